"""millrace: warehouse layouts, validated ingest and session analytics on Spark DataFrames."""
