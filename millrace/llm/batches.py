"""Arrow batches inside tasks: slices whose size is bounded by characters, not by rows."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa


def slices(batches: Iterator[pa.RecordBatch], text: str, most_chars: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Consecutive row slices and the values of column `text` in each.

    A slice ends once it holds `most_chars` characters; one longer text is a slice of its own, so
    memory is bounded by the longest text. Every row is in exactly one slice.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        values = column.to_pylist()
        sizes = [len(v) if v is not None else 0 for v in values]
        start = chars = 0
        for i, size in enumerate(sizes):
            if chars and chars + size > most_chars:
                yield batch.slice(start, i - start), values[start:i]
                start, chars = i, 0
            chars += size
        if start < len(values):
            yield batch.slice(start), values[start:]


def importable(spark) -> None:
    """Lets Python workers of this session find this package where the driver found it.

    On a cluster the package is installed or passed with --py-files; this covers a session that was
    started from another folder.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
