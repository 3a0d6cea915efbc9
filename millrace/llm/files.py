"""Binary files of tasks in the shared folder, committed by the rows that name them.

A task writes its file under a name of its own and returns rows that hold the name. Only files named in
the written table of those rows are ever read, so a file of a task that was lost or ran twice is ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from millrace.session import fresh_path


def folder(spark: SparkSession, label: str) -> str:
    """A new folder, as a URI, that the driver and all executors reach."""
    path = fresh_path(spark, label)
    return path if ":" in path.split("/")[0] else f"file://{path}"


def _system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def new_name(folder_uri: str, suffix: str) -> str:
    return f"{folder_uri}/{uuid.uuid4().hex}{suffix}"


def open_new(uri: str):
    """An output stream; the folder is made if need be."""
    system, path = _system(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_at(uri: str):
    """A file that can be read from any place."""
    system, path = _system(uri)
    return system.open_input_file(path)
