"""Numbered commits of a table or a set of tables: what readers see changes at once or not at all.

A commit is one small file, `<root>/_commits/<number>.json`, that names folders which were written before. It is
put in place by a rename that fails where the number is taken, so of two writers that start from one version one
gets an error and nothing of it is seen. Folders that no commit names are never read.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession

from millrace.session import on_file_system


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the table."""


def _folder(root: str) -> str:
    return f"{root}/_commits"


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all commits, oldest first."""
    files, folder = on_file_system(spark, _folder(root))
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def read(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict[str, Any]]:
    """The commit of this number, by default the latest, and its number; (-1, {}) before the first."""
    known = versions(spark, root)
    if version is None:
        version = known[-1] if known else -1
    if version == -1:
        return -1, {}
    files, path = on_file_system(spark, f"{_folder(root)}/{version:010d}.json")
    stream = files.open(path)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return version, json.loads(text)


def commit(spark: SparkSession, root: str, based_on: int, content: dict[str, Any]) -> int:
    """Makes `content` the version after `based_on`. Raises CommitConflict where that is taken."""
    number = based_on + 1
    files, draft = on_file_system(spark, f"{_folder(root)}/.{uuid.uuid4().hex}")
    _, target = on_file_system(spark, f"{_folder(root)}/{number:010d}.json")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    # A rename does not replace a file on HDFS; local file systems would, so look first.
    placed = not files.exists(target) and files.rename(draft, target)
    if not placed:
        files.delete(draft, False)
        raise CommitConflict(f"version {number} of {root} exists")
    return number
