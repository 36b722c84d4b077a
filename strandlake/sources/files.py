"""Files that a Python data source opens itself, by path or URI."""

from __future__ import annotations

import json
import re

import pyarrow.fs as fs
from pyspark.sql import SparkSession

MANIFEST = "_manifest.json"


def system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if path.startswith("file:"):
        path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of the files that a path or pattern names, those of a folder included, hidden ones not; by name."""
    top = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found, todo = [], list(store.globStatus(top) or [])
    if not todo:
        raise FileNotFoundError(pattern)
    while todo:
        x = todo.pop()
        if x.isDirectory():
            todo += [y for y in store.listStatus(x.getPath()) if y.getPath().getName()[0] not in "._"]
        else:
            found.append((x.getPath().toString(), x.getLen()))
    return sorted(found)


def read_manifest(path: str) -> dict:
    store, folder = system(path)
    with store.open_input_stream(f"{folder}/{MANIFEST}") as f:
        return json.loads(f.read())


def write_manifest(path: str, content: dict) -> None:
    store, folder = system(path)
    with store.open_output_stream(f"{folder}/{MANIFEST}") as f:
        f.write(json.dumps(content).encode())
