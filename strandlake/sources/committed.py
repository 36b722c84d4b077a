"""Sinks with a commit: tasks write bodies, the driver's commit what only it can know.

A task writes under names of its own; the commit gives the files of the tasks that
succeeded their final names, in the order of the partitions, and writes the manifest that
readers go by. What failed or repeated attempts leave is never listed.
"""

from __future__ import annotations

import gzip
import sys
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from . import files

BUFFER = 1 << 20


@dataclass
class Written(WriterCommitMessage):
    """``(group, temporary name, rows)`` of a task's files."""

    partition: int
    parts: list = field(default_factory=list)


class LinesWriter(DataSourceArrowWriter):
    """Rows ``(part, value)``, those of a part together, as text files: one for each task and part.

    ``together``: parts whose rows may come mixed; so many files are open at once.
    ``least``: parts of fewer rows in all are removed at the commit. ``header``: text of a first
    file, in which ``{rows}`` is the number of rows in all.
    """

    def __init__(self, options):
        self.path = options["path"]
        self.ending = options.get("ending", ".txt")
        self.least, self.header = int(options.get("least", "0")), options.get("header")
        self.together = int(options.get("together", "1"))

    def write(self, iterator):
        store, folder = files.system(self.path)
        out = Written(TaskContext.get().partitionId())
        opened: dict[str, list] = {}  # by part: file, lines that wait, their bytes, entry of the message

        def flush(x):
            if x[1]:
                x[0].write(b"\n".join(x[1]) + b"\n")
            x[1], x[2] = [], 0

        try:
            for batch in iterator:
                for part, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    if part not in opened:
                        while len(opened) >= self.together:
                            name = next(iter(opened))
                            flush(opened[name])
                            opened.pop(name)[0].close()
                        target = f"{part}/_{uuid.uuid4().hex}" if part else f"_{uuid.uuid4().hex}"
                        store.create_dir(f"{folder}/{target}".rpartition("/")[0], recursive=True)
                        raw = store.open_output_stream(f"{folder}/{target}", compression=None)
                        out.parts.append([part, target, 0])
                        opened[part] = [_Gzip(raw) if self.ending.endswith(".gz") else raw, [], 0, out.parts[-1]]
                    x = opened[part]
                    x[1].append(value)
                    x[2] += len(value)
                    x[3][2] += 1
                    if x[2] > BUFFER:
                        flush(x)
            for x in opened.values():
                flush(x)
        finally:
            for x in opened.values():
                x[0].close()
        return out

    def commit(self, messages):
        store, folder = files.system(self.path)
        messages = sorted((m for m in messages if m), key=lambda m: m.partition)
        total: dict[str, int] = {}
        for m in messages:
            for part, _, n in m.parts:
                total[part] = total.get(part, 0) + n
        small = {p: n for p, n in total.items() if n < self.least}
        store.create_dir(folder, recursive=True)
        kept, number = [], {}
        for m in messages:
            for part, name, n in m.parts:
                if part in small:
                    store.delete_file(f"{folder}/{name}")
                    continue
                number[part] = number.get(part, -1) + 1
                target = f"{part}/part-{number[part]:05d}{self.ending}".lstrip("/")
                store.move(f"{folder}/{name}", f"{folder}/{target}")
                kept.append({"part": part, "file": target, "rows": n})
        rows = sum(x["rows"] for x in kept)
        if self.header is not None:
            with store.open_output_stream(f"{folder}/header") as f:
                f.write(self.header.replace("{rows}", str(rows)).encode())
        files.write_manifest(self.path, {"rows": rows, "files": kept, "small": small})

    def abort(self, messages):
        store, folder = files.system(self.path)
        for m in messages:
            for _, name, _ in m.parts if m else []:
                store.delete_file(f"{folder}/{name}")


class _Gzip(gzip.GzipFile):
    """Closes what it writes to as well."""

    def __init__(self, raw):
        super().__init__(fileobj=raw, mode="wb", compresslevel=4, mtime=0)
        self._raw = raw

    def close(self):
        super().close()
        self._raw.close()


class LinesSink(DataSource):
    @classmethod
    def name(cls):
        return "strandlake_lines"

    def schema(self):
        return "part string, value string"

    def writer(self, schema, overwrite):
        return LinesWriter(self.options)


def write_lines(df: DataFrame, path: str, **options) -> None:
    """Rows ``part, value`` under ``path``; a task's rows of one part should stand together."""
    spark = df.sparkSession
    for module in (files, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)  # workers needn't have this package
    spark.dataSource.register(LinesSink)
    df.select("part", "value").write.format(LinesSink.name()).mode("append").options(**{k: str(v) for k, v in options.items()}).option("path", path).save()


def manifest_rows(spark: SparkSession, path: str) -> DataFrame:
    """``part, rows, kept``: what a commit kept and what it removed as too small."""
    m = files.read_manifest(path)
    total: dict[str, int] = {}
    for x in m["files"]:
        total[x["part"]] = total.get(x["part"], 0) + x["rows"]
    rows = [(p, n, True) for p, n in total.items()] + [(p, n, False) for p, n in m["small"].items()]
    return spark.createDataFrame(rows, "part string, rows long, kept boolean")


def files_of(path: str) -> list[str]:
    """The committed files, in their order."""
    return [f"{path}/{x['file']}" for x in files.read_manifest(path)["files"]]
