"""Tables of positions as block-compressed files with an index, and scans that read only a region's blocks.

A file is a series of gzip members, so any tool that reads gzip reads it whole.
Each member holds the rows of one contig, up to BLOCK bytes of them in the order of their
starts. The file's index (Parquet, beside it) has a row for each block: where it
lies, its first and last start, and its largest end. The manifest has the same for whole
files. Filters on contig, start and end reach the scan: it opens the files that
can hold such rows, and reads the bytes of the blocks that can.
"""

from __future__ import annotations

import gzip
import io
import itertools
import sys
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.csv as pc
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from . import files

#: Bytes of text in a block, and of blocks that are read at once.
BLOCK, RUN = 1 << 16, 1 << 21
INDEX = pa.schema([("offset", pa.int64()), ("size", pa.int64()), ("contig", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("reach", pa.int64()), ("rows", pa.int64())])


@dataclass
class Part(WriterCommitMessage):
    partition: int
    name: str = ""
    spans: list = field(default_factory=list)  # contig, first start, last start, largest end, for each contig
    rows: int = 0


class BlockWriter(DataSourceArrowWriter):
    def __init__(self, options, schema):
        self.path, self.schema = options["path"], schema
        self.keys = [options.get(k, k) for k in ("contig", "start", "end")]

    def write(self, iterator):
        out = Part(TaskContext.get().partitionId())
        store, folder = files.system(self.path)
        store.create_dir(folder, recursive=True)
        out.name = f"part-{out.partition:05d}-{uuid.uuid4().hex}"
        index, at = [], 0
        options = pc.WriteOptions(include_header=False, delimiter="\t", quoting_style="none")
        with store.open_output_stream(f"{folder}/{out.name}.tsv.gz", compression=None) as f:
            for table in self._blocks(iterator):
                text = io.BytesIO()
                pc.write_csv(table, text, options)
                data = gzip.compress(text.getvalue(), 4, mtime=0)
                contig, start, end = (table.column(k).to_pylist() for k in self.keys)
                if start != sorted(start):
                    raise ValueError("rows have to be sorted by contig and start")
                index.append((at, len(data), contig[0], start[0], start[-1], max(end), len(start)))
                f.write(data)
                at += len(data)
        if not index:
            store.delete_file(f"{folder}/{out.name}.tsv.gz")
            return Part(out.partition)
        table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*index, strict=True), INDEX.types, strict=True)], schema=INDEX)
        with store.open_output_stream(f"{folder}/{out.name}.idx") as f:
            pq.write_table(table, f)
        for _, _, contig, first, last, reach, n in index:
            if out.spans and out.spans[-1][0] == contig:
                out.spans[-1][2:] = [last, max(reach, out.spans[-1][3])]
            else:
                out.spans.append([contig, first, last, reach])
            out.rows += n
        return out

    def _blocks(self, iterator):
        """The rows in tables of one contig and about BLOCK bytes of text."""
        waiting: list = []
        for batch in iterator:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            step = max(1, table.num_rows * BLOCK // max(1, table.nbytes))
            code = table.column(self.keys[0]).combine_chunks().dictionary_encode().indices.to_numpy()
            edges = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), len(code)]
            for first, last in itertools.pairwise(edges):
                for at in range(first, last, step):
                    piece = table.slice(at, min(step, last - at))
                    if waiting and (waiting[0].column(self.keys[0])[0] != piece.column(self.keys[0])[0] or sum(x.nbytes for x in waiting) >= BLOCK):
                        yield pa.concat_tables(waiting)
                        waiting = []
                    waiting.append(piece)
        if waiting:
            yield pa.concat_tables(waiting)

    def commit(self, messages):
        parts = sorted((m for m in messages if m and m.name), key=lambda m: m.partition)
        store, folder = files.system(self.path)
        store.create_dir(folder, recursive=True)
        content = {"columns": [[f.name, f.dataType.simpleString()] for f in self.schema.fields], "keys": self.keys, "rows": sum(m.rows for m in parts)}
        files.write_manifest(self.path, content | {"files": [{"name": m.name, "rows": m.rows, "spans": m.spans} for m in parts]})

    def abort(self, messages):
        store, folder = files.system(self.path)
        for m in messages:
            for ending in ("tsv.gz", "idx") if m and m.name else ():
                store.delete_file(f"{folder}/{m.name}.{ending}")


@dataclass
class Wanted:
    """What the pushed filters ask for; nothing set means all."""

    contig: str | None = None
    start_from: int | None = None
    start_to: int | None = None
    end_from: int | None = None

    def has(self, contig: str, first: int, last: int, reach: int) -> bool:
        return (
            (self.contig is None or contig == self.contig)
            and (self.start_from is None or last >= self.start_from)
            and (self.start_to is None or first <= self.start_to)
            and (self.end_from is None or reach >= self.end_from)
        )


@dataclass
class File(InputPartition):
    path: str
    wanted: Wanted

    def __post_init__(self):
        super().__init__(self.path)


def blocks_of(file: File) -> list[tuple[int, int]]:
    """``(offset, bytes)`` of the runs of blocks that can hold what is wanted."""
    store, path = files.system(file.path)
    with store.open_input_file(f"{path}.idx") as f:
        index = pq.read_table(f)
    runs: list = []
    for offset, size, contig, first, last, reach, _ in zip(*(c.to_pylist() for c in index.columns), strict=True):
        if file.wanted.has(contig, first, last, reach):
            if runs and sum(runs[-1]) == offset and runs[-1][1] < RUN:
                runs[-1] = (runs[-1][0], runs[-1][1] + size)
            else:
                runs.append((offset, size))
    return runs


class BlockReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.schema, self.wanted = options["path"], schema, Wanted()
        self.manifest = files.read_manifest(self.path)

    def pushFilters(self, filters):
        contig, start, end = ((k,) for k in self.manifest["keys"])
        w = self.wanted
        most = lambda a, b: b if a is None else max(a, b)
        least = lambda a, b: b if a is None else min(a, b)
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == contig:
                w.contig = f.value
            elif isinstance(f, EqualTo) and f.attribute == start:
                w.start_from, w.start_to = most(w.start_from, f.value), least(w.start_to, f.value)
            elif isinstance(f, GreaterThan | GreaterThanOrEqual) and f.attribute in (start, end):
                value = f.value + isinstance(f, GreaterThan)
                if f.attribute == start:
                    w.start_from = most(w.start_from, value)
                else:
                    w.end_from = most(w.end_from, value)
            elif isinstance(f, LessThan | LessThanOrEqual) and f.attribute == start:
                w.start_to = least(w.start_to, f.value - isinstance(f, LessThan))
            yield f  # blocks hold other rows too

    def partitions(self):
        return [File(f"{self.path}/{x['name']}", self.wanted) for x in self.manifest["files"] if any(self.wanted.has(*s) for s in x["spans"])]

    def read(self, partition):
        if partition is None:  # Spark's stand-in where there are no partitions
            return
        store, path = files.system(partition.path)
        types = {f.name: f.type for f in to_arrow_schema(self.schema)}
        convert = pc.ConvertOptions(column_types=types, null_values=[""], strings_can_be_null=True, true_values=["true"], false_values=["false"])
        with store.open_input_file(f"{path}.tsv.gz") as f:
            for offset, size in blocks_of(partition):
                f.seek(offset)
                text = io.BytesIO(gzip.decompress(f.read(size)))
                reader = pc.open_csv(text, pc.ReadOptions(column_names=list(types)), pc.ParseOptions(delimiter="\t", quote_char=False), convert)
                yield from reader


class BlockSource(DataSource):
    """Options: ``path``; for writing ``contig``, ``start`` and ``end``, the names of these columns."""

    @classmethod
    def name(cls):
        return "strandlake_blocks"

    def schema(self):
        return ", ".join(f"`{n}` {t}" for n, t in files.read_manifest(self.options["path"])["columns"])

    def reader(self, schema):
        return BlockReader(self.options, schema)

    def writer(self, schema, overwrite):
        return BlockWriter(self.options, schema)


def _register(spark: SparkSession) -> None:
    for module in (files, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)  # workers needn't have this package
    spark.dataSource.register(BlockSource)


def write_blocks(df: DataFrame, path: str, *, contig: str = "contig", start: str = "start", end: str = "end", parts: int | None = None) -> None:
    """Rows in files of ranges of positions, block-compressed and indexed; null contigs are left out, as no region holds them.

    Values are written as text between tabs, so strings must hold no tabs and no
    line ends; an empty string is read as null.
    """
    _register(df.sparkSession)
    df = df.where(df[contig].isNotNull() & df[start].isNotNull() & df[end].isNotNull())
    out = df.repartitionByRange(parts, contig, start) if parts else df.repartitionByRange(contig, start)
    out = out.sortWithinPartitions(contig, start, end, *[c for c in df.columns if c not in (contig, start, end)])
    out.write.format(BlockSource.name()).mode("append").options(contig=contig, start=start, end=end).option("path", path).save()


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The rows that :func:`write_blocks` wrote; filters on contig, start and end decide which blocks are read.

    Switches the pushdown of filters to Python sources on in this session; without it the
    result is the same, from all blocks.
    """
    _register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(BlockSource.name()).option("path", path).load()
