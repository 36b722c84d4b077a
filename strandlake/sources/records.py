"""FASTQ, FASTA and numbered lines as a data source: byte ranges of plain files, one partition for each compressed file.

A range owns the records that start in it, so files are cut without looking
at them: a task skips to the first record start behind its first byte and reads
on past its last until the record there ends. Ordinals need the number of
records in the ranges before; those are counted by a first job over the files that
are cut, a row for each range, and no row is shuffled.
"""

from __future__ import annotations

import gzip
import itertools
import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import files

CHUNK = 1 << 22
KINDS = {
    "fastq": "path string, ordinal long, name string, seq string, qual string",
    "fasta": "path string, rank int, name string, seq string",
    "lines": "path string, ordinal long, value string",
    "pairs": "pair_id string, ordinal long, name1 string, seq1 string, qual1 string, name2 string, seq2 string, qual2 string",
}


@dataclass
class Range(InputPartition):
    """Records of ``path`` that start in ``[start, end)``; an ``end`` of -1 means all of a compressed file."""

    path: str
    start: int
    end: int
    first: int = 0

    def __post_init__(self):
        super().__init__(self.start)


@dataclass
class Pair(InputPartition):
    """Records of ``one`` and those with the same numbers of a second file, in ``others`` in their order."""

    pair_id: str
    one: Range
    others: list[Range]

    def __post_init__(self):
        super().__init__(self.one.start)


def _chunks(r: Range) -> Iterator[bytes]:
    """The file's bytes from one before the range's start on, so that a line start there can be told."""
    store, path = files.system(r.path)
    if r.end < 0:
        with store.open_input_file(path) as raw, gzip.GzipFile(fileobj=raw) as f:
            while data := f.read(CHUNK):
                yield data
        return
    with store.open_input_file(path) as f:
        f.seek(max(0, r.start - 1))
        while data := f.read(CHUNK):
            yield data


def _lines(r: Range) -> Iterator[tuple[int, list[bytes]]]:
    """``(position of the first line, whole lines)``, chunk by chunk, from the first line that starts in the range on."""
    at, left, skip = max(0, r.start - 1), [], r.start > 0 and r.end >= 0
    for data in _chunks(r):
        if skip:
            cut = data.find(b"\n") + 1
            if not cut:
                at += len(data)  # of the line that began before the range
                continue
            at, data, skip = at + cut, data[cut:], False
        end = data.rfind(b"\n") + 1
        if end:
            whole = b"".join([*left, data[:end]])
            yield at, whole[:-1].split(b"\n")
            at, left = at + len(whole), []
        left.append(data[end:])
    if not skip and any(left):
        yield at, [b"".join(left)]


def line_records(r: Range) -> Iterator[list[bytes]]:
    """Lines that start in the range."""
    for at, lines in _lines(r):
        if r.end >= 0 and at + sum(map(len, lines)) + len(lines) > r.end:
            starts = itertools.accumulate((len(x) + 1 for x in lines), initial=at)
            yield [x for x, start in zip(lines, starts, strict=False) if start < r.end]
            return
        yield lines


def fastq_records(r: Range) -> Iterator[list[list[bytes]]]:
    """The lines of whole records, four lists at a time.

    Of four lines in a row, only the first line of a record begins with an at
    sign and has one with a plus sign two lines behind it: a sequence never begins with one.
    """
    lines: list[bytes] = []
    at, found = 0, r.start <= 0 or r.end < 0
    for start, more in _lines(r):
        if not lines:
            at = start
        lines += more
        if not found:
            if len(lines) < 8:
                continue
            at, lines, found = *_first_record(at, lines), True
        n = _inside(r, at, lines)
        yield [lines[k:n:4] for k in range(4)]
        if n < len(lines) // 4 * 4:
            return
        at, lines = at + sum(map(len, lines[:n])) + n, lines[n:]
    if not found:
        at, lines = _first_record(at, lines)
    if len(lines) == 3 and not lines[1]:
        lines.append(b"")  # an empty read, and no line end behind its last line
    n = _inside(r, at, lines)
    if n == len(lines) // 4 * 4 and any(x.strip() for x in lines[n:]) and (r.end < 0 or at < r.end):
        raise ValueError(f"{r.path} ends within a record")
    yield [lines[k:n:4] for k in range(4)]


def paired_records(p: Pair) -> Iterator[tuple[list[list[bytes]], list[list[bytes]]]]:
    """The same records of both files, as lists of their four lines; those that only one file has are left out."""
    rest, skip = [[], [], [], []], p.one.first - p.others[0].first
    others = itertools.chain.from_iterable(map(fastq_records, p.others))
    for mine in fastq_records(p.one):
        while len(rest[0]) < len(mine[0]) and (more := next(others, None)) is not None:
            rest = [a + b[skip:] for a, b in zip(rest, more, strict=True)]
            skip = max(0, skip - len(more[0]))
        n = min(len(mine[0]), len(rest[0]))
        yield [x[:n] for x in mine], [x[:n] for x in rest]
        if n < len(mine[0]):
            return
        rest = [x[n:] for x in rest]


def _inside(r: Range, at: int, lines: list[bytes]) -> int:
    """How many of the lines, the first of which begins at ``at``, are of whole records that start in the range."""
    n = len(lines) // 4 * 4
    if r.end < 0 or at + sum(map(len, lines[:n])) + n <= r.end:
        return n
    for k in range(0, n, 4):
        if at >= r.end:
            return k
        at += sum(map(len, lines[k : k + 4])) + 4
    return n


def _first_record(at: int, lines: list[bytes]) -> tuple[int, list[bytes]]:
    for k in range(min(4, len(lines))):
        if lines[k][:1] == b"@" and lines[k + 2 : k + 3] and lines[k + 2][:1] == b"+":
            return at, lines[k:]
        at += len(lines[k]) + 1
    return at, lines[4:]


def fasta_records(r: Range) -> Iterator[tuple[bytes, list[bytes]]]:
    """``(name, lines of the sequence)``; what stands before a file's first name is skipped."""
    name, parts = None, []
    for at, lines in _lines(r):
        for line in lines:
            if line[:1] == b">":
                if name is not None:
                    yield name, parts
                name, parts = line[1:], []
                if 0 <= r.end <= at:
                    return
            elif name is not None:
                parts.append(line)
            elif 0 <= r.end <= at:
                return
            at += len(line) + 1
    if name is not None:
        yield name, parts


def _text(values: list[bytes]) -> pa.Array:
    return pa.array([x.rstrip(b"\r") for x in values], pa.binary()).cast(pa.string())


class RecordReader(DataSourceReader):
    def __init__(self, options):
        self.kind, self.count = options["kind"], options.get("count") == "true"
        given = json.loads(options["ranges"])
        self.ranges = [Pair(name, Range(*x), [Range(*y) for y in z]) for name, x, z in given] if self.kind == "pairs" else [Range(*x) for x in given]

    def partitions(self):
        return self.ranges

    def read(self, partition: Range):
        if partition is None:  # Spark's stand-in where there are no partitions
            return
        if self.count:
            size = {"fastq": lambda x: len(x[0]), "lines": len, "fasta": lambda _: 1}[self.kind]
            n = sum(map(size, {"fastq": fastq_records, "lines": line_records, "fasta": fasta_records}[self.kind](partition)))
            yield pa.RecordBatch.from_arrays([pa.array([partition.path]), pa.array([partition.start], pa.int64()), pa.array([n], pa.int64())], names=["path", "start", "n"])
        elif self.kind == "lines":
            at = partition.first
            for lines in line_records(partition):
                value = pa.array([x.rstrip(b"\r") for x in lines], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([partition.path] * len(lines), pa.string()), pa.array(range(at, at + len(lines)), pa.int64()), value], names=["path", "ordinal", "value"])
                at += len(lines)
        elif self.kind == "pairs":
            at = partition.one.first
            for a, b in paired_records(partition):
                ordinal = pa.array(range(at, at + len(a[0])), pa.int64())
                at += len(a[0])
                columns = [_text(x) for name, seq, _, qual in (a, b) for x in ([y[1:] for y in name], seq, qual)]
                yield pa.RecordBatch.from_arrays([pa.array([partition.pair_id] * len(ordinal), pa.string()), ordinal, *columns], names=["pair_id", "ordinal", "name1", "seq1", "qual1", "name2", "seq2", "qual2"])
        elif self.kind == "fastq":
            at = partition.first
            for name, seq, _, qual in fastq_records(partition):
                ordinal = pa.array(range(at, at + len(name)), pa.int64())
                at += len(name)
                yield pa.RecordBatch.from_arrays([pa.array([partition.path] * len(name), pa.string()), ordinal, _text([x[1:] for x in name]), _text(seq), _text(qual)], names=["path", "ordinal", "name", "seq", "qual"])
        else:
            rows, size = [], 0
            for k, (name, parts) in enumerate(fasta_records(partition), partition.first + 1):
                rows.append((k, name.strip(), b"".join(x.strip() for x in parts)))
                size += len(rows[-1][2])
                if size > CHUNK or len(rows) == 10_000:
                    yield self._fasta(partition.path, rows)
                    rows, size = [], 0
            if rows:
                yield self._fasta(partition.path, rows)

    @staticmethod
    def _fasta(path, rows):
        rank, name, seq = zip(*rows, strict=True)
        text = lambda x: pa.array(x, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array(rank, pa.int32()), text(name), text(seq)], names=["path", "rank", "name", "seq"])


class RecordSource(DataSource):
    """Options: ``kind``, ``ranges`` as JSON, ``count``."""

    @classmethod
    def name(cls):
        return "strandlake_records"

    def schema(self):
        return "path string, start long, n long" if self.options.get("count") == "true" else KINDS[self.options["kind"]]

    def reader(self, schema):
        return RecordReader(self.options)


def _load(spark: SparkSession, kind: str, ranges: list, **more) -> DataFrame:
    for module in (files, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)  # workers needn't have this package
    spark.dataSource.register(RecordSource)
    return spark.read.format(RecordSource.name()).options(kind=kind, ranges=json.dumps(ranges), **more).load()


def _ranges(spark: SparkSession, found: list[tuple[str, int]], kind: str, split: int | None) -> tuple[list[tuple], dict]:
    """Ranges of the files, numbered, and the number of records of those that are of a file that is cut."""
    split = split or int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    ranges = []
    for name, size in found:
        if name.endswith(".gz"):
            ranges.append((name, 0, -1, 0))
        else:
            ranges += [(name, at, min(size, at + split), 0) for at in range(0, size, split)]
    cut = {r[0] for r in ranges if r[1]}
    if not cut:
        return ranges, {}
    # a row for each range of a file that is cut
    n = {(x["path"], x["start"]): x["n"] for x in _load(spark, kind, [r for r in ranges if r[0] in cut], count="true").collect()}
    before, numbered = {}, []
    for name, start, end, _ in ranges:
        first = before.get(name, 0)
        before[name] = first + n.get((name, start), 0)
        numbered.append((name, start, end, first))
    return numbered, n


def scan(spark: SparkSession, path: str, kind: str, split: int | None = None) -> DataFrame:
    """Records of the files that ``path`` names, cut into ranges of ``split`` bytes (Spark's own bound by default)."""
    return _load(spark, kind, _ranges(spark, files.listed(spark, path), kind, split)[0])


def scan_pairs(spark: SparkSession, pairs: list[tuple[str, tuple[str, int], tuple[str, int]]], split: int | None = None) -> DataFrame:
    """Records of two FASTQ files side by side, for each ``(name, first, second)`` with ``(path, bytes)`` of the files.

    A task reads a range of the first file and those of the second that hold the same numbers; if one of
    them is compressed it reads both whole.
    """
    packed = lambda *both: any(x[0].endswith(".gz") for x in both)
    ranges, n = _ranges(spark, sorted({x for _, *both in pairs if not packed(*both) for x in both}), "fastq", split)
    of: dict[str, list] = {}
    for r in ranges:
        of.setdefault(r[0], []).append((*r[3:], r[3] + n[r[:2]] if r[:2] in n else sys.maxsize, r))
    given = []
    for name, *both in pairs:
        if packed(*both):
            one, other = ((path, 0, -1 if path.endswith(".gz") else size, 0) for path, size in both)
            given.append((name, one, [other]))
            continue
        for first, end, r in of.get(both[0][0], []):
            others = [x for a, b, x in of.get(both[1][0], []) if a < end and b > first]
            if others and first < end:
                given.append((name, r, others))
    return _load(spark, "pairs", given)
