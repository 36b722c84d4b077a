"""Audit of filters that interact: what each removes in every order of application.

A sparse document-term matrix decides the filters on words. Where texts are
read, words are numbered by a dictionary of some MB of text, a page, and documents become CSR shards in these numbers. All pages' words meet
in one global dictionary: a shuffle by word, in which a page lists each word once
however often it stands there, so the most frequent word is as many rows as there are pages. The
pages get their words' global numbers back, and shards are renumbered by them. Row
sums are a document's words, nonzero counts its distinct words.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import sendable, stored, table, text_or_empty
from .textstats import SPACE, Words, slices, sums

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
#: Distinct words of shards, added up, and shards of a page, which ends with the shard in which it gets as many.
PAGE, SHARDS = 1 << 21, 32
#: Words of a page in one row, so that no row and none of its buffers is large.
RUN = 1 << 15

SIGN = np.zeros(256, bool)
SIGN[list(b"#$%&*|")] = True


ENCODED = pa.schema([
    ("page", pa.int64()), ("shard", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("part", pa.list_(pa.string())), ("sha", pa.list_(pa.string())),
    ("marks", pa.list_(pa.int32())), ("indptr", pa.binary()), ("indices", pa.binary()), ("data", pa.binary()), ("first", pa.int64()), ("words", pa.list_(pa.binary())),
])
SHARD = "page long, shard long, n_rows int, indptr binary, indices binary, data binary"
COUNTS = "shard long, row int, n_words long, n_distinct long"


def _packed(x: np.ndarray) -> bytes:
    """int32 as four runs of bytes, lowest first: small numbers compress well."""
    return np.ascontiguousarray(x.astype(np.int32).view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(x: pa.Scalar) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of a slice, and their rows."""
    inside = ~SPACE[data]
    words = Words(data, offsets, inside)
    ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(data[inside])]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, buffers).dictionary_encode(), words.row.astype(np.int32)


def encoded(docs: DataFrame, *, words_of_page: int = PAGE) -> DataFrame:
    """CSR shards of ``docs(doc_id, part, sha, text)`` in the numbers of their pages, and the pages' ``words`` from number ``first`` on.

    A shard holds about a MB of text, or one longer document; ``marks`` has the bits of the filters on
    characters for each of its documents. Stored, as the numbers depend on how the rows are dealt.
    """

    def emit(**columns):
        return pa.RecordBatch.from_arrays([pa.array([columns.get(f.name)], f.type) for f in ENCODED], schema=ENCODED)

    def finish(page, held):
        """One dictionary for the shards of a page."""
        whole = pa.concat_arrays([words.dictionary for _, words, _, _ in held]).dictionary_encode()
        of, at = whole.indices.to_numpy().astype(np.int64), 0
        for shard, words, row, told in held:
            size, n = len(words.dictionary), len(told["marks"])
            entry, count = np.unique((row.astype(np.int64) << 32) + of[at : at + size][words.indices.to_numpy()], return_counts=True)
            at += size
            ptr = np.searchsorted(entry, np.arange(n + 1) << 32)
            yield emit(page=page, shard=shard, indptr=_packed(ptr), indices=_packed(entry & 0xFFFFFFFF), data=_packed(count), **told)
        for first in range(0, len(whole.dictionary), RUN):
            yield emit(page=page, first=first, words=whole.dictionary.slice(first, RUN).to_pylist())

    def run(batches):
        page, shard = TaskContext.get().partitionId() << 12, TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            for at, _, data, offsets in slices(batch.column("text")):
                words, row = _words(data, offsets)
                capitals, points = sums((data >= 65) & (data <= 90), offsets), sums((data & 0xC0) != 0x80, offsets)
                marks = BIT["C"] * (100 * capitals > 5 * points) + BIT["D"] * (sums(SIGN[data], offsets) > 0)
                told = {c: batch.column(c).slice(at, len(marks)).to_pylist() for c in ("doc_id", "part", "sha")}
                held.append((shard, words, row, told | {"marks": marks.tolist()}))
                shard, size = shard + 1, size + len(words.dictionary)
                if size >= words_of_page or len(held) == SHARDS:
                    yield from finish(page, held)
                    page, held, size = page + 1, [], 0
        if held:
            yield from finish(page, held)

    kind = "page long, shard long, doc_id array<long>, part array<string>, sha array<string>, marks array<int>, indptr binary, indices binary, data binary, first long, words array<binary>"
    return stored(docs.select("doc_id", "part", "sha", "text").mapInArrow(run, kind), "encoded")


def dictionary(found: DataFrame) -> DataFrame:
    """``word, own, id`` of :func:`encoded`'s pages: ``own`` is a word's number in a page, behind the page's number; a word's one ``id`` is its smallest ``own``."""
    words = found.where("words IS NOT NULL").select("page", "first", F.posexplode("words").alias("code", "word"))
    words = words.select("word", (F.shiftleft("page", 31) + F.col("first") + F.col("code")).alias("own"))
    return words.withColumn("id", F.min("own").over(Window.partitionBy("word")))


def _renumbered(shards: pa.Table, moved: pa.Table) -> pa.Table:
    """A page's shards in global numbers; ``moved`` has those of its words whose global number isn't their own."""
    if not shards.num_rows:
        return pa.table([[]] * 6, names=[c.split()[0] for c in SHARD.split(", ")])
    codes = [_unpacked(x) for x in shards.column("indices")]
    base = shards.column("page")[0].as_py() << 31
    of = base + np.arange(max((int(x.max(initial=-1)) for x in codes)) + 1)
    of[moved.column("own").to_numpy() - base] = moved.column("id").to_numpy()
    new = pa.array([of[x].tobytes() for x in codes], pa.binary())
    return shards.set_column(shards.schema.get_field_index("indices"), "indices", new)


def _counted(shards: pa.Table | pa.RecordBatch) -> pa.Table:
    """``shard, row, n_words, n_distinct`` of some shards: row sums and nonzero counts."""
    out = [[np.zeros(0, kind)] for kind in (np.int64, np.int32, np.int64, np.int64)]
    for shard, indptr, data in zip(shards.column("shard").to_pylist(), shards.column("indptr"), shards.column("data"), strict=True):
        ptr = _unpacked(indptr)
        total = np.concatenate([[0], np.cumsum(_unpacked(data), dtype=np.int64)])
        n = len(ptr) - 1
        for column, x in zip(out, (np.full(n, shard), np.arange(n, dtype=np.int32), total[ptr[1:]] - total[ptr[:-1]], np.diff(ptr).astype(np.int64)), strict=True):
            column.append(x)
    return pa.table([np.concatenate(x) for x in out], names=["shard", "row", "n_words", "n_distinct"])


def _by_page(found: DataFrame, read: Callable[[pa.Table, pa.Table], pa.Table], kind: str) -> DataFrame:
    moved = dictionary(found).where("own <> id").select(F.shiftright("own", 31).alias("page"), "own", "id")
    shards = found.where("words IS NULL").select("page", "shard", F.size("doc_id").alias("n_rows"), "indptr", "indices", "data")
    return shards.groupBy("page").cogroup(moved.groupBy("page")).applyInArrow(read, kind)  # a page is bounded


def term_shards(found: DataFrame) -> DataFrame:
    """``page, shard, n_rows, indptr, indices, data``: the CSR shards of :func:`encoded` in global numbers, ``indices`` as bytes of int64."""
    return _by_page(found, lambda shards, moved: _renumbered(shards, moved), SHARD)


def row_counts(shards: DataFrame) -> DataFrame:
    """``shard, row, n_words, n_distinct``: row sums and nonzero counts."""

    def run(batches):
        for batch in batches:
            yield from _counted(batch).to_batches()

    return shards.select("shard", "indptr", "data").mapInArrow(run, COUNTS)


def term_counts(found: DataFrame) -> DataFrame:
    """:func:`row_counts` of :func:`term_shards`, taken where a page is renumbered: a second Python worker a task and the way there would hold the page again."""
    return _by_page(found, lambda shards, moved: _counted(_renumbered(shards, moved)), COUNTS)


def failed_filters(docs: DataFrame) -> DataFrame:
    """``doc_id, part, failed`` for each row of ``docs(doc_id, text, source)``; ``failed`` has a bit for each filter that the row fails.

    A: under 50 words. B: under 65 distinct words in 100. C: over 5 of A-Z in 100
    code points. D: any of ``#$%&*|``. E: the same text stands under a smaller
    doc_id. Null texts are empty, null sources the empty string; a row without
    doc_id fails E never and makes no other row fail it; rows that share id and text
    don't make each other fail. Texts are taken as equal by their SHA-256. Other
    columns are ignored; an empty table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), text_or_empty().alias("text"))
    docs = docs.withColumn("sha", F.sha2("text", 256))
    found = encoded(docs)
    rows = found.where("words IS NULL").select("shard", F.posexplode(F.arrays_zip("doc_id", "part", "sha", "marks")).alias("row", "x")).select("shard", "row", "x.*")
    rows = rows.join(term_counts(found), ["shard", "row"])
    marks = F.col("marks") + F.when(F.col("n_words") < 50, BIT["A"]).otherwise(0) + F.when(F.expr("100 * n_distinct < 65 * n_words"), BIT["B"]).otherwise(0)
    rows = stored(rows.select("doc_id", "part", "sha", marks.alias("marks")), "marks")
    first = rows.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("sha", "first")
    found = rows.join(sendable(stored(first, "first")), "sha", "left")
    return found.select("doc_id", "part", (F.col("marks") + F.when(F.col("doc_id") > F.col("first"), BIT["E"]).otherwise(0)).alias("failed"))


def orders(spark: SparkSession) -> DataFrame:
    """``filter_order, step, filter, before``: the 600 steps of all orders; ``before`` has the bits of the earlier filters."""
    rows = [
        ("".join(p), k + 1, p[k], sum(BIT[f] for f in p[:k]))
        for p in itertools.permutations(FILTERS)
        for k in range(len(p))
    ]
    return spark.createDataFrame(rows, "filter_order string, step int, filter string, before int")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What every step of every order of the five filters keeps and removes, for each source.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``;
    a row for each source, order and step. Documents are counted by the set of
    filters that they fail (32 at most for a source), and only these counts meet
    the 600 steps. A document is good or toxic if any row of
    ``labels(doc_id, quality, toxic)`` says so. See :func:`failed_filters` for odd rows.
    """
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    docs = failed_filters(docs).join(known.where("good OR toxic"), "doc_id", "left")
    one = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False)))
    cells = docs.groupBy("part", "failed").agg(F.count("*").alias("n"), one("good").alias("good"), one("toxic").alias("toxic"))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(b).alias("bit")) for f, b in BIT.items()]))
    steps = cells.withColumn("f", each).select("*", "f.*").join(F.broadcast(orders(docs.sparkSession)), "filter")
    fails, earlier = F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0
    total = lambda when, c="n": F.sum(F.when(when, F.col(c)).otherwise(0))
    # of all orders, a document that fails k filters falls to each of them in one of k
    n_orders = F.lit(120)
    share = F.when(fails, F.col("n") * F.floor(n_orders / F.bit_count("failed"))).otherwise(0)
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("failed") == F.col("bit")).alias("unique_fails"), total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"), F.sum(share).alias("shapley"),
    )


def op13_audit(spark, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def oracle() -> str:
    return r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
f AS (
  SELECT w.doc_id, part,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END AS a,
         CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 1 ELSE 0 END AS b,
         CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * len(text) THEN 1 ELSE 0 END AS c,
         CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
         CASE WHEN w.doc_id > first_id THEN 1 ELSE 0 END AS e,
         CASE WHEN w.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 1 ELSE 0 END AS good,
         CASE WHEN w.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 1 ELSE 0 END AS toxic
  FROM w),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
perms AS (
  SELECT [p.x, q.x, r.x, s.x, t.x] AS p FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (
  SELECT array_to_string(p, '') AS filter_order, k AS step, p[k] AS filter, p[1:k - 1] AS before
  FROM perms, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
fails AS (
  SELECT part, good, toxic,
         list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: [a, b, c, d, e][i] = 1) AS failed
  FROM f),
counts AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY ALL),
seen AS (
  SELECT part, filter_order, step, n, good, toxic, failed, filter,
         list_contains(failed, filter) AS fails, list_has_any(failed, before) AS earlier
  FROM counts, steps)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(sum(CASE WHEN NOT fails AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN fails AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN fails AND earlier THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN failed = [filter] THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN fails AND NOT earlier THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN fails AND NOT earlier THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN fails THEN n * (120 // len(failed)) ELSE 0 END) AS BIGINT) AS shapley
FROM seen GROUP BY part, filter_order, step
"""
