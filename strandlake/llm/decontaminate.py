"""Benchmark decontamination: a BM25 index of test items, block-max WAND, overlap checks.

The index is made of the test items; every passage of every training text is a
query. A passage skips an index block when the sum of its terms' block maxima
can't reach the lowest threshold in the block; what is left is scored exactly
and everything above its item's threshold is retrieved. A retrieved pair counts
if the item's question and answer both overlap with the text there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .textstats import Words, mix, slices

#: The index goes to every task: postings of 12 bytes for each distinct word of an item and at most this many bytes of item text,
#: else an error. One part of it holds this many items.
MAX_INDEX_BYTES, PART_ITEMS, BLOCK = 64 << 20, 1024, 8
PASSAGE, STRIDE = 128, 64
K1, B = 1.2, 0.75
SHINGLE = 3
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words; none if there are fewer."""
    if not n or len(h) < n:
        return np.zeros(0, np.uint64)
    g = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i]
    return mix(g)


@dataclass
class Part:
    """One part of the index: the postings of each term (``item, impact`` from ``start`` on) and its largest impact."""

    ids: np.ndarray
    terms: np.ndarray
    start: np.ndarray
    item: np.ndarray
    impact: np.ndarray
    top: np.ndarray
    threshold: np.ndarray
    block_threshold: np.ndarray
    question: list
    answer: list
    length: np.ndarray

    def dense(self, terms: np.ndarray) -> np.ndarray:
        """Impacts (term x item) of a few terms: those that a slice of text holds."""
        n = self.start[terms + 1] - self.start[terms]
        at = np.repeat(self.start[terms] - np.cumsum(n) + n, n) + np.arange(n.sum())
        out = np.zeros((len(terms), len(self.ids)), np.float32)
        out[np.repeat(np.arange(len(terms)), n), self.item[at]] = self.impact[at]
        return out


def _part_grams(h: np.ndarray) -> tuple[int, np.ndarray]:
    """The run length for a question or an answer, three words or all it has, and its distinct runs."""
    n = min(SHINGLE, len(h))
    return n, np.unique(_grams(h, n))


def _overlap(part: tuple[int, np.ndarray], h: np.ndarray) -> float:
    """Share of the part's runs that stand among the words ``h``; an empty part is there."""
    n, grams = part
    return float(np.isin(grams, _grams(h, n)).mean()) if n else 1.0


def _question_words(text: str, n: int) -> int:
    """Words of the question: up to the last question mark that something follows, else two thirds."""
    raw = text.encode()
    at = raw.rstrip(b" \t\r\n").rfind(b"?", 0, max(0, len(raw.rstrip()) - 1))
    if at >= 0:
        data = np.frombuffer(raw[: at + 1], np.uint8)
        q = len(Words(data, np.array([0, len(data)]), _LETTER[data]).starts)
        if 0 < q < n:
            return q
    return max(1, (2 * n) // 3)


def build_index(items: list[tuple[int, str]], share: float) -> list[Part]:
    """Index parts of ``(item_id, text)``; items without words are in none."""
    kept = []
    for i, text in items:
        text = pc.utf8_lower(pa.scalar(text or "")).as_py()  # also letters beyond ASCII, as below for documents
        data = np.frombuffer(text.encode(), np.uint8)
        h = Words(data, np.array([0, len(data)]), _LETTER[data]).hashes() if len(data) else np.zeros(0, np.uint64)
        if len(h):
            kept.append((i, h, _question_words(text, len(h))))
    if not kept:
        return []
    n = len(kept)
    mean = sum(len(h) for _, h, _ in kept) / n
    every, df = np.unique(np.concatenate([np.unique(h) for _, h, _ in kept]), return_counts=True)
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    parts = []
    for a in range(0, n, PART_ITEMS):
        group = kept[a : a + PART_ITEMS]
        postings, threshold = [], np.zeros(len(group))
        for k, (_, h, _) in enumerate(group):
            t, tf = np.unique(h, return_counts=True)
            s = idf[np.searchsorted(every, t)] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(h) / mean))
            postings.append((t, np.full(len(t), k, np.int32), s.astype(np.float32)))
            # the score of the item's own best run that one passage is sure to hold
            at = np.searchsorted(t, h)
            best = max(s[np.unique(at[i : i + STRIDE])].sum() for i in range(0, max(1, len(h) - STRIDE + 1), 16))
            threshold[k] = share * best
        edges = np.arange(0, len(group), BLOCK)
        term, item, impact = (np.concatenate(x) for x in zip(*postings, strict=True))
        order = np.argsort(term, kind="stable")
        terms, first = np.unique(term[order], return_index=True)
        parts.append(Part(
            np.array([i for i, _, _ in group]), terms, np.append(first, len(term)), item[order], impact[order],
            np.maximum.reduceat(impact[order], first), threshold,
            np.minimum.reduceat(threshold, edges), [_part_grams(h[:q]) for _, h, q in group],
            [_part_grams(h[q:]) for _, h, q in group], np.array([len(h) for _, h, _ in group]),
        ))
    return parts


def _search(part: Part, w: Words, h: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """``(row, item, word from, word to, score)`` of all passages above their item's threshold."""
    at = np.minimum(np.searchsorted(part.terms, h), len(part.terms) - 1)
    known = np.flatnonzero(part.terms[at] == h)
    if not len(known):
        return []
    # passage k of a row covers its words [k * STRIDE, k * STRIDE + PASSAGE); every word lies in one or two of them
    first = w.first[w.row[known]]
    place = known - first
    n_row = w.first[w.row[known] + 1] - first
    k = place // STRIDE
    last = np.maximum(0, (n_row - 1) // STRIDE - (PASSAGE // STRIDE - 1))
    two = [(known, np.minimum(k, last)), (known[(k > 0) & (k <= last)], (k - 1)[(k > 0) & (k <= last)])]
    where, passage = (np.concatenate(x) for x in zip(*two, strict=True))
    # (row, passage, term) as one number, the term by its rank among those of the slice, so that 64 bits are enough
    used, rank = np.unique(at[where], return_inverse=True)
    t_bits, p_bits = (max(1, int(x).bit_length()) for x in (len(used), passage.max(initial=0)))
    if int(w.row[where].max()).bit_length() + p_bits + t_bits > 64:
        raise ValueError("a slice of text is too long to number its passages")
    t_bits, p_bits = np.uint64(t_bits), np.uint64(p_bits)
    pair = np.unique((((w.row[where].astype(np.uint64) << p_bits) | passage.astype(np.uint64)) << t_bits) | rank.astype(np.uint64))
    term = used[(pair & ((np.uint64(1) << t_bits) - np.uint64(1))).astype(np.int64)]
    key = pair >> t_bits
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    # WAND: the sum of the terms' maxima over all items bounds every score of the passage
    bound = np.add.reduceat(part.top[term], edge)
    live = bound >= part.threshold.min()
    if not live.any():
        return []
    size = np.diff(np.append(edge, len(term)))
    term, key = term[np.repeat(live, size)], key[edge[live]]
    edge = np.concatenate([[0], np.cumsum(size[live])[:-1]])
    used, term = np.unique(term, return_inverse=True)
    impact = part.dense(used)
    maxima = np.maximum.reduceat(impact, np.arange(0, len(part.ids), BLOCK), axis=1)
    blocks = np.add.reduceat(maxima[term], edge, axis=0) >= part.block_threshold - 1e-4
    stop = np.append(edge, len(term))
    out = []
    for p, b in np.argwhere(blocks):
        items = slice(b * BLOCK, (b + 1) * BLOCK)
        score = impact[term[stop[p] : stop[p + 1]], items].astype(np.float64).sum(0)
        for j in np.flatnonzero(score >= part.threshold[items] - 1e-6):
            row, kk = int(key[p] >> p_bits), int(key[p] & ((np.uint64(1) << p_bits) - np.uint64(1)))
            a = int(w.first[row]) + kk * STRIDE
            out.append((row, b * BLOCK + int(j), a, min(a + PASSAGE, int(w.first[row + 1])), float(score[j])))
    return out


SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def _index(benchmark: DataFrame, share: float):
    """The broadcast index of ``benchmark(item_id, text)``."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()
    if (size[0] or 0) > MAX_INDEX_BYTES:
        raise ValueError(f"the items have more than {MAX_INDEX_BYTES} bytes: search them in several calls")
    rows = benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select("item_id", "text").distinct().orderBy("item_id", "text").collect()
    return benchmark.sparkSession.sparkContext.broadcast(build_index([(r["item_id"], r["text"]) for r in rows], share))


def _found(index: list[Part], text: pa.Array, overlap: float) -> dict[tuple[int, int], tuple[float, float, float]]:
    """``(row, item_id)`` of the items that rows of a batch hold, with the best passage's figures."""
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    for base, _, data, offsets in slices(pc.utf8_lower(text)):
        w = Words(data, offsets, _LETTER[data])
        h = w.hashes()
        for part in index:
            for row, item, a, b, score in _search(part, w, h):
                reach = int(part.length[item])
                a, b = max(int(w.first[row]), a - reach), min(int(w.first[row + 1]), b + reach)
                q, r = _overlap(part.question[item], h[a:b]), _overlap(part.answer[item], h[a:b])
                if min(q, r) >= (overlap if reach >= 8 else 1.0):
                    key = (base + row, int(part.ids[item]))
                    found[key] = max(found.get(key, (0.0, 0.0, 0.0)), (score, q, r))
    return found


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, share: float = 0.6, overlap: float = 0.5) -> DataFrame:
    """Pairs of a document and a test item that it holds: one row for each, with the best passage's figures.

    ``docs(doc_id, text)`` against ``benchmark(item_id, text)``. An item's
    threshold is ``share`` of the BM25 score that its own words reach; of the
    three-word runs of its question and of its answer at least ``overlap`` have
    to stand around the passage (all of them for items under 8 words). Null and
    empty texts match nothing; equal documents or items match alike; items that
    share an id are found apart and reported by that id once; other
    columns are ignored; an empty table on either side gives an empty result.
    """
    index = _index(benchmark, share)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            rows = [(ids[i].as_py(), item, *v) for (i, item), v in sorted(_found(index.value, batch.column("text"), overlap).items())]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 2 else pa.float64()) for k, c in enumerate(cols)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, share: float = 0.6, overlap: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that hold no test item by :func:`find_leaks`, each judged by its own text, whatever its id. No shuffle."""
    index = _index(benchmark, share)

    def run(batches):
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[i for i, _ in _found(index.value, batch.column("_text"), overlap)]] = False
            yield pa.RecordBatch.from_arrays([batch.column("_row").filter(pa.array(clean))], names=["_row"])

    both = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text"))
    return both.mapInArrow(run, both.select("_row").schema).select("_row.*")


def op6_leaks(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
