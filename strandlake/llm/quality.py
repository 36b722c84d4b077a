"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .textstats import Words, slices, sums

STATISTICS = (
    "log_words word_length upper digits stops marks symbols pipes exclaims wide lines short_words distinct_words repeated_neighbours".split()
)


def _flags(codes: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes.encode())] = True
    return out


UPPER, DIGIT, STOP = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("0123456789"), _flags(".?;:")
MARK, SYMBOL, PIPE, EXCLAIM, LINE = _flags(",'\"()-"), _flags("#$%&*+/<=>@[\\]^_`{}~"), _flags("|"), _flags("!"), _flags("\n")
WIDE = np.arange(256) >= 128


def statistics(text: pa.Array) -> np.ndarray:
    """The transformed statistics of whole texts, a row each; empty texts have a row too."""
    out = np.zeros((len(text), len(STATISTICS)))
    for a, b, data, offsets in slices(text):
        w = Words(data, offsets)
        n_bytes = np.diff(offsets)
        n = w.per_row(np.ones(len(w.starts), np.int64))
        size = w.ends - w.starts
        h = w.hashes()
        # distinct words of a row: sort by row and hash
        order = np.lexsort((h, w.row))
        new = np.ones(len(h), np.int64)
        if len(h):
            hs, rs = h[order], w.row[order]
            new[1:] = (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])
        again = np.zeros(len(h), np.int64)
        again[1:] = (h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1])
        rate = lambda flags: np.log((sums(flags[data], offsets) + 0.5) / (n_bytes + 20.0))  # noqa: E731, B023
        share = lambda x: np.log((x + 0.5) / (n - x + 0.5))  # noqa: E731, B023
        out[a:b] = np.column_stack([
            np.log1p(n), np.log1p(w.per_row(size) / np.maximum(n, 1)), rate(UPPER), rate(DIGIT), rate(STOP), rate(MARK), rate(SYMBOL),
            rate(PIPE), rate(EXCLAIM), rate(WIDE), rate(LINE), share(w.per_row((size <= 3).astype(np.int64))), share(w.per_row(new)), share(w.per_row(again)),
        ])
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            x = statistics(batch.column("text"))
            flat = pa.array(x.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(STATISTICS), dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), lists], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


class Discriminant:
    """Class means and the inverse Cholesky factors of shrunk class covariances."""

    def __init__(self, sums_by_class: dict[int, tuple[float, np.ndarray, np.ndarray]], *, shrink: float = 0.15, ridge: float = 1e-2, temper: float = 0.2):
        self.temper, self.parts, d = temper, {}, len(STATISTICS)
        total = sum(s[0] for s in sums_by_class.values())
        self.constant = 0.5
        if len(sums_by_class) == 2 and min(s[0] for s in sums_by_class.values()) >= 2:
            cov = {}
            for c, (n, first, second) in sums_by_class.items():
                mean = first / n
                cov[c] = (n, mean, second / n - np.outer(mean, mean))
            pooled = sum(n * s for n, _, s in cov.values()) / total
            for c, (n, mean, s) in cov.items():
                # little data: more of the pooled matrix; always some of the diagonal
                own = n / (n + 2.0 * d)
                s = own * s + (1 - own) * pooled
                s = (1 - shrink) * s + shrink * np.diag(np.diag(s)) + ridge * np.eye(d)
                factor = np.linalg.cholesky(s)
                self.parts[c] = (mean, np.linalg.inv(factor), np.log(n / total) - np.log(np.diag(factor)).sum())
        elif sums_by_class:
            self.constant = float(np.clip(sum(c * s[0] for c, s in sums_by_class.items()) / total, 0.01, 0.99))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.parts:
            return np.full(len(x), self.constant)
        log = {c: k - 0.5 * np.square((x - mean) @ inv.T).sum(1) for c, (mean, inv, k) in self.parts.items()}
        return 1 / (1 + np.exp(-np.clip(self.temper * (log[1] - log[0]), -35, 35)))


def fit(train: DataFrame, **options) -> Discriminant:
    """From ``train(x, y)``: one aggregation of counts, sums and products for each class.

    Rows with equal statistics and label count once, so a group of thousands of
    copies weighs no more than one text.
    """
    d = len(STATISTICS)
    one = train.groupBy("y", "x").agg(F.count("*").alias("copies"))
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    got = one.groupBy("y").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(d)]).alias("first"),
        F.array(*[F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in pairs]).alias("second"),
    )
    by_class = {}
    for r in got.collect():  # two rows
        m = np.zeros((d, d))
        for (i, j), v in zip(pairs, r["second"], strict=True):
            m[i, j] = m[j, i] = v
        by_class[int(r["y"])] = (float(r["n"]), np.array(r["first"]), m)
    return Discriminant(by_class, **options)


def held_out(mod: int, rest: int, equal: bool):
    is_rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod == rest
    return is_rest if equal else ~is_rest


def score_quality(docs: DataFrame, labels: DataFrame, *, folds: int = 5, threshold: float = 0.3, **options) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, held_out, score, predicted``.

    Learns from ``labels(doc_id, quality)`` of 0 or 1 whose row isn't held out.
    Null or empty texts are scored by the statistics of an empty text; null
    doc_ids are scored and never learned from; several labels of a document
    count by their mean; without labels of both classes the score is the share
    of label 1 (0.5 without any). Other columns are ignored.
    """
    x = stored(document_statistics(docs), "statistics")
    y = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.round(F.avg("quality")).cast("int").alias("y"))
    model = fit(x.join(y, "doc_id").where(~held_out(folds, 0, True)).select("x", "y"), **options)

    def run(batches):
        for batch in batches:
            m = np.array(batch["x"].tolist(), float).reshape(len(batch), len(STATISTICS))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.score(m)})

    scored = x.mapInPandas(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(folds, 0, True).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op5_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
