"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon has two parts: a short list of English insults, and the words and
word beginnings (as hashes) that the labelled training rows show to be toxic,
so stems in any language are learned. Features are densities and rates over
whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table
from .quality import held_out
from .textstats import LOWER, Words, mix, slices, sums, word_hash

#: Bounds on what is fitted on, and on the lexicon that goes to every task. A token has to stand in half a percent of the toxic
#: texts of the sample, at least 4; a toxic text of usual length lets a few thousand tokens pass that, so 4,096 hardly ever cut.
MAX_TRAIN, MAX_LEXICON = 20_000, 4096
PREFIXES = (4, 5, 6, 7)
SEEDS = (
    "idiot idiots moron morons stupid loser losers pathetic worthless trash scum clown disgusting dumb imbecile garbage filth vermin scumbag "
    "bastard dumbass retard"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros"
).split()
FEATURES = (
    "log_words seed_hits seed_density learned_hits learned_density learned_weight near_you you_density capitals shouted exclaims questions "
    "punctuation obfuscated"
).split()
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = ~_LETTER & (np.arange(256) > 32)
_DISGUISE = np.zeros(256, bool)
_DISGUISE[list(b"@$*#!_.-+^")] = True


def _tokens(w: Words) -> list[np.ndarray]:
    """Hashes of whole words and of their beginnings; a word as short as its beginning has none (0)."""
    size = w.ends - w.starts
    found = [w.hashes()]
    for n in PREFIXES:
        h = mix(w.hashes(n) ^ np.uint64(0xA5A5_0000 + n))
        found.append(np.where(size > n, h, np.uint64(0)))
    return found


def _distinct_tokens(batches):
    for batch in batches:
        y = np.asarray(batch.column("y").to_pylist(), np.int64)
        for a, b, data, offsets in slices(batch.column("text")):
            w = Words(data, offsets, _LETTER[data])
            h = np.concatenate(_tokens(w))
            row = np.tile(w.row, 1 + len(PREFIXES))
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            keep = h != 0
            keep[1:] &= (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(y[a:b][row[keep]])], names=["token", "y"])


def learn_lexicon(train: DataFrame, n_toxic: int, n_clean: int, *, least_g2: float = 20.0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights (log odds) of tokens that mark toxic texts of ``train(text, y)``.

    A token has to be in at least 4 and half a percent of the toxic texts,
    nine times in ten in a toxic one, with a log-likelihood ratio of
    ``least_g2``. The strongest :data:`MAX_LEXICON` stay.
    """
    if not n_toxic or not n_clean:
        return np.zeros(0, np.uint64), np.zeros(0)
    base = n_toxic / (n_toxic + n_clean)
    counts = train.mapInArrow(_distinct_tokens, "token long, y long").groupBy("token").agg(F.sum("y").alias("a"), F.count("*").alias("n"))
    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    g2 = 2 * (a * F.log(a / (n * base)) + F.when(n > a, (n - a) * F.log((n - a) / (n * (1 - base)))).otherwise(0.0))
    best = (
        counts.where((a >= max(4.0, 0.005 * n_toxic)) & (a >= 0.9 * n))
        .withColumn("g2", g2)
        .where(F.col("g2") >= least_g2)
        .select("token", F.log((a + 0.5) / (n - a + 0.5)).alias("weight"), "g2")
        .orderBy(F.desc("g2"), "token")
        .limit(MAX_LEXICON)
        .collect()
    )
    token = np.array([r["token"] for r in best], np.int64).view(np.uint64)
    weight = np.array([r["weight"] for r in best], float)
    order = np.argsort(token)
    return token[order], weight[order]


def _lookup(h: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(keys) or not len(h):
        return np.zeros(len(h))
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, values[at], 0.0)


def features(text: pa.Array, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Dense features of whole texts, a row each; an empty text has zeros."""
    seeds, you = (np.sort(np.array([word_hash(x) for x in words], np.uint64)) for words in (SEEDS, SECOND_PERSON))
    out = np.zeros((len(text), len(FEATURES)))
    for a, b, data, offsets in slices(text):
        w = Words(data, offsets, _LETTER[data])
        tokens = _tokens(w)
        n = np.maximum(w.per_row(np.ones(len(w.starts))), 1)
        n_bytes = np.maximum(np.diff(offsets), 1)
        seed = _lookup(tokens[0], seeds, np.ones(len(seeds)))
        weight = np.max([_lookup(t, *lexicon) for t in tokens], axis=0) if len(w.starts) else np.zeros(0)
        hit = (weight > 0) | (seed > 0)
        person = _lookup(tokens[0], you, np.ones(len(you)))
        # hits within six words of a second person, in the same text
        c = np.concatenate([[0.0], np.cumsum(person)])
        at = np.arange(len(hit))
        lo, hi = np.maximum(at - 6, w.first[w.row]), np.minimum(at + 7, w.first[w.row + 1])
        near = hit & (c[hi] > c[lo])
        inner = np.zeros(len(data), bool)
        if len(data) > 2:
            inner[1:-1] = (_DISGUISE | _DIGIT)[data[1:-1]] & (LOWER[data[:-2]] >= 97) & _LETTER[data[:-2]] & (LOWER[data[2:]] >= 97) & _LETTER[data[2:]]
        size = w.ends - w.starts
        upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
        shouted = (size > 2) & (upper[w.ends] - upper[w.starts] == size)
        count = lambda flags: sums(flags[data], offsets)  # noqa: E731, B023
        letters = np.maximum(count(_LETTER), 1)
        out[a:b] = np.column_stack([
            np.log1p(w.per_row(np.ones(len(w.starts)))), np.log1p(w.per_row(seed)), 1000 * w.per_row(seed) / n,
            np.log1p(w.per_row(weight > 0)), 1000 * w.per_row(weight > 0) / n, w.per_row(weight) / np.sqrt(n),
            np.log1p(w.per_row(near)), 1000 * w.per_row(person) / n, count(_UPPER) / letters, w.per_row(shouted) / n,
            1000 * sums(data == 33, offsets) / n_bytes, 1000 * sums(data == 63, offsets) / n_bytes, count(_PUNCT) / n_bytes,
            1000 * sums(inner, offsets) / n_bytes,
        ])
    return out


def document_features(docs: DataFrame, lexicon: tuple[np.ndarray, np.ndarray], carry: list[str]) -> DataFrame:
    """``_row, x``: the columns ``carry`` of each row as a struct, and its features."""

    def run(batches):
        for batch in batches:
            x = features(batch.column("_text"), lexicon)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), lists], names=["_row", "x"])

    both = docs.select(F.struct(*carry).alias("_row"), F.col("text").alias("_text"))
    return both.mapInArrow(run, T.StructType([both.schema["_row"], T.StructField("x", T.ArrayType(T.DoubleType()))]))


def _scored(
    docs: DataFrame, labels: DataFrame, carry: list[str], *, threshold: float = 0.7, max_train: int = MAX_TRAIN, trees: int = 20, depth: int = 3, seed: int = 7
) -> DataFrame:
    """``_row, score, predicted`` for each row of ``docs``."""
    spark = docs.sparkSession
    y = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.round(F.avg("toxic")).cast("long").alias("y"))
    y = y.where(~held_out(3, 1, True))
    share = min(1.0, max_train / max(1, y.count()))
    # about max_train ids, so small enough to be sent to every task
    y = F.broadcast(y.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)))
    train = docs.select("doc_id", "text").where("text IS NOT NULL").join(y, "doc_id")
    train = train.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.round(F.avg("y")).cast("long").alias("y"))
    train = stored(train.withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(4))), "toxic-train")
    n = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    fitted = train.where("part > 0")
    m = {r["y"]: r["count"] for r in fitted.groupBy("y").count().collect()}
    # the lexicon is learned where the trees are, so the calibration sees features that don't know its labels
    lexicon = learn_lexicon(fitted, m.get(1, 0), m.get(0, 0))
    if min(m.get(1, 0), m.get(0, 0)) < 8:
        constant = n.get(1, 0) / max(1, sum(n.values()))
        return docs.select(F.struct(*carry).alias("_row"), F.lit(float(constant)).alias("score"), F.lit(int(constant >= threshold)).alias("predicted"))
    known = document_features(train, lexicon, ["part", "y"])
    known = stored(known.select("_row.part", F.col("_row.y").cast("double").alias("label"), "x"), "toxic-known").repartition(max(2, spark.sparkContext.defaultParallelism))
    known = known.withColumn("features", array_to_vector("x")).cache()
    boost = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed, minInstancesPerNode=4)
    model = boost.fit(known.where("part > 0"))
    margin = lambda df: model.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])
    judged = margin(known.where("part = 0")).select("margin", "label")
    both = judged.select("label").distinct().count() == 2
    curve = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="calibrated").fit(judged) if both else None
    known.unpersist()
    scored = margin(document_features(docs, lexicon, carry).select("_row", array_to_vector("x").alias("features")))
    soft = 1 / (1 + F.exp(-2 * F.col("margin")))
    if curve:
        # the calibrated value; a millionth of the margin only orders rows on one step of the curve
        ordered = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated") + 1e-6 * (soft - 0.5)))
        scored = curve.transform(scored.select("_row", "margin")).withColumn("score", ordered)
    else:
        scored = scored.withColumn("score", soft)
    return scored.select("_row", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def score_toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, held_out, score, predicted``.

    Learns from ``labels(doc_id, toxic)`` of 0 or 1 whose row isn't held out,
    from about ``max_train`` of them at most (a share by hash of the id). Equal
    texts are learned from once, with the mean of their labels. Three quarters
    fit the lexicon and the trees, the others the isotonic calibration, whose
    value is the score. Null or empty texts score as empty ones; null doc_ids
    are scored, never learned from; several labels of a document count by
    their mean; without enough labels of both classes the score is the share
    of label 1 (0 without any). Other columns are ignored; an empty table gives
    an empty table.
    """
    out = _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, ["doc_id"], **options)
    return out.select("_row.doc_id", "score", "predicted").select("doc_id", held_out(3, 1, True).alias("held_out"), "score", "predicted")


def reject_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`score_toxicity` doesn't reject, each judged by its own text, whatever its id."""
    return _scored(docs, labels, docs.columns, **options).where("predicted = 0").select("_row.*")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
