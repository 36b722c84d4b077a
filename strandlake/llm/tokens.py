"""Token counts with overlap resynchronisation.

Texts of up to ``chunk`` characters are encoded whole. Longer ones are cut into
chunks that overlap; every chunk is encoded on its own, on any executor, and
reports the token boundaries in its overlaps. Two neighbours are spliced at a
boundary that both have and that is proven stable: in front of a word, at a
change from a non-space to a space, where no piece of the vocabulary can span.
Texts whose neighbours share none are encoded again with wider overlaps, at
last as a whole.
"""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table, text_or_empty

MARK = "▁"


@functools.cache
def _model(path: str):
    """The tokenizer of this Python worker, and whether a word start is stable in it.

    It is if no piece holds the word mark behind another character and normalising
    changes nothing; both are read off the model itself.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = map(model.id_to_piece, range(model.get_piece_size()))
    probe = "  AÉﬁ① 　x\n\n y  "
    same = model.normalize(probe).replace(MARK, " ").lstrip(" ") == probe.lstrip(" ")
    return model, same and not any(MARK in p.lstrip(MARK) for p in pieces)


def _boundaries(model, text: str) -> tuple[int, list[tuple[int, int]]]:
    """Number of tokens, and (place, tokens before it) of the stable boundaries.

    The first token carries the prefix that a tokenizer puts in front of any
    text, so only boundaries behind it count.
    """
    ids = model.encode(text)
    at, found = -1, []  # the prefix mark stands at -1
    for k, (i, piece) in enumerate(zip(ids, map(model.id_to_piece, ids), strict=True)):
        if model.is_byte(i):
            at += (int(piece[3:5], 16) & 0xC0) != 0x80
            continue
        if model.is_unknown(i):
            return len(ids), []
        if piece[0] == MARK and at > 0 and text[at] in " " + MARK and text[at - 1] not in " " + MARK:
            found.append((at, k))
        at += len(piece)
    return len(ids), found if at == len(text) else []


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _count_short(docs: DataFrame, model: str | None) -> DataFrame:
    def count(batches):
        encoder, _ = _model(model or default_model())
        for batch in batches:
            ids = encoder.encode(batch["text"].tolist(), num_threads=1)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": [len(x) for x in ids]})

    return docs.mapInPandas(count, "doc_id long, n_bytes long, n_tokens long")


def _count_chunks(texts: DataFrame, chunk: int, overlap: int, model: str | None) -> DataFrame:
    """Tokens of each text of ``(key, n, text)`` by splicing; null where two neighbours share no boundary."""
    last = F.greatest(F.ceil(F.col("n") / chunk) - 1, F.lit(0))
    rows = texts.select("key", "n", "text", last.alias("last"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("i"))
    start = F.greatest(F.col("i") * chunk - overlap, F.lit(0))
    rows = rows.select(
        "key", "i", "last", start.alias("start"),
        F.substring("text", (start + 1).cast("int"), ((F.col("i") + 1) * chunk + overlap - start).cast("int")).alias("text"),
    ).repartition("key", "i")

    def encode(batches):
        encoder, stable = _model(model or default_model())
        for batch in batches:
            out = []
            for key, i, last, start, text in batch.itertuples(index=False):
                n, found = _boundaries(encoder, text)
                found = [(start + at, k) for at, k in found] if stable else []
                left = [x for x in found if abs(x[0] - i * chunk) <= overlap]
                right = [x for x in found if abs(x[0] - (i + 1) * chunk) <= overlap]
                out.append((key, i, last, n, [x[0] for x in left], [x[1] for x in left], [x[0] for x in right], [x[1] for x in right]))
            yield pd.DataFrame(out, columns=["key", "i", "last", "n", "left_at", "left_k", "right_at", "right_k"])

    kind = "key string, i long, last long, n long, left_at array<long>, left_k array<long>, right_at array<long>, right_k array<long>"
    parts = rows.mapInPandas(encode, kind)
    by = Window.partitionBy("key").orderBy("i")
    parts = parts.withColumn("next_at", F.lead("left_at").over(by)).withColumn("next_k", F.lead("left_k").over(by))
    common = F.array_min(F.array_intersect("right_at", "next_at"))
    parts = parts.withColumn("cut", common)
    at = lambda where, what: F.element_at(what, F.array_position(where, F.col("cut")).cast("int"))
    parts = parts.withColumn("stop", F.when(F.col("i") == F.col("last"), F.col("n")).when(F.col("cut").isNotNull(), at("right_at", "right_k")))
    parts = parts.withColumn("begin", F.when(F.col("cut").isNotNull(), at("next_at", "next_k")))
    parts = parts.withColumn("begin", F.when(F.col("i") == 0, F.lit(0)).otherwise(F.lag("begin").over(by)))
    whole = F.count("*") == F.count(F.col("stop") - F.col("begin"))
    return parts.groupBy("key").agg(F.when(whole, F.sum(F.col("stop") - F.col("begin"))).alias("n_tokens"))


def count_tokens(docs: DataFrame, *, model: str | None = None, chunk: int = 32_768, overlap: int = 512, limit: int = 4096) -> DataFrame:
    """Token counts of ``docs(doc_id, text)``: ``doc_id, n_bytes, n_tokens, over_limit``.

    One row for each row. Null text is empty: no bytes, no tokens. Equal rows
    give equal rows, other columns are ignored, an empty table gives an empty
    table. ``model`` is the path of a sentencepiece model; the default is looked
    up by each worker. Counts equal those of the whole texts.
    """
    if not 0 < 2 * overlap < chunk:
        raise ValueError("an overlap has to be shorter than half a chunk")
    text = text_or_empty("text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.length(text).cast("long").alias("n"), F.octet_length(text).cast("long").alias("n_bytes"))
    short = _count_short(docs.where(F.col("n") <= chunk).select("doc_id", "n_bytes", "text"), model)
    # equal texts share a key, so each is encoded once
    key = F.concat_ws("-", F.sha2("text", 256), F.col("n_bytes").cast("string"))
    long = docs.where(F.col("n") > chunk).withColumn("key", key)
    texts = long.dropDuplicates(["key"]).select("key", "n", "text")
    longest = long.agg(F.max("n")).first()[0]
    counted = None
    while longest is not None:
        part = stored(_count_chunks(texts, chunk, overlap, model), "tokens")
        done = part.where("n_tokens IS NOT NULL")
        counted = done if counted is None else counted.union(done)
        open_ = part.where("n_tokens IS NULL").select("key")
        if chunk >= longest or open_.isEmpty():
            break
        texts, chunk, overlap = texts.join(open_, "key", "left_semi"), chunk * 8, overlap * 8
    if counted is not None:
        short = short.union(long.select("doc_id", "n_bytes", "key").join(counted, "key").select("doc_id", "n_bytes", "n_tokens"))
    return short.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_tokens(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
