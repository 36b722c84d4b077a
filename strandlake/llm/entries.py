"""The queries of this package and their SQL, for the entry module at the top."""

from __future__ import annotations

from . import audit, decontaminate, embeddings, lines, mixing, negatives, ngram_join, quality, secrets, tokens, toxicity, urls, warc


def queries() -> dict:
    return {
        "op1_secrets": secrets.op1_secrets,
        "op2_line_dedup": lines.op2_line_dedup,
        "op3_embeddings": embeddings.op3_embeddings,
        "op4_tokens": tokens.op4_tokens,
        "op5_quality": quality.op5_quality,
        "op6_leaks": decontaminate.op6_leaks,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_mix": mixing.op8_mix,
        "op9_jaccard": ngram_join.op9_jaccard,
        "op10_warc": warc.op10_warc,
        "op11_urls": urls.op11_urls,
        "op12_negatives": negatives.op12_negatives,
        "op13_audit": audit.op13_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_warc": warc.oracle(), "op12_negatives": negatives.oracle(), "op13_audit": audit.oracle()}
