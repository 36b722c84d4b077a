"""URL filters: listed rules first, then association rules mined from what those decide.

The pages that a listed rule decides are labelled. FP-growth finds the sets of
URL tokens that are frequent among them together with a verdict; of the
association rules that follow, those stay that have enough support and confidence, and more
confidence than every shorter rule that they contain. A page without a listed
rule takes the verdict of its best matching mined rule. Rules are found by an
inverted index: each is posted under its rarest token only, and what the index
finds is then compared whole.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import MAX_IDS, stored, table

#: ``(host, path, verdict)``
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Least share of the labelled pages that a token set has to stand in, and least share of those with the rule's verdict.
SUPPORT, CONFIDENCE = 0.005, 0.8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")


def host_and_path(pages: DataFrame) -> DataFrame:
    """``pages(url, …)`` with the columns ``host`` and ``path``, replaced if they are there; both empty for null and for URLs without ``://``."""
    pages = pages.withColumn("_rest", F.coalesce(_rest(F.col("url")), F.lit("")))
    host = _lower(F.regexp_extract("_rest", r"^[^/?#]*", 0))
    return pages.withColumn("host", host).withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)).drop("_rest")


def listed_rule(rules: list[tuple[str, str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits ``host`` and ``path``, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for host, path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens() -> Column:
    """Distinct tokens of the columns ``url, host, path``: scheme, words of the host, of the path and of the query's keys, whether it has a fragment.

    Digits count as one digit, so numbers don't make tokens of their own.
    """
    url, plain = F.col("url"), lambda c: F.regexp_replace(_lower(F.col(c)), r"\p{N}+", "0")
    words = lambda c, mark: F.transform(F.filter(F.split(plain(c), r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.concat(F.lit(mark), w))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query:"), _lower(F.substring_index(x, "=", 1))))
    scheme = F.array(F.concat(F.lit("scheme:"), _lower(F.substring_index(url, "://", 1))))
    fragment = F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(scheme, words("host", "host:"), words("path", "path:"), keys, fragment)))


def alike_tokens(labelled: DataFrame, *, support: float = SUPPORT) -> dict[str, str]:
    """The tokens of ``labelled(tokens, verdict)`` that a rule can have, each with the token that stands for it in mining.

    All tokens take part that stand in a share ``support`` of the rows, but for those
    that stand in every row, which no rule has, as it would be no surer than without them.
    Tokens that stand in the very same rows make rules of equal support and confidence,
    and two of them in one rule make it no surer than one: the first by name stands for them all, so that
    a long URL that comes again and again is one item, not all sets of its tokens. Equal
    rows are told by 64-bit hashes. A number of tokens that the mean length of a URL over ``support`` bounds comes to the driver.
    """
    one = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("_n")).otherwise(0))
    sets = stored(labelled.groupBy("tokens", "verdict").agg(F.count("*").alias("_n")), "token-sets")
    n, blocked = sets.agg(F.sum("_n"), one("block")).first()
    if not n or blocked in (0, n):
        return {}
    seen = sets.select(F.explode("tokens").alias("token"), "_n", F.xxhash64("tokens").alias("_set"), "verdict")
    seen = seen.groupBy("token").agg(F.sum("_n").alias("n"), F.bit_xor(F.xxhash64("_set", "verdict")).alias("rows"))
    seen = seen.where((F.col("n") >= support * n) & (F.col("n") < n))
    alike = seen.withColumn("item", F.min("token").over(Window.partitionBy("n", "rows")))
    return {r["token"]: r["item"] for r in alike.select("token", "item").orderBy("token").collect()}


def telling_tokens(labelled: DataFrame, *, support: float = SUPPORT) -> list[str]:
    """All tokens of ``labelled(tokens, verdict)`` that a rule can have; counted over all rows."""
    return sorted(alike_tokens(labelled, support=support))


def items_of(alike: dict[str, str]) -> Column:
    """The items of the column ``tokens``, sorted: each token of ``alike`` by the one that stands for it."""
    if not alike:
        return F.array().cast("array<string>")
    known = F.filter("tokens", lambda t: t.isin(list(alike)))
    other = {t: item for t, item in alike.items() if t != item}
    if other:
        stand_in = F.map_from_arrays(F.array(*map(F.lit, other)), F.array(*map(F.lit, other.values())))
        known = F.array_distinct(F.transform(known, lambda t: F.coalesce(F.try_element_at(stand_in, t), t)))
    return F.array_sort(known)


def mined_rules(labelled: DataFrame, *, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """``antecedent, verdict, confidence, support`` of the association rules of ``labelled(items, verdict)``.

    ``items`` are distinct tokens. A rule stays if its sides stand together in a
    share ``support`` of the rows, if ``confidence`` of the rows with its tokens have its verdict,
    and if this share is above that of every rule with one token less (without any
    token: the verdict's share of all rows).
    """
    spark = labelled.sparkSession
    none = "antecedent array<string>, verdict string, confidence double, support double"
    n = labelled.count()
    if not n:
        return spark.createDataFrame([], none)
    said = F.concat(F.lit("="), F.col("verdict"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=0.0).fit(labelled.select(F.concat("items", F.array(said)).alias("items")))
    rules = model.associationRules.select(F.array_sort("antecedent").alias("antecedent"), F.col("consequent")[0].alias("said"), "confidence", "support")
    rules = rules.where(F.startswith("said", F.lit("=")))
    rules = rules.select("antecedent", F.substring("said", 2, 1 << 20).alias("verdict"), "confidence", "support")
    base = labelled.groupBy("verdict").agg((F.count("*") / n).alias("confidence")).select(F.array().cast("array<string>").alias("antecedent"), "verdict", "confidence", F.lit(1.0).alias("support"))
    rules = stored(rules, "rules")
    shorter = rules.union(base).select(F.col("antecedent").alias("part"), "verdict", F.col("confidence").alias("lower"))
    parts = rules.select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("x"))
    parts = parts.select("antecedent", "verdict", "confidence", F.array_remove("antecedent", F.col("x")).alias("part"))
    weak = parts.join(shorter, ["part", "verdict"]).where("lower >= confidence").select("antecedent", "verdict").distinct()
    return rules.where(F.col("confidence") >= confidence).join(weak, ["antecedent", "verdict"], "left_anti")


def matched(sets: DataFrame, rules: DataFrame, often: list[str]) -> DataFrame:
    """``items, verdict`` for those of the distinct ``sets(items)`` that hold a rule's tokens, by the rule that comes first.

    Rules come by confidence, support and length, block before allow. A rule is
    posted under that of its tokens which stands last in ``often``.
    """
    at = F.array(*[F.lit(t) for t in often]) if often else F.array().cast("array<string>")
    rarest = F.array_max(F.transform("antecedent", lambda t: F.array_position(at, t)))
    postings = rules.select(F.get(at, (rarest - 1).cast("int")).alias("token"), "antecedent", "verdict", "confidence", "support")
    postings = stored(postings, "postings")
    postings = F.broadcast(postings) if postings.limit(MAX_IDS // 10 + 1).count() <= MAX_IDS // 10 else postings
    found = sets.select("items", F.explode("items").alias("token")).join(postings, "token").where(F.size(F.array_except("antecedent", "items")) == 0)
    first = F.max_by("verdict", F.struct("confidence", "support", F.size("antecedent"), "verdict"))
    return found.groupBy("items").agg(first.alias("found"))


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, *, support: float = SUPPORT, confidence: float = CONFIDENCE, default: str = "allow"
) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, mined`` for each row of ``pages(page_id, url)``.

    ``rule`` is the longest listed rule that fits, else null; ``mined`` tells whether
    a mined rule gave the verdict. What neither decides gets ``default``, as do all
    pages without a listed rule if the listed ones decide nothing or all alike.
    A null or broken URL has an empty host and path and fits no rule. Ids may be null
    or repeated; other columns are ignored; an empty table gives an empty table.
    """
    p = host_and_path(pages.select("page_id", "url")).withColumn("_listed", listed_rule(rules)).withColumn("tokens", tokens())
    p = p.select("page_id", "url", "host", "path", F.col("_listed.rule").alias("rule"), F.col("_listed.verdict").alias("verdict"), "tokens")
    labelled = p.where("verdict IS NOT NULL").select("tokens", "verdict")
    alike = alike_tokens(labelled, support=support)
    p = stored(p.withColumn("items", items_of(alike)).drop("tokens"), "urls")
    mined = mined_rules(p.where("verdict IS NOT NULL").select("items", "verdict"), support=support, confidence=confidence)
    number = p.where("verdict IS NULL").select(F.explode("items").alias("t")).groupBy("t").count().collect()  # a row for each item
    count = {r["t"]: r["count"] for r in number}
    often = sorted(set(alike.values()), key=lambda t: (-count.get(t, 0), t))
    found = stored(matched(p.where("verdict IS NULL").select("items").distinct(), mined, often), "verdicts")
    found = F.broadcast(found) if found.limit(MAX_IDS // 10 + 1).count() <= MAX_IDS // 10 else found
    out = p.join(found, "items", "left")
    open_ = F.col("verdict").isNull()
    return out.select("page_id", "url", "host", "path", "rule", F.coalesce("verdict", "found", F.lit(default)).alias("verdict"), (open_ & F.col("found").isNotNull()).alias("mined"))


def op11_urls(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).drop("url")
