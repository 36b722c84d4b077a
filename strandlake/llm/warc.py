"""WARC derivatives: metadata and plain-text conversion records of responses.

All of it is DataFrame expressions: one pass over the responses, no shuffle.
The same expressions, as text, make the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, text_or_empty

CRLF = "\r\n"

#: (pattern, replacement) in order; the syntax is common to Java and RE2. What isn't closed reaches to the end.
TO_TEXT = (
    (r"(?s)<!--.*?(?:-->|\z)", " "),
    (r"(?is)<script(?:[ \t\r\n][^>]*)?>.*?(?:</script[ \t\r\n]*>|\z)", " "),
    (r"(?is)<style(?:[ \t\r\n][^>]*)?>.*?(?:</style[ \t\r\n]*>|\z)", " "),
    (
        r"(?i)</?(?:p|div|br|h[1-6]|li|ul|ol|table|tr|article|section|header|footer|nav|aside|main|blockquote|pre|hr|title)"
        r"(?:[ \t\r\n/][^>]*)?>",
        "\n",
    ),
    (r"<[/!?]?[A-Za-z][^>]*>", ""),
    (r"[ \t\r\x{0B}\x{0C}\x{A0}]*\n[ \t\r\n\x{0B}\x{0C}\x{A0}]*", "\n"),
    (r"[ \t\r\x{0B}\x{0C}\x{A0}]+", " "),
    (r"^[ \n]+|[ \n]+$", ""),
)
#: Named entities; the ampersand last, so that nothing is decoded twice. Fixed values.
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&hellip;", "…"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&laquo;", "«"),
    ("&raquo;", "»"),
    ("&amp;", "&"),
)
TITLE = r"(?is)<title(?:[ \t\r\n][^>]*)?>(.*?)</title"
LANG = r"(?i)<html[^>]*[ \t\r\n]lang=[\"']?([A-Za-z-]+)"
LINK = r"(?i)<a[ \t\r\n][^>]*href="
DATE = "1970-01-01T00:00:00Z"
#: What follows "&#" in a numeric reference: decimal or hexadecimal digits and a semicolon.
DECIMAL = r"^0*([0-9]{1,7});"
HEX = r"^[xX]0*([0-9A-Fa-f]{1,6});"
#: HTTP headers: folded lines are one, ends are trimmed, each line after the first is a header.
HEADERS = ((r"\r?\n[ \t]+", " "), (r"[\r\n]+$", ""), (r"\r?\n", f"{CRLF}source-header-"))


def _uuid(value):
    h = F.md5(value)
    part = lambda a, n: F.substring(h, a, n)
    # version 8, variant 10: an id made from a hash of the writer's choice
    parts = [part(1, 8), part(9, 4), F.concat(F.lit("8"), part(14, 3)), F.concat(F.lit("a"), part(18, 3)), part(21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _char(n):
    """The character of a code point; what is none is U+FFFD. An ampersand stays coded, as named entities are decoded later."""
    known = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
    return (
        F.when(n == 38, F.lit("&amp;"))
        .when(known, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        .otherwise(F.lit("\ufffd"))
    )


def _numeric(text):
    """``text`` with its numeric character references decoded."""

    def one(p, i):
        dec = F.regexp_extract(p, DECIMAL, 1)
        hexa = F.regexp_extract(p, HEX, 1)
        return (
            F.when(i == 0, p)
            .when(dec != "", F.concat(_char(dec.cast("long")), F.regexp_replace(p, DECIMAL, "")))
            .when(hexa != "", F.concat(_char(F.conv(hexa, 16, 10).cast("long")), F.regexp_replace(p, HEX, "")))
            .otherwise(F.concat(F.lit("&#"), p))
        )

    return F.array_join(F.transform(F.split(text, "&#"), one), "")


def html_to_text(html):
    for pattern, to in TO_TEXT[:5]:
        html = F.regexp_replace(html, pattern, to)
    html = _numeric(html)
    for name, to in ENTITIES:
        html = F.replace(html, F.lit(name), F.lit(to))
    for pattern, to in TO_TEXT[5:]:
        html = F.regexp_replace(html, pattern, to)
    return html


def responses_from_pages(pages: DataFrame, *, date: str = DATE) -> DataFrame:
    """Response records of a table ``(page_id, url, html)``.

    Null html is an empty payload, a null url an empty target. A record's id
    depends on the row alone, so reruns agree and equal rows share their id.
    """
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    url, html = text_or_empty("url"), text_or_empty("html")
    digest = F.sha2(html, 256)
    return pages.select(
        "page_id",
        url.alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(html)).alias("http_headers"),
        html.alias("payload"),
        digest.alias("payload_sha256"),
    ).withColumn("record_id", _uuid(F.concat_ws("|", F.lit("response"), page, "target_uri", "payload_sha256")))


def derivatives(responses: DataFrame, *, keep=("page_id",)) -> DataFrame:
    """Two records for each response: ``metadata`` and ``conversion``.

    ``responses`` has ``record_id, target_uri, warc_date, http_headers,
    payload, payload_sha256``; other columns stay out but for ``keep``. Both
    records carry the response's id in ``refers_to``, its target, date, HTTP
    status line, content type and whole HTTP headers, and the digest of its
    payload; each has its own id, block, block digest and length in bytes, and
    the id of the other one in ``concurrent_to``. The metadata block has a field
    for the status and for each source header. An empty payload has an empty
    conversion; an empty table gives an empty table. Nulls count as empty text.
    """
    r = responses.select(
        *keep,
        F.col("record_id").alias("refers_to"),
        *[text_or_empty(c).alias(c) for c in ("target_uri", "warc_date", "http_headers", "payload", "payload_sha256")],
    )
    r = r.withColumn("text", html_to_text(F.col("payload")))
    r = r.withColumn("source_status", F.regexp_extract("http_headers", r"^([^\r\n]*)", 1))
    r = r.withColumn("source_type", F.regexp_extract("http_headers", r"(?i)content-type:[ ]*([^\r\n]*)", 1))
    source = F.col("http_headers")
    for pattern, to in HEADERS:
        source = F.regexp_replace(source, pattern, to)
    title = F.regexp_replace(F.regexp_extract("payload", TITLE, 1), r"[ \t\r\n]+", " ")
    r = r.withColumn(
        "fields",
        F.concat(
            F.lit("title: "), title, F.lit(f"{CRLF}language: "), F.regexp_extract("payload", LANG, 1),
            F.lit(f"{CRLF}outlinks: "), F.regexp_count("payload", F.lit(LINK)).cast("string"),
            F.lit(f"{CRLF}text-length: "), F.length("text").cast("string"),
            F.lit(f"{CRLF}source-status: "), source, F.lit(CRLF),
        ),
    )
    r = r.withColumn("metadata_id", _uuid(F.concat_ws("|", F.lit("metadata"), "refers_to")))
    r = r.withColumn("conversion_id", _uuid(F.concat_ws("|", F.lit("conversion"), "refers_to")))

    def record(kind, own, other, content, block):
        return F.struct(
            F.lit(kind).alias("warc_type"), F.col(own).alias("record_id"), F.col(other).alias("concurrent_to"),
            F.lit(content).alias("content_type"), F.col(block).alias("block"),
        )

    both = F.array(
        record("metadata", "metadata_id", "conversion_id", "application/warc-fields", "fields"),
        record("conversion", "conversion_id", "metadata_id", "text/plain; charset=utf-8", "text"),
    )
    r = r.select(
        *keep, "refers_to", "target_uri", "warc_date", "source_status", "source_type",
        F.col("http_headers").alias("source_headers"), "payload_sha256", F.inline(both)
    )
    return r.select(
        *keep, "warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "warc_date", "source_status", "source_type", "source_headers",
        F.concat(F.lit("sha256:"), "payload_sha256").alias("source_payload_digest"),
        "content_type",
        F.octet_length("block").cast("long").alias("content_length"),
        F.concat(F.lit("sha256:"), F.sha2("block", 256)).alias("block_digest"),
        "block",
    )


def serialised(records: DataFrame) -> DataFrame:
    """One string ``record`` for each record: version, named headers, empty line, block."""
    header = lambda name, col: F.concat(F.lit(f"{name}: "), F.col(col), F.lit(CRLF))
    return records.select(
        F.concat(
            F.lit(f"WARC/1.1{CRLF}"),
            header("WARC-Type", "warc_type"), header("WARC-Record-ID", "record_id"), header("WARC-Refers-To", "refers_to"),
            header("WARC-Concurrent-To", "concurrent_to"), header("WARC-Target-URI", "target_uri"), header("WARC-Date", "warc_date"),
            header("WARC-Payload-Digest", "source_payload_digest"), header("WARC-Block-Digest", "block_digest"),
            header("Content-Type", "content_type"), F.lit("Content-Length: "), F.col("content_length").cast("string"),
            F.lit(CRLF * 2), F.col("block"),
        ).alias("record")
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write WARC files, one for each partition; two line ends close a record."""
    serialised(records).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def op10_warc(spark, sf_dir: str) -> DataFrame:
    return derivatives(responses_from_pages(table(spark, sf_dir, "pages")))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _chars(text: str) -> str:
    """An SQL string with line ends spelt out."""
    parts = [f"chr({ord(x)})" if x in "\r\n" else _quoted(x) for x in __import__("re").split(r"([\r\n])", text) if x]
    return "(" + " || ".join(parts or ["''"]) + ")"


def oracle() -> str:
    text = "payload"
    for pattern, to in TO_TEXT[:5]:
        text = f"regexp_replace({text}, {_quoted(pattern)}, {_chars(to)}, 'g')"
    char = lambda n: f"CASE WHEN {n} = 38 THEN '&amp;' WHEN {n} BETWEEN 1 AND 55295 OR {n} BETWEEN 57344 AND 1114111 THEN chr(CAST({n} AS INTEGER)) ELSE chr(65533) END"
    dec, hexa = (f"regexp_extract(p, {_quoted(x)}, 1)" for x in (DECIMAL, HEX))
    text = f"""array_to_string(list_transform(string_split({text}, '&#'), lambda p, i: CASE WHEN i = 1 THEN p
      WHEN {dec} <> '' THEN {char(f"TRY_CAST({dec} AS BIGINT)")} || regexp_replace(p, {_quoted(DECIMAL)}, '')
      WHEN {hexa} <> '' THEN {char(f"TRY_CAST(concat('0x', {hexa}) AS BIGINT)")} || regexp_replace(p, {_quoted(HEX)}, '')
      ELSE '&#' || p END), '')"""
    for name, to in ENTITIES:
        text = f"replace({text}, {_quoted(name)}, {_quoted(to)})"
    for pattern, to in TO_TEXT[5:]:
        text = f"regexp_replace({text}, {_quoted(pattern)}, {_chars(to)}, 'g')"
    uid = lambda e: (
        f"concat('<urn:uuid:', substr(md5({e}),1,8), '-', substr(md5({e}),9,4), '-', concat('8', substr(md5({e}),14,3)), '-', concat('a', substr(md5({e}),18,3)), '-', substr(md5({e}),21,12), '>')"
    )
    return f"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_sha256 FROM pages
), r AS (
  SELECT page_id, target_uri, payload, payload_sha256, {text} AS text,
    {uid("concat_ws('|', 'response', coalesce(CAST(page_id AS VARCHAR), 'null'), target_uri, payload_sha256)")} AS refers_to,
    regexp_replace(regexp_extract(payload, {_quoted(TITLE)}, 1), '[ \\t\\r\\n]+', ' ', 'g') AS title,
    regexp_extract(payload, {_quoted(LANG)}, 1) AS lang,
    len(regexp_extract_all(payload, {_quoted(LINK)})) AS links
  FROM p
), f AS (
  SELECT *, 'title: ' || title || {_chars(CRLF)} || 'language: ' || lang || {_chars(CRLF)} || 'outlinks: ' || CAST(links AS VARCHAR)
    || {_chars(CRLF)} || 'text-length: ' || CAST(length(text) AS VARCHAR) || {_chars(CRLF)}
    || 'source-status: HTTP/1.1 200 OK' || {_chars(CRLF)} || 'source-header-Content-Type: text/html; charset=utf-8' || {_chars(CRLF)}
    || 'source-header-Content-Length: ' || CAST(strlen(payload) AS VARCHAR) || {_chars(CRLF)} AS fields,
    'HTTP/1.1 200 OK' || {_chars(CRLF)} || 'Content-Type: text/html; charset=utf-8' || {_chars(CRLF)}
    || 'Content-Length: ' || CAST(strlen(payload) AS VARCHAR) AS source_headers,
    {uid("concat_ws('|', 'metadata', refers_to)")} AS metadata_id, {uid("concat_ws('|', 'conversion', refers_to)")} AS conversion_id
  FROM r
), b AS (
  SELECT page_id, 'metadata' AS warc_type, metadata_id AS record_id, refers_to, conversion_id AS concurrent_to, target_uri, source_headers,
    payload_sha256, 'application/warc-fields' AS content_type, fields AS block FROM f
  UNION ALL
  SELECT page_id, 'conversion', conversion_id, refers_to, metadata_id, target_uri, source_headers, payload_sha256, 'text/plain; charset=utf-8', text FROM f
)
SELECT page_id, warc_type, record_id, refers_to, concurrent_to, target_uri, {_quoted(DATE)} AS warc_date, 'HTTP/1.1 200 OK' AS source_status,
  'text/html; charset=utf-8' AS source_type, source_headers, 'sha256:' || payload_sha256 AS source_payload_digest, content_type,
  CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest, block
FROM b"""
