"""Secret scan: fixed patterns, and strings that zstandard can't foretell.

The base kinds are found by their patterns. The method adds ``novel`` spans:
strings in a sensitive context (a word such as *credential* or *bearer* shortly
before them) that cost nearly as much as random characters of their alphabet
after a compressor has been primed with a dictionary of identifiers and the code
or prose around them.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from .common import table

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{32,}")
#: Words that make what follows them sensitive.
CONTEXT = (
    "password passwd passphrase secret token api_key apikey api-key access_key private_key credential bearer authorization auth_token "
    "client_secret signature session_id encryption_key"
).split()
SENSITIVE = re.compile("(?i:" + "|".join(CONTEXT) + ")")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
#: What code and configuration say around secrets; primes the compressor. Fixed values.
IDENTIFIERS = " ".join(CONTEXT) + (
    " access_key_id secret_access_key aws_access_key_id aws_secret_access_key client_id connection_string username user_name localhost "
    "example.com https:// http:// import export return function const public private static final string String int boolean null true false "
    "None self this class def value config settings environment os.environ getenv process.env request response header headers content-type "
    "application/json abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 your_password_here changeme placeholder xxxxxxxxxxxxxxxx"
)
#: A cheap superset of all that can match, for RE2 over whole Arrow columns.
MAYBE = r"(?i)pass(word|wd|phrase)|secret|token|api[_-]?key|AKIA|credential|bearer|authorization|auth_token|access_key|private_key|signature|session_id|encryption_key|[0-9a-f]{32}"


def marginal_bytes(candidate: str, around: str) -> int:
    """Bytes that the candidate adds once identifiers and surroundings are known."""
    primed = zstandard.ZstdCompressionDict(
        (IDENTIFIERS + "\n" + around).encode("utf-8", "surrogatepass"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    pack = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
    return len(pack.compress(candidate.encode("utf-8", "surrogatepass"))) - len(pack.compress(b""))


#: Alphabets of keys, the smallest first, and how many characters each has.
ALPHABETS = [(re.compile(x), n) for x, n in (
    ("[0-9]+", 10), ("[0-9a-f]+|[0-9A-F]+", 16), ("[a-z]+|[A-Z]+", 26), ("[A-Z2-7]+=*|[a-z2-7]+=*", 32), ("[0-9a-z]+|[0-9A-Z]+", 36),
    ("[A-Za-z]+", 52), ("[0-9A-Za-z]+", 62), ("[0-9A-Za-z+/]+=*|[0-9A-Za-z_-]+=*", 64), (".+", 67))]


def is_novel(candidate: str, around: str, novelty: float) -> bool:
    """Whether the marginal bytes reach ``novelty`` times what the candidate would cost without any order.

    That is the cost of its own characters shuffled: entropy coding brings
    random strings of a small alphabet far below their length. Runs and the
    like, cheap in any order, stay under the entropy of their alphabet.
    """
    n = len(candidate)
    cost = marginal_bytes(candidate, around)
    size = next(size for pattern, size in ALPHABETS if pattern.fullmatch(candidate))
    if cost < novelty * n * math.log2(size) / 8:
        return False
    if cost >= novelty * n:
        return True
    mixed = list(candidate)
    random.Random(n).shuffle(mixed)
    return cost >= novelty * marginal_bytes("".join(mixed), around)


def surroundings(text: str, a: int, b: int, around: int) -> str:
    """The text around a span, its other copies blanked: a key isn't foretold by itself."""
    n = b - a
    left, right = (x.replace(text[a:b], " " * n) for x in (text[max(0, a - around - n) : a], text[b : b + around + n]))
    return left[max(0, len(left) - around) :] + right[:around]


def find_secrets(text: str, *, reach: int = 48, around: int = 512, novelty: float = 0.8) -> list[tuple[int, int, str]]:
    """All spans ``(start, end, kind)`` of a text, by start and then kind as listed in :data:`KINDS`.

    A ``novel`` candidate has 16 or more characters, starts at most ``reach``
    characters behind a sensitive word and overlaps no base span; it is
    reported if its marginal compressed bytes reach ``novelty`` times what its
    characters cost in random order.
    """
    spans = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [(m.start(), m.end(), 2) for m in HEX_LONG.finditer(text)]
    base = sorted(spans)
    starts = [x for x, _, _ in base]
    ends = list(accumulate((y for _, y, _ in base), max))  # the furthest end so far
    done: set[int] = set()
    for s in SENSITIVE.finditer(text):
        at = s.end()
        while m := CANDIDATE.search(text, at, s.end() + reach + 16):
            m = CANDIDATE.match(text, m.start())  # the whole run, however long
            (a, b), at = m.span(), m.end()
            if a in done:
                continue
            done.add(a)
            before = bisect_left(starts, b)  # base spans that start ahead of its end
            if before and ends[before - 1] > a:
                continue
            if is_novel(m[0], surroundings(text, a, b, around), novelty):
                spans.append((a, b, 3))
    return [(a, b, KINDS[k]) for a, b, k in sorted(spans, key=lambda x: (x[0], x[2], x[1]))]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)`` with its spans.

    Null or empty text has no spans; equal rows give equal rows; other columns
    are ignored; an empty table gives an empty table. RE2 first picks the rows
    that can match at all, so Python sees only those. No shuffle.
    """
    arrow = pa.schema([(c, pa.string() if c in ("base_sha256", "spans") else pa.int64()) for c in
                       ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel")])
    nothing = hashlib.sha256(b"").hexdigest()

    def scan(batches):
        for batch in batches:
            text = batch.column("text")
            maybe = pc.fill_null(pc.match_substring_regex(text, MAYBE), False)
            n = batch.num_rows
            counts = [[0] * n for _ in KINDS]
            digest, found = [nothing] * n, [""] * n
            for i in pc.indices_nonzero(maybe).to_pylist():
                spans = find_secrets(text[i].as_py())
                for k, kind in enumerate(KINDS):
                    counts[k][i] = sum(s[2] == kind for s in spans)
                digest[i] = hashlib.sha256(joined([s for s in spans if s[2] != "novel"]).encode()).hexdigest()
                found[i] = joined(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *[pa.array(c, pa.int64()) for c in counts[:3]], pa.array(digest), pa.array(found), pa.array(counts[3], pa.int64())],
                schema=arrow,
            )

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
