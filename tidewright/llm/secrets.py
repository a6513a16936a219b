"""Secret scan with corpus-wide ownership frequency.

Candidates are found in whole texts.  Their values are hashed and counted over the corpus by distinct
repositories and owners: a value that many owners hold is a copied example, one that stays with its owner and looks
random is reported as live.  Spans of the three base kinds always stay; live candidates of further kinds are added.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_hexdigest

from tidewright.llm.common import in_batches, row_keys, stored, text_bytes

#: Kinds in the order of ties; the first three are the base ones.
KINDS = ("assign", "access", "hex", "vendor", "token")
BASE = 3
#: Owners from which a value counts as a copied example.
EXAMPLE_OWNERS = 3
#: Bits of entropy a character that a value needs to look live.
LEAST_ENTROPY = 2.5
TOKEN_ENTROPY = 3.5

WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
VENDOR = re.compile(
    r"gh[pousr]_[A-Za-z0-9]{36,}|github_pat_\w{40,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|[rs]k_live_[A-Za-z0-9]{16,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", re.ASCII)
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Length of a word below which only an assignment can be a secret.
LONG = 15

SPAN = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("value", T.StringType()), T.StructField("random", T.BooleanType()),
])


def entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def merged(found: list[tuple]) -> tuple[list[int], list[int]]:
    """Starts and ends of the places that spans cover, in order and apart from each other."""
    starts: list[int] = []
    ends: list[int] = []
    for a, _, b, _ in sorted(found):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def spans(text: str) -> list[tuple[int, int, int, str, bool]]:
    """(start, kind, end, hash of the value, looks random) of each candidate, in code points, end exclusive."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if any(len(w) >= LONG for w in text.split()):
        for kind, pattern in ((1, ACCESS), (2, HEX)):
            found += [(m.start(), kind, m.end(), m[0]) for m in pattern.finditer(text)]
        for kind, pattern in ((3, VENDOR), (4, TOKEN)):
            starts, ends = merged(found)
            for m in pattern.finditer(text):
                at = bisect_left(starts, m.end()) - 1  # the last place that begins before the match ends
                if at >= 0 and ends[at] > m.start():
                    continue
                mixed = re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])
                if kind == 3 or mixed and entropy(m[0]) >= TOKEN_ENTROPY:
                    found.append((m.start(), kind, m.end(), m[0]))
    return [(a, kind, b, xxh3_128_hexdigest(v.encode()), entropy(v) >= LEAST_ENTROPY) for a, kind, b, v in sorted(found)]


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """(id, __id, __hash, repo, owner, spans) of every row."""
    schema = T.StructType([
        docs.schema[id_col], T.StructField("__id", T.LongType()), T.StructField("__hash", T.LongType()),
        T.StructField("repo", T.StringType()), T.StructField("owner", T.StringType()), T.StructField("spans", T.ArrayType(SPAN)),
    ])

    def work(rows: list[tuple]) -> Iterator[tuple]:
        for *keys, data in rows:
            found = spans(data.decode("utf-8", "replace"))
            yield *keys, [dict(zip(SPAN.names, s, strict=True)) for s in found]

    keys = row_keys(docs, id_col)
    return in_batches(
        docs, [F.col(id_col), keys["__id"], keys["__hash"], F.col(repo_col).cast("string"), F.col(owner_col).cast("string"), text_bytes(text_col)],
        work, schema)


def ownership(found: DataFrame) -> DataFrame:
    """(value, repos, owners): distinct repositories and owners of each value; a NULL one counts as one of its own."""
    held = found.select("repo", "owner", F.explode("spans.value").alias("value"))
    owners = held.groupBy("value", "owner").agg(F.lit(1).alias("one")).groupBy("value").agg(F.count("one").alias("owners"))
    repos = held.groupBy("value", "repo").agg(F.lit(1).alias("one")).groupBy("value").agg(F.count("one").alias("repos"))
    return owners.join(repos, "value")


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", *,
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """(id, secrets) of every row: secrets is an array of (start, kind, end, value, repos, owners, live), in order.

    Base kinds are all there; further kinds only where live.  ``value`` is a hash.  A NULL or empty
    text has none.  Repeated rows each get their spans; they count once if repository and owner are the same.
    """
    found = stored(candidates(docs, id_col, text_col, repo_col, owner_col), "secrets")
    each = found.select("__id", "__hash", F.explode("spans").alias("s")).select("__id", "__hash", "s.*")
    live = (F.col("owners") < example_owners) & F.col("random")
    judged = each.join(ownership(found), "value").withColumn("live", live).where((F.col("kind") < BASE) | F.col("live"))
    span = F.struct("start", "kind", "end", "value", "repos", "owners", "live")
    lists = judged.groupBy("__id", "__hash").agg(F.array_sort(F.collect_set(span)).alias("secrets"))
    none = F.array().cast(lists.schema["secrets"].dataType)
    return found.join(lists, ["__id", "__hash"], "left").select(id_col, F.coalesce("secrets", none).alias("secrets"))


def redacted(text: str, found: list, mark: str = "[secret]") -> str:
    """``text`` with the spans of ``found`` replaced; overlapping ones are one."""
    out, at = [], 0
    for s in sorted(found, key=lambda s: s["start"]):
        if s["end"] > at:
            out += [text[at : s["start"]], mark] if s["start"] >= at else []
            at = s["end"]
    return "".join([*out, text[at:]])
