"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius; two fingerprints
within the radius meet at a variant half-way.  Variants are the shuffle key, so no
group is larger than one ball (65 fingerprints at a radius of 2).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tidewright.llm.common import columns_apart, components, in_batches, row_keys, stored, text_bytes

BITS = 64
SEED = 42
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def shingle_hashes(data: bytes, shingle: int) -> np.ndarray:
    """Hash of every run of ``shingle`` words; of the whole text if it has fewer words."""
    words = data.lower().split()
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(joined, SEED)] if words else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: -shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    digests = (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True))
    return np.fromiter(digests, np.uint64, len(starts))


def simhash(data: bytes, shingle: int = 3) -> int:
    """Unsigned fingerprint of a text: a bit is 1 if set in over half of the hashes."""
    hashes = shingle_hashes(data, shingle)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, __hash, fp) of every row; fp is the fingerprint as a signed long, 0 without words."""
    schema = T.StructType([docs.schema[id_col], T.StructField("__hash", T.LongType()), T.StructField("fp", T.LongType())])

    def work(rows: list[tuple]) -> Iterator[tuple]:
        for key, hashed, data in rows:
            yield key, hashed, (simhash(data, shingle) ^ (1 << 63)) - (1 << 63)

    return in_batches(docs, [F.col(id_col), row_keys(docs, id_col)["__hash"], text_bytes(text_col)], work, schema)


def links(classes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Distinct links (a, b), a < b, that connect all fingerprints within ``max_bits`` of each other.

    ``classes`` has distinct ``fp``.  Those that meet at a variant are within the radius of each other, so each is
    linked to the least of them only; the distance is verified all the same.
    """
    if max_bits % 2 or not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0, 2 or 4: half of it is the radius of a ball")
    masks = [sum(1 << b for b in bits) for n in range(max_bits // 2 + 1) for bits in combinations(range(BITS), n)]
    signed = F.array(*[F.lit((m ^ (1 << 63)) - (1 << 63)) for m in masks])
    balls = classes.select("fp", F.explode(signed).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    least = F.min("fp").over(Window.partitionBy("variant"))
    met = balls.select("fp", least.alias("a")).where("fp > a").select("a", F.col("fp").alias("b")).distinct()
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """(id, __hash, fp, component_id) of every row, ``component_id`` the least id reachable.

    Ids that are NULL are passed over; a component of such rows alone has a NULL id.  A NULL
    text is empty; texts without words have fingerprint 0 and link like any other.  Rows that
    repeat are kept.  An empty table gives no rows.  Other columns are ignored.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = stored(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")), "classes")
    roots = components(links(classes, max_bits))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(id_col, "__hash", "fp", "component_id")


@columns_apart
def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """One row of ``docs`` of each component, that of least id (NULL last), then least hash of the row.

    Of rows equal in every column one stays.  All columns are kept as they are.
    """
    near = near_duplicates(docs, id_col, text_col, **options)
    first = F.min(F.struct(F.col(id_col).isNull().alias("n"), F.coalesce(F.col(id_col), F.lit(0)).alias("i"), F.col("__hash").alias("h")))
    kept = (
        near.groupBy(F.coalesce("component_id", "fp"), F.col("component_id").isNull()).agg(first.alias("k"))
        .select(F.col("k.i").alias("__id"), F.col("k.h").alias("__hash"))
    )
    chosen = docs.withColumns(row_keys(docs, id_col)).join(kept, ["__id", "__hash"], "left_semi")
    return chosen.dropDuplicates(["__id", "__hash"]).select(*docs.columns)
