"""Sharding by extendible hashing.

A shard is a bucket: the rows whose hashes begin with the same bits, as many as its local depth.  The directory has a
slot for each hash prefix of the global depth that rows have, with the bytes of its rows, and points it to a bucket.  All
slots begin in one bucket; a bucket over the byte limit is split on its next bit, which only concerns its own slots, until every
bucket fits.  Where a single slot is still over the limit the directory is extended: rows of such slots alone get slots of more bits.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import numbered, row_keys, stored

BITS = 60
#: Bits that a round goes beyond what an even split would need, and bits of each further round.
SPARE_BITS = 3
STEP_BITS = 8
LIMIT = 1 << 20


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of a key, as a long."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def slots(rows: DataFrame, depth: int) -> DataFrame:
    """(slot, bytes, rows, low, high): the slots of a directory of global depth ``depth``, with the least and greatest hash in each.

    Hash prefixes without rows have no slot.
    """
    of = rows.groupBy(F.shiftright("bits", BITS - depth).alias("slot"))
    return of.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"), F.min("bits").alias("low"), F.max("bits").alias("high"))


def split(open_: DataFrame, at: int, depth: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(slot, at, paged) of the slots of ``open_`` whose bucket of ``at`` bits ends here, and the slots of those to split.

    A bucket of one row fits whatever its size.  One whose rows agree in all bits can never be split: it gets all
    bits, and pages.
    """
    bucket = F.shiftright("slot", depth - at).alias("bucket")
    held = open_.groupBy(bucket).agg(
        F.sum("bytes").alias("held"), F.sum("rows").alias("n"), F.min("low").alias("least"), F.max("high").alias("most"))
    fits = (F.col("held") <= limit) | (F.col("n") == 1)
    # stored, so that its size is known: few buckets are broadcast, and many leave no hot one in the join
    buckets = stored(held.select("bucket", fits.alias("fits"), (~fits & F.expr("least = most")).alias("paged")), "buckets")
    told = stored(open_.withColumn("bucket", bucket).join(buckets, "bucket").drop("bucket"), "slots")
    ended = F.when(F.col("paged"), BITS).otherwise(at).alias("at")
    return told.where("fits or paged").select("slot", ended, "paged"), told.where("not fits and not paged").drop("fits", "paged")


def point(rows: DataFrame, done: int, depth: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(slot, at, paged) of all slots whose bucket is final, of ``at`` bits, and the slots that are oversized by themselves.

    ``done`` bits are known to be too few.  A bucket is split once a step, so a step reads the slots of oversized buckets only.
    """
    left, pointed = stored(slots(rows, depth), "slots"), []
    for at in range(done, depth + 1):
        ends, left = split(left, at, depth, limit)
        pointed.append(ends)
        if left.isEmpty():
            break
    return stored(reduce(DataFrame.unionByName, pointed), "directory"), left


def pages(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` of buckets that cannot be split with ``page``, each page of as many rows as surely fit."""
    rows = stored(rows, "paged")
    counted = numbered(rows, ["bits"], ["bytes", "__id", "__hash"], "page", rows=rows.count())
    most = rows.groupBy("bits").agg(F.greatest(F.lit(1), F.floor(F.lit(limit) / F.max("bytes"))).alias("each"))
    return counted.join(most, "bits").withColumn("page", F.floor(F.col("page") / F.col("each")).cast("long")).drop("each")


def assign(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``rows`` (stored, with ``bits`` and ``bytes``) with ``shard``, its prefix as digits 0 and 1, and ``page``.

    Rows that agree in all bits cannot be split further: beyond the limit they go to pages of one shard, each of as many
    as surely fit.  Page 0 is the shard itself.
    """
    total, n = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    if not n:
        return rows.select("*", F.lit("").alias("shard"), F.lit(0).cast("long").alias("page"))
    done, depth = 0, max(1, min(BITS, math.ceil(math.log2(max(1, total / limit))) + SPARE_BITS))
    left, parts = rows, []
    while True:
        pointed, over = point(left, done, depth, limit)
        placed = left.withColumn("slot", F.shiftright("bits", BITS - depth))
        ended = placed.join(pointed, "slot").drop("slot")
        parts.append(ended.where("not paged").drop("paged").withColumn("page", F.lit(0).cast("long")))
        if not pointed.where("paged").isEmpty():
            parts.append(pages(ended.where("paged").drop("paged"), limit))
        if over.isEmpty():
            break
        left = stored(placed.join(over.select("slot"), "slot", "left_semi").drop("slot"), "oversized")
        done, depth = depth + 1, min(BITS, depth + STEP_BITS)
    every = reduce(DataFrame.unionByName, parts)
    return every.withColumn("shard", F.expr(f"substring(lpad(bin(bits), {BITS}, '0'), 1, at)")).drop("at")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, __id, __hash, bytes, shard, page) of every row, by the hash of its id and the bytes of its text.

    A NULL text has 0 bytes.  A NULL id is a key like any other.  A text over the limit is a shard of its own.
    """
    keys = row_keys(docs, id_col)
    rows = docs.select(
        F.col(id_col), keys["__id"].alias("__id"), keys["__hash"].alias("__hash"), hash_bits(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("bits"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("bytes"))
    return assign(stored(rows, "rows-to-shard"), limit).drop("bits")


def directory(sharded: DataFrame) -> DataFrame:
    """(shard, page, depth, rows, bytes): the buckets; the global depth of the directory is the greatest depth."""
    return sharded.groupBy("shard", "page").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).withColumn("depth", F.length("shard"))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> None:
    """Write each shard of ``docs`` as Parquet under ``shard=<prefix>/page=<page>``, one file a shard."""
    placed = shard(docs, id_col, text_col, limit).groupBy("__id", "__hash").agg(F.sort_array(F.collect_list(F.struct("shard", "page"))).alias("at"))
    keyed = docs.withColumns(row_keys(docs, id_col)).dropDuplicates(["__id", "__hash"]).join(placed, ["__id", "__hash"])
    at = F.explode("at").alias("_at")
    every = keyed.select(*docs.columns, at).select(
        *docs.columns, F.concat(F.lit("p"), "_at.shard").alias("shard"), F.col("_at.page").alias("page"))
    every.repartition("shard", "page").write.partitionBy("shard", "page").parquet(path)
