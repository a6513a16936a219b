"""Mixing sources to target weights by entropy balancing.

The document rates nearest to 1 in relative entropy that meet each source's token target and a
cap are exponentially tilted: ``min(cap, exp(lambda * size))``.  The multipliers solve a convex
dual, found for all sources at once by safeguarded Newton steps; a step is one aggregation over
the counts of (source, size).  Rates become copies by passing each size's remainder on to the
next smaller one, so a source misses its target by about its smallest documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import columns_apart, in_batches, numbered, row_keys, same, stored, text_bytes

CAP = 3.0
TOLERANCE = 1e-6
MAX_STEPS = 80


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, __id, __hash): size is the number of words, 0 for a NULL text."""
    schema = T.StructType([
        docs.schema[id_col], T.StructField("source", docs.schema[source_col].dataType),
        T.StructField("size", T.LongType()), T.StructField("__id", docs.schema[id_col].dataType), T.StructField("__hash", T.LongType()),
    ])

    def work(rows: list[tuple]) -> Iterator[tuple]:
        for key, source, row_id, hashed, data in rows:
            yield key, source, len(data.split()), row_id, hashed

    keys = row_keys(docs, id_col)
    return in_batches(docs, [F.col(id_col), F.col(source_col), keys["__id"], keys["__hash"], text_bytes(text_col)], work, schema)


def repeating_weights(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """(source, weight): ``weights`` in turn over the sources by code point, NULL last."""
    schema = T.StructType([sources.schema["source"], T.StructField("weight", T.DoubleType())])
    ordered = sources.select("source").distinct().orderBy(F.col("source").asc_nulls_last())
    return sources.sparkSession.createDataFrame(
        ordered.rdd.zipWithIndex().map(lambda x: (x[0][0], float(weights[x[1] % len(weights)]))), schema)


def targets(sources: DataFrame, cap: float = CAP) -> DataFrame:
    """``sources`` (source, source_size, weight; stored) with ``target``.

    All tokens are shared by weight; targets stop at ``cap`` times the source, and the excess is shared again
    until none is above.  The share of one weight only grows, so this ends at the latest after one pass a source.
    """
    above = F.lit(cap) * F.col("source_size")
    total, weight = sources.agg(F.sum("source_size").cast("double"), F.sum("weight")).first()
    share, last = (total or 0.0) / (weight or 1.0), None
    while share != last:
        free = above > F.lit(share) * F.col("weight")
        full, weight = sources.agg(F.sum(F.when(~free, above)), F.sum(F.when(free, F.col("weight")))).first()
        last, share = share, (max(share, (total - (full or 0.0)) / weight) if weight else share)
    return sources.withColumn("target", F.least(above.cast("double"), F.lit(share) * F.col("weight")))


def tilts(counts: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, target, mean, tilt): multipliers of ``size / mean`` that meet the targets.

    ``counts``: stored (source, size, n) with size over 0; ``goals``: (source, target).
    """
    base = counts.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).cast("double").alias("words"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("least"))
    least = F.col("least") / F.col("mean")
    state = base.alias("l").join(goals.alias("r"), same("l", "r", ["source"])).where("target > 0").select(
        "l.source", "target", "mean", F.lit(0.0).alias("tilt"),
        F.least(F.lit(0.0), F.log(F.col("target") / F.col("words")) / least).alias("lo"),
        F.when(F.col("target") > F.col("words"), F.lit(math.log(cap)) / least).otherwise(0.0).alias("hi"),
        F.lit(None).cast("double").alias("miss"))
    state = stored(state, "tilts")
    for _ in range(MAX_STEPS):
        reach = F.col("size") / F.col("mean")
        rate = F.least(F.lit(cap), F.exp(F.col("tilt") * reach))
        words = F.col("n") * F.col("size") * rate
        sums = counts.alias("l").join(state.alias("r"), same("l", "r", ["source"])).groupBy(
            "r.source", "target", "mean", "tilt", "lo", "hi",
        ).agg(F.sum(words).alias("got"), F.sum(F.when(rate < cap, words * reach).otherwise(0.0)).alias("slope"))
        short = F.col("got") < F.col("target")
        step = F.col("tilt") - F.log(F.col("got") / F.col("target")) * F.col("got") / F.col("slope")
        bounds = sums.withColumns({
            "step": F.when(F.col("slope") > 0, step), "miss": F.abs(F.col("got") / F.col("target") - 1),
            "lo": F.when(short, F.col("tilt")).otherwise(F.col("lo")), "hi": F.when(short, F.col("hi")).otherwise(F.col("tilt")),
        })
        inside = (F.col("step") > F.col("lo")) & (F.col("step") < F.col("hi"))
        moved = F.when(inside, F.col("step")).otherwise((F.col("lo") + F.col("hi")) / 2)
        state = stored(bounds.select(
            "source", "target", "mean",
            F.when(F.col("miss") <= TOLERANCE, F.col("tilt")).otherwise(moved).alias("tilt"), "lo", "hi", "miss"), "tilts")
        if (state.agg(F.max("miss")).first()[0] or 0.0) <= TOLERANCE:
            break
    return state.select("source", "target", "mean", "tilt")


def allot(counts: DataFrame, tilted: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, size, whole, extra): copies of every document of a size, and how many get one more.

    Works down the sizes of a source; what rounding leaves over goes to the next smaller size.  A group has
    one row for each size of document in the source.
    """
    schema = T.StructType([
        counts.schema["source"], T.StructField("size", T.LongType()), T.StructField("whole", T.LongType()), T.StructField("extra", T.LongType()),
    ])

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False)
        rate = np.minimum(cap, np.exp(np.minimum(rows["tilt"] * rows["size"] / rows["mean"], 700)))
        whole = np.floor(rate + 1e-9).astype("int64")
        left, extra = 0.0, []
        for size, n, part, k in zip(rows["size"], rows["n"], rate - whole, whole, strict=True):
            left += n * part * size
            extra.append(int(min(max(round(left / size), 0), n if k + 1 <= cap else 0)))
            left -= extra[-1] * size
        return pd.DataFrame({"source": rows["source"], "size": rows["size"], "whole": whole, "extra": extra})

    joined = counts.alias("l").join(tilted.alias("r"), same("l", "r", ["source"]))
    return joined.select("l.source", "size", "n", "mean", "tilt").groupBy("source").applyInPandas(work, schema)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
    weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = CAP,
) -> DataFrame:
    """(id, __id, __hash, size, source_size, target, copies) of every row.

    A NULL source is a source, the last one.  A NULL text has size 0; rows of size 0 keep one copy and take no
    words.  Which rows of one source and size get one copy more is settled by a hash of the row, so reruns
    agree.  Repeated rows count each.  An empty table gives no rows.
    """
    sized = stored(sizes(docs, id_col, text_col, source_col), "sizes")
    every = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes-of-sources")
    sources = every.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    weighted = sources.alias("l").join(repeating_weights(sources, weights).alias("r"), same("l", "r", ["source"])).select("l.*", "weight")
    goals = stored(targets(stored(weighted, "weights"), cap), "targets")
    counts = every.where("size > 0")
    copies = stored(allot(counts, tilts(counts, goals, cap), cap), "copies")
    ranked = numbered(sized, ["source", "size"], ["__id", "__hash"])
    taken = F.when(F.col("l.size") == 0, 1).otherwise(
        F.coalesce(F.col("whole") + F.when(F.col("rank") < F.col("extra"), 1).otherwise(0), F.lit(0)))
    return (
        ranked.alias("l").join(copies.alias("r"), same("l", "r", ["source", "size"]), "left")
        .select("l.*", taken.cast("long").alias("copies")).alias("l")
        .join(goals.alias("r"), same("l", "r", ["source"]))
        .select(f"l.{id_col}", "__id", "__hash", "size", "source_size", "target", "copies")
    )


@columns_apart
def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options: object) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    taken = mix(docs, id_col, **options).groupBy("__id", "__hash").agg(F.sum("copies").alias("_copies")).where("_copies > 0")
    keyed = docs.withColumns(row_keys(docs, id_col)).join(taken, ["__id", "__hash"])
    one = Window.partitionBy("__id", "__hash").orderBy("__id")
    once = keyed.withColumn("_n", F.row_number().over(one)).where("_n = 1")
    return once.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).select(*docs.columns)
