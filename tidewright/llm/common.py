"""Helpers shared by the operators: Arrow batches, row keys, numbering, components."""

from __future__ import annotations

import inspect
import math
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewright.session import materialize

#: Most bytes and rows of one Arrow batch, so that very long texts do not add up in a worker.
BATCH_BYTES = "16m"
BATCH_ROWS = "4000"

#: Rows that one task may number, see ``numbered``.
ROWS_PER_BUCKET = 20_000


def columns_apart(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Operator on documents whose other columns may have any name, also one that the operator uses itself.

    Columns that no ``..._col`` argument names pass through under names of their own.  A column that the
    operator adds stands in for one of the user's with that name.
    """
    signature = inspect.signature(operator)

    @wraps(operator)
    def run(docs: DataFrame, *args: object, **options: object) -> DataFrame:
        bound = signature.bind(docs, *args, **options)
        bound.apply_defaults()
        flat = {**bound.arguments, **bound.arguments.get("options", {})}
        named = {v for k, v in flat.items() if k.endswith("_col") and v}
        aside = {c: f"kept_column_{i}" for i, c in enumerate(docs.columns) if c not in named and c not in USED_BY_NAME}
        back = {v: k for k, v in aside.items()}
        out = operator(docs.select(*[F.col(f"`{c}`").alias(aside.get(c, c)) for c in docs.columns]), *args, **options)
        own = set(out.columns) - set(back)
        return out.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in out.columns if back.get(c) not in own])

    return run


#: Columns that operators read without an argument for them.
USED_BY_NAME = ("doc_id", "text", "source", "lang")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: a short lineage that survives lost executors."""
    return materialize(df, f"llm-{name}")


def in_batches(
    df: DataFrame, columns: list[Column], work: Callable[..., Iterator[tuple]], schema: T.StructType
) -> DataFrame:
    """Run ``work(rows) -> rows`` over Arrow batches of ``columns``, as tuples both ways."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = list(work(list(zip(*(c.to_pylist() for c in batch.columns), strict=True))))
                arrays = [
                    pa.array(values, f.type)
                    for values, f in zip(zip(*rows, strict=True) if rows else [[]] * len(out), out, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(run, schema)


def text_bytes(text_col: str = "text") -> Column:
    """UTF-8 bytes of a text; a NULL text is empty."""
    return F.coalesce(F.col(text_col), F.lit("")).cast("binary")


def row_keys(df: DataFrame, id_col: str = "doc_id") -> dict[str, Column]:
    """Two columns, never NULL, that name a row; only rows equal in every column share them.

    Columns of maps take no part.
    """
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise ValueError(f"ids have to be whole numbers; {id_col} is {df.schema[id_col].dataType.simpleString()}")
    columns = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    hashed = F.xxhash64(*columns, *[c.isNull() for c in columns])
    return {"__id": F.coalesce(F.col(id_col), F.lit(0)), "__hash": hashed}


def same(left: str, right: str, columns: list[str]) -> Column:
    """Null-safe equality of ``columns`` of two aliased frames."""
    condition = F.lit(True)
    for c in columns:
        condition &= F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return condition


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "rank", rows: int | None = None) -> DataFrame:
    """``df`` with a number from 0 in each group of ``keys``, without holes.

    A group is numbered in hash buckets of ``order``, each of about
    ``ROWS_PER_BUCKET`` rows, so a group with a third of all rows spreads over many
    tasks.  ``df`` must be a stored table; rows equal in ``order`` are numbered in any order.
    """
    rows = df.count() if rows is None else rows
    buckets = max(1, math.ceil(rows / ROWS_PER_BUCKET))
    placed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = placed.withColumn("_rank", F.row_number().over(inside) - 1)
    return (
        ranked.alias("l").join(starts.alias("r"), same("l", "r", [*keys, "_bucket"]))
        .select("l.*", (F.col("_start") + F.col("_rank")).cast("long").alias(name))
        .drop("_bucket", "_rank")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the least node reachable.

    Alternates large-star and small-star steps; a step is an aggregation and a join,
    stored before the next one.  Hubs are joined, not gathered, so skew handling splits them.
    """
    edges = stored(edges.select("a", "b").where("a <> b"), "edges")
    seen = None
    while (now := tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())) != seen and now[0]:
        seen = now
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select("v", "m").distinct()
        down = large.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least.select("u", "m")).distinct(), "edges")
    if seen is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.union(edges.select("b", "b").distinct())
