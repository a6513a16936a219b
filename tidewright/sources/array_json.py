"""Directories of JSON files, each one object of parallel arrays.

Layout: ``<root>/<mooring>/<deployment>/buoy/{metbk,wavss}/*.json``.  Every file is
one scan unit; no schema is inferred and only the listed variables are parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.timegrid import epoch_to_ts, minutes
from tidewright.model import KEYS, MET_FIELDS, WAVE_FIELDS, WAVE_SHIFT_MINUTES, array_schema
from tidewright.operators.dedup import first_per_key

CORRUPT = "_corrupt_record"

#: Mooring and deployment folders in a file's path.
PATH_KEYS = r"/([^/]+)/([^/]+)/buoy/(?:metbk|wavss)/[^/]+$"

#: Columns that name a sample's origin; they order copies of one time stamp.
ORIGIN = ["file_path", "pos"]

INSTRUMENTS = {
    "metbk": ("*.json", MET_FIELDS),
    "wavss": ("*.wavss.json", WAVE_FIELDS),
}


def file_schema(fields: list[str]) -> T.StructType:
    return T.StructType([*array_schema(fields).fields, T.StructField(CORRUPT, T.StringType())])


def text_schema(fields: list[str]) -> T.StructType:
    """Cells are parsed as text, since numbers may be written as strings."""
    return T.StructType([*[T.StructField(f, T.ArrayType(T.StringType())) for f in fields], T.StructField(CORRUPT, T.StringType())])


def number(cell: Column) -> Column:
    """A cell's text as a double; ``NaN`` and ``Infinity`` come in quotes from one of Spark's two ways to parse."""
    return F.btrim(cell, F.lit('"')).try_cast("double")


def checked(raw: DataFrame, fields: list[str]) -> DataFrame:
    """Files with what is wrong with them in ``_corrupt_record``: not JSON, or a cell that is not a number; ``n``: the longest column.

    The cells stay text here; ``unnest`` casts each of them once, after it has become a row.  What filters use comes out of
    an exploded struct: over plain projections the optimizer would derive every mixture of the columns and their sources.
    """
    cells = F.concat(*[F.coalesce(f, F.array().cast("array<string>")) for f in fields])
    wrong = F.exists(cells, lambda x: x.isNotNull() & number(x).isNull())
    told = F.coalesce(F.col(CORRUPT), F.when(wrong, "an array holds text")).alias(CORRUPT)
    return raw.select("file_path", F.explode(F.array(F.struct(*fields, told, longest(fields).alias("n")))).alias("_file")).select("file_path", "_file.*")


def read_files(
    spark: SparkSession, paths: str | list[str], glob: str, fields: list[str]
) -> DataFrame:
    """One row per file: a column of arrays of text per variable, absent ones NULL.

    Numbers may be written as strings.  Files that are not one valid JSON object, or hold other than numbers in
    an array, have a text in ``_corrupt_record``.  Whole files are read and parsed as one value: the reader of JSON of several lines
    takes some 30 ms a file besides.
    """
    whole = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
    return parse_files(whole.select("path", "content", F.lit(None).cast("string").alias("fault")), fields)


def parse_files(whole: DataFrame, fields: list[str]) -> DataFrame:
    """The same of files that come as rows (path, content, fault)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col("content").cast("string"), text_schema(fields), options)
    # exploded, so that no filter or projection above parses the text again
    raw = whole.select("fault", F.col("path").alias("file_path"), F.explode(F.array(parsed)).alias("j"))
    told = F.coalesce(F.col(f"j.{CORRUPT}"), F.col("fault"), F.when(F.col("j").isNull(), "not an object"))
    return checked(raw.select(*[f"j.{f}" for f in fields], told.alias(CORRUPT), "file_path"), fields)


def longest(fields: list[str]) -> Column:
    return F.greatest(*[F.coalesce(F.size(f), F.lit(0)) for f in fields])


def rejects(files: DataFrame, fields: list[str], stations: DataFrame) -> DataFrame:
    """(file_path, reason): each thing that keeps a file, or one of its columns, from being landed."""
    short = F.filter(
        F.array(*[F.when(F.size(f) < F.col("n"), F.lit(f"short column {f}")) for f in fields]), lambda r: r.isNotNull())
    known = stations.select("mooring").distinct().withColumn("known", F.lit(True))
    placed = files.withColumn("mooring", F.regexp_extract("file_path", PATH_KEYS, 1)).join(known, "mooring", "left")
    n = F.col("n")
    reasons = (
        F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("corrupt"))).when(n <= 0, F.array(F.lit("empty")))
        .when(F.col("known").isNull(), F.array(F.lit("unknown mooring"))).otherwise(short)
    )
    return placed.select("file_path", F.explode(reasons).alias("reason"))


def accepted_files(files: DataFrame, fields: list[str], watch: Observation | None = None) -> DataFrame:
    """Drop corrupt and empty files; count files seen and rejected in ``watch``."""
    counted = files.withColumn("corrupt", F.col(CORRUPT).isNotNull())
    if watch is not None:
        counted = counted.observe(
            watch,
            F.count("*").alias("files"),
            F.count_if("corrupt").alias("corrupt"),
            F.count_if(~F.col("corrupt") & (F.col("n") <= 0)).alias("empty"),
        )
    return counted.filter(~F.col("corrupt") & (F.col("n") > 0)).drop("corrupt", CORRUPT)


def unnest(files: DataFrame, fields: list[str]) -> DataFrame:
    """Parallel arrays to rows, with ``pos`` counting from 0; a cell becomes a number here, once.

    A column shorter than the longest one is NULL throughout; NaN becomes NULL.
    """
    keep = [c for c in files.columns if c not in (*fields, "n")]
    whole = [F.when(F.size(f) == F.col("n"), F.col(f)).otherwise(F.array().cast("array<string>")).alias(f) for f in fields]
    zipped = files.select(*keep, F.arrays_zip(*whole).alias("rows"))
    # the files have rows; outer, as the optimizer would else infer a filter over all columns
    rows = zipped.select(*keep, F.posexplode_outer("rows").alias("pos", "row"))
    return rows.select(*keep, "pos", *[F.nanvl(number(F.col("row")[f]), F.lit(None)).alias(f) for f in fields])


def with_keys(df: DataFrame, stations: DataFrame) -> DataFrame:
    """Site and deployment from the file path; unknown moorings drop out."""
    keyed = df.withColumn("mooring", F.regexp_extract("file_path", PATH_KEYS, 1)).withColumn(
        "deployment", F.regexp_extract("file_path", PATH_KEYS, 2)
    )
    return keyed.join(stations.select("site", "mooring"), "mooring").drop("mooring")


def samples(
    files: DataFrame,
    fields: list[str],
    stations: DataFrame | None = None,
    watch: Observation | None = None,
) -> DataFrame:
    """Rows with a valid time, keyed by ``(site, deployment)`` if stations are given."""
    accepted = accepted_files(files, fields, watch)
    keyed = accepted if stations is None else with_keys(accepted, stations)
    rows = unnest(keyed, fields).withColumn("time", epoch_to_ts(F.col("time")))
    return rows.filter(F.col("time").isNotNull())


def deduplicate(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row per time stamp: the first by file path, then by position."""
    return first_per_key(df, ["time", *keys], ORIGIN)


def instrument_files(spark: SparkSession, root: str, instrument: str) -> DataFrame:
    """Files of one instrument in every deployment under ``root``."""
    glob, fields = INSTRUMENTS[instrument]
    return read_files(spark, f"{root}/*/*/buoy/{instrument}", glob, fields)


def load_met(spark: SparkSession, root: str, stations: DataFrame) -> DataFrame:
    """Meteorological samples of every deployment under ``root``."""
    return deduplicate(samples(instrument_files(spark, root, "metbk"), MET_FIELDS, stations))


def load_wave(spark: SparkSession, root: str, stations: DataFrame) -> DataFrame:
    """Wave samples of every deployment under ``root``, with raw time stamps.

    Binning applies the instrument's shift; ``shifted_wave`` applies it up front.
    """
    return deduplicate(samples(instrument_files(spark, root, "wavss"), WAVE_FIELDS, stations))


def shifted_wave(wave: DataFrame) -> DataFrame:
    """Wave samples moved to the middle of their 20-minute cycle."""
    return wave.withColumn("time", F.col("time") + minutes(WAVE_SHIFT_MINUTES))
