"""Progress of each deployment: a ledger of processed windows, one version a run."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.timegrid import instant_to_ntz
from tidewright.model import KEYS, PROGRESS_SCHEMA
from tidewright.session import materialize
from tidewright.sources.array_json import PATH_KEYS
from tidewright.sources.ledger import Ledger


def progress_ledger(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, path, PROGRESS_SCHEMA)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Progress rows since the last snapshot, and those of it; empty where none was written yet.

    A version that cannot be read is named in a warning, and what it held counts as never processed.
    """
    ledger = progress_ledger(spark, path)
    try:
        return materialize(ledger.read(), "progress")
    except Exception:  # noqa: BLE001
        good = []
        for v in ledger.parts():
            try:
                good.append(materialize(spark.read.schema(PROGRESS_SCHEMA).parquet(f"{path}/{v.name}"), "progress"))
            except Exception as e:  # noqa: BLE001
                warnings.warn(f"progress version {path}/{v.name} cannot be read and is left out: {str(e)[:300]}", stacklevel=2)
        out = spark.createDataFrame([], PROGRESS_SCHEMA)
        for rows in good:
            out = out.union(rows)
        return out


def latest_progress(progress: DataFrame) -> DataFrame:
    """``last_bin_end`` of the last run per deployment, NULL after a clear."""
    last = F.max_by(F.struct("last_bin_end", "cleared"), "run_id")
    return (
        progress.groupBy(*KEYS)
        .agg(last.alias("last"))
        .select(*KEYS, F.when(~F.col("last.cleared"), F.col("last.last_bin_end")).alias("last_bin_end"))
    )


def append_progress(rows: DataFrame, path: str) -> None:
    """Add rows as one version; from time to time the last row of each deployment becomes a snapshot."""
    spark = rows.sparkSession
    ledger = progress_ledger(spark, path)
    ledger.write(rows.coalesce(1), ledger.last() + 1)
    if ledger.snapshot_due():
        last = read_progress(spark, path).groupBy(*KEYS).agg(F.max_by(F.struct("last_bin_end", "cleared"), "run_id").alias("s"), F.max("run_id").alias("run_id"))
        ledger.snapshot(last.select(*KEYS, "s.last_bin_end", "run_id", "s.cleared").coalesce(1))


def save_progress(runs: DataFrame, path: str, run_id: int) -> None:
    """Record ``bin_end`` of each run; call it after its output is written."""
    append_progress(
        runs.select(
            *KEYS,
            F.col("bin_end").alias("last_bin_end"),
            F.lit(run_id).alias("run_id"),
            F.lit(False).alias("cleared"),
        ),
        path,
    )


def clear_progress(
    spark: SparkSession, path: str, run_id: int, sites: list[str] | None = None, deployments: list[str] | None = None,
    only: DataFrame | None = None,
) -> None:
    """Forget what was processed, for all or some sites and deployments; nothing recorded is fine.

    ``only`` is a table of the keys in question.
    """
    keys = read_progress(spark, path).select(*KEYS).distinct()
    for column, wanted in (("site", sites), ("deployment", deployments)):
        if wanted is not None:
            keys = keys.filter(F.col(column).isin(wanted))
    if only is not None:
        keys = keys.join(only.select(*KEYS).distinct(), KEYS, "left_semi")
    append_progress(
        keys.select(
            *KEYS,
            F.lit(None).alias("last_bin_end"),
            F.lit(run_id).alias("run_id"),
            F.lit(True).alias("cleared"),
        ),
        path,
    )


def progress_from_state_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Progress rows from per-deployment JSON state files, to carry them over.

    A file holds ``{"last_bin_end": ISO-8601, "station": site}`` under its
    deployment's ``buoy`` folder; a time without offset is UTC.  Unreadable
    files give no row.
    """
    raw = (
        spark.read.schema("last_bin_end string, station string")
        .option("multiLine", True)
        .json(paths)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
    )
    has_offset = F.col("last_bin_end").rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    instant = F.try_to_timestamp(F.when(has_offset, F.col("last_bin_end")).otherwise(F.concat("last_bin_end", F.lit("Z"))))
    folder = PATH_KEYS.replace("/[^/]+$", "/")
    return raw.select(
        F.col("station").alias("site"),
        F.regexp_extract("file_path", folder, 2).alias("deployment"),
        instant_to_ntz(instant).alias("last_bin_end"),
        F.lit(0).cast("bigint").alias("run_id"),
        F.lit(False).alias("cleared"),
    ).filter("last_bin_end IS NOT NULL AND site IS NOT NULL")
