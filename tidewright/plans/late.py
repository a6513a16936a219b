"""Late data: samples of bins that were issued before they came.

Landing keeps them; what they change is issued again.  Each call looks at the batches landed since the last one, keeps the samples whose
bin had left in a side table, computes the bins they touch once more and writes the files of the days concerned.
A call that finds nothing new changes nothing, and one that broke off is repeated with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions import text
from tidewright.functions.timegrid import floor_to_bin
from tidewright.model import BIN, KEYS, MET_SHIFT_MINUTES, WAVE_SHIFT_MINUTES
from tidewright.operators.bins import bin_observations
from tidewright.operators.bounds import bin_grid, data_bounds, fresh_bounds, run_days, with_run_constants
from tidewright.operators.bulletin import bulletin_files
from tidewright.operators.qc import apply_qc
from tidewright.plans.progress import latest_progress
from tidewright.session import materialize
from tidewright.sinks.text_files import write_text_files, written_files
from tidewright.sources.landed import LandedTable, window_zones, zone_times
from tidewright.sources.ledger import Ledger

LATE = T.StructType([
    T.StructField("instrument", T.StringType()), T.StructField("site", T.StringType()), T.StructField("deployment", T.StringType()),
    T.StructField("time", T.TimestampNTZType()), T.StructField("bin", T.TimestampNTZType()),
])
MARK = T.StructType([T.StructField("met", T.IntegerType()), T.StructField("wave", T.IntegerType())])


@dataclass(frozen=True)
class Reissued:
    """``bins``: the bins that late samples touch, as they are now; ``files``: manifest of the files written again."""

    bins: DataFrame
    files: DataFrame | None


def marks(spark: SparkSession, late_path: str) -> Ledger:
    return Ledger(spark, f"{late_path}/marks", MARK)


def late_samples(spark: SparkSession, late_path: str) -> DataFrame:
    """The side table: every sample that came after its bin had left."""
    return Ledger(spark, f"{late_path}/samples", LATE).read(marks(spark, late_path).last())


def issued_spans(met: LandedTable, progress: DataFrame) -> DataFrame:
    """(site, deployment, first_bin, last_bin_end, phase): what each deployment has issued so far."""
    done = latest_progress(progress).where("last_bin_end IS NOT NULL")
    spans = fresh_bounds(data_bounds(zone_times(met))).join(done, KEYS)
    phased = spans.withColumn("phase", F.col("last_bin_end") - floor_to_bin(F.col("last_bin_end")))
    return phased.select(*KEYS, F.col("fresh_start").alias("first_bin"), "last_bin_end", "phase")


def behind(table: LandedTable, since: int, spans: DataFrame, instrument: str, shift: int) -> DataFrame | None:
    """Samples of batches after ``since`` whose bin lies in what was issued."""
    new = table.read(table.zones().where(F.col("batch") > since))
    if new is None:
        return None
    moved = new.select(*KEYS, "time").join(spans, KEYS).withColumn("at", F.col("time") + F.expr(f"INTERVAL {shift} MINUTES") - F.col("phase"))
    placed = moved.withColumn("bin", floor_to_bin(F.col("at")) + F.col("phase"))
    return placed.where(f"bin + INTERVAL {BIN} <= last_bin_end AND bin >= first_bin").select(F.lit(instrument).alias("instrument"), *KEYS, "time", "bin")


def reissue_late(
    spark: SparkSession, met: LandedTable, wave: LandedTable, stations: DataFrame, declinations: DataFrame, progress: DataFrame, late_path: str,
    out_path: str | None = None, as_of: datetime | None = None, alpha_date: Column | None = None,
) -> Reissued | None:
    """Issue again what samples landed since the last call change; None where they change nothing.

    The first call only takes note of what is landed.  Compaction moves no sample to a new batch that was not
    looked at before: call this before ``compact``.  Files are those of whole days, named like those of long runs; rotation is that of
    ``alpha_date``, or of the middle of the days concerned.
    """
    seen = marks(spark, late_path)
    number = seen.last() + 1
    now = spark.createDataFrame([(met.manifest.last(), wave.manifest.last())], MARK).coalesce(1)
    if number == 1:
        seen.write(now, number)
        return None
    # versions only grow
    since = seen.read().agg(F.max("met").alias("met"), F.max("wave").alias("wave")).first()
    spans = materialize(issued_spans(met, progress), "spans")
    found = [behind(met, since["met"], spans, "metbk", MET_SHIFT_MINUTES), behind(wave, since["wave"], spans, "wavss", WAVE_SHIFT_MINUTES)]
    found = [f for f in found if f is not None]
    late = None
    if found:
        late = materialize(found[0] if len(found) == 1 else found[0].union(found[1]), "late")
    if late is None or late.isEmpty():
        seen.write(now, number)
        return None
    Ledger(spark, f"{late_path}/samples", LATE).write(late, number)
    touched = materialize(late.select(*KEYS, F.col("bin").alias("time")).distinct(), "touched")
    # one window a deployment, from the first to the last day concerned; only bins of such days go on
    days = touched.select(*KEYS, F.to_date("time").alias("date")).distinct()
    ends = days.groupBy(*KEYS).agg(F.min("date").cast("timestamp_ntz").alias("a"), (F.max("date").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("b"))
    windows = ends.join(spans, KEYS).select(
        *KEYS, F.greatest(F.col("a") + F.col("phase"), "first_bin").alias("bin_start"), F.least(F.col("b") + F.col("phase"), "last_bin_end").alias("bin_end"))
    runs = materialize(with_run_constants(bin_grid(windows), stations, declinations, alpha_date), "late-runs")
    samples = [t.read(window_zones(t, runs)) for t in (met, wave)]
    samples = [t.read().limit(0) if s is None else s for s, t in zip(samples, (met, wave))]
    binned = apply_qc(bin_observations(*samples, runs)).withColumn("date", F.to_date("time"))
    observed = materialize(binned.join(days, [*KEYS, "date"], "left_semi").drop("date"), "late-bins")
    files = None
    if out_path is not None:
        moment = F.lit((as_of or datetime.now(timezone.utc)).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
        day, station = F.to_date("time"), F.col("station_id")
        named = observed.join(runs.select(*KEYS, "station_id", "sensor_depth_m"), KEYS).withColumn(
            "file_name", text.daily_file_name(station, day, text.day_file_hour(day, moment)))
        path = F.concat_ws("/", "site", "deployment", "file_name").alias("file")
        texts = bulletin_files(named, run_days(runs)).select("*", path)
        files = written_files(spark, out_path, write_text_files(texts, out_path, encoding=text.ENCODING))
    seen.write(now, number)
    return Reissued(observed.join(touched, [*KEYS, "time"], "left_semi"), files)
