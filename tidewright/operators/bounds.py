"""Run bounds per deployment: where a run starts, where it ends, its constants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.declination import declination_at
from tidewright.functions.seawater import pressure_from_depth
from tidewright.functions.timegrid import floor_to, floor_to_bin
from tidewright.model import BIN, KEYS


def data_bounds(met: DataFrame) -> DataFrame:
    """First and last meteorological time stamp per deployment."""
    return met.groupBy(*KEYS).agg(F.min("time").alias("earliest"), F.max("time").alias("latest"))


def fresh_bounds(extent: DataFrame) -> DataFrame:
    """Add the start of a first run and the end of any run.

    A first run starts one hour after the earliest sample, floored to 10 minutes;
    a run ends at the latest sample floored to the hour.
    """
    started = extent.withColumn("fresh_start", floor_to_bin(F.col("earliest") + F.expr("INTERVAL 1 HOUR")))
    return started.withColumn("bin_end", floor_to(F.col("latest"), "1 hour"))


def run_bounds(extent: DataFrame, progress: DataFrame | None = None) -> DataFrame:
    """Bins to process per deployment; deployments without a whole new bin drop out.

    ``progress`` holds one ``last_bin_end`` per deployment, NULL or absent where
    there is none.  Bins are anchored at ``bin_start``: ``phase`` is its offset
    from the clock's 10-minute grid and ``grid_end`` the last whole edge.
    """
    df = fresh_bounds(extent)
    if progress is None:
        df = df.withColumn("bin_start", F.col("fresh_start"))
    else:
        saved = progress.select(*KEYS, F.col("last_bin_end").alias("saved_end"))
        df = df.join(saved, KEYS, "left").withColumn("bin_start", F.coalesce("saved_end", "fresh_start"))
    return bin_grid(df).select(
        *KEYS, "earliest", "latest", "bin_start", "bin_end", "grid_end", "phase", "mid_date"
    )


def bin_grid(windows: DataFrame) -> DataFrame:
    """Bin geometry of windows ``[bin_start, bin_end)``; those without a whole bin drop out."""
    df = windows.filter("bin_end > bin_start")
    df = df.withColumn("phase", F.col("bin_start") - floor_to_bin(F.col("bin_start")))
    df = df.withColumn("grid_end", floor_to_bin(F.col("bin_end") - F.col("phase")) + F.col("phase"))
    middle = F.col("bin_start") + (F.col("bin_end") - F.col("bin_start")) / 2
    return df.filter("grid_end > bin_start").withColumn("mid_date", middle)


def with_declination(df: DataFrame, declinations: DataFrame, date: Column) -> DataFrame:
    """Add ``alpha_deg`` for ``date`` from the declination table: of a site's reference dates the last one not after ``date``.

    Where all lie after it the first one counts.  An as-of join by union: rows and references are sorted together within
    a site's day; the last reference of earlier days comes from a summary with one row for each site and day that
    occurs.  So neither a long table of references nor a site with many rows meets in one task.
    """
    fields = ["ref_date", "decl_deg", "rate_deg_per_year"]
    ref = F.struct(*fields)
    # one name that no column of ``df`` has
    at, day, found, row = (next(f"{n}{'_' * k}" for k in range(99) if f"{n}{'_' * k}" not in df.columns) for n in ("_at", "_day", "_ref", "_row"))
    rows = df.select("site", date.alias(at), F.lit(None).cast(_ref_type()).alias(found), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row))
    refs = declinations.select("site", F.col("ref_date").alias(at), ref.cast(_ref_type()).alias(found), F.lit(None).cast(rows.schema[row].dataType).alias(row))
    both = rows.union(refs).withColumn(day, F.to_date(at))
    so_far = Window.partitionBy("site", day).orderBy(F.col(at).asc_nulls_first(), F.col(row).isNotNull())
    inside = both.withColumn("_inside", F.last(found, ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
    days = both.groupBy("site", day).agg(F.max(found).alias("_last"))
    earlier = Window.partitionBy("site").orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("site", day, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    first = declinations.groupBy("site").agg(F.min(ref.cast(_ref_type())).alias("_first"))
    best = F.coalesce("_inside", "_carried", "_first")
    placed = (
        inside.where(F.col(row).isNotNull()).alias("i")
        .join(carried.alias("c"), F.expr(f"i.site <=> c.site AND i.{day} <=> c.{day}"), "left")
        .join(first.alias("f"), F.expr("i.site = f.site"), "left")
        .select(f"i.{row}", F.when(F.col(f"i.{at}").isNotNull(), best).alias("_best"), F.col(f"i.{at}").alias("_date"))
    )
    alpha = declination_at(F.col("_best.decl_deg"), F.col("_best.rate_deg_per_year"), F.col("_best.ref_date"), F.col("_date"))
    return placed.select(f"{row}.*", alpha.alias("alpha_deg"))


def _ref_type() -> str:
    return "struct<ref_date:timestamp_ntz,decl_deg:double,rate_deg_per_year:double>"


def with_run_constants(
    bounds: DataFrame,
    stations: DataFrame,
    declinations: DataFrame,
    alpha_date: Column | None = None,
) -> DataFrame:
    """Add the station's identity, pressure and rotation to the bounds.

    One rotation per run: the declination at the middle of the window, or at
    ``alpha_date`` where given.
    """
    date = F.col("mid_date") if alpha_date is None else F.coalesce(alpha_date, F.col("mid_date"))
    alpha = F.radians("alpha_deg")
    return (
        with_declination(bounds.join(stations, "site"), declinations, date)
        .withColumn("cos_a", F.cos(alpha))
        .withColumn("sin_a", F.sin(alpha))
        .withColumn("pressure_dbar", pressure_from_depth("sensor_depth_m", "latitude"))
    )


#: Days of bins that one task of the spine makes (144 bins each).
SPINE_DAYS = 5_000


def run_days(bounds: DataFrame) -> int:
    """Days that the runs of ``bounds`` touch, at most one too many each."""
    days = F.date_diff(F.to_date("grid_end"), F.to_date("bin_start")) + 1
    return bounds.agg(F.coalesce(F.sum(days), F.lit(0))).first()[0]


def bin_spine(bounds: DataFrame) -> DataFrame:
    """One row per bin of every run: left edges from ``bin_start`` to ``grid_end``.

    ``bounds`` should be a stored table, as its days are counted first: they are dealt out to tasks by key and
    day, and become bins only there.
    """
    ten, day = F.expr(f"INTERVAL {BIN}"), F.expr("INTERVAL 1 DAY")
    days = bounds.select(
        *KEYS, "phase", "bin_start", "grid_end", F.explode(F.sequence("bin_start", F.col("grid_end") - ten, day)).alias("from"))
    dealt = days.repartition(max(1, -(-run_days(bounds) // SPINE_DAYS)), *KEYS, "from")
    last = F.least(F.col("from") + day, F.col("grid_end")) - ten
    return dealt.select(*KEYS, "phase", F.explode(F.sequence("from", last, ten)).alias("time"))
