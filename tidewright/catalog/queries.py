"""Registered queries: each operator over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.catalog import fixtures
from tidewright.functions import text
from tidewright.functions.declination import declination_angle
from tidewright.functions.seawater import add_practical_salinity, pressure_from_depth
from tidewright.functions.timegrid import epoch_to_ts, interval_seconds
from tidewright.functions.vectors import add_direction_from, rotate_wave_dir, rotate_wind, wind_speed
from tidewright.model import (
    BINNED_FIELDS, DECLINATION_SCHEMA, KEYS, MET_FIELDS, MET_SHIFT_MINUTES, PROGRESS_SCHEMA, WAVE_FIELDS,
    WAVE_SHIFT_MINUTES, local_table, stations,
)
from tidewright.operators import bins, bounds
from tidewright.operators.bounds import bin_spine, run_days, with_declination
from tidewright.operators.bulletin import bulletin_files, file_names
from tidewright.operators.dedup import first_per_key
from tidewright.operators.qc import apply_qc
from tidewright.operators.rain import rain_rate
from tidewright.plans import progress as progress_log
from tidewright.plans.late import reissue_late
from tidewright.plans.run import observations, plan_runs
from tidewright.session import materialize, scratch_path
from tidewright.sinks.text_files import write_text_files, written_files
from tidewright.sources import array_json, events
from tidewright.sources.landed import LandedTable, land
from tidewright.streaming.bins import collect_available, stream_bins
from tidewright.streaming.landing import land_new_files, rejected_files
from tidewright.streaming.series import stream_series

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Decimals kept of computed doubles.
DIGITS = 6


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.expr(f"round({c}, {DIGITS})") for c in columns})


def declinations(spark: SparkSession) -> DataFrame:
    return local_table(spark, fixtures.DECLINATIONS, DECLINATION_SCHEMA)


def progress(spark: SparkSession) -> DataFrame:
    return local_table(spark, fixtures.PROGRESS, PROGRESS_SCHEMA)


def as_of() -> Column:
    return F.lit(fixtures.AS_OF).cast("timestamp_ntz")


def fresh_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    met, wave = events.raw_met(spark, sf_dir), events.raw_wave(spark, sf_dir)
    return plan_runs(met, wave, stations(spark), declinations(spark))


def resumed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    met, wave = events.raw_met(spark, sf_dir), events.raw_wave(spark, sf_dir)
    return plan_runs(met, wave, stations(spark), declinations(spark), progress(spark))


def met_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples unique per time stamp, stored: means and rain both read them, and each would de-duplicate anew."""
    return materialize(events.met_samples(spark, sf_dir), "met")


def binned(spark: SparkSession, sf_dir: str, runs: DataFrame, rain: bool = True) -> DataFrame:
    met = met_unique(spark, sf_dir) if rain else events.met_samples(spark, sf_dir)
    return bins.bin_observations(met, events.wave_samples(spark, sf_dir), runs, rain)


# ---- the whole run ---------------------------------------------------------------


@query("flagship")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality-checked bins of all stations since their last run, with file names."""
    runs = materialize(resumed_runs(spark, sf_dir), "runs")
    met, wave = met_unique(spark, sf_dir), events.wave_samples(spark, sf_dir)
    named = file_names(observations(met, wave, runs), runs, as_of())
    return rounded(named.select("site", "station_id", "file_name", "time", *BINNED_FIELDS), BINNED_FIELDS)


# ---- sources ---------------------------------------------------------------------

#: What is wrong with one raw file in so many, by the number of its hour.
RAGGED_EVERY, WRONG_EVERY = 4, 16


def write_raw_files(
    spark: SparkSession, samples: DataFrame, fields: list[str], instrument: str, *, suffix: str | None = None, ragged: bool = False,
    wrong: bool = False, root: str | None = None,
) -> str:
    """Store samples as raw JSON files, one a station and hour; returns their root.

    With ``ragged``, one file in four lacks a column, one has a short column and
    one a short time column.  With ``wrong``, of 16 files one is cut off, one has no columns, one holds text, one a short column and
    one comes from an unknown mooring.
    """
    st = stations(spark).select("site", "mooring")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = interval_seconds(F.col("time") - epoch)
    numbered = samples.withColumn("file_no", F.floor(seconds / 3600))
    sample = F.struct("event_id", seconds.alias("time"), *fields[1:])
    grouped = numbered.groupBy("site", "deployment", "file_no").agg(F.sort_array(F.collect_list(sample)).alias("s"))
    arrays = {f: F.col("s")[f] for f in fields}
    short = lambda f: F.slice(arrays[f], 1, F.size("s") - 1)
    if ragged:
        kind = F.col("file_no") % RAGGED_EVERY
        arrays["precipitation_level"] = F.when(kind != 1, arrays["precipitation_level"])
        for f, k in (("air_temperature", 2), ("time", 3)):
            arrays[f] = F.when(kind == k, short(f)).otherwise(arrays[f])
    kind = F.col("file_no") % WRONG_EVERY if wrong else F.lit(-1)
    arrays[fields[1]] = F.when(kind == 3, short(fields[1])).otherwise(arrays[fields[1]])
    content = F.to_json(F.struct(*[arrays[f].alias(f) for f in fields]))
    content = (
        F.when(kind == 0, F.concat(F.lit('{"time": ['), F.col("file_no"))).when(kind == 1, "{}")
        .when(kind == 2, F.concat(F.lit('{"time": ["noon"], "more": '), F.col("file_no"), F.lit("}"))).otherwise(content)
    )
    mooring = F.when(kind == 4, F.concat(F.lit("x"), F.col("mooring"))).otherwise(F.col("mooring"))
    files = grouped.join(st, "site").select(
        F.format_string(f"%s/%s/buoy/{instrument}/%08d.{suffix or instrument}.json", mooring, "deployment", "file_no").alias("file"), content.alias("content"))
    root = root or scratch_path(spark, "raw-files")
    write_text_files(files, root)
    return root


@query("ingest_json")
def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_raw_files(spark, events.raw_met(spark, sf_dir), MET_FIELDS, "metbk")
    return array_json.load_met(spark, root, stations(spark)).select(*KEYS, *MET_FIELDS)


@query("ingest_wave_json")
def ingest_wave_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wave samples, moved to the middle of their cycle; files of the other instrument in the same folders do not count."""
    root = write_raw_files(spark, events.raw_wave(spark, sf_dir), WAVE_FIELDS, "wavss")
    write_raw_files(spark, events.raw_met(spark, sf_dir), MET_FIELDS, "wavss", suffix="metbk", root=root)
    moved = array_json.shifted_wave(array_json.load_wave(spark, root, stations(spark)))
    return rounded(moved.select(*KEYS, *WAVE_FIELDS), WAVE_FIELDS[1:])


@query("ragged_arrays")
def ragged_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_raw_files(spark, events.raw_met(spark, sf_dir), MET_FIELDS, "metbk", ragged=True)
    files = array_json.read_files(spark, f"{root}/*/*/buoy/metbk", "*.json", MET_FIELDS)
    rows = array_json.samples(files, MET_FIELDS, stations(spark))
    return rows.select(*KEYS, "pos", *MET_FIELDS)


def _land(spark: SparkSession, root: str, landed: str) -> int:
    return land_new_files(spark, root, "metbk", stations(spark), landed, f"{landed}-seen", f"{landed}-rejected")


@query("rejected_files")
def rejected_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What keeps files, or columns of them, from being landed, by two calls over the same files."""
    root = write_raw_files(spark, events.raw_met(spark, sf_dir), MET_FIELDS, "metbk", wrong=True)
    landed = scratch_path(spark, "landed")
    _land(spark, root, landed)
    _land(spark, root, landed)
    told = rejected_files(spark, landed, f"{landed}-rejected")
    return told.select(F.regexp_extract("file_path", r"([^/]+/[^/]+)/buoy/metbk/([^/]+)$", 1).alias("folder"), F.regexp_extract("file_path", r"[^/]+$", 0).alias("file"), "reason")


def _landed_twice(spark: SparkSession, sf_dir: str) -> LandedTable:
    """All samples, landed by two calls: those of even ids first."""
    met = events.raw_met(spark, sf_dir)
    root = write_raw_files(spark, met.where("event_id % 2 = 0"), MET_FIELDS, "metbk")
    landed = scratch_path(spark, "landed")
    _land(spark, root, landed)
    write_raw_files(spark, met.where("event_id % 2 = 1"), MET_FIELDS, "metbk", suffix="late", root=root)
    _land(spark, root, landed)
    return LandedTable(spark, landed)


@query("landed_bounds")
def landed_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last time and rows of each landed day, from the manifest."""
    days = _landed_twice(spark, sf_dir).zones().groupBy(*KEYS, "date")
    return days.agg(F.min("min_time").alias("first_time"), F.max("max_time").alias("last_time"), F.sum("rows").alias("n"))


@query("compacted_samples")
def compacted_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed samples after compaction, and the batches that hold their day."""
    table = _landed_twice(spark, sf_dir)
    table.compact()
    batches = table.zones().groupBy(*KEYS, "date").agg(F.count("*").alias("n_batches"))
    return table.read().join(batches, [*KEYS, "date"]).select(*KEYS, "n_batches", *MET_FIELDS)


@query("met_stream")
def met_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.met_samples(spark, sf_dir).select(*KEYS, *MET_FIELDS)


@query("wave_stream")
def wave_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = array_json.shifted_wave(events.wave_samples(spark, sf_dir)).select(*KEYS, *WAVE_FIELDS)
    return rounded(moved, WAVE_FIELDS[1:])


@query("station_dim")
def station_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations with the extent of their data."""
    seen = events.read_events(spark, sf_dir).groupBy("site").agg(
        F.count("*").alias("n_samples"), F.min("time").alias("first_time"), F.max("time").alias("last_time")
    )
    return seen.join(stations(spark), "site")


@query("dedup_first")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First sample per station and minute, by ``event_id``."""
    minute = events.raw_met(spark, sf_dir).withColumn("time", F.window("time", "1 minute")["start"])
    return first_per_key(minute, ["time", *KEYS], ["event_id"]).select(*KEYS, "time", "event_id", *MET_FIELDS[1:])


# ---- scalar functions --------------------------------------------------------------


@query("epoch_to_ts")
def epoch_to_ts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    seconds = F.col("event_id") * 0.25 + 1.7e9
    broken = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(seconds)
    return e.select("event_id", epoch_to_ts(broken).alias("time"))


def _wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.raw_met(spark, sf_dir).select(
        "event_id", F.col("eastward_wind_velocity").alias("u"), F.col("northward_wind_velocity").alias("v"),
        (F.col("event_id") % 720 - 360.0).alias("alpha"),
    )


@query("rotate_wind")
def rotate_wind_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, v = rotate_wind(F.col("u"), F.col("v"), F.col("alpha"))
    out = _wind(spark, sf_dir).select("event_id", u.alias("u_true"), v.alias("v_true"))
    return rounded(out, ["u_true", "v_true"]).withColumns({c: F.col(c) + 0.0 for c in ("u_true", "v_true")})


@query("wind_speed")
def wind_speed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        _wind(spark, sf_dir).select("event_id", wind_speed(F.col("u"), F.col("v")).alias("wind_speed")), ["wind_speed"]
    )


@query("wind_direction")
def wind_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = add_direction_from(_wind(spark, sf_dir), "u", "v", "wind_dir")
    return rounded(out.select("event_id", "wind_dir"), ["wind_dir"])


def _waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    vectors = rotate_wave_dir(F.col("mean_wave_direction"), F.col("alpha"))
    return (
        events.raw_wave(spark, sf_dir)
        .select("event_id", "mean_wave_direction", (e % 720 - 360.0).alias("alpha"))
        .select("event_id", vectors[0].alias("u"), vectors[1].alias("v"))
    )


@query("rotate_wave_dir")
def rotate_wave_dir_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rounded(_waves(spark, sf_dir), ["u", "v"])
    return out.select("event_id", (F.col("u") + 0.0).alias("u_true"), (F.col("v") + 0.0).alias("v_true"))


@query("wave_direction")
def wave_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direction of the rotated unit vectors, kept off the 0/360 seam by half a degree."""
    e = F.col("event_id")
    turned = rotate_wave_dir(F.col("mean_wave_direction") + 0.5, e % 360 * 1.0)
    vectors = events.raw_wave(spark, sf_dir).select("event_id", turned[0].alias("u"), turned[1].alias("v"))
    return rounded(add_direction_from(vectors, "u", "v", "wave_dir").select("event_id", "wave_dir"), ["wave_dir"])


@query("salinity")
def salinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salinity over fresh, brackish and sea water, at depths down to 10 m."""
    e = F.col("event_id")
    samples = events.raw_met(spark, sf_dir).select(
        "event_id",
        F.when(e % 5 == 0, (e % 40) * 0.01).otherwise(F.col("sea_surface_conductivity")).alias("conductivity"),
        F.col("sea_surface_temperature").alias("temperature"),
        ((e % 40) * 0.25).alias("pressure"),
    )
    out = add_practical_salinity(samples, "conductivity", "temperature", "pressure")
    return rounded(out.select("event_id", "salinity"), ["salinity"])


@query("station_pressure")
def station_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pressure of a sensor at varying depth at each sample's station."""
    samples = events.raw_met(spark, sf_dir).select("event_id", "site", (F.col("event_id") % 80 * 0.25).alias("depth_m"))
    out = samples.join(stations(spark).select("site", "latitude"), "site").withColumn(
        "pressure_dbar", pressure_from_depth("depth_m", "latitude")
    )
    return rounded(out.select("event_id", "site", "depth_m", "pressure_dbar"), ["pressure_dbar"])


@query("declination_angle")
def declination_angle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    east, north = F.col("event_id") % 9001 - 4500.0, F.col("event_id") % 18007 + 1000.0
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rounded(e.select("event_id", declination_angle(east, north).alias("decl_deg")), ["decl_deg"])


@query("declination_lookup")
def declination_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declination at each sample's date, and at a fixed date."""
    samples = events.read_events(spark, sf_dir).select("event_id", "site", "time")
    fixed = F.coalesce(F.lit(fixtures.ALPHA_DATE).cast("timestamp_ntz"), F.col("time"))
    own = with_declination(samples, declinations(spark), F.col("time")).withColumnRenamed("alpha_deg", "own_deg")
    both = with_declination(own, declinations(spark), fixed).withColumnRenamed("alpha_deg", "fixed_deg")
    return rounded(both.select("event_id", "site", "own_deg", "fixed_deg"), ["own_deg", "fixed_deg"])


@query("format_values")
def format_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-decimal text of values that often fall on rounding ties."""
    e = F.col("event_id")
    x = (
        F.when(e % 50 == 0, F.lit(float("nan")))
        .when(e % 50 == 1, F.lit(float("inf")))
        .when(e % 50 == 2, F.lit(None))
        .when(e % 2 == 0, (e * 10 + 5) / 1e7)
        .otherwise(F.col("value") / 128.0 - 1.0)
    )
    events_ = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", x.alias("x"))
    return events_.select("event_id", text.format_value("x").alias("text"), text.tag("wspd1", "x").alias("tag"))


# ---- bounds and progress -------------------------------------------------------------

RUN_COLUMNS = ["site", "earliest", "latest", "bin_start", "bin_end", "grid_end", "mid_date"]


def _runs(df: DataFrame) -> DataFrame:
    out = df.select(*RUN_COLUMNS, "station_id", "alpha_deg", "pressure_dbar")
    return rounded(out, ["alpha_deg", "pressure_dbar"])


@query("run_bounds")
def run_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(fresh_runs(spark, sf_dir))


@query("resume_bounds")
def resume_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(resumed_runs(spark, sf_dir))


# ---- windows, bins and joins -----------------------------------------------------------


@query("rain_rate")
def rain_rate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    met = events.met_samples(spark, sf_dir).select(*KEYS, "time", "event_id", "precipitation_level")
    return rain_rate(met).select("site", "event_id", "time", "precipitation_level", "rain_rate")


@query("bin_spine")
def bin_spine_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_spine(materialize(resumed_runs(spark, sf_dir), "runs")).select("site", "time")


def _met_rows(spark: SparkSession, sf_dir: str, runs: DataFrame) -> DataFrame:
    placed = bins.place(events.met_samples(spark, sf_dir), runs, MET_SHIFT_MINUTES)
    return bins.met_variables(placed.filter("inside"))


def _wave_rows(spark: SparkSession, sf_dir: str, runs: DataFrame) -> DataFrame:
    placed = bins.place(events.wave_samples(spark, sf_dir), runs, WAVE_SHIFT_MINUTES)
    return bins.wave_variables(placed.filter("inside"))


@query("bin_means")
def bin_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-empty meteorological bins."""
    runs = materialize(resumed_runs(spark, sf_dir), "runs")
    values = [c for c in bins.MET_MEANS if c not in ("wind_u", "wind_v")]
    return rounded(bins.bin_means([_met_rows(spark, sf_dir, runs)], values).drop("deployment"), values)


@query("met_wave_join")
def met_wave_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins with a sample of either instrument."""
    runs = materialize(fresh_runs(spark, sf_dir), "runs")
    values = ["wind_speed", "baro", "sig_wave_hgt", "max_wave_hgt", "peak_period", "avg_period"]
    both = bins.bin_means([_met_rows(spark, sf_dir, runs), _wave_rows(spark, sf_dir, runs)], values)
    return rounded(both.drop("deployment"), values)


@query("vector_mean_dir")
def vector_mean_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directions of the mean vectors of each bin."""
    runs = materialize(fresh_runs(spark, sf_dir), "runs")
    values = ["wind_speed", "wind_u", "wind_v", "wave_u", "wave_v"]
    both = bins.bin_means([_met_rows(spark, sf_dir, runs), _wave_rows(spark, sf_dir, runs)], values)
    dirs = bins.recover_directions(both).select("site", "time", "wind_dir", "wave_dir")
    return rounded(dirs, ["wind_dir", "wave_dir"])


@query("gap_fill")
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air temperature of every bin of the run, gaps included."""
    runs = materialize(resumed_runs(spark, sf_dir), "runs")
    spine = bin_spine(runs).withColumn("cell", F.col("time") - F.col("phase")).select(*bins.GROUP)
    filled = bins.bin_means([_met_rows(spark, sf_dir, runs), spine], ["air_temp"])
    return rounded(filled.drop("deployment"), ["air_temp"])


@query("binned_obs")
def binned_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every variable of every bin of a first run, before the range checks."""
    runs = materialize(fresh_runs(spark, sf_dir), "runs")
    return rounded(binned(spark, sf_dir, runs).drop("deployment"), BINNED_FIELDS)


@query("apply_qc")
def apply_qc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range checks on single samples of both instruments."""
    e = F.col("event_id")
    met = events.raw_met(spark, sf_dir).select(
        "event_id",
        wind_speed(F.col("eastward_wind_velocity") * 6, F.col("northward_wind_velocity") * 6).alias("wind_speed"),
        F.col("barometric_pressure").alias("baro"), F.col("air_temperature").alias("air_temp"),
        F.col("relative_humidity").alias("rel_humidity"), F.col("shortwave_irradiance").alias("shortwave"),
        F.when(e % 7 == 0, F.lit(float("nan"))).otherwise(F.col("longwave_irradiance") * 5).alias("longwave"),
        F.col("sea_surface_temperature").alias("sst"), (e % 60).cast("double").alias("salinity"),
    )
    wave = events.raw_wave(spark, sf_dir).select(
        "event_id", F.col("significant_wave_height").alias("sig_wave_hgt"),
        F.col("maximum_wave_height").alias("max_wave_hgt"), "peak_period",
        F.col("average_wave_period").alias("avg_period"), (F.col("mean_wave_direction") * 1.5 - 60).alias("wave_dir"),
    )
    checked = apply_qc(met.unionByName(wave, allowMissingColumns=True))
    return rounded(checked, [c for c in checked.columns if c != "event_id"])


# ---- bulletins ----------------------------------------------------------------------------


def _named(spark: SparkSession, sf_dir: str, runs: DataFrame) -> DataFrame:
    return file_names(apply_qc(binned(spark, sf_dir, runs, rain=False)), runs, as_of())


@query("messages")
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = materialize(resumed_runs(spark, sf_dir), "runs")
    block = text.message(F.col("station_id"), F.col("time"), F.col("sensor_depth_m"))
    return _named(spark, sf_dir, runs).select("site", "time", block.alias("message"))


@query("bulletin_header")
def bulletin_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header of each station's and day's file."""
    days = bin_spine(materialize(fresh_runs(spark, sf_dir), "runs")).groupBy("site", F.to_date("time").alias("day"))
    last = days.agg(F.max("time").alias("last_time"))
    return last.select("site", "day", text.bulletin_header(F.col("last_time")).alias("header"))


@query("file_names")
def file_names_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of file name for each station and day of data."""
    days = events.read_events(spark, sf_dir).select("site", F.to_date("time").alias("day")).distinct()
    named = days.join(stations(spark), "site")
    daily = text.daily_file_name(F.col("station_id"), F.col("day"), text.day_file_hour(F.col("day"), as_of()))
    moment = F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 7 HOURS")
    return named.select("site", "day", daily.alias("daily_name"), text.file_name(F.col("station_id"), moment).alias("run_name"))


@query("daily_split")
def daily_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a first run: one per station and day."""
    runs = materialize(fresh_runs(spark, sf_dir), "runs")
    named = _named(spark, sf_dir, runs)
    return named.groupBy("site", "station_id", "file_name").agg(
        F.count("*").alias("n_messages"), F.min("time").alias("first_time"), F.max("time").alias("last_time"),
        F.count("sst").alias("n_sst"), F.count("sig_wave_hgt").alias("n_waves"),
    )


@query("bulletin_files")
def bulletin_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every file of a resumed run."""
    runs = materialize(resumed_runs(spark, sf_dir), "runs")
    return bulletin_files(_named(spark, sf_dir, runs), run_days(runs)).drop("deployment")


@query("published_files")
def published_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the files of a resumed run, as written."""
    runs = materialize(resumed_runs(spark, sf_dir), "runs")
    files = bulletin_files(_named(spark, sf_dir, runs), run_days(runs))
    out = scratch_path(spark, "published")
    manifest = write_text_files(files.select(F.concat_ws("/", "site", "file_name").alias("file"), "content"), out, encoding=text.ENCODING)
    return written_files(spark, out, manifest)


# ---- streaming -----------------------------------------------------------------------------


@query("stream_bins")
def stream_bins_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed bins of the event stream; rain is left to the batch run."""
    runs = materialize(fresh_runs(spark, sf_dir), "runs")
    stream = events.event_stream(spark, sf_dir)
    met, wave = events.as_met(stream), events.as_wave(stream)
    closed = collect_available(stream_bins(met, wave, runs)).drop("deployment")
    return rounded(closed, [f for f in BINNED_FIELDS if f != "rain_rate"])


@query("stream_bins_copies")
def stream_bins_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a stream that holds every tenth event twice."""
    runs = materialize(fresh_runs(spark, sf_dir), "runs")
    stream = events.event_stream(spark, sf_dir)
    twice = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    copied = stream.withColumn("copy", F.explode(twice)).drop("copy")
    closed = collect_available(stream_bins(events.as_met(copied), events.as_wave(copied), runs)).drop("deployment")
    return rounded(closed, [f for f in BINNED_FIELDS if f != "rain_rate"])


@query("stream_rain")
def stream_rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rain of the closed bins of the event stream, empty ones included."""
    runs = materialize(fresh_runs(spark, sf_dir), "runs")
    series = collect_available(stream_series(events.as_met(events.event_stream(spark, sf_dir)), runs))
    return rounded(series.drop("deployment"), ["rain_rate"])


@query("stream_gap_fill")
def stream_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air temperature of every closed bin of the stream, gaps included."""
    runs = materialize(fresh_runs(spark, sf_dir), "runs")
    met, wave = (f(events.event_stream(spark, sf_dir)) for f in (events.as_met, events.as_wave))
    every = collect_available(stream_series(met, runs)).select(*KEYS, "time")
    closed = collect_available(stream_bins(met, wave, runs)).select(*KEYS, "time", "air_temp")
    return rounded(every.join(closed, [*KEYS, "time"], "left").drop("deployment"), ["air_temp"])


@query("stream_anchored")
def stream_anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed bins of deployments anchored 0, 3, 7 and 0 minutes off the clock's grid."""
    minutes_off = F.when(F.col("site") == "CE04", 3).when(F.col("site") == "CE07", 7).otherwise(0)
    runs = fresh_runs(spark, sf_dir).withColumn("phase", F.make_dt_interval(F.lit(0), F.lit(0), minutes_off, F.lit(0)))
    met, wave = (f(events.event_stream(spark, sf_dir)) for f in (events.as_met, events.as_wave))
    closed = collect_available(stream_bins(met, wave, materialize(runs, "runs"))).drop("deployment")
    return rounded(closed.select("site", "time", "baro", "wind_speed", "sig_wave_hgt", "peak_period"), ["baro", "wind_speed", "sig_wave_hgt", "peak_period"])


@query("late_bins")
def late_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins that one meteorological sample in fifty, landed after all bins were issued, changes."""
    met, wave = events.met_samples(spark, sf_dir), events.wave_samples(spark, sf_dir)
    tables = [LandedTable(spark, scratch_path(spark, "late")) for _ in range(2)]
    early = met.where("event_id % 50 <> 0")
    land(early, tables[0].path)
    land(wave, tables[1].path)
    ends = bounds.fresh_bounds(bounds.data_bounds(early)).select(
        *KEYS, F.col("bin_end").alias("last_bin_end"), F.lit(1).cast("bigint").alias("run_id"), F.lit(False).alias("cleared"))
    issued = materialize(ends, "issued")
    late = scratch_path(spark, "late")
    again = lambda: reissue_late(spark, *tables, stations(spark), declinations(spark), issued, late)
    again()
    land(met.where("event_id % 50 = 0"), tables[0].path)
    changed = again()
    values = ["baro", "air_temp", "wind_speed", "rain_rate", "sig_wave_hgt"]
    if changed is None:
        return spark.createDataFrame([], f"site string, time timestamp_ntz, {', '.join(f'{v} double' for v in values)}")
    return rounded(changed.bins.select("site", "time", *values), values)


@query("cleared_bounds")
def cleared_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each deployment resumes after one of two deployments of a site was cleared; half the events of a site are in each."""
    deployment = F.when(F.col("event_id") % 2 == 0, "D00001").otherwise("D00002")
    met = events.raw_met(spark, sf_dir).withColumn("deployment", deployment)
    extent = bounds.data_bounds(met)
    run_id = lambda n: F.lit(n).cast("bigint").alias("run_id")
    done = extent.select(*KEYS, (F.col("earliest") + F.expr("INTERVAL 3 HOURS")).alias("last_bin_end"), run_id(1), F.lit(False).alias("cleared"))
    path = scratch_path(spark, "progress")
    progress_log.append_progress(done, path)
    progress_log.clear_progress(spark, path, 2, sites=["CE02", "CE07"], deployments=["D00002"])
    runs = bounds.run_bounds(extent, progress_log.latest_progress(progress_log.read_progress(spark, path)))
    return runs.select(*KEYS, "bin_start", "bin_end", "grid_end")
