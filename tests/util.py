"""Small builders shared by the tests."""

from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.timegrid import epoch_to_ts
from tidewright.model import DECLINATION_SCHEMA, KEYS, MET_FIELDS, WAVE_FIELDS, local_table, stations
from tidewright.operators.bounds import bin_grid, with_run_constants

T0 = datetime(2026, 1, 1)

MET_DEFAULTS = {
    "eastward_wind_velocity": 3.0, "northward_wind_velocity": 4.0, "barometric_pressure": 1013.0,
    "air_temperature": 15.0, "relative_humidity": 75.0, "shortwave_irradiance": 200.0,
    "longwave_irradiance": 350.0, "sea_surface_temperature": 12.0, "sea_surface_conductivity": 3.5,
    "precipitation_level": 0.0,
}
WAVE_DEFAULTS = {
    "significant_wave_height": 1.5, "maximum_wave_height": 2.0, "peak_period": 10.0,
    "average_wave_period": 8.0, "mean_wave_direction": 270.0,
}


def epoch(moment: datetime) -> float:
    return (moment - datetime(1970, 1, 1)).total_seconds()


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def _frame(spark, rows, fields, defaults) -> DataFrame:
    """``rows`` are dicts with ``time`` (datetime) and any of site, deployment, fields."""
    full = [
        (r.get("site", "CE02"), r.get("deployment", "D00001"), epoch(r["time"]),
         *[r.get(f, defaults[f]) for f in fields[1:]])
        for r in rows
    ]
    schema = "site string, deployment string, " + ", ".join(f"{f} double" for f in fields)
    df = spark.createDataFrame(full, schema)
    return df.withColumn("time", epoch_to_ts(F.col("time")))


def met_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return _frame(spark, rows, MET_FIELDS, MET_DEFAULTS)


def wave_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return _frame(spark, rows, WAVE_FIELDS, WAVE_DEFAULTS)


def declinations(spark: SparkSession, degrees: float = 0.0, rate: float = 0.0) -> DataFrame:
    sites = ["CE02", "CE04", "CE07", "CE09"]
    return local_table(spark, [(s, "2026-01-01 00:00:00", degrees, rate) for s in sites], DECLINATION_SCHEMA)


def window_runs(spark, start: datetime, end: datetime, keys=(("CE02", "D00001"),), alpha=0.0) -> DataFrame:
    """Runs over a fixed window."""
    windows = spark.createDataFrame(
        [(*k, start, end) for k in keys], "site string, deployment string, bin_start timestamp_ntz, bin_end timestamp_ntz"
    )
    return with_run_constants(bin_grid(windows), stations(spark), declinations(spark, alpha))


def by_time(df: DataFrame) -> pd.DataFrame:
    rows = df.orderBy(*KEYS, "time").collect()
    return pd.DataFrame([r.asDict() for r in rows], columns=df.columns)
