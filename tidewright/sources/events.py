"""Sensor samples read from the ``events`` test table.

``user_id % 4`` picks the station; views, clicks and errors are meteorological
samples, purchases and signups wave samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.model import KEYS, MET_FIELDS, STATIONS, WAVE_FIELDS
from tidewright.operators.dedup import first_per_key

DEPLOYMENT = "D00001"
MET_TYPES = ["view", "click", "error"]
WAVE_TYPES = ["purchase", "signup"]


EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def keyed(events: DataFrame) -> DataFrame:
    """Events with their station, deployment and time."""
    sites = F.array(*[F.lit(s[0]) for s in STATIONS])
    return events.withColumns(
        {
            "site": F.element_at(sites, (F.pmod(F.col("user_id"), F.lit(4)) + 1).cast("int")),
            "deployment": F.lit(DEPLOYMENT),
            "time": F.col("ts"),
            "k": F.get_json_object("props", "$.k").cast("double"),
        }
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", "events.parquet")
    return keyed(files.parquet(sf_dir))


def as_met(events: DataFrame) -> DataFrame:
    """Meteorological samples of keyed events."""
    values = {
        "air_temperature": "-15D + event_id % 50",
        "barometric_pressure": "850D + event_id % 211",
        "eastward_wind_velocity": "(event_id % 41 - 20) * 0.5D",
        "northward_wind_velocity": "(event_id % 29 - 14) * 0.5D",
        "longwave_irradiance": "250D + 2D * k",
        "relative_humidity": "CASE WHEN event_id % 23 <> 0 THEN k * 1.25D END",
        "sea_surface_conductivity": "2.5D + (event_id % 17) * 0.1D",
        "sea_surface_temperature": "CAST(event_id % 28 AS DOUBLE)",
        "shortwave_irradiance": "value * 5D",
        "precipitation_level": "(event_id % 100) * 0.25D",
    }
    chosen = events.filter(F.col("event_type").isin(MET_TYPES))
    return chosen.selectExpr(*KEYS, "time", "event_id", *[f"{values[f]} AS {f}" for f in MET_FIELDS[1:]])


def as_wave(events: DataFrame) -> DataFrame:
    """Wave samples of keyed events."""
    values = {
        "peak_period": "4D + k / 4D",
        "average_wave_period": "3D + k / 6D",
        "significant_wave_height": "value / 15D",
        "maximum_wave_height": "value / 10D",
        "mean_wave_direction": "CAST((event_id * 13) % 360 AS DOUBLE)",
    }
    chosen = events.filter(F.col("event_type").isin(WAVE_TYPES))
    return chosen.selectExpr(*KEYS, "time", "event_id", *[f"{values[f]} AS {f}" for f in WAVE_FIELDS[1:]])


def raw_met(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meteorological samples in arrival order (``event_id``), copies included."""
    return as_met(read_events(spark, sf_dir))


def raw_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wave samples in arrival order (``event_id``), copies included."""
    return as_wave(read_events(spark, sf_dir))


def met_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meteorological samples, the first one of each time stamp."""
    return first_per_key(raw_met(spark, sf_dir), ["time", *KEYS], ["event_id"])


def wave_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wave samples with raw time stamps, the first one of each."""
    return first_per_key(raw_wave(spark, sf_dir), ["time", *KEYS], ["event_id"])
