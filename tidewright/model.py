"""Data model: schemas, the station dimension, quality bounds, bin geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: One deployment of one station; all time series are kept apart by this key.
KEYS = ["site", "deployment"]

BIN = "10 minutes"
BIN_MINUTES = 10

# ---- fixed values: names of the raw variables of each instrument -------------
MET_FIELDS = [
    "time",
    "air_temperature",
    "barometric_pressure",
    "eastward_wind_velocity",
    "northward_wind_velocity",
    "longwave_irradiance",
    "relative_humidity",
    "sea_surface_conductivity",
    "sea_surface_temperature",
    "shortwave_irradiance",
    "precipitation_level",
]
WAVE_FIELDS = [
    "time",
    "peak_period",
    "average_wave_period",
    "significant_wave_height",
    "maximum_wave_height",
    "mean_wave_direction",
]

# ---- fixed values: minutes added to the raw time stamps -----------------------
MET_SHIFT_MINUTES = 5
WAVE_SHIFT_MINUTES = -10

# ---- fixed values: stations (site, mooring, station_id, latitude, longitude) --
STATIONS = [
    ("CE02", "ce02shsm", "46097", 44.639, -124.304),
    ("CE04", "ce04ossm", "46098", 44.381, -124.956),
    ("CE07", "ce07shsm", "46099", 46.986, -124.566),
    ("CE09", "ce09ossm", "46100", 46.851, -124.972),
]
DEFAULT_SENSOR_DEPTH_M = 1.15

# ---- fixed values: inclusive quality bounds of the binned variables -----------
QC_BOUNDS = {
    "wind_dir": (0.0, 360.0),
    "wind_speed": (0.0, 60.0),
    "baro": (860.0, 1050.0),
    "air_temp": (-10.0, 30.0),
    "rel_humidity": (0.0, 100.0),
    "shortwave": (0.0, 2000.0),
    "longwave": (0.0, 2000.0),
    "sst": (0.0, 25.0),
    "salinity": (10.0, 40.0),
    "sig_wave_hgt": (0.0, 30.0),
    "max_wave_hgt": (0.0, 30.0),
    "peak_period": (0.0, 30.0),
    "avg_period": (0.0, 30.0),
    "wave_dir": (0.0, 360.0),
}

#: Value columns of the binned table, in output order.
BINNED_FIELDS = [
    "wind_speed",
    "baro",
    "air_temp",
    "rel_humidity",
    "shortwave",
    "longwave",
    "sst",
    "salinity",
    "rain_rate",
    "sig_wave_hgt",
    "max_wave_hgt",
    "peak_period",
    "avg_period",
    "wind_dir",
    "wave_dir",
]

STATION_SCHEMA = T.StructType(
    [
        T.StructField("site", T.StringType(), False),
        T.StructField("mooring", T.StringType(), False),
        T.StructField("station_id", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("sensor_depth_m", T.DoubleType(), False),
    ]
)

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("site", T.StringType(), False),
        T.StructField("deployment", T.StringType(), False),
        T.StructField("last_bin_end", T.TimestampNTZType(), True),
        T.StructField("run_id", T.LongType(), False),
        T.StructField("cleared", T.BooleanType(), False),
    ]
)

DECLINATION_SCHEMA = T.StructType(
    [
        T.StructField("site", T.StringType(), False),
        T.StructField("ref_date", T.TimestampNTZType(), False),
        T.StructField("decl_deg", T.DoubleType(), False),
        T.StructField("rate_deg_per_year", T.DoubleType(), False),
    ]
)


def stations(
    spark: SparkSession,
    rows: list[tuple] | None = None,
    sensor_depth_m: float = DEFAULT_SENSOR_DEPTH_M,
) -> DataFrame:
    """The station dimension; ``rows`` replaces the four built-in stations."""
    rows = STATIONS if rows is None else rows
    return local_table(spark, [(*r, float(sensor_depth_m)) for r in rows], STATION_SCHEMA)


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small table from driver values, of known size, so Spark may broadcast it.

    Timestamps are given as ISO strings.
    """
    names = ", ".join(f.name for f in schema)
    cells = rows or [(None,) * len(schema)]
    args = {f"r{i}_{f.name}": v for i, r in enumerate(cells) for f, v in zip(schema, r)}
    values = ", ".join(
        "(" + ", ".join(f"CAST(:r{i}_{f.name} AS {f.dataType.simpleString()})" for f in schema) + ")"
        for i in range(len(cells))
    )
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})", args=args)
    return table if rows else table.limit(0)


def array_schema(fields: list[str]) -> T.StructType:
    """Read schema of one raw file: an object of parallel arrays of doubles."""
    return T.StructType([T.StructField(f, T.ArrayType(T.DoubleType())) for f in fields])
