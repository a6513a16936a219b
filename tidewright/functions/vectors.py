"""Wind and wave vectors: rotation, speed and direction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rotate_by(u: Column, v: Column, cos_a: Column, sin_a: Column) -> tuple[Column, Column]:
    """Rotate ``(u, v)`` by an angle given by its cosine and sine."""
    return u * cos_a + v * sin_a, v * cos_a - u * sin_a


def rotate_wind(u: Column, v: Column, alpha_deg: Column) -> tuple[Column, Column]:
    """Rotate wind components by ``alpha_deg`` degrees."""
    a = F.radians(alpha_deg)
    return rotate_by(u, v, F.cos(a), F.sin(a))


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


#: Vectors shorter than this share of their scale have cancelled: what is left is rounding noise.
CALM = 1e-9


def add_direction_from(df: DataFrame, u: str, v: str, name: str, scale: Column | None = None) -> DataFrame:
    """Add the direction a flow comes from, in degrees clockwise from north, 0 to 360.

    Calm reads 180: both components zero, or, for mean vectors, a length of at most ``CALM`` times
    ``scale``, the mean length of what was averaged.  Without that rule the direction of vectors that cancel
    would depend on the order of summation.
    """
    calm = (F.col(u) == 0) & (F.col(v) == 0)
    if scale is not None:
        calm |= F.sqrt(F.col(u) * F.col(u) + F.col(v) * F.col(v)) <= CALM * scale
    deg = F.when(calm, F.lit(180.0)).otherwise(F.degrees(F.atan2(-F.col(u), -F.col(v))))
    return df.withColumn(name, deg).withColumn(name, F.col(name) + F.when(F.col(name) < 0, 360.0).otherwise(0.0))


def wave_unit_vector(mean_dir: Column) -> tuple[Column, Column]:
    """Unit vector of a wave direction given in degrees."""
    a = F.lit(270.0) - mean_dir
    wrapped = F.radians(F.when(a > 180, a - 360.0).when(a < -180, a + 360.0).otherwise(a))
    return F.cos(wrapped), F.sin(wrapped)


def rotate_wave_dir(mean_dir: Column, alpha_deg: Column) -> tuple[Column, Column]:
    """Wave direction as a unit vector rotated by ``alpha_deg`` degrees."""
    return rotate_wind(*wave_unit_vector(mean_dir), alpha_deg)
