"""Anchored 10-minute means of both instruments in one shuffle.

Meteorological means, wave means, rain and the empty bins of the window are rows
of one union, aggregated once: ``avg`` skips NULL, so the result equals the outer
join of the separately binned tables reindexed on every bin of the window.  Wide
rows are combined before the shuffle; only ``(key, time, level)`` is shuffled
sample by sample, for rain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.seawater import add_practical_salinity
from tidewright.functions.timegrid import floor_to_bin
from tidewright.functions.vectors import add_direction_from, rotate_by, wave_unit_vector
from tidewright.model import BINNED_FIELDS, KEYS, MET_SHIFT_MINUTES, WAVE_SHIFT_MINUTES
from tidewright.operators.bounds import bin_spine
from tidewright.operators.rain import rain_by_cell
from tidewright.session import materialize

GROUP = [*KEYS, "phase", "cell"]

MET_MEANS = [
    "wind_speed", "wind_u", "wind_v", "baro", "air_temp", "rel_humidity", "shortwave", "longwave", "sst", "salinity",
]
WAVE_MEANS = ["sig_wave_hgt", "max_wave_hgt", "peak_period", "avg_period", "wave_u", "wave_v"]


def place(samples: DataFrame, bounds: DataFrame, shift_minutes: int) -> DataFrame:
    """Attach the run's constants and the bin's ``cell`` to each sample.

    ``cell`` is the bin's left edge less ``phase``, which lies on the clock's
    grid; ``inside`` tells whether the bin belongs to the run's window.
    ``bounds`` should be a stored table, so that its size decides how it is
    joined.
    """
    shift = f"INTERVAL {shift_minutes} MINUTES"
    run = bounds.selectExpr(
        *KEYS, "phase", "cos_a", "sin_a", "pressure_dbar",
        f"bin_start - {shift} AS from_time", f"grid_end - {shift} AS to_time", f"{shift} - phase AS offset",
    )
    moved = samples.join(run, KEYS).withColumns(
        {"inside": F.expr("time >= from_time AND time < to_time"), "shifted": F.expr("time + offset")}
    )
    return moved.withColumn("cell", floor_to_bin(F.col("shifted")))


def met_variables(placed: DataFrame, keep: list[str] = GROUP) -> DataFrame:
    """Derived variables of each meteorological sample, next to the ``keep`` columns."""
    u, v = rotate_by(
        F.col("eastward_wind_velocity"), F.col("northward_wind_velocity"), F.col("cos_a"), F.col("sin_a")
    )
    rotated = placed.withColumns({"wind_u": u, "wind_v": v})
    salted = add_practical_salinity(
        rotated, "sea_surface_conductivity", "sea_surface_temperature", "pressure_dbar"
    )
    return salted.selectExpr(
        *keep,
        "sqrt(wind_u * wind_u + wind_v * wind_v) AS wind_speed",
        "wind_u",
        "wind_v",
        "barometric_pressure AS baro",
        "air_temperature AS air_temp",
        "relative_humidity AS rel_humidity",
        "shortwave_irradiance AS shortwave",
        "longwave_irradiance AS longwave",
        "sea_surface_temperature AS sst",
        "salinity",
    )


def wave_variables(placed: DataFrame, keep: list[str] = GROUP) -> DataFrame:
    """Derived variables of each wave sample, next to the ``keep`` columns."""
    u, v = rotate_by(*wave_unit_vector(F.col("mean_wave_direction")), F.col("cos_a"), F.col("sin_a"))
    return placed.select(
        *keep,
        F.col("significant_wave_height").alias("sig_wave_hgt"),
        F.col("maximum_wave_height").alias("max_wave_hgt"),
        "peak_period",
        F.col("average_wave_period").alias("avg_period"),
        u.alias("wave_u"),
        v.alias("wave_v"),
    )


def mean_of(c: str) -> Column:
    """Mean of all values but NULL and NaN, which infinite inputs can leave behind.

    A mean that is NaN itself (opposite infinities) counts as missing.
    """
    null = "CAST(NULL AS DOUBLE)"
    return F.expr(f"nanvl(avg(nanvl({c}, {null})), {null}) AS {c}")


def bin_means(parts: list[DataFrame], values: list[str]) -> DataFrame:
    """Union of rows keyed by ``GROUP``, averaged per bin; ``time`` is the left edge."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    binned = rows.groupBy(*GROUP).agg(*[mean_of(c) for c in values])
    return binned.select(*KEYS, (F.col("cell") + F.col("phase")).alias("time"), *values)


def bin_observations(met: DataFrame, wave: DataFrame, bounds: DataFrame, rain: bool = True) -> DataFrame:
    """Bin both instruments over each deployment's run window.

    Without ``rain`` its branch, which needs a shuffle of single samples, is left out and ``rain_rate`` with it.

    Samples must be unique per ``(site, deployment, time)`` and carry raw times
    (the instruments' shifts are applied here).  ``bounds`` comes from
    ``with_run_constants``.  Every bin of the window is present, empty ones NULL.
    """
    bounds = materialize(bounds, "bounds")  # each branch reads them, and would work them out anew
    met_placed = place(met, bounds, MET_SHIFT_MINUTES)
    wave_placed = place(wave, bounds, WAVE_SHIFT_MINUTES)
    spine = bin_spine(bounds).withColumn("cell", F.col("time") - F.col("phase")).select(*GROUP)
    parts = [met_variables(met_placed.filter("inside")), wave_variables(wave_placed.filter("inside")), spine]
    values = [*MET_MEANS, *WAVE_MEANS]
    if rain:
        parts.append(rain_by_cell(met_placed).filter("inside").drop("inside"))
        values.append("rain_rate")
    fields = [f for f in BINNED_FIELDS if rain or f != "rain_rate"]
    return recover_directions(bin_means(parts, values)).select(*KEYS, "time", *fields)


def recover_directions(binned: DataFrame) -> DataFrame:
    """Directions from the averaged vectors, with the mean speed as their scale; the vector means are dropped."""
    wind = add_direction_from(binned, "wind_u", "wind_v", "wind_dir", F.col("wind_speed"))
    return add_direction_from(wind, "wave_u", "wave_v", "wave_dir", F.lit(1.0)).drop("wind_u", "wind_v", "wave_u", "wave_v")
