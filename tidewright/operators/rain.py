"""Rain increments: difference of the cumulative level between successive samples.

The difference runs over the whole deployment, so a plain window per deployment
would put one long series into one task.  Both forms below cut the series into
10-minute cells: differences inside a cell need only that cell, and the first one
takes the last level of the previous non-empty cell from a per-cell summary.  The
summary has one row per cell, so its length per deployment is bounded by the
calendar (52,560 rows a year), not by the sampling rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.timegrid import floor_to_bin
from tidewright.model import KEYS

# ---- fixed values: valid increment per sample (mm), inclusive --------------------
RAIN_MIN = 0.2
RAIN_MAX = 2.5

#: The cell leads: it varies most, so it is what the sorts compare first.
CELL = ["cell", *KEYS]


def valid_increment(level: Column, previous: Column) -> Column:
    """``level - previous`` where it is plausible, else NULL."""
    diff = level - previous
    return F.when(diff.between(RAIN_MIN, RAIN_MAX), diff)


def rain_rate(samples: DataFrame, level: str = "precipitation_level") -> DataFrame:
    """Add ``rain_rate`` to samples that are unique per ``(site, deployment, time)``.

    The window and the join below share one shuffle on the cell, and the sort of
    the window serves the merge join.
    """
    placed = samples.withColumn("cell", floor_to_bin(F.col("time")))
    in_cell = Window.partitionBy(*CELL).orderBy("time")
    rows = placed.withColumn("before", F.lag(level).over(in_cell)).withColumn(
        "is_first", F.row_number().over(in_cell) == 1
    )
    last = placed.groupBy(*CELL).agg(F.max_by(level, "time").alias("last_level"))
    carried = last.select(
        *CELL, F.lag("last_level").over(Window.partitionBy(*KEYS).orderBy("cell")).alias("carried")
    )
    previous = F.when(F.col("is_first"), F.col("carried")).otherwise(F.col("before"))
    return (
        rows.join(carried, CELL, "left")
        .withColumn("rain_rate", valid_increment(F.col(level), previous))
        .select(*samples.columns, "rain_rate")
    )


def rain_by_cell(placed: DataFrame, level: str = "precipitation_level") -> DataFrame:
    """Mean valid increment per cell of rows that carry ``phase``, ``cell`` and ``inside``.

    The cell's inner differences are reduced first; the difference across the
    cell's left edge is added on the reduced rows.
    """
    cell = [*CELL, "phase"]
    inner = placed.select(*cell, "inside", "time", level).withColumn(
        "inc", valid_increment(F.col(level), F.lag(level).over(Window.partitionBy(*cell).orderBy("time")))
    )
    per_cell = inner.groupBy(*cell).agg(
        F.bool_and("inside").alias("inside"),
        F.sum("inc").alias("total"),
        F.count("inc").alias("n"),
        F.min_by(level, "time").alias("first_level"),
        F.max_by(level, "time").alias("last_level"),
    )
    series = Window.partitionBy(*KEYS).orderBy("cell")
    edge = per_cell.withColumn("edge", valid_increment(F.col("first_level"), F.lag("last_level").over(series)))
    total = F.coalesce("total", F.lit(0.0)) + F.coalesce("edge", F.lit(0.0))
    n = F.col("n") + F.col("edge").isNotNull().cast("int")
    return edge.select(*cell, "inside", F.when(n > 0, total / n).alias("rain_rate"))
