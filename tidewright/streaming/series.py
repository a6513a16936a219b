"""Rain and empty bins of the sample stream, by keyed state.

Rain needs the sample before, and a gap shows only when a later bin closes: both need what a deployment had last.  Samples are
de-duplicated and gathered bin by bin, spread over all tasks; a bin leaves once the watermark has passed it, with the increments
inside it added up.  Only then do the bins of a deployment meet: its state is the last level before them and how far they have left.
The increment across a bin's edge, and the empty bins between, are added there.

A task for one deployment sees one row a bin, bounded by the calendar (52,560 a year), however many samples there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewright.functions.timegrid import instant_to_ntz, ntz_to_instant
from tidewright.model import BIN, BIN_MINUTES, KEYS, MET_SHIFT_MINUTES
from tidewright.operators.rain import RAIN_MAX, RAIN_MIN, valid_increment
from tidewright.streaming.bins import DELAY, phase_of

CELL_MICROS = BIN_MINUTES * 60_000_000
OUT = "site string, deployment string, cell long, rain_rate double, n_samples long"
OUT_COLUMNS = ["site", "deployment", "cell", "rain_rate", "n_samples"]


def increments(levels: list[float], before: float) -> list[float]:
    """Plausible differences of successive levels; ``before`` is the one ahead of them, NaN where there is none."""
    steps = [b - a for a, b in zip([before, *levels], levels)]
    return [s for s in steps if RAIN_MIN <= s <= RAIN_MAX]


class Series(StatefulProcessor):
    """Closed bins of one deployment in order, each once, with the empty ones between them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.past = handle.getValueState("past", "level double, left long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        closed = pd.concat(list(rows)).sort_values("cell")
        level, left = self.past.get() if self.past.exists() else (None, self.due(int(closed["cell"].min()) - 1))
        closed = closed[self.due(closed["cell"]) > left]
        if closed.empty:
            yield pd.DataFrame(columns=OUT_COLUMNS)
            return
        cells = closed["cell"].to_numpy(np.int64)
        first, last = (closed[c].astype(float).tolist() for c in ("first_level", "last_level"))
        edges = [increments([a], before) for a, before in zip(first, [math.nan if level is None else level, *last])]
        n = closed["n_steps"].to_numpy() + [len(e) for e in edges]
        total = closed["total"].to_numpy() + [sum(e) for e in edges]
        start = (left + 1) // (CELL_MICROS // 1000)
        every = pd.DataFrame({"cell": np.arange(start, cells[-1] + 1), "rain_rate": np.nan, "n_samples": 0}).astype({"rain_rate": object})
        every.loc[cells - start, "rain_rate"] = [t / k if k else None for t, k in zip(total.tolist(), n.tolist())]
        every.loc[cells - start, "n_samples"] = closed["n_samples"].to_numpy(np.int64)
        self.past.update((last[-1], self.due(int(cells[-1]))))
        every["rain_rate"] = every["rain_rate"].where(every["rain_rate"].notna(), None)
        yield every.assign(site=key[0], deployment=key[1])[OUT_COLUMNS]

    @staticmethod
    def due(cell: int) -> int:
        """Milliseconds of a bin's end, less one: it leaves once the watermark is beyond them."""
        return (cell + 1) * (CELL_MICROS // 1000) - 1

    def close(self) -> None:
        pass


def stream_series(met: DataFrame, constants: DataFrame, level: str = "precipitation_level") -> DataFrame:
    """(site, deployment, time, rain_rate, n_samples) of every bin between a deployment's first and last closed one.

    Empty bins are there with no samples.  ``constants`` is a stored table of the deployments, with the ``phase`` of their bins where
    these are anchored off the clock.  Samples more than an hour behind the newest one may come too late, and are passed over.
    """
    fixed = constants.select(*KEYS, phase_of(constants).alias("phase"))
    moved = F.col("time") + F.expr(f"INTERVAL {MET_SHIFT_MINUTES} MINUTES") - F.col("phase")
    placed = met.join(fixed, KEYS).withColumn("shifted", ntz_to_instant(moved)).where(F.col("shifted").isNotNull())
    rows = placed.select(*KEYS, "shifted", F.col(level).cast("double").alias("level"))
    unique = rows.withWatermark("shifted", DELAY).dropDuplicatesWithinWatermark([*KEYS, "shifted"])
    bins = unique.groupBy(*KEYS, F.window("shifted", BIN).alias("bin")).agg(F.collect_list(F.struct("shifted", "level")).alias("samples"))
    levels = F.transform(F.array_sort("samples"), lambda s: s["level"])
    steps = F.zip_with(F.slice("levels", 2, F.size("levels")), "levels", valid_increment)
    cells = bins.select(
        *KEYS, F.floor(F.unix_micros("bin.start") / CELL_MICROS).cast("long").alias("cell"), levels.alias("levels")
    ).select(
        *KEYS, "cell", F.get("levels", F.lit(0)).alias("first_level"), F.element_at("levels", -1).alias("last_level"),
        F.size("levels").cast("long").alias("n_samples"), F.filter(steps, lambda s: s.isNotNull()).alias("steps")
    ).select(
        *KEYS, "cell", "first_level", "last_level", "n_samples", F.size("steps").cast("long").alias("n_steps"),
        F.aggregate("steps", F.lit(0.0), lambda a, s: a + s).alias("total"))
    series = cells.groupBy(*KEYS).transformWithStateInPandas(
        statefulProcessor=Series(), outputStructType=OUT, outputMode="Append", timeMode="None")
    start = instant_to_ntz(F.timestamp_micros(F.col("cell") * CELL_MICROS))
    return series.join(fixed, KEYS).select(*KEYS, (start + F.col("phase")).alias("time"), "rain_rate", "n_samples")
