"""Hourly increments as a Structured Streaming query.

Bins close when the watermark, one hour behind the newest sample, passes them;
samples later than that are lost.  Empty bins and rain, which need what came before, are the work of ``streaming.series``.
Of copies of a time stamp the first to arrive wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.timegrid import instant_to_ntz, ntz_to_instant
from tidewright.model import BIN, BINNED_FIELDS, KEYS, MET_SHIFT_MINUTES, WAVE_SHIFT_MINUTES
from tidewright.operators.bins import (
    MET_MEANS, WAVE_MEANS, mean_of, met_variables, recover_directions, wave_variables,
)
from tidewright.operators.qc import apply_qc
from tidewright.session import scratch_path

DELAY = "1 hour"


def phase_of(constants: DataFrame) -> Column:
    """How far a deployment's bins are off the clock's grid; zero where nothing is said."""
    return F.col("phase") if "phase" in constants.columns else F.expr("INTERVAL '0' SECOND")


def stream_bins(met: DataFrame, wave: DataFrame, constants: DataFrame) -> DataFrame:
    """Quality-checked bins of two sample streams, anchored at each deployment's phase.

    ``constants`` is a stored table with ``cos_a``, ``sin_a`` and
    ``pressure_dbar`` per deployment, and ``phase`` where its bins are off the clock's grid: event time is moved back by it
    before watermark and window, and the bins forward again.
    """
    fixed = constants.select(*KEYS, "cos_a", "sin_a", "pressure_dbar", phase_of(constants).alias("phase"))
    keep = [*KEYS, "shifted", "instrument", "phase"]

    def shifted(samples: DataFrame, shift: int, instrument: str) -> DataFrame:
        moved = F.col("time") + F.expr(f"INTERVAL {shift} MINUTES") - F.col("phase")
        return samples.join(fixed, KEYS).withColumns({"shifted": ntz_to_instant(moved), "instrument": F.lit(instrument)})

    both = met_variables(shifted(met, MET_SHIFT_MINUTES, "met"), keep).unionByName(
        wave_variables(shifted(wave, WAVE_SHIFT_MINUTES, "wave"), keep), allowMissingColumns=True
    )
    # one watermark over both: two would wait for the slower instrument
    rows = both.withWatermark("shifted", DELAY).dropDuplicatesWithinWatermark([c for c in keep if c != "phase"])
    values = [*MET_MEANS, *WAVE_MEANS]
    binned = (
        rows.groupBy(*KEYS, "phase", F.window("shifted", BIN).alias("bin"))
        .agg(*[mean_of(c) for c in values])
        .select(*KEYS, (instant_to_ntz(F.col("bin.start")) + F.col("phase")).alias("time"), *values)
    )
    fields = [f for f in BINNED_FIELDS if f != "rain_rate"]
    return apply_qc(recover_directions(binned).select(*KEYS, "time", *fields))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(stream: DataFrame, out_path: str, checkpoint_path: str) -> None:
    """Process everything that is there now, append the closed bins, and stop.

    The state is kept by RocksDB; the session's own choice is back when the query has started.
    """
    conf = stream.sparkSession.conf
    before = conf.get(STATE_STORE, None)
    conf.set(STATE_STORE, ROCKSDB)
    try:
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True)
            .start(out_path)
        )
        query.awaitTermination()
    finally:
        conf.unset(STATE_STORE) if before is None else conf.set(STATE_STORE, before)


def collect_available(stream: DataFrame) -> DataFrame:
    """Run to the end of the available input and return the closed bins."""
    spark = stream.sparkSession
    out = scratch_path(spark, "stream-bins")
    run_available(stream, out, scratch_path(spark, "stream-checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)
