"""Streams over several micro-batches and restarts: rain, gaps, anchored bins."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.session import materialize
from tidewright.streaming.bins import run_available
from tidewright.streaming.series import Series, increments, stream_series

T0 = datetime(2026, 1, 1)
SCHEMA = "site string, deployment string, time timestamp_ntz, precipitation_level double"


def constants(spark, minutes_off=0):
    rows = spark.createDataFrame([("CE02", "D1"), ("CE04", "D1")], "site string, deployment string")
    return materialize(rows.withColumn("phase", F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes_off), F.lit(0))), "constants")


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def samples():
    """Six hours of two sites with gaps, copies, NULL levels and rows out of order within ten minutes."""
    rng = random.Random(4)
    rows = []
    for site in ("CE02", "CE04"):
        level = 0.0
        for minute in range(360):
            level += rng.choice([0.0, 0.1, 0.25, 1.0, 3.0])
            if not 100 <= minute < 145 and rng.random() < 0.7:
                rows.append((site, "D1", T0 + timedelta(minutes=minute, seconds=rng.randrange(60)), rng.choice([level, level, level, None])))
    return sorted(rows, key=lambda r: r[2])


def expected(rows, off, watermark):
    out = {}
    for site in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == site), key=lambda r: r[2])
        bins, before = {}, None
        for _, _, t, level in own:
            moved = t + timedelta(minutes=5 - off) - T0
            start = T0 + timedelta(minutes=10 * (moved // timedelta(minutes=10)))
            rain = bins.setdefault(start, [])
            step = None if level is None or before is None else level - before
            rain.append(step if step is not None and 0.2 <= step <= 2.5 else None)
            before = level
        closed = [b for b in bins if b + timedelta(minutes=10) <= watermark]
        at = min(closed)
        while at <= max(closed):
            good = [s for s in bins.get(at, []) if s is not None]
            out[(site, at + timedelta(minutes=off))] = (sum(good) / len(good) if good else None, len(bins.get(at, [])))
            at += timedelta(minutes=10)
    return out


@pytest.mark.parametrize("off", [0, 3])
def test_series_over_batches_and_a_restart(spark, tmp_path, off):
    rows = samples()
    rng = random.Random(2)
    parts = [rows[i : i + 90] for i in range(0, len(rows), 90)]
    fixed = constants(spark, off)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def go():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        run_available(stream_series(stream, fixed), out, checkpoint)

    for k, part in enumerate(parts):
        rng.shuffle(part)
        again = [(s, d, t, 99.0) for s, d, t, _ in parts[k - 1][:5]] if k else []  # copies, a batch later
        put(spark, tmp_path / "in", part + again)
        if k == len(parts) // 2:
            go()
            go()
    go()
    watermark = max(r[2] for r in rows) + timedelta(minutes=5 - off) - timedelta(hours=1)
    want = expected(rows, off, watermark)
    got = spark.read.parquet(out).collect()
    assert len(got) == len(want)
    for r in got:
        rain, n = want[(r.site, r.time)]
        assert r.n_samples == n and (r.rain_rate is None if rain is None else r.rain_rate == pytest.approx(rain)), r
    assert any(r.n_samples == 0 for r in got)
    before = len(got)
    put(spark, tmp_path / "in", [("CE02", "D1", T0 + timedelta(minutes=1), 50.0)])  # hours late
    go()
    assert spark.read.parquet(out).count() == before


def test_increments():
    nan = float("nan")
    assert increments([1.0, 1.5, nan, 2.0, 2.5, 9.0], 0.5) == [0.5, 0.5, 0.5]
    assert increments([1.0], nan) == [] and increments([], 1.0) == []
    assert Series.due(0) == 599_999


def test_the_state_store_of_the_session_stays(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    put(spark, tmp_path / "in", samples()[:50])
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    run_available(stream_series(stream, constants(spark)), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert spark.conf.get(name, None) == before


class Held:
    """A value state that counts what is written to it."""

    def __init__(self):
        self.value, self.writes = None, 0

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.writes = value, self.writes + 1


class Handle:
    def __init__(self):
        self.held = Held()

    def getValueState(self, name, schema):
        return self.held


def test_a_deployment_sees_one_row_a_bin_and_writes_its_state_once_a_batch():
    """Not one read and write of the state for each bin of each chunk of samples, as it was."""
    columns = ["site", "deployment", "cell", "first_level", "last_level", "n_samples", "n_steps", "total"]
    chunk = lambda *rows: pd.DataFrame([("CE02", "D1", *r) for r in rows], columns=columns)
    handle, series, key = Handle(), Series(), ("CE02", "D1")
    series.init(handle)
    first = [chunk((13, 4.0, None, 2, 0, 0.0), (10, 1.0, 1.5, 3, 2, 0.5)), chunk((11, 2.0, 2.0, 1, 0, 0.0))]
    out = pd.concat(series.handleInputRows(key, iter(first), None))
    assert handle.held.writes == 1
    told = [(r.cell, None if pd.isna(r.rain_rate) else r.rain_rate, r.n_samples) for r in out.itertuples()]
    assert told == [(10, 0.25, 3), (11, 0.5, 1), (12, None, 0), (13, 2.0, 2)]
    # a bin that has left is passed over; the level before is NULL, so the edge has no increment
    out = pd.concat(series.handleInputRows(key, iter([chunk((15, 5.0, 6.0, 2, 1, 1.0), (13, 9.0, 9.0, 1, 0, 0.0))]), None))
    told = [(r.cell, None if pd.isna(r.rain_rate) else r.rain_rate, r.n_samples) for r in out.itertuples()]
    assert told == [(14, None, 0), (15, 1.0, 2)] and handle.held.writes == 2
    assert pd.concat(series.handleInputRows(key, iter([chunk((15, 1.0, 1.0, 1, 0, 0.0))]), None)).empty
    assert handle.held.writes == 2


def test_samples_are_gathered_by_bin_before_the_deployment(spark, tmp_path):
    put(spark, tmp_path / "in", samples()[:50])
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    plan = stream_series(stream, constants(spark))._jdf.queryExecution().analyzed().toString()
    below = plan[plan.index("TransformWithState"):]
    assert "Aggregate" in below and below.index("Aggregate") < below.index("DeduplicateWithinWatermark")
