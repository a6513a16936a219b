import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.util import T0, at, met_frame
from tidewright.model import KEYS
from tidewright.operators.dedup import first_per_key
from tidewright.operators.rain import rain_rate


def rates(spark, rows):
    return [r.rain_rate for r in rain_rate(met_frame(spark, rows)).orderBy(*KEYS, "time").collect()]


def test_increments_are_masked(spark):
    rows = [{"time": at(m), "precipitation_level": v} for m, v in enumerate([0.0, 1.0, 3.6, 4.0, 3.9])]
    got = rates(spark, rows)
    assert got[0] is None and got[2] is None and got[4] is None
    assert got[1] == pytest.approx(1.0) and got[3] == pytest.approx(0.4)


def test_both_limits_are_valid(spark):
    rows = [{"time": at(m), "precipitation_level": v} for m, v in enumerate([0.0, 2.5, 2.5, 0.0, 0.2])]
    assert rates(spark, rows) == [None, 2.5, None, None, 0.2]


def test_missing_level_breaks_both_sides(spark):
    rows = [{"time": at(m), "precipitation_level": v} for m, v in enumerate([0.0, None, 1.0, 2.0])]
    assert rates(spark, rows) == [None, None, None, 1.0]


def test_long_gaps_and_cells_equal_brute_force(spark):
    """A hot deployment with a third of all rows, gaps of days, NULL levels at cell edges."""
    rnd = random.Random(11)
    rows = []
    for site, deployment, n in [("CE02", "D00001", 900), ("CE02", "D00002", 500), ("CE04", "D00001", 400)]:
        t = T0
        for _ in range(n):
            t += timedelta(seconds=rnd.choice([1, 20, 60, 299, 600, 3600, 86400 * 3]))
            level = None if rnd.random() < 0.1 else rnd.choice([0.0, 0.2, 0.5, 1.0, 2.5, 2.7])
            rows.append({"site": site, "deployment": deployment, "time": t, "precipitation_level": level})
    expected, last = {}, {}
    for r in rows:
        key = (r["site"], r["deployment"])
        prev, level = last.get(key), r["precipitation_level"]
        diff = None if prev is None or level is None else level - prev
        expected[(*key, r["time"])] = diff if diff is not None and 0.2 <= diff <= 2.5 else None
        last[key] = level
    rnd.shuffle(rows)
    got = {(r.site, r.deployment, r.time): r.rain_rate for r in rain_rate(met_frame(spark, rows)).collect()}
    assert got == expected


def test_first_copy_wins(spark):
    df = spark.createDataFrame(
        [("a", 1, "f2", 0, 5.0), ("a", 1, "f1", 7, None), ("a", 1, "f1", 9, 3.0), ("a", 2, "f9", 0, 1.0)],
        "k string, t int, file string, pos int, x double",
    )
    got = {(r.k, r.t): (r.file, r.pos, r.x) for r in first_per_key(df, ["k", "t"], ["file", "pos"]).collect()}
    assert got == {("a", 1): ("f1", 7, None), ("a", 2): ("f9", 0, 1.0)}


def test_copies_are_combined_before_the_shuffle(spark):
    """A third of the rows copy one key; each input task ships it once."""
    df = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id", F.rand(1).alias("x")
    )
    out = first_per_key(df, ["k"], ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("== Initial Plan ==")[0].split("Exchange")[-1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert out.filter("k = 0").first().id == 0
    assert out.count() == 20001
