import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from tests.util import T0, at, by_time, met_frame, wave_frame, window_runs
from tidewright.model import BINNED_FIELDS, QC_BOUNDS
from tidewright.operators.bins import bin_observations
from tidewright.operators.bounds import bin_spine, data_bounds, run_bounds
from tidewright.operators.qc import apply_qc


def binned(spark, met, wave, start=T0, end=at(30), alpha=0.0):
    runs = window_runs(spark, start, end, alpha=alpha)
    return by_time(bin_observations(met_frame(spark, met), wave_frame(spark, wave), runs))


def test_every_bin_has_a_row_with_its_left_edge(spark):
    rows = [{"time": at(m)} for m in (0, 10, 20)]
    out = binned(spark, rows, rows)
    assert list(out.time) == [at(0), at(10), at(20)]
    assert list(out.columns) == ["site", "deployment", "time", *BINNED_FIELDS]


def test_empty_bin_is_null(spark):
    out = binned(spark, [{"time": at(0)}, {"time": at(20)}], [{"time": at(0)}])
    assert [math.isnan(x) for x in out.wind_speed] == [False, True, False]


def test_missing_values_do_not_count(spark):
    met = [
        {"time": at(0), "eastward_wind_velocity": None, "northward_wind_velocity": None},
        {"time": at(4)},
    ]
    out = binned(spark, met, met[1:], end=at(10))
    assert out.wind_speed[0] == 5.0


def test_shifts(spark):
    """A met sample counts five minutes later, a wave sample ten minutes earlier."""
    met = [{"time": at(4.99), "air_temperature": 1.0}, {"time": at(5), "air_temperature": 2.0}]
    wave = [
        {"time": at(9.99), "significant_wave_height": 1.0},
        {"time": at(10), "significant_wave_height": 2.0},
        {"time": at(20), "significant_wave_height": 3.0},
    ]
    out = binned(spark, met, wave)
    assert list(out.air_temp[:2]) == [1.0, 2.0]
    assert list(out.sig_wave_hgt[:2]) == [2.0, 3.0]


def test_speed_is_mean_of_speeds_and_direction_of_vectors(spark):
    met = [
        {"time": at(0), "eastward_wind_velocity": 3.0, "northward_wind_velocity": 0.0},
        {"time": at(1), "eastward_wind_velocity": 0.0, "northward_wind_velocity": 4.0},
    ]
    out = binned(spark, met, [{"time": at(10)}], end=at(10))
    assert out.wind_speed[0] == 3.5
    assert out.wind_dir[0] == pytest.approx(math.degrees(math.atan2(-1.5, -2.0)) + 360)
    assert out.wave_dir[0] == pytest.approx(270.0)


def test_infinite_values_spoil_the_mean_and_fail_the_check(spark):
    inf = float("inf")
    met = [{"time": at(0), "air_temperature": inf}, {"time": at(1), "air_temperature": 3.0}]
    both = [{"time": at(0), "air_temperature": inf}, {"time": at(1), "air_temperature": -inf}]
    runs = window_runs(spark, T0, at(10))
    wave = wave_frame(spark, [{"time": at(10)}])
    assert bin_observations(met_frame(spark, met), wave, runs).first().air_temp == inf
    assert apply_qc(bin_observations(met_frame(spark, met), wave, runs)).first().air_temp is None
    assert bin_observations(met_frame(spark, both), wave, runs).first().air_temp is None


def test_derived_nan_does_not_count(spark):
    inf = float("inf")
    met = [
        {"time": at(0), "sea_surface_conductivity": inf, "sea_surface_temperature": 20.0,
         "eastward_wind_velocity": inf, "northward_wind_velocity": -inf},
        {"time": at(1)},
    ]
    wave = [{"time": at(10), "mean_wave_direction": inf}, {"time": at(11)}]
    out = binned(spark, met, wave, end=at(10), alpha=14.5)
    assert out.salinity[0] == pytest.approx(30.167116, abs=1e-5)
    assert out.wave_dir[0] == pytest.approx(284.5)


def test_first_bin_of_a_window_uses_the_level_before_it(spark):
    met = [{"time": at(-600), "precipitation_level": 1.0}, {"time": at(2), "precipitation_level": 1.5},
           {"time": at(3), "precipitation_level": 2.5}, {"time": at(12), "precipitation_level": 2.8}]
    out = binned(spark, met, [{"time": at(10)}])
    assert out.rain_rate[0] == pytest.approx(0.75)
    assert out.rain_rate[1] == pytest.approx(0.3)
    assert math.isnan(out.rain_rate[2])


def test_anchor_off_the_clock_drops_the_partial_bin(spark):
    runs = window_runs(spark, T0 + timedelta(minutes=5), T0 + timedelta(minutes=60))
    assert [r.time for r in bin_spine(runs).orderBy("time").collect()] == [at(m) for m in (5, 15, 25, 35, 45)]
    met = [{"time": at(m), "air_temperature": float(m)} for m in range(0, 60)]
    out = by_time(bin_observations(met_frame(spark, met), wave_frame(spark, [{"time": at(20)}]), runs))
    assert list(out.time) == [at(m) for m in (5, 15, 25, 35, 45)]
    assert out.air_temp[0] == pytest.approx(np.mean(range(0, 10)))
    assert out.air_temp[4] == pytest.approx(np.mean(range(40, 50)))


def test_bounds(spark):
    met = met_frame(spark, [{"time": datetime(2026, 3, 1, 0, 0)}, {"time": datetime(2026, 3, 1, 5, 59, 59)},
                            {"site": "CE04", "time": datetime(2026, 3, 1, 0, 7)},
                            {"site": "CE04", "time": datetime(2026, 3, 1, 1, 59)}])
    runs = run_bounds(data_bounds(met)).collect()
    assert [(r.site, r.bin_start, r.bin_end, r.mid_date) for r in runs] == [
        ("CE02", datetime(2026, 3, 1, 1), datetime(2026, 3, 1, 5), datetime(2026, 3, 1, 3))
    ]
    saved = spark.createDataFrame(
        [("CE02", "D00001", datetime(2026, 3, 1, 4, 55)), ("CE04", "D00001", None)],
        "site string, deployment string, last_bin_end timestamp_ntz",
    )
    assert run_bounds(data_bounds(met), saved).count() == 0  # 5 minutes hold no whole bin


def test_qc(spark):
    ok = {c: (lo + hi) / 2 for c, (lo, hi) in QC_BOUNDS.items()}
    rows = [ok, {**ok, "wind_speed": 70.0}, {**ok, "baro": 860.0}, {**ok, "salinity": 9.99}, {**ok, "sst": None}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} double" for c in ok))
    got = [r.asDict() for r in apply_qc(df).collect()]
    assert got[0] == ok and got[2] == rows[2] and got[4] == rows[4]
    assert got[1] == {**ok, "wind_speed": None} and got[3] == {**ok, "salinity": None}
    assert apply_qc(df.select("baro")).columns == ["baro"]


def test_random_deployments_equal_brute_force(spark):
    rnd = random.Random(2)
    keys = [("CE02", "D00001"), ("CE02", "D00002"), ("CE09", "D00001")]
    start, end = T0 + timedelta(hours=2, minutes=3), T0 + timedelta(hours=9)
    met, wave = [], []
    for site, deployment in keys:
        for t in sorted(rnd.sample(range(0, 10 * 3600), 700 if site == "CE02" else 150)):
            met.append({
                "site": site, "deployment": deployment, "time": T0 + timedelta(seconds=t),
                "eastward_wind_velocity": rnd.uniform(-20, 20), "northward_wind_velocity": rnd.uniform(-20, 20),
                "air_temperature": None if rnd.random() < 0.2 else rnd.uniform(-5, 35),
                "precipitation_level": rnd.choice([0.0, 0.3, 0.6, 1.0, None]),
            })
        for t in range(0, 10 * 3600, 1200):
            wave.append({"site": site, "deployment": deployment, "time": T0 + timedelta(seconds=t),
                         "mean_wave_direction": rnd.uniform(0, 360), "peak_period": rnd.uniform(1, 20)})
    alpha = math.radians(14.5)
    cells: dict = {}

    def put(r, shift, values):
        t = r["time"] + timedelta(minutes=shift)
        n = (t - start) // timedelta(minutes=10)
        if 0 <= n < (end - start) // timedelta(minutes=10):
            cell = cells.setdefault((r["site"], r["deployment"], start + n * timedelta(minutes=10)), {})
            for c, x in values.items():
                if x is not None:
                    cell.setdefault(c, []).append(x)

    level: dict = {}
    for r in met:
        key = (r["site"], r["deployment"])
        prev, now = level.get(key), r["precipitation_level"]
        step = None if prev is None or now is None else now - prev
        level[key] = now
        u, v = r["eastward_wind_velocity"], r["northward_wind_velocity"]
        put(r, 5, {"wind_speed": math.hypot(u, v), "air_temp": r["air_temperature"],
                   "u": u * math.cos(alpha) + v * math.sin(alpha), "v": v * math.cos(alpha) - u * math.sin(alpha),
                   "rain_rate": step if step is not None and 0.2 <= step <= 2.5 else None})
    for r in wave:
        a = math.radians(270 - r["mean_wave_direction"]) - alpha
        put(r, -10, {"wu": math.cos(a), "wv": math.sin(a), "peak_period": r["peak_period"]})

    runs = window_runs(spark, start, end, keys, alpha=14.5)
    rnd.shuffle(met)
    out = bin_observations(met_frame(spark, met), wave_frame(spark, wave), runs).collect()
    assert len(out) == 3 * 41
    for r in out:
        cell = {c: sum(x) / len(x) for c, x in cells.get((r.site, r.deployment, r.time), {}).items()}
        for c in ("wind_speed", "air_temp", "rain_rate", "peak_period"):
            assert (r[c] is None and c not in cell) or r[c] == pytest.approx(cell[c], abs=1e-9)
        for name, u, v in (("wind_dir", "u", "v"), ("wave_dir", "wu", "wv")):
            if u in cell:
                assert r[name] == pytest.approx(math.degrees(math.atan2(-cell[u], -cell[v])) % 360, abs=1e-9)
            else:
                assert r[name] is None


def test_only_narrow_rows_are_shuffled_one_by_one(spark):
    """Wide samples are combined before the shuffle; only rain moves single samples."""
    met = met_frame(spark, [{"time": at(0)}])
    out = bin_observations(met, wave_frame(spark, [{"time": at(0)}]), window_runs(spark, T0, at(30)))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg(nanvl(wind_speed" in physical
    assert "CartesianProduct" not in physical and "BatchEvalPython" not in physical
    bulletin_only = out.drop("rain_rate")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(inc" not in bulletin_only
