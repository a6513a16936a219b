"""The whole run on raw files: first run, increments, reprocessing, progress."""

import json
import math
import re
from datetime import datetime, timedelta, timezone

import pytest

from pyspark.sql import functions as F

from tests.util import declinations, epoch, met_frame, wave_frame
from tidewright.model import MET_FIELDS, WAVE_FIELDS, stations
from tidewright.plans.late import late_samples, reissue_late
from tidewright.plans.progress import (
    clear_progress, latest_progress, progress_from_state_files, progress_ledger, read_progress, save_progress,
)
from tidewright.plans.run import ntz, plan_runs, run, run_directory
from tidewright.sources.array_json import load_met
from tidewright.operators.bounds import with_declination
from tidewright.sinks.text_files import write_text_files, written_files
from tidewright.sources import ledger
from tidewright.sources.landed import LandedTable, land, window_zones, zone_times

START = datetime(2026, 3, 1)


def raw_hours(root, mooring, first, hours, deployment="D00020"):
    """One file per hour and instrument: met every minute, waves every 20 minutes."""
    for h in range(first, first + hours):
        t0 = START + timedelta(hours=h)
        met = [t0 + timedelta(minutes=m) for m in range(60)]
        wave = [t0 + timedelta(minutes=m) for m in (0, 20, 40)]
        for instrument, times, fields in (("metbk", met, MET_FIELDS), ("wavss", wave, WAVE_FIELDS)):
            body = {"time": [epoch(t) for t in times]}
            for i, f in enumerate(fields[1:]):
                body[f] = [10.0 + i + math.sin(h + k / 7) for k in range(len(times))]
            if instrument == "metbk":
                body["barometric_pressure"] = [1000.0 + h] * 60
                body["precipitation_level"] = [h + k // 10 * 0.25 for k in range(60)]
            path = root / mooring / deployment / "buoy" / instrument
            path.mkdir(parents=True, exist_ok=True)
            (path / f"{t0:%Y%m%d%H}.{instrument}.json").write_text(json.dumps(body))


def go(spark, tmp_path, as_of=datetime(2026, 3, 9, 10), **options):
    return run_directory(
        spark, str(tmp_path / "raw"), stations(spark), declinations(spark, 14.5), str(tmp_path / "out"),
        str(tmp_path / "progress"), str(tmp_path / "landed"), as_of=as_of, **options,
    )


def files(tmp_path):
    return {str(p.relative_to(tmp_path / "out")): p.read_text("ISO-8859-1") for p in (tmp_path / "out").rglob("*.xml")}


def saved(spark, tmp_path):
    return {(r.site, r.deployment): r.last_bin_end for r in latest_progress(read_progress(spark, str(tmp_path / "progress"))).collect()}


def table(result):
    return {(r.site, r.deployment, r.time): tuple(r)[3:] for r in result.observations.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert x == y or x == pytest.approx(y, abs=1e-9)


def test_first_run_increment_and_reprocess(spark, tmp_path):
    raw_hours(tmp_path / "raw", "ce02shsm", 0, 30)
    raw_hours(tmp_path / "raw", "ce04ossm", 20, 10)
    first = go(spark, tmp_path)
    assert first.deployments == 2
    out = files(tmp_path)
    assert {r.file: r.bytes for r in first.files.collect()} == {f: len(t.encode("ISO-8859-1")) for f, t in out.items()}
    assert sorted(out) == [
        "CE02/D00020/23-01-Mar-2026-46097.xml", "CE02/D00020/23-02-Mar-2026-46097.xml",
        "CE04/D00020/10-09-Mar-2026-46098.xml",
    ]
    assert out["CE02/D00020/23-01-Mar-2026-46097.xml"].count("<message>") == 23 * 6
    assert out["CE02/D00020/23-02-Mar-2026-46097.xml"].count("<message>") == 5 * 6
    assert saved(spark, tmp_path) == {
        ("CE02", "D00020"): datetime(2026, 3, 2, 5), ("CE04", "D00020"): datetime(2026, 3, 2, 5)
    }
    assert go(spark, tmp_path) is None

    raw_hours(tmp_path / "raw", "ce02shsm", 30, 3)
    second = go(spark, tmp_path, as_of=datetime(2026, 3, 9, 11))
    assert second.deployments == 1
    assert files(tmp_path)["CE02/D00020/11-09-Mar-2026-46097.xml"].count("<message>") == 18
    assert saved(spark, tmp_path)[("CE02", "D00020")] == datetime(2026, 3, 2, 8)

    # all at once equals the two increments, but for the last bin's late waves
    whole = go(spark, tmp_path, reprocess=True)
    ce02 = {k: v for k, v in table(whole).items() if k[0] == "CE02"}
    parts = {**{k: v for k, v in table(first).items() if k[0] == "CE02"}, **table(second)}
    late = ("CE02", "D00020", datetime(2026, 3, 2, 4, 50))
    assert parts.pop(late)[:9] == ce02.pop(late)[:9]
    same(parts, ce02)


def test_late_samples_change_their_bins_and_no_others(spark, tmp_path):
    raw_hours(tmp_path / "raw", "ce02shsm", 0, 30)
    first = go(spark, tmp_path, late=True)
    assert first.deployments == 1
    before, out = table(first), files(tmp_path)
    path = tmp_path / "raw/ce02shsm/D00020/buoy/metbk"
    late = [START + timedelta(hours=5, minutes=12, seconds=30), START + timedelta(hours=5, minutes=13, seconds=30)]
    (path / "late.json").write_text(json.dumps({"time": [epoch(t) for t in late], "barometric_pressure": [900.0, 901.0]}))
    assert go(spark, tmp_path, late=True) is None  # no new bins
    now = files(tmp_path)
    day = "CE02/D00020/23-01-Mar-2026-46097.xml"
    assert {f for f in now if now[f] != out[f]} == {day}
    changed = [i for i, (a, b) in enumerate(zip(out[day].split("<message>"), now[day].split("<message>"))) if re.sub("<wdir>.*?</wdir>", "", a) != re.sub("<wdir>.*?</wdir>", "", b)]
    assert len(changed) == 1 and "03/01/2026 05:10:00" in now[day].split("<message>")[changed[0]]
    assert {r.time for r in late_samples(spark, str(tmp_path / "landed/late")).collect()} == set(late)
    assert {r.bin for r in late_samples(spark, str(tmp_path / "landed/late")).collect()} == {START + timedelta(hours=5, minutes=10)}
    args = [LandedTable(spark, str(tmp_path / f"landed/{i}")) for i in ("metbk", "wavss")]
    again = lambda: reissue_late(
        spark, *args, stations(spark), declinations(spark, 14.5), read_progress(spark, str(tmp_path / "progress")), str(tmp_path / "landed/late"))
    assert again() is None and files(tmp_path) == now
    assert len(before) == 28 * 6


def test_a_site_without_waves_waits(spark):
    times = [START + timedelta(minutes=10 * i) for i in range(24)]
    met = met_frame(spark, [{"site": s, "time": t} for s in ("CE02", "CE07") for t in times])
    wave = wave_frame(spark, [{"time": t} for t in times])
    assert [r.site for r in plan_runs(met, wave, stations(spark), declinations(spark)).collect()] == ["CE02"]


def test_progress_is_not_saved_when_writing_fails(spark, tmp_path):
    raw_hours(tmp_path / "raw", "ce02shsm", 0, 4)
    (tmp_path / "out").write_text("a file stands where the folder should")
    with pytest.raises(Exception):
        go(spark, tmp_path)
    assert saved(spark, tmp_path) == {}


def test_alpha_date_and_missing_declination(spark, tmp_path):
    times = [START + timedelta(minutes=10 * i) for i in range(24)]
    met, wave = met_frame(spark, [{"time": t} for t in times]), wave_frame(spark, [{"time": t} for t in times])
    dim = declinations(spark, 14.0, 1.0)
    fixed = plan_runs(met, wave, stations(spark), dim, alpha_date=ntz(datetime(2027, 1, 1, 6, tzinfo=timezone.utc)))
    assert fixed.first().alpha_deg == pytest.approx(15.0)
    own = plan_runs(met, wave, stations(spark), dim).first()
    assert own.alpha_deg == pytest.approx(14.0 + (59 + 2 / 24) / 365.25, abs=1e-6)
    with pytest.raises(ValueError, match="declination"):
        run(spark, met, wave, stations(spark), dim.filter("site = 'CE09'"), str(tmp_path / "out"), str(tmp_path / "progress"))


def test_window_needs_its_days_and_the_last_before(spark, tmp_path):
    for day in (0, 1, 9, 12):
        raw_hours(tmp_path / "raw", "ce02shsm", 24 * day, 3)
    raw_hours(tmp_path / "raw", "ce04ossm", 24 * 5, 3)
    land(load_met(spark, str(tmp_path / "raw"), stations(spark)), str(tmp_path / "landed/metbk"))
    met = LandedTable(spark, str(tmp_path / "landed/metbk"))
    runs = spark.sql("SELECT 'CE02' AS site, 'D00020' AS deployment, timestamp_ntz'2026-03-10 00:30:00' AS bin_start")
    window = met.read(window_zones(met, runs))
    days = {"2026-03-02", "2026-03-10", "2026-03-13"}
    assert {(r.site, str(r.date)) for r in window.select("site", "date").distinct().collect()} == {("CE02", d) for d in days}
    assert {f.split("date=")[1][:10] for f in window.inputFiles()} == days  # no other folder is even listed


def test_no_files(spark, tmp_path):
    (tmp_path / "raw/ce02shsm/D00020/buoy/metbk").mkdir(parents=True)
    (tmp_path / "raw/ce02shsm/D00020/buoy/wavss").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        go(spark, tmp_path)


def test_progress_log(spark, tmp_path):
    path = str(tmp_path / "progress")
    assert read_progress(spark, path).count() == 0
    clear_progress(spark, path, 1)  # nothing to forget
    runs = spark.createDataFrame(
        [("CE02", "D1", datetime(2026, 3, 1, 4)), ("CE04", "D1", datetime(2026, 3, 1, 5))],
        "site string, deployment string, bin_end timestamp_ntz",
    )
    save_progress(runs, path, 2)
    clear_progress(spark, path, 3, ["CE04"])
    assert saved(spark, tmp_path) == {("CE02", "D1"): datetime(2026, 3, 1, 4), ("CE04", "D1"): None}
    save_progress(runs, path, 4)
    assert saved(spark, tmp_path)[("CE04", "D1")] == datetime(2026, 3, 1, 5)
    broken = next(p for p in (tmp_path / "progress").glob("000000000001-delta/*.parquet"))
    broken.write_bytes(b"broken")
    with pytest.warns(UserWarning, match="000000000001-delta"):
        left = read_progress(spark, path)
    assert left.count() >= 2


def test_progress_reads_one_snapshot_and_the_tail(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "DELTAS", 4)
    path = str(tmp_path / "progress")
    for run in range(1, 15):
        rows = spark.createDataFrame(
            [(f"S{run % 3}", "D1", START + timedelta(hours=run))], "site string, deployment string, bin_end timestamp_ntz")
        save_progress(rows, path, run)
    kept = progress_ledger(spark, path)
    assert sum(v.snapshot for v in kept.parts()) == 1 and len(kept.parts()) <= 5
    assert len(kept.read().inputFiles()) <= 5
    assert len(kept.versions()) <= 11  # versions before the last snapshot but one are gone
    assert saved(spark, tmp_path) == {(f"S{r % 3}", "D1"): START + timedelta(hours=r) for r in (12, 13, 14)}


def test_landed_bounds_do_not_scan_the_data(spark, tmp_path):
    """Also with a stray sample of 1970, which the manifest shows like any other."""
    raw_hours(tmp_path / "raw", "ce02shsm", 0, 3)
    path = tmp_path / "raw/ce02shsm/D00020/buoy/metbk/stray.json"
    path.write_text(json.dumps({"time": [3600.0]}))
    table = LandedTable(spark, str(tmp_path / "landed/metbk"))
    samples = load_met(spark, str(tmp_path / "raw"), stations(spark))
    land(samples, table.path)
    times = zone_times(table)
    assert not [f for f in times.inputFiles() if "/data/" in f]
    wave = times.select("site", "deployment", "time")
    from_zones = plan_runs(times, wave, stations(spark), declinations(spark)).collect()
    assert from_zones == plan_runs(samples, wave, stations(spark), declinations(spark)).collect()
    assert from_zones[0].earliest == datetime(1970, 1, 1, 1)


def test_manifest_of_a_failed_and_repeated_job(spark, tmp_path):
    out = str(tmp_path / "out")
    good = spark.createDataFrame([(f"CE02/D1/{k}.xml", "x" * k) for k in range(1, 40)], "file string, content string").repartition(5)
    bad = good.withColumn("content", F.when(F.col("file").endswith("/7.xml"), F.raise_error(F.lit("no"))).otherwise(F.col("content")))
    with pytest.raises(Exception):
        write_text_files(bad, out, manifest="run")
    with pytest.raises(FileNotFoundError):
        written_files(spark, out, "run")
    assert write_text_files(good, out, manifest="run") == "run"
    on_disk = {str(p.relative_to(tmp_path / "out")): p.stat().st_size for p in (tmp_path / "out").rglob("*.xml")}
    assert {r.file: r.bytes for r in written_files(spark, out, "run").collect()} == on_disk


def test_declination_of_many_references(spark):
    """The last reference not after the date, among 200,000 a site; the first one where all lie after it."""
    n = 200_000
    refs = spark.range(2 * n).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'CE02' ELSE 'CE04' END AS site", "timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(0, 0, id DIV 2 * 60) AS ref_date",
        "double(id DIV 2) AS decl_deg", "0.0D AS rate_deg_per_year")
    rows = spark.createDataFrame(
        [(k, s, d) for k, (s, d) in enumerate([
            ("CE02", datetime(1999, 1, 1)), ("CE02", datetime(2000, 1, 1)), ("CE02", datetime(2010, 5, 5, 5, 30)), ("CE04", datetime(2015, 1, 1, 0, 59)),
            ("CE04", datetime(2090, 1, 1)), ("CE09", datetime(2010, 1, 1)), ("CE02", None)])],
        "_at long, site string, day timestamp_ntz")
    got = with_declination(rows, refs, F.col("day")).collect()
    hours = lambda d: (d - datetime(2000, 1, 1)) // timedelta(hours=1)
    assert {r._at: r.alpha_deg for r in got} == {
        0: 0.0, 1: 0.0, 2: hours(datetime(2010, 5, 5, 5, 30)), 3: hours(datetime(2015, 1, 1)), 4: n - 1.0, 5: None, 6: None}
    assert got[0].asDict().keys() == {"_at", "site", "day", "alpha_deg"}


def test_state_files_carry_over(spark, tmp_path):
    def put(mooring, deployment, site, body):
        path = tmp_path / mooring / deployment / "buoy" / "metbk" / "xml"
        path.mkdir(parents=True)
        (path / f"{site}_position.json").write_text(body)

    put("ce02shsm", "D00020", "CE02", json.dumps({"last_bin_end": "2026-03-30T12:00:00+00:00", "station": "CE02"}, indent=2))
    put("ce04ossm", "D00019", "CE04", json.dumps({"last_bin_end": "2026-03-30T12:00:00", "station": "CE04"}))
    put("ce07shsm", "D00020", "CE07", json.dumps({"last_bin_end": "2026-03-30T05:00:00-07:00", "station": "CE07"}))
    put("ce09ossm", "D00020", "CE09", "not json")
    rows = progress_from_state_files(spark, f"{tmp_path}/*/*/buoy/metbk/xml")
    got = {(r.site, r.deployment): r.last_bin_end for r in latest_progress(rows).collect()}
    noon = datetime(2026, 3, 30, 12)
    assert got == {("CE02", "D00020"): noon, ("CE04", "D00019"): noon, ("CE07", "D00020"): noon}
