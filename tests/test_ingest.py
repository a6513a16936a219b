import json
import os
import shutil
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from tests.util import T0, epoch
from tidewright.model import MET_FIELDS, WAVE_FIELDS, stations
from tidewright.session import LISTING, materialize
from tidewright.sources import array_json, ledger
from tidewright.sources.file_groups import read_whole
from tidewright.sources.landed import LandedTable, land, read_landed
from tidewright.plans.run import land_directory
from tidewright.streaming.landing import land_new_files, listing, rejected_files, seen_files

BASE = epoch(datetime(2026, 1, 1))


def folder(root, mooring="ce02shsm", deployment="D00020", instrument="metbk"):
    path = root / mooring / deployment / "buoy" / instrument
    path.mkdir(parents=True, exist_ok=True)
    return path


def put(path, name, body):
    (path / name).write_text(body if isinstance(body, str) else json.dumps(body))


def load(spark, root):
    rows = array_json.load_met(spark, str(root), stations(spark)).orderBy("site", "deployment", "time").collect()
    return [r.asDict() for r in rows]


def test_columns_nulls_and_literals(spark, tmp_path):
    put(folder(tmp_path), "a.json", '{"time": [%f, %f, %f, %f], "air_temperature": [1.5, null, NaN, Infinity], "extra": [1]}'
        % (BASE, BASE + 60, BASE + 120, BASE + 180))
    rows = load(spark, tmp_path)
    assert [r["air_temperature"] for r in rows] == [1.5, None, None, float("inf")]
    assert {r["barometric_pressure"] for r in rows} == {None}
    assert {(r["site"], r["deployment"]) for r in rows} == {("CE02", "D00020")}
    assert rows[0]["time"] == datetime(2026, 1, 1)
    assert set(rows[0]) == {"site", "deployment", "file_path", "pos", *MET_FIELDS}


def test_short_column_is_blank_but_the_file_stays(spark, tmp_path):
    put(folder(tmp_path), "a.json", {"time": [BASE, BASE + 60], "air_temperature": [1.0], "barometric_pressure": [1000, 1001]})
    rows = load(spark, tmp_path)
    assert [(r["air_temperature"], r["barometric_pressure"]) for r in rows] == [(None, 1000.0), (None, 1001.0)]


def test_short_time_drops_the_rows(spark, tmp_path):
    put(folder(tmp_path), "a.json", {"time": [BASE], "air_temperature": [1.0, 2.0]})
    put(folder(tmp_path), "b.json", {"time": [BASE + 600], "air_temperature": [3.0]})
    assert [r["air_temperature"] for r in load(spark, tmp_path)] == [3.0]


def test_bad_files_are_skipped_and_counted(spark, tmp_path):
    for mooring in ("ce02shsm", "unknown"):
        path = folder(tmp_path, mooring)
        put(path, "good.json", {"time": [BASE], "air_temperature": [1.0]})
    path = folder(tmp_path)
    put(path, "bad.json", '{"time": [1,')
    put(path, "empty.json", "{}")
    put(path, "text.json", {"time": [BASE], "air_temperature": ["warm"]})
    put(path, "note.txt", "not JSON")
    put(folder(tmp_path, instrument="wavss"), "w.wavss.json", {"time": [BASE]})
    assert [r["air_temperature"] for r in load(spark, tmp_path)] == [1.0]
    totals = land_directory(spark, str(tmp_path), stations(spark), str(tmp_path / "landed"))
    assert totals == {"metbk_files": 5, "metbk_corrupt": 2, "metbk_empty": 1,
                      "wavss_files": 1, "wavss_corrupt": 0, "wavss_empty": 0}


def test_no_files_and_no_good_files(spark, tmp_path):
    put(folder(tmp_path, instrument="wavss"), "w.wavss.json", {"time": [BASE]})
    folder(tmp_path)
    with pytest.raises(FileNotFoundError):
        land_directory(spark, str(tmp_path), stations(spark), str(tmp_path / "landed1"))
    put(folder(tmp_path), "bad.json", "not json")
    with pytest.raises(ValueError):
        land_directory(spark, str(tmp_path), stations(spark), str(tmp_path / "landed2"))


def test_globs_and_subfolders(spark, tmp_path):
    path = folder(tmp_path)
    put(path, "a.json", {"time": [BASE]})
    put(path, "b.wavss.json", {"time": [BASE + 60]})
    (path / "xml").mkdir()
    put(path / "xml", "state.json", {"time": [BASE + 120]})
    assert len(load(spark, tmp_path)) == 2  # *.json also matches *.wavss.json; subfolders do not count
    wave = folder(tmp_path, instrument="wavss")
    put(wave, "a.json", {"time": [BASE]})
    put(wave, "b.wavss.json", {"time": [BASE + 1200], "peak_period": [9.0]})
    rows = array_json.shifted_wave(array_json.load_wave(spark, str(tmp_path), stations(spark))).collect()
    assert [(r.time, r.peak_period) for r in rows] == [(datetime(2026, 1, 1, 0, 10), 9.0)]
    assert set(WAVE_FIELDS) <= set(rows[0].asDict())


def test_copies_across_files_and_deployments(spark, tmp_path):
    put(folder(tmp_path), "2.json", {"time": [BASE, BASE + 60], "air_temperature": [2.0, 2.5]})
    put(folder(tmp_path), "1.json", {"time": [BASE, BASE], "air_temperature": [1.0, 9.0]})
    put(folder(tmp_path, deployment="D00021"), "0.json", {"time": [BASE], "air_temperature": [7.0]})
    got = [(r["deployment"], r["air_temperature"]) for r in load(spark, tmp_path)]
    assert got == [("D00020", 1.0), ("D00020", 2.5), ("D00021", 7.0)]


def test_landing_adds_each_time_stamp_once(spark, tmp_path):
    put(folder(tmp_path), "1.json", {"time": [BASE, BASE + 60], "air_temperature": [1.0, 1.5]})
    target = str(tmp_path / "landed")
    samples = array_json.load_met(spark, str(tmp_path), stations(spark))
    land(samples, target)
    land(samples, target)
    put(folder(tmp_path), "2.json", {"time": [BASE + 60, BASE + 90000], "air_temperature": [8.0, 2.0]})
    land(array_json.load_met(spark, str(tmp_path), stations(spark)), target)
    got = read_landed(spark, target).orderBy("time")
    assert [r.air_temperature for r in got.collect()] == [1.0, 1.5, 2.0]
    plan = got.filter(F.col("date") >= F.lit("2026-01-02").cast("date"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def landing(spark, root, tmp_path, instrument="metbk"):
    paths = [str(tmp_path / f"{name}_{instrument}") for name in ("landed", "seen", "rejected")]
    return lambda: land_new_files(spark, str(root), instrument, stations(spark), *paths), *paths


def test_lands_only_new_files(spark, tmp_path):
    root = tmp_path / "raw"
    call, landed, _, _ = landing(spark, root, tmp_path)
    put(folder(root), "1.json", {"time": [BASE], "air_temperature": [1.0]})
    assert call() == 1
    put(folder(root), "2.json", {"time": [BASE, BASE + 60], "air_temperature": [5.0, 2.0]})
    assert [call(), call()] == [1, 0]
    assert [r.air_temperature for r in read_landed(spark, landed).orderBy("time").collect()] == [1.0, 2.0]
    shutil.copy(folder(root) / "2.json", folder(root) / "3.json")
    assert call() == 1
    assert read_landed(spark, landed).count() == 2


def test_old_modification_times_land(spark, tmp_path):
    root = tmp_path / "raw"
    call, landed, _, _ = landing(spark, root, tmp_path)
    put(folder(root), "1.json", {"time": [BASE], "air_temperature": [1.0]})
    call()
    other = folder(root, mooring="ce04ossm", deployment="D00021")
    put(folder(root), "0 [old] {x}.json", {"time": [BASE - 3600], "air_temperature": [2.0]})
    put(other, "1.json", {"time": [BASE], "air_temperature": [3.0]})
    for days, file in ((30, folder(root) / "0 [old] {x}.json"), (400, other / "1.json")):
        os.utime(file, (time.time() - days * 86400,) * 2)
    assert [call(), call()] == [2, 0]
    assert sorted(r.air_temperature for r in read_landed(spark, landed).collect()) == [1.0, 2.0, 3.0]


def test_rejected_files_are_recorded(spark, tmp_path):
    root = tmp_path / "raw"
    call, landed, _, rejected = landing(spark, root, tmp_path)
    put(folder(root), "1.json", {"time": [BASE], "air_temperature": [1.0]})
    put(folder(root), "corrupt.json", '{"time": [1,')
    put(folder(root), "empty.json", "{}")
    put(folder(root), "zero.json", "")
    put(folder(root), "short.json", {"time": [BASE + 60, BASE + 120], "air_temperature": [2.0]})
    put(folder(root, mooring="xx99zzzz"), "1.json", {"time": [BASE]})
    call()
    got = sorted((r.file_path[r.file_path.index("/raw/") + 5:].replace("/D00020/buoy/metbk", ""), r.reason)
                 for r in rejected_files(spark, landed, rejected).collect())
    assert got == [("ce02shsm/corrupt.json", "corrupt"), ("ce02shsm/empty.json", "empty"),
                   ("ce02shsm/short.json", "short column air_temperature"), ("xx99zzzz/1.json", "unknown mooring")]
    assert read_landed(spark, landed).count() == 3
    put(folder(root), "zero.json", {"time": [BASE + 180]})  # zero bytes so far
    assert call() == 1 and read_landed(spark, landed).count() == 4


def test_numbers_written_as_strings(spark, tmp_path):
    put(folder(tmp_path), "a.json", {"time": [str(BASE)], "air_temperature": ["1.5"]})
    assert [r["air_temperature"] for r in load(spark, tmp_path)] == [1.5]


def rows_of(df):
    return sorted((r.site, r.deployment, r.time, r.air_temperature) for r in df.collect())


def test_compaction_while_a_reader_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "DELTAS", 3)
    root = tmp_path / "raw"
    call, landed, _, _ = landing(spark, root, tmp_path)
    table = LandedTable(spark, landed)
    for h in range(5):
        for mooring in ("ce02shsm", "ce04ossm"):
            put(folder(root, mooring), f"{h}.json", {"time": [BASE + 3600 * h, BASE + 86400 + h], "air_temperature": [h, h + 0.5]})
        assert call() == 2
    reader = table.read()
    before, files = rows_of(reader), len(reader.inputFiles())
    assert len(before) == 20 and files >= 20
    assert table.compact() == 4
    assert len(table.read().inputFiles()) == 4
    assert rows_of(reader) == rows_of(table.read()) == before  # the reader that began before goes on
    assert table.compact() == 0
    assert table.vacuum() == 5
    assert rows_of(table.read()) == before
    put(folder(root), "9.json", {"time": [BASE, BASE + 9 * 3600], "air_temperature": [70.0, 9.0]})
    assert call() == 1
    assert rows_of(table.read()) == sorted([*before, ("CE02", "D00020", datetime(2026, 1, 1, 9), 9.0)])
    assert sum(r["rows"] for r in table.zones().collect()) == 21
    assert len(table.manifest.parts()) <= 4


@pytest.mark.parametrize("step", ["rejected", "seen", "manifest"])
def test_a_landing_that_breaks_off_leaves_nothing_twice(spark, tmp_path, monkeypatch, step):
    root = tmp_path / "raw"
    call, landed, seen, rejected = landing(spark, root, tmp_path)
    put(folder(root), "0.json", {"time": [BASE], "air_temperature": [0.0]})
    put(folder(root), "bad0.json", "[")
    call()
    put(folder(root), "1.json", {"time": [BASE, BASE + 60], "air_temperature": [8.0, 1.0]})
    put(folder(root), "bad1.json", "[")
    write = ledger.Ledger.write

    def breaks(self, rows, number, snapshot=False):
        if step in self.path:
            raise RuntimeError("lost")
        write(self, rows, number, snapshot)

    monkeypatch.setattr(ledger.Ledger, "write", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        call()
    assert read_landed(spark, landed).count() == 1 and rejected_files(spark, landed, rejected).count() == 1
    monkeypatch.setattr(ledger.Ledger, "write", write)
    put(folder(root), "2.json", {"time": [BASE + 120], "air_temperature": [2.0]})
    assert [call(), call()] == [3, 0]
    assert [r[3] for r in rows_of(read_landed(spark, landed))] == [0.0, 1.0, 2.0]
    names = [r.file_path.rsplit("/", 1)[1] for r in rejected_files(spark, landed, rejected).collect()]
    assert sorted(names) == ["bad0.json", "bad1.json"]
    assert seen_files(spark, seen, 99).count() == 5


def test_many_files_land_in_one_pass(spark, tmp_path):
    root = tmp_path / "raw"
    path = folder(root)
    for k in range(7_000):
        (path / f"{k}.json").write_text('{"time": [%d], "air_temperature": [%d]}' % (BASE + 60 * k, k % 30))
    call, landed, _, _ = landing(spark, root, tmp_path)
    assert [call(), call()] == [7_000, 0]
    table = LandedTable(spark, landed)
    assert table.manifest.last() == 1 and table.read().count() == 7_000


def test_a_file_that_goes_away_is_told(spark, tmp_path):
    lost = spark.createDataFrame([(f"file:{tmp_path}/none.json", 9)], "path string, length long")
    whole, _ = read_whole(materialize(lost, "lost"))
    assert [(r.content, r.fault) for r in whole.collect()] == [(None, "FileNotFoundError")]


def test_plan_of_the_parser_stays_small(spark, tmp_path):
    put(folder(tmp_path), "a.json", {"time": [BASE]})
    plan = array_json.load_met(spark, str(tmp_path), stations(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") <= 22 or plan.count("TRY") <= 22


def test_top_level_lists_are_rejected(spark, tmp_path):
    root = tmp_path / "raw"
    call, landed, _, rejected = landing(spark, root, tmp_path)
    put(folder(root), "1.json", [{"time": [BASE]}, {"time": [BASE + 60]}])
    put(folder(root), "2.json", '{"time": [%f, NaN, "%f"], "air_temperature": [NaN, 1, "2.5"], "barometric_pressure": [Infinity, -Infinity, 3]}' % (BASE, BASE + 60))
    call()
    assert [(r.air_temperature, r.barometric_pressure) for r in read_landed(spark, landed).orderBy("time").collect()] == [(None, float("inf")), (2.5, 3.0)]
    assert [r.reason for r in rejected_files(spark, landed, rejected).collect()] == ["corrupt"]


def test_folders_are_listed_whole(spark, tmp_path):
    """One task a folder, not one for every few files; zero bytes, hidden files, subfolders and other names do not count."""
    for i in range(100):
        for deployment in ("D1", "D 2"):
            at = tmp_path / "ce02shsm" / deployment / "buoy" / "metbk"
            at.mkdir(parents=True, exist_ok=True)
            (at / f"a b{i}.json").write_text("{}" * (i % 3))
    for name in (".x.json", "_x.json", "x.txt", "sub/x.json"):
        (at / name).parent.mkdir(exist_ok=True)
        (at / name).write_text("{}")
    found = listing(spark, f"{tmp_path}/*/*/buoy/metbk", "*.json")
    plain = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(f"{tmp_path}/*/*/buoy/metbk")
    assert sorted(found.collect()) == sorted(plain.select("path", "length").collect()) and found.count() == 132
    assert found.rdd.getNumPartitions() == 2
    assert listing(spark, f"{tmp_path}/*/*/buoy/wavss", "*.json").count() == 0


def test_landed_folders_are_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    """Spark starts a task for each folder otherwise, up to 10,000."""
    at = [T0 + timedelta(days=d) for d in range(40)]
    rows = spark.createDataFrame([("CE02", "D1", t, 1.0) for t in at], "site string, deployment string, time timestamp_ntz, x double")
    land(rows, str(tmp_path / "landed"))
    allowed, plain = [], DataFrameReader.parquet

    def parquet(self, *paths, **options):
        if any("date=" in p for p in paths):
            allowed.append(int(spark.conf.get(LISTING)))
        return plain(self, *paths, **options)

    monkeypatch.setattr(DataFrameReader, "parquet", parquet)
    assert sorted(r.time for r in read_landed(spark, str(tmp_path / "landed")).collect()) == at
    assert allowed and max(allowed) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(LISTING, None) is None
