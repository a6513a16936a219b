from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewright.functions import text
from tidewright.model import KEYS
from tidewright.operators.bulletin import bulletin_files, file_names
from tidewright.sinks.text_files import write_text_files, written_files

FIELDS = {
    "wind_dir": 270.0, "wind_speed": 5.0, "baro": 1013.0, "air_temp": 12.0, "rel_humidity": 80.0, "shortwave": 200.0,
    "longwave": 350.0, "sig_wave_hgt": 1.2, "peak_period": 9.0, "wave_dir": 280.0, "sst": 11.5, "salinity": 32.8,
}


def observed(spark, start, n, **changes):
    values = {**FIELDS, **changes}
    rows = [("CE02", "D00001", start + timedelta(minutes=10 * i), *values.values()) for i in range(n)]
    schema = "site string, deployment string, time timestamp_ntz, " + ", ".join(f"{c} double" for c in values)
    return spark.createDataFrame(rows, schema)


def runs(spark, start, end):
    return spark.createDataFrame(
        [("CE02", "D00001", "46097", 1.15, start, end)],
        "site string, deployment string, station_id string, sensor_depth_m double, bin_start timestamp_ntz, bin_end timestamp_ntz",
    )


def as_of(moment):
    return F.lit(str(moment)).cast("timestamp_ntz")


def test_message(spark):
    df = observed(spark, datetime(2026, 3, 30, 12), 1, wind_dir=None)
    body = df.select(text.message(F.lit("46097"), F.col("time"), F.lit(1.15))).first()[0]
    assert body.splitlines() == [
        "<message>", "<station>46097</station>", "<date>03/30/2026 12:00:00</date>", "<missing>-9999</missing>",
        "<roundtime>no</roundtime>", "<met>", "<wdir1>-9999</wdir1>", "<wspd1>5.000000</wspd1>",
        "<baro1>1013.000000</baro1>", "<atmp1>12.000000</atmp1>", "<rrh>80.000000</rrh>", "<srad1>200.000000</srad1>",
        "<lwrad>350.000000</lwrad>", "<wvhgt>1.200000</wvhgt>", "<dompd>9.000000</dompd>", "<mwdir>280.000000</mwdir>",
        "<tp001>11.500000</tp001>", "<fm64iii>830</fm64iii>", "<fm64xx>99</fm64xx>", "<fm64k1>7</fm64k1>",
        "<fm64k2>1</fm64k2>", "<dp001>1.15</dp001>", "<wtmp1>11.500000</wtmp1>", "<sp001>32.800000</sp001>",
        "</met>", "</message>",
    ]
    deep = df.select(text.message(F.lit("46097"), F.col("time"), F.lit(2.0))).first()[0]
    assert "<dp001>2.0</dp001>" in deep


def test_short_run_makes_one_file(spark):
    start = datetime(2026, 3, 30, 22)
    rows = file_names(observed(spark, start, 18), runs(spark, start, start + timedelta(hours=3)), as_of(datetime(2026, 3, 31, 1, 2)))
    files = bulletin_files(rows).collect()
    assert [(f.file_name, f.n_messages) for f in files] == [("01-31-Mar-2026-46097.xml", 18)]
    lines = files[0].content.split("\n")
    assert lines[0] == "SXML99 KWBC 310050"
    assert lines[1] == '<?xml version="1.0" encoding="ISO-8859-1"?>'
    assert lines[2] == "<message>" and lines[-1] == "</message>"
    dates = [line for line in lines if line.startswith("<date>")]
    assert len(dates) == 18 and dates[0] == "<date>03/30/2026 22:00:00</date>" and dates[-1] == "<date>03/31/2026 00:50:00</date>"


@pytest.mark.parametrize("hours,files", [(24, 1), (25, 2)])
def test_longer_than_a_day_is_split(spark, hours, files):
    start = datetime(2026, 3, 30, 1)
    rows = file_names(
        observed(spark, start, hours * 6), runs(spark, start, start + timedelta(hours=hours)), as_of(datetime(2026, 3, 31, 9))
    )
    got = {f.file_name: f.n_messages for f in bulletin_files(rows).collect()}
    expected = {24: {"09-31-Mar-2026-46097.xml": 144}, 25: {"23-30-Mar-2026-46097.xml": 138, "09-31-Mar-2026-46097.xml": 12}}
    assert got == expected[hours] and len(got) == files


def test_sink_writes_replaces_and_keeps_bytes(spark, tmp_path):
    df = spark.createDataFrame([("a/one.xml", "café\nend"), ("b/two.xml", "x")], "file string, content string")
    names = [write_text_files(df.repartition(2), str(tmp_path), encoding="ISO-8859-1") for _ in range(2)]
    assert (tmp_path / "a/one.xml").read_bytes() == b"caf\xe9\nend"
    # besides the files there is a manifest of each job, and nothing else
    held = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file() and "_manifests" not in p.parts)
    assert held == ["a/one.xml", "b/two.xml"]
    assert sorted(p.name for p in (tmp_path / "_manifests").iterdir()) == sorted(names)
    for name in names:
        assert {(r.file, r.bytes) for r in written_files(spark, str(tmp_path), name).collect()} == {("a/one.xml", 8), ("b/two.xml", 1)}


def test_empty_sink_raises(spark, tmp_path):
    df = spark.createDataFrame([("a", "b")], "file string, content string").limit(0)
    with pytest.raises(Exception, match="no rows to write"):
        write_text_files(df, str(tmp_path))
    write_text_files(df, str(tmp_path), allow_empty=True)
    assert KEYS == ["site", "deployment"]
