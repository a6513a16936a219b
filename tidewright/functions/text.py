"""Text rendering of values, messages, headers and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: the bulletin format ------------------------------------------
MISSING = "-9999"
BULLETIN_PREFIX = "SXML99 KWBC "
XML_DECLARATION = '<?xml version="1.0" encoding="ISO-8859-1"?>'
ENCODING = "ISO-8859-1"
#: (tag, binned column) in message order; the four constant tags and the depth
#: stand between the two groups
TAGS_BEFORE_DEPTH = [
    ("wdir1", "wind_dir"),
    ("wspd1", "wind_speed"),
    ("baro1", "baro"),
    ("atmp1", "air_temp"),
    ("rrh", "rel_humidity"),
    ("srad1", "shortwave"),
    ("lwrad", "longwave"),
    ("wvhgt", "sig_wave_hgt"),
    ("dompd", "peak_period"),
    ("mwdir", "wave_dir"),
    ("tp001", "sst"),
]
CONSTANT_TAGS = [("fm64iii", "830"), ("fm64xx", "99"), ("fm64k1", "7"), ("fm64k2", "1")]
TAGS_AFTER_DEPTH = [("wtmp1", "sst"), ("sp001", "salinity")]

#: Splits a double into two halves whose products with 2e6 are exact (2^27 + 1).
_SPLIT = "134217729D"


def _off_tie(x: str) -> str:
    """``x``, moved off a rounding tie at six decimals when it must round down.

    ``format_string`` rounds the shortest decimal text of a double half up.  The
    bulletin rounds the exact binary value, half to even.  The two differ only
    where that text ends on a 5 in the seventh place; there the sign of the exact
    distance to the tie, ``|x| * 2e6`` less an odd number, decides.
    """
    size = f"abs({x})"
    halves = f"rint({size} * 2e6D)"
    high = f"({_SPLIT} * {size} - ({_SPLIT} * {size} - {size}))"
    product = f"({size} * 2e6D)"
    distance = f"(({product} - {halves}) + (({high} * 2e6D - {product}) + ({size} - {high}) * 2e6D))"
    down = f"{distance} < 0D OR ({distance} = 0D AND pmod(({halves} - 1D) / 2D, 2D) = 0D)"
    return (
        f"CASE WHEN pmod({halves}, 2D) = 1D AND {halves} / 2e6D = {size}"
        f" THEN CASE WHEN {down} THEN {x} - signum({x}) * 2e-7D ELSE {x} END ELSE {x} END"
    )


def _value_sql(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL OR isnan({x}) OR abs({x}) = double('inf') THEN '{MISSING}'"
        f" ELSE format_string('%.6f', {_off_tie(x)}) END"
    )


def format_value(column: str) -> Column:
    """Six decimals; NULL, NaN and infinities become the missing marker."""
    return F.expr(_value_sql(column))


def tag(name: str, column: str) -> Column:
    return F.concat(F.lit(f"<{name}>"), format_value(column), F.lit(f"</{name}>"))


def _iso(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.f]``; unlike ``date_format`` it never uses a time zone."""
    return ts.cast("string")


def date_text(ts: Column) -> Column:
    """``MM/DD/YYYY HH:MM:SS``."""
    s = _iso(ts)
    return F.concat(
        F.substring(s, 6, 2), F.lit("/"), F.substring(s, 9, 2), F.lit("/"), F.substring(s, 1, 4),
        F.lit(" "), F.substring(s, 12, 8),
    )


def message(station_id: Column, time: Column, depth_m: Column) -> Column:
    """One ``<message>`` block from the binned columns of a row."""

    def fixed(name: str, text: Column) -> Column:
        return F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>"))

    return F.concat_ws(
        "\n",
        F.lit("<message>"),
        fixed("station", station_id),
        fixed("date", date_text(time)),
        F.lit(f"<missing>{MISSING}</missing>"),
        F.lit("<roundtime>no</roundtime>"),
        F.lit("<met>"),
        *[tag(name, c) for name, c in TAGS_BEFORE_DEPTH],
        *[F.lit(f"<{name}>{text}</{name}>") for name, text in CONSTANT_TAGS],
        fixed("dp001", depth_m.cast("string")),
        *[tag(name, c) for name, c in TAGS_AFTER_DEPTH],
        F.lit("</met>"),
        F.lit("</message>"),
    )


def bulletin_header(last_time: Column) -> Column:
    """Header line: day, hour and minute of the last observation of a file."""
    s = _iso(last_time)
    return F.concat(F.lit(BULLETIN_PREFIX), F.substring(s, 9, 2), F.substring(s, 12, 2), F.substring(s, 15, 2))


def daily_file_name(station_id: Column, day: Column, hour: Column) -> Column:
    """``HH-DD-Mon-YYYY-id.xml`` for a date and an hour."""
    return F.concat(
        F.lpad(hour.cast("string"), 2, "0"),
        F.date_format(day.cast("date"), "-dd-MMM-yyyy-"),
        station_id,
        F.lit(".xml"),
    )


def file_name(station_id: Column, as_of: Column) -> Column:
    """``HH-DD-Mon-YYYY-id.xml`` for the time of the run."""
    return daily_file_name(station_id, F.to_date(as_of), F.hour(as_of))


def day_file_hour(day: Column, as_of: Column) -> Column:
    """Hour in a daily file name: the run's hour today, 23 for every other day."""
    return F.when(day == F.to_date(as_of), F.hour(as_of)).otherwise(F.lit(23))
