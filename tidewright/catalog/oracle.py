"""DuckDB SQL for the registered queries, written independently of the Spark plans.

Joins and windows are plain here: deployments are joined, not unioned, and rain is
one window per station.
"""

from __future__ import annotations

from tidewright.catalog import fixtures
from tidewright.catalog.queries import DIGITS
from tidewright.functions import seawater as sw
from tidewright.functions import text
from tidewright.model import BINNED_FIELDS, DEFAULT_SENSOR_DEPTH_M, MET_FIELDS, QC_BOUNDS, STATIONS, WAVE_FIELDS

AS_OF = f"TIMESTAMP '{fixtures.AS_OF}'"


def _literal(v: object) -> str:
    if v is None:
        return "NULL"
    return f"'{v}'" if isinstance(v, str) else str(v).lower()


def _values(rows: list[tuple], types: dict[str, str], name: str) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    cast = ", ".join(f"{c}::{t} AS {c}" for c, t in types.items())
    return f"{name} AS (SELECT {cast} FROM (VALUES {body}) t({', '.join(types)}))"


def _poly(coefs: list[float], x: str) -> str:
    """Sum of powers, unlike the Horner form of the Spark side."""
    return "(" + " + ".join(f"({c!r})::DOUBLE * ({x}) ** {i}" for i, c in enumerate(coefs)) + ")"


def _round(columns: list[str]) -> str:
    return ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in columns)


STATION_CTE = _values(
    STATIONS,
    {"site": "VARCHAR", "mooring": "VARCHAR", "station_id": "VARCHAR", "latitude": "DOUBLE", "longitude": "DOUBLE"},
    "station",
)
DECLINATION_CTE = _values(
    fixtures.DECLINATIONS,
    {"site": "VARCHAR", "ref_date": "TIMESTAMP", "decl_deg": "DOUBLE", "rate": "DOUBLE"},
    "declination",
)
PROGRESS_CTE = _values(
    fixtures.PROGRESS,
    {"site": "VARCHAR", "deployment": "VARCHAR", "last_bin_end": "TIMESTAMP", "run_id": "BIGINT", "cleared": "BOOLEAN"},
    "progress",
)
NO_PROGRESS_CTE = "progress AS (SELECT NULL::VARCHAR AS site, NULL::TIMESTAMP AS last_bin_end, 0 AS run_id, false AS cleared WHERE false)"

SOURCE_CTES = """
keyed AS (
  SELECT *, CASE user_id % 4 WHEN 0 THEN 'CE02' WHEN 1 THEN 'CE04' WHEN 2 THEN 'CE07' ELSE 'CE09' END AS site,
         'D00001' AS deployment, ts AS time, json_extract_string(props, '$.k')::DOUBLE AS k
  FROM events),
raw_met AS (
  SELECT site, deployment, time, event_id,
         (-15 + event_id % 50)::DOUBLE AS air_temperature, (850 + event_id % 211)::DOUBLE AS barometric_pressure,
         (event_id % 41 - 20) * 0.5::DOUBLE AS eastward_wind_velocity,
         (event_id % 29 - 14) * 0.5::DOUBLE AS northward_wind_velocity,
         250 + 2 * k AS longwave_irradiance, CASE WHEN event_id % 23 <> 0 THEN k * 1.25::DOUBLE END AS relative_humidity,
         2.5::DOUBLE + (event_id % 17) * 0.1::DOUBLE AS sea_surface_conductivity,
         (event_id % 28)::DOUBLE AS sea_surface_temperature, value * 5 AS shortwave_irradiance,
         (event_id % 100) * 0.25::DOUBLE AS precipitation_level
  FROM keyed WHERE event_type IN ('view', 'click', 'error')),
raw_wave AS (
  SELECT site, deployment, time, event_id, 4 + k / 4 AS peak_period, 3 + k / 6 AS average_wave_period,
         value / 15 AS significant_wave_height, value / 10 AS maximum_wave_height,
         ((event_id * 13) % 360)::DOUBLE AS mean_wave_direction
  FROM keyed WHERE event_type IN ('purchase', 'signup')),
met AS (SELECT * FROM raw_met QUALIFY row_number() OVER (PARTITION BY site, time ORDER BY event_id) = 1),
wave AS (SELECT * FROM raw_wave QUALIFY row_number() OVER (PARTITION BY site, time ORDER BY event_id) = 1)"""

_sin2 = "sin(radians(latitude)) ** 2"


def _pressure(depth: str) -> str:
    head = f"({sw.GRAVITY_EQUATOR!r}::DOUBLE * {_poly(sw.GRAVITY, _sin2)} * ({depth} + 0.5::DOUBLE * {sw.GRAVITY_DEPTH!r}::DOUBLE * ({depth}) ** 2))"
    start = f"({head} / (1e4::DOUBLE * {sw.SPECIFIC_VOLUME[0]!r}::DOUBLE))"
    z = f"({start} / 1e4::DOUBLE)"
    h = f"(1e8::DOUBLE * {_poly([0.0] + [c / (i + 1) for i, c in enumerate(sw.SPECIFIC_VOLUME)], z)})"
    return f"{start} - ({h} - {head}) / (1e4::DOUBLE * {_poly(sw.SPECIFIC_VOLUME, z)})"


def _salinity_ctes(source: str, cond: str, temp: str, pres: str, out: str) -> str:
    """``out`` is ``source`` with a ``salinity`` column."""
    rp = (
        f"(1 + {pres} * {_poly(sw.RP_E, pres)} / ({_poly(sw.RP_T, 't68')} + {_poly(sw.RP_R, 't68')} * r))"
    )
    return f"""
{out}_a AS (SELECT *, {temp} * {sw.ITS90_TO_IPTS68!r}::DOUBLE AS t68, {cond} * 10 * {sw.R_PER_C!r}::DOUBLE AS r FROM {source}),
{out}_b AS (SELECT *, (t68 - 15) / (1 + {sw.F_K!r}::DOUBLE * (t68 - 15)) AS ft, r / ({rp} * {_poly(sw.RT_C, 't68')}) AS rt FROM {out}_a),
{out}_c AS (SELECT *, CASE WHEN rt >= 0 THEN sqrt(CASE WHEN rt >= 0 THEN rt END) END AS x FROM {out}_b),
{out}_d AS (SELECT *, {_poly(sw.SAL_A, 'x')} + ft * {_poly(sw.SAL_B, 'x')} AS sp FROM {out}_c),
{out}_e AS (SELECT *, CASE WHEN sp >= 2 THEN sp ELSE (1 + {_poly(sw.LOW_SALINITY_JOIN, 'ft')}) * (
    sp - {sw.SAL_A[0]!r}::DOUBLE / {_poly([1.0, 1.5, 1.0], '400 * x * x')}
       - ft * {sw.SAL_B[0]!r}::DOUBLE / {_poly([1.0, 1.0, 1.0, 1.0], '10 * x')}) END AS sj FROM {out}_d),
{out} AS (SELECT * EXCLUDE (t68, r, ft, rt, x, sp, sj), CASE WHEN sj >= 0 THEN sj END AS salinity FROM {out}_e)"""


def _dir(u: str, v: str, scale: str = "0") -> str:
    """Direction a vector comes from; 180 where it is at most 1e-9 of its scale long."""
    d = f"degrees(atan2(-({u}), -({v})))"
    calm = f"sqrt(({u}) * ({u}) + ({v}) * ({v})) <= 1e-9::DOUBLE * ({scale})"
    return f"CASE WHEN {calm} THEN 180 WHEN {d} < 0 THEN {d} + 360 ELSE {d} END"


RUN_CTES = f"""
extent AS (SELECT site, min(time) AS earliest, max(time) AS latest FROM met
           WHERE site IN (SELECT site FROM wave) GROUP BY site),
last_run AS (SELECT site, CASE WHEN NOT cleared THEN last_bin_end END AS saved FROM progress
             QUALIFY row_number() OVER (PARTITION BY site ORDER BY run_id DESC) = 1),
bounds AS (SELECT e.*, coalesce(saved, time_bucket(INTERVAL 10 MINUTE, earliest + INTERVAL 1 HOUR)) AS bin_start,
                  date_trunc('hour', latest) AS bin_end
           FROM extent e LEFT JOIN last_run USING (site)),
edges AS (SELECT *, bin_start + to_minutes(10 * (datediff('microsecond', bin_start, bin_end) // 600000000)) AS grid_end,
                 bin_start + to_microseconds(datediff('microsecond', bin_start, bin_end) // 2) AS mid_date
          FROM bounds WHERE bin_end > bin_start),
runs AS (SELECT e.*, s.* EXCLUDE (site), decl_deg + rate * (epoch(mid_date) - epoch(ref_date)) / (365.25::DOUBLE * 86400) AS alpha_deg,
                {_pressure(f'{DEFAULT_SENSOR_DEPTH_M}::DOUBLE')} AS pressure_dbar
         FROM edges e JOIN station s USING (site) JOIN declination USING (site) WHERE grid_end > bin_start)"""

RUN_SQL_COLUMNS = f"""site, earliest, latest, bin_start, bin_end, grid_end, mid_date, station_id,
  round(alpha_deg, {DIGITS}) AS alpha_deg, round(pressure_dbar, {DIGITS}) AS pressure_dbar"""


def _bin(shift: str) -> str:
    micros = f"datediff('microsecond', bin_start, time + INTERVAL '{shift}')"
    return f"bin_start + to_minutes(10 * CAST(floor({micros} / 6e8::DOUBLE) AS BIGINT))"


_COS, _SIN = "cos(radians(alpha_deg))", "sin(radians(alpha_deg))"

BIN_CTES = f"""
spine AS (SELECT site, unnest(generate_series(bin_start, grid_end - INTERVAL 10 MINUTE, INTERVAL 10 MINUTE)) AS time FROM runs),
levels AS (SELECT *, precipitation_level - lag(precipitation_level) OVER (PARTITION BY site ORDER BY time) AS step FROM met),
met_run AS (SELECT l.*, r.* EXCLUDE (site), {_bin('5 minutes')} AS bin,
                   eastward_wind_velocity * {_COS} + northward_wind_velocity * {_SIN} AS u,
                   northward_wind_velocity * {_COS} - eastward_wind_velocity * {_SIN} AS v
            FROM levels l JOIN runs r USING (site)),
{_salinity_ctes('met_run', 'sea_surface_conductivity', 'sea_surface_temperature', 'pressure_dbar', 'met_sal').strip()},
met_bins AS (SELECT site, bin AS time, avg(sqrt(u * u + v * v)) AS wind_speed, avg(u) AS mu, avg(v) AS mv,
                    avg(barometric_pressure) AS baro, avg(air_temperature) AS air_temp, avg(relative_humidity) AS rel_humidity,
                    avg(shortwave_irradiance) AS shortwave, avg(longwave_irradiance) AS longwave,
                    avg(sea_surface_temperature) AS sst, avg(salinity) AS salinity,
                    avg(CASE WHEN step >= 0.2::DOUBLE AND step <= 2.5::DOUBLE THEN step END) AS rain_rate
             FROM met_sal WHERE bin >= bin_start AND bin < grid_end GROUP BY site, bin),
wave_run AS (SELECT w.*, bin_start, grid_end, {_bin('-10 minutes')} AS bin,
                    cos(radians(270 - mean_wave_direction)) AS wu, sin(radians(270 - mean_wave_direction)) AS wv,
                    {_COS} AS ca, {_SIN} AS sa FROM wave w JOIN runs USING (site)),
wave_bins AS (SELECT site, bin AS time, avg(significant_wave_height) AS sig_wave_hgt, avg(maximum_wave_height) AS max_wave_hgt,
                     avg(peak_period) AS peak_period, avg(average_wave_period) AS avg_period,
                     avg(wu * ca + wv * sa) AS wmu, avg(wv * ca - wu * sa) AS wmv
              FROM wave_run WHERE bin >= bin_start AND bin < grid_end GROUP BY site, bin),
joined AS (SELECT coalesce(m.site, w.site) AS site, coalesce(m.time, w.time) AS time, m.* EXCLUDE (site, time), w.* EXCLUDE (site, time),
                  {_dir('mu', 'mv', 'wind_speed')} AS wind_dir, {_dir('wmu', 'wmv', '1')} AS wave_dir
           FROM met_bins m FULL JOIN wave_bins w ON m.site = w.site AND m.time = w.time),
binned AS (SELECT * FROM spine LEFT JOIN joined USING (site, time)),
checked AS (SELECT site, time, rain_rate, {", ".join(f"CASE WHEN {c} >= {lo} AND {c} <= {hi} THEN {c} END AS {c}" for c, (lo, hi) in QC_BOUNDS.items())}
            FROM binned)"""

_MON = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"


def _name(day: str, hour: str) -> str:
    return (
        f"printf('%02d', {hour}) || '-' || strftime({day}, '%d') || '-' || ({_MON})[month({day})] || '-' || "
        f"strftime({day}, '%Y') || '-' || station_id || '.xml'"
    )


_DAILY_NAME = _name("time::DATE", f"CASE WHEN time::DATE = {AS_OF}::DATE THEN hour({AS_OF}) ELSE 23 END")
NAMED_CTE = f"""
named AS (SELECT c.*, station_id, CASE WHEN bin_end - bin_start > INTERVAL 1 DAY THEN {_DAILY_NAME}
                 ELSE {_name(AS_OF, f'hour({AS_OF})')} END AS file_name
          FROM checked c JOIN (SELECT site, station_id, bin_start, bin_end FROM runs) USING (site))"""


def _fmt(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR NOT isfinite({x}) THEN '{text.MISSING}' ELSE format('{{:.6f}}', {x}) END"


def _message() -> str:
    lines = [
        "'<message>'", "'<station>' || station_id || '</station>'",
        "'<date>' || strftime(time, '%m/%d/%Y %H:%M:%S') || '</date>'",
        "'<missing>-9999</missing>'", "'<roundtime>no</roundtime>'", "'<met>'",
    ]
    lines += [f"'<{t}>' || {_fmt(c)} || '</{t}>'" for t, c in text.TAGS_BEFORE_DEPTH]
    lines += [f"'<{t}>{v}</{t}>'" for t, v in text.CONSTANT_TAGS]
    lines += [f"'<dp001>{DEFAULT_SENSOR_DEPTH_M}</dp001>'"]
    lines += [f"'<{t}>' || {_fmt(c)} || '</{t}>'" for t, c in text.TAGS_AFTER_DEPTH]
    lines += ["'</met>'", "'</message>'"]
    return "concat_ws(chr(10), " + ", ".join(lines) + ")"


def _run(select: str, resumed: bool, ctes: list[str] | None = None) -> str:
    parts = [SOURCE_CTES, STATION_CTE, DECLINATION_CTE, PROGRESS_CTE if resumed else NO_PROGRESS_CTE, RUN_CTES]
    return "WITH " + ",\n".join(p.strip() for p in parts + (ctes or [])) + f"\n{select}"


def _source(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in (SOURCE_CTES, STATION_CTE, DECLINATION_CTE, *ctes)) + f"\n{select}"


_MET = ", ".join(MET_FIELDS)
_FILE_NO = "CAST(floor(epoch(time) / 3600) AS BIGINT)"
_ROTATED_U = "({u}) * cos(radians(alpha)) + ({v}) * sin(radians(alpha))"
_ROTATED_V = "({v}) * cos(radians(alpha)) - ({u}) * sin(radians(alpha))"
_WU, _WV = "cos(radians(270 - mean_wave_direction))", "sin(radians(270 - mean_wave_direction))"
_ALPHA = "(event_id % 720 - 360)::DOUBLE"
_QC_SAMPLE = ", ".join(
    f"round(CASE WHEN {c} >= {lo} AND {c} <= {hi} THEN {c} END, {DIGITS}) AS {c}"
    for c, (lo, hi) in QC_BOUNDS.items() if c != "wind_dir"
)
_MET_VALUES = ["wind_speed", "baro", "air_temp", "rel_humidity", "shortwave", "longwave", "sst", "salinity"]
_JOIN_VALUES = ["wind_speed", "baro", "sig_wave_hgt", "max_wave_hgt", "peak_period", "avg_period"]
_STREAM_VALUES = [c for c in BINNED_FIELDS if c != "rain_rate"]

#: Bins of all samples by the clock, and every bin between a station's first and last one that closed an hour before the newest sample.
_STREAM_SERIES = [
    """steps AS (SELECT *, precipitation_level - lag(precipitation_level) OVER (PARTITION BY site ORDER BY time) AS step,
                time_bucket(INTERVAL 10 MINUTE, time + INTERVAL 5 MINUTE) AS bin FROM met WHERE site IN (SELECT site FROM runs))""",
    """full_bins AS (SELECT site, bin AS time, count(*) AS n, avg(air_temperature) AS air_temp,
                  avg(CASE WHEN step >= 0.2::DOUBLE AND step <= 2.5::DOUBLE THEN step END) AS rain_rate FROM steps GROUP BY site, bin)""",
    """closing AS (SELECT site, min(time) AS a, max(time) AS b FROM full_bins
                WHERE time + INTERVAL 10 MINUTE <= (SELECT max(time) + INTERVAL 5 MINUTE FROM steps) - INTERVAL 1 HOUR GROUP BY site)""",
    "every AS (SELECT site, unnest(generate_series(a, b, INTERVAL 10 MINUTE)) AS time FROM closing)",
]

ORACLE: dict[str, str] = {
    "flagship": _run(
        f"SELECT site, station_id, file_name, time, {_round(BINNED_FIELDS)} FROM named", True, [BIN_CTES, NAMED_CTE]
    ),
    "ingest_json": _source(f"SELECT site, deployment, {_MET} FROM met"),
    "ingest_wave_json": _source(
        f"SELECT site, deployment, time - INTERVAL 10 MINUTE AS time, {_round(WAVE_FIELDS[1:])} FROM wave"
    ),
    "ragged_arrays": _source(
        f"""SELECT * EXCLUDE (event_id, kind, precipitation_level, air_temperature),
          CASE WHEN kind <> 1 THEN precipitation_level END AS precipitation_level,
          CASE WHEN kind <> 2 THEN air_temperature END AS air_temperature
        FROM (SELECT *, {_FILE_NO} % 4 AS kind,
                     (row_number() OVER (PARTITION BY site, {_FILE_NO} ORDER BY event_id) - 1)::INTEGER AS pos
              FROM raw_met) WHERE kind <> 3"""
    ),
    "rejected_files": _source(
        f"""SELECT CASE WHEN kind = 4 THEN 'x' ELSE '' END || mooring || '/D00001' AS folder, printf('%08d.metbk.json', file_no) AS file,
          CASE kind WHEN 0 THEN 'corrupt' WHEN 1 THEN 'empty' WHEN 2 THEN 'corrupt' WHEN 3 THEN 'short column air_temperature'
               ELSE 'unknown mooring' END AS reason
        FROM (SELECT DISTINCT site, {_FILE_NO} AS file_no, {_FILE_NO} % 16 AS kind FROM raw_met) JOIN station USING (site)
        WHERE kind <= 4"""
    ),
    "landed_bounds": _source(
        """SELECT site, deployment, time::DATE AS date, min(time) AS first_time, max(time) AS last_time, count(*) AS n
        FROM met GROUP BY ALL"""
    ),
    "compacted_samples": _source(f"SELECT site, deployment, 1::BIGINT AS n_batches, {_MET} FROM met"),
    "met_stream": _source(f"SELECT site, deployment, {_MET} FROM met"),
    "wave_stream": _source(
        f"SELECT site, deployment, time - INTERVAL 10 MINUTE AS time, {_round(WAVE_FIELDS[1:])} FROM wave"
    ),
    "station_dim": _source(
        f"""SELECT s.*, {DEFAULT_SENSOR_DEPTH_M}::DOUBLE AS sensor_depth_m, n_samples, first_time, last_time
        FROM station s JOIN (SELECT site, count(*) AS n_samples, min(time) AS first_time, max(time) AS last_time
                             FROM keyed GROUP BY site) USING (site)"""
    ),
    "dedup_first": _source(
        f"""SELECT site, deployment, date_trunc('minute', time) AS time, event_id, {", ".join(MET_FIELDS[1:])} FROM raw_met
        QUALIFY row_number() OVER (PARTITION BY site, date_trunc('minute', time) ORDER BY event_id) = 1"""
    ),
    "epoch_to_ts": """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN
          make_timestamp(CAST((1.7e9::DOUBLE + event_id * 0.25::DOUBLE) * 1000000 AS BIGINT)) END AS time FROM events""",
    "rotate_wind": _source(
        f"""SELECT event_id, round({_ROTATED_U.format(u='u', v='v')}, {DIGITS}) + 0.0 AS u_true,
          round({_ROTATED_V.format(u='u', v='v')}, {DIGITS}) + 0.0 AS v_true
        FROM (SELECT event_id, eastward_wind_velocity AS u, northward_wind_velocity AS v, {_ALPHA} AS alpha FROM raw_met)"""
    ),
    "wind_speed": _source(
        f"""SELECT event_id, round(sqrt(eastward_wind_velocity ** 2 + northward_wind_velocity ** 2), {DIGITS}) AS wind_speed
        FROM raw_met"""
    ),
    "wind_direction": _source(
        f"SELECT event_id, round({_dir('eastward_wind_velocity', 'northward_wind_velocity')}, {DIGITS}) AS wind_dir FROM raw_met"
    ),
    "rotate_wave_dir": _source(
        f"""SELECT event_id, round({_ROTATED_U.format(u=_WU, v=_WV)}, {DIGITS}) + 0.0 AS u_true,
          round({_ROTATED_V.format(u=_WU, v=_WV)}, {DIGITS}) + 0.0 AS v_true FROM (SELECT *, {_ALPHA} AS alpha FROM raw_wave)"""
    ),
    "wave_direction": _source(
        f"""SELECT event_id, round((mean_wave_direction + 0.5::DOUBLE + event_id % 360) % 360, {DIGITS}) AS wave_dir FROM raw_wave"""
    ),
    "salinity": _source(
        f"SELECT event_id, round(salinity, {DIGITS}) AS salinity FROM sal",
        """cond AS (SELECT event_id, sea_surface_temperature AS temperature, (event_id % 40) * 0.25::DOUBLE AS pressure,
             CASE WHEN event_id % 5 = 0 THEN (event_id % 40) * 0.01::DOUBLE ELSE sea_surface_conductivity END AS conductivity
           FROM raw_met)""",
        _salinity_ctes("cond", "conductivity", "temperature", "pressure", "sal"),
    ),
    "station_pressure": _source(
        f"""SELECT event_id, site, depth_m, round({_pressure('depth_m')}, {DIGITS}) AS pressure_dbar
        FROM (SELECT event_id, site, (event_id % 80) * 0.25::DOUBLE AS depth_m FROM raw_met) JOIN station USING (site)"""
    ),
    "declination_angle": f"""SELECT event_id, round(degrees(atan2((event_id % 9001 - 4500)::DOUBLE,
          (event_id % 18007 + 1000)::DOUBLE)), {DIGITS}) AS decl_deg FROM events""",
    "declination_lookup": _source(
        f"""SELECT event_id, site,
          round(decl_deg + rate * (epoch(time) - epoch(ref_date)) / (365.25::DOUBLE * 86400), {DIGITS}) AS own_deg,
          round(decl_deg + rate * (epoch(TIMESTAMP '{fixtures.ALPHA_DATE}') - epoch(ref_date)) / (365.25::DOUBLE * 86400), {DIGITS}) AS fixed_deg
        FROM keyed JOIN declination USING (site)"""
    ),
    "format_values": f"""WITH v AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'nan'::DOUBLE
          WHEN event_id % 50 = 1 THEN 'inf'::DOUBLE WHEN event_id % 50 = 2 THEN NULL
          WHEN event_id % 2 = 0 THEN (event_id * 10 + 5) / 1e7::DOUBLE ELSE value / 128 - 1 END AS x FROM events)
        SELECT event_id, {_fmt('x')} AS text, '<wspd1>' || {_fmt('x')} || '</wspd1>' AS tag FROM v""",
    "run_bounds": _run(f"SELECT {RUN_SQL_COLUMNS} FROM runs", False),
    "resume_bounds": _run(f"SELECT {RUN_SQL_COLUMNS} FROM runs", True),
    "rain_rate": _source(
        """SELECT site, event_id, time, precipitation_level,
          CASE WHEN step >= 0.2::DOUBLE AND step <= 2.5::DOUBLE THEN step END AS rain_rate
        FROM (SELECT *, precipitation_level - lag(precipitation_level) OVER (PARTITION BY site ORDER BY time) AS step FROM met)"""
    ),
    "bin_spine": _run("SELECT site, time FROM spine", True, [BIN_CTES]),
    "bin_means": _run(f"SELECT site, time, {_round(_MET_VALUES)} FROM met_bins", True, [BIN_CTES]),
    "met_wave_join": _run(f"SELECT site, time, {_round(_JOIN_VALUES)} FROM joined", False, [BIN_CTES]),
    "vector_mean_dir": _run(f"SELECT site, time, {_round(['wind_dir', 'wave_dir'])} FROM joined", False, [BIN_CTES]),
    "gap_fill": _run(f"SELECT site, time, {_round(['air_temp'])} FROM binned", True, [BIN_CTES]),
    "binned_obs": _run(f"SELECT site, time, {_round(BINNED_FIELDS)} FROM binned", False, [BIN_CTES]),
    "apply_qc": _source(
        f"SELECT event_id, {_QC_SAMPLE} FROM both_kinds",
        """both_kinds AS (
          SELECT event_id, sqrt((eastward_wind_velocity * 6) ** 2 + (northward_wind_velocity * 6) ** 2) AS wind_speed,
                 barometric_pressure AS baro, air_temperature AS air_temp, relative_humidity AS rel_humidity,
                 shortwave_irradiance AS shortwave, CASE WHEN event_id % 7 <> 0 THEN longwave_irradiance * 5 END AS longwave,
                 sea_surface_temperature AS sst, (event_id % 60)::DOUBLE AS salinity
          FROM raw_met
          UNION ALL BY NAME
          SELECT event_id, significant_wave_height AS sig_wave_hgt, maximum_wave_height AS max_wave_hgt, peak_period,
                 average_wave_period AS avg_period, mean_wave_direction * 1.5::DOUBLE - 60 AS wave_dir
          FROM raw_wave)""",
    ),
    "messages": _run(f"SELECT site, time, {_message()} AS message FROM named", True, [BIN_CTES, NAMED_CTE]),
    "bulletin_header": _run(
        f"""SELECT site, time::DATE AS day, '{text.BULLETIN_PREFIX}' || strftime(max(time), '%d%H%M') AS header
        FROM spine GROUP BY ALL""", False, [BIN_CTES]
    ),
    "file_names": _source(
        f"""SELECT site, day, {_name('day', f"CASE WHEN day = {AS_OF}::DATE THEN hour({AS_OF}) ELSE 23 END")} AS daily_name,
          {_name('day', '7')} AS run_name
        FROM (SELECT DISTINCT site, time::DATE AS day FROM keyed) JOIN station USING (site)"""
    ),
    "daily_split": _run(
        """SELECT site, station_id, file_name, count(*) AS n_messages, min(time) AS first_time, max(time) AS last_time,
          count(sst) AS n_sst, count(sig_wave_hgt) AS n_waves FROM named GROUP BY ALL""", False, [BIN_CTES, NAMED_CTE]
    ),
    "bulletin_files": _run(
        f"""SELECT site, station_id, file_name, count(*) AS n_messages,
          '{text.BULLETIN_PREFIX}' || strftime(max(time), '%d%H%M') || chr(10) || '{text.XML_DECLARATION}' || chr(10) ||
          string_agg(message, chr(10) ORDER BY time) AS content
        FROM (SELECT *, {_message()} AS message FROM named) GROUP BY site, station_id, file_name""",
        True, [BIN_CTES, NAMED_CTE]
    ),
    "published_files": _run(
        f"""SELECT site || '/' || file_name AS file, strlen(
          '{text.BULLETIN_PREFIX}' || strftime(max(time), '%d%H%M') || chr(10) || '{text.XML_DECLARATION}' || chr(10) ||
          string_agg(message, chr(10) ORDER BY time)) AS bytes
        FROM (SELECT *, {_message()} AS message FROM named) GROUP BY site, station_id, file_name""",
        True, [BIN_CTES, NAMED_CTE]
    ),
    "stream_bins": _run(
        f"""SELECT site, time, {", ".join(
            f"round(CASE WHEN {c} >= {QC_BOUNDS[c][0]} AND {c} <= {QC_BOUNDS[c][1]} THEN {c} END, {DIGITS}) AS {c}" for c in _STREAM_VALUES
        )} FROM closed""", False,
        [BIN_CTES.replace(" WHERE bin >= bin_start AND bin < grid_end", ""),
         """closed AS (SELECT * FROM joined WHERE time + INTERVAL 10 MINUTE <= (
              SELECT greatest((SELECT max(time) + INTERVAL 5 MINUTE FROM met), (SELECT max(time) - INTERVAL 10 MINUTE FROM wave))
            ) - INTERVAL 1 HOUR)"""]
    ),
    "stream_bins_copies": _run(
        f"""SELECT site, time, {", ".join(
            f"round(CASE WHEN {c} >= {QC_BOUNDS[c][0]} AND {c} <= {QC_BOUNDS[c][1]} THEN {c} END, {DIGITS}) AS {c}" for c in _STREAM_VALUES
        )} FROM closed""", False,
        [BIN_CTES.replace(" WHERE bin >= bin_start AND bin < grid_end", ""),
         """closed AS (SELECT * FROM joined WHERE time + INTERVAL 10 MINUTE <= (
              SELECT greatest((SELECT max(time) + INTERVAL 5 MINUTE FROM met), (SELECT max(time) - INTERVAL 10 MINUTE FROM wave))
            ) - INTERVAL 1 HOUR)"""]
    ),
    "stream_rain": _run(
        f"""SELECT site, time, round(rain_rate, {DIGITS}) AS rain_rate, coalesce(n, 0) AS n_samples FROM every LEFT JOIN full_bins USING (site, time)""",
        False, _STREAM_SERIES
    ),
    "stream_gap_fill": _run(
        f"""SELECT site, time, round(CASE WHEN air_temp >= -10 AND air_temp <= 30 THEN air_temp END, {DIGITS}) AS air_temp
        FROM every LEFT JOIN full_bins USING (site, time)""",
        False, _STREAM_SERIES
    ),
    "stream_anchored": _source(
        f"""SELECT site, bin AS time, round(CASE WHEN baro >= 860 AND baro <= 1050 THEN baro END, {DIGITS}) AS baro,
          round(CASE WHEN wind_speed <= 60 THEN wind_speed END, {DIGITS}) AS wind_speed,
          round(CASE WHEN sig_wave_hgt >= 0 AND sig_wave_hgt <= 30 THEN sig_wave_hgt END, {DIGITS}) AS sig_wave_hgt,
          round(CASE WHEN peak_period >= 0 AND peak_period <= 30 THEN peak_period END, {DIGITS}) AS peak_period
        FROM (SELECT site, bin, avg(baro) AS baro, avg(speed) AS wind_speed, avg(hgt) AS sig_wave_hgt, avg(period) AS peak_period, any_value(off) AS off
              FROM placed GROUP BY site, bin)
        WHERE bin - off + INTERVAL 10 MINUTE <= (SELECT max(moved) FROM placed) - INTERVAL 1 HOUR""",
        """shifted AS (
          SELECT site, time + INTERVAL 5 MINUTE AS t, barometric_pressure AS baro, sqrt(eastward_wind_velocity ** 2 + northward_wind_velocity ** 2) AS speed,
                 NULL::DOUBLE AS hgt, NULL::DOUBLE AS period FROM met
          UNION ALL SELECT site, time - INTERVAL 10 MINUTE, NULL, NULL, significant_wave_height, peak_period FROM wave),
        placed AS (
          SELECT *, t - off AS moved, time_bucket(INTERVAL 10 MINUTE, t - off) + off AS bin
          FROM (SELECT *, to_minutes(CASE site WHEN 'CE04' THEN 3 WHEN 'CE07' THEN 7 ELSE 0 END) AS off FROM shifted)
          WHERE site IN (SELECT site FROM wave) AND site IN (SELECT site FROM met))""",
    ),
    "late_bins": _source(
        f"""SELECT m.site, m.bin AS time, round(CASE WHEN m.baro >= 860 AND m.baro <= 1050 THEN m.baro END, {DIGITS}) AS baro,
          round(CASE WHEN m.air_temp >= -10 AND m.air_temp <= 30 THEN m.air_temp END, {DIGITS}) AS air_temp,
          round(CASE WHEN m.wind_speed <= 60 THEN m.wind_speed END, {DIGITS}) AS wind_speed, round(m.rain_rate, {DIGITS}) AS rain_rate,
          round(CASE WHEN w.hgt >= 0 AND w.hgt <= 30 THEN w.hgt END, {DIGITS}) AS sig_wave_hgt
        FROM means m JOIN issued USING (site) LEFT JOIN waves w ON m.site = w.site AND m.bin = w.bin
        WHERE m.n_late > 0 AND m.bin + INTERVAL 10 MINUTE <= last_bin_end AND m.bin >= first_bin""",
        """levels AS (SELECT *, time_bucket(INTERVAL 10 MINUTE, time + INTERVAL 5 MINUTE) AS bin,
                 precipitation_level - lag(precipitation_level) OVER (PARTITION BY site ORDER BY time) AS step FROM met)""",
        """means AS (SELECT site, bin, count(*) FILTER (event_id % 50 = 0) AS n_late, avg(barometric_pressure) AS baro, avg(air_temperature) AS air_temp,
                 avg(sqrt(eastward_wind_velocity ** 2 + northward_wind_velocity ** 2)) AS wind_speed,
                 avg(CASE WHEN step >= 0.2::DOUBLE AND step <= 2.5::DOUBLE THEN step END) AS rain_rate FROM levels GROUP BY ALL)""",
        """waves AS (SELECT site, time_bucket(INTERVAL 10 MINUTE, time - INTERVAL 10 MINUTE) AS bin, avg(significant_wave_height) AS hgt FROM wave GROUP BY ALL)""",
        """issued AS (SELECT site, date_trunc('hour', max(time) FILTER (event_id % 50 <> 0)) AS last_bin_end,
                 time_bucket(INTERVAL 10 MINUTE, min(time) + INTERVAL 1 HOUR) AS first_bin FROM met GROUP BY site)""",
    ),
    "cleared_bounds": _source(
        """SELECT site, deployment, bin_start, bin_end,
             bin_start + to_minutes(10 * (datediff('microsecond', bin_start, bin_end) // 600000000)) AS grid_end
           FROM (SELECT site, CASE WHEN event_id % 2 = 0 THEN 'D00001' ELSE 'D00002' END AS deployment, date_trunc('hour', max(time)) AS bin_end,
                   CASE WHEN site IN ('CE02', 'CE07') AND min(event_id % 2) = 1 THEN time_bucket(INTERVAL 10 MINUTE, min(time) + INTERVAL 1 HOUR)
                        ELSE min(time) + INTERVAL 3 HOUR END AS bin_start
                 FROM raw_met GROUP BY site, event_id % 2)
           WHERE bin_end > bin_start AND datediff('microsecond', bin_start, bin_end) >= 600000000"""
    ),
}
