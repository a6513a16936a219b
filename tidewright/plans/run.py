"""The whole run, for every deployment at once: samples to bulletins to progress."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.text import ENCODING
from tidewright.model import KEYS
from tidewright.operators.bins import bin_observations
from tidewright.operators.bounds import run_bounds, run_days, with_run_constants
from tidewright.operators.bulletin import bulletin_files, file_names
from tidewright.operators.qc import apply_qc
from tidewright.plans.late import reissue_late
from tidewright.plans.progress import clear_progress, latest_progress, read_progress, save_progress
from tidewright.session import materialize
from tidewright.sinks.text_files import check_path, write_text_files, written_files
from tidewright.sources.array_json import INSTRUMENTS, deduplicate, instrument_files, samples
from tidewright.sources.landed import LandedTable, land, window_zones, zone_times
from tidewright.streaming.landing import land_new_files


@dataclass(frozen=True)
class RunResult:
    """``runs``: what was processed, one row per deployment; ``observations``: its bins; ``files``: the manifest of what was written.

    ``files`` has the site, the deployment, the file, relative to the output folder, and its bytes.
    """

    runs: DataFrame
    observations: DataFrame
    deployments: int
    files: DataFrame


def ntz(moment: datetime) -> Column:
    """A literal UTC timestamp; a naive ``moment`` is UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def plan_runs(
    met: DataFrame,
    wave: DataFrame,
    stations: DataFrame,
    declinations: DataFrame,
    progress: DataFrame | None = None,
    alpha_date: Column | None = None,
) -> DataFrame:
    """Bounds and constants of each deployment with new bins and both instruments.

    Copies of a time stamp make no difference here.
    """
    # one aggregation: time stamps of waves count as a mark only
    times = met.select(*KEYS, "time", F.lit(False).alias("waves")).union(
        wave.select(*KEYS, F.lit(None).cast("timestamp_ntz"), F.lit(True)))
    extent = times.groupBy(*KEYS).agg(
        F.min("time").alias("earliest"), F.max("time").alias("latest"), F.bool_or("waves").alias("waves"))
    both = extent.where("waves AND earliest IS NOT NULL").drop("waves")
    saved = None if progress is None else latest_progress(progress)
    return with_run_constants(run_bounds(both, saved), stations, declinations, alpha_date)


def observations(met: DataFrame, wave: DataFrame, runs: DataFrame) -> DataFrame:
    """Quality-checked bins of every run."""
    return apply_qc(bin_observations(met, wave, runs))


def bulletins(observed: DataFrame, runs: DataFrame, as_of: Column) -> DataFrame:
    """Bulletin text per file."""
    return bulletin_files(file_names(observed, runs, as_of), run_days(runs))


def run(
    spark: SparkSession,
    met: DataFrame | LandedTable,
    wave: DataFrame | LandedTable,
    stations: DataFrame,
    declinations: DataFrame,
    out_path: str,
    progress_path: str,
    as_of: datetime | None = None,
    alpha_date: datetime | None = None,
    reprocess: bool = False,
    run_id: int | None = None,
    sites: list[str] | None = None,
    deployments: list[str] | None = None,
) -> RunResult | None:
    """Write bulletins of all new bins and record the progress; None without new bins.

    ``sites`` and ``deployments`` limit the run, and what ``reprocess`` forgets: only deployments that have
    samples in this run, at a station of ``stations``.  Samples may be any frames unique per time stamp, or landed
    tables: then bounds and days come from their manifests and only the folders of the dates in question are read.
    Progress is recorded after the files are written: a run that breaks off is
    repeated.  Files go to ``<out_path>/<site>/<deployment>/``.
    """
    check_path(out_path)
    as_of = as_of or datetime.now(timezone.utc)

    def chosen(df: DataFrame) -> DataFrame:
        for column, wanted in (("site", sites), ("deployment", deployments)):
            if wanted is not None:
                df = df.where(F.col(column).isin(wanted))
        return df

    met_times, wave_times = (chosen(zone_times(t) if isinstance(t, LandedTable) else t) for t in (met, wave))
    run_id = time.time_ns() // 1000 if run_id is None else run_id
    if reprocess:
        clear_progress(spark, progress_path, run_id, only=met_times.select(*KEYS).join(stations.select("site"), "site", "left_semi"))
        run_id += 1
    alpha = None if alpha_date is None else ntz(alpha_date)
    progress = read_progress(spark, progress_path)
    runs = materialize(plan_runs(met_times, wave_times, stations, declinations, progress, alpha), "runs")
    counts = runs.agg(F.count("*").alias("n"), F.count("alpha_deg").alias("n_alpha")).first()
    if counts["n"] == 0:
        return None
    if counts["n_alpha"] < counts["n"]:
        raise ValueError("no declination for some stations with new data")
    met, wave = (samples_of(t, runs) if isinstance(t, LandedTable) else chosen(t) for t in (met, wave))
    observed = materialize(observations(met, wave, runs), "observations")
    path = F.concat_ws("/", "site", "deployment", "file_name").alias("file")
    manifest = write_text_files(
        bulletins(observed, runs, ntz(as_of)).select("*", path), out_path, encoding=ENCODING, manifest=f"run-{run_id}-{uuid.uuid4().hex[:8]}")
    save_progress(runs, progress_path, run_id)
    keys = F.split("file", "/")
    written = written_files(spark, out_path, manifest).select(keys[0].alias("site"), keys[1].alias("deployment"), "file", "bytes")
    return RunResult(runs, observed, counts["n"], written)


def samples_of(table: LandedTable, runs: DataFrame) -> DataFrame:
    """Landed samples that the runs need; empty ones where the table has none on their days."""
    found = table.read(window_zones(table, runs))
    return table.read().limit(0) if found is None else found


def land_directory(spark: SparkSession, root: str, stations: DataFrame, landed_path: str) -> dict[str, int]:
    """Land every file under ``root``, new or not; returns files seen, corrupt and empty.

    Without any file this raises ``FileNotFoundError``, without a readable one
    ``ValueError``.
    """
    totals: dict[str, int] = {}
    for instrument, (_, fields) in INSTRUMENTS.items():
        files = instrument_files(spark, root, instrument)
        if files.isEmpty():
            raise FileNotFoundError(f"no {instrument} files under {root}")
        watch = Observation(f"{instrument}_files")
        if not land(deduplicate(samples(files, fields, stations, watch)), f"{landed_path}/{instrument}"):
            raise ValueError(f"all {instrument} files under {root} failed to load")
        seen = watch.get
        totals.update({f"{instrument}_{k}": v for k, v in seen.items()})
    return totals


def run_directory(
    spark: SparkSession, root: str, stations: DataFrame, declinations: DataFrame, out_path: str,
    progress_path: str, landed_path: str, late: bool = False, **options,
) -> RunResult | None:
    """Land the files that are new under ``root``, then run on the landed samples.

    With ``late`` the bins and files that late samples change are issued again first, see ``plans.late``.

    Files landed by an earlier call are not parsed again; what is wrong with a file is recorded under
    ``<landed_path>/rejected_<instrument>``.  An instrument without
    any landed sample raises ``FileNotFoundError``.
    """
    landed = {}
    for instrument in INSTRUMENTS:
        path = f"{landed_path}/{instrument}"
        land_new_files(spark, root, instrument, stations, path, f"{landed_path}/seen_{instrument}", f"{landed_path}/rejected_{instrument}")
        landed[instrument] = LandedTable(spark, path)
        if landed[instrument].zones().isEmpty():
            raise FileNotFoundError(f"no readable {instrument} files under {root}")
    if late:
        reissue_late(
            spark, landed["metbk"], landed["wavss"], stations, declinations, read_progress(spark, progress_path), f"{landed_path}/late", out_path,
            options.get("as_of"))
    return run(spark, landed["metbk"], landed["wavss"], stations, declinations, out_path, progress_path, **options)
