"""Bulletin files: one text per station and day, or one per short run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions import text
from tidewright.model import KEYS

FILE_KEYS = [*KEYS, "station_id", "file_name"]


def file_names(binned: DataFrame, runs: DataFrame, as_of: Column) -> DataFrame:
    """Add the station's id, depth and the file each bin goes to.

    Runs longer than one day get a file per UTC day, others a single file named
    after ``as_of``.  ``runs`` has one row per deployment, with ``bin_start``,
    ``bin_end``, ``station_id`` and ``sensor_depth_m``.
    """
    run = runs.select(
        *KEYS, "station_id", "sensor_depth_m",
        (F.col("bin_end") - F.col("bin_start") > F.expr("INTERVAL 1 DAY")).alias("daily"),
    )
    day = F.to_date("time")
    station = F.col("station_id")
    name = F.when(
        F.col("daily"), text.daily_file_name(station, day, text.day_file_hour(day, as_of))
    ).otherwise(text.file_name(station, as_of))
    return binned.join(run, KEYS).withColumn("file_name", name).drop("daily")


#: Files that one task makes and writes.
FILES_PER_TASK = 100


def bulletin_files(named: DataFrame, n_files: int | None = None) -> DataFrame:
    """Text of each file: header, declaration, messages in time order.

    ``n_files`` is about how many there are; it sets the number of tasks, which the few bytes of
    the numbers would put far too low.

    Numbers are shuffled to their file before they become text, which is several
    times larger.  A file holds at most the 144 bins of a day.
    """
    tasks = [] if n_files is None else [max(1, -(-n_files // FILES_PER_TASK))]
    rows = named.repartition(*tasks, *FILE_KEYS).withColumn(
        "message", text.message(F.col("station_id"), F.col("time"), F.col("sensor_depth_m"))
    )
    files = rows.groupBy(*FILE_KEYS).agg(
        F.max("time").alias("last_time"),
        F.count("*").alias("n_messages"),
        F.sort_array(F.collect_list(F.struct("time", "message"))).alias("messages"),
    )
    content = F.concat_ws(
        "\n",
        text.bulletin_header(F.col("last_time")),
        F.lit(text.XML_DECLARATION),
        F.col("messages.message"),
    )
    return files.select(*FILE_KEYS, "n_messages", content.alias("content"))
