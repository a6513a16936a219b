"""Landing of new files: a record of the paths landed so far decides what is new.

Modification times play no part, so back-fills and restored archives land like any other file.  What a call lands is one batch: samples,
rejects and paths are written under its number, and the manifest of the samples, written last, makes all three count.  A call that
broke off is not seen and repeated by the next, under the same number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.model import KEYS
from tidewright.session import discard, materialize
from tidewright.sources.array_json import INSTRUMENTS, ORIGIN, deduplicate, parse_files, rejects, samples
from tidewright.sources.file_groups import list_files, read_whole
from tidewright.sources.landed import LandedTable, unseen
from tidewright.sources.ledger import Ledger

SEEN = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])
REJECTED = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("reason", T.StringType())])


def listing(spark: SparkSession, paths: str, glob: str) -> DataFrame:
    """(path, length) of every file there is; contents are not read.

    Files of zero bytes count as not there until they hold something.
    """
    files = list_files(spark, paths, glob)
    return spark.createDataFrame([], SEEN) if files is None else files


def seen_files(spark: SparkSession, path: str, upto: int) -> DataFrame:
    """(path, length) of the files of the batches up to a number."""
    return Ledger(spark, path, SEEN).read(upto)


def rejected_files(spark: SparkSession, landed_path: str, rejected_path: str) -> DataFrame:
    """(file_path, reason) of everything that kept a file, or one of its columns, from being landed."""
    return Ledger(spark, rejected_path, REJECTED).read(LandedTable(spark, landed_path).manifest.last())


def land_new_files(
    spark: SparkSession, root: str, instrument: str, stations: DataFrame, landed_path: str, seen_path: str, rejected_path: str
) -> int:
    """Land the files under ``root`` that no earlier call landed; returns their number.

    New is a path, or a length of it, that is not in the record at ``seen_path``.  However many there are, they are one pass: dealt
    out in groups, each read by one task.
    """
    glob, fields = INSTRUMENTS[instrument]
    table = LandedTable(spark, landed_path)
    batch = table.next_batch()
    seen, rejected = Ledger(spark, seen_path, SEEN), Ledger(spark, rejected_path, REJECTED)
    there = listing(spark, f"{root}/*/*/buoy/{instrument}", glob)
    new = materialize(there.join(seen.read(batch - 1), ["path", "length"], "left_anti"), "new-files")
    n = new.count()
    if n:
        whole, dealt = read_whole(new)
        files = materialize(parse_files(whole, fields), "files")
        rows = deduplicate(samples(files, fields, stations)).select(*KEYS, "time", *ORIGIN, *fields[1:])
        landing = materialize(rows.withColumn("date", F.to_date("time")), "landing")
        table.write(unseen(table, landing), batch)
        rejected.write(rejects(files, fields, stations).repartition(1), batch)
        seen.write(new.coalesce(1), batch)
        table.commit(batch)
        for ledger in (seen, rejected):
            if ledger.snapshot_due():
                ledger.snapshot(ledger.read())
        for used in (dealt, files, landing):
            discard(used)
    discard(new)
    return n
