"""Landed samples: unique per time stamp, Parquet by batch, site, deployment and date, with a manifest.

Parsing and de-duplication happen once, when a file arrives.  Each landing or compaction writes a batch of its own and then one version of
the manifest: the partitions that count from now on and those that no longer do, with the first and last time and the rows of
each.  That version makes the batch count: one that broke off is not seen, and replaced by the next.  Time
bounds and days come from the manifest alone, without a look at the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.model import KEYS
from tidewright.session import discard, hadoop_path, materialize, read_folders
from tidewright.sources.ledger import Ledger

PARTITIONS = [*KEYS, "date"]

ZONE_SCHEMA = T.StructType([
    T.StructField("batch", T.IntegerType()), T.StructField("site", T.StringType()), T.StructField("deployment", T.StringType()),
    T.StructField("date", T.DateType()), T.StructField("min_time", T.TimestampNTZType()), T.StructField("max_time", T.TimestampNTZType()),
    T.StructField("rows", T.LongType()), T.StructField("live", T.BooleanType()),
])
ZONE = ["batch", *PARTITIONS]

#: Partitions up to which a read names their folders; beyond, it lists the table and joins the manifest.
MOST_FOLDERS = 10_000
#: Live batches of a partition from which it is compacted.
COMPACTED_FROM = 2


@dataclass(frozen=True)
class LandedTable:
    """One instrument's samples under ``path``."""

    spark: SparkSession
    path: str

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    @property
    def manifest(self) -> Ledger:
        return Ledger(self.spark, f"{self.path}/manifest", ZONE_SCHEMA)

    def zones(self) -> DataFrame:
        """(batch, site, deployment, date, min_time, max_time, rows) of every partition that counts."""
        # a partition is written once and dropped at most once
        said = self.manifest.read().groupBy(*ZONE).agg(
            F.bool_and("live").alias("live"), *[F.max(c).alias(c) for c in ("min_time", "max_time", "rows")])
        return said.where("live").drop("live")

    def next_batch(self) -> int:
        return self.manifest.last() + 1

    def read(self, zones: DataFrame | None = None) -> DataFrame | None:
        """Samples of some or all partitions; None if there are none."""
        wanted = materialize((self.zones() if zones is None else zones).select(*ZONE), "zones")
        folders = [
            f"{self.data}/batch={r.batch}/site={r.site}/deployment={r.deployment}/date={r.date}" for r in wanted.limit(MOST_FOLDERS + 1).collect()]
        if not folders:
            discard(wanted)
            return None
        if len(folders) <= MOST_FOLDERS:
            discard(wanted)
            return self.typed(read_folders(self.spark, folders, self.data)).drop("batch")
        # a comparison of the stored side is what Spark asks for before it prunes partitions at run time
        live = wanted.where("date >= DATE'0001-01-01'")
        return self.typed(read_folders(self.spark, [self.data])).join(live, ZONE, "left_semi").drop("batch")

    def typed(self, df: DataFrame) -> DataFrame:
        """Partition values with the types of the manifest, whatever they look like."""
        return df.withColumns({c: F.col(c).cast(ZONE_SCHEMA[c].dataType) for c in ZONE})

    def write(self, samples: DataFrame, batch: int) -> None:
        """Write a batch, in place of one of the same number that broke off.  It does not count before ``commit``."""
        (
            samples.hint("rebalance", *PARTITIONS)
            .sortWithinPartitions(*PARTITIONS, "time")
            .write.mode("overwrite").partitionBy(*PARTITIONS).parquet(f"{self.data}/batch={batch}")
        )

    def commit(self, batch: int, dropped: DataFrame | None = None) -> None:
        """Make a written batch count, and ``dropped`` (zones) no longer."""
        fs, at = hadoop_path(self.spark, f"{self.data}/batch={batch}")
        folders = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        entries = self.spark.createDataFrame([], ZONE_SCHEMA)
        if any(f.startswith("site=") for f in folders):
            written = self.typed(read_folders(self.spark, [f"{self.data}/batch={batch}"]).withColumn("batch", F.lit(batch)))
            entries = written.groupBy(*ZONE).agg(
                F.min("time").alias("min_time"), F.max("time").alias("max_time"), F.count("*").alias("rows"), F.lit(True).alias("live"))
        if dropped is not None:
            entries = entries.unionByName(dropped.withColumn("live", F.lit(False)))
        self.manifest.write(entries.coalesce(1), batch)
        if self.manifest.snapshot_due():
            self.manifest.snapshot(self.zones().withColumn("live", F.lit(True)).coalesce(1))

    def compact(self, least: int = COMPACTED_FROM) -> int:
        """Bring the batches of each partition that has ``least`` or more into one; returns the partitions concerned.

        The change shows at once, as one version.  Files that no longer count stay until ``vacuum``, so readers that have begun go on.
        """
        zones = self.zones()
        many = zones.groupBy(*PARTITIONS).agg(F.count("*").alias("n")).where(F.col("n") >= least)
        old = materialize(zones.join(many, PARTITIONS, "left_semi"), "compacted")
        samples = self.read(old)
        concerned = old.select(*PARTITIONS).distinct().count()
        if samples is not None:
            batch = self.next_batch()
            self.write(samples, batch)
            self.commit(batch, old)
        discard(old)
        return concerned

    def vacuum(self) -> int:
        """Delete the folders of batches of which nothing counts; returns their number.  No reader may be under way."""
        live = {r.batch for r in self.zones().select("batch").distinct().collect()}
        last, gone = self.manifest.last(), 0
        fs, at = hadoop_path(self.spark, self.data)
        for status in fs.listStatus(at) if fs.exists(at) else []:
            batch = int(status.getPath().getName().split("=")[1])
            if batch <= last and batch not in live:
                gone += bool(fs.delete(status.getPath(), True))
        return gone


def unseen(table: LandedTable, new: DataFrame) -> DataFrame:
    """Rows of the stored table ``new`` whose time stamp is not landed yet; only days that it touches are read."""
    days = new.select(*PARTITIONS).distinct()
    landed = table.read(table.zones().join(days, PARTITIONS, "left_semi"))
    if landed is None:
        return new
    return new.join(landed.select(*PARTITIONS, "time"), [*PARTITIONS, "time"], "left_anti")


def land(samples: DataFrame, path: str, batch: int | None = None) -> int:
    """Append the samples whose time stamp is not landed yet, as one batch; returns the samples seen.

    ``samples`` must be unique per time stamp.  A row landed earlier wins over a later copy.  Repeating a call,
    also one that broke off, adds nothing twice.
    """
    table = LandedTable(samples.sparkSession, path)
    new = materialize(samples.withColumn("date", F.to_date("time")), "landing")
    n = new.count()
    if n:
        batch = table.next_batch() if batch is None else batch
        table.write(unseen(table, new), batch)
        table.commit(batch)
    discard(new)
    return n


def read_landed(spark: SparkSession, path: str) -> DataFrame | None:
    """All landed samples, or None where nothing was landed yet."""
    return LandedTable(spark, path).read()


def zone_times(table: LandedTable) -> DataFrame:
    """(site, deployment, time): first and last time of every landed partition, all that time bounds need."""
    return table.zones().select(*KEYS, F.explode(F.array("min_time", "max_time")).alias("time"))


def window_zones(table: LandedTable, runs: DataFrame) -> DataFrame:
    """Partitions that a set of runs needs: their windows, and one sample before each.

    The sample before a window feeds its first rain difference; it lies on the
    last landed date before the window's first one.
    """
    first = runs.select(*KEYS, F.to_date(F.expr("bin_start - INTERVAL 5 MINUTES")).alias("first_date"))
    days = table.zones().join(first, KEYS)
    before = days.groupBy(*KEYS).agg(
        F.max(F.when(F.col("date") < F.col("first_date"), F.col("date"))).alias("before")
    )
    return days.join(before, KEYS).filter("date >= coalesce(before, first_date)")
