"""Numbered versions of a small table: deltas, and now and then a snapshot of all that counts.

A version is a folder that Spark writes; its ``_SUCCESS`` file, written last, makes it count.  A version that broke off
is not seen, and written again under the same number.  Readers take the last snapshot and the deltas after it, so the files they
read do not grow with the number of versions.  One writer at a time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewright.session import hadoop_path

#: Deltas after which a snapshot is due.
DELTAS = 64


@dataclass(frozen=True)
class Version:
    number: int
    snapshot: bool
    name: str


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    path: str
    schema: T.StructType

    def versions(self) -> list[Version]:
        """All versions that count, in order."""
        fs, at = hadoop_path(self.spark, self.path)
        if not fs.exists(at):
            return []
        found = []
        for status in fs.listStatus(at):
            name = status.getPath().getName()
            said = re.fullmatch(r"(\d{12})-(delta|snapshot)", name)
            if said and fs.exists(hadoop_path(self.spark, f"{self.path}/{name}/_SUCCESS")[1]):
                found.append(Version(int(said[1]), said[2] == "snapshot", name))
        return sorted(found, key=lambda v: (v.number, v.snapshot))

    def last(self) -> int:
        """Number of the last version; 0 before the first."""
        return max((v.number for v in self.versions()), default=0)

    def parts(self, upto: int | None = None) -> list[Version]:
        """The versions that a reader needs: the last snapshot and what came after it."""
        known = [v for v in self.versions() if upto is None or v.number <= upto]
        base = max((v.number for v in known if v.snapshot), default=0)
        return [v for v in known if v.number > base or v.number == base and v.snapshot]

    def read(self, upto: int | None = None) -> DataFrame:
        """Rows of the snapshot and of later deltas; a file that cannot be read is an error that names it."""
        parts = self.parts(upto)
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{v.name}" for v in parts])

    def write(self, rows: DataFrame, number: int, snapshot: bool = False) -> None:
        """Write a version; one of the same number that broke off is replaced."""
        ordered = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in self.schema])
        name = f"{number:012d}-{'snapshot' if snapshot else 'delta'}"
        ordered.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", True).parquet(f"{self.path}/{name}")

    def snapshot_due(self) -> bool:
        return len(self.parts()) > DELTAS

    def snapshot(self, rows: DataFrame) -> None:
        """All that counts, ``rows``, as of the last version.

        Versions before the last snapshot but one go; those between stay for readers that have begun.
        """
        number = self.last()
        earlier = [v.number for v in self.versions() if v.snapshot]
        self.write(rows, number, snapshot=True)
        for v in self.versions():
            if earlier and (v.number < earlier[-1] or v.number == earlier[-1] and not v.snapshot):
                fs, at = hadoop_path(self.spark, f"{self.path}/{v.name}")
                fs.delete(at, True)
