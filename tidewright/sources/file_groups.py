"""Files of folders, and whole files as rows: readers with one partition for each folder, or group of files of a stored list.

The list is a table of paths, dealt out by size into its part files; a task reads one of these and then the files it names.
No path but those of the parts passes through the driver.  Any file system known to Arrow can be read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from fnmatch import fnmatchcase
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tidewright.session import discard, hadoop_path, materialize

FORMAT = "file_groups"
SCHEMA = "path string, content binary, fault string"
FOLDERS = "folder_files"
FILE_SCHEMA = "path string, length long"

#: Bytes and files that a task reads at most, but for single larger files.
GROUP_BYTES = 64 << 20
GROUP_FILES = 5_000
#: Bytes of a batch on its way to Spark, and files of a listed one.
BATCH_BYTES = 8 << 20
LISTED_TOGETHER = 10_000


@dataclass
class Group(InputPartition):
    part: str


class FileGroupSource(DataSource):
    """Files named in the Parquet files of the option ``parts``, one path a line."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return FileGroupReader(self.options)


class FileGroupReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.parts = [p for p in options["parts"].split("\n") if p]

    def partitions(self) -> list[InputPartition]:
        return [Group(p) for p in self.parts]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(partition.part)
        names = ["path", "content", "fault"]
        kinds = [pa.string(), pa.binary(), pa.string()]
        rows, held = [], 0
        for path in pq.read_table(at, filesystem=store, columns=["path"]).column("path").to_pylist():
            try:
                file_store, file = fs.FileSystem.from_uri(location(path))
                with file_store.open_input_stream(file, compression=None) as data:
                    rows.append((path, data.read(), None))
            except OSError as e:  # a file that is gone, or may not be read, is told and does not end the job
                rows.append((path, None, type(e).__name__))
            held += len(rows[-1][1] or b"")
            if held > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class FolderSource(DataSource):
    """Files right in the folders of the option ``folders``, one a line, whose names match the option ``glob``."""

    @classmethod
    def name(cls) -> str:
        return FOLDERS

    def schema(self) -> str:
        return FILE_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return FolderReader(self.options)


class FolderReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folders = options["folders"].split("\n")
        self.glob = options["glob"]

    def partitions(self) -> list[InputPartition]:
        return [Group(f) for f in self.folders]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(location(partition.part))
        files = [
            (f"{partition.part}/{f.base_name}", f.size) for f in store.get_file_info(fs.FileSelector(at, allow_not_found=True))
            if f.is_file and f.size and f.base_name[0] not in "._" and fnmatchcase(f.base_name, self.glob)]
        for i in range(0, len(files), LISTED_TOGETHER):
            paths, lengths = zip(*files[i : i + LISTED_TOGETHER])
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], ["path", "length"])


def list_files(spark: SparkSession, paths: str, glob: str) -> DataFrame | None:
    """(path, length) of the files of all folders that the pattern ``paths`` stands for; None if there is no such folder.

    Each folder is listed by one task, without a look at single files; only the names of folders pass through the driver.  Files of
    zero bytes and hidden ones are passed over, as by Spark's scans.
    """
    fs, at = hadoop_path(spark, paths)
    folders = [s.getPath().toString() for s in fs.globStatus(at) or [] if s.isDirectory()]
    if not folders:
        return None
    register(spark)
    return spark.read.format(FOLDERS).option("folders", "\n".join(folders)).option("glob", glob).load()


def location(path: str) -> str:
    """A path as Spark lists it, for Arrow: local ones without scheme, since their names are not encoded."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return path.replace("s3a://", "s3://", 1)


def register(spark: SparkSession) -> None:
    """Make the readers known to the session; their code travels with the job."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FileGroupSource)
    spark.dataSource.register(FolderSource)


def read_whole(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, content, fault) of the files of a stored table (path, length); also the dealt list, for ``discard`` afterwards."""
    spark = files.sparkSession
    size = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    groups = max(1, -(-size["n"] // GROUP_FILES), -(-size["bytes"] // GROUP_BYTES), min(size["n"], spark.sparkContext.defaultParallelism))
    dealt = materialize(files.select("path").repartition(groups, "path"), "groups")
    folder = {f.rsplit("/", 1)[0] for f in dealt.inputFiles()}
    parts = []
    for name in folder:
        fs, at = hadoop_path(spark, name)
        parts += [s.getPath().toString() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")]
    register(spark)
    return spark.read.format(FORMAT).option("parts", "\n".join(sorted(map(location, parts)))).load(), dealt
