"""Sink that writes one text file per row, on the executors.

Each row names a file relative to the target folder.  On file systems a file is written under a
temporary name and moved into place, so a retried or doubled task leaves the same file; the
temporary folder of the job goes at its end, also when it fails (a task that still runs then may leave its last file there).  On object stores a file appears only when
it is complete, so it is written in place.  Any file system known to Arrow can be the target.

A task lists what it wrote in a file of its own and tells the driver only where that is.  When the job commits, the lists of the
attempts that count become its manifest, ``_manifests/<name>``; ``_SUCCESS``, written last, makes it one that readers trust.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from tidewright.session import hadoop_path

FORMAT = "text_files"
#: File systems, by Arrow's names, that show a file only when it is complete.
OBJECT_STORES = ("s3", "gcs", "abfs")


def check_path(path: str) -> None:
    """Raise ``ValueError`` where Arrow knows no file system for ``path``, before anything is computed for it."""
    from pyarrow import fs

    try:
        fs.FileSystem.from_uri(path)
    except Exception as e:
        raise ValueError(f"{path} is not a path that Arrow can write to (s3://, gs://, abfs://, hdfs://, file:// or absolute): {e}") from e


MANIFESTS = "_manifests"


@dataclass
class Written(WriterCommitMessage):
    files: int
    listed: str | None


class TextFileSource(DataSource):
    """``df(file, content)`` to files; options ``path``, ``encoding``, ``allow_empty``, ``manifest``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file string, content string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return TextFileWriter(self.options)


class TextFileWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"].rstrip("/")
        self.encoding = options.get("encoding", "utf-8")
        self.allow_empty = options.get("allow_empty", "false").lower() == "true"
        self.parts = f".parts-{uuid.uuid4().hex}"
        self.manifest = options["manifest"]

    def write(self, rows: Iterator[Row]) -> Written:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.path)
        in_place = store.type_name in OBJECT_STORES
        made: set[str] = set()
        lines = []
        for row in rows:
            target = f"{base}/{row['file']}"
            folder = target.rsplit("/", 1)[0]
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            part = target if in_place else f"{base}/{self.parts}/{uuid.uuid4().hex}"
            if not in_place and self.parts not in made:
                store.create_dir(f"{base}/{self.parts}", recursive=True)
                made.add(self.parts)
            data = row["content"].encode(self.encoding)
            with store.open_output_stream(part) as out:
                out.write(data)
            if not in_place:
                store.move(part, target)
            lines.append(json.dumps({"file": row["file"], "bytes": len(data)}))
        if not lines:
            return Written(0, None)
        store.create_dir(f"{base}/{self.parts}", recursive=True)
        listed = f"{base}/{self.parts}/list-{uuid.uuid4().hex}.json"
        with store.open_output_stream(listed) as out:
            out.write("\n".join(lines).encode())
        return Written(len(lines), listed)

    def abort(self, messages: list[Written | None]) -> None:
        self.clean()

    def clean(self) -> None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.path)
        store.delete_dir_contents(f"{base}/{self.parts}", missing_dir_ok=True)
        if store.get_file_info(f"{base}/{self.parts}").type != fs.FileType.NotFound:
            store.delete_dir(f"{base}/{self.parts}")

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        written = [m for m in messages if m is not None and m.files]
        if not self.allow_empty and not written:
            self.clean()
            raise ValueError("no rows to write")
        store, base = fs.FileSystem.from_uri(self.path)
        folder = f"{base}/{MANIFESTS}/{self.manifest}"
        store.create_dir(folder, recursive=True)
        for m in written:
            store.move(m.listed, f"{folder}/{m.listed.rsplit('/', 1)[1]}")
        with store.open_output_stream(f"{folder}/_SUCCESS"):
            pass
        self.clean()


def write_text_files(
    df: DataFrame, path: str, encoding: str = "utf-8", allow_empty: bool = False, manifest: str | None = None
) -> str:
    """Write ``df(file, content)`` under ``path``; existing files are replaced.  Returns the name of the manifest.

    No rows at all is an error unless ``allow_empty``.
    """
    register(df.sparkSession)
    manifest = manifest or uuid.uuid4().hex
    (
        df.select("file", "content")
        .write.format(FORMAT)
        .mode("append")
        .option("encoding", encoding)
        .option("allow_empty", str(allow_empty))
        .option("manifest", manifest)
        .save(path)
    )
    return manifest


def written_files(spark: SparkSession, path: str, manifest: str) -> DataFrame:
    """(file, bytes) of a job that was committed; ``FileNotFoundError`` for any other."""
    folder = f"{path.rstrip('/')}/{MANIFESTS}/{manifest}"
    fs, done = hadoop_path(spark, f"{folder}/_SUCCESS")
    if not fs.exists(done):
        raise FileNotFoundError(f"no job {manifest} was committed under {path}")
    # a name without a leading underscore, so that Spark sees the folder's files
    return spark.read.schema("file string, bytes long").option("pathGlobFilter", "list-*.json").json(folder)


def register(spark: SparkSession) -> None:
    """Make the sink known to the session; its code travels with the job."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TextFileSource)
