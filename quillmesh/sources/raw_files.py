"""Raw contents as files of their own, named by checksum: a data source to write them.

``rows.write.format("raw_files").mode("append").save(folder)`` writes rows (category, checksum, content)
as ``folder/<category>/<checksum>.raw``; ``spark.read.format("binaryFile")`` reads them.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from quillmesh.functions import urls

CATEGORY, CHECKSUM = re.compile(r"[a-z0-9_-]+"), re.compile(r"[0-9a-f]{64}")


def _open(folder: str):
    """A file system that executors reach, and the folder in it; paths without a scheme are shared local ones."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if re.match(r"[a-z][a-z0-9+.-]*:", folder):
        return FileSystem.from_uri(re.sub(r"^file:/*", "file:///", folder))
    return LocalFileSystem(), folder


@dataclass
class Written(WriterCommitMessage):
    #: staged file and final name below the folder
    files: list[tuple[str, str]]


class RawFileWriter(DataSourceWriter):
    """Tasks write to one hidden folder of the job; the driver's commit moves what succeeded tasks
    wrote to its place, unless it is already there, and the hidden folder goes in any case."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.staging = f".staging-{uuid.uuid4().hex}"
        # made here and not by tasks: a task that outlives an abort then has nowhere to write
        files, place = _open(self.folder)
        files.create_dir(f"{place}/{self.staging}", recursive=True)

    def write(self, rows: Iterator) -> Written:
        files, folder = _open(self.folder)
        out = []
        for row in rows:
            content = bytes(row["content"])
            # the names come from rows: nothing may lead out of the folder
            if not CATEGORY.fullmatch(row["category"] or "") or not CHECKSUM.fullmatch(row["checksum"] or ""):
                raise ValueError(f"not a category and checksum: {row['category']!r}, {row['checksum']!r}")
            if hashlib.sha256(content).hexdigest() != row["checksum"]:
                raise ValueError(f"content isn't what its checksum says: {row['checksum']}")
            staged = f"{self.staging}/{uuid.uuid4().hex}"
            with files.open_output_stream(f"{folder}/{staged}") as f:
                f.write(content)
            out.append((staged, f"{row['category']}/{row['checksum']}.raw"))
        return Written(out)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow.fs import FileType

        files, folder = _open(self.folder)
        for category in {name.split("/")[0] for m in messages if m for _, name in m.files}:
            files.create_dir(f"{folder}/{category}", recursive=True)
        for staged, name in (x for m in messages if m for x in m.files):
            if files.get_file_info(f"{folder}/{name}").type == FileType.NotFound:
                files.move(f"{folder}/{staged}", f"{folder}/{name}")
        self._clear(files, folder)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_open(self.folder))

    def _clear(self, files, folder: str) -> None:
        from pyarrow.fs import FileType

        if files.get_file_info(f"{folder}/{self.staging}").type == FileType.Directory:
            files.delete_dir(f"{folder}/{self.staging}")


class RawFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raw_files"

    def schema(self) -> str:
        return "category string, checksum string, content binary"

    def writer(self, schema, overwrite: bool) -> RawFileWriter:
        if overwrite:
            raise ValueError("raw files are never overwritten: use the mode append")
        return RawFileWriter(self.options["path"])


def write_files(captured: DataFrame, folder: str) -> None:
    """Contents (source_url, content_type, content) as files, each once, in folders by category.
    Those that are already there stay untouched; null contents have no file."""
    captured.sparkSession.dataSource.register(RawFiles)
    rows = captured.where("content IS NOT NULL").select(
        urls.stored_category(F.col("content_type"), F.col("source_url")).alias("category"), F.sha2("content", 256).alias("checksum"), "content"
    )
    rows.dropDuplicates(["category", "checksum"]).write.format("raw_files").mode("append").save(folder)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """``category, checksum, size, content`` of the files of a folder, failing on a content that isn't what
    its name says. Spark's file sources skip empty files, so the empty content isn't among them."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.raw").option("recursiveFileLookup", "true").load(folder)
    named = rows.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("category"), F.regexp_extract("path", r"([0-9a-f]{64})\.raw$", 1).alias("checksum"), F.col("length").alias("size"), "content")
    same = F.sha2("content", 256) == F.col("checksum")
    return named.withColumn("content", F.when(same, F.col("content")).otherwise(F.raise_error(F.concat(F.lit("damaged content "), F.col("checksum")))))
