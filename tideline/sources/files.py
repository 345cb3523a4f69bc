"""Whole files as rows, read and written in tasks, whatever their names are."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: What one task reads, at most: bytes (or one file that has more), and files.
TASK_BYTES, TASK_FILES = 64 << 20, 4_096
#: Bytes that a task holds before it hands rows on (or one file that has more).
BATCH_BYTES = 16 << 20

# Schemes of Hadoop's clients beside the name that Arrow has for the same store.
STORES = {"s3a": "s3", "s3n": "s3"}

_SCHEMA = pa.schema([("path", pa.string()), ("content", pa.binary())])


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """The store that holds ``folder``, a qualified address whose path is not percent-encoded, and the path in it."""
    head, _, rest = folder.partition(":") if urlsplit(folder).scheme else ("file", "", folder)
    if rest.startswith("//"):
        authority, slash, path = rest[2:].partition("/")
        path = slash + path
    else:
        authority, path = "", rest
    store, base = fs.FileSystem.from_uri(f"{STORES.get(head, head)}://{authority}/")
    return store, base.rstrip("/") + path.rstrip("/")


@dataclass
class Bundle(InputPartition):
    """Paths that one task reads."""

    paths: Sequence[str]


class WholeFiles(DataSource):
    """``path, content`` of the files below ``path`` that end in ``suffix``: hidden and empty ones too.

    Spark's own readers pass over both.  Paths are relative to the folder, contents are bytes.
    Only names and sizes are listed on the driver; a folder that is not there has no files.
    """

    @classmethod
    def name(cls) -> str:
        return "whole_files"

    def schema(self) -> str:
        return "path string, content binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("suffix", ""))


class _Reader(DataSourceReader):
    def __init__(self, folder: str, suffix: str):
        self.folder, self.suffix = folder, suffix

    def partitions(self) -> Sequence[InputPartition]:
        store, base = open_store(self.folder)
        listed = store.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=True))
        files = sorted((f.path[len(base) + 1 :], f.size) for f in listed if f.is_file and f.path.endswith(self.suffix))
        bundles, held = [Bundle([])], 0
        for path, size in files:
            paths = bundles[-1].paths
            if paths and (held + size > TASK_BYTES or len(paths) == TASK_FILES):
                bundles.append(Bundle([]))
                held = 0
            bundles[-1].paths.append(path)
            held += size
        return bundles

    def read(self, partition: Bundle) -> Iterator[pa.RecordBatch]:
        store, base = open_store(self.folder)
        paths, contents, held = [], [], 0
        for path in partition.paths:
            with store.open_input_stream(f"{base}/{path}") as stream:
                contents.append(stream.read())
            paths.append(path)
            held += len(contents[-1])
            if held >= BATCH_BYTES:
                yield pa.record_batch([paths, contents], schema=_SCHEMA)
                paths, contents, held = [], [], 0
        if paths:
            yield pa.record_batch([paths, contents], schema=_SCHEMA)


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme and authority of its store, nothing in it encoded."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def read_files(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """``path, content`` of every file below ``folder`` that ends in ``suffix``, see ``WholeFiles``."""
    spark.dataSource.register(WholeFiles)
    return spark.read.format("whole_files").options(path=qualified(spark, folder), suffix=suffix).load()


def _astray(path: str) -> Column:
    """Whether a path is NULL, names no file or leads out of its folder."""
    return F.col(path).isNull() | F.exists(F.split(path, "/"), lambda part: part.isin("", ".", ".."))


def write_files(files: DataFrame, folder: str, path: Column | str = "path", content: Column | str = "content") -> None:
    """One file below ``folder`` for each row; a task that is run again writes the same files again.

    A NULL content is an empty file.  A path that is NULL, names no file or leads out of the folder is an
    error, and so are two rows of one path; both are found before anything is written.
    """
    spark = files.sparkSession
    rows = files.select(F.col(path).alias("path") if isinstance(path, str) else path.alias("path"),
                        (F.col(content) if isinstance(content, str) else content).cast("binary").alias("content"))
    wrong = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | _astray("path")).limit(10)
    found = [r["path"] for r in wrong.collect()]
    if found:
        raise ValueError(f"paths that cannot be written, or that several rows have: {found}")
    target = qualified(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(target)
        made = set()
        for batch in batches:
            for name, body in zip(batch.column("path"), batch.column("content"), strict=True):
                file = f"{base}/{name.as_py()}"
                parent = file.rpartition("/")[0]
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                with store.open_output_stream(file) as stream:
                    stream.write(body.as_buffer() if body.is_valid else b"")
            yield batch.select(["path"]).slice(0, 0)

    rows.mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()


def remove_files(files: DataFrame, folder: str, path: Column | str = "path") -> None:
    """Remove the file below ``folder`` that each row names, or the folder with all that is in it, in tasks.

    What is gone already is passed over, as a task may be run again. A path that is NULL, names no file or
    leads out of the folder is an error, found before anything is removed.
    """
    rows = files.select((F.col(path) if isinstance(path, str) else path).alias("path"))
    found = [r["path"] for r in rows.where(_astray("path")).limit(10).collect()]
    if found:
        raise ValueError(f"paths that cannot be removed: {found}")
    target = qualified(files.sparkSession, folder)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(target)
        for batch in batches:
            for name in batch.column("path").to_pylist():
                kind = store.get_file_info(f"{base}/{name}").type
                if kind == fs.FileType.Directory:
                    store.delete_dir(f"{base}/{name}")
                elif kind == fs.FileType.File:
                    store.delete_file(f"{base}/{name}")
            yield batch.slice(0, 0)

    rows.mapInArrow(remove, "path string").write.format("noop").mode("overwrite").save()
