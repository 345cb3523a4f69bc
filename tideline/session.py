"""Session settings and the shared folder that written intermediates live in."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Dates and instants are UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts raise instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesced shuffles, skewed joins and rebalanced writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # One set of tasks may read a hot partition even where that costs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

def build_session(app: str = "tideline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are written for.

    ``conf`` takes further settings with ``__`` in place of dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it then has one beside its tables.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{table_root(spark)}/_shared"


def table_root(spark: SparkSession) -> str:
    """The warehouse, where tables live that are given no other place."""
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/tideline/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage, survives lost executors, and lets several later
    steps read the same rows with only the columns they need.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    # Nothing reads the shuffles of a finished write again, so their files can go at once.
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a frame that ``materialise`` gave, once nothing reads it any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return
    folder = files[0].rsplit("/", 1)[0]
    # Without the scheme, which may be written in several ways.
    ours, here = (_folder(spark, p)[0].toUri().getPath() for p in (f"{shared_folder(spark)}/tideline", folder))
    if not here.startswith(f"{ours}/"):
        raise ValueError(f"{folder} is not a folder of this library")
    remove_folder(spark, folder)


def _folder(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    found, system = _folder(spark, path)
    system.delete(found, True)


def make_folder(spark: SparkSession, path: str) -> None:
    found, system = _folder(spark, path)
    system.mkdirs(found)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file that says something by its name."""
    found, system = _folder(spark, path)
    system.create(found, True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below ``path``; none if it is not there."""
    found, system = _folder(spark, path)
    if not system.exists(found):
        return []
    return [f.getPath().getName() for f in system.listStatus(found)]


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if it is not there."""
    found, system = _folder(spark, path)
    if not system.exists(found):
        return []
    return [f.getPath().getName() for f in system.listStatus(found) if f.isDirectory()]


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session for as long as the block runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
