"""The document registry: append-only versions of agent and skill definitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import blank_to_null
from tideline.operators.versions import DIGEST, version_steps, with_versions, written_loads
from tideline.session import discard, materialise
from tideline.sources.definitions import parse_definitions, read_definitions
from tideline.sources.tables import append_rows, ensure_table

DATABASE = "document_registry"

_SECTIONS = T.ArrayType(
    T.StructType([T.StructField("heading", T.StringType()), T.StructField("body", T.StringType())])
)
_LIST = T.ArrayType(T.StringType())

AGENT_SNAPSHOTS = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("tools", _LIST),
        T.StructField("skills", _LIST),
        T.StructField("sections", _SECTIONS),
        T.StructField("content", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
        T.StructField("snapshotted_at", T.TimestampType(), False),
        T.StructField("notes", T.StringType()),
        T.StructField("performance_tag", T.StringType()),
        T.StructField(DIGEST, T.StringType(), False),
    ]
)
SKILL_SNAPSHOTS = T.StructType([f for f in AGENT_SNAPSHOTS.fields if f.name not in ("tools", "skills")])

KINDS = {"agent": AGENT_SNAPSHOTS, "skill": SKILL_SNAPSHOTS}


def registry_table(kind: str, prefix: str = "") -> str:
    return f"{prefix}{DATABASE}.{kind}_snapshots"


def ensure_registry(spark: SparkSession, prefix: str = "", root: str | None = None) -> None:
    for kind, schema in KINDS.items():
        ensure_table(spark, registry_table(kind, prefix), schema, root=root)


def append_versions(df: DataFrame, kind: str, prefix: str = "") -> None:
    """Append version rows; blank texts become NULL, missing sections an empty list."""

    def text(name: str) -> Column:
        return blank_to_null(name) if name in df.columns else F.lit(None).cast("string")

    rows = df.withColumns(
        {
            "description": text("description"),
            "notes": text("notes"),
            "performance_tag": text("performance_tag"),
            "sections": F.coalesce("sections", F.array().cast(_SECTIONS)),
            # Written with the text that it is of, so the two never part.
            DIGEST: F.sha2(F.col("content").cast("string"), 256),
        }
    )
    append_rows(rows, registry_table(kind, prefix), KINDS[kind])


def sync_registry(
    spark: SparkSession,
    project: str,
    prefix: str = "",
    now: dt.datetime | None = None,
    root: str | None = None,
    notes: str | None = None,
    names: list[str] | None = None,
) -> DataFrame:
    """``sync_definitions`` of the definition files below ``project``; ``names`` restricts it to some."""
    files = read_definitions(spark, project)
    if names is not None:
        files = files.where(F.col("name").isin(names))
    return sync_definitions(spark, files, prefix, now, root, notes)


def sync_definitions(
    spark: SparkSession,
    files: DataFrame,
    prefix: str = "",
    now: dt.datetime | None = None,
    root: str | None = None,
    notes: str | None = None,
) -> DataFrame:
    """Append a version for every definition of ``files (kind, name, content, error)`` that changed.

    Files that cannot be read are counted and left out; the others go on.  The
    report has one row per kind: files checked, versions appended, files with
    errors.  Files are read once and written once; digests alone tell which of them are new versions.
    """
    ensure_registry(spark, prefix, root)
    files = written_loads(files.select("kind", "name", "content", "error"))
    reports = []
    try:
        for kind in KINDS:
            of_kind = files.where(F.col("kind") == kind)
            history = spark.table(registry_table(kind, prefix))
            readable = of_kind.where(F.col("error").isNull()).drop("kind", "error")
            # Written, as the history that they are found from grows by them.
            steps = materialise(version_steps(readable, history), "changed")
            # Parsed after the comparison, so unchanged documents are not taken apart.
            changed = parse_definitions(with_versions(readable, steps, now))
            append_versions(changed.withColumn("notes", F.lit(notes).cast("string")), kind, prefix)
            checked, errors = of_kind.agg(F.count(F.lit(1)), F.count("error")).first()
            reports.append((kind, checked, steps.count(), errors))
            discard(steps)
    finally:
        discard(files)
    return spark.createDataFrame(reports, "kind string, checked long, appended long, errors long")
