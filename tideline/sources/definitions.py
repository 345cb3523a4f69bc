"""Definition files read as documents, one whole file per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.documents import (
    AGENT_FOLDER,
    AGENT_SUFFIX,
    DEFINITION_ROOT,
    SKILL_FILE,
    SKILL_FOLDER,
    classify_path,
    document_sections,
    front_matter_fields,
    front_matter_parts,
)
from tideline.sources.files import read_files, remove_files, write_files


def read_definitions(spark: SparkSession, project: str, root: str = DEFINITION_ROOT) -> DataFrame:
    """``kind, name, path, content, error`` of every agent and skill file below ``project/root``.

    Line ends are read as ``\\n``.  A file that is not valid UTF-8 keeps its row
    with an error and no content.  Names that begin with ``_`` or ``.`` and empty files are read too.
    """
    files = read_files(spark, f"{project.rstrip('/')}/{root}", ".md")
    text = F.col("content").cast("string")
    located = files.select(
        F.concat(F.lit(f"{root}/"), "path").alias("path"),
        F.when(F.is_valid_utf8(text), F.regexp_replace(text, "\r\n?", "\n")).alias("content"),
    )
    return (
        located.withColumn("_definition", classify_path("path", root))
        .where(F.col("_definition").isNotNull())
        .select(
            "_definition.kind",
            "_definition.name",
            "path",
            "content",
            F.when(F.col("content").isNull(), "not valid UTF-8").alias("error"),
        )
    )


def write_definitions(files: DataFrame, project: str, root: str = DEFINITION_ROOT) -> None:
    """Write ``files (kind, name, content)`` below ``project/root``, where ``read_definitions`` finds them.

    A registry's current versions become a tree of files again.  A name with a slash, a skill named ``.`` or ``..``,
    a NULL name, another kind, and two rows for one file are errors; a NULL content is an empty file.
    """
    path = F.when(F.col("kind") == "agent", F.concat(F.lit(f"{AGENT_FOLDER}/"), "name", F.lit(AGENT_SUFFIX))).when(
        F.col("kind") == "skill", F.concat(F.lit(f"{SKILL_FOLDER}/"), "name", F.lit(f"/{SKILL_FILE}"))
    )
    # A slash would make a deeper folder, which is no definition.
    plain = F.when(~F.contains("name", F.lit("/")), path)
    write_files(files.select(plain.alias("path"), "content"), f"{project.rstrip('/')}/{root}")


def remove_definitions(files: DataFrame, project: str) -> None:
    """Remove the definitions ``files (kind, path)`` that ``read_definitions`` found: an agent's file, a skill's whole folder."""
    entry = F.when(F.col("kind") == "skill", F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.col("path"))
    remove_files(files, project, entry)


def parse_definitions(files: DataFrame, content: str = "content") -> DataFrame:
    """Adds description, tools, skills and sections taken from each document."""
    parts = files.withColumn("_parts", front_matter_parts(content))
    fields = parts.withColumn("_fields", front_matter_fields("_parts.front_matter"))
    return (
        fields.withColumn("description", F.col("_fields.description"))
        .withColumn("tools", F.col("_fields.tools"))
        .withColumn("skills", F.col("_fields.skills"))
        .withColumn("sections", document_sections("_parts.body"))
        .drop("_parts", "_fields")
    )
