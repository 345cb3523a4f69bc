"""Versioned documents: history, change detection, differences and parsing."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.documents import (
    classify_path,
    document_sections,
    front_matter_fields,
    front_matter_parts,
)
from tideline.functions.patterns import BREAKS, INLINE, LINE, ONE_BREAK, SPACE
from tideline.functions.scalars import blank_to_null, normalise_text, short_message
from tideline.operators.latest import latest_per_key, top_n_per_key
from tideline.operators.versions import (
    history_of,
    line_changes,
    next_versions,
    version_history,
    version_pairs,
)
from tideline.operators.ordering import number_rows, split_groups
from tideline.plans.registry import KINDS, registry_table, sync_definitions
from tideline.session import discard, materialise, new_folder, remove_folder
from tideline.sources.definitions import read_definitions, remove_definitions, write_definitions
from tideline.workload import inputs
from tideline.workload.catalogue import query, read


_VERSIONS = (
    f"WITH {inputs.LOADS}, marked AS (SELECT *, lag(parity) OVER w AS before, row_number() OVER w AS rn "
    "FROM loads WINDOW w AS (PARTITION BY name ORDER BY turn)) "
    "SELECT name, turn, parity, row_number() OVER (PARTITION BY name ORDER BY turn) AS version "
    "FROM marked WHERE rn = 1 OR parity IS DISTINCT FROM before"
)


@query("version_history", _VERSIONS)
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads whose content is a parity, so about half of them change nothing."""
    loads = inputs.loads(spark, sf_dir).select("name", "turn", "parity")
    return version_history(loads, ["name"], ["turn"], "parity")


_PAIRS = (
    f"{inputs.LOADS}, pairs AS (SELECT name, lag(turn) OVER w AS older_version, turn AS newer_version, "
    "lag(text) OVER w AS older, text AS newer, row_number() OVER w AS rn FROM loads "
    "WINDOW w AS (PARTITION BY name ORDER BY turn))"
)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = inputs.loads(spark, sf_dir).select("name", "turn", "text")
    return version_pairs(loads, ["name"], ["turn"], content="text", version="turn")


@query("version_pairs", f"WITH {_PAIRS} SELECT * EXCLUDE (rn) FROM pairs WHERE rn > 1")
def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@query(
    "line_changes",
    f"WITH {_PAIRS}, steps AS (SELECT name, newer_version, unnest(regexp_extract_all(newer, '{LINE}')) AS line, "
    "1 AS step FROM pairs WHERE rn > 1 UNION ALL SELECT name, newer_version, "
    f"unnest(regexp_extract_all(older, '{LINE}')), -1 FROM pairs WHERE rn > 1) "
    "SELECT name, newer_version, line, CAST(sum(step) AS BIGINT) AS net FROM steps GROUP BY 1, 2, 3 "
    "HAVING sum(step) <> 0",
)
def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_changes(_pairs(spark, sf_dir), ["name", "newer_version"])


@query(
    "changed_content",
    f"WITH {inputs.LOADS}, ends AS (SELECT name AS n, max(turn) AS last FROM loads GROUP BY 1), history AS "
    "(SELECT name, turn + 1 AS version, parity FROM loads JOIN ends ON name = n WHERE turn < last), "
    "last AS (" + inputs.ranked_first("history", "name", "version DESC") + "), "
    "current AS (" + inputs.ranked_first("loads", "name", "turn DESC") + ") "
    "SELECT current.name, current.parity AS content, coalesce(last.version, 0) + 1 AS version FROM current "
    "LEFT JOIN last ON current.name = last.name WHERE last.name IS NULL "
    "OR current.parity IS DISTINCT FROM last.parity",
)
def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last turn of each name is its current content, all turns before it are recorded versions."""
    loads = _parities(spark, sf_dir)
    current = latest_per_key(loads, ["name"], "turn")
    recorded = loads.join(current.select("name", "turn"), ["name", "turn"], "left_anti")
    return next_versions(current.select("name", "content"), recorded).select("name", "content", "version")


def _parities(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    return inputs.loads(spark, sf_dir).select(
        "name",
        "turn",
        F.col("parity").alias("content"),
        (F.col("turn") + 1).alias("version"),
        (start + F.make_dt_interval(days=F.col("turn").cast("int"))).alias("snapshotted_at"),
    )


@query("continued_versions", _VERSIONS)
def continued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three turns are recorded, the others come in at once and are numbered on from there."""
    loads = _parities(spark, sf_dir).drop("version")
    recorded = version_history(loads.where(F.col("turn") < 3), ["name"], ["turn"], "content")
    later = next_versions(loads.where(F.col("turn") >= 3).drop("snapshotted_at"), recorded, order_by=["turn"])
    both = recorded.drop("snapshotted_at").unionByName(later.drop("snapshotted_at"))
    return both.withColumnRenamed("content", "parity")


@query(
    "latest_snapshot",
    f"WITH {inputs.LOADS} " + inputs.ranked_first("(SELECT name, turn, text FROM loads)", "name", "turn DESC"),
)
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(inputs.loads(spark, sf_dir).select("name", "turn", "text"), ["name"], "turn")


@query(
    "last_two_versions",
    f"WITH {inputs.LOADS} SELECT name, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY name "
    "ORDER BY turn DESC) AS rn FROM loads) WHERE rn <= 2",
)
def last_two_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n_per_key(inputs.loads(spark, sf_dir).select("name", "turn", "text"), ["name"], "turn", 2)


@query(
    "history_top_n",
    "SELECT role, conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id DESC, "
    "turn DESC) AS rn FROM conversations) WHERE rn <= 20",
)
def history_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty rows of each role, where one role holds about half of the table."""
    rows = read(spark, sf_dir, "conversations").select("role", "conv_id", "turn")
    return top_n_per_key(rows, ["role"], "conv_id", 20, ["turn"])


@query(
    "history_list",
    "SELECT turn + 1 AS version, TIMESTAMP '2024-01-01' + to_days(CAST(conv_id AS INTEGER)) AS snapshotted_at, "
    "CAST(NULL AS VARCHAR) AS notes, role AS performance_tag FROM conversations WHERE role = 'assistant' "
    "ORDER BY snapshotted_at DESC, version DESC LIMIT 20",
)
def history_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of one name, bound as a parameter: the 20 latest versions."""
    start = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    read(spark, sf_dir, "conversations").select(
        F.col("role").alias("name"),
        (F.col("turn") + 1).alias("version"),
        (start + F.make_dt_interval(days=F.col("conv_id").cast("int"))).alias("snapshotted_at"),
        F.lit(None).cast("string").alias("notes"),
        F.col("role").alias("performance_tag"),
    ).createOrReplaceTempView("role_snapshots")
    return history_of(spark, "role_snapshots", "assistant")


_FRONT_MATTER = (
    rf"(?s)\A[{INLINE}]*---[{INLINE}]*{ONE_BREAK}((?:.*?{ONE_BREAK})??)[{INLINE}]*---[{INLINE}]*"
    rf"(?:{ONE_BREAK}|\z)(.*)\z"
)
_PARTS = (
    f"{inputs.DEFINITIONS}, parts AS (SELECT doc_id, "
    f"regexp_matches(content, '{_FRONT_MATTER}') AS closed, content, "
    f"regexp_extract(content, '{_FRONT_MATTER}', 1) AS header, "
    f"regexp_extract(content, '{_FRONT_MATTER}', 2) AS rest FROM definitions), "
    "bodies AS (SELECT doc_id, CASE WHEN closed THEN header ELSE '' END AS front_matter, "
    "CASE WHEN closed THEN rest ELSE content END AS body FROM parts)"
)


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.definitions(spark, sf_dir).select("doc_id", F.inline(F.array(front_matter_parts("content"))))


@query("split_front_matter", f"WITH {_PARTS} SELECT doc_id, front_matter, body FROM bodies")
def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir)


@query(
    "front_matter_fields",
    "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source END AS name, "
    "CASE WHEN doc_id % 3 = 0 THEN 'document ' || doc_id || ' in ' || lang END AS description, "
    "CASE WHEN doc_id % 3 = 0 THEN 'Read,' || lang ELSE '' END AS tools, "
    "CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END AS skills FROM documents",
)
def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parts(spark, sf_dir).select("doc_id", front_matter_fields("front_matter").alias("f"))
    return parsed.select(
        "doc_id",
        "f.name",
        "f.description",
        F.array_join("f.tools", ",").alias("tools"),
        F.array_join("f.skills", ",").alias("skills"),
    )


@query(
    "split_sections",
    f"WITH {_PARTS}, lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM "
    f"(SELECT doc_id, regexp_extract_all(body, '{LINE}') AS l FROM bodies)), "
    f"marked AS (SELECT *, regexp_matches(line, '^[{INLINE}]*#') AS headed FROM lines), "
    "placed AS (SELECT *, sum(CAST(headed AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS part FROM marked), "
    "sections AS (SELECT doc_id, part, "
    f"coalesce(regexp_replace(max(line) FILTER (headed), '[{SPACE}]+\\z', ''), '') AS heading, "
    "regexp_replace(coalesce(string_agg(line, '' ORDER BY pos) FILTER (NOT headed), ''), "
    f"'\\A[{SPACE}]+|[{SPACE}]+\\z', '', 'g') AS body FROM placed GROUP BY doc_id, part) "
    "SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY part) - 1 AS INTEGER) AS pos, heading, body "
    "FROM sections WHERE heading <> '' OR body <> ''",
)
def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir)
    placed = parts.select("doc_id", F.posexplode(document_sections("body")).alias("pos", "section"))
    return placed.select("doc_id", "pos", "section.heading", "section.body")


@query(
    "normalise_text",
    f"SELECT doc_id, trim(regexp_replace(text, '[{SPACE}]+', ' ', 'g'), ' ') AS normalised, "
    "nullif(CASE WHEN lang = 'en' THEN '' ELSE source END, '') AS source FROM documents",
)
def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanked = F.when(F.col("lang") == "en", "").otherwise(F.col("source"))
    return read(spark, sf_dir, "documents").select(
        "doc_id", normalise_text("text").alias("normalised"), blank_to_null(blanked).alias("source")
    )


@query(
    "error_messages",
    "SELECT event_id, substring(trim('  could not read ' || repeat(props || ' ', CAST(event_id % 40 AS INTEGER)), ' '), 1, 200) "
    "AS message FROM events",
)
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of failed requests are reported up to 200 characters."""
    repeated = F.repeat(F.concat("props", F.lit(" ")), F.pmod("event_id", F.lit(40)).cast("int"))
    message = F.concat(F.lit("  could not read "), repeated)
    return read(spark, sf_dir, "events").select("event_id", short_message(message).alias("message"))


_PATH = (
    "CASE doc_id % 6 WHEN 0 THEN '.claude/agents/' || source || '.md' WHEN 1 THEN '.claude/skills/' || source || "
    "'/SKILL.md' WHEN 2 THEN '.claude/skills/a/' || source || '/SKILL.md' WHEN 3 THEN '.claude/agents/' || source "
    "|| '.txt' WHEN 4 THEN 'docs/.claude/agents/' || source || '.md' ELSE '.claude/skills/' || source || '.md' END"
)


@query(
    "classify_path",
    f"WITH paths AS (SELECT doc_id, {_PATH} AS path FROM documents), parts AS (SELECT *, "
    "string_split(path, '/') AS p FROM paths) SELECT doc_id, path, "
    "CASE WHEN len(p) = 4 AND p[1] = '.claude' AND p[2] = 'skills' AND p[4] = 'SKILL.md' THEN 'skill' "
    "WHEN len(p) = 3 AND p[1] = '.claude' AND p[2] = 'agents' AND ends_with(p[3], '.md') THEN 'agent' END AS kind, "
    "CASE WHEN len(p) = 4 AND p[1] = '.claude' AND p[2] = 'skills' AND p[4] = 'SKILL.md' THEN p[3] "
    "WHEN len(p) = 3 AND p[1] = '.claude' AND p[2] = 'agents' AND ends_with(p[3], '.md') "
    "THEN p[3][:-4] END AS name FROM parts",
)
def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = read(spark, sf_dir, "documents").select("doc_id", _path().alias("path"))
    found = located.withColumn("definition", classify_path("path"))
    return found.select("doc_id", "path", "definition.kind", "definition.name")


def _path():
    kind = F.pmod("doc_id", F.lit(6))
    shapes = [
        (".claude/agents/", ".md"),
        (".claude/skills/", "/SKILL.md"),
        (".claude/skills/a/", "/SKILL.md"),
        (".claude/agents/", ".txt"),
        ("docs/.claude/agents/", ".md"),
        (".claude/skills/", ".md"),
    ]
    path = F.lit(None).cast("string")
    for number, (before, after) in enumerate(shapes):
        path = F.when(kind == number, F.concat(F.lit(before), "source", F.lit(after))).otherwise(path)
    return path


_REGISTRY = (
    f"WITH {inputs.DEFINITIONS}, parts AS (SELECT doc_id, content, CASE WHEN doc_id % 2 = 0 THEN 'agent' ELSE 'skill' END "
    "AS kind, 'd' || doc_id AS name, CASE WHEN doc_id % 3 = 0 THEN 'document ' || doc_id || ' in ' || lang END "
    "AS description FROM definitions) "
    "SELECT kind, name, 1 AS version, description, md5(content) AS digest FROM parts UNION ALL "
    "SELECT kind, name, 2, description, md5(content || chr(10) || 'more') FROM parts WHERE doc_id % 5 = 0"
)


@query("registry_sync", _REGISTRY)
def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as definitions, synced twice: a fifth of them has changed by the second time."""
    prefix = f"registry_{uuid.uuid4().hex}_"
    files = inputs.definitions(spark, sf_dir).select(
        F.when(F.pmod("doc_id", F.lit(2)) == 0, "agent").otherwise("skill").alias("kind"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("name"),
        "doc_id",
        "content",
        F.lit(None).cast("string").alias("error"),
    )
    altered = F.when(F.pmod("doc_id", F.lit(5)) == 0, F.concat("content", F.lit("\nmore"))).otherwise(F.col("content"))
    sync_definitions(spark, files, prefix, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    sync_definitions(spark, files.withColumn("content", altered), prefix, dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc))
    tables = [
        spark.table(registry_table(kind, prefix)).select(
            F.lit(kind).alias("kind"), "name", F.col("version").cast("int").alias("version"), "description", F.md5("content").alias("digest")
        )
        for kind in KINDS
    ]
    return tables[0].unionByName(tables[1])


_TREE = (
    f"WITH {inputs.DEFINITIONS}, named AS (SELECT doc_id, content, CASE WHEN doc_id % 2 = 0 THEN 'agent' ELSE 'skill' END "
    "AS kind, CASE doc_id % 3 WHEN 0 THEN 'd' WHEN 1 THEN '_d' ELSE '.d' END || doc_id AS name FROM definitions), "
    "located AS (SELECT *, CASE kind WHEN 'agent' THEN '.claude/agents/' || name || '.md' "
    "ELSE '.claude/skills/' || name || '/SKILL.md' END AS path FROM named) "
    "SELECT kind, name, path, row_number() OVER (PARTITION BY kind ORDER BY path) AS position, "
    "CASE WHEN doc_id % 7 > 0 THEN md5(CASE WHEN doc_id % 11 = 0 THEN '' "
    "ELSE regexp_replace(content, '\r\n?', chr(10), 'g') END) END AS digest, "
    "CASE WHEN doc_id % 7 = 0 THEN 'not valid UTF-8' END AS error FROM located"
)


@query("definition_tree", _TREE)
def definition_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as definition files, hidden, empty and broken ones among them, and read back in path order."""
    project = new_folder(spark, "tree")
    number = F.col("doc_id").cast("string")
    mark = F.when(F.pmod("doc_id", F.lit(3)) == 0, "d").when(F.pmod("doc_id", F.lit(3)) == 1, "_d").otherwise(".d")
    body = F.when((F.pmod("doc_id", F.lit(7)) > 0) & (F.pmod("doc_id", F.lit(11)) == 0), "").otherwise(F.col("content"))
    broken = F.when(F.pmod("doc_id", F.lit(7)) == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    files = inputs.definitions(spark, sf_dir).select(
        F.when(F.pmod("doc_id", F.lit(2)) == 0, "agent").otherwise("skill").alias("kind"),
        F.concat(mark, number).alias("name"),
        F.concat(F.coalesce(body.cast("binary"), F.unhex(F.lit(""))), broken).alias("content"),
    )
    write_definitions(files, project)
    # Written before it is put in order, as finding the borders of an order reads its rows once more.
    found = materialise(read_definitions(spark, project).withColumn("digest", F.md5("content")).drop("content"), "found")
    ordered = split_groups(found, ["kind"], ["path"])
    remove_definitions(found, project)
    remove_folder(spark, project)
    discard(found)
    return number_rows(ordered, ["kind"], ["path"], "position").select("kind", "name", "path", "position", "digest", "error")
