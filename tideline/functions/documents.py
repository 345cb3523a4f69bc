"""Column functions on whole definition documents, one document per row.

A document never leaves its row, so splitting needs no shuffle.  Only the unified
diff text uses Python, in Arrow batches.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.patterns import INLINE_SPACE, LINE_END, NO_BREAK, WHOLE_LINE
from tideline.functions.scalars import _col, normalise_text, rstrip_text, starts_with_mark, strip_text

# Folder names, file suffix and file name that mark a definition.
DEFINITION_ROOT = ".claude"
AGENT_FOLDER, AGENT_SUFFIX = "agents", ".md"
SKILL_FOLDER, SKILL_FILE = "skills", "SKILL.md"

# Texts given where there is nothing to diff.
TOO_FEW = "(fewer than 2 snapshots exist for '%s' — nothing to diff)"
NO_CHANGE = "(no text changes between last two snapshots)"

_RULE = rf"{INLINE_SPACE}*---{INLINE_SPACE}*"
# From the opening rule to the end of the closing rule's line.
_HEADER = rf"(?s)\A{_RULE}(?>{LINE_END}).*?(?<!{NO_BREAK}){_RULE}(?:{LINE_END}|\z)"
# The lines between the two rules of such a header.
_HEADER_LINES = rf"(?s)\A{NO_BREAK}*+(?>{LINE_END})(.*?){_RULE}(?:{LINE_END}|\z)\z"
_FIRST_LINE = rf"\A{NO_BREAK}*+"
# A line start with a heading ahead; the lookbehind also holds at the very start.
_HEADING_AHEAD = rf"(?<!{NO_BREAK})(?={INLINE_SPACE}*#)"


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _after(text: Column, start: Column) -> Column:
    """What follows ``start`` at the beginning of ``text``."""
    return F.substr(text, F.char_length(start) + 1)


def front_matter_parts(content: Column | str) -> Column:
    """``struct(front_matter, body)``; without a closed header all is body."""
    content = _col(content)
    opened = starts_with_mark(content, "---")
    header = F.when(opened, F.regexp_extract(content, _HEADER, 0)).otherwise("")
    return _once(
        header,
        lambda h: F.struct(
            F.when(h != "", F.regexp_extract(h, _HEADER_LINES, 1)).otherwise("").alias("front_matter"),
            F.when(h != "", _after(content, h)).otherwise(content).alias("body"),
        ),
    )


def document_sections(body: Column | str) -> Column:
    """``array<struct(heading, body)>``, cut before every heading line.

    A heading is any line whose first visible character is ``#``, code fences
    included.  Text before the first heading gets a blank heading, and is left
    out when it is empty.
    """
    pieces = F.split(_col(body), _HEADING_AHEAD)

    def section(piece: Column) -> Column:
        line = F.when(starts_with_mark(piece), F.regexp_extract(piece, _FIRST_LINE, 0)).otherwise("")
        return _once(
            line,
            lambda first: F.struct(
                rstrip_text(first).alias("heading"), strip_text(_after(piece, first)).alias("body")
            ),
        )

    return F.filter(
        F.transform(pieces, section),
        lambda s: (s["heading"] != "") | (s["body"] != ""),
    )


def classify_path(path: Column | str, root: str = DEFINITION_ROOT) -> Column:
    """``struct(kind, name)`` for a project-relative path, NULL for any other file."""
    path = _col(path)
    stem = rf"\A\Q{root}\E/"
    agent = rf"{stem}{AGENT_FOLDER}/([^/]*)\Q{AGENT_SUFFIX}\E\z"
    skill = rf"{stem}{SKILL_FOLDER}/([^/]*)/\Q{SKILL_FILE}\E\z"
    return (
        F.when(
            path.rlike(skill),
            F.struct(F.lit("skill").alias("kind"), F.regexp_extract(path, skill, 1).alias("name")),
        )
        .when(
            path.rlike(agent),
            F.struct(F.lit("agent").alias("kind"), F.regexp_extract(path, agent, 1).alias("name")),
        )
    )


def lines_of(content: Column | str) -> Column:
    """The lines of a text, each with its own break."""
    return F.regexp_extract_all(_col(content), F.lit(f"({WHOLE_LINE})"), 1)


def front_matter_fields(front_matter: Column | str) -> Column:
    """``struct(name, description, tools, skills)`` of a header of ``key: value`` lines.

    A value is plain or quoted text, text on indented lines, or a list in brackets or on
    dashed lines; one text counts as a list of one.  Keys that are missing, empty or
    not closed give empty fields.  Nested mappings, anchors and tags are not read.
    """
    header = F.regexp_replace(_col(front_matter), r"\r\n?", "\n")

    def values(field: str) -> Column:
        line = rf"(?m)^{field}:(?:[ \t]+([^\n]*?))?[ \t]*$"
        below = rf"(?m)^{field}:[^\n]*\n((?:[ \t]+[^\n]*(?:\n|\z)|-(?:[ \t][^\n]*)?(?:\n|\z)|\n)*)"
        return _once(
            F.struct(
                F.regexp_replace(F.regexp_extract(header, line, 1), r"(?:^|[ \t]+)#.*$", "").alias("inline"),
                F.regexp_extract(header, below, 1).alias("below"),
            ),
            lambda found: _listed(found["inline"], found["below"]),
        )

    return F.struct(
        F.get(values("name"), F.lit(0)).alias("name"),
        normalise_text(F.get(values("description"), F.lit(0))).alias("description"),
        values("tools").alias("tools"),
        values("skills").alias("skills"),
    )


def _listed(inline: Column, below: Column) -> Column:
    bracketed = F.transform(F.split(F.substr(inline, F.lit(2), F.length(inline) - 2), ","), lambda x: _unquoted(strip_text(x)))
    dashed = F.transform(
        F.regexp_extract_all(below, F.lit(r"(?m)^[ \t]*-[ \t]+([^\n]*)$"), F.lit(1)),
        lambda x: _unquoted(strip_text(F.regexp_replace(x, r"(?:^|[ \t]+)#.*$", ""))),
    )
    text = F.when(inline.rlike(r"^[>|][+-]?$"), "").otherwise(inline)
    folded = F.array(_unquoted(strip_text(F.concat_ws("\n", text, below))))
    found = (
        F.when(inline.rlike(r"^\[.*\]$"), bracketed)
        .when(inline.startswith("[") | inline.startswith("{"), F.array().cast("array<string>"))
        .when((inline == "") & (F.size(dashed) > 0), dashed)
        .otherwise(folded)
    )
    return F.filter(found, lambda x: (x != "") & ~x.isin("~", "null"))


def _unquoted(text: Column) -> Column:
    return F.when(text.rlike(r"(?s)^(?:'.*'|\".*\")$"), F.substr(text, F.lit(2), F.length(text) - 2)).otherwise(text)


def unified_diff(
    older: Column | str, newer: Column | str, older_label: Column, newer_label: Column, n_context: int = 5
) -> Column:
    """Unified diff text of two texts, one pair per row; NULL where either is NULL."""
    return _unified_diff(_col(older), _col(newer), older_label, newer_label, F.lit(n_context))


@F.pandas_udf(T.StringType())
def _unified_diff(
    older: pd.Series, newer: pd.Series, older_label: pd.Series, newer_label: pd.Series, n_context: pd.Series
) -> pd.Series:
    def one(old, new, old_label, new_label, n):
        if old is None or new is None:
            return None
        old_lines, new_lines = old.splitlines(keepends=True), new.splitlines(keepends=True)
        return "".join(difflib.unified_diff(old_lines, new_lines, old_label, new_label, n=n))

    rows = zip(older, newer, older_label, newer_label, n_context, strict=True)
    return pd.Series([one(*row) for row in rows], dtype=object)
