"""Whole files read and written in tasks."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_tables import definition
from tideline.sources import files as S
from tideline.sources.definitions import read_definitions, remove_definitions, write_definitions
from tideline.sources.files import open_store, read_files, remove_files, write_files
from tideline.workload import documents

NAMES = ["a.md", "_b.md", ".c.md", "d 100%+é#?.md", "_x/.y/e.md", "empty.md", "f.txt"]


def bodies(df) -> dict:
    return {r["path"]: bytes(r["content"]) for r in df.collect()}


def test_every_name_comes_back(spark, tmp_path):
    folder = str(tmp_path / "a b+c%20é")
    want = {n: b"" if n == "empty.md" else n.encode() + b"\xff\r\n" for n in NAMES}
    rows = [(n, bytearray(c), i) for i, (n, c) in enumerate(want.items())]
    write_files(spark.createDataFrame(rows, "path string, content binary, extra int"), folder)
    assert bodies(read_files(spark, folder)) == want
    assert bodies(read_files(spark, folder, ".md")) == {n: c for n, c in want.items() if n.endswith(".md")}
    assert bodies(read_files(spark, f"file:{folder}")) == bodies(read_files(spark, f"file://{folder}/")) == want
    # A second write of the same rows, as of a task run again, changes nothing.
    write_files(spark.createDataFrame(rows, "path string, content binary, extra int"), folder)
    assert bodies(read_files(spark, folder)) == want


def test_no_folder_and_no_rows(spark, tmp_path):
    assert read_files(spark, str(tmp_path / "none")).count() == 0
    write_files(spark.createDataFrame([], "path string, content string"), str(tmp_path / "empty"))
    assert read_files(spark, str(tmp_path / "empty")).count() == 0
    write_files(spark.createDataFrame([("n.md", None)], "path string, content string"), str(tmp_path / "null"))
    assert bodies(read_files(spark, str(tmp_path / "null"))) == {"n.md": b""}


@pytest.mark.parametrize("paths", [["a", "a"], [None], ["../a"], ["/a"], ["b/"], ["."], [""]])
def test_paths_that_cannot_be_written(spark, tmp_path, paths):
    with pytest.raises(ValueError, match="cannot be written"):
        write_files(spark.createDataFrame([(p, "x") for p in paths], "path string, content string"), str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()


def test_files_are_dealt_to_tasks(tmp_path, monkeypatch):
    for i, size in enumerate((10, 10, 100, 0, 5, 5, 5)):
        (tmp_path / f"{i}").write_bytes(b"x" * size)
    monkeypatch.setattr(S, "TASK_BYTES", 20)
    monkeypatch.setattr(S, "TASK_FILES", 3)
    monkeypatch.setattr(S, "BATCH_BYTES", 15)
    reader = S.WholeFiles({"path": str(tmp_path)}).reader(None)
    bundles = reader.partitions()
    assert [list(b.paths) for b in bundles] == [["0", "1"], ["2"], ["3", "4", "5"], ["6"]]
    batches = [batch.num_rows for b in bundles for batch in reader.read(b)]
    assert batches == [2, 1, 3, 1]


def test_addresses():
    assert open_store("/x/y")[1] == open_store("file:/x/y")[1] == open_store("file:///x/y/")[1] == "/x/y"


def test_definitions_there_and_back(spark, tmp_path):
    definition(tmp_path, ".claude/agents/_a.md", "")
    definition(tmp_path, ".claude/agents/b.md", "x\r\ny")
    definition(tmp_path, ".claude/agents/b.txt", "no definition")
    definition(tmp_path, ".claude/skills/.s/SKILL.md", "é", "latin-1")
    found = read_definitions(spark, str(tmp_path))
    got = {(r.kind, r.name): (r.content, r.error) for r in found.collect()}
    assert got == {("agent", "_a"): ("", None), ("agent", "b"): ("x\ny", None), ("skill", ".s"): (None, "not valid UTF-8")}
    again = str(tmp_path / "again")
    write_definitions(found.where(F.col("error").isNull()), again)
    assert sorted((r.kind, r.name, r.path, r.content) for r in read_definitions(spark, again).collect()) == [
        ("agent", "_a", ".claude/agents/_a.md", ""),
        ("agent", "b", ".claude/agents/b.md", "x\ny"),
    ]
    for kind, name in (("agent", "a/b"), ("skill", ".."), ("tool", "a"), ("agent", None)):
        with pytest.raises(ValueError, match="cannot be written"):
            write_definitions(spark.createDataFrame([(kind, name, "x")], "kind string, name string, content string"), again)


def test_definitions_are_removed_in_tasks(spark, tmp_path):
    for path in ("agents/_a.md", "agents/b.md", "agents/b.txt", "skills/.s/SKILL.md", "skills/.s/more/x.txt", "skills/t/SKILL.md"):
        definition(tmp_path, f".claude/{path}", "x")
    found = read_definitions(spark, str(tmp_path)).where("name <> 't'").cache()
    for _ in range(2):
        remove_definitions(found, str(tmp_path))
    found.unpersist()
    left = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file())
    assert left == [".claude/agents/b.txt", ".claude/skills/t/SKILL.md"]
    assert not (tmp_path / ".claude/skills/.s").exists()


@pytest.mark.parametrize("path", [None, "../a", "a/../..", "", "."])
def test_paths_that_cannot_be_removed(spark, tmp_path, path):
    (tmp_path / "a").write_text("x")
    with pytest.raises(ValueError, match="cannot be removed"):
        remove_files(spark.createDataFrame([("a",), (path,)], "path string"), str(tmp_path))
    assert (tmp_path / "a").exists()


def test_the_tree_is_read_once_and_leaves_no_files_to_the_driver(spark, tmp_path, monkeypatch):
    rows = [(k, f"Some. text, {k}", "en", "web", 12) for k in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    calls = []

    def split(df, *args):
        calls.append(bool(df.inputFiles()))
        return split_groups(df, *args)

    def remove(session, folder):
        calls.append([str(p) for p in Path(folder.removeprefix("file:")).rglob("*") if p.is_file() and p.suffix != ".crc"])
        remove_folder(session, folder)

    split_groups, remove_folder = documents.split_groups, documents.remove_folder
    monkeypatch.setattr(documents, "split_groups", split)
    monkeypatch.setattr(documents, "remove_folder", remove)
    assert documents.definition_tree(spark, str(tmp_path)).count() == 40
    assert calls == [True, []]
