"""Versions by manifest, the ledger of landed files, and counts of the write itself."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import versions as versions_module
from tidemark.sources.files import file_names, put_text
from tidemark.sources.landing import land, read_landed, read_ledger, require_observed, store_payloads
from tidemark.sources.versions import (
    append_version,
    manifest_of,
    read_version,
    version_history,
    versions,
)

DDL = "player_id string, items array<string>"


def test_a_version_is_there_or_not(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "v")
    with pytest.raises(ValueError, match="no version"):
        read_version(spark, path)
    assert versions(spark, path) == []

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions_module, "put_text", crash)
        with pytest.raises(OSError):
            append_version(spark.range(5), path, "1")
    assert versions(spark, path) == [] and len(os.listdir(f"{path}/data")) == 1
    append_version(spark.range(3), path, "2")
    with monkeypatch.context() as m:
        m.setattr(versions_module, "put_text", crash)
        with pytest.raises(OSError):
            append_version(spark.range(9), path, "2")
    assert read_version(spark, path).count() == 3


def test_an_empty_version_is_a_version_and_replaces(spark, tmp_path):
    path = str(tmp_path / "v")
    append_version(spark.range(4), path, "a/b: c*")
    append_version(spark.range(4).limit(0), path, "b")
    assert versions(spark, path) == ["a/b: c*", "b"]
    assert read_version(spark, path).count() == 0
    assert read_version(spark, path).columns == ["id", "version"]
    manifest = append_version(spark.range(4).limit(0), path, "a/b: c*")
    assert manifest["n_rows"] == 0
    assert read_version(spark, path, "a/b: c*").count() == 0
    assert {r["version"]: r["n_rows"] for r in version_history(spark, path).collect()} == {"a/b: c*": 0, "b": 0}
    with pytest.raises(ValueError, match="no version x"):
        manifest_of(spark, path, "x")


def test_a_manifest_names_files_rows_and_what_was_observed(spark, tmp_path):
    path = str(tmp_path / "v")
    rows = spark.range(0, 10, 1, 3).withColumn("n", F.when(F.col("id") > 6, F.col("id")))
    found = append_version(rows, path, "1", {"missing": F.count_if(F.col("n").isNull())})
    assert (found["n_rows"], found["observed"]) == (10, {"missing": 7})
    manifest = manifest_of(spark, path)
    assert len(manifest["files"]) == 3
    assert set(manifest["files"]) <= set(os.listdir(f"{path}/{manifest['folder']}"))
    # Versions may have schemas of their own.
    append_version(spark.range(2).withColumn("t", F.lit("x")), path, "2")
    assert read_version(spark, path).columns == ["id", "t", "version"]
    assert read_version(spark, path, "1").columns == ["id", "n", "version"]


def test_text_is_put_in_place_whole(spark, tmp_path):
    path = str(tmp_path / "x" / "a.json")
    put_text(spark, path, "one é")
    put_text(spark, path, "two")
    assert open(path).read() == "two"
    assert file_names(spark, str(tmp_path / "x")) == ["a.json"]
    assert file_names(spark, str(tmp_path / "none")) == []


def put(folder, name, documents):
    folder.mkdir(exist_ok=True)
    lines = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    (folder / name).write_text("\n".join(lines))


def doc(player, *items):
    return {"player_id": player, "items": list(items)}


def landed(spark, target):
    good, bad = read_landed(spark, target, DDL)
    rows = sorted((r["origin"].split("/")[-1], r["player_id"], tuple(r["items"])) for r in good.collect())
    return rows, sorted((r["origin"].split("/")[-1], r["_bad_record"]) for r in bad.collect())


def test_landings_read_new_and_changed_files_only(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    put(source, "a b.json", [doc("#A", "1"), doc("#A", "2"), "", "{broken"])
    put(source, "b.json", [doc("#B", "1")])
    first = land(spark, str(source), target, DDL)
    assert (first["files"], first["rows"], first["bad"], first["missing_items"]) == (2, 4, 1, 0)
    one = landed(spark, target)
    assert [r[1:] for r in one[0]] == [("#A", ("1",)), ("#A", ("2",)), ("#B", ("1",))]
    assert [b[1] for b in one[1]] == ["{broken"]
    # Nothing new: nothing is read and nothing is committed.
    assert land(spark, str(source), target, DDL) == {"files": 0, "rows": 0, "bad": 0}
    assert versions(spark, f"{target}/ledger") == ["000000000001"]
    # One file changes, one comes, one goes.
    put(source, "b.json", [doc("#B", "1"), doc("#B", "9")])
    put(source, "c.json", [{"player_id": "#C"}])
    (source / "a b.json").unlink()
    again = land(spark, str(source), target, DDL)
    assert (again["files"], again["rows"], again["missing_items"]) == (2, 3, 1)
    good, _ = read_landed(spark, target, DDL)
    assert sorted(r["player_id"] for r in good.collect()) == ["#A", "#A", "#B", "#B", "#C"]
    assert {r["origin"].split("/")[-1] for r in read_ledger(spark, target).collect()} == {"a%20b.json", "b.json", "c.json"}


def test_a_landing_that_fails_has_no_effect(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.json", [doc("#A", "1")])
    land(spark, str(source), target, DDL)
    put(source, "b.json", [doc("#B", "1")])

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions_module, "put_text", crash)
        with pytest.raises(OSError):
            land(spark, str(source), target, DDL)
    assert [r[1] for r in landed(spark, target)[0]] == ["#A"]
    assert land(spark, str(source), target, DDL)["files"] == 1
    assert [r[1] for r in landed(spark, target)[0]] == ["#A", "#B"]


def test_nothing_landed(spark, tmp_path):
    good, bad = read_landed(spark, str(tmp_path / "out"), DDL)
    assert good.columns == ["origin", "player_id", "items"] and good.count() == bad.count() == 0


def test_one_stored_parse_for_good_and_bad(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "a.json", [doc("#A", "1"), '{"player_id": 5', doc(None, "2"), " "])
    found = store_payloads(spark, str(source), DDL, str(tmp_path / "out"))
    assert found.counts == {"rows": 3, "bad": 1, "missing_player_id": 1, "missing_items": 0}
    assert sorted(str(r["player_id"]) for r in found.good.collect()) == ["#A", "None"]
    assert [r[0] for r in found.bad.collect()] == ['{"player_id": 5']
    for side in (found.good, found.bad):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and "FileScan text" not in plan
    require_observed(found.counts, "rows", "payloads")
    require_observed(found.counts, "bad", "payloads", most=0.5)
    with pytest.raises(ValueError, match="1 of 3 rows in payloads are bad"):
        require_observed(found.counts, "bad", "payloads", most=0.1)
    with pytest.raises(ValueError, match="no rows in payloads"):
        require_observed(found.counts | {"rows": 0}, "rows", "payloads")
