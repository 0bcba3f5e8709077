"""CSV with bad rows, and the versioned model store."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import types as T

from sylvan.sources import load_tables, model_io, published_numbers, read_csv_checked, save_tables

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("v", T.DoubleType())])


def test_malformed_rows_are_kept_apart_with_their_reason(spark, tmp_path):
    text = ('id,name,v\n1,a,0.5\n2,"b, c",1\n3,d\n4,e,1.0,x\nfive,f,2\n6,g,much\n7,,\n\n8,"say ""hi""",3\n9,"two\nlines",4\n10,"two\nlines",many\n')
    (tmp_path / "a.csv").write_text(text)
    rows, rejects = read_csv_checked(spark, f"file://{tmp_path}/a.csv", SCHEMA, multi_line=True)
    assert sorted(map(tuple, rows.collect())) == [
        (1, "a", 0.5), (2, "b, c", 1.0), (7, None, None), (8, 'say "hi"', 3.0), (9, "two\nlines", 4.0)]
    got = {r.record.split(",")[0]: r.reason for r in rejects.collect()}
    assert got == {"3": "short", "4": "long", "five": "mistyped:id", "6": "mistyped:v", "10": "mistyped:v"}
    assert rows.schema == SCHEMA


def test_lines_are_records_without_multi_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,a,0.5\n2,b\n")
    rows, rejects = read_csv_checked(spark, f"file://{tmp_path}", SCHEMA, header=False)
    assert [tuple(r) for r in rows.collect()] == [(1, "a", 0.5)]
    assert Counter(r.reason for r in rejects.collect()) == {"short": 1}
    with pytest.raises(ValueError):
        read_csv_checked(spark, f"file://{tmp_path}", T.StructType([T.StructField("_record", T.LongType())]))


def _names(about):
    return about["names"]


def test_versions_are_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/model"
    with pytest.raises(FileNotFoundError):
        load_tables(spark, path, _names)
    one, two = spark.range(3), spark.range(5)
    assert save_tables(spark, path, {"nodes": one, "labels-0": one}, {"names": ["nodes", "labels-0"]}) == 1
    held, _ = load_tables(spark, path, _names)

    # A writer that dies between its tables, and one that dies before it publishes.
    with pytest.raises(Exception, match="gone"):
        save_tables(spark, path, {"nodes": two, "labels-0": two.selectExpr("raise_error('gone') AS id")}, {"names": []})
    with monkeypatch.context() as m:
        m.setattr(model_io, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            save_tables(spark, path, {"nodes": two, "labels-0": two}, {"names": ["nodes"]})
    assert published_numbers(spark, path) == [1]
    tables, about = load_tables(spark, path, _names)
    assert {n: t.count() for n, t in tables.items()} == {"nodes": 3, "labels-0": 3} and about == {"names": ["nodes", "labels-0"]}

    assert save_tables(spark, path, {"nodes": two}, {"names": ["nodes"]}) == 2
    assert load_tables(spark, path, _names)[0]["nodes"].count() == 5
    assert load_tables(spark, path, _names, 1)[0]["nodes"].count() == 3 and held["nodes"].count() == 3
    with pytest.raises(FileNotFoundError):
        load_tables(spark, path, _names, 7)


def test_two_writers_of_one_number_are_both_published(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/model"
    save_tables(spark, path, {"nodes": spark.range(1)}, {"names": ["nodes"]})
    real, seen = model_io.published_numbers, []

    def late(spark, path):  # the first look misses the number that another writer has just taken
        seen.append(1)
        return [] if len(seen) == 1 else real(spark, path)

    monkeypatch.setattr(model_io, "published_numbers", late)
    assert save_tables(spark, path, {"nodes": spark.range(2)}, {"names": ["nodes"]}) == 2
    assert [load_tables(spark, path, _names, n)[0]["nodes"].count() for n in (1, 2)] == [1, 2]
