import sqlite3

import pytest
from pyspark.sql import functions as F

from qirtas.graph import resilient
from qirtas.sources import files, web
from qirtas.sources.sqlite import read_sqlite, sqlite_catalog
from qirtas.streaming import ingest as s


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "x.db")
    with sqlite3.connect(path) as link:
        link.execute("CREATE TABLE words (id INTEGER, text TEXT, score REAL)")
        link.executemany("INSERT INTO words VALUES (?, ?, ?)", [(i, f"w{i}", i / 2) for i in range(50)] + [(None, None, None)])
    rows = read_sqlite(spark, path, "words", partition_column="id", partitions=4)
    assert rows.dtypes == [("id", "bigint"), ("text", "string"), ("score", "double")]
    assert rows.count() == 51 and rows.where("id >= 40 and text <> 'w41'").count() == 9
    assert read_sqlite(spark, path, "SELECT id, upper(text) AS u FROM words WHERE id < 3").agg(F.max("u")).first()[0] == "W2"
    assert sqlite_catalog(path) == [("words", 51)]


def test_csv_with_mark_and_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,text\n1,"a ""b""\nc"\n', encoding="utf-8")
    assert [tuple(r) for r in files.read_csv(spark, f"file://{tmp_path}/a.csv").collect()] == [("1", 'a "b"\nc')]
    (tmp_path / "b.csv").write_text("id,text\nx,y\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|malformed"):
        files.read_csv(spark, f"file://{tmp_path}/b.csv", "id int, text string").collect()
    files.append_csv(spark.range(2), f"file://{tmp_path}/c")
    files.append_csv(spark.range(2), f"file://{tmp_path}/c")
    assert files.read_csv(spark, f"file://{tmp_path}/c").count() == 4


def test_progress_and_scalars(spark, tmp_path):
    (tmp_path / "done").write_text("a\n\n  \nb\na\n")
    assert {r.key for r in files.read_progress(spark, f"file://{tmp_path}/done").collect()} == {"a", "b"}
    rows = spark.createDataFrame([('"q"',), ("12",), ("",), ("null",), (None,), ("raw x",)], "v string")
    assert [r[0] for r in rows.select(files.decode_scalar(F.col("v"))).collect()] == ["q", "12", None, None, None, "raw x"]


def test_quarantine(spark):
    rows = spark.createDataFrame([("نور", "a"), ("x", "1"), ("نور", None)], "ar string, la string")
    good, bad = files.split_valid(rows, [(files.has_arabic(F.col("ar")), "ar"), (files.has_latin(F.col("la")), "la")])
    assert good.count() == 1 and {r.reason for r in bad.collect()} == {"ar", "la"}


def test_ingest_resumes(spark, tmp_path):
    base = f"file://{tmp_path}"
    ddl = "id long, v long"
    run = lambda: s.ingest(s.once_per_key(s.stream_files(spark, f"{base}/in", ddl), ["id"]), f"{base}/good", f"{base}/bad", f"{base}/state", [(F.col("v") > 0, "low")])
    spark.createDataFrame([(1, 1), (1, 2), (2, 0)], ddl).write.parquet(f"{base}/in", mode="append")
    run()
    spark.createDataFrame([(1, 5), (3, 1)], ddl).write.parquet(f"{base}/in", mode="append")
    run()
    run()
    assert sorted(r.id for r in spark.read.parquet(f"{base}/good").collect()) == [1, 3]
    assert [r.reason for r in spark.read.parquet(f"{base}/bad").collect()] == ["low"]


def test_pages_until_nothing_new(spark):
    pages = spark.createDataFrame([("u", 1, "a"), ("u", 2, "b"), ("u", 3, "a"), ("u", 4, "c"), ("v", 2, "x"), ("u", 1, ""), ("u", 2, None)], "unit string, page int, key string")
    assert {tuple(r) for r in s.until_nothing_new(pages, "unit", "page", "key").select("unit", "page", "key").collect()} == {("u", 1, "a"), ("u", 2, "b")}
    done = s.completed_units(spark.createDataFrame([("u", True), ("u", False), ("v", True)], "unit string, loaded boolean"), "unit")
    assert {r.unit: r.completed for r in done.collect()} == {"u": False, "v": True}


def test_fetched_pages(spark):
    rows = [("a", 1, None), ("a", 2, " "), ("a", 3, "x"), ("a", 4, "y"), ("b", 4, "late"), ("c", 1, "one"), ("c", 2, "two")]
    got = {tuple(r) for r in web.loaded_pages(spark.createDataFrame(rows, "url string, attempt int, html string")).collect()}
    assert got == {("a", "x", 3, True), ("b", None, None, False), ("c", "one", 1, True)}
    pages = spark.createDataFrame([("u", 1, True), ("u", 2, False), ("u", 3, True), ("v", 1, True)], "unit string, page int, loaded boolean")
    assert {(r.unit, r.page) for r in web.until_failure(pages, "unit", "page").collect()} == {("u", 1), ("v", 1)}


def test_settings(spark):
    env = {"QIRTAS_SOURCES": "s", "QIRTAS_GRAPH": "g", "QIRTAS_CHECKPOINTS": "c", "QIRTAS_PARTITIONS": "7"}
    assert web.Settings.from_environment(env) == web.Settings("s", "g", "c", "corpus", 7)
    with pytest.raises(ValueError, match="QIRTAS_GRAPH"):
        web.Settings.from_environment(env | {"QIRTAS_GRAPH": ""})


def test_resilient_write():
    waited, seen = [], []

    def write(attempt):
        seen.append(attempt)
        if attempt < 2:
            raise ConnectionError

    assert resilient(write, 5, waited.append) == 3 and waited == [2, 4] and seen == [0, 1, 2]
    with pytest.raises(ConnectionError):
        resilient(lambda _: (_ for _ in ()).throw(ConnectionError()), 2, waited.append)
