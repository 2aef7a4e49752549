"""The CSV reader that splits files, against Python's own reader of whole files."""

import csv
import random

import pytest
from ledgerline.operators import changes
from ledgerline.schemas import INGEST_SEQ
from ledgerline.sources.csv_snapshot import SourceError, read_source
from pyspark.sql import functions as F

VALUES = ["a", 'say "hi"', "two\nlines", "x,y", '"', 'é\n\n\nü"q"', "long " * 40, 'a\nb"c"\nd', "", "  pad "]


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _write(path, header, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(header)
        writer.writerows([[r[c] for c in header] for r in rows])


def test_split_files_equal_whole_files_in_order(spark, small_ranges, tmp_path):
    rng, expected = random.Random(5), []
    for name, header, end in (("a", ["id", "v", "w"], "\n"), ("b", ["w", "id", "v"], "\r\n"), ("c", ["v", "w", "id"], "\n")):
        rows = [{"id": f"{name}{i}", "v": rng.choice(VALUES), "w": rng.choice(VALUES)} for i in range(120)]
        _write(tmp_path / f"{name}.csv", header, rows, end)
        expected += [tuple(r[c] or None for c in ("id", "v", "w")) for r in rows]
    df = read_source(spark, str(tmp_path), ["id", "v", "w"])
    assert df.rdd.getNumPartitions() > 20
    rows = df.collect()
    assert [tuple(r)[:3] for r in sorted(rows, key=lambda r: r[INGEST_SEQ])] == expected
    assert len({r[INGEST_SEQ] for r in rows}) == len(rows)
    assert {r[INGEST_SEQ] >> changes.FILE_SHIFT for r in rows} == {0, 1, 2}


def test_a_record_longer_than_a_range(spark, small_ranges, tmp_path):
    rows = [{"id": "1", "v": "line\n" * 500}, {"id": "2", "v": "x"}]
    _write(tmp_path / "a.csv", ["id", "v"], rows)
    got = read_source(spark, str(tmp_path / "a.csv")).orderBy(INGEST_SEQ).collect()
    assert [(r["id"], r["v"]) for r in got] == [("1", "line\n" * 500), ("2", "x")]


def test_odd_files(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes('﻿"id",v\n\n1,\n   \n2,""\n'.encode())
    got = read_source(spark, str(tmp_path / "bom.csv"), ["id", "v"]).orderBy(INGEST_SEQ).collect()
    assert [(r["id"], r["v"]) for r in got] == [("1", None), ("2", None)]
    (tmp_path / "head.csv").write_text("id,v\n")
    assert read_source(spark, str(tmp_path / "head.csv")).count() == 0
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(SourceError):
        read_source(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "open.csv").write_text('id,v\n1,"never closed\n2,x\n')
    with pytest.raises(Exception, match="no end"):
        read_source(spark, str(tmp_path / "open.csv")).collect()
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text("id,v\n1,x\n")
    (tmp_path / "two" / "b.csv").write_text("id,other\n1,x\n")
    with pytest.raises(SourceError, match="lacks columns"):
        read_source(spark, str(tmp_path / "two"))


def test_a_key_with_most_of_a_file_is_spread(spark, monkeypatch):
    """Heavy keys are cut into runs; the result is that of one window over the key."""
    rng = random.Random(8)
    rows = [("hot" if rng.random() < 0.4 else str(i % 50), rng.choice("ab"), (i % 3) << changes.FILE_SHIFT | i) for i in range(900)]
    src = spark.createDataFrame(rows, f"k string, v string, {INGEST_SEQ} long")
    stored = spark.createDataFrame([("hot", "a"), ("7", "b"), (None, "a")], "k string, v string")
    expected, last = [], dict([("hot", "a"), ("7", "b")])
    for k, v, seq in sorted(rows, key=lambda r: r[2]):
        if last.get(k) != v:
            expected.append((k, v, seq))
        last[k] = v
    for heavy, run in ((changes.HEAVY_ROWS, changes.RUN_ROWS), (40, 25)):
        monkeypatch.setattr(changes, "HEAVY_ROWS", heavy)
        monkeypatch.setattr(changes, "RUN_ROWS", run)
        got = changes.new_or_changed(src, stored, ["k"], ["k", "v"]).collect()
        assert sorted(map(tuple, got), key=lambda r: r[2]) == expected
    sizes = src.withColumn("run", F.floor(F.col(INGEST_SEQ) / 25)).groupBy("k", "run").count()
    assert sizes.agg(F.max("count")).first()[0] <= 25


def test_change_capture_exchanges_rows_once(spark):
    src = spark.createDataFrame([("1", "a", 1)], f"k string, v string, {INGEST_SEQ} long")
    stored = spark.createDataFrame([("1", "b")], "k string, v string")
    plan = changes.new_or_changed(src, stored, ["k"], ["k", "v"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Join" not in plan
