"""Change capture (loader) cases with known answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import changes
from ledgerline.sources.csv_snapshot import SourceError, read_source

COLS = ("id", "op_date", "amount")
KEYS = ("id",)
SCHEMA = "id STRING, op_date STRING, amount STRING, ingest_seq LONG"
STORED = "id STRING, op_date STRING, amount STRING, loaded_at TIMESTAMP, ingest_seq LONG"


def src(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA)


def stored(spark, rows, ts="2024-02-01 00:00:00"):
    t = dt.datetime.fromisoformat(ts)
    return spark.createDataFrame([(*r, t, i) for i, r in enumerate(rows)], STORED)


def load(spark, source_rows, stored_rows=None, days=30):
    raw = stored(spark, stored_rows) if stored_rows is not None else None
    processed, inserted = changes.changes_for_load(src(spark, source_rows), raw, KEYS, COLS, "op_date", days)
    return processed, sorted(tuple(r[c] for c in COLS) for r in inserted.collect())


def test_first_load_appends_everything(spark):
    rows = [("1", "2024-01-10", "10"), ("2", "2024-01-11", "20"), ("3", "2024-01-12", "30")]
    _, ins = load(spark, rows)
    assert ins == sorted(rows)


def test_unchanged_snapshot_appends_nothing(spark):
    rows = [("1", "2024-01-10", "10"), ("2", "2024-01-11", "20")]
    _, ins = load(spark, rows, rows)
    assert ins == []


def test_changed_amount_inside_window(spark):
    old = [("1", "2024-01-10", "10"), ("2", "2024-01-20", "20")]
    _, ins = load(spark, [("1", "2024-01-10", "12"), ("2", "2024-01-20", "20")], old)
    assert ins == [("1", "2024-01-10", "12")]


def test_window_boundary_is_inclusive_and_older_rows_are_skipped(spark):
    # stored max date 2024-02-10 -> cutoff 2024-01-11
    old = [("1", "2024-01-11", "10"), ("2", "2024-01-10", "10"), ("9", "2024-02-10", "1")]
    new = [("1", "2024-01-11", "11"), ("2", "2024-01-10", "11"), ("9", "2024-02-10", "1")]
    processed, ins = load(spark, new, old)
    assert ins == [("1", "2024-01-11", "11")]
    assert processed.count() == 2


def test_cutoff_is_max_minus_days(spark):
    raw = stored(spark, [("1", "2024-01-11", "1"), ("2", "2024-02-10", "1")])
    row = changes.cutoff_frame(raw, "op_date", 30).first()
    assert row["max_date"] == dt.date(2024, 2, 10)
    assert row["cutoff_date"] == dt.date(2024, 1, 11)


def test_repeats_inside_one_file(spark):
    # A, B, A, A -> A, B, A
    rows = [("1", "2024-01-10", "A"), ("1", "2024-01-10", "B"), ("1", "2024-01-10", "A"), ("1", "2024-01-10", "A")]
    s = src(spark, rows)
    out = changes.new_or_changed(s, None, KEYS, COLS).orderBy("ingest_seq").collect()
    assert [r["amount"] for r in out] == ["A", "B", "A"]
    assert [r["ingest_seq"] for r in out] == [0, 1, 2]


def test_repeats_seeded_by_stored_version(spark):
    rows = [("1", "2024-01-10", "A"), ("1", "2024-01-10", "B")]
    _, ins = load(spark, rows, [("1", "2024-01-10", "A")])
    assert ins == [("1", "2024-01-10", "B")]


def test_text_only_change_is_a_change(spark):
    _, ins = load(spark, [("1", "2024-01-10", "1.00")], [("1", "2024-01-10", "1.0")])
    assert ins == [("1", "2024-01-10", "1.00")]


def test_null_equals_null(spark):
    _, ins = load(spark, [("1", "2024-01-10", None)], [("1", "2024-01-10", None)])
    assert ins == []


def test_hot_key_split_over_files(spark):
    """One key spread over several files: the hand-over between files uses the last row of
    the previous file, so the result equals a single sequential pass."""
    shift = 1 << changes.FILE_SHIFT
    values = ["A", "A", "B", "B", "A", "C", "C", "C", "A"]
    rows = [("1", "2024-01-10", v, (i // 3) * shift + i) for i, v in enumerate(values)]
    s = spark.createDataFrame(rows, SCHEMA)
    out = changes.new_or_changed(s, stored(spark, [("1", "2024-01-10", "A")]), KEYS, COLS).orderBy("ingest_seq")
    # sequential reference: keep when different from the previous value, seeded with stored "A"
    prev, want = "A", []
    for v in values:
        if v != prev:
            want.append(v)
        prev = v
    assert [r["amount"] for r in out.collect()] == want


def test_load_counts(spark):
    old = [("1", "2024-01-10", "10")]
    processed, inserted = changes.changes_for_load(
        src(spark, [("1", "2024-01-10", "11"), ("2", "2024-01-10", "5")]), stored(spark, old), KEYS, COLS, "op_date", 30
    )
    row = changes.load_counts("t", processed, inserted).first()
    assert (row["processed_rows"], row["inserted_rows"]) == (2, 2)


def test_csv_source_requires_header(spark, tmp_path):
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(Exception):
        read_source(spark, str(empty), COLS)


def test_csv_source_by_header_name_any_order(spark, tmp_path):
    f = tmp_path / "snap.csv"
    f.write_text('amount,id,op_date\n10,1,2024-01-10\n"2\n0",2,2024-01-11\n')
    df = read_source(spark, str(f), COLS)
    rows = df.orderBy("ingest_seq").collect()
    assert df.columns == [*COLS, "ingest_seq"]
    assert [(r["id"], r["amount"]) for r in rows] == [("1", "10"), ("2", "2\n0")]


def test_csv_source_unknown_column_fails(spark, tmp_path):
    f = tmp_path / "snap.csv"
    f.write_text("id,op_date,amount,extra\n1,2024-01-10,1,x\n")
    with pytest.raises(SourceError):
        read_source(spark, str(f), COLS)
