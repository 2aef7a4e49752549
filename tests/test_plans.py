"""Physical plan checks: the plans we want, not only the right rows."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from ledgerline.operators.incremental import newer_than
from ledgerline.plans import build
from ledgerline.sources import fixtures
from ledgerline.sources.store import TableStore


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_product_or_python_udf(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in p, (name, bad)


def test_staging_dedup_limits_before_the_shuffle(spark):
    w = build.full_build(fixtures.raw_tables(spark, SF_SMALL))
    p = plan(w.staging["games"])
    assert "WindowGroupLimit" in p and "Partial" in p


def test_rates_are_broadcast_into_facts(spark):
    w = build.full_build(fixtures.raw_tables(spark, SF_SMALL))
    p = plan(w.facts["fact_bet"])
    # the rate join (left outer) is a broadcast; the fixture's own lineitem-orders join may shuffle
    assert "BroadcastHashJoin LeftOuter" in p
    assert "SortMergeJoin LeftOuter" not in p


def test_watermark_filter_reaches_the_scan(spark, tmp_path):
    raw = fixtures.raw_tables(spark, SF_SMALL)
    store = TableStore(spark, str(tmp_path / "wh"))
    store.replace("deposits", build.full_build(raw).staging["deposits"])
    stored = store.read_model("deposits")
    p = plan(newer_than(stored.df, dt.datetime(2000, 6, 30)))
    assert "PushedFilters" in p and "GreaterThan(loaded_at" in p


def test_raw_log_prunes_batches_and_months(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    rows = spark.createDataFrame(
        [("1", "5", "2024-01-10", "1", "10", "USD", 0), ("2", "5", "2024-03-10", "1", "10", "USD", 1)],
        "id STRING, player_id STRING, deposit_date STRING, provider_id STRING, amount STRING, currency STRING, ingest_seq LONG",
    )
    store.append_versions("deposits", rows, dt.datetime(2024, 3, 11))
    df = store.read_raw("deposits", since=dt.datetime(2024, 3, 1), from_date=dt.date(2024, 2, 15))
    p = plan(df)
    assert "PartitionFilters" in p and "_batch" in p and "_month" in p
    assert df.count() == 1


def test_delete_insert_touches_only_batch_partitions(spark, tmp_path):
    raw = fixtures.raw_tables(spark, SF_SMALL)
    store = TableStore(spark, str(tmp_path / "wh"))
    stg = build.full_build(raw).staging["deposits"]
    first = store.replace("deposits", stg.filter(F.col("deposit_date") < F.lit("1999-01-01").cast("date")))
    batch = store.scratch("deposits__batch", stg.filter(F.col("deposit_date") >= F.lit("1999-01-01").cast("date")))
    before_old_months = store.read_model("deposits").df.filter(F.col("deposit_date") < F.lit("1999-01-01").cast("date"))
    n_old = before_old_months.count()
    merged = store.merge_keys("deposits", first, batch, ["deposit_id"])
    assert merged.rows == stg.count() == merged.df.count()
    assert merged.df.filter(F.col("deposit_date") < F.lit("1999-01-01").cast("date")).count() == n_old


def test_stored_facts_prune_to_affected_months(spark, tmp_path):
    from ledgerline.operators.incremental import months_of, prune_months

    raw = fixtures.raw_tables(spark, SF_SMALL)
    store = TableStore(spark, str(tmp_path / "wh"))
    fact = store.replace("fact_deposit", build.full_build(raw).facts["fact_deposit"])
    dates = spark.createDataFrame([(dt.date(1998, 1, 5),), (dt.date(1998, 3, 9),)], "activity_date DATE")
    months = months_of(dates, "activity_date")
    pruned = prune_months(fact.df, months)
    p = plan(pruned)
    assert sorted(months) == [199801, 199803]
    assert "PartitionFilters" in p and "_month" in p
    got = {r[0] for r in pruned.select(F.date_format("deposit_date", "yyyyMM")).distinct().collect()}
    assert got <= {"199801", "199803"}


def test_report_increment_prunes_metric_days(spark, tmp_path):
    from ledgerline.operators.incremental import prune_days

    raw = fixtures.raw_tables(spark, SF_SMALL)
    store = TableStore(spark, str(tmp_path / "wh"))
    pm = store.replace("player_metrics", build.full_build(raw).player_metrics)
    dates = store.scratch("dates", spark.createDataFrame([(dt.date(1998, 1, 5),)], "activity_date DATE"))
    p = plan(prune_days(pm.df, "activity_date", dates.df, dates.rows))
    line = [x for x in p.splitlines() if "PartitionFilters" in x][0]
    assert "1998-01-05" in line
