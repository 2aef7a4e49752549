"""Plans whose shuffles and tasks must not grow faster than the input."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import key_filter
from ledgerline.operators.incremental import newer_than
from ledgerline.plans import build, reports, staging
from ledgerline.sources import fixtures
from test_plans import plan


def test_bets_are_dealt_by_id_once_and_filtered_at_the_scan(spark):
    raw = fixtures.raw_bets(spark, SF_SMALL)
    p = plan(newer_than(staging.stage(raw, "games"), dt.datetime(2000, 6, 30)), "simple")
    assert p.count("Exchange hashpartitioning") == 3  # both sides of the join with orders, then by id
    p = plan(newer_than(raw, dt.datetime(2000, 6, 30)), "simple")
    assert any("Filter" in x and "l_shipdate" in x and "2000-06-30" in x for x in p.splitlines())


def test_a_written_model_is_read_by_column(spark):
    t = build.checkpointed("few", spark.range(5).select("id", (F.col("id") * 2).alias("twice")))
    assert t.rows == 5 and sorted(r["twice"] for r in t.df.collect()) == [0, 2, 4, 6, 8]
    assert "ReadSchema: struct<id:bigint>" in plan(t.df.select("id"))


def test_models_that_cost_a_shuffle_can_be_written_once(spark):
    names = []

    def writing(name, df):
        names.append(name)
        return build.Table(df.limit(0), build.SENTINEL, 0)

    build.full_build(fixtures.raw_tables(spark, SF_SMALL), writing)
    assert names == [*build.STAGING_TABLES, "player_metrics", "metrics_overview"]


def test_key_filters_take_more_tasks_for_more_keys(spark, monkeypatch):
    monkeypatch.setattr(key_filter, "TASK_KEYS", 1_000)
    rows = spark.range(9_500).select((F.col("id") % 3).alias("p"), F.col("id").alias("k"))
    filters = key_filter.build(rows.unionByName(rows.limit(10)), "p", "k")
    assert "hashpartitioning(p" in plan(filters, "simple") and ", 10)" in plan(filters, "simple")
    hits = key_filter.probe(rows.select(F.col("k").alias("key"), "p").withColumnRenamed("p", "q"), filters, "p")
    assert hits.filter(F.col("key") % 3 == F.col("p")).count() == 9_500


def test_previous_period_reads_the_report_once(spark):
    days = [(dt.date(2024, 1, 5), 1.0), (dt.date(2024, 2, 5), 3.0), (dt.date(2024, 4, 1), 5.0), (None, 7.0)]
    o = spark.createDataFrame(days, "activity_date DATE, v DOUBLE").select("activity_date", *[F.col("v").alias(m) for m in reports.METRICS])
    got = reports.period_over_period(o)
    before = plan(got, "simple")
    rows = {r["period_start"]: (r["bets_amount_usd"], r["previous_bets_amount_usd"]) for r in got.collect()}
    assert rows == {dt.date(2024, 1, 1): (1, None), dt.date(2024, 2, 1): (3, 1), dt.date(2024, 4, 1): (5, None), None: (7, None)}
    assert before.count("ExistingRDD") == 1 and "Join" not in before
