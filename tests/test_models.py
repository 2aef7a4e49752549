"""Model semantics on hand-made tables (one case per trap of the source models)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import incremental, quality
from ledgerline.plans import build, checks, mart, report, staging

T1 = dt.datetime(2024, 1, 2)
T2 = dt.datetime(2024, 1, 5)
T3 = dt.datetime(2024, 1, 9)
D1 = dt.date(2024, 1, 1)
D2 = dt.date(2024, 1, 2)

RATES = "rate_date DATE, currency STRING, currency_units_per_usd DECIMAL(20,8), loaded_at TIMESTAMP"
DEPOSITS = "deposit_id BIGINT, player_id BIGINT, deposit_date DATE, provider_id BIGINT, amount DECIMAL(20,4), currency STRING, loaded_at TIMESTAMP"
BETS = "bet_id BIGINT, player_id BIGINT, game_date DATE, amount DECIMAL(20,4), currency STRING, provider_id BIGINT, game_id BIGINT, loaded_at TIMESTAMP"
WITHDRAWALS = "withdrawal_id BIGINT, player_id BIGINT, withdrawal_date DATE, provider_id BIGINT, amount DECIMAL(20,4), currency STRING, loaded_at TIMESTAMP"
PLAYERS = "player_id BIGINT, registration_date DATE, registration_type STRING, country STRING, loaded_at TIMESTAMP"


def dec(x):
    return Decimal(str(x))


def usd_of(df, key="deposit_id"):
    return {r[key]: (None if r["amount_usd"] is None else float(r["amount_usd"])) for r in df.collect()}


def test_late_rate_gives_null_then_fills(spark):
    deps = spark.createDataFrame([(1, 10, D1, 1, dec(10), "EUR", T1)], DEPOSITS)
    no_rates = spark.createDataFrame([], RATES)
    f1 = mart.fact(deps, no_rates, "fact_deposit")
    assert usd_of(f1) == {1: None}
    assert quality.not_null_failures(f1, f1.columns, "fact_deposit").count() == 1
    rates = spark.createDataFrame([(D1, "EUR", dec(2), T2)], RATES)
    f2 = mart.fact_increment(f1, deps, rates, "fact_deposit")
    assert usd_of(f2) == {1: 5.0}
    assert f2.first()["loaded_at"] == T2


def test_revised_rate_reprices_only_its_rows(spark):
    deps = spark.createDataFrame(
        [(1, 10, D1, 1, dec(10), "EUR", T1), (2, 10, D2, 1, dec(10), "EUR", T1)], DEPOSITS
    )
    r1 = spark.createDataFrame([(D1, "EUR", dec(2), T1), (D2, "EUR", dec(2), T1)], RATES)
    f1 = mart.fact(deps, r1, "fact_deposit")
    r2 = spark.createDataFrame([(D1, "EUR", dec(4), T3), (D2, "EUR", dec(2), T1)], RATES)
    w = incremental.high_water_mark(f1)
    cand = mart.fact_candidates(deps, r2, w, "deposit_date")
    assert [r["deposit_id"] for r in cand.collect()] == [1]
    f2 = mart.fact_increment(f1, deps, r2, "fact_deposit")
    assert usd_of(f2) == {1: 2.5, 2: 5.0}
    plain = mart.fact_increment_plain(f1, deps, r2, "fact_deposit")
    assert usd_of(plain) == usd_of(f2)


def test_zero_rate_is_null_not_error(spark):
    deps = spark.createDataFrame([(1, 10, D1, 1, dec(10), "RUB", T1)], DEPOSITS)
    rates = spark.createDataFrame([(D1, "RUB", dec(0), T1)], RATES)
    assert usd_of(mart.fact(deps, rates, "fact_deposit")) == {1: None}


def _facts(spark, deps_rows, bet_rows=(), wd_rows=()):
    rates = spark.createDataFrame([(D1, "USD", dec(1), T1), (D2, "USD", dec(1), T1)], RATES)
    return {
        "fact_deposit": mart.fact(spark.createDataFrame(list(deps_rows), DEPOSITS), rates, "fact_deposit"),
        "fact_withdrawal": mart.fact(spark.createDataFrame(list(wd_rows), WITHDRAWALS), rates, "fact_withdrawal"),
        "fact_bet": mart.fact(spark.createDataFrame(list(bet_rows), BETS), rates, "fact_bet"),
    }


def test_null_deposit_with_bet_zero_fills_but_fact_check_fails(spark):
    rates = spark.createDataFrame([(D1, "USD", dec(1), T1)], RATES)  # no EUR rate
    deps = spark.createDataFrame([(1, 10, D1, 1, dec(10), "EUR", T1)], DEPOSITS)
    bets = spark.createDataFrame([(7, 10, D1, dec(3), "USD", 1, 1, T1)], BETS)
    facts = {
        "fact_deposit": mart.fact(deps, rates, "fact_deposit"),
        "fact_withdrawal": mart.fact(spark.createDataFrame([], WITHDRAWALS), rates, "fact_withdrawal"),
        "fact_bet": mart.fact(bets, rates, "fact_bet"),
    }
    pm = mart.player_metrics(facts).first()
    assert float(pm["deposits_amount_usd"]) == 0.0 and float(pm["bets_amount_usd"]) == 3.0
    assert quality.not_null_failures(facts["fact_deposit"], ["amount_usd"], "f").count() == 1


def test_null_date_is_left_out_and_reported(spark):
    facts = _facts(spark, [(1, 10, None, 1, dec(10), "USD", T1), (2, 10, D1, 1, dec(5), "USD", T1)])
    pm = mart.player_metrics(facts)
    assert [r["activity_date"] for r in pm.collect()] == [D1]
    bad = checks.recon_player_metrics(facts, pm).collect()
    assert len(bad) == 1 and bad[0]["activity_date"] is None


def test_day_replaced_only_that_day(spark):
    facts1 = _facts(spark, [(1, 10, D1, 1, dec(10), "USD", T1), (2, 10, D2, 1, dec(5), "USD", T1)])
    pm1 = mart.player_metrics(facts1).checkpoint()
    late = (3, 10, D1, 1, dec(1), "USD", T2)
    facts2 = _facts(spark, [(1, 10, D1, 1, dec(10), "USD", T1), (2, 10, D2, 1, dec(5), "USD", T1), late])
    dates = mart.affected_dates(facts2, incremental.high_water_mark(pm1))
    assert [r[0] for r in dates.collect()] == [D1]
    pm2 = mart.player_metrics_increment(pm1, facts2)
    got = {r["activity_date"]: float(r["deposits_amount_usd"]) for r in pm2.collect()}
    assert got == {D1: 11.0, D2: 5.0}


def test_player_moves_country_restates_all_days(spark):
    facts = _facts(spark, [(1, 10, D1, 1, dec(10), "USD", T1), (2, 10, D2, 1, dec(5), "USD", T1), (3, 11, D1, 1, dec(7), "USD", T1)])
    pm = mart.player_metrics(facts).checkpoint()
    p1 = spark.createDataFrame([(10, D1, "vip", "DE", T1), (11, D1, "vip", "DE", T1)], PLAYERS)
    mo1 = report.metrics_overview(pm, p1).checkpoint()
    p2 = spark.createDataFrame([(10, D1, "vip", "FR", T3), (11, D1, "vip", "DE", T1)], PLAYERS)
    mo2 = report.metrics_overview_increment(mo1, pm, p2)
    got = sorted((r["activity_date"], r["country"], float(r["deposits_amount_usd"])) for r in mo2.collect())
    assert got == [(D1, "DE", 7.0), (D1, "FR", 10.0), (D2, "FR", 5.0)]
    full = sorted((r["activity_date"], r["country"], float(r["deposits_amount_usd"])) for r in report.metrics_overview(pm, p2).collect())
    assert got == full


def test_unknown_player_then_known(spark):
    facts = _facts(spark, [(1, 10, D1, 1, dec(10), "USD", T1)])
    pm = mart.player_metrics(facts).checkpoint()
    none = spark.createDataFrame([], PLAYERS)
    mo1 = report.metrics_overview(pm, none).checkpoint()
    assert mo1.first()["country"] is None
    known = spark.createDataFrame([(10, D1, "vip", "DE", T2)], PLAYERS)
    mo2 = report.metrics_overview_increment(mo1, pm, known)
    assert [(r["country"], r["registration_type"]) for r in mo2.collect()] == [("DE", "vip")]


def test_delete_insert_null_keys_and_batch_duplicates(spark):
    target = spark.createDataFrame([(None, "old-null"), (1, "old-1"), (2, "old-2")], "k BIGINT, v STRING")
    batch = spark.createDataFrame([(None, "new-null"), (1, "new-1a"), (1, "new-1b")], "k BIGINT, v STRING")
    out = sorted((r["k"] if r["k"] is not None else -1, r["v"]) for r in incremental.delete_insert(target, batch, ["k"]).collect())
    assert out == [(-1, "new-null"), (-1, "old-null"), (1, "new-1a"), (1, "new-1b"), (2, "old-2")]


def test_watermark_sentinel_and_strict(spark):
    empty = spark.createDataFrame([], "loaded_at TIMESTAMP")
    assert incremental.high_water_mark(empty) == dt.datetime(1900, 1, 1)
    df = spark.createDataFrame([(T1,), (T2,)], "loaded_at TIMESTAMP")
    assert incremental.newer_than(df, T1).count() == 1


def test_staging_keeps_last_row_of_a_file_on_equal_load_time(spark):
    raw = spark.createDataFrame(
        [("1", "5", "2024-01-01", "1", "10", "usd", T1, 0), ("1", "5", "2024-01-01", "1", "12", " usd ", T1, 1)],
        "id STRING, player_id STRING, deposit_date STRING, provider_id STRING, amount STRING, currency STRING, loaded_at TIMESTAMP, ingest_seq LONG",
    )
    row = staging.stage(raw, "deposits").first()
    assert (row["amount"], row["currency"]) == (Decimal("12.0000"), "USD")


def test_currency_spelling_breaks_composite_uniqueness(spark):
    raw = spark.createDataFrame(
        [("2024-01-01", "usd", "1", T1, 0), ("2024-01-01", "USD", "1", T1, 1)],
        "date STRING, currency STRING, rate_to_usd STRING, loaded_at TIMESTAMP, ingest_seq LONG",
    )
    stg = staging.stage(raw, "currency_rates")
    assert checks.unique(stg, "currency_rates").count() == 1


def test_bad_number_raises(spark):
    raw = spark.createDataFrame(
        [("x", "5", "2024-01-01", "1", "10", "usd", T1, 0)],
        "id STRING, player_id STRING, deposit_date STRING, provider_id STRING, amount STRING, currency STRING, loaded_at TIMESTAMP, ingest_seq LONG",
    )
    import pytest

    with pytest.raises(Exception):
        staging.stage(raw, "deposits").collect()


def test_bad_date_raises(spark):
    raw = spark.createDataFrame(
        [("1", "5", "2024", "1", "10", "usd", T1, 0)],
        "id STRING, player_id STRING, deposit_date STRING, provider_id STRING, amount STRING, currency STRING, loaded_at TIMESTAMP, ingest_seq LONG",
    )
    import pytest

    with pytest.raises(Exception):
        staging.stage(raw, "deposits").collect()


def test_gate_raises_with_sample(spark):
    import pytest

    bad = spark.createDataFrame([(1,)], "x INT")
    with pytest.raises(quality.DataQualityError) as err:
        quality.gate("demo", bad)
    assert err.value.sample == [{"x": 1}]
    quality.gate("ok", bad.limit(0))


def test_incremental_equals_full_on_random_splits(spark):
    """Several batch boundaries over the fixture data: the incremental state equals the full build."""
    from conftest import SF_SMALL
    from ledgerline.sources import fixtures

    raw = fixtures.raw_tables(spark, SF_SMALL)
    full = build.full_build(raw)
    state = None
    for cut in ("1996-06-30", "1999-01-31", "2001-12-16", "2100-01-01"):
        part = {n: df.filter(F.col("loaded_at") < F.lit(cut).cast("timestamp")) for n, df in raw.items()}
        state = build.advance(state, part)
    for name in ("fact_bet", "player_metrics", "metrics_overview", "dim_player", "currency_rates"):
        a = state.table(name)
        b = full.table(name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_unique_key_enforced_before_write(spark, tmp_path):
    import pytest

    from ledgerline.sources.store import TableStore

    store = TableStore(spark, str(tmp_path / "wh"))
    dup = spark.createDataFrame([(1, D1, "vip", "DE", T1), (1, D1, "vip", "FR", T1)], PLAYERS)
    with pytest.raises(quality.DataQualityError):
        store.replace("players", dup)
    assert store.read_model("players") is None
