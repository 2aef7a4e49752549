"""Versioned keyed tables: crashes, readers, two writers, change feeds, player metrics by signed changes, bounded gates."""

import contextlib
import datetime as dt
import io
import random
import shutil
from decimal import Decimal

import pytest
from ledgerline.operators import quality
from ledgerline.plans import build, job, ledger, mart
from ledgerline.sources.manifest import ConcurrentWrite, Manifests
from ledgerline.sources.store import TableStore
from pyspark.sql import functions as F

T1, T2, T3 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 9)
DEPOSIT = "deposit_id BIGINT, player_id BIGINT, provider_id BIGINT, deposit_date DATE, currency STRING, amount DECIMAL(20,4), amount_usd DECIMAL(28,6), loaded_at TIMESTAMP"
WITHDRAWAL = DEPOSIT.replace("deposit", "withdrawal")
BET = "bet_id BIGINT, player_id BIGINT, game_id BIGINT, provider_id BIGINT, bet_date DATE, currency STRING, amount DECIMAL(20,4), amount_usd DECIMAL(28,6), loaded_at TIMESTAMP"


def day(n):
    return dt.date(2024, 1 + n // 28, 1 + n % 28)


def deposit(key, player, when, usd, at):
    usd = None if usd is None else Decimal(usd)
    return (key, player, 1, day(when), "USD", usd, usd, at)


def bet(key, player, when, usd, at):
    usd = None if usd is None else Decimal(usd)
    return (key, player, 1, 1, day(when), "USD", usd, usd, at)


def deposits(spark, rows):
    return spark.createDataFrame(rows, DEPOSIT)


def seen(df, key="deposit_id"):
    return sorted((r[key], float(r["amount"])) for r in df.collect())


OLD = [deposit(1, 1, 0, 10, T1), deposit(2, 1, 30, 20, T1), deposit(3, 2, 60, 30, T1)]
NEW = [deposit(2, 1, 30, 25, T2), deposit(4, 2, 1, 40, T2)]


@pytest.fixture
def stored(spark, tmp_path):
    root = str(tmp_path / "wh")
    TableStore(spark, root).replace("fact_deposit", deposits(spark, OLD))
    return root


def merge(spark, root, rows=NEW, run=None):
    store = TableStore(spark, root, run)
    batch = store.scratch("b", deposits(spark, rows))
    return store.merge_keys("fact_deposit", store.read_model("fact_deposit"), batch, ["deposit_id"], mart.feed_of("fact_deposit"))


AFTER = [(1, 10.0), (2, 25.0), (3, 30.0), (4, 40.0)]


def test_merge_writes_only_touched_partitions_and_keeps_the_old_files(spark, stored):
    store = TableStore(spark, stored)
    before = store.manifest("data_mart.fact_deposit").live()
    table = merge(spark, stored)
    after = TableStore(spark, stored).manifest("data_mart.fact_deposit").live()
    assert seen(table.df) == AFTER and table.rows == 4
    assert before["_month=202403"] == after["_month=202403"]  # untouched
    assert all(before[p] != after[p] for p in ("_month=202401", "_month=202402"))


@pytest.mark.parametrize("step", ["data", "ledger", "check", "publish"])
def test_crash_at_any_step_leaves_the_old_table(spark, stored, monkeypatch, step):
    def die(*_, **__):
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        if step == "data":
            m.setattr(TableStore, "_write", die)
        if step == "ledger":
            m.setattr(ledger, "totals", die)
        if step == "check":
            m.setattr(Manifests, "check_token", die)
        if step == "publish":
            m.setattr(Manifests, "publish", die)
        with pytest.raises(RuntimeError):
            merge(spark, stored)
    old = TableStore(spark, stored).read_model("fact_deposit")
    assert seen(old.df) == seen(deposits(spark, OLD)) and old.rows == 3
    assert TableStore(spark, stored).changes_since("fact_deposit", old.version).count() == 0
    assert seen(merge(spark, stored).df) == AFTER  # the rerun


def test_a_manifest_that_ends_early_is_void(spark, stored):
    manifests = Manifests(spark, stored)
    manifests.files.create(f"{stored}/_commits/data_mart.fact_deposit/{2:012d}.json", '{"version": 2, "ru')
    assert manifests.latest("data_mart.fact_deposit").version == 1
    table = merge(spark, stored)
    assert seen(table.df) == AFTER and table.version == 3


def test_reader_keeps_its_version_during_a_merge(spark, stored):
    reader = TableStore(spark, stored).read_model("fact_deposit").df
    merge(spark, stored)
    assert seen(reader) == seen(deposits(spark, OLD))
    assert seen(TableStore(spark, stored).read_model("fact_deposit").df) == AFTER


def test_of_two_writers_one_is_refused_and_nothing_is_mixed(spark, stored):
    late = TableStore(spark, stored)
    old = late.read_model("fact_deposit")  # both start from version 1
    batch = late.scratch("late", deposits(spark, [deposit(1, 1, 0, 99, T2)]))
    merge(spark, stored)
    with pytest.raises(ConcurrentWrite):
        late.merge_keys("fact_deposit", old, batch, ["deposit_id"])
    assert seen(TableStore(spark, stored).read_model("fact_deposit").df) == AFTER


def test_a_newer_run_fences_off_an_older_one(spark, stored):
    older, newer = TableStore(spark, stored), TableStore(spark, stored)
    older.begin_run()
    newer.begin_run()
    batch = older.scratch("b", deposits(spark, NEW))
    with pytest.raises(ConcurrentWrite):
        older.merge_keys("fact_deposit", older.read_model("fact_deposit"), batch, ["deposit_id"])
    newer.merge_keys("fact_deposit", newer.read_model("fact_deposit"), batch, ["deposit_id"])
    assert seen(TableStore(spark, stored).read_model("fact_deposit").df) == AFTER


def test_vacuum_deletes_only_what_no_manifest_names(spark, stored, monkeypatch):
    merge(spark, stored)
    monkeypatch.setattr("ledgerline.sources.manifest.KEEP", 1)
    merge(spark, stored, [deposit(2, 1, 30, 26, T3)])
    gone = TableStore(spark, stored).vacuum()
    assert len(gone) == 0 or all("_commit=" in x for x in gone)
    table = TableStore(spark, stored).read_model("fact_deposit")
    assert seen(table.df) == [(1, 10.0), (2, 26.0), (3, 30.0), (4, 40.0)]
    assert TableStore(spark, stored).changes_since("fact_deposit", 1).count() == 5


def test_null_partition_is_replaced_like_any_other(spark, stored):
    undated = (7, 1, 1, None, "USD", Decimal(1), Decimal(1), T2)
    merge(spark, stored, [undated])
    table = merge(spark, stored, [undated[:5] + (Decimal(2), Decimal(2), T3)])
    assert seen(table.df)[-1] == (7, 2.0) and table.rows == 4


# --- signed changes -------------------------------------------------------------------


def _random_facts(rng, n, at):
    rows = {"fact_deposit": {}, "fact_withdrawal": {}, "fact_bet": {}}
    for name, own in rows.items():
        for key in range(n):
            own[key] = _random_row(rng, name, key, at)
    return rows


def _random_row(rng, name, key, at):
    make = bet if name == "fact_bet" else deposit
    return make(key, rng.choice([1, 2, 3, None]), rng.randrange(40), rng.choice([None, 1, 2, 50]), at)


def _frames(spark, rows):
    kinds = {"fact_deposit": DEPOSIT, "fact_withdrawal": WITHDRAWAL, "fact_bet": BET}
    return {n: spark.createDataFrame(list(own.values()), kinds[n]) for n, own in rows.items()}


def _same(a, b):
    a, b = a.select(*sorted(b.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("stored_form", [False, True])
def test_signed_changes_equal_the_full_build(spark, tmp_path, stored_form):
    """Random batches: new operations, amounts that come and go, players changed, so that days and players lose all rows."""
    rng = random.Random(11)
    store = TableStore(spark, str(tmp_path / "wh")) if stored_form else build.CheckpointWriter()
    rows = _random_facts(rng, 12, T1)
    facts = {n: store.replace(n, df) for n, df in _frames(spark, rows).items()}
    pm = build._advance_player_metrics(None, facts, store)
    for step in range(3):
        at = T2 + dt.timedelta(days=step)
        for _ in range(1 + step % 2):  # the second time, player metrics lag two commits behind
            for name, own in rows.items():
                batch = {k: _random_row(rng, name, k, at) for k in rng.sample(range(16), 5)}
                for k in batch:  # the business date of an operation doesn't change
                    if k in own:
                        date = 4 if name == "fact_bet" else 3
                        batch[k] = batch[k][:date] + (own[k][date],) + batch[k][date + 1 :]
                own |= batch
                frame = _frames(spark, {name: batch})[name]
                key = mart.FACTS[name].id_col
                facts[name] = store.merge_keys(name, facts[name], store.scratch(f"{name}__b", frame), [key], mart.feed_of(name))
            at += dt.timedelta(hours=1)
        pm = build._advance_player_metrics(pm, facts, store)
        assert _same(pm.df, mart.player_metrics(_frames(spark, rows))), step
        assert pm.rows >= pm.df.count()
    assert build._advance_player_metrics(pm, facts, store) is pm


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_increment_reads_only_stored_days_and_feeds(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    facts = {n: store.replace(n, df) for n, df in _frames(spark, _random_facts(random.Random(1), 9, T1)).items()}
    build._advance_player_metrics(None, facts, store)
    batch = store.scratch("b", deposits(spark, [deposit(100, 1, 3, 5, T2)]))
    facts["fact_deposit"] = store.merge_keys("fact_deposit", facts["fact_deposit"], batch, ["deposit_id"], mart.feed_of("fact_deposit"))
    feed = store.changes("fact_deposit", facts["fact_deposit"], 1)
    assert [(r["player_id"], r["sign"]) for r in feed.collect()] == [(1, 1)]
    p = plan(mart.aggregate_changes(feed))
    assert "_changes" in p and "fact_deposit/_commit" in p


# --- gates ----------------------------------------------------------------------------


@pytest.fixture
def warehouse(two_runs, tmp_path):
    shutil.copytree(two_runs[0], tmp_path / "copy")
    return str(tmp_path / "copy")


def _gates(spark, root, whole=False):
    store = TableStore(spark, root)
    state = {n: t for n, t in job.stored_state(store).tables.items()}
    return store, state, job.Gates(store, dict(state), whole)


def test_gates_pass_again_without_reading_a_row(spark, warehouse, monkeypatch):
    store, state, gates = _gates(spark, warehouse)
    for name in state:
        assert store.unchecked_parts(f"columns:{name}", name) == []

    def never(*_, **__):
        raise AssertionError("rows were read")

    for reader in ("recon_fact", "recon_player_metrics", "not_null", "unique"):
        monkeypatch.setattr(job.checks, reader, never)
    for name, table in state.items():
        gates(name, table)


def test_whole_gates_agree(spark, warehouse):
    _, state, gates = _gates(spark, warehouse, whole=True)
    for name, table in state.items():
        gates(name, table)


def test_ledgers_equal_totals_of_the_rows(spark, warehouse):
    store = TableStore(spark, warehouse)
    for name in ledger.LEDGERS:
        rows = ledger.totals(store.read_model(name).df, name)
        columns = [c for c in rows.columns if c != ledger.CONTENT]
        kept = store.read_ledger(name).groupBy(*[c for c in columns if c not in ("row_count", *ledger.LEDGERS[name].sums)]).agg(
            F.sum("row_count").alias("row_count"), *[F.sum(c).alias(c) for c in ledger.LEDGERS[name].sums]
        )
        assert _same(kept.select(*[F.col(c).cast("string") for c in columns]), rows.select(*[F.col(c).cast("string") for c in columns])), name


def test_gates_read_only_changed_days_and_find_what_is_wrong(spark, warehouse):
    store, state, gates = _gates(spark, warehouse)
    fact = state["fact_deposit"]
    row = fact.df.orderBy("deposit_id").first()
    same_total = fact.df.filter(F.col("deposit_id") == row["deposit_id"])
    wrong = same_total.withColumn("amount_usd", (F.col("amount_usd") + 1).cast("decimal(28,6)")).drop("_month")
    batch = store.scratch("wrong", wrong)
    state["fact_deposit"] = store.merge_keys("fact_deposit", fact, batch, ["deposit_id"])
    days = store.unchecked_days("totals:fact_deposit", "fact_deposit")
    assert [r[0] for r in days.collect()] == [row["deposit_date"]]
    frames = [state[t].df for t in ("deposits", "currency_rates", "fact_deposit")]
    months = [int(row["deposit_date"].strftime("%Y%m"))]
    p = plan(job.checks.fact_gate(*frames, "fact_deposit", days, months))
    scans = [x for x in p.splitlines() if "PartitionFilters" in x]
    assert sum(str(months[0]) in x for x in scans) >= 3  # staging, rates and fact
    with pytest.raises(quality.DataQualityError, match="totals:fact_deposit"):
        gates("fact_deposit", state["fact_deposit"])


def test_a_lost_change_shows_in_the_ledgers(spark, warehouse):
    """player_metrics that missed a commit of a fact: found without reading the rows of either."""
    store, state, gates = _gates(spark, warehouse)
    day_lost = state["player_metrics"].df.orderBy("activity_date").first()["activity_date"]
    kept = store.read_model("player_metrics").state.filter(F.col("activity_date") == F.lit(day_lost))
    fresh = store.scratch("lost", kept.withColumn("bets_amount_usd", (F.col("bets_amount_usd") + 1).cast("decimal(38,6)")))
    state["player_metrics"] = store.merge_days("player_metrics", store.read_model("player_metrics"), fresh, "activity_date")
    with pytest.raises(quality.DataQualityError, match="player_metrics"):
        gates("player_metrics", state["player_metrics"])


# --- unique keys over partitions --------------------------------------------------------


def test_key_filter_misses_no_key_and_hits_few_others(spark):
    from ledgerline.operators import key_filter

    rows = spark.range(40_000).select((F.col("id") * 3).alias("k"), F.pmod("id", F.lit(4)).cast("int").alias("p"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1)], "k long, p int"))
    filters = key_filter.build(rows, "p", "k")
    assert all(len(r["bits"]) == key_filter.BLOCK // 8 for r in filters.collect())
    hits = key_filter.probe(spark.range(120_000).select(F.col("id").alias("key")), filters, "p")
    right = F.pmod("key", F.lit(3)) == 0
    assert hits.filter(right & (F.pmod(F.col("key") / 3, F.lit(4)) == F.col("p"))).count() == 40_000
    assert hits.count() - 40_000 < 440_000 * 1e-4


def test_key_that_returns_in_another_month_is_found(spark, stored, monkeypatch):
    merge(spark, stored, [deposit(1, 1, 31, 11, T2)])  # key 1 lives in January; its business date has moved to February
    store = TableStore(spark, stored)
    read = []
    whole = TableStore._read_partitions
    monkeypatch.setattr(TableStore, "_read_partitions", lambda self, name, parts: read.append(list(parts)) or whole(self, name, parts))
    found = store.doubled_keys("fact_deposit", ["_month=202402"]).collect()
    assert [(r["deposit_id"], r["n_rows"]) for r in found] == [(1, 2)]
    assert read == [["_month=202402"], ["_month=202401"]]  # March is not read


def test_gate_finds_a_key_that_returns(spark, warehouse):
    store, state, gates = _gates(spark, warehouse)
    deposits = state["deposits"]
    row = deposits.df.orderBy("deposit_id").first()
    moved = deposits.df.filter(F.col("deposit_id") == row["deposit_id"]).drop("_month")
    moved = moved.withColumn("deposit_date", F.add_months("deposit_date", 1))
    state["deposits"] = store.merge_keys("deposits", deposits, store.scratch("moved", moved), ["deposit_id"])
    with pytest.raises(quality.DataQualityError, match="unique:deposits"):
        gates("deposits", state["deposits"])
