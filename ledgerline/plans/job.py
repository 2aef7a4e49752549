"""The pipeline job: load raw snapshots, then build every model in dependency order with gates.

Order and gates follow the source system's job: each raw table is loaded, each model is
written and immediately checked (not-null on every column, unique keys, layer-to-layer
totals); a failing check raises ``DataQualityError`` before anything that reads the model is
built. Scheduling, retries and calendars are left to the cluster's scheduler: the job is one
driver function, safe to rerun (see ``sources.store``).
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import changes, quality
from ledgerline.operators.incremental import months_of, prune_days
from ledgerline.operators.versions import latest_version
from ledgerline.plans import build, checks, mart, report
from ledgerline.schemas import MODELS, RAW_TABLES
from ledgerline.session import ensure_session
from ledgerline.sources.csv_snapshot import read_source
from ledgerline.sources.store import SPREAD_KEYS, LoadOrderError, TableStore


def load_table(
    store: TableStore, table: str, source: str | list[str], batch_ts: dt.datetime, lookback_days: int | None = None
) -> dict:
    """Change capture of one CSV snapshot (a file, a folder or a list of files) into the raw log: new or changed
    versions only. Nothing is appended when a business date lies after the load time: the log cannot be repaired, and
    such a date would move the look-back window of all later loads. The source is parsed once: its rows inside the
    window are written to the run's work folder, and counted on the way; the window comes from the log's manifest.
    ``lookback_days`` replaces the table's own look-back in this load."""
    cfg = RAW_TABLES[table]
    src = read_source(store.spark, source, cfg.columns)
    newest = store.newest_date(table) if cfg.date_column else None
    days = cfg.lookback_days if lookback_days is None else lookback_days
    cutoff = newest - dt.timedelta(days=days) if newest is not None else None
    seen = Observation()
    dates = F.max(F.to_date(cfg.date_column, "yyyy-MM-dd")) if cfg.date_column else F.lit(None).cast("date")
    processed = changes.within_lookback(src, cfg.date_column, cutoff)
    processed = processed.observe(seen, F.count(F.lit(1)).alias("rows"), dates.alias("newest"))
    processed = store.scratch(f"{table}__snapshot", processed).df
    last = seen.get.get("newest")
    if last is not None and last > batch_ts.date():
        raise LoadOrderError(f"raw.{table}: business date {last} is after the load time {batch_ts}")
    stored = store.read_raw(table, from_date=cutoff)
    latest = changes.latest_stored(stored, cfg.keys, cfg.date_column, cutoff)
    inserted = changes.new_or_changed(processed, latest, cfg.keys, cfg.columns)
    written = store.append_versions(table, inserted, batch_ts)
    return {"table_name": table, "processed_rows": int(seen.get.get("rows") or 0), "inserted_rows": written}


def load_all(
    store: TableStore, source_dir: str, batch_ts: dt.datetime, lookback_days: dict[str, int] | int | None = None
) -> list[dict]:
    """The seven loads, side by side. A table that fails doesn't keep the others from loading; then the first failure is
    raised, and a rerun at the same time finds the loaded ones unchanged."""

    def one(table: str) -> dict:
        days = lookback_days.get(table) if isinstance(lookback_days, dict) else lookback_days
        # a snapshot that was not delivered fails the run, as a path that cannot be read
        return load_table(store, table, f"{source_dir.rstrip('/')}/{table}.csv", batch_ts, days)

    with ThreadPoolExecutor(max_workers=build.BUILD_THREADS) as pool:
        loads = {table: pool.submit(one, table) for table in RAW_TABLES}
    failed = [f.exception() for f in loads.values() if f.exception() is not None]
    if failed:
        raise failed[0]
    return [f.result() for f in loads.values()]


class Gates:
    """Checks run right after each model is written (the source job's test steps).

    A gate reads what changed since it last passed: not-null and unique checks the partitions written since then (and for
    keys that could return elsewhere the partitions whose key filter they hit), layer-to-layer totals the ledgers of the whole history and the rows of the days whose ledger changed. ``whole``
    checks every row of every table instead."""

    def __init__(self, store: TableStore, state: dict[str, build.Table], whole: bool = False):
        self.store, self.state, self.whole = store, state, whole

    def __call__(self, name: str, table: build.Table) -> None:
        self.state[name] = table
        self._columns(name)
        if name in mart.FACTS:
            self._fact_totals(name)
        if name == "player_metrics":
            self._player_metrics_totals()
        if name == "metrics_overview":
            self._overview_totals()

    def _columns(self, name: str) -> None:
        check = f"columns:{name}"
        parts = None if self.whole else self.store.unchecked_parts(check, name)
        if parts == []:
            return
        rows = self.store.read_parts(name, parts)
        quality.gate(f"not_null:{name}", checks.not_null(rows, name))
        if name == "metrics_overview":  # the view's columns are sums and keys of these rows
            quality.gate("not_null:monthly_summary", checks.not_null(report.monthly_summary(rows), "monthly_summary"))
        if name in checks.UNIQUE_KEYS:
            # a key whose partition follows from it can only be doubled inside a partition
            spread = parts is not None and name in SPREAD_KEYS
            quality.gate(f"unique:{name}", self.store.doubled_keys(name, parts) if spread else checks.unique(rows, name))
        self.store.mark_passed(check, [name])

    def _days(self, check: str, names: list[str]) -> tuple[DataFrame | None, list | None]:
        """The dates of any of the tables that changed since the check last passed, and their months."""
        found = [None if self.whole else self.store.unchecked_days(check, n) for n in names]
        if any(f is None for f in found):
            return None, None
        days = reduce(DataFrame.unionByName, found).distinct()
        days = self.store.scratch(f"days-{check.replace(':', '-')}", days)
        return days.df, months_of(days.df, "activity_date")

    def _fact_totals(self, name: str) -> None:
        spec, check = mart.FACTS[name], f"totals:{name}"
        tables = [spec.staging, "currency_rates", name]
        days, months = self._days(check, tables)
        quality.gate(f"ledger:{name}", checks.fact_ledger_gate(self.store.read_ledger(spec.staging), self.store.read_ledger(name), name))
        if months != []:
            ops, rates, fact = (self.state[t].df for t in tables)
            quality.gate(check, checks.fact_gate(ops, rates, fact, name, days, months))
        self.store.mark_passed(check, tables)

    def _player_metrics_totals(self) -> None:
        name, check = "player_metrics", "totals:player_metrics"
        tables = [*mart.FACTS, name]
        days, months = self._days(check, tables)
        ledgers = {n: self.store.read_ledger(n) for n in tables}
        quality.gate("ledger:player_metrics", checks.player_metrics_ledger_gate({n: ledgers[n] for n in mart.FACTS}, ledgers[name]))
        if months != []:
            pm = self.state[name].df
            if days is not None:
                pm = prune_days(pm, "activity_date", days, days.count())
            facts = {n: self.state[n].df for n in mart.FACTS}
            quality.gate(check, checks.player_metrics_gate(facts, pm, days, months))
        self.store.mark_passed(check, tables)

    def _overview_totals(self) -> None:
        """Both ledgers hold every day's exact sums, so no row is read."""
        names = ["player_metrics", "metrics_overview"]
        pm, mo = (self.store.read_ledger(n) for n in names)
        quality.gate("totals:metrics_overview", checks.recon_metrics_overview(pm, mo))


def stored_state(store: TableStore) -> build.Warehouse | None:
    tables = {name: store.read_model(name) for name in MODELS}
    present = {k: v for k, v in tables.items() if v is not None}
    if not present:
        return None
    return build.Warehouse(staging={}, dims={}, facts={}, player_metrics=None, metrics_overview=None, tables=present)


def run_pipeline(
    spark: SparkSession,
    root: str,
    source_dir: str,
    batch_ts: dt.datetime,
    gates: bool | str = True,
    lookback_days: dict[str, int] | int | None = None,
    round_numbers: bool = False,
) -> tuple[build.Warehouse, list[dict]]:
    """One run: raw loads for the seven sources, then all models; returns the state and load counts. ``gates="whole"``
    checks whole tables instead of what changed. ``lookback_days`` (a number, or one for some tables) replaces the
    configured look-back in this run. A number that its model's type can't hold exactly stops the run before any model is
    built, unless ``round_numbers``. A run that began earlier can commit nothing from now on."""
    ensure_session(spark)
    store = TableStore(spark, root)
    store.begin_run()
    loads = load_all(store, source_dir, batch_ts, lookback_days)
    prev = stored_state(store)
    raw = {}
    for t in build.STAGING_TABLES:
        since = prev.tables[t].watermark if prev is not None and t in prev.tables else None
        df = store.read_raw(t, since=since)
        if df is None:
            raise LoadOrderError(f"raw.{t} has never been loaded")
        raw[t] = df
    if not round_numbers:
        for t in checks.NUMBERS:  # of the versions that are staged next, as staging takes the newest
            quality.gate(f"exact_numbers:{t}", checks.lossy(latest_version(raw[t], RAW_TABLES[t].keys), t))
    state: dict[str, build.Table] = dict(prev.tables) if prev is not None else {}
    after = Gates(store, state, whole=gates == "whole") if gates else None
    result = build.advance(prev, raw, writer=store, after=after)
    result.metrics_overview.createOrReplaceTempView("monthly_summary_source")
    result.monthly_summary.createOrReplaceTempView("monthly_summary")
    return result, loads


def load_counts_frame(spark: SparkSession, loads: list[dict]) -> DataFrame:
    return spark.createDataFrame(loads, "table_name STRING, processed_rows LONG, inserted_rows LONG")
