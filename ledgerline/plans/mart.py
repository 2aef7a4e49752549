"""Data-mart models: SCD1 dimensions, facts converted to USD, daily player metrics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import freshest, to_usd, zero_usd
from ledgerline.operators.incremental import (
    MONTH_PARTITION,
    dates_touched,
    months_of,
    prune_months,
    delete_insert,
    high_water_mark,
    newer_than,
    replace_days,
    restrict_to,
)
from ledgerline.operators.joins import bounded_broadcast, fits
from ledgerline.schemas import LOADED_AT, MODELS, STATE, USD

# Rates are days x currencies; broadcast only while the count is under this bound.
RATES_BROADCAST_ROWS = 5_000_000

# --- dimensions -------------------------------------------------------------

DIMENSIONS = {
    "dim_player": ("players", ["player_id", "registration_date", "registration_type", "country", LOADED_AT]),
    "dim_provider": ("providers_map", ["provider_id", "provider_name", LOADED_AT]),
    "dim_game": ("games_map", ["game_id", "game_name", LOADED_AT]),  # provider_id is dropped
}


def dimension(staged: DataFrame, name: str) -> DataFrame:
    return staged.select(*DIMENSIONS[name][1])


def dimension_increment(target: DataFrame | None, staged: DataFrame, name: str) -> DataFrame:
    batch = dimension(newer_than(staged, high_water_mark(target)), name)
    return batch if target is None else delete_insert(target, batch, MODELS[name].keys)


# --- facts ------------------------------------------------------------------


@dataclass(frozen=True)
class FactSpec:
    name: str
    staging: str
    id_col: str
    op_date: str  # date column in staging
    fact_date: str  # date column in the fact
    columns: tuple[str, ...]  # output order


FACTS = {
    f.name: f
    for f in (
        FactSpec(
            "fact_deposit",
            "deposits",
            "deposit_id",
            "deposit_date",
            "deposit_date",
            ("deposit_id", "player_id", "provider_id", "deposit_date", "currency", "amount", "amount_usd", LOADED_AT),
        ),
        FactSpec(
            "fact_withdrawal",
            "withdrawals",
            "withdrawal_id",
            "withdrawal_date",
            "withdrawal_date",
            (
                "withdrawal_id",
                "player_id",
                "provider_id",
                "withdrawal_date",
                "currency",
                "amount",
                "amount_usd",
                LOADED_AT,
            ),
        ),
        FactSpec(
            "fact_bet",
            "games",
            "bet_id",
            "game_date",
            "bet_date",
            ("bet_id", "player_id", "game_id", "provider_id", "bet_date", "currency", "amount", "amount_usd", LOADED_AT),
        ),
    )
}


def convert_currency(
    ops: DataFrame, rates: DataFrame, date_col: str, amount_col: str = "amount", rates_rows: int | None = None
) -> DataFrame:
    """Left join to the rate *of that day* and currency; a missing or zero rate gives NULL USD.

    Adds ``amount_usd`` and replaces ``loaded_at`` by the later of operation and rate.
    """
    small = rates_rows <= RATES_BROADCAST_ROWS if rates_rows is not None else fits(rates, RATES_BROADCAST_ROWS)
    r = rates.select(
        F.col("rate_date").alias("_rate_date"),
        F.col("currency").alias("_rate_currency"),
        F.col("currency_units_per_usd").alias("_units_per_usd"),
        F.col(LOADED_AT).alias("_rate_loaded_at"),
    )
    r = F.broadcast(r) if small else r
    joined = ops.join(
        r, (ops[date_col] == r["_rate_date"]) & (ops["currency"] == r["_rate_currency"]), "left"
    )
    return joined.withColumn("amount_usd", to_usd(amount_col, "_units_per_usd")).withColumn(
        LOADED_AT, freshest(ops[LOADED_AT], F.col("_rate_loaded_at"))
    ).drop("_rate_date", "_rate_currency", "_units_per_usd", "_rate_loaded_at")


def fact(ops: DataFrame, rates: DataFrame, name: str, rates_rows: int | None = None) -> DataFrame:
    spec = FACTS[name]
    out = convert_currency(ops, rates, spec.op_date, rates_rows=rates_rows)
    if spec.op_date != spec.fact_date:
        out = out.withColumnRenamed(spec.op_date, spec.fact_date)
    return out.select(*spec.columns)


def fact_candidates(
    ops: DataFrame, rates: DataFrame, watermark, date_col: str, rates_rows: int | None = None, narrowed: Callable | None = None
) -> DataFrame:
    """Operations whose fact row would have ``greatest(op.loaded_at, rate.loaded_at) > w``.

    Written as two disjoint parts so that both filters reach the scans:
    new operations, plus older operations whose rate of the day is new. ``narrowed`` applies a row filter
    to ``ops`` below a merge that isn't written yet, so that only the repriced rows are joined with the batch.
    """
    new_ops = newer_than(ops, watermark)
    new_rates = newer_than(rates, watermark).select(
        F.col("rate_date").alias(date_col), F.col("currency")
    )
    months = months_of(new_rates, date_col) if MONTH_PARTITION in ops.columns else None
    new_rates = bounded_broadcast(new_rates.distinct(), RATES_BROADCAST_ROWS, rates_rows)

    def of_new_rates(rows: DataFrame) -> DataFrame:
        old_ops = rows.filter(F.col(LOADED_AT) <= F.lit(watermark).cast("timestamp"))
        if months is not None:
            # stored operations: read only the months whose rates changed
            old_ops = prune_months(old_ops, months)
        return old_ops.join(new_rates, [date_col, "currency"], "left_semi").select(*ops.columns)

    repriced = of_new_rates(ops) if narrowed is None else narrowed(of_new_rates)
    return new_ops.unionByName(repriced)


def fact_increment(target: DataFrame | None, ops: DataFrame, rates: DataFrame, name: str) -> DataFrame:
    spec = FACTS[name]
    if target is None:
        return fact(ops, rates, name)
    batch = fact(fact_candidates(ops, rates, high_water_mark(target), spec.op_date), rates, name)
    return delete_insert(target, batch, [spec.id_col])


def fact_increment_plain(target: DataFrame, ops: DataFrame, rates: DataFrame, name: str) -> DataFrame:
    """Same as ``fact_increment`` with the two-sided filter after the join (reference form)."""
    spec = FACTS[name]
    w = high_water_mark(target)
    batch = newer_than(fact(ops, rates, name), w)
    return delete_insert(target, batch, [spec.id_col])


# --- player_metrics ---------------------------------------------------------

METRICS = ("deposits_amount_usd", "withdrawals_amount_usd", "bets_amount_usd")
FACT_MEASURE = {"fact_deposit": "deposits_amount_usd", "fact_withdrawal": "withdrawals_amount_usd", "fact_bet": "bets_amount_usd"}


def player_operations(facts: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of the three facts with zero-filled measures (facts are never joined to each other)."""
    parts = []
    for name, df in facts.items():
        spec = FACTS[name]
        measures = [
            (F.col("amount_usd") if m == FACT_MEASURE[name] else zero_usd()).alias(m) for m in METRICS
        ]
        parts.append(
            df.select(F.col("player_id"), F.col(spec.fact_date).alias("activity_date"), *measures, F.col(LOADED_AT))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def aggregate_player_day(ops: DataFrame) -> DataFrame:
    """Sums per (player, day); partial aggregation runs before the shuffle."""
    return ops.groupBy("player_id", "activity_date").agg(
        *[F.sum(m).alias(m) for m in METRICS], F.max(LOADED_AT).alias(LOADED_AT)
    )


# --- player_metrics by signed changes ----------------------------------------

# Besides its three sums a stored (player, day) keeps, for each fact, how many rows it has and how many of them have an
# amount: by these a sum knows when it is NULL (no row has an amount, as SUM over the union of the facts gives it) and a
# (player, day) knows when its last row has gone. Sums and counts can be taken back, so a batch needs no other rows.


def _rows(name: str) -> str:
    return f"{STATE}{name}_rows"


def _valued(name: str) -> str:
    return f"{STATE}{name}_valued"


def counted(name: str) -> tuple[str, str]:
    return _rows(name), _valued(name)


COUNTERS = tuple(c for name in FACTS for c in counted(name))


def signed(name: str, rows: DataFrame, sign: int) -> DataFrame:
    """Rows of a fact as changes: +1 for those that came, -1 for those that went."""
    return rows.select(
        F.lit(name).alias("fact"), "player_id", F.col(FACTS[name].fact_date).alias("activity_date"),
        F.col("amount_usd").cast(USD).alias("amount_usd"), F.col(LOADED_AT), F.lit(sign).alias("sign"),
    )


def feed_of(name: str):
    """What a merge of a fact writes into its change feed: replaced rows taken back, batch rows added."""
    return lambda replaced, batch: signed(name, replaced, -1).unionByName(signed(name, batch, 1))


def _shown(sums: dict[str, Column]) -> list[Column]:
    """The three measures: a sum is NULL when neither an amount of its own fact nor a row of another fact is there."""
    out = []
    for name, measure in FACT_MEASURE.items():
        present = reduce(lambda a, b: a + b, [F.col(_valued(n) if n == name else _rows(n)) for n in FACTS])
        out.append(F.when(present > 0, sums[measure]).cast(T.DecimalType(38, 6)).alias(measure))
    return out


def aggregate_changes(changes: DataFrame) -> DataFrame:
    """Net sums and counts per (player, day); ``came`` is the newest load time of an added row, and ``recheck`` tells
    that rows of a fact went and none newer than these came, so the newest load time left is unknown."""
    aggregates, gone = [], F.lit(False)
    for name, measure in FACT_MEASURE.items():
        own = F.col("fact") == name
        one = F.when(own, F.col("sign")).otherwise(0)
        value = F.when(own, F.when(F.col("sign") > 0, F.col("amount_usd")).otherwise(-F.col("amount_usd")))
        aggregates += [
            F.coalesce(F.sum(value), F.lit(0)).cast(T.DecimalType(38, 6)).alias(measure), F.sum(one).alias(_rows(name)),
            F.sum(F.when(F.col("amount_usd").isNotNull(), one).otherwise(0)).alias(_valued(name)),
        ]
        went, new = (F.max(F.when(own & (F.col("sign") == s), F.col(LOADED_AT))) for s in (-1, 1))
        gone = gone | (went.isNotNull() & F.coalesce(went >= new, F.lit(True)))
    came = F.max(F.when(F.col("sign") > 0, F.col(LOADED_AT))).alias("came")
    dated = changes.filter(F.col("activity_date").isNotNull())
    return dated.groupBy("player_id", "activity_date").agg(*aggregates, came, gone.alias("recheck"))


def player_metrics_state(facts: dict[str, DataFrame]) -> DataFrame:
    """Full build with counters; its visible columns are those of ``player_metrics``."""
    parts = [signed(name, df, 1) for name, df in facts.items()]
    net = aggregate_changes(reduce(DataFrame.unionByName, parts))
    shown = _shown({m: F.col(m) for m in METRICS})
    return net.select("player_id", "activity_date", *shown, F.col("came").alias(LOADED_AT), *COUNTERS)


def apply_changes(stored: DataFrame, net: DataFrame) -> DataFrame:
    """``stored`` (player, day) rows with ``net`` changes added: state columns and ``recheck``. Rows whose last operation
    has gone are left out."""
    s = stored.select(*[F.col(c).alias(f"_s_{c}") for c in ("player_id", "activity_date", *METRICS, LOADED_AT, *COUNTERS)])
    on = F.col("player_id").eqNullSafe(F.col("_s_player_id")) & (F.col("activity_date") == F.col("_s_activity_date"))
    j = s.join(net, on, "full_outer")
    zero = F.lit(0).cast(T.DecimalType(38, 6))
    sums = {m: F.coalesce(f"_s_{m}", zero) + F.coalesce(m, zero) for m in METRICS}
    key = F.col("_s_activity_date").isNotNull()
    j = j.select(
        F.when(key, F.col("_s_player_id")).otherwise(F.col("player_id")).alias("player_id"),
        F.coalesce("_s_activity_date", "activity_date").alias("activity_date"),
        *[x.alias(f"_sum_{m}") for m, x in sums.items()],
        F.greatest(f"_s_{LOADED_AT}", "came").alias(LOADED_AT),
        *[(F.coalesce(f"_s_{c}", F.lit(0)) + F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in COUNTERS],
        F.coalesce("recheck", F.lit(False)).alias("recheck"),
    )
    left = reduce(lambda a, b: a + b, [F.col(_rows(n)) for n in FACTS])
    shown = _shown({m: F.col(f"_sum_{m}") for m in METRICS})
    return j.filter(left > 0).select("player_id", "activity_date", *shown, LOADED_AT, *COUNTERS, "recheck")


def reloaded_at(state: DataFrame, facts: dict[str, DataFrame]) -> DataFrame:
    """``state`` with the load time of its ``recheck`` rows taken from the facts (restricted by the caller to their days)."""
    doubtful = state.filter("recheck").select(F.col("player_id").alias("_p"), F.col("activity_date").alias("_d"))
    on = F.col("player_id").eqNullSafe(F.col("_p")) & (F.col("activity_date") == F.col("_d"))
    found = player_operations(facts).join(doubtful, on, "left_semi")
    newest = found.groupBy(F.col("player_id").alias("_p"), F.col("activity_date").alias("_d")).agg(F.max(LOADED_AT).alias("_newest"))
    fixed = F.when(F.col("recheck"), F.col("_newest")).otherwise(F.col(LOADED_AT))
    return state.join(newest, on, "left").withColumn(LOADED_AT, fixed).select(*state.columns)


def player_metrics(facts: dict[str, DataFrame]) -> DataFrame:
    """Full build. Facts without a date never join an affected date, so they are left out."""
    ops = player_operations(facts).filter(F.col("activity_date").isNotNull())
    return aggregate_player_day(ops)


def affected_dates(facts: dict[str, DataFrame], watermark) -> DataFrame:
    """Dates of fact rows newer than the watermark (UNION of the three facts)."""
    return dates_touched({FACTS[n].fact_date: df for n, df in facts.items()}, watermark, "activity_date")


def player_metrics_increment(target: DataFrame | None, facts: dict[str, DataFrame]) -> DataFrame:
    if target is None:
        return player_metrics(facts)
    dates = affected_dates(facts, high_water_mark(target))
    # restrict each fact before the union so every scan gets its own semi join
    touched = {n: restrict_to(df, FACTS[n].fact_date, dates, "activity_date") for n, df in facts.items()}
    return replace_days(target, aggregate_player_day(player_operations(touched)), "activity_date")
