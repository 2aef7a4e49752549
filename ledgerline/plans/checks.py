"""The warehouse's data-quality gates, composed from ``operators.quality``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import loses_digits, to_usd
from ledgerline.operators import quality
from ledgerline.operators.incremental import prune_months
from ledgerline.operators.joins import bounded_broadcast
from ledgerline.plans.mart import FACT_MEASURE, FACTS, METRICS, RATES_BROADCAST_ROWS, aggregate_player_day, player_operations
from ledgerline.schemas import AMOUNT, RATE, RAW_TABLES

# Every model column is declared NOT NULL; these keys are declared unique (single column),
# plus composite grains we also check.
UNIQUE_KEYS = {
    "players": ("player_id",),
    "providers_map": ("provider_id",),
    "games_map": ("game_id",),
    "deposits": ("deposit_id",),
    "withdrawals": ("withdrawal_id",),
    "games": ("bet_id",),
    "dim_player": ("player_id",),
    "dim_provider": ("provider_id",),
    "dim_game": ("game_id",),
    "fact_deposit": ("deposit_id",),
    "fact_withdrawal": ("withdrawal_id",),
    "fact_bet": ("bet_id",),
    # composite grains
    "currency_rates": ("rate_date", "currency"),
    "player_metrics": ("player_id", "activity_date"),
    "metrics_overview": ("activity_date", "country", "registration_type"),
}

# Raw columns typed as NUMERIC.
NUMBERS = {
    "currency_rates": ("rate_to_usd", RATE),
    "deposits": ("amount", AMOUNT),
    "withdrawals": ("amount", AMOUNT),
    "games": ("amount", AMOUNT),
}


def lossy(raw: DataFrame, table: str) -> DataFrame:
    """Raw versions whose number is rounded by the cast of its staging model; one scan, no shuffle."""
    column, kind = NUMBERS[table]
    key = F.concat_ws("|", *RAW_TABLES[table].keys)
    return raw.filter(loses_digits(column, kind)).select(
        F.lit(table).alias("table_name"), key.alias("key"), F.lit(column).alias("column_name"), F.col(column).alias("raw_value")
    )


def not_null(df: DataFrame, table: str) -> DataFrame:
    return quality.not_null_failures(df, df.columns, table)


def unique(df: DataFrame, table: str) -> DataFrame:
    return quality.duplicates(df, UNIQUE_KEYS[table])


def fact_totals_expected(ops: DataFrame, rates: DataFrame, op_date: str) -> DataFrame:
    """Count, amount and USD amount per (day, currency), computed from staging and rates."""
    r = bounded_broadcast(
        rates.select(
            F.col("rate_date").alias("_d"), F.col("currency").alias("_c"), F.col("currency_units_per_usd").alias("_u")
        ),
        RATES_BROADCAST_ROWS,
    )
    j = ops.join(r, (ops[op_date] == F.col("_d")) & (ops["currency"] == F.col("_c")), "left")
    return j.groupBy(F.col(op_date).alias("activity_date"), ops["currency"]).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("amount").alias("amount"),
        F.sum(to_usd("amount", "_u")).alias("amount_usd"),
    )


def fact_totals_actual(fact: DataFrame, fact_date: str) -> DataFrame:
    return fact.groupBy(F.col(fact_date).alias("activity_date"), "currency").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("amount"), F.sum("amount_usd").alias("amount_usd")
    )


def recon_fact(ops: DataFrame, rates: DataFrame, fact: DataFrame, name: str) -> DataFrame:
    spec = FACTS[name]
    return quality.reconcile(
        fact_totals_expected(ops, rates, spec.op_date),
        fact_totals_actual(fact, spec.fact_date),
        ["activity_date", "currency"],
        ["row_count", "amount", "amount_usd"],
    )


def recon_player_metrics(facts: dict[str, DataFrame], pm: DataFrame) -> DataFrame:
    """Row-level: player_metrics against a recomputation from all fact rows (NULL dates included)."""
    expected = aggregate_player_day(player_operations(facts)).drop("loaded_at")
    return quality.reconcile(expected, pm, ["player_id", "activity_date"], list(METRICS))


# --- gates bounded by the batch -------------------------------------------------------------
#
# ``days`` holds the dates (nulls included) whose rows changed since the gate last passed; None means every date. Months
# are literals, so that only their directories are read; the semi join leaves just the days.


def on_days(df: DataFrame, date_col: str, days: DataFrame | None, months: list | None) -> DataFrame:
    """The rows of ``df`` on one of ``days``, null matching null."""
    if days is None:
        return df
    pruned = prune_months(df, months)
    wanted = F.broadcast(days.select(F.col("activity_date").alias("_wanted")))
    return pruned.join(wanted, F.col(date_col).eqNullSafe(F.col("_wanted")), "left_semi")


def fact_gate(ops: DataFrame, rates: DataFrame, fact: DataFrame, name: str, days: DataFrame | None, months: list | None) -> DataFrame:
    """``recon_fact`` over some days."""
    spec = FACTS[name]
    return recon_fact(
        on_days(ops, spec.op_date, days, months), on_days(rates, "rate_date", days, months),
        on_days(fact, spec.fact_date, days, months), name,
    )


def fact_ledger_gate(staged: DataFrame, fact: DataFrame, name: str) -> DataFrame:
    """Count and amount per (day, currency) of the whole history, from the two ledgers; an undated or unnamed group has no
    partner, as in ``recon_fact``."""
    spec, measures = FACTS[name], ["row_count", "amount"]

    def grouped(rows: DataFrame, day: str) -> DataFrame:
        return rows.groupBy(F.col(day).alias("activity_date"), "currency").agg(*[F.sum(m).alias(m) for m in measures])

    return quality.reconcile(grouped(staged, spec.op_date), grouped(fact, spec.fact_date), ["activity_date", "currency"], measures)


def player_metrics_gate(facts: dict[str, DataFrame], pm: DataFrame, days: DataFrame | None, months: list | None) -> DataFrame:
    """``recon_player_metrics`` over some days; ``pm`` is restricted to them by the caller."""
    touched = {n: on_days(df, FACTS[n].fact_date, days, months) for n, df in facts.items()}
    return recon_player_metrics(touched, on_days(pm, "activity_date", days, months))


def player_metrics_ledger_gate(facts: dict[str, DataFrame], pm: DataFrame) -> DataFrame:
    """Daily sums of the whole history from ledgers: the facts' amounts against player_metrics (an absent sum counts as 0,
    since a day of other operations shows 0 and a day without amounts NULL)."""
    parts = []
    for name, measure in FACT_MEASURE.items():
        own = facts[name].select(F.col(FACTS[name].fact_date).alias("activity_date"), F.col("amount_usd").alias(measure))
        parts.append(own)
    expected = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    zero = F.lit(0).cast("decimal(38,6)")

    def daily(df: DataFrame) -> DataFrame:
        return df.groupBy("activity_date").agg(*[F.coalesce(F.sum(m), zero).cast("decimal(38,6)").alias(m) for m in METRICS])

    return quality.reconcile(daily(expected), daily(pm), ["activity_date"], list(METRICS))


def daily_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("activity_date").agg(*[F.sum(m).alias(m) for m in METRICS])


def recon_metrics_overview(pm: DataFrame, mo: DataFrame) -> DataFrame:
    return quality.reconcile(daily_totals(pm), daily_totals(mo), ["activity_date"], list(METRICS))
