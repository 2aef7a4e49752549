"""Staging models: latest version per business key, typed and normalised."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import as_amount, as_bigint, as_date, as_rate, clean_text, code
from ledgerline.operators.incremental import delete_insert, high_water_mark, newer_than
from ledgerline.operators.versions import latest_version
from ledgerline.schemas import LOADED_AT, MODELS, RAW_TABLES


def _players() -> list[Column]:
    return [
        as_bigint("id").alias("player_id"),
        as_date("registration_date").alias("registration_date"),
        clean_text("registration_type").alias("registration_type"),
        code("country").alias("country"),
        F.col(LOADED_AT),
    ]


def _providers() -> list[Column]:
    return [as_bigint("id").alias("provider_id"), clean_text("provider_name").alias("provider_name"), F.col(LOADED_AT)]


def _games_map() -> list[Column]:
    return [
        as_bigint("id").alias("game_id"),
        clean_text("game_name").alias("game_name"),
        as_bigint("provider_id").alias("provider_id"),
        F.col(LOADED_AT),
    ]


def _rates() -> list[Column]:
    return [
        as_date("date").alias("rate_date"),
        code("currency").alias("currency"),
        as_rate("rate_to_usd").alias("currency_units_per_usd"),
        F.col(LOADED_AT),
    ]


def _money_ops(id_name: str, date_name: str) -> Callable[[], list[Column]]:
    def cols() -> list[Column]:
        return [
            as_bigint("id").alias(id_name),
            as_bigint("player_id").alias("player_id"),
            as_date(date_name).alias(date_name),
            as_bigint("provider_id").alias("provider_id"),
            as_amount("amount").alias("amount"),
            code("currency").alias("currency"),
            F.col(LOADED_AT),
        ]

    return cols


def _bets() -> list[Column]:
    return [
        as_bigint("id").alias("bet_id"),
        as_bigint("player_id").alias("player_id"),
        as_date("game_date").alias("game_date"),
        as_amount("amount").alias("amount"),
        code("currency").alias("currency"),
        as_bigint("provider_id").alias("provider_id"),
        as_bigint("game_id").alias("game_id"),
        F.col(LOADED_AT),
    ]


PROJECTIONS: dict[str, Callable[[], list[Column]]] = {
    "players": _players,
    "providers_map": _providers,
    "games_map": _games_map,
    "currency_rates": _rates,
    "deposits": _money_ops("deposit_id", "deposit_date"),
    "withdrawals": _money_ops("withdrawal_id", "withdrawal_date"),
    "games": _bets,
}


def stage(raw: DataFrame, table: str) -> DataFrame:
    """Full build: newest raw version of each key (partitioned by the *raw* text key), then typed.

    Keys are normalised after the dedup, as in the source models, so ``usd``/``USD`` on
    one day stay two rows; the composite unique check catches that.
    """
    cfg = RAW_TABLES[table]
    return latest_version(raw, cfg.keys).select(*PROJECTIONS[table]())


def stage_batch(target: DataFrame | None, raw: DataFrame, table: str) -> DataFrame:
    """Staged rows of the raw versions loaded after the target's watermark."""
    return stage(newer_than(raw, high_water_mark(target)), table)


def stage_increment(target: DataFrame | None, raw: DataFrame, table: str) -> DataFrame:
    """Incremental build: delete+insert the batch by the staging key."""
    batch = stage_batch(target, raw, table)
    if target is None:
        return batch
    return delete_insert(target, batch, MODELS[table].keys)
