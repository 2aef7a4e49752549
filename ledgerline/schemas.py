"""Table layout, decimal policy and per-table load configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Decimal policy: the source keeps unconstrained NUMERIC; Spark needs a fixed scale.
AMOUNT = T.DecimalType(20, 4)
RATE = T.DecimalType(20, 8)
USD = T.DecimalType(28, 6)

LOADED_AT = "loaded_at"
INGEST_SEQ = "ingest_seq"  # position of the row in its source file, tie-break for equal loaded_at

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for the same results:
# layer names, raw table columns, business keys, window columns, the look-back
# length in days and the empty-table watermark sentinel.
# ---------------------------------------------------------------------------
LAYERS = ("raw", "staging", "data_mart", "data_mart_report")
LOOKBACK_DAYS = 30
WATERMARK_SENTINEL = "1900-01-01 00:00:00"


@dataclass(frozen=True)
class RawTable:
    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    date_column: str | None = None
    lookback_days: int = LOOKBACK_DAYS
    extra: dict = field(default_factory=dict)


RAW_TABLES: dict[str, RawTable] = {
    t.name: t
    for t in (
        RawTable("players", ("id", "registration_date", "registration_type", "country"), ("id",)),
        RawTable("providers_map", ("id", "provider_name"), ("id",)),
        RawTable("games_map", ("id", "game_name", "provider_id"), ("id",)),
        RawTable("currency_rates", ("date", "currency", "rate_to_usd"), ("date", "currency"), "date"),
        RawTable(
            "deposits",
            ("id", "player_id", "deposit_date", "provider_id", "amount", "currency"),
            ("id",),
            "deposit_date",
        ),
        RawTable(
            "withdrawals",
            ("id", "player_id", "withdrawal_date", "provider_id", "amount", "currency"),
            ("id",),
            "withdrawal_date",
        ),
        RawTable(
            "games",
            ("id", "player_id", "game_date", "amount", "currency", "provider_id", "game_id"),
            ("id",),
            "game_date",
        ),
    )
}


def raw_schema(table: str) -> T.StructType:
    """Raw version log: all business columns as text, plus load time and file position."""
    cfg = RAW_TABLES[table]
    fields = [T.StructField(c, T.StringType(), True) for c in cfg.columns]
    fields.append(T.StructField(LOADED_AT, T.TimestampType(), False))
    fields.append(T.StructField(INGEST_SEQ, T.LongType(), True))
    return T.StructType(fields)


# Storage layout of each stored model: unique key (None = replaced by day), and the
# directory partition column derived from an immutable business date or key.
@dataclass(frozen=True)
class ModelLayout:
    layer: str
    name: str
    keys: tuple[str, ...] | None
    partition_by: str | None
    date_column: str | None = None


MODELS: dict[str, ModelLayout] = {
    m.name: m
    for m in (
        ModelLayout("staging", "players", ("player_id",), "_bucket"),
        ModelLayout("staging", "providers_map", ("provider_id",), "_bucket"),
        ModelLayout("staging", "games_map", ("game_id",), "_bucket"),
        ModelLayout("staging", "currency_rates", ("rate_date", "currency"), "_month", "rate_date"),
        ModelLayout("staging", "deposits", ("deposit_id",), "_month", "deposit_date"),
        ModelLayout("staging", "withdrawals", ("withdrawal_id",), "_month", "withdrawal_date"),
        ModelLayout("staging", "games", ("bet_id",), "_month", "game_date"),
        ModelLayout("data_mart", "dim_player", ("player_id",), "_bucket"),
        ModelLayout("data_mart", "dim_provider", ("provider_id",), "_bucket"),
        ModelLayout("data_mart", "dim_game", ("game_id",), "_bucket"),
        ModelLayout("data_mart", "fact_deposit", ("deposit_id",), "_month", "deposit_date"),
        ModelLayout("data_mart", "fact_withdrawal", ("withdrawal_id",), "_month", "withdrawal_date"),
        ModelLayout("data_mart", "fact_bet", ("bet_id",), "_month", "bet_date"),
        ModelLayout("data_mart", "player_metrics", None, "activity_date", "activity_date"),
        ModelLayout("data_mart_report", "metrics_overview", None, "activity_date", "activity_date"),
    )
}

# Columns of a stored model that only its own maintenance uses; readers never see them.
STATE = "_state_"
