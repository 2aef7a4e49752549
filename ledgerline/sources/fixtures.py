"""Source-shaped raw tables derived by Spark from the driver's test tables.

Every raw table has text business columns, ``loaded_at`` and ``ingest_seq``, as if loaded
from CSV snapshots. The mapping (which test table feeds which source) is fixed so that the
DuckDB oracle can rebuild the same values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import INGEST_SEQ, LOADED_AT, RAW_TABLES

# ---------------------------------------------------------------------------
# Fixed fixture values (test-data design, shared with the oracle SQL):
#   order priority -> currency: 1-URGENT USD, 2-HIGH EUR, 3-MEDIUM GBP,
#   4-NOT SPECIFIED INR, anything else RUB
#   first load time of the small tables: 1995-01-01
#   players second version: custkey % 20 = 0, nation (nationkey + 1) % 25, at 2001-12-15
#   rate hundredths k: USD 100, EUR 51 + 2*(doy % 47), GBP 51 + 2*((doy + 10) % 47),
#   INR 8001 + 2*(doy % 47), RUB 9001 + 2*((doy + 10) % 47)
#   rates second version: non-USD, doy % 50 = 0, k + 2, at 2001-12-20
#   batch split: batch 1 is loaded_at on or before 2000-06-30
# ---------------------------------------------------------------------------
PRIORITY_CURRENCY = {"1-URGENT": "USD", "2-HIGH": "EUR", "3-MEDIUM": "GBP", "4-NOT SPECIFIED": "INR"}
OTHER_CURRENCY = "RUB"
FIRST_LOAD = "1995-01-01 00:00:00"
PLAYER_MOVE_LOAD = "2001-12-15 00:00:00"
RATE_REVISION_LOAD = "2001-12-20 00:00:00"
BATCH1_LAST_DAY = "2000-06-30"
NATION_ROWS = 25  # TPC-H nation is fixed at 25 rows: safe to broadcast


@dataclass(frozen=True)
class Variant:
    """Fixture variants for trap queries."""

    gappy_rates: bool = False  # no INR rate when dayofyear % 31 = 0
    zero_rates: bool = False  # RUB rate 0 when dayofyear % 61 = 0
    orphans: bool = False  # players with custkey % 100 = 7 are missing


BASE = Variant()


_READS: dict[tuple[int, str, str], DataFrame] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One DataFrame per input table and session (the scan is shared, the listing done once)."""
    key = (id(spark), sf_dir, name)
    if key not in _READS:
        _READS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _READS[key]


def _ts(text: str) -> Column:
    return F.lit(text).cast(T.TimestampType())


def _day_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _money_text(c: Column) -> Column:
    return c.cast(T.DecimalType(20, 2)).cast(T.StringType())


def currency_of(priority: Column) -> Column:
    expr = F.lit(OTHER_CURRENCY)
    for p, cur in reversed(list(PRIORITY_CURRENCY.items())):
        expr = F.when(priority == p, F.lit(cur)).otherwise(expr)
    return expr


def _padded_currency(priority: Column, orderkey: Column) -> Column:
    """Raw currency text: ' usd '-style for odd order keys (exercises trim/upper)."""
    cur = currency_of(priority)
    return F.when(orderkey % 2 == 1, F.concat(F.lit(" "), F.lower(cur), F.lit(" "))).otherwise(cur)


def _finish(df: DataFrame, table: str) -> DataFrame:
    cols = list(RAW_TABLES[table].columns)
    return df.select(*[F.col(c).cast(T.StringType()) for c in cols], LOADED_AT, INGEST_SEQ)


def raw_players(spark: SparkSession, sf_dir: str, variant: Variant = BASE) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    if variant.orphans:
        c = c.filter(F.col("c_custkey") % 100 != 7)
    n = F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    reg_date = F.date_add(F.lit("1994-01-01").cast(T.DateType()), (F.col("c_custkey") % 365).cast("int"))
    first = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("id"),
        _day_text(reg_date).alias("registration_date"),
        F.col("c_mktsegment").alias("registration_type"),
        F.col("n_name").alias("country"),
        _ts(FIRST_LOAD).alias(LOADED_AT),
        F.lit(0).cast("long").alias(INGEST_SEQ),
    )
    moved = (
        c.filter(F.col("c_custkey") % 20 == 0)
        .join(n, ((c.c_nationkey + 1) % 25) == n.n_nationkey)
        .select(
            F.col("c_custkey").alias("id"),
            _day_text(reg_date).alias("registration_date"),
            F.col("c_mktsegment").alias("registration_type"),
            F.col("n_name").alias("country"),
            _ts(PLAYER_MOVE_LOAD).alias(LOADED_AT),
            F.lit(0).cast("long").alias(INGEST_SEQ),
        )
    )
    return _finish(first.unionByName(moved), "players")


def raw_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    out = s.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("provider_name"),
        _ts(FIRST_LOAD).alias(LOADED_AT),
        F.lit(0).cast("long").alias(INGEST_SEQ),
    )
    return _finish(out, "providers_map")


def raw_games_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    out = p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("game_name"),
        (F.col("p_partkey") % 100).alias("provider_id"),
        _ts(FIRST_LOAD).alias(LOADED_AT),
        F.lit(0).cast("long").alias(INGEST_SEQ),
    )
    return _finish(out, "games_map")


def _operations(spark: SparkSession, sf_dir: str, final: bool, date_name: str, table: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    o = o.filter(F.col("o_orderstatus") == "F") if final else o.filter(F.col("o_orderstatus") != "F")
    day = F.col("o_orderdate").cast(T.DateType())
    out = o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("player_id"),
        _day_text(day).alias(date_name),
        (F.col("o_orderkey") % 100).alias("provider_id"),
        _money_text(F.col("o_totalprice")).alias("amount"),
        _padded_currency(F.col("o_orderpriority"), F.col("o_orderkey")).alias("currency"),
        F.date_add(day, 1).cast(T.TimestampType()).alias(LOADED_AT),
        F.lit(0).cast("long").alias(INGEST_SEQ),
    )
    return _finish(out, table)


def raw_deposits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _operations(spark, sf_dir, False, "deposit_date", "deposits")


def raw_withdrawals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _operations(spark, sf_dir, True, "withdrawal_date", "withdrawals")


def raw_bets(spark: SparkSession, sf_dir: str, placed: bool = True) -> DataFrame:
    """One version per lineitem row; an id (orderkey*10 + linenumber) has several versions.

    Versions of an id sharing a load time are ordered in the emulated file by
    (partkey, suppkey, extendedprice, quantity), so the greatest of those wins.

    The rows are dealt by id, once: both the place in the file and the newest version of an id are found there. Only
    numbers and short codes travel, texts are made afterwards, and a filter on the load time reaches the scan. Without
    ``placed`` the rows stay where the join left them and have no place in the file.
    """
    from pyspark.sql import Window

    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"
    )
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    out = li.join(o, li.l_orderkey == o.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast(T.StringType()).alias("id"),
        F.col("o_custkey").alias("player_id"),
        F.col("o_orderdate").cast(T.DateType()).alias("game_date"),
        "l_extendedprice",
        _padded_currency(F.col("o_orderpriority"), F.col("o_orderkey")).alias("currency"),
        F.col("l_suppkey").alias("provider_id"),
        F.col("l_partkey").alias("game_id"),
        "l_quantity",
        F.col("l_shipdate").cast(T.TimestampType()).alias(LOADED_AT),
    )
    place = F.lit(None).cast("long")
    if placed:
        file_order = Window.partitionBy("id", LOADED_AT).orderBy("game_id", "provider_id", "l_extendedprice", "l_quantity")
        out, place = out.repartition("id"), F.row_number().over(file_order).cast("long")
    out = out.withColumn(INGEST_SEQ, place)
    amount = _money_text(F.col("l_extendedprice"))
    return _finish(out.withColumn("game_date", _day_text(F.col("game_date"))).withColumn("amount", amount), "games")


def _hundredths(currency: str, doy: Column) -> Column:
    if currency == "USD":
        return F.lit(100)
    if currency == "EUR":
        return 51 + 2 * (doy % 47)
    if currency == "GBP":
        return 51 + 2 * ((doy + 10) % 47)
    if currency == "INR":
        return 8001 + 2 * (doy % 47)
    return 9001 + 2 * ((doy + 10) % 47)


def raw_currency_rates(spark: SparkSession, sf_dir: str, variant: Variant = BASE) -> DataFrame:
    """A rate for every order date and five currencies, plus revised rates for some days."""
    days = _read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast(T.DateType()).alias("d")).distinct()
    currencies = ["USD", "EUR", "GBP", "INR", "RUB"]
    doy = F.dayofyear("d")
    k = F.lit(None).cast("int")
    cur = F.col("cur")
    for c in currencies:
        k = F.when(cur == c, _hundredths(c, doy)).otherwise(k)
    grid = days.select("d", F.explode(F.array(*[F.lit(c) for c in currencies])).alias("cur"))
    if variant.gappy_rates:
        grid = grid.filter(~((cur == "INR") & (doy % 31 == 0)))
    k_first = F.when((cur == "RUB") & (doy % 61 == 0), F.lit(0)).otherwise(k) if variant.zero_rates else k

    def rate_text(kc: Column) -> Column:
        return F.format_string("%d.%02d", (kc / 100).cast("int"), kc % 100)

    first = grid.select(
        _day_text(F.col("d")).alias("date"),
        F.col("cur").alias("currency"),
        rate_text(k_first).alias("rate_to_usd"),
        F.date_add("d", 1).cast(T.TimestampType()).alias(LOADED_AT),
        F.lit(0).cast("long").alias(INGEST_SEQ),
    )
    revised = grid.filter((cur != "USD") & (doy % 50 == 0)).select(
        _day_text(F.col("d")).alias("date"),
        F.col("cur").alias("currency"),
        rate_text(k + 2).alias("rate_to_usd"),
        _ts(RATE_REVISION_LOAD).alias(LOADED_AT),
        F.lit(0).cast("long").alias(INGEST_SEQ),
    )
    return _finish(first.unionByName(revised), "currency_rates")


def raw_tables(spark: SparkSession, sf_dir: str, variant: Variant = BASE, placed: bool = True) -> dict[str, DataFrame]:
    """All raw tables; ``placed=False`` for readers that need no order among the versions of a bet."""
    return {
        "players": raw_players(spark, sf_dir, variant),
        "providers_map": raw_providers(spark, sf_dir),
        "games_map": raw_games_map(spark, sf_dir),
        "currency_rates": raw_currency_rates(spark, sf_dir, variant),
        "deposits": raw_deposits(spark, sf_dir),
        "withdrawals": raw_withdrawals(spark, sf_dir),
        "games": raw_bets(spark, sf_dir, placed),
    }


def in_batch1(df: DataFrame) -> DataFrame:
    return df.filter(F.col(LOADED_AT).cast(T.DateType()) <= F.lit(BATCH1_LAST_DAY).cast(T.DateType()))


def split_batches(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw state after the first batch: only versions loaded on or before the split day."""
    return {name: in_batch1(df) for name, df in raw.items()}


# ---------------------------------------------------------------------------
# Fixed values of the change-capture fixture built from ``events``:
#   business key (user_id, event_type), window column event_date, look-back 7 days,
#   snapshot A = latest event per key before 2024-01-21, snapshot B = latest over all events,
#   load times 2024-01-21 (A) and 2024-01-31 (B); feed band = floor(value / 100)
# ---------------------------------------------------------------------------
EVENT_KEYS = ("user_id", "event_type")
EVENT_COLUMNS = ("user_id", "event_type", "event_date", "value")
FEED_COLUMNS = ("user_id", "event_type", "band")
EVENT_LOOKBACK_DAYS = 7
SNAPSHOT_A_BEFORE = "2024-01-21 00:00:00"
LOAD_A = "2024-01-21 00:00:00"
LOAD_B = "2024-01-31 00:00:00"


def event_snapshot(spark: SparkSession, sf_dir: str, before: str | None = None) -> DataFrame:
    """One text row per (user_id, event_type): its latest event (by ts, event_id) before ``before``.

    ``ingest_seq`` is that event's id, i.e. the snapshot file lists keys in event order.
    """
    e = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    if before is not None:
        e = e.filter(F.col("ts") < F.lit(before).cast(T.TimestampNTZType()))
    latest = e.groupBy("user_id", "event_type").agg(
        F.max_by(F.struct("event_id", "ts", "value"), F.struct("ts", "event_id")).alias("last")
    )
    return latest.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type"),
        _day_text(F.col("last.ts").cast(T.DateType())).alias("event_date"),
        _money_text(F.col("last.value")).alias("value"),
        F.col("last.event_id").alias(INGEST_SEQ),
    )


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a text row (user_id, event_type, band), in event order: a key repeats,
    often with an unchanged band, which exercises collapsing of repeats inside one file."""
    e = _read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type"),
        F.floor(F.col("value") / 100).cast("long").cast("string").alias("band"),
        F.col("event_id").alias(INGEST_SEQ),
    )


def current_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's players snapshot: the moved players' new country, everybody else unchanged."""
    from ledgerline.operators.versions import latest_version

    cols = list(RAW_TABLES["players"].columns)
    return latest_version(raw_players(spark, sf_dir), ["id"]).select(*cols, INGEST_SEQ)
