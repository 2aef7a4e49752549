"""Incremental building blocks: watermark, delete+insert by key, replace by day, affected dates.

The watermark is one scalar computed on the driver and passed back as a literal, so the
``loaded_at > w`` filter reaches the Parquet scan (row-group statistics, batch partitions).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalar import watermark_or_sentinel
from ledgerline.operators.joins import bounded_broadcast
from ledgerline.schemas import LOADED_AT

# A batch's distinct keys or dates are broadcast only under this bound.
BATCH_KEYS_BROADCAST_ROWS = 5_000_000


def high_water_mark(target: DataFrame | None, col: str = LOADED_AT) -> dt.datetime:
    """``coalesce(max(loaded_at), '1900-01-01')`` of the target; the sentinel when there is none."""
    if target is None:
        return dt.datetime(1900, 1, 1)
    return target.agg(watermark_or_sentinel(col).alias("w")).first()["w"]


def watermark_frame(target: DataFrame, col: str = LOADED_AT) -> DataFrame:
    """The same watermark as a one-row DataFrame (for reporting, no driver round trip)."""
    return target.agg(watermark_or_sentinel(col).alias("watermark"))


def newer_than(df: DataFrame, watermark: dt.datetime, col: str = LOADED_AT) -> DataFrame:
    """Strictly newer rows: ``col > watermark``."""
    return df.filter(F.col(col) > F.lit(watermark).cast(T.TimestampType()))


def delete_insert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], batch_rows: int | None = None
) -> DataFrame:
    """Drop target rows whose key occurs in the batch, then add every batch row.

    Plain equality: NULL keys are never deleted, and duplicates inside the batch are all
    inserted (the semantics of delete+insert, not of MERGE).
    """
    return without_keys(target, batch, keys, batch_rows).unionByName(batch)


def without_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str], batch_rows: int | None = None) -> DataFrame:
    """The target rows that ``delete_insert`` would keep."""
    keys = list(keys)
    batch_keys = bounded_broadcast(batch.select(*keys).distinct(), BATCH_KEYS_BROADCAST_ROWS, batch_rows)
    return target.join(batch_keys, on=keys, how="left_anti").select(*target.columns)


def rows_with_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str], batch_rows: int | None = None) -> DataFrame:
    """The target rows that ``delete_insert`` would drop."""
    keys = list(keys)
    batch_keys = bounded_broadcast(batch.select(*keys).distinct(), BATCH_KEYS_BROADCAST_ROWS, batch_rows)
    return target.join(batch_keys, on=keys, how="left_semi").select(*target.columns)


def replace_days(target: DataFrame, fresh: DataFrame, date_col: str, fresh_rows: int | None = None) -> DataFrame:
    """Key not unique: every target row of a date present in ``fresh`` is replaced."""
    return delete_insert(target, fresh, [date_col], fresh_rows)


def without_days(target: DataFrame, days: DataFrame, date_col: str) -> DataFrame:
    """The target rows of other dates than ``days``."""
    gone = bounded_broadcast(days.select(date_col).distinct(), BATCH_KEYS_BROADCAST_ROWS)
    return target.join(gone, on=date_col, how="left_anti").select(*target.columns)


def dates_touched(sources: Mapping[str, DataFrame], watermark: dt.datetime | None, out: str) -> DataFrame:
    """Distinct dates of rows newer than the watermark, over several inputs (UNION).

    ``sources`` maps the date column name to its DataFrame. ``watermark=None`` means all rows.
    """
    parts = []
    for date_col, df in sources.items():
        rows = df if watermark is None else newer_than(df, watermark)
        parts.append(rows.select(F.col(date_col).alias(out)))
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result.distinct()


def restrict_to(
    df: DataFrame, date_col: str, dates: DataFrame, dates_col: str, dates_rows: int | None = None
) -> DataFrame:
    """Rows of ``df`` on one of ``dates`` (semi join against a small, checked date set)."""
    small = bounded_broadcast(
        dates.select(F.col(dates_col).alias(date_col)).distinct(), BATCH_KEYS_BROADCAST_ROWS, dates_rows
    )
    return df.join(small, on=date_col, how="left_semi").select(*df.columns)


MONTH_PARTITION = "_month"  # yyyyMM partition column of stored dated tables


def months_of(dates: DataFrame, date_col: str) -> list:
    """Distinct yyyyMM of a small date set (bounded by the calendar months it spans)."""
    month = F.date_format(F.col(date_col), "yyyyMM").cast("int")
    return [r[0] for r in dates.select(month.alias("m")).distinct().collect()]


def prune_months(df: DataFrame, months: list) -> DataFrame:
    """On a stored table partitioned by month, read only ``months`` (directory pruning);
    a no-op for tables without the partition column."""
    if MONTH_PARTITION not in df.columns:
        return df
    col = F.col(MONTH_PARTITION)
    known = [m for m in months if m is not None]
    cond = col.isin(known) if known else F.lit(False)
    if len(known) < len(months):
        cond = cond | col.isNull()
    return df.filter(cond)


DAY_LIST_ROWS = 20_000  # a day list this long (55 years) still makes a cheap literal filter


def prune_days(df: DataFrame, date_col: str, dates: DataFrame, dates_rows: int) -> DataFrame:
    """Filter a day-partitioned table to a small day set as literals (static partition pruning).

    A semi join alone does not prune directories here (no selective predicate for dynamic
    pruning). Above ``DAY_LIST_ROWS`` days the semi join alone restricts the rows.
    """
    if dates_rows > DAY_LIST_ROWS:
        return df
    days = [r[0] for r in dates.select(date_col).distinct().collect()]
    return df.filter(F.col(date_col).isin(days)) if days else df.limit(0)
