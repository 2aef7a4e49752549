"""Change capture from full snapshots without CDC columns.

A source row is appended to the raw version log when it differs (as text, NULL equal to
NULL) from the previous version of its key: the previous row of the same key in file order,
or for the first such row the latest stored version. Dated tables only look at rows whose
business date is inside the look-back window (``max(stored date) - days``, inclusive); a row without a readable date has
no place in any window and is refused by every load, the first included.

Scale: stored versions and new rows go through one window together, by key. Keys with more than ``HEAVY_ROWS`` new rows
are found by a count before it (map-side sums, one number a key) and cut into runs of ``RUN_ROWS`` positions, so that a
key holding a third of a snapshot is spread over many tasks; the last row of each run is then handed to the next, a few
rows a heavy key. Without heavy keys, as usual, the rows are exchanged once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.joins import bounded_broadcast
from ledgerline.operators.versions import latest_version
from ledgerline.schemas import INGEST_SEQ, LOADED_AT

FILE_SHIFT = 33  # ingest_seq = file_index << 33 | number of the record's first line
HEAVY_ROWS = 1_000_000  # new rows of one key that a task may hold
RUN_ROWS = 1_000_000


def _day(c: str) -> Column:
    return F.to_date(F.col(c), "yyyy-MM-dd")


def cutoff_frame(raw: DataFrame, date_col: str, days: int) -> DataFrame:
    """One row: the newest stored business date and the window start (NULL when raw is empty).

    Dates are parsed before ``max`` so a malformed value cannot win a text comparison.
    """
    return raw.agg(F.max(_day(date_col)).alias("max_date")).select(
        "max_date", F.date_sub("max_date", days).alias("cutoff_date")
    )


def cutoff_date(raw: DataFrame | None, date_col: str | None, days: int) -> dt.date | None:
    """The window start as a driver scalar; None for a first load or an undated table."""
    if raw is None or date_col is None:
        return None
    return cutoff_frame(raw, date_col, days).first()["cutoff_date"]


def within_lookback(df: DataFrame, date_col: str | None, cutoff: dt.date | None) -> DataFrame:
    """Rows dated on or after the cutoff; every row when there is no cutoff. A row without a readable date cannot be
    placed in the window and raises."""
    if date_col is None:
        return df
    undated = F.raise_error(F.lit(f"a row without a readable {date_col}")).cast("boolean")
    inside = _day(date_col).isNotNull() if cutoff is None else _day(date_col) >= F.lit(cutoff)
    return df.filter(F.when(_day(date_col).isNull(), undated).otherwise(inside))


def latest_stored(
    raw: DataFrame | None, keys: Sequence[str], date_col: str | None, cutoff: dt.date | None
) -> DataFrame | None:
    """Latest stored version per key, only inside the window (DISTINCT ON ... ORDER BY loaded_at DESC)."""
    if raw is None:
        return None
    return latest_version(within_lookback(raw, date_col, cutoff), keys)


def _same(a: str, b: str, columns: Sequence[str]) -> Column:
    """Row ``a`` equals row ``b`` column by column, NULL equal to NULL; a missing ``b`` differs."""
    eq = reduce(lambda x, y: x & y, [F.col(a)[c].eqNullSafe(F.col(b)[c]) for c in columns])
    return F.col(b).isNotNull() & eq


def new_or_changed(
    source: DataFrame,
    stored: DataFrame | None,
    keys: Sequence[str],
    columns: Sequence[str],
    seq_col: str = INGEST_SEQ,
) -> DataFrame:
    """Source rows (with ``seq_col``) that start a new version of their key."""
    keys = list(keys)
    values = F.struct(*[F.col(c) for c in columns]).alias("_v")
    src = source.select(*[F.col(k) for k in keys], F.col(seq_col).alias("_seq"), values)
    both = src.withColumn("_new", F.lit(True))
    if stored is not None:
        old = stored.select(*[F.col(k) for k in keys], F.lit(-1).cast("long").alias("_seq"), values, F.lit(False).alias("_new"))
        both = both.unionByName(old)
    heavy = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HEAVY_ROWS).select(*keys)
    heavy = [r.asDict() for r in heavy.collect()]  # fewer than one in HEAVY_ROWS rows
    run = F.lit(0).cast("long")
    if heavy:
        is_heavy = reduce(lambda a, b: a | b, [reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.lit(h[k])) for k in keys]) for h in heavy])
        run = F.when(is_heavy, F.floor(F.col("_seq") / RUN_ROWS)).otherwise(run).cast("long")
    both = both.withColumn("_run", run)
    in_run = Window.partitionBy(*keys, "_run").orderBy("_seq")
    rows = both.withColumn("_prev", F.lag("_v").over(in_run))
    if heavy:
        # one row a run of a heavy key: the last version it leaves behind goes to the run after it
        last = both.filter(is_heavy).groupBy(*keys, "_run").agg(F.max_by("_v", "_seq").alias("_last"))
        across = Window.partitionBy(*keys).orderBy("_run")
        handed = last.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_run").alias("_k_run"), F.lag("_last").over(across).alias("_before"))
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]) & (F.col("_run") == F.col("_k_run"))
        rows = rows.join(bounded_broadcast(handed), on, "left")
        rows = rows.withColumn("_prev", F.coalesce("_prev", "_before"))
    return rows.filter(F.col("_new") & ~_same("_v", "_prev", columns)).select("_v.*", F.col("_seq").alias(seq_col))


def changes_for_load(
    source: DataFrame,
    raw: DataFrame | None,
    keys: Sequence[str],
    columns: Sequence[str],
    date_col: str | None,
    days: int,
) -> tuple[DataFrame, DataFrame]:
    """(rows processed inside the window, rows to append) for one snapshot load."""
    cutoff = cutoff_date(raw, date_col, days)
    processed = within_lookback(source, date_col, cutoff)
    stored = latest_stored(raw, keys, date_col, cutoff)
    return processed, new_or_changed(processed, stored, keys, columns)


def stamp(rows: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    """Every row of one load gets the same ``loaded_at``."""
    return rows.withColumn(LOADED_AT, F.lit(batch_ts).cast(T.TimestampType()))


def load_counts(table: str, processed: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row with the loader's two counters, computed by Spark in one aggregate (no driver loop)."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    marks = processed.select(one.alias("p"), zero.alias("i")).unionByName(
        inserted.select(zero.alias("p"), one.alias("i"))
    )
    return marks.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("p"), zero).alias("processed_rows"),
        F.coalesce(F.sum("i"), zero).alias("inserted_rows"),
    )
