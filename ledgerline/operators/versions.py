"""Latest version per business key (staging dedup, DISTINCT ON of the loader)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.schemas import INGEST_SEQ, LOADED_AT


def version_order(df: DataFrame) -> list[Column]:
    """Newest first: load time, then position in the file (the last row of a file wins)."""
    order = [F.col(LOADED_AT).desc()]
    if INGEST_SEQ in df.columns:
        order.append(F.col(INGEST_SEQ).desc())
    return order


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order`` (default newest version).

    ``row_number() = 1`` lets Catalyst insert a partial WindowGroupLimit before the shuffle,
    so a key with millions of versions leaves each map task as a single row.
    """
    order = list(order) if order is not None else version_order(df)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_version_rank", F.row_number().over(w)).filter("_version_rank = 1").drop("_version_rank")
