"""Data-quality checks: each returns the failing rows as a DataFrame; ``gate`` raises on any.

* ``null_counts`` checks every listed column in one aggregation pass.
* ``duplicates`` groups by the key (NULL keys ignored) with map-side partial counts.
* ``reconcile`` compares two aggregates with a full outer join on plain ``=`` (NULL keys
  never match, so they surface as failures) and keeps rows where any measure
  ``IS DISTINCT FROM`` its counterpart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DataQualityError(RuntimeError):
    def __init__(self, check: str, sample: list):
        super().__init__(f"data-quality check {check!r} failed; sample of failing rows: {sample}")
        self.check = check
        self.sample = sample


def null_counts(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """(table_name, column_name, null_count) for every column, from a single scan."""
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(0).cast("long")).alias("null_count")) for c in columns]
    )
    return counts.select(F.lit(table).alias("table_name"), F.inline(pairs))


def not_null_failures(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    return null_counts(df, columns, table).filter("null_count > 0")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row; rows with any NULL key column are not checked."""
    keys = list(keys)
    nonnull = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return nonnull.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def reconcile(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Rows where expected and actual aggregates disagree on any measure, or exist on one side only."""
    e = expected.select(*[F.col(k).alias(f"_e_{k}") for k in keys], *[F.col(m).alias(f"expected_{m}") for m in measures])
    a = actual.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *[F.col(m).alias(f"actual_{m}") for m in measures])
    on = reduce(lambda x, y: x & y, [F.col(f"_e_{k}") == F.col(f"_a_{k}") for k in keys])
    joined = e.join(a, on, "full_outer")
    differs = reduce(
        lambda x, y: x | y, [~F.col(f"expected_{m}").eqNullSafe(F.col(f"actual_{m}")) for m in measures]
    )
    out = [F.coalesce(F.col(f"_e_{k}"), F.col(f"_a_{k}")).alias(k) for k in keys]
    for m in measures:
        out += [F.col(f"expected_{m}"), F.col(f"actual_{m}")]
    return joined.filter(differs).select(*out)


def gate(check: str, failures: DataFrame, sample_rows: int = 5) -> None:
    """Stop the job when a check returns any row; only a small sample reaches the driver."""
    sample = failures.take(sample_rows)
    if sample:
        raise DataQualityError(check, [r.asDict() for r in sample])
