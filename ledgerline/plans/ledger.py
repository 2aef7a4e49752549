"""Ledgers: mergeable totals a commit keeps of the partitions it wrote.

A ledger has a row per (day, currency) or day of a model: row count, exact sums, and the sum of a hash of each row's
content, by which two versions of a day can be told apart without their rows. A gate compares ledgers over the whole
history at the cost of a few numbers a day, and reads rows again only for days whose ledger changed since it last passed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.plans.mart import FACTS, METRICS
from ledgerline.schemas import LOADED_AT, MODELS, STATE

CONTENT = "content"  # sum of the rows' hashes, wrapped into a decimal so that it neither overflows nor loses digits
_SUM = T.DecimalType(38, 6)
_AMOUNT = T.DecimalType(38, 4)


@dataclass(frozen=True)
class Ledger:
    day: str  # the model's date column
    by: tuple[str, ...] = ()  # further keys
    sums: tuple[str, ...] = ()


LEDGERS: dict[str, Ledger] = {
    "currency_rates": Ledger("rate_date"),
    "player_metrics": Ledger("activity_date", (), METRICS),
    "metrics_overview": Ledger("activity_date", (), METRICS),
} | {
    name: x
    for spec in FACTS.values()
    for name, x in (
        (spec.staging, Ledger(spec.op_date, ("currency",), ("amount",))),
        (spec.name, Ledger(spec.fact_date, ("currency",), ("amount", "amount_usd"))),
    )
}


def _content(columns: list[str]) -> Column:
    return F.sum(F.xxhash64(*columns).cast(T.DecimalType(38, 0))).alias(CONTENT)


def totals(df: DataFrame, name: str, keep: list[str] = ()) -> DataFrame:
    """The ledger of a model's rows; ``keep`` are partition columns that follow from the day."""
    x = LEDGERS[name]
    keys = list(dict.fromkeys([x.day, *x.by, *keep]))
    content = [c for c in df.columns if c not in keep and c != "_commit" and not c.startswith(STATE)]
    sums = [F.sum(c).cast(_AMOUNT if c == "amount" else _SUM).alias(c) for c in x.sums]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), *sums, _content(sorted({*content, x.day})))


def schema(name: str, model: T.StructType) -> T.StructType:
    """Columns of a stored ledger of a model with that schema."""
    x = LEDGERS[name]
    keys = list(dict.fromkeys([x.day, *x.by, MODELS[name].partition_by]))
    fields = [model[k] for k in keys] + [T.StructField("row_count", T.LongType())]
    fields += [T.StructField(c, _AMOUNT if c == "amount" else _SUM) for c in x.sums]
    return T.StructType([*fields, T.StructField(CONTENT, T.DecimalType(38, 0))])


def by_day(rows: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """A ledger's ``columns`` added up to ``activity_date``."""
    return rows.groupBy(F.col(LEDGERS[name].day).alias("activity_date")).agg(*[F.sum(c).alias(c) for c in columns])


def changed_days(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """``activity_date`` of the days whose rows differ between two states of a ledger (null for undated rows)."""
    columns = ["row_count", CONTENT]
    sides = [by_day(old, name, columns).select("activity_date", *[F.col(c).alias(f"old_{c}") for c in columns])]
    sides.append(by_day(new, name, columns).select(F.col("activity_date").alias("_day"), *columns))
    joined = sides[0].join(sides[1], F.col("activity_date").eqNullSafe(F.col("_day")), "full_outer")
    same = F.col("row_count").eqNullSafe(F.col("old_row_count")) & F.col(CONTENT).eqNullSafe(F.col(f"old_{CONTENT}"))
    return joined.filter(~same).select(F.coalesce("activity_date", "_day").alias("activity_date"))


#: The stored form of a fact's signed changes.
CHANGES = T.StructType(
    [
        T.StructField("fact", T.StringType()),
        T.StructField("player_id", T.LongType()),
        T.StructField("activity_date", T.DateType()),
        T.StructField("amount_usd", T.DecimalType(28, 6)),
        T.StructField(LOADED_AT, T.TimestampType()),
        T.StructField("sign", T.IntegerType()),
    ]
)


def changes_schema(name: str) -> T.StructType:
    if name not in FACTS:
        raise KeyError(f"{name} keeps no change feed")
    return CHANGES
