"""Dashboard data over the report layer: totals by period, breakdowns, filters, period-over-period.

All of these read ``metrics_overview`` (one row per day and segment), the only layer the
dashboard may read. A period's totals are handed to the period one unit later, by a grouping on the
period start, so the report is read once and no window has to gather the whole series into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import period_start
from ledgerline.functions.scalar import PERIOD_UNITS
from ledgerline.plans.mart import METRICS


def _totals(df: DataFrame, unit: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(period_start("activity_date", unit).alias("period_start"), *by).agg(
        *[F.sum(m).alias(m) for m in METRICS]
    )


def filtered(
    overview: DataFrame,
    start=None,
    end=None,
    countries: Sequence[str] | None = None,
    registration_types: Sequence[str] | None = None,
) -> DataFrame:
    """The dashboard filters: period range (inclusive), country and registration type lists."""
    df = overview
    if start is not None:
        df = df.filter(F.col("activity_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("activity_date") <= F.lit(end).cast("date"))
    if countries is not None:
        df = df.filter(F.col("country").isin(list(countries)))
    if registration_types is not None:
        df = df.filter(F.col("registration_type").isin(list(registration_types)))
    return df


def by_period(overview: DataFrame, units: Sequence[str] = PERIOD_UNITS) -> DataFrame:
    """Totals for each period granularity, tagged with ``period_type``. The report is read once: its days are added up
    first, then each day's few sums go to the periods it lies in."""
    days = overview.groupBy("activity_date").agg(*[F.sum(m).alias(m) for m in METRICS])
    periods = F.array(*[F.struct(F.lit(u).alias("period_type"), period_start("activity_date", u).alias("period_start")) for u in units])
    spread = days.select(F.inline(periods), *METRICS)
    return spread.groupBy("period_type", "period_start").agg(*[F.sum(m).alias(m) for m in METRICS])


def last_period(overview: DataFrame, units: Sequence[str] = PERIOD_UNITS) -> DataFrame:
    """For each granularity the last period of the (filtered) report, with the change since the period before it. A period
    before it without any row counts as absent: its columns are NULL."""
    shifted = F.lit(None).cast("date")
    for u in units:
        shifted = F.when(F.col("period_type") == u, _shift(F.col("period_start"), u, 1)).otherwise(shifted)
    periods = _beside_previous(by_period(overview, units), shifted, ["period_type"])
    shown = F.struct("period_start", *METRICS, *[f"previous_{m}" for m in METRICS])
    last = periods.groupBy("period_type").agg(F.max_by(shown, "period_start").alias("last"))
    out = ["period_type", F.col("last.period_start").alias("period_start")]
    for m in METRICS:
        out += _change(m, F.col(f"last.{m}"), F.col(f"last.previous_{m}"))
    return last.select(*out)


def _beside_previous(periods: DataFrame, following: Column, by: Sequence[str] = ()) -> DataFrame:
    """Each period's totals next to those of the period before (``following``: the start of the one after). A period's few
    sums go to its own row and to the next one's, so the report below is read once."""
    empty = [F.lit(None).cast(periods.schema[m].dataType) for m in METRICS]
    own = F.struct("period_start", F.lit(True).alias("_own"), *METRICS, *[e.alias(f"previous_{m}") for m, e in zip(METRICS, empty)])
    handed = F.struct(
        following.alias("period_start"), F.lit(False).alias("_own"), *[e.alias(m) for m, e in zip(METRICS, empty)],
        *[F.col(m).alias(f"previous_{m}") for m in METRICS],
    )
    rows = periods.select(*by, F.inline(F.array(own, handed))).filter("_own or period_start is not null")
    sums = [F.max(c).alias(c) for c in (*METRICS, *[f"previous_{m}" for m in METRICS])]  # one value each
    return rows.groupBy(*by, "period_start").agg(F.max("_own").alias("_own"), *sums).filter("_own").drop("_own")


def _change(measure: str, current: Column, previous: Column) -> list[Column]:
    c, p = current.cast("double"), previous.cast("double")
    return [
        c.alias(measure), p.alias(f"previous_{measure}"), (c - p).alias(f"change_{measure}"),
        F.when(p != 0, (c - p) / p).alias(f"relative_change_{measure}"),
    ]


def by_dimension(overview: DataFrame, dimension: str, unit: str = "month") -> DataFrame:
    return _totals(overview, unit, [dimension])


def _shift(c: Column, unit: str, n: int) -> Column:
    if unit == "day":
        return F.date_add(c, n)
    if unit == "week":
        return F.date_add(c, 7 * n)
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return F.add_months(c, months * n)


def period_over_period(overview: DataFrame, unit: str = "month") -> DataFrame:
    """Each period's totals next to the calendar-previous period's, with absolute and relative change."""
    j = _beside_previous(_totals(overview, unit), _shift(F.col("period_start"), unit, 1))
    out = [F.col("period_start")]
    for m in METRICS:
        out += _change(m, F.col(m), F.col(f"previous_{m}"))
    return j.select(*out)
