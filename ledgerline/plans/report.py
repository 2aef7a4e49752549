"""Report layer: daily segment metrics and the monthly summary view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import freshest, month_start
from ledgerline.operators.incremental import high_water_mark, newer_than, replace_days, restrict_to
from ledgerline.operators.joins import bounded_broadcast
from ledgerline.plans.mart import METRICS
from ledgerline.schemas import LOADED_AT

# dim_player is broadcast only while it has at most this many rows; beyond, AQE joins by shuffle.
DIM_PLAYER_BROADCAST_ROWS = 5_000_000


def _segment_rows(pm: DataFrame, dim_player: DataFrame, dim_rows: int | None = None) -> DataFrame:
    """Left join: a player missing from the dimension keeps its row with a NULL segment."""
    p = dim_player.select(
        "player_id", "country", "registration_type", F.col(LOADED_AT).alias("_player_loaded_at")
    )
    return pm.join(bounded_broadcast(p, DIM_PLAYER_BROADCAST_ROWS, dim_rows), "player_id", "left")


def aggregate_segments(pm: DataFrame, dim_player: DataFrame, dim_rows: int | None = None) -> DataFrame:
    rows = _segment_rows(pm, dim_player, dim_rows)
    return rows.groupBy("activity_date", "country", "registration_type").agg(
        *[F.sum(m).alias(m) for m in METRICS],
        F.max(freshest(F.col(LOADED_AT), F.col("_player_loaded_at"))).alias(LOADED_AT),
    )


def metrics_overview(pm: DataFrame, dim_player: DataFrame, dim_rows: int | None = None) -> DataFrame:
    return aggregate_segments(pm, dim_player, dim_rows)


def restated_dates(pm: DataFrame, dim_player: DataFrame, watermark, dim_rows: int | None = None) -> DataFrame:
    """Dates to restate: new metric rows, plus every day of a player whose attributes changed."""
    by_metrics = newer_than(pm, watermark).select("activity_date")
    changed_players = newer_than(dim_player, watermark).select("player_id")
    changed = bounded_broadcast(changed_players, DIM_PLAYER_BROADCAST_ROWS, dim_rows)
    by_player = pm.join(changed, "player_id", "inner").select(
        "activity_date"
    )
    return by_metrics.unionByName(by_player).distinct()


def metrics_overview_increment(target: DataFrame | None, pm: DataFrame, dim_player: DataFrame) -> DataFrame:
    if target is None:
        return metrics_overview(pm, dim_player)
    dates = restated_dates(pm, dim_player, high_water_mark(target))
    fresh = aggregate_segments(restrict_to(pm, "activity_date", dates, "activity_date"), dim_player)
    return replace_days(target, fresh, "activity_date")


def monthly_summary(overview: DataFrame) -> DataFrame:
    """A view: computed on read from the (small) daily report table."""
    return overview.groupBy(month_start("activity_date").alias("activity_month"), "country").agg(
        *[F.sum(m).alias(m) for m in METRICS], F.max(LOADED_AT).alias(LOADED_AT)
    )
