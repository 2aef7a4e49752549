"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows above which a side is never broadcast. Rates (days x currencies) and date sets stay
# far below it; dimensions at scale usually do not, and then AQE picks the join at runtime.
DEFAULT_BROADCAST_ROWS = 2_000_000


# Checked DataFrames keep their answer (the DataFrame is held so its id is not reused).
_CHECKED: dict[tuple[int, int], tuple[DataFrame, bool]] = {}


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Reads at most ``max_rows + 1`` rows,
    once per DataFrame object."""
    key = (id(df), max_rows)
    hit = _CHECKED.get(key)
    if hit is not None and hit[0] is df:
        return hit[1]
    ok = df.limit(max_rows + 1).count() <= max_rows
    _CHECKED[key] = (df, ok)
    return ok


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, known_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its row count is proven under the bound, else ``df`` unchanged
    (sort-merge or shuffle-hash join chosen by AQE, with skew splitting).

    ``known_rows`` is an exact upper bound already measured (e.g. by the job that wrote
    ``df``); it saves the counting job."""
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    return F.broadcast(df) if fits(df, max_rows) else df
