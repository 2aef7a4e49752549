"""Incremental transaction analytics on Spark.

Layers: raw version log -> typed staging -> dimensions and facts -> daily player
metrics -> daily segment report -> monthly summary. Every step is a DataFrame
transform; side effects live in ``sources.store`` and ``plans.job``.
"""

from ledgerline.session import ensure_session, get_session

__all__ = ["ensure_session", "get_session"]
