"""Benchmark the headline builds at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each timed step forces the whole plan with the ``noop`` sink (no collect to the driver):
  facts_full           - the three facts from raw (staging dedup, rate join)
  player_metrics_full  - daily player metrics from raw
  metrics_overview_full- daily segment report from raw
  monthly_summary_full - the monthly view from raw
  increment_batch2     - applying batch 2 to the stored batch-1 state (all 15 models)
The raw layer (source-shaped tables derived from the test tables) is stored once before timing.
  rebuild_full         - rebuilding all 15 models from scratch, stored the same way
  new_or_changed_bets  - change capture of a bets snapshot against the stored raw log
The reported value is the sum of the step times (median of the runs).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="ledgerline-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .config("spark.local.dir", os.path.join(scratch, "local"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from ledgerline.operators import changes
    from ledgerline.plans import build
    from ledgerline.schemas import RAW_TABLES
    from ledgerline.session import ensure_session
    from ledgerline.sources import fixtures

    ensure_session(spark)

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # The raw layer is a stored table in the pipeline (written by the loader); derive it from
    # the test tables once and store it, outside the timed steps.
    # Like a loader's output it is spread over several files (the test inputs are one row group each).
    parts = int(cpus) * 2
    raw = {name: df.repartition(parts).checkpoint(eager=True) for name, df in fixtures.raw_tables(spark, sf_dir).items()}

    def facts_full():
        w = build.full_build(raw)
        for f in w.facts.values():
            noop(f)

    def pm_full():
        noop(build.full_build(raw).player_metrics)

    def mo_full():
        noop(build.full_build(raw).metrics_overview)

    def monthly_full():
        noop(build.full_build(raw).monthly_summary)

    state1 = build.advance(None, fixtures.split_batches(raw))

    def increment():
        build.advance(state1, raw)

    def rebuild():
        build.advance(None, raw)

    bets_cfg = RAW_TABLES["games"]
    stored_bets = fixtures.in_batch1(raw["games"]).checkpoint(eager=True)
    snapshot = raw["games"].drop("loaded_at")

    def cdc():
        _, inserted = changes.changes_for_load(
            snapshot, stored_bets, bets_cfg.keys, bets_cfg.columns, bets_cfg.date_column, bets_cfg.lookback_days
        )
        noop(inserted)

    steps = {
        "facts_full": facts_full,
        "player_metrics_full": pm_full,
        "metrics_overview_full": mo_full,
        "monthly_summary_full": monthly_full,
        "increment_batch2": increment,
        "rebuild_full": rebuild,
        "new_or_changed_bets": cdc,
    }
    facts_full()  # warm-up: JVM, code generation, file listing
    times: dict[str, list[float]] = {k: [] for k in steps}
    for _ in range(runs):
        for name, fn in steps.items():
            t0 = time.perf_counter()
            fn()
            times[name].append(time.perf_counter() - t0)
    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "warehouse_build_total",
                "value": round(sum(med.values()), 3),
                "unit": "sec",
                "queries": med,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
