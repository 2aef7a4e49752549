"""Print job and stage durations from a Spark event log folder (plain or zstd).

Usage: python tools/eventlog.py <eventlog dir or file> [job-description-filter]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard

            with open(f, "rb") as fh:
                reader = zstandard.ZstdDecompressor().stream_reader(fh)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    want = sys.argv[2] if len(sys.argv) > 2 else None
    jobs: dict[int, list] = {}
    stages: dict[int, tuple] = {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description")
            jobs[e["Job ID"]] = [e["Submission Time"], [s["Stage ID"] for s in e["Stage Infos"]], desc, None]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][3] = e["Completion Time"] - jobs[e["Job ID"]][0]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (
                si["Stage Name"][:60],
                si["Number of Tasks"],
                si.get("Completion Time", 0) - si.get("Submission Time", 0),
            )
    for j, (_, sids, desc, dur) in sorted(jobs.items()):
        if want and desc != want:
            continue
        print(f"job {j} {dur} ms {desc or ''}")
        for s in sids:
            if s in stages:
                name, n, ms = stages[s]
                print(f"    stage {s}: {ms} ms, {n} tasks, {name}")


if __name__ == "__main__":
    main()
