"""Stage timings from Spark's event log (the web UI stays off)."""

from __future__ import annotations

import glob
import json
import os


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
        return
    if os.path.basename(path).startswith("appstatus"):
        return
    with open(path, encoding="utf-8", errors="replace") as fh:
        yield from fh


def stage_times(log_dir: str) -> list[dict]:
    """Completed stages in every event log under ``log_dir`` (rolling v2 folders included):
    stage id, name, tasks and wall time in ms, slowest first."""
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(f)]
    out = []
    for f in sorted(files):
        for line in _lines(f):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") != "SparkListenerStageCompleted":
                continue
            info = e["Stage Info"]
            out.append({"stage": info["Stage ID"], "name": info["Stage Name"],
                        "tasks": info["Number of Tasks"],
                        "ms": info.get("Completion Time", 0) - info.get("Submission Time", 0)})
    return sorted(out, key=lambda s: -s["ms"])
