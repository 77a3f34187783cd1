"""Per-job durations and the driver-side gaps between jobs, from a Spark event log.

Run a workload with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir``
set to a scratch folder, then:

    python tools/job_times.py <event-log-folder> [job-group ...]

Handles plain and zstd-compressed logs (rolling ``events_*`` files too).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        with open(path, "rb") as f:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(f), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def jobs(folder: str) -> list[dict]:
    files = sorted(p for p in glob.glob(os.path.join(folder, "**", "*"), recursive=True)
                   if os.path.isfile(p) and "appstatus" not in os.path.basename(p))
    out: dict[int, dict] = {}
    for p in files:
        for line in _lines(p):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                props = e.get("Properties", {})
                out[e["Job ID"]] = {"id": e["Job ID"], "start": e["Submission Time"], "stages": len(e["Stage IDs"]),
                                    "group": props.get("spark.jobGroup.id"), "site": props.get("callSite.short", "")}
            elif e["Event"] == "SparkListenerJobEnd" and e["Job ID"] in out:
                out[e["Job ID"]]["end"] = e["Completion Time"]
    return sorted(out.values(), key=lambda j: j["start"])


def main() -> None:
    folder, groups = sys.argv[1], set(sys.argv[2:])
    prev = None
    total = 0
    for j in jobs(folder):
        if groups and j["group"] not in groups:
            continue
        dur = j.get("end", j["start"]) - j["start"]
        gap = j["start"] - prev if prev is not None else 0
        total += dur
        print(f"job {j['id']:>5}  {dur:>6} ms  gap {gap:>6} ms  stages {j['stages']}  {j['group'] or ''}  {j['site']}")
        prev = j.get("end", j["start"])
    print(f"sum of job time: {total} ms")


if __name__ == "__main__":
    main()
