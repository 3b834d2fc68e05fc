"""Summarise a Spark event log: per SQL execution, its duration and slowest stages.

Usage: ``python tools/profile_stages.py <event-log-file-or-dir> [top_n]``

Write the log with ``BENCH_EVENT_LOG=<scratch dir> python bench.py``.  The
report lists the SQL executions by duration, each with its job count, stage
count and slowest stages (name, tasks, seconds).  No Spark UI or server is
involved: the log is a JSON-lines file read directly.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _files(path: str) -> list[str]:
    if os.path.isfile(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in names if not n.startswith(".")]
    return sorted(out)


def _lines(f: str):
    """Lines of a plain or zstd-compressed event log file."""
    if f.endswith(".zstd") or f.endswith(".zst"):
        import io

        import zstandard

        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def summarise(path: str) -> list[dict]:
    sql: dict[int, dict] = {}
    job_sql: dict[int, int] = {}
    stage_job: dict[int, int] = {}
    stages: dict[int, dict] = {}
    for f in _files(path):
        for line in _lines(f):
                ev = json.loads(line)
                kind = ev.get("Event", "")
                if kind.endswith("SparkListenerSQLExecutionStart"):
                    sql[ev["executionId"]] = {"id": ev["executionId"], "desc": ev.get("description", "")[:60],
                                              "start": ev["time"], "end": None}
                elif kind.endswith("SparkListenerSQLExecutionEnd"):
                    if ev["executionId"] in sql:
                        sql[ev["executionId"]]["end"] = ev["time"]
                elif kind == "SparkListenerJobStart":
                    eid = (ev.get("Properties") or {}).get("spark.sql.execution.id")
                    if eid is not None:
                        job_sql[ev["Job ID"]] = int(eid)
                        for sid in ev.get("Stage IDs", []):
                            stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    sub, done = info.get("Submission Time"), info.get("Completion Time")
                    if sub and done:
                        stages[info["Stage ID"]] = {"name": info.get("Stage Name", "")[:50],
                                                    "tasks": info.get("Number of Tasks", 0), "secs": (done - sub) / 1000}
    per_sql: dict[int, list] = defaultdict(list)
    for sid, st in stages.items():
        job = stage_job.get(sid)
        if job is not None and job in job_sql:
            per_sql[job_sql[job]].append(st)
    rows = []
    for eid, s in sql.items():
        if s["end"] is None:
            continue
        sts = sorted(per_sql.get(eid, []), key=lambda x: -x["secs"])
        jobs = sum(1 for j, e in job_sql.items() if e == eid)
        rows.append({"id": eid, "desc": s["desc"], "secs": (s["end"] - s["start"]) / 1000, "jobs": jobs,
                     "stages": len(sts), "slowest": sts[:3]})
    return sorted(rows, key=lambda r: -r["secs"])


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    for r in summarise(path)[:top]:
        slow = "; ".join(f"{s['name']} ({s['tasks']} tasks) {s['secs']:.2f}s" for s in r["slowest"])
        print(f"{r['secs']:7.2f}s  exec {r['id']:<4} jobs {r['jobs']:<3} stages {r['stages']:<3} {r['desc']!r}  | {slow}")


if __name__ == "__main__":
    main()
