"""Summarise a Spark event log: wall time and task time per job group
(bench query), and the longest stages.

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py ...
    python tools/stage_times.py <event log file or folder>
"""

from __future__ import annotations

import collections
import json
import os
import sys


def events(path):
    files = [path]
    if os.path.isdir(path):   # rolled (v2) logs are folders of event files
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                       if not f.startswith("."))
    for f in files:
        if f.endswith(".zstd"):      # Spark 4 compresses event logs with zstd
            import io

            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                for line in io.TextIOWrapper(reader, encoding="utf-8"):
                    yield json.loads(line)
            continue
        if not f.startswith(os.path.join(os.path.dirname(f), "events")) and os.path.isdir(path):
            continue
        with open(f, encoding="utf-8") as fh:
            for line in fh:
                yield json.loads(line)


def main(path):
    job_group, job_start, stage_job = {}, {}, {}
    group_wall = collections.defaultdict(float)
    group_task = collections.defaultdict(float)
    group_jobs = collections.Counter()
    stages = []
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            g = props.get("spark.jobGroup.id", "-")
            job_group[e["Job ID"]] = g
            job_start[e["Job ID"]] = e["Submission Time"]
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
            group_jobs[g] += 1
        elif kind == "SparkListenerJobEnd":
            g = job_group.get(e["Job ID"], "-")
            group_wall[g] += (e["Completion Time"] - job_start.get(e["Job ID"], e["Completion Time"])) / 1e3
        elif kind == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            g = job_group.get(stage_job.get(e["Stage ID"]), "-")
            group_task[g] += m.get("Executor Run Time", 0) / 1e3
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if "Completion Time" in info and "Submission Time" in info:
                stages.append(((info["Completion Time"] - info["Submission Time"]) / 1e3,
                               info["Stage Name"][:60], info["Number of Tasks"],
                               job_group.get(stage_job.get(info["Stage ID"]), "-")))
    print(f"{'query':32s} {'jobs':>5s} {'job wall s':>10s} {'task s':>8s}")
    for g in sorted(group_wall, key=lambda k: -group_wall[k]):
        print(f"{g:32s} {group_jobs[g]:5d} {group_wall[g]:10.2f} {group_task[g]:8.2f}")
    print("\nlongest stages:")
    for secs, name, ntasks, g in sorted(stages, reverse=True)[:15]:
        print(f"{secs:7.2f}s  {ntasks:4d} tasks  {g:28s} {name}")


if __name__ == "__main__":
    main(sys.argv[1])
