"""Summarise a Spark event log per job group (bench check): jobs, stages,
tasks and task time. Usage:
    python scripts/stage_times.py <event log file or directory> [check]"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: one file, or the rolling directory Spark 4
    writes; zstd-compressed parts are decompressed on the fly."""
    files = [path]
    if os.path.isdir(path):
        files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for f in files:
        if f.endswith(".zstd"):
            import zstandard

            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main(path: str, detail: str | None = None) -> None:
    group_of_job, stages_of_job = {}, defaultdict(set)
    tasks, task_ms, stage_group = defaultdict(int), defaultdict(int), {}
    stage_tasks, stage_ms, stage_name = defaultdict(int), defaultdict(int), {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            props = ev.get("Properties") or {}
            g = props.get("spark.jobGroup.id", "-")
            group_of_job[ev["Job ID"]] = g
            for info in ev.get("Stage Infos", []):
                stage_name[info["Stage ID"]] = info.get("Stage Name", "")
            for sid in ev.get("Stage IDs", []):
                stages_of_job[g].add(sid)
                stage_group[sid] = g
        elif kind == "SparkListenerTaskEnd":
            sid = ev.get("Stage ID")
            g = stage_group.get(sid, "-")
            info = ev.get("Task Info", {})
            ms = int(info.get("Finish Time", 0)) - int(info.get("Launch Time", 0))
            tasks[g] += 1
            task_ms[g] += ms
            stage_tasks[sid] += 1
            stage_ms[sid] += ms
    jobs = defaultdict(int)
    for g in group_of_job.values():
        jobs[g] += 1
    print(f"{'check':30s} {'jobs':>5s} {'stages':>6s} {'tasks':>6s} {'task_s':>7s}")
    for g in sorted(jobs, key=lambda k: -task_ms[k]):
        print(f"{g:30s} {jobs[g]:5d} {len(stages_of_job[g]):6d} {tasks[g]:6d} {task_ms[g] / 1000:7.2f}")
    if detail:
        print(f"\nstages of {detail} (stages skipped by reuse have no tasks):")
        for sid in sorted(stages_of_job[detail]):
            if stage_tasks[sid]:
                print(f"  stage {sid:4d} tasks {stage_tasks[sid]:4d} task_s {stage_ms[sid] / 1000:6.2f}  {stage_name[sid][:70]}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else None)
