"""Summarise a Spark event log: per job group, wall time of its jobs, task
time, shuffle read/write bytes and spill.

    BENCH_EVENT_LOG=1 python bench.py          # prints "event_log": <dir>
    python scripts/stage_times.py <dir or file>
"""

import io
import json
import os
import sys
from collections import defaultdict


def _files(path):
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _dirs, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names)
                if n.startswith(("events_", "local-", "app-")) and not n.endswith(".crc")]
    return out


def events(path):
    """Event-log lines; rolled files and zstd compression (Spark's default
    codec for event logs) are handled."""
    for f in _files(path):
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8").splitlines():
            if line.strip():
                yield json.loads(line)


def main():
    jobs, group_of_stage, agg = {}, {}, defaultdict(lambda: defaultdict(float))
    for e in events(sys.argv[1]):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            g = props.get("spark.jobGroup.id", "-")
            jobs[e["Job ID"]] = [g, e["Submission Time"], None]
            for sid in e.get("Stage IDs", []):
                group_of_stage[sid] = g
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][2] = e["Completion Time"]
        elif kind == "SparkListenerTaskEnd":
            g = group_of_stage.get(e["Stage ID"], "-")
            m = e.get("Task Metrics") or {}
            a = agg[g]
            a["tasks"] += 1
            a["task_ms"] += m.get("Executor Run Time", 0)
            a["shuffle_read_mb"] += (m.get("Shuffle Read Metrics", {}).get("Remote Bytes Read", 0)
                                     + m.get("Shuffle Read Metrics", {}).get("Local Bytes Read", 0)) / 1e6
            a["shuffle_write_mb"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 1e6
            a["spill_mb"] += m.get("Disk Bytes Spilled", 0) / 1e6
    for g, s, t in jobs.values():
        if t is not None:
            agg[g]["job_wall_ms"] += t - s
            agg[g]["jobs"] += 1
    print(f"{'group':32s} {'jobs':>5s} {'job_wall_s':>10s} {'tasks':>6s} {'task_s':>8s} "
          f"{'shuf_rd_MB':>10s} {'shuf_wr_MB':>10s} {'spill_MB':>8s}")
    for g, a in sorted(agg.items()):
        print(f"{g:32s} {int(a['jobs']):5d} {a['job_wall_ms'] / 1000:10.2f} {int(a['tasks']):6d} "
              f"{a['task_ms'] / 1000:8.2f} {a['shuffle_read_mb']:10.2f} {a['shuffle_write_mb']:10.2f} "
              f"{a['spill_mb']:8.2f}")


if __name__ == "__main__":
    main()
