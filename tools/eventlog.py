"""Summarise a Spark event log: per job, wall time and its stages' task time.

Usage: FLEETVOLT_EVENT_LOG=/tmp/run-x/events python bench.py ; python tools/eventlog.py /tmp/run-x/events
"""

import glob
import json
import os
import sys


def main():
    files = [p for p in glob.glob(os.path.join(sys.argv[1], "**", "*"), recursive=True)
             if os.path.isfile(p) and "appstatus" not in os.path.basename(p)]
    for path in sorted(files):
        jobs, stages = {}, {}
        if path.endswith(".zstd"):
            import io

            import zstandard
            f = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
        else:
            f = open(path, encoding="utf-8")
        with f:
            for line in f:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"]}
                elif ev == "SparkListenerJobEnd":
                    jobs[e["Job ID"]]["end"] = e["Completion Time"]
                elif ev == "SparkListenerTaskEnd":
                    s = stages.setdefault(e["Stage ID"], {"tasks": 0, "run_ms": 0})
                    s["tasks"] += 1
                    s["run_ms"] += e.get("Task Metrics", {}).get("Executor Run Time", 0)
        print(os.path.basename(path))
        for j, v in sorted(jobs.items()):
            st = [stages.get(s, {"tasks": 0, "run_ms": 0}) for s in v["stages"]]
            print(f"  job {j}: {v.get('end', v['start']) - v['start']} ms wall, "
                  f"{sum(x['tasks'] for x in st)} tasks, {sum(x['run_ms'] for x in st)} ms task time")


if __name__ == "__main__":
    main()
