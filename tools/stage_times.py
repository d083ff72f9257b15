"""Summarise stage and task times from a Spark event log folder (no UI needed).

Usage: python tools/stage_times.py <event-log-dir> [top_n]
"""

import glob
import json
import sys


def _lines(path):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"), read_across_frames=True).read()
    return [ln for ln in raw.decode().split("\n") if ln.strip()]


def main():
    root = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, tasks = {}, {}
    for f in sorted(glob.glob(root + "/*/events_*")):
        for line in _lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                stages[si["Stage ID"]] = (dur, si["Number of Tasks"], si.get("Details", "").split("\n"))
            elif ev == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
    total = sum(d for d, _, _ in stages.values())
    print(f"stages={len(stages)} sum_stage_secs={total:.1f}")
    for sid, (dur, n, det) in sorted(stages.items(), key=lambda x: -x[1][0])[:top]:
        ts = sorted(tasks.get(sid, [0]))
        where = next((d.strip() for d in det if "innflow" in d), det[0].strip() if det else "")
        print(f"stage {sid:4d} {dur:7.2f}s tasks={n:3d} max_task={ts[-1]:.2f}s med_task={ts[len(ts)//2]:.2f}s  {where[:110]}")


if __name__ == "__main__":
    main()
