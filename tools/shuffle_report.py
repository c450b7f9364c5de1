"""Per-query input, shuffle and task counts of the headline queries, read
from Spark's event log (written to a fresh scratch folder).
Usage: python tools/shuffle_report.py [sf_dir] > SHUFFLE.md"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from affinity.plans.catalog import registry  # noqa: E402
from affinity.session import build_session  # noqa: E402
from bench import HEADLINE  # noqa: E402

METRICS = {
    "internal.metrics.input.bytesRead": "input",
    "internal.metrics.shuffle.write.bytesWritten": "shuffle_write",
    "internal.metrics.shuffle.write.recordsWritten": "shuffle_records",
}


def mb(x: float) -> str:
    return f"{x / 2**20:.2f}"


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="affinity-events-")
    spark = build_session(shuffle_partitions=16, extra={"spark.eventLog.enabled": "true",
                                                        "spark.eventLog.dir": logdir})
    reg = registry()
    for name in HEADLINE:
        spark.sparkContext.setJobGroup(name, name)
        reg[name](spark, sf).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("", "")
    spark.stop()

    stage_group, totals = {}, {n: {"stages": 0, "tasks": 0, "input": 0, "shuffle_write": 0,
                                   "shuffle_records": 0} for n in HEADLINE}
    for path in glob.glob(os.path.join(logdir, "**", "events_*"), recursive=True):
        raw = open(path, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if path.endswith(".zstd") else raw
        with io.TextIOWrapper(stream, encoding="utf-8") as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = stage_group.get(info["Stage ID"])
                    if group not in totals:
                        continue
                    t = totals[group]
                    t["stages"] += 1
                    t["tasks"] += info.get("Number of Tasks", 0)
                    for acc in info.get("Accumulables", []):
                        key = METRICS.get(acc.get("Name"))
                        if key:
                            t[key] += int(acc.get("Value", 0))
    print(f"# Shuffle report ({os.path.basename(sf)}, local[8], from the event log)\n")
    print("Generated by `python tools/shuffle_report.py`. One session runs the headline queries in "
          "order, so later queries read the persisted index and unit tables instead of parquet; "
          "model queries include their fit jobs.  Skipped stages (reused shuffles) are not counted.\n")
    print("| query | stages | tasks | input MB | shuffle write MB | shuffle records |")
    print("| --- | --- | --- | --- | --- | --- |")
    for n in HEADLINE:
        t = totals[n]
        print(f"| {n} | {t['stages']} | {t['tasks']} | {mb(t['input'])} | {mb(t['shuffle_write'])} | "
              f"{t['shuffle_records']:,} |")


if __name__ == "__main__":
    main()
