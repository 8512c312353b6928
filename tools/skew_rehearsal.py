"""Skew rehearsal: how evenly do the hot-key plans spread a key that holds a
third of all rows?

One user of ``events`` is given a third of the rows; SCD2 and a left join
onto that skewed side are run twice, with splitting disabled and with a
scaled-down split threshold.  Per-task shuffle-read records of each job's
largest stage are taken from Spark's event log (written to a scratch folder)
and the largest task's share of its stage is printed.

    python tools/skew_rehearsal.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def stage_task_records(log_dir: str) -> dict[tuple[str, int], list[int]]:
    """(job group, stage id) -> shuffle records read per finished task."""
    out: dict[tuple[str, int], list[int]] = defaultdict(list)
    group_of_stage: dict[int, str] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith(("appstatus", ".")):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for sid in ev.get("Stage IDs", []):
                        group_of_stage[sid] = group
                elif kind == "SparkListenerTaskEnd" and ev.get("Task End Reason", {}).get("Reason") == "Success":
                    metrics = ev.get("Task Metrics") or {}
                    read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    sid = ev["Stage ID"]
                    out[(group_of_stage.get(sid, ""), sid)].append(read)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="skew-rehearsal-")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logs)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from strata.operators.scd2 import build_scd2
    from strata.operators.skew import skew_left_join
    from strata.plans.catalogue import events_bronze, read

    bronze = events_bronze(spark, sf_dir)
    skewed = bronze.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    total = skewed.count()
    rows_per_task = max(1000, total // 64)
    sc = spark.sparkContext
    for label, rpb in (("scd2_plain", 10**12), ("scd2_split", rows_per_task)):
        sc.setJobGroup(label, label)
        hist, _ = build_scd2(skewed, ["user_id"], "ts", rows_per_bucket=rpb)
        hist.write.format("noop").mode("overwrite").save()
    users = read(spark, sf_dir, "events").select("user_id").distinct()
    for label, rpt in (("join_plain", 10**12), ("join_salted", rows_per_task)):
        sc.setJobGroup(label, label)
        joined = skew_left_join(users, skewed.select(F.col("user_id").alias("u"), "event_id"), [("user_id", "u")], rpt)
        joined.write.format("noop").mode("overwrite").save()
    spark.stop()

    by_stage = stage_task_records(logs)
    print(f"rows={total}, hot key rows={total // 3} (approx), split threshold={rows_per_task}")
    for label in ("scd2_plain", "scd2_split", "join_plain", "join_salted"):
        stages = {sid: recs for (g, sid), recs in by_stage.items() if g == label and sum(recs) > 0}
        sid, recs = max(stages.items(), key=lambda kv: sum(kv[1]))
        share = max(recs) / sum(recs)
        print(f"{label:12s} stage {sid:3d}: {len(recs):3d} tasks, largest task {max(recs):7d} of {sum(recs):7d} "
              f"shuffle records ({share:.1%})")


if __name__ == "__main__":
    main()
