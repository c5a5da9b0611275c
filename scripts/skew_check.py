"""Skew experiment: one key holds a third of all rows.

Runs skew-sensitive operators over a skewed copy of lineitem and reads the
Spark event log (written to a fresh scratch folder) to report, per job, the
largest task's shuffle-read records against the median task.

usage: python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from bibliospark.operators import (  # noqa: E402
    distinct_on,
    drop_all_duplicates,
    first_match_contains,
    global_prefix_sum,
    global_rank,
    global_row_number,
)
from bibliospark.session import get_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
scratch = tempfile.mkdtemp(prefix="skew-run-")
spark = get_session("local[8]", **{
    "spark.sql.shuffle.partitions": "32", "spark.ui.showConsoleProgress": "false",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch,
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
    "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
})
li = spark.read.parquet(f"{sf}/lineitem.parquet")
# a third of the rows share one order key / one quantity value
hot = F.xxhash64("l_orderkey", "l_linenumber", "l_partkey") % 3 == 0
skewed = li.withColumn("l_orderkey", F.when(hot, F.lit(1)).otherwise(F.col("l_orderkey"))) \
           .withColumn("l_quantity", F.when(hot, F.lit(7.0)).otherwise(F.col("l_quantity")))

runs = {
    "distinct_on(hot key)": lambda: distinct_on(skewed, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]),
    "drop_all_duplicates(hot group)": lambda: drop_all_duplicates(
        skewed.select("l_orderkey", "l_returnflag", "l_partkey"), exclude=["l_partkey"]),
    "global_rank(hot value)": lambda: global_rank(skewed.select("l_partkey", "l_quantity"),
                                                  [("l_quantity", "desc_nulls_first")], "r"),
    "global_row_number": lambda: global_row_number(skewed.select("l_orderkey", "l_linenumber", "l_partkey"),
                                                   ["l_orderkey", "l_linenumber", "l_partkey"], "rn"),
    "global_prefix_sum": lambda: global_prefix_sum(skewed.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"),
                                                   ["l_orderkey", "l_linenumber", "l_partkey"], "l_quantity", "before"),
    "first_match_contains(hot name)": lambda: first_match_contains(
        skewed.select(F.concat(F.lit("S"), (F.col("l_orderkey") % 997).cast("string")).alias("sur"),
                      F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("giv")),
        skewed.select(F.col("l_partkey").alias("author_id"),
                      F.concat(F.lit("S"), (F.col("l_orderkey") % 997).cast("string")).alias("bs"),
                      F.concat(F.lit("G"), F.col("l_partkey").cast("string"), F.lit("x")).alias("bg")),
        [("sur", "bs"), ("giv", "bg")], "author_id"),
}
marks = {}
for name, fn in runs.items():
    spark.sparkContext.setJobGroup(name, name)
    fn().write.format("noop").mode("overwrite").save()
spark.stop()

# ---- read the event log: per job group, per stage, task shuffle-read records
log = [p for p in glob.glob(os.path.join(scratch, "**", "*"), recursive=True)
       if os.path.isfile(p) and "ckpt" not in p and not p.endswith(".crc")][0]
stage_group, tasks = {}, {}
for line in open(log):
    e = json.loads(line)
    ev = e.get("Event")
    if ev == "SparkListenerJobStart":
        grp = (e.get("Properties") or {}).get("spark.jobGroup.id")
        for sid in e.get("Stage IDs", []):
            stage_group[sid] = grp
    elif ev == "SparkListenerTaskEnd":
        m = e.get("Task Metrics") or {}
        rd = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
        tasks.setdefault(e["Stage ID"], []).append(rd)
report = {}
for sid, recs in tasks.items():
    grp = stage_group.get(sid)
    if grp is None or sum(recs) == 0:
        continue
    # per job group: the stage that shuffles the most records
    if sum(recs) > report.get(grp, (0,))[0]:
        report[grp] = (sum(recs), max(recs), statistics.median(recs), len(recs))
print(f"event log: {log}")
print("heaviest shuffle stage per operator: worst task's share of the stage's records (ideal 1/tasks)")
for grp, (total, worst, med, n) in report.items():
    print(f"{grp:36s} {worst / total:6.1%}  ({worst} of {total} records, median {med:.0f}, {n} tasks)")
