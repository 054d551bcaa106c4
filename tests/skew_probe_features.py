"""Skew probe for the feature job: the (user, session, page) base aggregate's
shuffle with one user holding a third of the rows.

Usage: python tests/skew_probe_features.py <empty scratch dir for the event log>
"""
import sys, json, glob, os, io, zstandard
sys.path.insert(0, "/root/repo")
from pyspark.sql import functions as F
from churnlens.session import build_session
from churnlens.plans.registry import kept
from churnlens.operators.clean import with_churn
from churnlens.operators.joins import materialize
from churnlens.operators.features import base_aggregate
ev = sys.argv[1]
spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": ev})
k = kept(spark, "/root/testdata/sf0.1")
hot = k.withColumn("userId", F.when(F.pmod(F.xxhash64("ts", "itemInSession"), F.lit(3)) == 0, F.lit("hot")).otherwise(F.col("userId")))
spark.conf.set("spark.sql.adaptive.enabled", "false")
cl = materialize(with_churn(hot), "skewed-clean")
sc = spark.sparkContext
sc.setJobGroup("base", "base")
base_aggregate(cl).write.format("noop").mode("overwrite").save()
spark.stop()
lines = []
for f in glob.glob(os.path.join(ev, "**", "events_*"), recursive=True):
    raw = open(f, "rb").read()
    if f.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    lines += raw.decode().splitlines()
stage_job, tasks = {}, {}
for l in lines:
    e = json.loads(l)
    if e.get("Event") == "SparkListenerJobStart":
        for sid in e["Stage IDs"]:
            stage_job[sid] = e.get("Properties", {}).get("spark.jobGroup.id")
    if e.get("Event") == "SparkListenerTaskEnd":
        m = e.get("Task Metrics") or {}
        tasks.setdefault(e["Stage ID"], []).append(((m.get("Input Metrics") or {}).get("Records Read", 0),
            (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0),
            (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)))
for sid, ts in sorted(tasks.items()):
    if stage_job.get(sid) == "base":
        print("stage", sid, "tasks", len(ts), "input", sum(t[0] for t in ts), "shuffle written", sum(t[1] for t in ts),
              "read per task", sorted((t[2] for t in ts), reverse=True))
