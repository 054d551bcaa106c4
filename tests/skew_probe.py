"""Skew probe: one user holds a third of the rows; compare per-task shuffle reads.

Usage: python tests/skew_probe.py <empty scratch dir for the event log>
Runs the per-user window form of the churn label and the salted join path
(``with_churn(max_rows=0)``) with AQE off, then reads Spark's event log.
"""
import sys, json, glob, os
sys.path.insert(0, "/root/repo")
from pyspark.sql import functions as F, Window
from churnlens.session import build_session
from churnlens.plans.registry import kept
from churnlens.operators.clean import with_churn
from churnlens.operators.joins import materialize
from churnlens.schema import CANCEL_PAGE
ev = sys.argv[1]
spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": ev,
                             "spark.sql.adaptive.enabled": "false"})
k = kept(spark, "/root/testdata/sf0.1")
hot = k.withColumn("userId", F.when(F.pmod(F.xxhash64("ts", "itemInSession"), F.lit(3)) == 0, F.lit("hot")).otherwise(F.col("userId")))
spark.conf.set("spark.sql.adaptive.enabled", "false")
hot = materialize(hot, "skewed-log")
print("rows", hot.count(), "hot rows", hot.filter("userId = 'hot'").count())
sc = spark.sparkContext
sc.setJobGroup("window", "window")
w = hot.withColumn("churn", F.sum(F.when(F.col("page") == CANCEL_PAGE, 1).otherwise(0)).over(Window.partitionBy("userId")))
w.write.format("noop").mode("overwrite").save()
sc.setJobGroup("salted", "salted")
with_churn(hot, max_rows=0).write.format("noop").mode("overwrite").save()
spark.stop()
# per stage: shuffle records read per task
logfs = sorted(glob.glob(os.path.join(ev, "**", "events_*"), recursive=True))
stages, group_of_job, stage_job = {}, {}, {}
import io, zstandard
def read_lines(f):
    raw = open(f, "rb").read()
    if f.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8").splitlines()
lines = [l for f in logfs for l in read_lines(f)]
tasks = {}
for line in lines:
    e = json.loads(line)
    t = e.get("Event")
    if t == "SparkListenerJobStart":
        g = e.get("Properties", {}).get("spark.jobGroup.id")
        for sid in e["Stage IDs"]:
            stage_job[sid] = g
    if t == "SparkListenerTaskEnd":
        m = e.get("Task Metrics") or {}
        r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
        wr = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
        inp = (m.get("Input Metrics") or {}).get("Records Read", 0)
        tasks.setdefault(e["Stage ID"], []).append((inp, r, wr, e["Task Info"]["Finish Time"] - e["Task Info"]["Launch Time"]))
for sid, ts in sorted(tasks.items()):
    g = stage_job.get(sid)
    if g in ("window", "salted"):
        reads = [t[1] for t in ts]
        print(g, "stage", sid, "tasks", len(ts), "input", sum(t[0] for t in ts), "shuffle-read per task", sorted(reads, reverse=True)[:8], "written", sum(t[2] for t in ts))
