"""Run clean -> features -> split/weights -> naive Bayes with injected task failures.

Usage: python tests/resilience_run.py <fail: 0|1> <out.json>
With fail=1 the first attempt of partition 0 of the log scan raises, so Spark
retries it (master local[4,3] allows three attempts). Prints a digest of the
results; the test compares the digests of a clean and a failing run.
"""

import hashlib
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402

from churnlens.operators.clean import clean  # noqa: E402
from churnlens.operators.ml import train  # noqa: E402
from churnlens.plans.feature_job import feature_table, weighted_split  # noqa: E402
from churnlens.session import build_session  # noqa: E402
from churnlens.sources import events_as_event_log  # noqa: E402


FAIL = sys.argv[1] == "1"


def flaky(batches):
    ctx = TaskContext.get()
    if FAIL and ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task loss")
    yield from batches


def _norm(v):
    # float sums may differ in the last bits with shuffle fetch order, failure or not
    return round(v, 9) if isinstance(v, float) else v


def digest(rows) -> str:
    return hashlib.sha256(json.dumps(sorted(str(tuple(_norm(v) for v in r)) for r in rows)).encode()).hexdigest()


def main() -> None:
    out = sys.argv[2]
    spark = build_session(master="local[4,3]", shuffle_partitions=4)
    raw = events_as_event_log(spark, "/root/testdata/sf0.01")
    raw = raw.repartition(4).mapInPandas(flaky, raw.schema)  # same shape in both runs
    cleaned = clean(raw)
    train_df, validation = weighted_split(feature_table(cleaned))
    pred = train(train_df, "nb").transform(validation)
    res = {
        "cleaned": digest(cleaned.collect()),
        "train": digest(train_df.drop("pref_user_system_ohe").collect()),
        "validation": digest(validation.drop("pref_user_system_ohe").collect()),
        "predictions": digest(pred.select("userId", "prediction").collect()),
    }
    with open(out, "w") as f:
        json.dump(res, f)
    spark.stop()


if __name__ == "__main__":
    main()
