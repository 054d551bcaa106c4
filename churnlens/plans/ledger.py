"""Resumable workflows: steps with a ledger of what was done.

A ``Step`` names its inputs, its outputs and the settings its result depends on. ``run_steps``
goes through the steps in order and writes a record to the ledger table when one starts,
ends or fails. A step is kept, not run again, when its last record says done, its key (settings
and the state of its inputs) is the same and its outputs are as they were written. So a
rerun goes on after the last finished step; a changed input or output runs its step again and,
as that changes the outputs, the steps that read them.

The state of a path is an aggregate over its files' names, sizes and times, listed by Spark; no
file is opened. What a broken attempt left is deleted before the next one; an output that the
ledger knows nothing of is never deleted (the step's own sink refuses it).
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.session import drop_path
from churnlens.sources.table_sets import path_exists

RECORD = "seq long, step string, state string, key string, outputs string, result string, note string, at timestamp"


@dataclass(frozen=True)
class Step:
    name: str
    run: Callable[[SparkSession], object]
    inputs: Sequence[str]
    outputs: Sequence[str]
    settings: dict = field(default_factory=dict)


def path_state(spark: SparkSession, path: str) -> str:
    """Number, bytes and a hash of names, sizes and times of the files below a path."""
    if not path_exists(spark, path):
        return "none"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.slice(F.reverse(F.split("path", "/")), 1, 3).alias("name"), "length", "modificationTime"))
    one = F.xxhash64("name", "length", "modificationTime")
    n, size, xor, total = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.bit_xor(one), F.lit(0)),
                                    F.coalesce(F.sum(one.cast("decimal(20,0)")), F.lit(0))).first()
    return f"{n} files, {size} bytes, {xor & (1 << 64) - 1:016x}{int(total) & (1 << 64) - 1:016x}"


class Ledger:
    """An append-only table of step records."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def records(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], RECORD)
        return self.spark.read.schema(RECORD).json(self.path)

    def latest(self) -> DataFrame:
        """The last record of every step."""
        newest = Window.partitionBy("step").orderBy(F.desc("seq"))  # a few records a step
        return self.records().withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")

    def last(self, step: str) -> Row | None:
        return self.records().filter(F.col("step") == step).orderBy(F.desc("seq")).first()

    def add(self, step: str, state: str, key: str, outputs: Sequence[str], result: str = "", note: str = "") -> None:
        seq = (self.records().agg(F.max("seq")).first()[0] or 0) + 1
        row = (seq, step, state, key, json.dumps(list(outputs)), result, note[:500])
        (self.spark.createDataFrame([row], RECORD.rsplit(",", 1)[0]).withColumn("at", F.current_timestamp())
         .coalesce(1).write.mode("append").json(self.path))


def _key(spark: SparkSession, step: Step) -> str:
    seen = {p: path_state(spark, p) for p in step.inputs}
    return hashlib.sha256(json.dumps([step.name, step.settings, seen, list(step.outputs)], sort_keys=True).encode()).hexdigest()


def _result(spark: SparkSession, step: Step) -> str:
    return json.dumps([path_state(spark, p) for p in step.outputs])


def run_steps(spark: SparkSession, steps: Sequence[Step], ledger_path: str, *,
              until: str | None = None) -> list[tuple[str, str, float]]:
    """Run what is not done yet, to the end or to the step ``until``: (step, 'ran' or
    'kept', seconds) of each step passed."""
    if until is not None and until not in [s.name for s in steps]:
        raise ValueError(f"no step {until!r}; the steps are {[s.name for s in steps]}")
    ledger, out = Ledger(spark, ledger_path), []
    for step in steps:
        begin, key, last = time.monotonic(), _key(spark, step), ledger.last(step.name)
        if last and last["state"] == "done" and last["key"] == key and last["result"] == _result(spark, step):
            out.append((step.name, "kept", time.monotonic() - begin))
        else:
            for path in set(json.loads(last["outputs"]) if last else []) & set(step.outputs):
                drop_path(spark, path)  # a broken or outdated attempt's
            ledger.add(step.name, "started", key, step.outputs)
            try:
                step.run(spark)
            except Exception as e:
                ledger.add(step.name, "failed", key, step.outputs, note=f"{type(e).__name__}: {e}")
                raise
            ledger.add(step.name, "done", key, step.outputs, _result(spark, step))
            out.append((step.name, "ran", time.monotonic() - begin))
        if step.name == until:
            break
    return out
