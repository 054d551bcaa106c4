"""Resumable workflows and tables published as one commit."""

import json

import pytest
from pyspark.sql import functions as F

from churnlens.plans import workflows as W
from churnlens.plans.feature_job import publish_features
from churnlens.plans.ledger import Ledger, Step, path_state, run_steps
from churnlens.plans.registry import cleaned
from churnlens.session import scratch_path
from churnlens.sources import table_sets as P
from churnlens.sources import write_parquet

from .conftest import SF001


def counting(spark, root, fail=()):
    """Two steps over numbers that note their runs and can break."""
    runs = []

    def step(name, source, target, n):
        def run(s):
            runs.append(name)
            write_parquet(s.read.parquet(source).filter(F.col("id") < n), target)
            if name in fail:
                raise RuntimeError("broken")
        return Step(name, run, [source], [target], {"n": n})
    write_parquet(spark.range(100), f"{root}/in", "overwrite")
    return runs, [step("a", f"{root}/in", f"{root}/a", 50), step("b", f"{root}/a", f"{root}/b", 20)]


def done(steps):
    return [(name, what) for name, what, _ in steps]


def test_a_rerun_goes_on_after_the_last_finished_step(spark):
    root = scratch_path(spark, "wf")
    runs, steps = counting(spark, root)
    assert done(run_steps(spark, steps, f"{root}/ledger", until="a")) == [("a", "ran")]
    assert done(run_steps(spark, steps, f"{root}/ledger")) == [("a", "kept"), ("b", "ran")]
    assert done(run_steps(spark, steps, f"{root}/ledger")) == [("a", "kept"), ("b", "kept")]
    assert runs == ["a", "b"] and spark.read.parquet(f"{root}/b").count() == 20
    states = Ledger(spark, f"{root}/ledger").records().orderBy("seq").select("step", "state").collect()
    assert [tuple(r) for r in states] == [("a", "started"), ("a", "done"), ("b", "started"), ("b", "done")]
    with pytest.raises(ValueError):
        run_steps(spark, steps, f"{root}/ledger", until="c")


def test_changes_run_what_depends_on_them(spark):
    root = scratch_path(spark, "wf")
    runs, steps = counting(spark, root)
    run_steps(spark, steps, f"{root}/ledger")
    write_parquet(spark.range(10), f"{root}/in", "append")  # another input
    assert done(run_steps(spark, steps, f"{root}/ledger")) == [("a", "ran"), ("b", "ran")]
    write_parquet(spark.range(1), f"{root}/b", "append")  # someone touched an output
    assert done(run_steps(spark, steps, f"{root}/ledger")) == [("a", "kept"), ("b", "ran")]
    assert spark.read.parquet(f"{root}/b").count() == 30
    other = [steps[0], Step("b", steps[1].run, steps[1].inputs, steps[1].outputs, {"n": 21})]  # another setting
    assert done(run_steps(spark, other, f"{root}/ledger")) == [("a", "kept"), ("b", "ran")]


def test_what_a_broken_attempt_left_goes_and_nothing_else(spark):
    root = scratch_path(spark, "wf")
    broken = ["b"]
    runs, steps = counting(spark, root, broken)
    with pytest.raises(RuntimeError):
        run_steps(spark, steps, f"{root}/ledger")
    last = Ledger(spark, f"{root}/ledger").last("b")
    assert last["state"] == "failed" and "broken" in last["note"]
    broken.clear()
    assert done(run_steps(spark, steps, f"{root}/ledger")) == [("a", "kept"), ("b", "ran")]
    # an output that the ledger does not know is refused, not replaced
    root = scratch_path(spark, "wf")
    runs, steps = counting(spark, root)
    write_parquet(spark.range(3), f"{root}/a")
    with pytest.raises(Exception, match="(?i)exists"):
        run_steps(spark, steps, f"{root}/ledger")
    assert spark.read.parquet(f"{root}/a").count() == 3


def test_path_state_sees_files_not_order(spark):
    root = scratch_path(spark, "state")
    assert path_state(spark, root) == "none"
    write_parquet(spark.range(10).repartition(3), root)
    one = path_state(spark, root)
    assert one == path_state(spark, root + "/") and one.startswith("3 files")
    write_parquet(spark.range(1), root, "append")
    assert path_state(spark, root) != one


def test_interrupted_training_workflow_equals_an_unbroken_run(spark):
    root = scratch_path(spark, "train-wf")
    write_parquet(cleaned(spark, SF001), f"{root}/cleaned")
    publish_features(spark, f"{root}/cleaned", f"{root}/set")
    paths = P.published(spark, f"{root}/set")
    args = (spark, paths["train"], paths["validation"])
    assert W.train_and_evaluate(*args, f"{root}/m", ("nb", "lr"), cross_validate=False, ledger=f"{root}/l", until="evaluate nb") is None
    steps = W.training_steps(paths["train"], paths["validation"], f"{root}/m", ("nb", "lr"), cross_validate=False)
    assert done(run_steps(spark, steps, f"{root}/l", until="train lr")) == [
        ("train nb", "kept"), ("evaluate nb", "kept"), ("train lr", "ran")]
    resumed = W.train_and_evaluate(*args, f"{root}/m", ("nb", "lr"), cross_validate=False, ledger=f"{root}/l")
    whole = W.train_and_evaluate(*args, f"{root}/w", ("nb", "lr"), cross_validate=False)
    score = lambda t: {(r["Algorithm"], r["Metric"]): round(r["Score"], 9) for r in t.collect()}
    assert score(resumed) == score(whole) and len(score(whole)) == 8


def test_two_tables_are_seen_together_or_not_at_all(spark, monkeypatch):
    root = scratch_path(spark, "set")
    write_parquet(cleaned(spark, SF001), f"{root}/cleaned")
    real, written = P.write_parquet, []

    def breaks(df, path, *a):
        if len(written) % 2 == 1:
            written.append(path)
            raise RuntimeError("between the two writes")
        written.append(path)
        return real(df, path, *a)
    monkeypatch.setattr(P, "write_parquet", breaks)
    with pytest.raises(RuntimeError):
        publish_features(spark, f"{root}/cleaned", f"{root}/set")
    assert P.published(spark, f"{root}/set") == {} and P.path_exists(spark, written[0])
    monkeypatch.setattr(P, "write_parquet", real)
    assert publish_features(spark, f"{root}/cleaned", f"{root}/set") == 1
    first = P.published(spark, f"{root}/set")
    monkeypatch.setattr(P, "write_parquet", breaks)
    with pytest.raises(RuntimeError):  # a later version breaks: readers stay with the first
        publish_features(spark, f"{root}/cleaned", f"{root}/set")
    assert P.published(spark, f"{root}/set") == first and sorted(first) == ["train", "validation"]
    assert len(P.vacuum(spark, f"{root}/set")) == 2
    assert P.read_published(spark, f"{root}/set", "train").count() > 0
    with pytest.raises(ValueError):
        P.read_published(spark, f"{root}/set", "test")


def test_versions_torn_manifests_and_racing_writers(spark, monkeypatch):
    root = scratch_path(spark, "versions")
    assert P.publish(spark, root, {"t": spark.range(3)}) == 1
    keep = {k: v for k, v in P.manifests(spark, root)[1].items()}
    assert P.publish(spark, root, {"u": spark.range(4)}, keep=keep) == 2
    assert P.read_published(spark, root, "t").count() == 3 and P.read_published(spark, root, "u").count() == 4
    assert sorted(P.published(spark, root, 1)) == ["t"]
    fs, p = P._fs(spark, f"{root}/manifest/00000003.json")
    stream = fs.create(p, False)
    stream.write(bytearray(json.dumps({"tables": {}}).encode()[:-1]))
    stream.close()
    assert sorted(P.published(spark, root)) == ["t", "u"]  # torn: passed over
    assert P.publish(spark, root, {"t": spark.range(5)}) == 4
    monkeypatch.setattr(P, "_children", lambda s, path: [])  # this writer has not seen the others
    with pytest.raises(Exception, match="(?i)exist"):
        P.commit(spark, root, {"t": "x"})


def test_the_feature_job_shows_both_tables_or_neither(spark, monkeypatch):
    from churnlens.plans.feature_job import run_features

    root = scratch_path(spark, "together")
    write_parquet(cleaned(spark, SF001), f"{root}/cleaned")
    paths = [f"{root}/{n}" for n in ("train", "validation")]
    real, calls = P.write_parquet, []

    def breaks(df, path, *a):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("between the two writes")
        return real(df, path, *a)
    monkeypatch.setattr(P, "write_parquet", breaks)
    with pytest.raises(RuntimeError):
        run_features(spark, f"{root}/cleaned", *paths)
    assert P._children(spark, root) == ["cleaned"]
    monkeypatch.setattr(P, "write_parquet", real)
    run_features(spark, f"{root}/cleaned", *paths)
    rows = [spark.read.parquet(p).count() for p in paths]
    calls.clear()
    monkeypatch.setattr(P, "write_parquet", breaks)
    with pytest.raises(RuntimeError):  # the old tables stay
        run_features(spark, f"{root}/cleaned", *paths, mode="overwrite")
    monkeypatch.setattr(P, "write_parquet", real)
    move, n = P._move, []

    def stuck(s, source, target, moved):
        n.append(source)
        if len(n) == 4:
            raise OSError("stuck")
        return move(s, source, target, moved)
    monkeypatch.setattr(P, "_move", stuck)
    with pytest.raises(OSError):  # the second table cannot be moved: the first one goes back
        run_features(spark, f"{root}/cleaned", *paths, mode="overwrite")
    monkeypatch.setattr(P, "_move", move)
    assert [spark.read.parquet(p).count() for p in paths] == rows
    with pytest.raises(FileExistsError):
        run_features(spark, f"{root}/cleaned", *paths)
    run_features(spark, f"{root}/cleaned", *paths, mode="overwrite")
    assert P._children(spark, root) == ["cleaned", "train", "validation"]
    with pytest.raises(ValueError):
        P.write_together(spark, {}, "append")
