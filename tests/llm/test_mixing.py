from collections import Counter

import pytest

from churnlens.llm.mixing import mix, plan_mix, _sized

from .conftest import doc, prose


def _fill(sizes, weights, cap=3):
    """Water-filling by hand: clamp and reshare until none is above."""
    total, full = sum(sizes), set()
    while True:
        rest = total - sum(cap * sizes[i] for i in full)
        open_ = sum(w for i, w in enumerate(weights) if i not in full)
        if not open_:
            return [cap * s for s in sizes]
        target = [cap * s if i in full else weights[i] * rest / open_ for i, s in enumerate(sizes)]
        above = {i for i, t in enumerate(target) if t > cap * sizes[i]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000, 5, 700], [1, 1, 1000], [0, 50, 50, 50, 50, 1], [500]])
def test_targets(make, sizes):
    df = make([doc(i, " ".join(["w"] * n), f"s{i}") for i, n in enumerate(sizes)])
    plan = plan_mix(_sized(df, "text", "doc_id", "source", 1))
    got = {r["__source"]: r.target for r in plan.collect()}
    want = _fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert got == pytest.approx({f"s{i}": t for i, t in enumerate(want)})


def test_taken_is_near_target_and_reruns_agree(make):
    rows = [doc(i, prose(i, 20 + i % 50), "abcd"[i % 4] if i % 3 else "a") for i in range(600)] + [doc(None, "x y", None), doc(9001, None), doc(9002, "")]
    df = make(rows)
    plan = {r["__source"]: r.target for r in plan_mix(_sized(df, "text", "doc_id", "source", 17)).collect()}
    first, second = ([tuple(r) for r in mix(x).collect()] for x in (df, df.repartition(7)))
    assert sorted(first, key=repr) == sorted(second, key=repr)
    taken = {}
    for r in first:
        taken[r[3]] = taken.get(r[3], 0) + len(r[1].split())
    for s, t in plan.items():
        assert abs(taken.get(s, 0) - t) <= 40
    assert max(first.count(r) for r in first) <= 3
    assert not {9001, 9002} & {r[0] for r in first}


def test_extra_columns_stay(make):
    df = make([doc(1, "a b c")] * 4 + [doc(2, prose(2))]).withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "target")
    assert mix(df).columns == df.columns
    assert mix(make([])).collect() == []


def taken_words(docs, **kw):
    out = {}
    for r in mix(docs, **kw).collect():
        out[r["source"]] = out.get(r["source"], 0) + len(r["text"].split())
    return out


def test_a_source_of_equal_rows_meets_its_target(make):
    """1000 rows alike in everything: as many are taken as the target asks for."""
    rows = [doc(1, prose(1, 50), "a")] * 1000 + [doc(5000 + i, prose(i, 25), "b") for i in range(1000)]
    df = make(rows).repartition(6)
    target = {r["__source"]: r.target for r in plan_mix(_sized(df, "text", "doc_id", "source", 17)).collect()}
    got = taken_words(df)
    assert abs(got["a"] - target["a"]) <= 25 and abs(got["b"] - target["b"]) <= 13
    assert got == taken_words(df.repartition(3))


def test_rows_without_id_are_a_sample_that_does_not_see_their_size(make):
    rows = [doc(None, prose(i, 1 + i % 100), "a") for i in range(1000)] + [doc(5000 + i, prose(i, 20), "b") for i in range(4000)]
    out = mix(make(rows)).filter("source = 'a'").collect()
    size = [len(r["text"].split()) for r in out]
    short, long = sum(n <= 50 for n in size) / 500, sum(n > 50 for n in size) / 500
    assert 1.2 < short < 3 and abs(short - long) / long < 0.05


@pytest.mark.parametrize("epochs", [1, 2, 5])
def test_any_number_of_epochs(make, epochs):
    rows = [doc(i, prose(i, 30), "a") for i in range(60)] + [doc(500 + i, prose(i, 30), "b") for i in range(600)]
    df = make(rows)
    plan = {r["__source"]: r for r in plan_mix(_sized(df, "text", "doc_id", "source", 17), max_epochs=epochs).collect()}
    got = taken_words(df, max_epochs=epochs)
    for s, r in plan.items():
        assert abs(got[s] - r.target) <= 15 and got[s] <= epochs * r.source_size
    assert max(Counter(tuple(r) for r in mix(df, max_epochs=epochs).collect()).values()) <= epochs


def test_any_column_name_stays_and_long_texts(make):
    names = ["__source", "__whole", "__size", "__key", "__copies", "__copy", "__from", "__cut", "a.b", "row", "__nth", "__part"]
    df = make([doc(1, "word " * 300_000), *[doc(2, "a b")] * 50, doc(3, None)]).selectExpr("*", *[f"'{i}' AS `{n}`" for i, n in enumerate(names)])
    out = mix(df)
    assert out.columns == df.columns and all(list(r)[5:] == [str(i) for i in range(len(names))] for r in out.collect())
