import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import lsh_search as L

VECTORS = "vec_id long, embedding array<float>, rank string"


def _exact(rows, k=10):
    good = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[(i, tuple(np.float32(v).tolist()))] = 1
    size = max({len(v) for _, v in good}, key=lambda n: (sum(len(v) == n for _, v in good), n)) if good else 0
    good = [(i, np.array(v, np.float64)) for i, v in good if len(v) == size]
    out = {}
    for q, x in good:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in good if i != q)[:k]
            out[q] = near
    return out


def _found(df, **kw):
    out = {}
    for r in sorted(L.nearest(df, F.col("id") % 100 == 0, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def _random(n, d=16, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(20, d))
    return [(i, (centres[i % 20] + 0.3 * r.normal(size=d)).astype(np.float32).tolist(), "x") for i in range(n)]


def test_recall_and_scores(make):
    rows = _random(3000)
    want, got = _exact(rows), _found(make(rows, VECTORS))
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    assert all(x == sorted(x) for x in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    exact = {q: dict((i, s) for s, i in x) for q, x in _exact(rows, 3000).items()}
    assert all(s == pytest.approx(exact[q][i], rel=1e-12) for q, x in got.items() for s, i in x)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_given_vectors(spark, sf):
    path = f"/root/testdata/{sf}"
    df = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding")
    want, got = _exact([tuple(r) for r in df.collect()]), {}
    for r in L.op5_nearest(spark, path).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_copies_ties_and_odd_rows(make, monkeypatch):
    one = [1.0, 0.0, 2.0]
    rows = [(i, one, "x") for i in range(0, 400)] + [(1000 + i, [1.0, 0.0, 2.0 + 0.01 * i], "x") for i in range(1, 30)]
    rows += [(None, one, "x"), (5000, None, "x"), (5100, [0.0] * 3, "x"), (5200, [1.0, None, 1.0], "x"), (5300, [1.0, float("nan"), 1.0], "x"),
             (5400, [1.0, float("inf"), 1.0], "x"), (5500, [1.0, 2.0], "x"), (5600, [], "x"), (100, one, "x"), (7, one, "x"), (2000, [1.0, 0.0, 2.005], "x")]
    monkeypatch.setattr(L, "CHUNK", 8)
    want, got = _exact(rows), _found(make(rows, VECTORS))
    assert got.keys() == want.keys() == {0, 100, 200, 300, 2000}
    assert [i for _, i in got[0]] == list(range(1, 11)) and [i for _, i in got[300]] == list(range(10))
    assert {q: [i for _, i in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items()}


def test_few_found_are_compared_with_all(make):
    rows = [(i, [float(i % 7 + 1) * 1000 ** (i % 3), float(i)], "x") for i in range(0, 500, 5)]
    want = _exact(rows)
    got = _found(make(rows, VECTORS), tables=1, hashes=8, probes=1)
    assert all(len(x) == 10 for x in got.values())
    assert got.keys() == want.keys()


def test_small_tables(make):
    assert _found(make([], VECTORS)) == {}
    rows = [(0, [1.0, 2.0], "x"), (1, [1.0, 3.0], "x")]
    assert _found(make(rows, VECTORS)) == {0: [(1.0, 1)]}
    assert _found(make(rows[:1], VECTORS)) == {}


def test_lengths_are_searched_apart(make):
    rows = [(i, [float(i % 9), 1.0 + i], "x") for i in range(0, 300, 10)] + [(1000 + i, [1.0, float(i), 3.0], "x") for i in range(0, 300, 10)]
    got = _found(make(rows, VECTORS))
    assert got.keys() == {0, 100, 200, 1000, 1100, 1200}
    assert all((i >= 1000) == (q >= 1000) for q, x in got.items() for _, i in x) and all(len(x) == 10 for x in got.values())


def test_probes_come_in_order():
    h = L.Hashes(4, 1.0, tables=1, hashes=4, probes=30)
    place = np.array([0.1, 0.45, 0.8, 0.3])
    cost = [sum(place[i] ** 2 if d < 0 else (1 - place[i]) ** 2 for i, d in c) for c in h._changes(place)]
    assert cost == sorted(cost) and len(cost) == 30 and cost[0] == 0
    every = sorted(sum(place[i] ** 2 if d < 0 else (1 - place[i]) ** 2 for i, d in enumerate(c) if d)
                   for c in np.ndindex(3, 3, 3, 3) for c in [[x - 1 for x in c]])
    assert cost == pytest.approx(every[:30])
