import random

import numpy as np
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from churnlens.llm import simhash as S
from churnlens.llm.components import components

from .conftest import doc, prose


def _fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
    h = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(fps, bits=3):
    root = {f: f for f in fps}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    f = np.array(sorted(fps), np.uint64)
    for a in range(len(f)):
        for b in np.flatnonzero(np.bitwise_count(f[a] ^ f) <= bits):
            x, y = sorted((find(int(f[a])), find(int(f[b]))))
            root[y] = x
    return {x: find(x) for x in fps}


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _linked(spark, fps, bits=3):
    nodes = spark.createDataFrame([(_signed(f),) for f in fps], "fp long")
    stars = {r.a % 2**64: r.b % 2**64 for r in components(S.near_links(nodes, bits)).collect()}
    groups = {}
    for f in fps:
        groups.setdefault(stars.get(f, f), set()).add(f)
    return {frozenset(g) for g in groups.values()}


def _wanted(fps, bits=3):
    groups = {}
    for f, r in _classes(fps, bits).items():
        groups.setdefault(r, set()).add(f)
    return {frozenset(g) for g in groups.values()}


def test_fingerprints():
    for t in [None, "", " \n", "One", "one two", "A b C", "a b c d", prose(1), "é\u3000ß x\x0by z", prose(2, 70_000)]:
        assert S.fingerprint(t) % 2**64 == _fingerprint(t)


def _flipped(r, f, n):
    for b in r.sample(range(64), n):
        f ^= 1 << b
    return f


def test_links_equal_brute_force(spark):
    r = random.Random(4)
    fps = {0, 2**64 - 1, 7, 15, 1 << 63}
    for _ in range(60):
        f = r.getrandbits(64)
        fps |= {f} | {_flipped(r, f, r.randint(1, 4)) for _ in range(r.randint(0, 4))}
    for _ in range(3):  # chains: ends far apart
        f = r.getrandbits(64)
        for _ in range(15):
            fps.add(f)
            f = _flipped(r, f, 3)
    assert _linked(spark, fps) == _wanted(fps)
    assert _linked(spark, fps, 1) == _wanted(fps, 1)


def test_hot_cells_are_cut_and_exact(spark, monkeypatch):
    r = random.Random(5)
    f = r.getrandbits(64)
    fps = {_flipped(r, f, r.randint(0, 3)) for _ in range(700)} | {r.getrandbits(64) for _ in range(50)}
    monkeypatch.setattr(S, "CELL", 16)
    nodes = spark.createDataFrame([(_signed(x),) for x in fps], "fp long")
    links = S.near_links(nodes)
    assert links.count() <= 60 * len(fps)  # forests, not all pairs
    assert _linked(spark, fps) == _wanted(fps)


def test_groups_and_edges(make):
    base = prose(9, 300)
    rows = [doc(5, base), doc(3, base + " tail"), doc(8, base), doc(9, prose(10, 300)), doc(1, None), doc(2, ""), doc(4, " "),
            doc(None, prose(11)), doc(None, prose(11)), doc(9, prose(10, 300)), doc(12, base.upper())]
    df = make(rows).withColumnsRenamed({"lang": "fp", "n_chars": "component_id", "source": "t"})
    fps = {i: _fingerprint(t) for i, t, *_ in rows if i is not None}
    near = _classes(set(fps.values()))
    found, groups = S.near_groups(df)
    got = found.join(groups, "fp").select("__doc", "component_id", S.hex_fingerprint(F.col("fp")).alias("h")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["__doc"] is not None:
            assert r.h == f"{fps[r['__doc']]:016x}"
            assert r.component_id == min(i for i in fps if near[fps[i]] == near[fps[r["__doc"]]])
    kept = S.keep_one_of_each(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    want = {min(i for i in fps if near[fps[i]] == c) for c in set(near.values())}
    assert ids == sorted([*want, None], key=repr)
    assert S.keep_one_of_each(make([])).collect() == []


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    got = {x.a: x.b for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for l in links for x in l}  # noqa: E741
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {x: got.get(x, x) for x in root} == root
