"""Vector codes against a plain computation in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from churnlens.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """{row number: (vec_id, code, error, label_error)}, digest; rows: (vec_id, vector, label)."""
    good = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(good[0][1]) // parts if good else 0
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(v, p) for _, v, _ in order[:entries]] for p in range(parts)]

    def near(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return far.index(min(far)), min(far)
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in good:
                groups.setdefault(near(cut(v, p), books[p])[0], []).append(cut(v, p))
            for j, g in groups.items():
                books[p][j] = [sum(c) // len(g) for c in zip(*g)]
    out = []
    for i, v, lab in good:
        hits = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{j:02x}" for j, _ in hits), sum(f for _, f in hits)))
    labels = {}
    for _, lab, _, e in out:
        labels[lab] = labels.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted([(i, code, e, labels[lab]) for i, lab, code, e in out], key=repr), digest


def run(spark, rows, schema=SCHEMA, **kw):
    codes, books = V.encode_vectors(spark.createDataFrame(rows, schema), **kw)
    got = [tuple(r) for r in codes.select("id", "code", "error", "label_error").collect()]
    return sorted(got, key=repr), V.books_digest(books)


def vectors(n, width=8, seed=1, grid=None):
    r = random.Random(seed)
    return [[float(np.float32(r.choice(grid) if grid else r.gauss(0, 0.2))) for _ in range(width)] for _ in range(n)]


def test_walk_equals_all_distances():
    r = np.random.default_rng(3)
    for n, width, high in ((1, 4, 3), (700, 3, 2), (2500, 5, 3), (3000, 2, 60), (40, 0, 2), (1300, 1, 9), (50, 4, 2**27)):
        parts = np.unique(r.integers(-high, high, (n, width)), axis=0) if width else np.zeros((1, 0), np.int64)
        entries = r.integers(-high, high, (17, width))
        entries[5] = entries[3]  # a tie
        far = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        best, error = V.walk(parts, entries)
        assert (best == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()


def test_prefixes_are_shared(monkeypatch):
    parts = np.array([[a, b, c] for a in range(3) for b in range(4) for c in range(50)])
    made = []
    real = V._bundle
    monkeypatch.setattr(V, "_bundle", lambda p, e, d, a: made.append((len(p), d)) or real(p, e, d, a))
    monkeypatch.setattr(V, "LEAVES", 120)
    V.walk(parts, np.zeros((4, 3), np.int64))
    assert sum(n for n, _ in made) == 600 and max(n for n, _ in made) <= 120
    assert {d for _, d in made} == {1}  # entered below the shared first dimension


@pytest.mark.parametrize("grid", [None, [0.0, 0.25, -0.25, 0.001]])
def test_codes_equal_brute_force(spark, grid):
    rows = [(i, v, i % 3 if i % 7 else None) for i, v in enumerate(vectors(400, grid=grid))]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, entries=5, rounds=2, parts=2) == brute(rows, entries=5, rounds=2, parts=2)


def test_nulls_repeats_and_few_rows(spark):
    v = vectors(6)
    rows = [(1, v[0], 1), (1, v[0], 1), (1, v[1], None), (None, v[2], None), (None, v[3], 2), (7, v[4], 2),
            (8, None, 1), (9, [None] * 8, 1), (10, [float("nan")] + v[5][1:], 1), (11, [float("inf")] + v[5][1:], 1)]
    got, digest = run(spark, rows)
    assert (got, digest) == brute(rows) and len(got) == 6
    assert all(e == 0 for _, _, e, _ in got)  # every row is an entry of its own


def test_empty_table_and_empty_vectors(spark):
    assert run(spark, []) == ([], hashlib.sha256(b"").hexdigest())
    assert run(spark, [(3, None, 1)])[0] == []
    assert run(spark, [(3, [], 1), (4, [], 1)]) == brute([(3, [], 1), (4, [], 1)])


def test_bad_lengths_and_sizes_are_refused(spark):
    with pytest.raises(ValueError):
        run(spark, [(1, [0.0] * 8, 1), (2, [0.0] * 4, 1)])
    with pytest.raises(ValueError):
        run(spark, [(1, [0.0] * 6, 1)])
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e30] * 4, 1)])


def test_one_vector_and_one_label_hold_most_rows(spark):
    v = vectors(30)
    rows = [(i, v[0] if i % 3 else v[i % 30], 5 if i % 4 else i) for i in range(900)]
    spark.conf.set("spark.churnlens.maxBroadcastRows", "3")  # the labels' table through the salted join
    try:
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.churnlens.maxBroadcastRows")


def test_clashing_and_odd_column_names(spark):
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(20))]
    df = spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({"vec_id": "a.b", "label": "v"}).selectExpr(
        "*", "1 AS id", "'x' AS code", "2 AS __label", "3 AS error", "4 AS pos", "5 AS part")
    codes, books = V.encode_vectors(df, vec_id="a.b", label="v")
    got = sorted([tuple(r) for r in codes.select("id", "code", "error", "label_error").collect()], key=repr)
    assert (got, V.books_digest(books)) == brute(rows)


def test_doubles_and_text_labels(spark):
    rows = [(i, v, "ab"[i % 2] if i % 5 else None) for i, v in enumerate(vectors(60))]
    got = run(spark, rows, "vec_id long, embedding array<double>, label string")
    assert got == brute(rows)


def test_partitioning_does_not_matter(spark):
    rows = [(i, v, 1) for i, v in enumerate(vectors(200, seed=9))]
    df = spark.createDataFrame(rows, SCHEMA)
    results = []
    for n in (1, 7):
        codes, books = V.encode_vectors(df.repartition(n, "vec_id"))
        results.append((sorted(map(tuple, codes.collect())), V.books_digest(books)))
    assert results[0] == results[1]
