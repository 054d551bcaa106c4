"""The pipeline against plain Python, stage by stage on each stage's own input."""

from collections import Counter

import corpus_pipeline as C
from churnlens.llm import quality, simhash
from churnlens.llm.mixing import MAX_EPOCHS
from churnlens.operators.joins import materialize

from .conftest import doc, prose
from .test_line_dedup import _brute as line_brute
from .test_simhash import _classes, _fingerprint

LICENSE = "permission is hereby granted to use this line of text"


def _rows():
    rows = [doc(i, f"{LICENSE}\n{prose(i, 60 + i % 40)}", "abc"[i % 3]) for i in range(90)]
    rows += [doc(200 + i, f"{LICENSE}\n{prose(5, 65)}", "a") for i in range(6)]  # copies of document 5
    rows += [doc(300, prose(7, 67) + " tail", "b"), doc(301, None), doc(302, ""), doc(303, "junk " * 300), doc(304, "few words"),
             doc(None, prose(400), None), doc(5, f"{LICENSE}\n{prose(5, 65)}", "c")]
    return rows


def test_stages(spark, make):
    docs = make(_rows())
    assert [n for n, _ in C.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "mixing", "SentencePiece"]
    out = [docs]
    for name, stage in C.STAGES:
        out.append(materialize(stage(spark, out[-1], ""), "test-stage"))
    for d in out[1:-1]:
        assert d.columns == docs.columns
    rows = [[tuple(r) for r in d.collect()] for d in out]

    def good(t):
        n, _, _, _, again, _ = quality.text_stats(t)
        return not (n < 50 or 100 * again > 50 * n)
    assert Counter(rows[1]) == Counter(r for r in rows[0] if good(r[1]))  # no host fails as a whole

    assert sorted(((r[0], r[1]) for r in rows[2]), key=repr) == sorted(((i, t) for i, _, _, t in line_brute(rows[1])), key=repr)
    assert sum(LICENSE in r[1] for r in rows[2]) < 5

    fps = [_fingerprint(r[1]) for r in rows[2]]
    group = _classes(set(fps))
    first = {}
    for r, f in zip(rows[2], fps):
        if r[0] is not None:
            first[group[f]] = min(first.get(group[f], r[0]), r[0])
    assert Counter(r[0] for r in rows[3]) == Counter([*first.values(), *(None for g in set(group.values()) if g not in first)])
    assert len(rows[3]) < len(rows[2])

    words = {}
    for r in rows[4]:
        words[r[3]] = words.get(r[3], 0) + len(r[1].split())
    assert set(rows[4]) <= set(rows[3]) and max(Counter(rows[4]).values()) <= MAX_EPOCHS
    total = sum(len(r[1].split()) for r in rows[3])
    assert abs(sum(words.values()) - total) <= 110 * len(words)

    assert Counter(r[0] for r in rows[5]) == Counter(r[0] for r in rows[4])
    assert all(r.exact and r.n_tokens == len(r.ids) for r in out[5].collect())


def test_run_equals_its_stages(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in C.STAGES:
        docs = materialize(stage(spark, docs, path), "test-stage")
    key = lambda r: (r.doc_id, r.n_tokens)
    assert sorted(map(key, C.run(spark, path).collect())) == sorted(map(key, docs.collect()))


def test_empty(spark, make):
    docs = make([])
    for _, stage in C.STAGES:
        docs = materialize(stage(spark, docs, ""), "test-stage")
    assert docs.collect() == []
    assert simhash.MAX_BITS == 3 and simhash.SHINGLE == 3
