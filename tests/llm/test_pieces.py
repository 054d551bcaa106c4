import random

import pytest

from churnlens.llm import pieces as P

from .conftest import doc, prose


@pytest.fixture(scope="module")
def model():
    return P.Pieces.read(P.default_model())


def _all(model, s):
    """Every segmentation's (score, ids)."""
    into = model.edges(s)
    paths = [[(0.0, ())]] + [[] for _ in s]
    for j in range(1, len(s) + 1):
        for i, score, piece in into[j]:
            paths[j] += [(a + score, (*p, (i, j, piece))) for a, p in paths[i]]
    return [(a, tuple(model.ids(s, p))) for a, p in paths[-1]]


def test_nbest_equals_enumeration(model):
    r = random.Random(1)
    for _ in range(400):
        text = "".join(r.choice("the ab.é,\nin▁ß1  ²") for _ in range(r.randint(1, 9)))
        n = r.randint(1, 6)
        ids, scores, edits = P.Encoder(model, n).encode(text)
        every = _all(model, " " + text)
        assert scores == sorted((a for a, _ in every), reverse=True)[:n]
        lists = [ids.tolist(), *(P.apply_edits(ids.tolist(), e) for e in edits)]
        assert len(lists) == len(scores) and len(set(map(tuple, lists))) == len(lists)
        score_of = dict((i, a) for a, i in every)
        assert [score_of[tuple(x)] for x in lists] == scores
        assert all(model.decode(x) == text for x in lists)


def test_blocks_are_exact(model):
    """Cutting into blocks finds the same best scores as one lattice over the text."""
    whole = P.Pieces.read(P.default_model())
    whole.blocks = P.re.compile(".+", P.re.S)
    for k in range(30):
        text = prose(k, 12).replace("a", "A.")[:90]
        assert P.Encoder(model, 5).encode(text)[1] == P.Encoder(whole, 5).encode(text)[1]


def test_second_best_of_a_block(model):
    for s in (" hello", " the", "...", " é", "²²", " unbelievable", " x"):
        scores = sorted((a for a, _ in _all(model, s)), reverse=True) + [float("-inf")]
        _, best, loss = model.best(s)
        assert best == scores[0] and best - loss == scores[1]


def test_full_cache_changes_nothing(model, monkeypatch):
    want = P.Encoder(model).encode(prose(3, 500))
    monkeypatch.setattr(P, "CACHE", 5)
    got = P.Encoder(model).encode(prose(3, 500))
    assert got[0].tolist() == want[0].tolist() and got[1:] == want[1:]


def test_table(make, monkeypatch, model):
    texts = ["Hello world", None, "", " ", "\n", "▁ literal ▁▁", "tab\tß\u0000 😀 é", "w" * 20_000, prose(1, 30_000), "Hello world"]
    df = make([doc(i, t) for i, t in enumerate(texts)]).withColumnRenamed("lang", "ids").withColumnRenamed("n_chars", "old ids")
    got = {r.doc_id: r for r in P.encode_pieces(df).collect()}
    assert len(got) == len(texts) and all(r.exact for r in got.values())
    assert got[1].n_tokens == got[2].n_tokens == 0 and got[1].scores == [0.0] and got[1].alternatives == []
    assert got[0].ids == got[9].ids and got[0].n_tokens == len(got[0].ids)
    for i, t in enumerate(texts):
        for k in range(2, len(got[i].scores) + 1):
            edits = [(e["at"], e["drop"], e["ids"]) for e in got[i].alternatives if e["rank"] == k]
            assert edits and model.decode(P.apply_edits(got[i].ids, edits)) == t
    assert P.encode_pieces(make([])).collect() == []
    assert P.encode_pieces(df).columns == ["doc_id", "source", "old ids", "n_tokens", "ids", "scores", "alternatives", "exact"]
