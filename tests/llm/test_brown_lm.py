import math
import random
from collections import Counter
from dataclasses import replace
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnlens.llm import brown_lm as B
from churnlens.llm.text import lower_words

from .conftest import doc, prose


def _tokens(text):
    return [*lower_words(text), b""]


def _corpus():
    """Words of two kinds that alternate: a bigram of classes tells them apart."""
    r = random.Random(2)
    first, second = ([f"{c}{k}" for k in range(40)] for c in "xy")
    return [doc(i, " ".join(w for _ in range(30) for w in (r.choice(first), r.choice(second)))) for i in range(120)]


EDGES = [doc(1000, None), doc(1001, ""), doc(1002, "Unseen WORDS é x1"), doc(None, "x1 y1"), doc(1003, "x1 y2 " * 20_000), doc(1003, "x1")]


def _brute(rows, model):
    """Scores of all rows from the classes alone, counting everything anew."""
    train = [r for r in rows if crc32(("" if r[0] is None else str(r[0])).encode()) % 5 != 1]
    count = Counter(t for r in train for t in _tokens(r[1]))
    n_words = len(model.class_of) - 1 - B.GROUPS

    def cls(w):
        if w == b"":
            return int(model.class_of[-1])
        item = model.known[w][0] if w in model.known else n_words + B.group_of(w)
        return int(model.class_of[item])
    k = len(model.emitted)
    pairs, total, kinds = np.zeros((k, k)), Counter(), Counter()
    for r in train:
        last = k - 1
        for t in _tokens(r[1]):
            pairs[last, cls(t)] += 1
            last = cls(t)
    for w, n in count.items():
        if w:
            total[cls(w)] += n
            kinds[cls(w)] += 1
    with_groups = set(model.class_of[n_words:-1].tolist())
    own = (pairs.sum(0) + 1) / (pairs.sum() + k)
    all_, types = sum(count.values()), len(count)
    out = []
    for r in rows:
        last, score, base = k - 1, 0.0, 0.0
        for t in _tokens(r[1]):
            c = cls(t)
            score += math.log10((pairs[last, c] + 10 * own[c]) / (pairs[last].sum() + 10))
            if t:
                score += math.log10((count[t] + 0.5) / (total[c] + 0.5 * (kinds[c] + (c in with_groups))))
            base += math.log10((count[t] + 0.5) / (all_ + 0.5 * (types + 1)))
            last = c
        known = sum(count[t] > 0 for t in _tokens(r[1]))
        out.append((r[0], len(_tokens(r[1])), known, all_, base, score))
    return out


@pytest.mark.parametrize("texts", [
    [], [None], ["", "   ", None], ["  A b\x0bC\t", None, "\u2003x\x85 y\x1cz\n", "q", "\u0130 I \x00 a", "a" * 9 + " \r\n" * 5]])
def test_tokens_of_a_batch(texts):
    words, code, starts = B._tokens(pa.array(texts, pa.string()))
    want = [_tokens(t) for t in texts]
    assert [words[i].as_py() for i in code] == sum(want, [])
    assert starts.tolist() == [sum(map(len, want[:k])) for k in range(len(want))]


@pytest.mark.parametrize("items,known", [(B.ITEMS, B.KNOWN), (100, 200)])
def test_scores_equal_brute_force(make, items, known):
    rows = [doc(i, prose(i, 40)) for i in range(60)] + EDGES
    df = make(rows).withColumnRenamed("lang", "rare").withColumnRenamed("n_chars", "score")
    model = B.fit(df.filter(~B.held_out(F.col("doc_id"))), classes=6, items=items, known=known)
    got = B.score(df, model)
    assert got.columns == ["doc_id", "rare", "source", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    key = lambda r: (repr(r[0]), r[1])
    got = sorted((tuple(r) for r in got.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=key)
    want = sorted(_brute(rows, model), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9)


def test_probabilities_sum_to_one(make):
    model = B.fit(make([doc(i, prose(i, 40)) for i in range(30)]), classes=5)
    assert (10 ** model.transition).sum(1) == pytest.approx(np.ones(6))


def test_exchange_raises_likelihood_and_held_out_score(make):
    rows = _corpus()
    df = make(rows)
    model = B.fit(df.filter(~B.held_out(F.col("doc_id"))), classes=4)
    out = B.score(df, model).filter(B.held_out(F.col("doc_id"))).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (out[0] - out[1]) / out[2] > 0.25  # two kinds of words: near log10(2) a token
    item = {w: model.class_of[i] for w, (i, _) in model.known.items()}
    assert not {item[f"x{k}".encode()] for k in range(40)} & {item[f"y{k}".encode()] for k in range(40)}


def test_each_move_is_the_best_one():
    """The gain of a move equals the change of the likelihood counted anew."""
    r = np.random.default_rng(0)
    n, k = 12, 4
    pairs = r.integers(0, 9, (n, n))
    class_of = np.r_[r.integers(0, k - 1, n - 1), k - 1]

    def counts(classes):
        left, right = np.zeros((n, k), int), np.zeros((n, k), int)
        for a in range(n):
            for b in range(n):
                left[b, classes[a]] += pairs[a, b]
                right[a, classes[b]] += pairs[a, b]
        return left, right
    left, right = counts(class_of)
    moved = B.exchange(left, right, np.diag(pairs), class_of, k, [3])

    def value(classes):
        return B.likelihood(B.class_bigrams(counts(classes)[0], classes, k))
    options = []
    for c in range(k - 1):
        other = class_of.copy()
        other[3] = c
        options.append(value(other))
    assert value(moved) == pytest.approx(max(options))


@pytest.mark.parametrize("known", [B.KNOWN, 100])
def test_rare_words_of_a_large_corpus_are_clustered(make, known):
    """A word's count alone makes it an item, however many tokens the corpus has."""
    r = random.Random(4)
    first, second = ([f"{c}{k}" for k in range(40) for _ in range(10)] for c in "xy")
    r.shuffle(first)
    r.shuffle(second)
    rows = [doc(i, " ".join(w for p in zip(first[i::20], second[i::20]) for w in p)) for i in range(20)]
    model = B.fit(make(rows + [doc(i, "the of " * 20_000) for i in range(2000, 2018)]), classes=6, known=known, sweeps=8)
    n_words = len(model.class_of) - 1 - B.GROUPS
    assert model.tokens > 10 * 65_279 and n_words == 82 and len(model.rarer) == (0 if known == B.KNOWN else 80)
    item = {w: model.known[w][0] if w in model.known else B.rare_items([w], model.rarer, n_words)[0]
            for w in (f"{c}{k}".encode() for c in "xy" for k in range(40))}
    assert len({*item.values()}) == 80 and max(item.values()) < n_words
    cls = [np.bincount([model.class_of[i] for w, i in item.items() if w[:1] == c], minlength=6) for c in (b"x", b"y")]
    assert np.minimum(*cls).sum() <= 4  # words that share a class with the other kind


def test_a_batch_that_lowers_the_likelihood_is_cut():
    """Two words that swap their classes side by side: one of them moves."""
    bigrams = np.array([[0, 9, 0, 1], [9, 0, 0, 1], [0, 0, 5, 1], [1, 1, 1, 0]])

    def count(classes):
        one = np.eye(4, dtype=int)[classes]
        return None, None, None, one.T @ bigrams @ one
    old, worse = np.array([0, 1, 2, 3]), np.array([2, 2, 2, 3])
    value = lambda c: B.likelihood(count(c)[3])
    assert value(worse) < value(old)
    kept, counted = B.kept_moves(count, old, worse, count(old))
    assert value(kept) >= value(old) and B.likelihood(counted[3]) == value(kept)


def test_rarer_items_score_like_known_ones(make):
    """The same classes, with all words in the tasks' table or found by their hashes."""
    df = make([doc(i, prose(i, 40)) for i in range(60)] + EDGES)
    train = df.filter(~B.held_out(F.col("doc_id")))
    model = B.fit(train, classes=6, known=20, min_count=2)
    n_words = len(model.class_of) - 1 - B.GROUPS
    vocabulary = [(bytes(r.word), r.n) for r in model.vocabulary.collect() if r.word]
    assert len(model.rarer) > 100 and n_words == sum(n >= 2 for _, n in vocabulary)
    full = {w: (B.rare_items([w], model.rarer, n_words)[0] if w not in model.known else model.known[w][0], n) for w, n in vocabulary}
    want = _brute([tuple(r) for r in df.collect()], replace(model, known=full))
    got = B.score(df, model).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    key = lambda r: (repr(r[0]), r[1])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:], rel=1e-9)


def test_gains_equal_the_change_of_the_likelihood():
    r = np.random.default_rng(5)
    n, k = 30, 5
    bigrams = r.integers(0, 6, (n, n)) * (r.random((n, n)) < 0.4)
    class_of = np.r_[r.integers(0, k - 1, n - 1), k - 1]

    def tables(classes):
        one = np.eye(k, dtype=int)[classes]
        return bigrams.T @ one, bigrams @ one
    left, right = tables(class_of)
    pairs = B.class_bigrams(left, class_of, k)
    got = B.gains(pairs, class_of[:-1], left[:-1], right[:-1], bigrams.diagonal()[:-1])
    for w in range(n - 1):
        value = []
        for c in range(k - 1):
            other = class_of.copy()
            other[w] = c
            value.append(B.likelihood(B.class_bigrams(tables(other)[0], other, k)))
        assert got[w] - got[w, 0] == pytest.approx(np.array(value) - value[0], abs=1e-6)


def test_no_training_text(make):
    df = make(EDGES)
    model = B.fit(df.filter("false"))
    got = B.score(df, model).collect()
    assert len(got) == len(EDGES) and all(r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert B.score(make([]), model).collect() == []
