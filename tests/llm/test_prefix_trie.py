"""The prefix trie against a plain trie of tuples."""

import hashlib
import random
import zlib

import pytest

from churnlens.llm import prefix_trie as P
from tests.llm.conftest import rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            convs.setdefault(c, []).append((t is not None, t or 0, name, role, text))
    return {c: [(r, x) for *_, r, x in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids = {p: 0 for p in members}
    leaves, saved = dict(kids), dict(kids)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        value = (len(m) - 1) * len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += value
            leaves[p[:d]] += not kids[p]
    return sorted([(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p)))).encode()).hexdigest())
                   for p, m in members.items()], key=repr)


def made(seed, n=40, longest=30, words=3):
    """Turns over few texts, so that prefixes are shared at every depth."""
    r = random.Random(seed)
    rows = []
    for c in range(n):
        of = r.randrange(c) if c and r.random() < 0.7 else None
        size = r.randrange(0, longest)
        if of is not None:  # a copy of another conversation's opening
            opening = [(t, role, x) for k, t, role, x in rows if k == of][:r.randrange(0, longest)]
            rows += [(c, t, role, x) for t, role, x in opening]
        else:
            opening = []
        rows += [(c, len(opening) + i, r.choice("ua"), "w " * r.randrange(words)) for i in range(size)]
    r.shuffle(rows)
    return rows


def trie(make, rows, schema=SCHEMA):
    return rows_of(P.conversation_trie(make(rows, schema)), *COLUMNS)


def rebuilt_trie(df):
    return rows_of(P.prefix_trie(*P.rebuild(P.materialize(P.ordered_turns(df), "t"))), *COLUMNS)


@pytest.mark.parametrize("seed, longest", [(1, 6), (2, 30), (3, 150)])
def test_trie_equals_brute_force(make, seed, longest):
    rows = made(seed, longest=longest)
    assert trie(make, rows) == brute(sequences(rows))


@pytest.mark.parametrize("base", [1, 2, 3])
def test_height_of_the_lowest_blocks_does_not_matter(make, monkeypatch, base):
    monkeypatch.setattr(P, "BASE", base)
    rows = made(4, longest=20)
    assert trie(make, rows) == brute(sequences(rows))


def test_lengths_at_the_cuts(make):
    for n in (4, 5, 8, 16, 17):
        rows = [(c, t, "u", f"x{t if t < n - 1 or c < 2 else c}") for c in range(4) for t in range(n - (c == 3))]
        assert trie(make, rows) == brute(sequences(rows))


def test_rebuilt_conversations(make):
    rows = made(6, n=70, longest=7) + [(c, 0, "u", "one") for c in (-21, -20, -5, 999, 1007)]
    rows = [r for r in rows if r[0] not in (20, 40)]  # absent bases
    convs = rebuilt(sequences(rows))
    assert any(not s for s in convs.values())  # some have no turns left
    assert rebuilt_trie(make(rows, SCHEMA)) == brute(convs)


def test_nulls_ties_repeats_and_long_texts(make):
    rows = [(1, None, None, None), (1, 0, "u", ""), (1, 0, "", "u"), (1, 0, "u", ""), (2, None, "", ""), (2, None, None, None),
            (None, 1, "u", "x"), (3, 5, "u", "word " * 200_000), (4, 5, "u", "word " * 200_000), (4, 6, "u", " ")]
    got = trie(make, rows)
    assert got == brute(sequences(rows))
    assert max(r[6] for r in got) == 200_000


def test_empty_table(make):
    assert trie(make, []) == [] and trie(make, [(None, 1, "u", "x")]) == []
    assert rebuilt_trie(make([], SCHEMA)) == []


def test_one_turn_repeated_many_times(make, monkeypatch):
    monkeypatch.setattr(P, "COPIES", 7)
    rows = [(5, 1, "u", "again")] * 60 + [(6, 1, "u", "again")] * 33 + [(6, 2, "a", "so")]
    assert trie(make, rows) == brute(sequences(rows))


def test_hot_prefix_and_long_conversation(make, spark):
    rows = [(c, 0, "s", "the same") for c in range(400)] + [(7, t, "u", f"t{t % 3}") for t in range(1, 300)] \
        + [(8, t, "u", f"t{t % 3}") for t in range(1, 250)]
    spark.conf.set("spark.churnlens.maxBroadcastRows", "2")  # joins by salting
    try:
        assert trie(make, rows) == brute(sequences(rows))
    finally:
        spark.conf.unset("spark.churnlens.maxBroadcastRows")


def test_ends_over_several_slices(make):
    rows = [(c, 0, "s", "x") for c in range(3000)]
    assert trie(make, rows) == brute(sequences(rows))


def test_clashing_names(make):
    rows = made(9, n=8, longest=6)
    df = make(rows, SCHEMA).withColumnsRenamed({"turn": "a.b"}).selectExpr("*", "1 AS conv", "2 AS pos", "3 AS name", "4 AS part")
    assert rows_of(P.conversation_trie(df, turn="a.b"), *COLUMNS) == brute(sequences(rows))
