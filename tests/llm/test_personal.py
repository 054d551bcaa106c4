import random
import re

import numpy as np
import pytest

from churnlens.llm import personal as P

from .conftest import doc, prose

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _plain(text):
    out = []
    for k, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (name == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or name == "email"
                    or name == "card" and 12 <= len(digits) <= 19 and P.luhn(digits) or name == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.mark.parametrize("parts", ["aé.@-+ 0123(4)\n5.", ["1", "2", "4", "0", ".", " ", "-", "25", "300", "+", "@", "a.b"]])
def test_patterns(parts):
    r = random.Random(3)
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 45)))
        assert P.base_spans(text) == _plain(text), text


def test_long_texts_stay_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "@" * 200_000, "+1(" * 100_000, "1." * 100_000, "a.a@" * 50_000):
        P.base_spans(text)
    assert not P.Graph("a" * 300_000 + " x", []).places


def test_luhn():
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


TEXT = ("Write to jane.doe77@mail.example.com or call +1 (988) 555-2485 now. " + prose(1, 500)
        + " Later jane.doe77 said 19885552485, (jane.doe77) and 12345678 or john.roe5.")


def test_field_adds_similar_mentions_only():
    field = P.Field(np.zeros((P.FEATURES, P.LABELS)), np.zeros((P.LABELS, P.LABELS)), P.SKIP_PRIOR)
    base = P.base_spans(TEXT)
    more = P.added_spans(TEXT, base, field)
    assert [(P.KINDS[k], TEXT[s:e]) for s, k, e in more] == [("email", "jane.doe77"), ("phone", "19885552485"), ("email", "jane.doe77")]
    assert P.added_spans("12345678 and 4111111111111112 twice 4111111111111112", [], field) == []


@pytest.mark.parametrize("text,want", [
    ("john.smith@example.com wrote. " + prose(2, 200) + " (John.Smith) said", [("email", "John.Smith")]),
    ("ann@example.com wrote, said ann, not anna", [("email", "ann")]),
    ("Call +44 20 7946 0958 or " + prose(1, 99) + " 020 7946 0958 now", [("phone", "020 7946 0958")]),
    ("+1 (988) 555-2485 is (988) 555-2485, not (989) 555-2486", [("phone", "988) 555-2485")]),
    ("card 4111 1111 1111 1111, again 411111 1111111111 there, and 1111 times", [("card", "411111 1111111111")]),
])
def test_letters_and_spaced_numbers_are_linked(text, want):
    field = P.Field(np.zeros((P.FEATURES, P.LABELS)), np.zeros((P.LABELS, P.LABELS)), P.SKIP_PRIOR)
    base = [s for s in P.base_spans(text) if s[2] <= text.rindex(want[0][1])]
    assert base and [(P.KINDS[k], text[s:e]) for s, k, e in P.added_spans(text, base, field)] == want


def test_repeated_short_tokens_are_linked():
    assert P.Graph("a1 word x2 other a1", []).skips == [(0, 2)]
    assert len(P.Graph("+49 30 1234567 " + "1 " * 3000, P.base_spans("+49 30 1234567 ")).skips) < 4000


def test_messages_are_exact_on_trees():
    """On a graph without cycles the marginals equal the sum over all labelings."""
    r = np.random.default_rng(1)
    text = "a1234567 x 7654321 b1234567 c9999999"
    graph = P.Graph(text, [])
    field = P.Field(r.normal(size=(P.FEATURES, P.LABELS)), r.normal(size=(P.LABELS, P.LABELS)), 1.3)
    n = len(graph.places)
    edges = [(i, i + 1, field.transition) for i in graph.chain] + [(i, j, 1.3 * np.eye(P.LABELS)) for i, j in graph.skips]
    assert n == 4 and len(edges) == 3
    node = np.array([field.features[f].sum(0) for f in graph.features])
    want = np.zeros((n, P.LABELS))
    for y in np.ndindex(*[P.LABELS] * n):
        w = np.exp(sum(node[i, y[i]] for i in range(n)) + sum(t[y[i], y[j]] for i, j, t in edges))
        for i in range(n):
            want[i, y[i]] += w
    want /= want.sum(1, keepdims=True)
    if len({(i, j) for i, j, _ in edges}) == n - 1:
        assert field.marginals(graph) == pytest.approx(want, abs=2e-3)


def test_skips_are_linear():
    graph = P.Graph(" ".join(["5551234567"] * 1000), [])
    assert len(graph.skips) == 999


def test_table(make):
    rows = [doc(1, TEXT), doc(2, None), doc(3, ""), doc(1, TEXT), doc(None, "x@y.z 1.2.3.4"), doc(5, "é" * 10 + "a@b.cd"), doc(6, prose(3, 20_000) + " +49 30 1234567")]
    df = make(rows).withColumnRenamed("lang", "spans").withColumnRenamed("n_chars", "kind")
    got = P.find_personal(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.spans for r in got}
    for i, t, *_ in rows:
        assert [(s.start, s.kind, s.end) for s in by[i] if s.base] == _plain(t or "")
        starts = [s.start for s in by[i]]
        assert starts == sorted(starts)
    assert by[2] == by[3] == [] and (by[5][0].start, by[5][0].end) == (10, 16)
    assert P.find_personal(make([])).collect() == []


def test_training_learns_the_patterns_labels(make):
    rows = [doc(i, f"{prose(i, 20)} user{i}.x@mail.example.com {prose(i, 9)} 10.0.{i % 250}.7 {prose(i, 5)} {1000 + i}") for i in range(120)]
    field = P.fit_field(make(rows))
    text = rows[3][1]
    graph = P.Graph(text, [])
    p = field.marginals(graph)
    kinds = [int(x) for x in p.argmax(1)]
    assert kinds[0] == 1 and kinds[-1] == 0
