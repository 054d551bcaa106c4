"""Personal data: patterns, and a skip-chain conditional random field around them.

Patterns find emails, ip addresses, cards and phones in the whole text. The
field then looks for further mentions that no pattern sees, such as a card
number repeated without its check digits' spacing or the local part of an email
that occurs elsewhere. Its nodes are the document's tokens with a digit or an
``@`` and all tokens that equal the local part of one of its emails (letters only
or not); neighbouring tokens share a transition potential, and each token shares a
skip potential with the next repeated or similar token, however far apart (the same
token of any length, the same digits, or the same local part of at least MIN_LOCAL
characters). A run of digit groups that repeats a card's or phone's digits, or a
phone's last groups, shares one with that span, leading zeros aside, group by group;
one group of a spaced number alone does not.
Tokens under a pattern are observed; loopy
message passing carries their labels along both kinds of edges, and a token is
added when its marginal for a kind exceeds ``THRESHOLD``. Only tokens connected
to an observed one by skip edges can be added, so a lone number that no pattern
accepts, such as 16 digits with a wrong check digit, is left alone.

Skip edges join each token to the next similar one, so k mentions have k - 1
edges. Documents are handled one by one in Arrow batches; nothing is shuffled.

The weights are learned by pseudo-likelihood from at most ``FIT_TOKENS`` tokens of
about ``FIT_DOCS`` documents picked by a hash of their id, labelled by the
patterns (tokens similar to a labelled one, but without a label, are left out).

Defined results: null and empty texts have no spans; texts of any length are searched whole;
repeated rows have equal results; an empty table gives an empty table; a column named spans is
replaced, all others stay, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.text import in_small_batches, map_texts, quoted

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0: none
FIT_DOCS = 2000
FIT_TOKENS = 20_000
FEATURES = 1 << 10
THRESHOLD = 0.5
#: Prior mean of the skip potential, in nats; the sample moves it as far as it holds similar tokens.
SKIP_PRIOR = 5.0
ROUNDS = 20
#: Shorter local parts would make mentions of common words.
MIN_LOCAL = 3
#: Digits of a run that is compared with the observed numbers.
RUN_DIGITS = (7, 19)
EMAIL_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the lookbehind and the possessive repeats only spare retries that cannot match
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_ANY_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_GROUPS = re.compile(r"[+().0-9-]*[0-9][+().0-9-]*")
_EDGE = ".,;:!?()[]{}<>\"'"

Span = tuple[int, int, int]  # start, index of kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches: each needs an @, so go from @ to @."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1].isascii() and ord(text[start - 1]) in EMAIL_LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start, then kind."""
    out: list[Span] = [(s, 0, e) for s, e in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0]) if m.end() - m.start() >= 12 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


def _keys(token: str) -> list[str]:
    """Tokens with a key in common are similar."""
    keys = []
    digits = _NOT_DIGIT.sub("", token)
    if len(digits) >= 7:
        keys.append(digits)
    local = token.strip(_EDGE).lower().partition("@")[0]
    if len(local) >= MIN_LOCAL and not local.isdigit():
        keys.append("@" + local)
    if same := token.strip(_EDGE):
        keys.append("=" + same)
    return keys


def _numbers(span: Span, text: str) -> set[str]:
    """What a run of digit groups may repeat of a card or phone: all its digits, or a phone's last groups."""
    low, high = RUN_DIGITS
    groups = re.findall("[0-9]+", text[span[0]:span[2]]) if span[1] in (2, 3) else []
    ends = ["".join(groups[k:]).lstrip("0") for k in range(len(groups) if span[1] == 3 else min(1, len(groups)))]
    return {x for x in ends if low <= len(x) <= high}


def _kind(c: str) -> str:
    return "digit" if c.isdigit() else "letter" if c.isalpha() else c


def _features(token: str, alone: bool) -> list[int]:
    """What a mention has in common with the tokens that the patterns see, not
    what the patterns themselves ask for (an @, separators, a check digit)."""
    token = token.strip(_EDGE) or token
    n = len(_NOT_DIGIT.sub("", token))
    size = next(k for k, top in enumerate((3, 6, 11, 10**9)) if n <= top)
    letters = any(c.isalpha() for c in token)
    names = ("bias", f"digits {size}", f"letters {letters}", f"digits {size} letters {letters}",
             f"first {_kind(token[0])}", f"last {_kind(token[-1])}", f"alone {alone}")
    return [crc32(x.encode()) % FEATURES for x in names]


class Graph:
    """A document's tokens: places, observed labels (-1: none), features and edges."""

    def __init__(self, text: str, spans: list[Span]):
        locals_ = {x for s, k, e in spans if k == 0 and len(x := text[s:e].partition("@")[0].lower()) >= MIN_LOCAL}
        if any(not _TOKEN.search(x) for x in locals_):
            self.places = [m.span() for m in _ANY_TOKEN.finditer(text)
                           if _TOKEN.match(m[0]) or m[0].strip(_EDGE).lower() in locals_]
        else:
            self.places = [m.span() for m in _TOKEN.finditer(text)]
        self.labels = np.full(len(self.places), -1)
        k = 0
        starts = sorted(spans)
        reach = []  # spans that may cover the current token
        whole: dict[int, list[str]] = {}  # last token of a span -> the span's keys
        numbers: dict[str, int] = {}  # digits of a card or phone -> the span's last token
        parts = set()  # tokens that are one group of a span: the group alone is no mention
        for i, (s, e) in enumerate(self.places):
            while k < len(starts) and starts[k][0] < e:
                reach.append(starts[k])
                k += 1
            reach = [x for x in reach if x[2] > s]
            if reach:
                self.labels[i] = reach[0][1] + 1
                if any(x[0] < s or x[2] > e for x in reach):
                    parts.add(i)
                whole[i] = [key for x in reach if x[2] <= e for key in _keys(text[x[0]:x[2]])]
                numbers |= {n: i for x in reach if x[2] <= e for n in _numbers(x, text)}
        tokens = [text[s:e] for s, e in self.places]
        # neighbours: one white-space character apart
        self.chain = [i for i in range(len(tokens) - 1) if self.places[i + 1][0] - self.places[i][1] == 1]
        linked = {*self.chain, *(i + 1 for i in self.chain)}
        self.features = [_features(t, i not in linked) for i, t in enumerate(tokens)]
        last: dict[str, int] = {}
        skips = set()
        for i, t in enumerate(tokens):
            for key in dict.fromkeys([*_keys(t), *whole.get(i, ())]):
                if i in parts and key[0] == "=":
                    continue
                if key in last:
                    skips.add((last[key], i))
                last[key] = i
        if numbers:
            skips |= self._runs(tokens, numbers)
        self.skips = sorted(skips)

    def _runs(self, tokens: list[str], numbers: dict[str, int]) -> set[tuple[int, int]]:
        """Edges from the tokens of runs of digit groups to the spans whose digits they repeat."""
        digits = [_NOT_DIGIT.sub("", t) if _GROUPS.fullmatch(t.strip(_EDGE)) and self.labels[i] < 0 else ""
                  for i, t in enumerate(tokens)]
        follows, out = set(self.chain), set()
        for end in range(len(tokens)):
            run, k = digits[end], end
            while digits[k] and len(run) <= RUN_DIGITS[1] + 3:
                if (span := numbers.get(run.lstrip("0"))) is not None:
                    out |= {(min(span, i), max(span, i)) for i in range(k, end + 1)}
                if k == 0 or k - 1 not in follows:
                    break
                k -= 1
                run = digits[k] + run
        return out

    def reached(self) -> np.ndarray:
        """Tokens that skip edges connect to an observed one."""
        root = list(range(len(self.places)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i
        for i, j in self.skips:
            root[find(i)] = find(j)
        seen = {find(i) for i in np.flatnonzero(self.labels >= 0)}
        return np.array([find(i) in seen for i in range(len(root))], bool)


class Field:
    """The weights: features by label, transitions, and the skip potential for equal labels."""

    def __init__(self, features: np.ndarray, transition: np.ndarray, skip: float):
        self.features, self.transition, self.skip = features, transition, skip

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, before: np.ndarray, after: np.ndarray, twins: np.ndarray,
            steps: int = 200, rate: float = 0.1, decay: float = 1e-3) -> Field:
        """Pseudo-likelihood by Adam: each label given its neighbours' (-1: none). ``twins``
        has the labels of the similar tokens before and after."""
        n, one = max(1, len(y)), np.eye(LABELS)
        hot = np.concatenate([one, np.zeros((1, LABELS))])  # row -1: no neighbour
        same = hot[twins].sum(1)
        shapes = [(FEATURES, LABELS), (LABELS, LABELS), ()]
        prior = [0.0, 0.0, SKIP_PRIOR]
        w = [np.full(s, p) for s, p in zip(shapes, prior)]
        m, v = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
        for t in range(1, steps + 1):
            logits = w[0][x].sum(1) + hot[before] @ w[1] + hot[after] @ w[1].T + w[2] * same
            p = np.exp(logits - logits.max(1, keepdims=True))
            wrong = one[y] - p / p.sum(1, keepdims=True)
            g_x = np.stack([np.bincount(x.ravel(), np.repeat(wrong[:, k], x.shape[1]), FEATURES)
                            for k in range(LABELS)], 1)
            grads = [g_x, hot[before].T @ wrong + wrong.T @ hot[after], (wrong * same).sum()]
            for k, g in enumerate(grads):
                g = g / n - decay * (w[k] - prior[k])
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                w[k] = w[k] + rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
        return cls(w[0], w[1], float(max(w[2], 0.0)))

    def marginals(self, graph: Graph) -> np.ndarray:
        """Label distributions of all tokens by loopy message passing."""
        node = np.array([self.features[f].sum(0) for f in graph.features]).reshape(-1, LABELS)
        seen = graph.labels >= 0
        node[seen] = -1e9
        node[seen, graph.labels[seen]] = 0.0
        pairs = np.array([*((i, i + 1) for i in graph.chain), *graph.skips], np.int64).reshape(-1, 2)
        tables = np.concatenate([np.repeat(self.transition[None], len(graph.chain), 0),
                                 np.repeat(self.skip * np.eye(LABELS)[None], len(graph.skips), 0)])
        a = np.concatenate([pairs[:, 0], pairs[:, 1]])  # messages run from a to b
        b = np.concatenate([pairs[:, 1], pairs[:, 0]])
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        back = np.r_[np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))]
        message = np.zeros((len(a), LABELS))

        def belief() -> np.ndarray:
            out = node.copy()
            np.add.at(out, b, message)
            return out
        for _ in range(ROUNDS if len(a) else 0):
            sent = (belief()[a] - message[back])[:, :, None] + tables
            top = sent.max(1, keepdims=True)
            new = (top + np.log(np.exp(sent - top).sum(1, keepdims=True)))[:, 0]
            new -= new.max(1, keepdims=True)
            change = np.abs(new - message).max()
            message = 0.5 * message + 0.5 * new
            if change < 1e-4:
                break
        out = belief()
        out = np.exp(out - out.max(1, keepdims=True))
        return out / out.sum(1, keepdims=True)


def added_spans(text: str, spans: list[Span], field: Field) -> list[Span]:
    """The further mentions that the field finds; they overlap no pattern's span."""
    if not spans:
        return []
    graph = Graph(text, spans)
    open_ = graph.reached() & (graph.labels < 0)
    if not open_.any():
        return []
    p = field.marginals(graph)
    out: list[Span] = []
    for i in np.flatnonzero(open_ & (p[:, 1:].max(1) > THRESHOLD)):
        s, e = graph.places[i]
        token = text[s:e]
        s, e = s + len(token) - len(token.lstrip(_EDGE)), e - len(token) + len(token.rstrip(_EDGE))
        kind = int(p[i, 1:].argmax())
        if s >= e:
            continue
        gap = text[out[-1][2]:s] if out and out[-1][1] == kind else ""
        if len(gap) == 1 or KINDS[kind] == "phone" and gap in (") ", " (", ") ("):
            out[-1] = (out[-1][0], kind, e)
        else:
            out.append((s, kind, e))
    return out


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for order, text in zip(batch.column("order").to_pylist(), batch.column("text")):
            text = text.as_py() or ""
            graph = Graph(text, base_spans(text))
            similar = graph.reached()
            y = np.maximum(graph.labels, 0)
            before, after = np.full(len(y), -1), np.full(len(y), -1)
            twins = np.full((len(y), 2), -1)
            for i in graph.chain:
                before[i + 1], after[i] = y[i], y[i + 1]
            for i, j in graph.skips:
                twins[i, 1], twins[j, 0] = y[j], y[i]
            rows += [(order, i, [*map(int, graph.features[i]), int(y[i]), int(before[i]), int(after[i]), *map(int, twins[i])])
                     for i in range(len(y)) if graph.labels[i] >= 0 or not similar[i]]
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.list_(pa.int32())))],
                                         names=["order", "at", "row"])


def fit_field(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Field:
    """Learns from at most FIT_TOKENS tokens of about FIT_DOCS documents."""
    total = docs.count()
    order = F.xxhash64(quoted(doc_id))
    share = min(1.0, FIT_DOCS / max(1, total))
    sample = docs.select(order.alias("order"), quoted(text).alias("text")).filter(
        F.pmod("order", F.lit(1_000_000)) < round(1_000_000 * share))
    rows = (sample.mapInArrow(_examples, "order long, at int, row array<int>")
            .orderBy("order", "at", "row").limit(FIT_TOKENS).collect())
    if not rows:
        return Field(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), SKIP_PRIOR)
    data = np.array([r["row"] for r in rows], np.int64)
    return Field.fit(data[:, :-5], data[:, -5], data[:, -4], data[:, -3], data[:, -2:])


def _finder(field, text: str):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_of = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        for batch in batches:
            found = []
            for body in batch.column(text):
                body = body.as_py() or ""
                base = base_spans(body)
                more = added_spans(body, base, field.value)
                found.append([dict(zip(("start", "kind", "end", "base"), x)) for x in
                              sorted([(*s, True) for s in base] + [(*s, False) for s in more])])
            kept = batch.drop_columns([text])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found, pa.list_(kind_of))],
                                             names=[*kept.schema.names, "spans"])
    return find


def find_personal(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the text, with ``spans``: an array of (start, kind, end, base) by start,
    kind counting from 0 in the order of KINDS, base false for what the field added (a column
    of that name is replaced)."""
    field = docs.sparkSession.sparkContext.broadcast(fit_field(docs, text, doc_id))
    return map_texts(in_small_batches(docs), text, _finder(field, "text"),
                     "spans array<struct<start:int, kind:int, end:int, base:boolean>>", ("spans",))


def _joined(spans: Column) -> Column:
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kind, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_personal_data(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_personal(docs)
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
             for k, name in enumerate(KINDS)]
    return found.select("doc_id", *count, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))
