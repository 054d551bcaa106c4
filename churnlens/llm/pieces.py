"""Encoding into the pieces of a SentencePiece model, with the N best segmentations.

The pieces of a text form a lattice over its code points; the score of a
segmentation is the sum of its pieces' scores in the model file. Forward Viterbi
gives every node the best score of a path to it, which is an exact estimate for
an A* search that runs backward from the end of the text: hypotheses leave the
queue in order of the best complete path they can become, so the first N that
reach the start are the N best.

No piece of the model joins a character to a following space, or a letter to
another kind of character (checked when the model is read; where a model has
such pieces the cut is left out). The lattice therefore falls into blocks that
share only their end nodes. Blocks repeat: a task keeps each block's best path
and the loss of its second path, from a forward pass that keeps two scores a node. The N
best of a text can differ from its best one only in the N - 1 blocks whose
second path loses least; A* runs on those, and their lists are merged.

As in the model: a space is put in front of the text, spaces belong to the
following characters, and a character without a piece becomes its UTF-8 bytes'
pieces, at the lowest score less 10. Other than in the model, a literal U+2581
(the model's sign for a space) is written as bytes, so that decoding returns
every text exactly.

Defined results: a null or empty text has no pieces, score 0 and no
alternatives; texts of any length are encoded whole; repeated rows have equal results; an
empty table gives an empty table; columns named like the results are replaced, all others
stay, whatever their names.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from churnlens.llm.text import in_small_batches, map_texts

NBEST = 4
#: Blocks in each of the two generations that a task remembers.
CACHE = 300_000
#: Ids in a batch of results.
OUT_IDS = 1 << 20
SPACE_SIGN = "▁"
RESULT = ("n_tokens long, ids array<int>, scores array<double>, "
          "alternatives array<struct<rank:int, at:int, drop:int, ids:array<int>>>, exact boolean")
_EDITS = pa.list_(pa.struct([("rank", pa.int32()), ("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))]))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A model's pieces as plain tables, small enough to broadcast (its size is the vocabulary's)."""

    def __init__(self, pieces: list[tuple[str, int, float]], byte_ids: list[int], n_ids: int):
        #: piece or prefix of a piece -> (id, score), or None for a mere prefix
        self.table: dict[str, tuple[int, float] | None] = {}
        self.byte_ids = byte_ids
        self.unknown = min(s for _, _, s in pieces) - 10
        self.bytes_of = [b""] * n_ids
        for b, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([b])
        for p, i, s in pieces:
            self.bytes_of[i] = p.encode()
            for n in range(1, len(p)):
                self.table.setdefault(p[:n])
            self.table[p] = (i, s)
        #: the same by characters: character -> (what follows or None, id or -1, score)
        self.trie = self._trie({p: (i, s) for p, i, s in pieces})
        self.blocks = re.compile(self._cut([p for p, _, _ in pieces]), re.S)

    @staticmethod
    def _trie(pieces: dict[str, tuple[int, float]]) -> dict[str, tuple]:
        following: dict[str, set[str]] = {}
        for p in pieces:
            for n in range(len(p)):
                following.setdefault(p[:n], set()).add(p[n])

        def below(prefix: str) -> dict[str, tuple] | None:  # as deep as the longest piece
            return {c: (below(prefix + c), *pieces.get(prefix + c, (-1, 0.0))) for c in following[prefix]} if prefix in following else None
        return below("") or {}

    @staticmethod
    def _cut(pieces: list[str]) -> str:
        """A pattern whose matches are the blocks of a text."""
        if any(" " in p.lstrip(" ") for p in pieces):
            return ".+"
        letter = re.compile(r"[^\W\d_]")
        mixed = [set(map(bool, map(letter.match, p.lstrip(" ")))) == {True, False} for p in pieces]
        odd = "".join(sorted({c for p, m in zip(pieces, mixed) if m for c in p if letter.match(c) and not c.isalpha()}))
        pattern = rf" *(?:[^\W\d_{odd}]+|(?:(?! )[\W\d_{odd}])+)"
        if any(not re.fullmatch(pattern, p) for p in pieces if p.strip(" ")):
            return " *[^ ]+| +"
        return pattern + "| +"

    @classmethod
    def read(cls, path: str) -> Pieces:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(m.get_piece_size())
        byte_ids = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        plain = [i for i in ids if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        return cls([(m.id_to_piece(i).replace(SPACE_SIGN, " "), i, m.get_score(i)) for i in plain], byte_ids, len(ids))

    def edges(self, s: str) -> list[list[tuple[int, float, int]]]:
        """For each node, the edges (start, score, id) that end there; id -1: bytes."""
        n, table = len(s), self.table
        into: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            j = i + 1
            while j <= n and (sub := s[i:j]) in table:
                if hit := table[sub]:
                    into[j].append((i, hit[1], hit[0]))
                j += 1
            if not table.get(s[i]):
                into[i + 1].append((i, self.unknown, -1))
        return into

    def ids(self, s: str, path: list[tuple[int, int, int]]) -> list[int]:
        out: list[int] = []
        for i, j, piece in path:
            out += [piece] if piece >= 0 else [self.byte_ids[b] for b in s[i:j].encode()]
        return out

    def forward(self, into) -> tuple[list[float], list[tuple[int, float, int]]]:
        best, back = [0.0], [(0, 0.0, 0)]
        for edges in into[1:]:
            top = max(edges, key=lambda e: best[e[0]] + e[1])
            best.append(best[top[0]] + top[1])
            back.append(top)
        return best, back

    def best(self, s: str) -> tuple[list[int], float, float]:
        """(ids, score, loss of the second best path) of a block: forward Viterbi that
        keeps the two best scores of every node."""
        n, get, rest = len(s), self.trie.get, (None, -1, 0.0)
        first, second = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
        back: list[tuple[int, int, int]] = [(0, 0, 0)] * (n + 1)
        first[0] = 0.0
        for i in range(n):
            here, other, j = first[i], second[i], i + 1
            node, piece, score = get(s[i], rest)
            if piece < 0:  # as bytes
                v, w = here + self.unknown, other + self.unknown
                if v > first[j]:
                    second[j], first[j], back[j] = max(first[j], w), v, (i, j, -1)
                elif v > second[j]:
                    second[j] = v
            while True:
                if piece >= 0:
                    v = here + score
                    if v > first[j]:
                        w = other + score
                        second[j] = w if w > first[j] else first[j]
                        first[j], back[j] = v, (i, j, piece)
                    elif v > second[j]:
                        second[j] = v
                if node is None or j == n or (step := node.get(s[j])) is None:
                    break
                node, piece, score = step
                j += 1
        path, j = [], n
        while j:
            path.append(back[j])
            j = back[j][0]
        return self.ids(s, path[::-1]), first[n], first[n] - second[n]

    def nbest(self, s: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations (score, ids) of a block, best first: A* from its end."""
        into = self.edges(s)
        ahead, _ = self.forward(into)
        count = itertools.count()
        # of equal estimates the one nearest the start goes first
        queue: list = [(-ahead[-1], len(s), next(count), 0.0, None)]
        out: list[tuple[float, list[int]]] = []
        while queue and len(out) < n:
            _, j, _, done, path = heapq.heappop(queue)
            if not j:
                steps = []
                while path:
                    step, path = path
                    steps.append(step)
                out.append((done, self.ids(s, steps)))
                continue
            for i, score, piece in into[j]:
                heapq.heappush(queue, (-(done + score + ahead[i]), i, next(count), done + score, ((i, j, piece), path)))
        return out

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode()[1:]


class Encoder:
    """Encodes texts in a task, remembering blocks."""

    def __init__(self, pieces: Pieces, n: int = NBEST):
        self.pieces, self.n = pieces, n
        self.known: dict[str, tuple[bytes, float, float]] = {}
        self.older: dict[str, tuple[bytes, float, float]] = {}  # blocks seen again come back from here
        self.lists: dict[str, list[tuple[float, list[int]]]] = {}

    def _block(self, s: str) -> tuple[bytes, float, float]:
        if len(self.known) >= CACHE:
            self.known, self.older = {}, self.known
        if (got := self.known.get(s) or self.older.get(s)) is None:
            ids, score, loss = self.pieces.best(s)
            got = array("i", ids).tobytes(), score, loss
        self.known[s] = got
        return got

    def _list(self, s: str) -> list[tuple[float, list[int]]]:
        if (got := self.lists.get(s)) is None:
            if len(self.lists) >= CACHE // 10:
                self.lists.clear()
            got = self.lists[s] = self.pieces.nbest(s, self.n)
        return got

    def encode(self, text: str | None) -> tuple[np.ndarray, list[float], list[list[tuple[int, int, list[int]]]]]:
        """(best ids, scores of the N best, for each of the others its edits (at, drop, ids) of the best)."""
        if not text:
            return np.zeros(0, np.int32), [0.0], []
        blocks = self.pieces.blocks.findall(" " + text)
        known, make = self.known.get, self._block
        got = [known(b) or make(b) for b in blocks]  # a generation that ends meanwhile is still read
        raw, scores, losses = zip(*got)
        ids = np.frombuffer(b"".join(raw), np.int32)
        score = sum(scores)
        losses = np.array(losses)
        near = np.argsort(losses, kind="stable")[:self.n - 1] if self.n > 1 else []
        near = [int(p) for p in near if losses[p] < math.inf]
        lists = [self._list(blocks[p]) for p in near]
        # the N best combinations of the lists' entries, by total loss
        start = (0,) * len(near)
        queue, seen, ranked = [(0.0, start)], {start}, []
        while queue and len(ranked) < self.n:
            loss, pick = heapq.heappop(queue)
            ranked.append((loss, pick))
            for k, entries in enumerate(lists):
                if pick[k] + 1 < len(entries):
                    more = (*pick[:k], pick[k] + 1, *pick[k + 1:])
                    if more not in seen:
                        seen.add(more)
                        step = entries[pick[k]][0] - entries[pick[k] + 1][0]
                        heapq.heappush(queue, (loss + step, more))
        if len(ranked) > 1:
            begin = np.cumsum([0, *map(len, raw)]) // 4
        edits = [sorted((int(begin[p]), int(begin[p + 1] - begin[p]), lists[k][c][1])
                        for k, (p, c) in enumerate(zip(near, pick)) if c) for _, pick in ranked[1:]]
        return ids, [score - loss for loss, _ in ranked], edits


#: The encoder of this Python worker's last task: what it remembers serves the next one.
_last: list[Encoder] = []


def _encoder_of_worker(pieces: Pieces, n: int) -> Encoder:
    if not _last or _last[0].pieces is not pieces or _last[0].n != n:
        _last[:] = [Encoder(pieces, n)]
    return _last[0]


def apply_edits(ids, edits) -> list[int]:
    """The ids of an alternative, from the best ids and the alternative's edits."""
    out, last = [], 0
    for at, drop, new in edits:
        out += [*ids[last:at], *new]
        last = at + drop
    return [*out, *ids[last:]]


def _encoder(pieces, n: int, text: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder_of_worker(pieces.value, n)
        for batch in batches:
            rows, size, first = [], 0, 0
            texts = batch.column(text)
            for at in range(batch.num_rows):
                body = texts[at].as_py()
                ids, scores, edits = encoder.encode(body)
                rows.append((ids, scores, edits, encoder.pieces.decode(ids.tolist()) == (body or "")))
                size += len(ids)
                if size >= OUT_IDS or at + 1 == batch.num_rows:
                    offsets = np.cumsum([0, *(len(r[0]) for r in rows)], dtype=np.int32)
                    columns = [
                        pa.array(np.diff(offsets).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([r[0] for r in rows]))),
                        pa.array([r[1] for r in rows], pa.list_(pa.float64())),
                        pa.array([[dict(zip(("rank", "at", "drop", "ids"), (k, *e))) for k, es in enumerate(r[2], 2) for e in es]
                                  for r in rows], _EDITS),
                        pa.array([r[3] for r in rows], pa.bool_())]
                    kept = batch.slice(first, at + 1 - first).drop_columns([text])
                    yield pa.RecordBatch.from_arrays(
                        [*kept.columns, *columns],
                        names=[*kept.schema.names, "n_tokens", "ids", "scores", "alternatives", "exact"])
                    rows, size, first = [], 0, at + 1
    return encode


def encode_pieces(docs: DataFrame, text: str = "text", *, model: str | None = None, n: int = NBEST) -> DataFrame:
    """``docs`` without the text, with n_tokens and ids of the best segmentation, the
    scores of the n best, the others (rank 2 to n) as edits of the best, and whether decoding
    gives back the text (columns of these names are replaced)."""
    pieces = docs.sparkSession.sparkContext.broadcast(Pieces.read(model or default_model()))
    new = ("n_tokens", "ids", "scores", "alternatives", "exact")
    return map_texts(in_small_batches(docs), text, _encoder(pieces, n, "text"), RESULT, new)


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
