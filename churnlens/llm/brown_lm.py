"""Language-model scoring with Brown classes: a class bigram model.

P(word | previous) = P(class | previous word's class) * P(word | class). The
classes come from exchange clustering: starting from words dealt out by
frequency, each item moves to the class that raises the likelihood of the
training bigrams most, given the counts of its left and right neighbours'
classes; the counts are taken anew from the whole corpus before every batch.
An item is a word with at least MIN_COUNT tokens, however large the corpus, or
one of GROUPS groups of rarer words with the same ending; every word has a
class, those not seen in training too.

A sweep has three batches. The HEAD most frequent words and the groups move one
after the other on the driver. The other words move in tasks, half of them at a
time: each task's counts go to the task of the item, which compares the classes
by the class bigrams counted before the batch. Moves made side by side can hinder
each other: a batch that lowers the recounted likelihood keeps a half, a quarter
and so on of its moves, or none.

What Spark does: word counts (partial counts per task, one shuffle), the
neighbours' class counts, the moves of all words but the HEAD first, the scores.
What the driver holds: the counts of HEAD + GROUPS items by class; the words
with at least 1 / KNOWN of the tokens (at most KNOWN words), which the tasks use
as a table; 64 bits of hash, a count and a class for each rarer item, of which the
tasks have hash and class. Items with equal hashes are one item. The full
vocabulary stays in Spark: occurrences of rarer words are counted per document,
joined with their counts by word, and summed back per document.

Smoothing: word counts + 0.5, with one more word of count 0 in every class
that has a group of rarer words; class transitions are interpolated with the
classes' own frequencies.

Defined results: a null or empty text is one end token; texts of any length are read whole; a
null doc_id trains like the empty string; repeated rows each count and get equal scores; with no
training text every word is unknown; an empty table gives an empty table; columns named like the
results are replaced, all others stay, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from churnlens.llm.text import in_small_batches, quoted
from churnlens.operators.joins import materialize
from churnlens.session import scratch

CLASSES = 32
GROUPS = 256
#: Words with at least so many tokens are items.
MIN_COUNT = 5
#: If set, items are only words with at least one token in so many.
ITEMS = None
#: The most frequent words, moved one after the other.
HEAD = 4096
#: What the tasks' items are dealt out by.
BUCKETS = 4096
#: How often the moves of a batch are halved before it is dropped.
HALVINGS = 4
#: Words with at least one token in so many are a table in the tasks, the others are joined.
KNOWN = 1 << 20
SWEEPS = 3
ADD = 0.5
#: Weight, in tokens, of the classes' own frequencies in the transitions.
BACKOFF = 10.0
KEYS = 1 << 21  # neighbours that a task counts at once
ROW = 1 << 18  # tokens in a row of item ids (a longer text makes a longer row)
SEED = 42
END = b""


def group_of(word: bytes) -> int:
    return crc32(word[-3:]) % GROUPS


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different tokens of a batch of texts; of all tokens, text after text, which of them each is;
    where each text starts. An end follows the words of every text."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    # cut at the space behind the last word, the empty word is left: the end
    texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(texts, "", " "))
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary.cast(pa.binary()), coded.indices.to_numpy().astype(np.int64), np.cumsum(sizes) - sizes


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, code, _ = _tokens(batch.column("text"))
        yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(code, minlength=len(words)), pa.int64())],
                                         names=["word", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all tokens of the column ``text``, the end token being the empty word."""
    return (texts.mapInArrow(_count_words, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


@dataclass
class Model:
    """A fitted model. ``vocabulary`` is a table (word, n) of all training words."""
    vocabulary: DataFrame
    tokens: int
    types: int
    known: dict[bytes, tuple[int, int]]  # word -> (item, count)
    known_from: int  # words with this count or more are in ``known``
    rarer: np.ndarray  # sorted hashes of the items that are not in ``known``: the last of the words
    class_of: np.ndarray  # by item: words, groups, end
    transition: np.ndarray  # log10, (previous class, class)
    emitted: np.ndarray  # log10 of each class's denominator

    def group_item(self, word: bytes) -> int:
        return len(self.class_of) - 1 - GROUPS + group_of(word)


def rare_items(words: list[bytes], rarer: np.ndarray, n_words: int) -> list[int]:
    """Items of words that are not in the tasks' table."""
    if not len(rarer):
        return [n_words + group_of(w) for w in words]
    hashes = np.array([xxh64_intdigest(w, SEED) for w in words], np.uint64)
    at = np.minimum(np.searchsorted(rarer, hashes), len(rarer) - 1)
    first = n_words - len(rarer)
    return [first + i if hit else n_words + group_of(w)
            for w, i, hit in zip(words, at.tolist(), (rarer[at] == hashes).tolist())]


@dataclass
class Lookup:
    """What the tasks know of words: the table's words with their items and log10 counts, the end
    behind them (its score is added per text), and the hashes of the other items."""
    place: dict[bytes, int]
    item: np.ndarray
    log: np.ndarray
    rarer: np.ndarray
    n_words: int

    @classmethod
    def of(cls, known: dict[bytes, tuple[int, int]], rarer: np.ndarray, n_words: int) -> Lookup:
        place = {w: k for k, w in enumerate(known)}
        place[END] = len(known)
        item, count = np.array([*known.values(), (n_words + GROUPS, 1)], np.int64).T
        return cls(place, item.astype(np.uint32), np.r_[np.log10(count[:-1] + ADD), 0.0], rarer, n_words)

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items and log10 counts (0 if not in the table) of different words, and which are not in it."""
        words = words.to_numpy(zero_copy_only=False).tolist()
        place = np.array([self.place.get(w, -1) for w in words], np.int64)
        item, log = self.item[place], self.log[place]
        rare = place < 0
        at = np.flatnonzero(rare)
        log[at] = 0.0
        item[at] = rare_items([words[i] for i in at.tolist()], self.rarer, self.n_words)
        return item, log, rare


def _item_ids(shared):
    """Texts to item ids: every row some texts', with an end before the first and after each."""
    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup: Lookup = shared.value
        end = np.array([lookup.n_words + GROUPS], np.uint32)
        for batch in batches:
            words, code, starts = _tokens(batch.column("text"))
            item = lookup.find(words)[0][code]
            cuts = np.unique(np.r_[starts, len(item)][np.searchsorted(starts, np.arange(0, len(item) + ROW, ROW))])
            parts = [np.concatenate([end, item[a:b]]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], names=["ids"])
    return ids


def _neighbours(class_of, n_classes: int, head: int, n_words: int):
    """Counts of the left and the right neighbours' classes, and of itself, per head word, group and
    end seen in the task; behind them, each class's counts as if it were an item."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = class_of.value
        tops = head + len(classes) - n_words
        size = (tops + n_classes) * n_classes
        left, right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        twice = np.zeros(tops + n_classes, np.int64)
        for batch in batches:
            for raw in batch.column("ids"):
                item = np.frombuffer(raw.as_buffer(), np.uint32).astype(np.int64)
                cls = classes[item].astype(np.int64)
                slot = np.where(item >= n_words, item - n_words + head, np.where(item < head, item, -1))
                at = np.flatnonzero(slot >= 0)
                after, before = at[at > 0], at[at < len(item) - 1]
                left += np.bincount(slot[after] * n_classes + cls[after - 1], minlength=size)
                right += np.bincount(slot[before] * n_classes + cls[before + 1], minlength=size)
                left += np.bincount((tops + cls[1:]) * n_classes + cls[:-1], minlength=size)
                twice += np.bincount(slot[after[item[after] == item[after - 1]]], minlength=len(twice))
        rows = np.concatenate([left.reshape(-1, n_classes), right.reshape(-1, n_classes), twice[:, None]], axis=1)
        seen = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array([r.tobytes() for r in rows[seen].astype("<u4")], pa.binary())],
            names=["item", "counts"])
    return count


def _sum_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for item, raw in zip(batch.column("item").to_pylist(), batch.column("counts")):
            row = np.frombuffer(raw.as_buffer(), "<u4")
            if item in sums:
                sums[item] += row
            else:
                sums[item] = row.astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([r.tobytes() for r in sums.values()], pa.binary())],
        names=["item", "counts"])


def _class_counts(ids: DataFrame, class_of: np.ndarray, n_classes: int, head: int, n_words: int):
    """(left, right, twice) of the head words, groups and end, and the class bigrams, over the corpus."""
    shared = ids.sparkSession.sparkContext.broadcast(class_of.astype(np.int16))
    rows = (ids.mapInArrow(_neighbours(shared, n_classes, head, n_words), "item int, counts binary")
            .repartition("item").mapInArrow(_sum_items, "item int, counts binary").collect())  # a row per item
    shared.destroy()
    tops = head + len(class_of) - n_words
    table = np.zeros((tops + n_classes, 2 * n_classes + 1), np.int64)
    for r in rows:
        table[r["item"]] = np.frombuffer(r["counts"], np.int64)
    return table[:tops, :n_classes], table[:tops, n_classes:-1], table[:tops, -1], table[tops:, :n_classes].T.copy()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(keys) else counts


def _rest_neighbours(class_of, n_classes: int, head: int, n_words: int, part: int):
    """As ``_neighbours``, of every second word behind the head: per bucket, sorted keys
    (place in the bucket, column) and their counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, width = class_of.value, 2 * n_classes + 1
        span = (n_words // 2 // BUCKETS + 1) * width  # keys of a bucket
        found, held, sums = [], 0, []

        def sum_up():
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            found.clear()
            sums.append((keys, counts))

        def flush():
            keys, counts = _summed(*map(np.concatenate, zip(*sums)))
            sums.clear()
            cuts = np.flatnonzero(np.diff(keys // span)) + 1
            rows = [(int(k[0] // span), (k % span).astype("<u4").tobytes(), c.astype("<u4").tobytes())
                    for k, c in zip(np.split(keys, cuts), np.split(counts, cuts)) if len(k)]
            cols = list(zip(*rows)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.binary(), pa.binary()))],
                                              names=["bucket", "keys", "counts"])
        for batch in batches:
            for raw in batch.column("ids"):
                item = np.frombuffer(raw.as_buffer(), np.uint32).astype(np.int64)
                cls = classes[item].astype(np.int64)
                # the first and the last token are ends
                at = np.flatnonzero((item >= head) & (item < n_words) & (item % 2 == part))
                place = item[at] // 2
                base = place % BUCKETS * span + place // BUCKETS * width
                same = item[at] == item[at - 1]
                found += [base + cls[at - 1], base + n_classes + cls[at + 1], base[same] + 2 * n_classes]
                held += 2 * len(at)
                if held > KEYS:
                    sum_up()
                    held = 0
                    if sum(len(k) for k, _ in sums) > 2 * KEYS:
                        yield flush()
        if found:
            sum_up()
        if sums:
            yield flush()
    return count


def _best_moves(shared, n_classes: int, part: int):
    """Buckets in order, to the items that move and their new classes."""
    def best(bucket: int, blobs: list[tuple[bytes, bytes]]):
        class_of, pairs = shared.value
        keys, counts = _summed(np.concatenate([np.frombuffer(k, "<u4") for k, _ in blobs]).astype(np.int64),
                               np.concatenate([np.frombuffer(c, "<u4") for _, c in blobs]).astype(np.int64))
        places, row = np.unique(keys // (2 * n_classes + 1), return_inverse=True)
        items = (places * BUCKETS + bucket) * 2 + part
        out = []
        for k in range(0, len(items), 1024):
            at = slice(*np.searchsorted(row, [k, k + 1024]))
            table = np.zeros((min(1024, len(items) - k), 2 * n_classes + 1), np.int64)
            table[row[at] - k, keys[at] % (2 * n_classes + 1)] = counts[at]
            own = class_of[items[k:k + 1024]].astype(np.int64)
            gain = gains(pairs, own, table[:, :n_classes], table[:, n_classes:-1], table[:, -1])
            new = gain.argmax(1)
            rows = np.arange(len(own))
            out.append(np.where(gain[rows, new] > gain[rows, own] + 1e-9, new, own))
        new = np.concatenate(out)
        moved = new != class_of[items]
        return bucket, items[moved].astype("<u4").tobytes(), new[moved].astype("<i2").tobytes()

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in best(last, blobs)], names=["bucket", "items", "classes"])
        last, blobs = None, []
        for batch in batches:
            for bucket, *blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "counts"))):
                if bucket != last and blobs:
                    yield done()
                    blobs = []
                last = bucket
                blobs.append(blob)
        if blobs:
            yield done()
    return lambda batches: (b.cast(MOVES) for b in moves(batches))


MOVES = pa.schema([("bucket", pa.int32()), ("items", pa.binary()), ("classes", pa.binary())])


def exchange_rest(ids: DataFrame, class_of: np.ndarray, pairs: np.ndarray, n_classes: int, head: int, n_words: int,
                  part: int) -> np.ndarray:
    """Every second word behind the head moves to its best class, given the class bigrams ``pairs``."""
    sc = ids.sparkSession.sparkContext
    small = class_of.astype(np.int16)
    classes, both = sc.broadcast(small), sc.broadcast((small, pairs))
    counts = ids.mapInArrow(_rest_neighbours(classes, n_classes, head, n_words, part), "bucket int, keys binary, counts binary")
    rows = (counts.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_best_moves(both, n_classes, part), "bucket int, items binary, classes binary").collect())
    classes.destroy()
    both.destroy()
    class_of = class_of.copy()
    for r in rows:
        class_of[np.frombuffer(r["items"], "<u4")] = np.frombuffer(r["classes"], "<i2")
    return class_of


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def class_bigrams(left: np.ndarray, class_of: np.ndarray, n_classes: int) -> np.ndarray:
    """Counts (previous class, class)."""
    out = np.zeros((n_classes, n_classes), np.int64)
    np.add.at(out, class_of, left)
    return out.T.copy()


def likelihood(pairs: np.ndarray) -> float:
    """What exchange raises: the part of the training log-likelihood that depends on the classes."""
    return float(_h(pairs).sum() - _h(pairs.sum(0)).sum() - _h(pairs.sum(1)).sum())


def gains(pairs: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Per item (row) and class: the likelihood with the item in that class, up to a constant of the item."""
    free, rows = len(pairs) - 1, np.arange(len(own))
    l, r = left.copy(), right.copy()  # noqa: E741
    l[rows, own] -= twice
    r[rows, own] -= twice
    out = np.zeros((len(own), free))

    def add(table, mine, theirs, with_self):
        # cells of the classes that the item's neighbours have, first without the item, then with it
        at, c = np.nonzero(mine)
        cells = table[c, :free]
        cells[np.arange(len(at)), own[at]] -= with_self[at, c]
        inside = np.flatnonzero(c == own[at])
        cells[inside] -= theirs[at[inside], :free]
        cells[inside, own[at[inside]]] += twice[at[inside]]
        np.maximum(cells, 0, out=cells)
        change = _h(cells + mine[at, c][:, None]) - _h(cells)
        on = np.flatnonzero(c < free)
        change[on, c[on]] = 0  # the diagonal below
        if len(at):
            starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            out[at[starts]] += np.add.reduceat(change, starts)
    add(pairs, l, right, left)
    add(pairs.T, r, left, right)
    cells = np.tile(pairs.diagonal()[:free], (len(own), 1))
    cells[rows, own] -= left[rows, own] + right[rows, own] - twice
    np.maximum(cells, 0, out=cells)
    out += _h(cells + l[:, :free] + r[:, :free] + twice[:, None]) - _h(cells)
    for sums, n in ((pairs.sum(1), right.sum(1)), (pairs.sum(0), left.sum(1))):
        cells = np.tile(sums[:free], (len(own), 1))
        cells[rows, own] -= n
        np.maximum(cells, 0, out=cells)
        out -= _h(cells + n[:, None]) - _h(cells)
    return out


def exchange(left, right, twice, class_of: np.ndarray, n_classes: int, items, pairs: np.ndarray | None = None) -> np.ndarray:
    """Each of ``items`` in turn moves to its best class (the end keeps its own). ``pairs`` has the
    class bigrams if the tables lack some items."""
    class_of = class_of.copy()
    pairs = class_bigrams(left, class_of, n_classes) if pairs is None else pairs.copy()
    for w in items:
        if not left[w].any():
            continue
        a, l, r, s = class_of[w], left[w].copy(), right[w].copy(), int(twice[w])  # noqa: E741
        b = int(gains(pairs, class_of[w:w + 1], left[w:w + 1], right[w:w + 1], twice[w:w + 1])[0].argmax())
        if a == b:
            continue
        pairs[:, a] -= l
        pairs[a, :] -= r
        pairs[a, a] += s
        l[a] -= s
        r[a] -= s
        pairs[:, b] += l
        pairs[b, :] += r
        pairs[b, b] += s
        np.maximum(pairs, 0, out=pairs)  # neighbours that moved in this batch leave small errors until the recount
        class_of[w] = b
    return class_of


def kept_moves(count, old: np.ndarray, new: np.ndarray, counted):
    """As many of the moves from ``old`` to ``new`` as do not lower the likelihood, and the counts with them.
    ``count`` takes the counts of classes anew; ``counted`` are those of ``old``."""
    moved, low = np.flatnonzero(new != old), likelihood(counted[3])
    for k in range(HALVINGS + 1 if len(moved) else 0):
        some = moved[::1 << k]
        trial = old.copy()
        trial[some] = new[some]
        got = count(trial)
        if likelihood(got[3]) >= low:
            return trial, got
    return old, counted


def fit(docs: DataFrame, text: str = "text", *, classes: int = CLASSES, sweeps: int = SWEEPS,
        items: int | None = ITEMS, known: int = KNOWN, min_count: int = MIN_COUNT, head: int = HEAD) -> Model:
    """Learns from all rows of ``docs``."""
    spark = docs.sparkSession
    texts = in_small_batches(docs).select(quoted(text).alias("text"))
    vocabulary = materialize(word_counts(texts), "vocabulary")
    tokens, types = vocabulary.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens = tokens or 0
    # at most ``known`` words have one token in ``known``
    known_from, item_from = max(1, -(-tokens // known)), max(1, min_count, -(-tokens // items) if items else 1)
    top = sorted(((-r["n"], bytes(r["word"])) for r in vocabulary.filter(F.col("n") >= known_from).collect()
                  if r["word"]))
    n_top, n_classes = sum(-n >= item_from for n, _ in top), classes + 1
    more = vocabulary.filter((F.col("n") >= item_from) & (F.col("n") < known_from) & (F.octet_length("word") > 0))
    more = more.select(F.xxhash64("word").alias("h"), "n").toArrow()  # two numbers an item
    rarer, at = np.unique(more["h"].to_numpy().view(np.uint64), return_inverse=True)
    n_words = n_top + len(rarer)
    group_item = lambda w: n_words + group_of(w)
    table = {w: (i if i < n_top else group_item(w), -n) for i, (n, w) in enumerate(top)}
    class_of = np.r_[np.arange(n_words + GROUPS) % classes, classes]

    head = min(head, n_top)
    tops = np.r_[:head, n_words:len(class_of)]  # the items that move in turn, the end behind them
    with scratch(spark):
        shared = spark.sparkContext.broadcast(Lookup.of(table, rarer, n_words))
        ids = materialize(texts.mapInArrow(_item_ids(shared), "ids binary"), "item-ids")
        count = lambda c: _class_counts(ids, c, n_classes, head, n_words)
        counted = count(class_of)
        for sweep in range(sweeps):
            left, right, twice, pairs = counted
            # half of the items at a time, so that neighbours do not swap places together
            half = [w for w in range(len(tops) - 1) if sweeps == 1 or (w + sweep) % 2 or sweep == 0]
            new = class_of.copy()
            new[tops] = exchange(left, right, twice, class_of[tops], n_classes, half, pairs)
            class_of, counted = kept_moves(count, class_of, new, counted)
            for part in (0, 1) if n_words > head else ():
                new = exchange_rest(ids, class_of, counted[3], n_classes, head, n_words, part)
                class_of, counted = kept_moves(count, class_of, new, counted)
        pairs = counted[3].astype(float)
        shared.destroy()

    own = (pairs.sum(0) + 1) / (pairs.sum() + n_classes)
    transition = np.log10((pairs + BACKOFF * own) / (pairs.sum(1, keepdims=True) + BACKOFF))
    # a class's tokens and types: its words and the words of its groups
    tail = np.zeros((GROUPS, 2))
    rest = vocabulary.filter((F.col("n") < item_from) & (F.octet_length("word") > 0))
    for r in (rest.groupBy((F.crc32(F.expr("substring(word, greatest(length(word) - 2, 1), 3)")) % GROUPS).alias("g"))
              .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()):  # a row per group
        tail[r["g"]] = r["n"], r["types"]
    total, kinds = np.zeros(n_classes), np.zeros(n_classes)
    counts = np.array([-n for n, _ in top[:n_top]], float)
    np.add.at(total, class_of[:-1], np.r_[counts, np.bincount(at, more["n"].to_numpy(), len(rarer)), tail[:, 0]])
    np.add.at(kinds, class_of[:-1], np.r_[np.ones(n_top), np.bincount(at, minlength=len(rarer)), tail[:, 1]])
    unseen = np.zeros(n_classes)
    unseen[class_of[n_words:-1]] = 1
    emitted = np.log10(np.maximum(total + ADD * (kinds + unseen), ADD))
    return Model(vocabulary, tokens, types, table, known_from, rarer, class_of, transition, emitted)


def _sums(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts) if len(starts) else np.zeros(0)


def _score(shared):
    """Per text: tokens, the scores of all it can tell without the full vocabulary, and the rarer words."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, class_of, transition, emitted, base_total, end = shared.value
        end_class = len(emitted) - 1  # the end is alone in its class
        step = transition - np.r_[emitted[:-1], 0.0]
        for batch in batches:
            words, code, starts = _tokens(batch.column("text"))
            item, log, rare = lookup.find(words)
            cls, size = class_of[item[code]], np.diff(np.r_[starts, len(code)])
            # every text follows an end, as the one before it has one
            model = _sums(step[np.r_[end_class, cls[:-1]], cls], starts)
            log_n = _sums(log[code], starts)
            # the rare words of all texts behind each other
            of_text = np.repeat(np.arange(len(starts)), size)
            at = np.flatnonzero(rare[code])
            once, times = np.unique(of_text[at] * len(words) + code[at], return_counts=True)
            offsets = np.searchsorted(once, np.arange(len(starts) + 1) * len(words))
            known = size - 1 - np.bincount(of_text[at], minlength=len(starts))
            cols = (size, known, log_n + end - base_total * size, log_n + model)
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            pairs = pa.StructArray.from_arrays([words.take(pa.array(once % max(1, len(words)))), pa.array(times, pa.int32())], ["word", "k"])
            kept = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(c, t) for c, t in zip(cols, types)),
                                              pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)],
                                             names=[*kept.schema.names, "n_tokens", "n_known", "base_score", "score", "__rare"])
    return score


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the text, with n_tokens, n_known, train_tokens, base_score (unigram) and
    score (the model's log10 probability of the whole text); columns of these names are replaced."""
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in docs.columns if c != text and c not in new]
    inside = [f"c{i}" for i in range(len(kept))]  # names of their own meanwhile
    base_total = math.log10(model.tokens + ADD * (model.types + 1))
    ends = model.vocabulary.filter(F.octet_length("word") == 0).first()
    end = math.log10((ends["n"] if ends else 0) + ADD)
    n_words = len(model.class_of) - 1 - GROUPS
    shared = docs.sparkSession.sparkContext.broadcast(
        (Lookup.of(model.known, model.rarer, n_words), model.class_of.astype(np.int16), model.transition, model.emitted,
         base_total, end))
    named = docs.select(*[quoted(c).alias(i) for c, i in zip(kept, inside)], quoted(text).alias("text"))
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in named.drop("text").schema),
                        "n_tokens long, n_known long, base_score double, score double, "
                        "__rare array<struct<word:binary, k:int>>"])
    part = materialize(named.mapInArrow(_score(shared), schema)
                       .withColumn("__row", F.monotonically_increasing_id()), "scores")
    # words below the tasks' table: joined with their counts, summed per text
    rest = model.vocabulary.filter(F.col("n") < model.known_from)
    rare = part.select("__row", F.explode("__rare").alias("r")).select("__row", "r.word", "r.k")
    n = F.coalesce("n", F.lit(0))
    more = (rare.join(rest, "word", "left").groupBy("__row")
            .agg(F.sum(F.when(n > 0, F.col("k")).otherwise(0)).alias("__known"),
                 F.sum(F.col("k") * F.log10(n + ADD)).alias("__log")))
    known_end = 1 if ends else 0
    log = F.coalesce("__log", F.lit(0.0))
    return (part.join(more, "__row", "left").select(
        *[F.col(i).alias(c) for c, i in zip(kept, inside)], "n_tokens",
        (F.col("n_known") + F.coalesce("__known", F.lit(0)) + known_end).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + log).alias("base_score"), (F.col("score") + log).alias("score")))


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return score(docs.withColumn("held_out", held_out(F.col("doc_id"))), model)
