"""Vector codes: every vector as a few indexes into learned codebooks (product quantization),
in whole numbers.

Vectors become integers (``floor(1024 x)``) and are cut into equal parts; each part position
has a codebook, which starts with the parts of the rows of smallest id and is moved by rounds
of assigning every part to its nearest entry and replacing entries by the floor of their
parts' means. All arithmetic is on integers, so the result is the same for every
partitioning.

The distances are those of a trie. Equal parts are counted once (their number is the weight
in the sums), the distinct parts are range-partitioned and sorted, and every task walks the
trie of its slice depth-first: a node holds the distances of its prefix of dimensions to all
entries, which everything below it shares, and a leaf takes the smallest one and adds its
weighted part to its entry's sum. Subtrees of up to ``LEAVES`` leaves are finished level by
level as arrays, one row a node, instead of node by node. A task returns one sum a codebook
entry and dimension, whatever it has read; the driver holds the codebooks only (``parts x
entries`` rows). The final codes are computed where the rows lie, by the same walk over the
distinct parts of each batch, so rows and parts are never joined; a row's group of equal labels
is met through one aggregate and one size-checked or salted join.

Defined results: rows whose vector is null or holds a null, infinite or NaN component go; ids
and labels may be null, a null id counts as the largest, and rows that repeat an id follow the
order of their vectors; repeated rows each keep their row; with fewer rows than entries the
codebooks are smaller; an empty table gives an empty table; vectors of length 0 have index 0
and error 0 everywhere. Vectors of different lengths, lengths that do not divide
into the parts, and components so large that an error would pass 64 bits are refused with an
error. Columns other than the three named are left out, so none can clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.operators.joins import join_small, materialize

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Leaves of a subtree that is finished as arrays.
LEAVES = 512


# --- The trie over distinct parts -------------------------------------------------------

def in_order(parts: np.ndarray) -> np.ndarray:
    """Indexes that sort rows lexicographically."""
    return np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))


def _bundle(parts: np.ndarray, entries: np.ndarray, depth: int, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, distance) of sorted rows below one node: each level has one row of
    distances per distinct prefix, made from its parent's."""
    near, node = above[None, :], np.zeros(len(parts), np.intp)
    apart = np.zeros(len(parts), bool)  # rows that begin a new prefix
    apart[:1] = True
    for d in range(depth, parts.shape[1]):
        column = parts[:, d]
        if len(near) < len(parts):
            apart[1:] |= column[1:] != column[:-1]
            first = np.flatnonzero(apart)
            near = near[node[first]]
            node = np.cumsum(apart) - 1
            column = column[first]
        step = entries[:, d][None, :] - column[:, None]
        near = near + step * step
    best = near.argmin(axis=1)
    return best[node], near[np.arange(len(near)), best][node]


def walk(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of lexicographically sorted rows; ties go to the lower
    entry. Depth-first: a node with more than LEAVES rows is entered child by child, its
    distances shared by all of them; smaller neighbours are finished together."""
    n, width = parts.shape
    top = max((int(np.abs(a).max()) for a in (parts, entries) if a.size), default=0)
    kind = np.int32 if 4 * top * top * max(1, width) < 2**31 else np.int64  # both are exact
    parts, entries = parts.astype(kind), entries.astype(kind)
    best, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    stack = [(0, n, 0, np.zeros(len(entries), kind))]
    while stack:
        low, high, depth, above = stack.pop()
        if high - low <= LEAVES or depth == width:
            best[low:high], error[low:high] = _bundle(parts[low:high], entries, depth, above)
            continue
        column = parts[low:high, depth]
        cuts = np.flatnonzero(column[1:] != column[:-1]) + 1
        starts, ends = np.r_[0, cuts] + low, np.r_[cuts, high - low] + low
        children, begin = [], low
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s > LEAVES:
                step = entries[:, depth] - parts[s, depth]
                children.append((s, e, depth + 1, above + step * step))
            if e - s > LEAVES or e - begin > LEAVES:  # what lies before goes as one
                if s > begin:
                    best[begin:s], error[begin:s] = _bundle(parts[begin:s], entries, depth, above)
                begin = e if e - s > LEAVES else s
        if begin < high:
            best[begin:high], error[begin:high] = _bundle(parts[begin:high], entries, depth, above)
        stack += children[::-1]
    return best, error


def _lists(column) -> np.ndarray:
    """A column of equally long lists as rows of an array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(n, len(flat) // n if n else 0)


def _sums(books, width: int):
    """Task side of a round: (pos, entry, dim, total) of the weighted parts by nearest entry;
    dim -1 is the weight itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.value
        total = np.zeros((len(entries), len(entries[0]), width + 1), np.int64)
        for batch in batches:
            pos, n = batch.column("pos").to_numpy(), batch.column("n").to_numpy()
            parts = _lists(batch.column("part"))
            for p in np.unique(pos):
                mine = np.flatnonzero(pos == p)
                mine = mine[in_order(parts[mine])]
                best, _ = walk(parts[mine], entries[p])
                by_entry = np.argsort(best, kind="stable")
                hit, first = np.unique(best[by_entry], return_index=True)
                weight = n[mine[by_entry]]
                weighted = np.column_stack([parts[mine[by_entry]] * weight[:, None], weight])
                total[p, hit] += np.add.reduceat(weighted, first, axis=0)
        p, e, d = np.nonzero(np.broadcast_to(total[:, :, -1:] > 0, total.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(np.where(d == width, -1, d), pa.int32()),
             pa.array(total[p, e, d], pa.int64())], names=["pos", "entry", "dim", "total"])
    return run


def _codes(books, parts: int):
    """Task side of the encoding: code and error of every row of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.value
        digits = np.array([f"{i:02x}" for i in range(max(256, len(entries[0])))])
        for batch in batches:
            vectors = _lists(batch.column("v"))
            width = vectors.shape[1] // parts
            code, error = np.full(len(vectors), "", object), np.zeros(len(vectors), np.int64)
            for p in range(parts):
                mine = vectors[:, p * width:(p + 1) * width]
                order = in_order(mine)
                ordered = mine[order]
                new = np.ones(len(mine), bool)
                new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
                best, far = walk(ordered[new], entries[p])
                at = np.empty(len(mine), np.intp)
                at[order] = np.cumsum(new) - 1
                code += digits[best[at]].astype(object)
                error += far[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                names=["id", "label", "code", "error"])
    return run


# --- Spark side ---------------------------------------------------------------------------

def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale x)`` of every component, as long as no error of such a vector can pass 64 bits."""
    bound = F.sqrt(F.lit(float(2**63 - 1)) / F.greatest(F.size(vector), F.lit(1))) / 2 - 1
    return F.transform(vector, lambda x: F.when(
        F.abs(x.cast("double") * scale) < F.least(bound, F.lit(2.0**31 - 1)), F.floor(x.cast("double") * scale).cast("int"))
        .otherwise(F.raise_error(F.lit("a component is too large for the codes' integer arithmetic")).cast("int")))


def usable(rows: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part, v as integers."""
    v = F.col("v")
    named = rows.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("v"))
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return named.filter(fine).withColumn("v", whole_numbers(v, scale))


def distinct_parts(points: DataFrame, parts: int, width: int) -> DataFrame:
    """(pos, part, n): the distinct parts with their numbers, in slices of the lexicographic order."""
    cut = F.array(*[F.slice("v", p * width + 1, width) if width else F.col("v") for p in range(parts)])
    counted = (points.select(F.posexplode(cut).alias("pos", "part"))
               .groupBy("pos", "part").agg(F.count(F.lit(1)).alias("n")))
    counted = materialize(counted, "part-counts")  # the range bounds are sampled from it
    return materialize(counted.repartitionByRange("pos", "part").sortWithinPartitions("pos", "part"), "distinct-parts")


def _first_books(points: DataFrame, parts: int, width: int, entries: int) -> np.ndarray:
    """parts x entries x width: the parts of the rows of smallest id (at most ``entries`` rows)."""
    first = points.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    v = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width)
    return v.transpose(1, 0, 2).copy()


def _moved(books: np.ndarray, sums: DataFrame) -> np.ndarray:
    """The entries replaced by the floor of their parts' means; unused ones stay."""
    rows = (sums.groupBy("pos", "entry", "dim").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
            .collect())  # at most parts x entries x (width + 1) numbers
    count = {(r["pos"], r["entry"]): int(r["total"]) for r in rows if r["dim"] < 0}
    books = books.copy()
    for r in rows:
        if r["dim"] >= 0:
            books[r["pos"], r["entry"], r["dim"]] = int(r["total"]) // count[r["pos"], r["entry"]]
    return books


def learn_codebooks(points: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (parts x entries x width) of a written table of ``usable`` rows."""
    sc = points.sparkSession.sparkContext
    n, short, long = points.agg(F.count(F.lit(1)), F.min(F.size("v")), F.max(F.size("v"))).first()
    if not n:
        return np.zeros((parts, 0, 0), np.int64)
    if short != long or short % parts:
        raise ValueError(f"vectors of one length that {parts} divides are needed, not of lengths {short} to {long}")
    width = short // parts
    books = _first_books(points, parts, width, entries)
    if not width:
        return books
    trie = distinct_parts(points, parts, width)
    for _ in range(rounds):
        shared = sc.broadcast(books)
        books = _moved(books, trie.mapInArrow(_sums(shared, width), "pos int, entry int, dim int, total long"))
        shared.unpersist()
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", *,
                   parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                   scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): id, label, code (two hex digits a part), error (squared distances
    summed over the parts) and label_error (error summed over equal labels) of every usable row."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    spark = rows.sparkSession
    points = materialize(usable(rows, vec_id, vector, label, scale), "vector-points")
    books = learn_codebooks(points, parts=parts, entries=entries, rounds=rounds)
    types = {f.name: f.dataType.simpleString() for f in points.schema}
    schema = f"id {types['id']}, label {types['label']}, code string, error long"
    if not books.shape[1]:
        return spark.createDataFrame([], schema + ", label_error long"), books
    shared = spark.sparkContext.broadcast(books)
    codes = points.mapInArrow(_codes(shared, parts), schema)
    # labels as text and a flag, so that nulls meet and a hot label can be salted
    codes = materialize(codes.withColumns({"__none": F.col("label").isNull(),
                                           "__label": F.coalesce(F.col("label").cast("string"), F.lit(""))}), "vector-codes")
    keys = ["__none", "__label"]
    total = codes.groupBy(*keys).agg(F.sum("error").alias("label_error"))
    return join_small(codes, total, keys).select("id", "label", "code", "error", "label_error"), books


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    codes, books = encode_vectors(rows)
    return codes.select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                        F.lit(books_digest(books)).alias("codebooks_sha256"))


def _round_sql(i: int) -> str:
    """One round: parts to their nearest entries, entries to the floor of the means."""
    return f"""
n{i} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min((xx + ee - 2 * list_dot_product(x, e))::BIGINT * 256 + j) AS near
  FROM q JOIN c{i} USING (p) GROUP BY r, p),
u{i} AS (SELECT p, j, list(m ORDER BY d) AS e FROM (
  SELECT p, near % 256 AS j, d, floor(sum(x[d]) / count(*)) AS m FROM n{i}, ds GROUP BY p, near % 256, d) GROUP BY p, j),
c{i + 1} AS MATERIALIZED (SELECT *, list_dot_product(e, e) AS ee FROM (
  SELECT c.p, c.j, coalesce(u.e, c.e) AS e FROM c{i} c LEFT JOIN u{i} u ON c.p = u.p AND c.j = u.j)),"""


OP11_SQL = r"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
t AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, len(v) // 4 AS w FROM k),
ds AS (SELECT unnest(range(1, (SELECT max(w) FROM t) + 1)) AS d),
q AS MATERIALIZED (SELECT *, list_dot_product(x, x) AS xx FROM (
  SELECT r, p, list_slice(v, p * w + 1, p * w + w) AS x FROM t, (SELECT unnest(range(4)) AS p))),
c0 AS MATERIALIZED (SELECT p, r - 1 AS j, x AS e, xx AS ee FROM q WHERE r <= 256),""" + "".join(map(_round_sql, range(ROUNDS))) + r"""
z AS (SELECT r, p, min((xx + ee - 2 * list_dot_product(x, e))::BIGINT * 256 + j) AS near FROM q JOIN c4 USING (p) GROUP BY r, p),
y AS (SELECT r, string_agg(printf('%02x', near % 256), '' ORDER BY p) AS code, sum(near // 256)::BIGINT AS error FROM z GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(e[d]::BIGINT::VARCHAR, ',' ORDER BY p, j, d)) FROM c4, ds) AS codebooks_sha256
FROM t JOIN y USING (r)
"""
