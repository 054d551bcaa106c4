"""Approximate nearest neighbours by multiprobe p-stable hashing.

Every table projects a vector onto ``HASHES`` Gaussian directions and cuts each
projection into steps of one width; the steps form the bucket. A query
visits its own bucket and, in the order of estimated success (the smaller the
squared distances from the query to the borders it crosses, the likelier),
``PROBES`` buckets of each table that differ by one step in some directions. The
bucket's rows are measured exactly where they lie, each visit keeps its
nearest, and the tables' lists are merged.

Equal vectors are one row with their smallest ids, so copies of a vector cost
nothing. Buckets with more than ``CHUNK`` rows or visits are cut into chunks
(rows meet all visiting chunks and the other way round), so a task holds at
most a chunk of visits and a batch of rows. A query that found fewer than
k rows is compared with all rows, in blocks of queries.

The width is set from the mean distance of at most ``FIT_ROWS`` vectors, picked by
a hash of their ids. All rows are indexed.

Defined results: rows with a null id, and vectors that are null, zero,
empty, or hold null or non-finite values, take no part; vectors of different lengths have no
distance, so each is searched among those of its length; rows
equal in id and vector count once; equal distances go to the smaller id; an
empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from churnlens.llm.text import quoted
from churnlens.operators.joins import materialize

NEAREST = 10
TABLES = 12
HASHES = 8
PROBES = 80
#: Width of a step, in mean distances of the sample.
WIDTH = 1.41
FIT_ROWS = 1000
CHUNK = 16384
BLOCK = 256  # queries compared with all rows at once
HELD = 1 << 23  # numbers held at once while measuring
SEED = 11


class Hashes:
    """The tables' directions, offsets and bucket names."""

    def __init__(self, dim: int, width: float, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES):
        rng = np.random.default_rng(SEED)
        self.width, self.tables, self.hashes, self.probes = width, tables, hashes, probes
        self.directions = rng.normal(size=(dim, tables * hashes))
        self.offsets = rng.uniform(0, width, tables * hashes)
        self.mix = rng.integers(1, 2**63 - 1, size=(tables, hashes), dtype=np.int64) | 1

    def steps(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(step, place within it) by (vector, table, hash)."""
        at = (x @ self.directions + self.offsets).reshape(len(x), self.tables, self.hashes)
        step = np.floor(at / self.width)
        return step.astype(np.int64), at - step * self.width

    def buckets(self, x: np.ndarray) -> np.ndarray:
        return (self.steps(x)[0] * self.mix).sum(-1)

    def visits(self, x: np.ndarray) -> np.ndarray:
        """Buckets by (vector, table, probe), in estimated success order; fewer
        possible probes repeat the own bucket."""
        step, place = self.steps(x)
        own = (step * self.mix).sum(-1)
        out = np.repeat(own[:, :, None], self.probes, axis=2)
        for v in range(len(x)):
            for t in range(self.tables):
                for k, change in enumerate(self._changes(place[v, t])):
                    name = int(own[v, t]) + sum(d * int(self.mix[t, i]) for i, d in change)
                    out[v, t, k] = (name + 2**63) % 2**64 - 2**63  # sums wrap, as in buckets()
        return out

    def _changes(self, place: np.ndarray) -> Iterator[tuple[tuple[int, int], ...]]:
        """Sets of (hash, -1 or 1), the likeliest first: a heap over the sorted squared
        distances to the borders, growing sets by shifting or adding their last element."""
        cost = np.concatenate([place**2, (self.width - place)**2])
        order = np.argsort(cost, kind="stable").tolist()
        cost = cost[order].tolist()
        move = [(i % self.hashes, 1 if i >= self.hashes else -1) for i in order]
        yield ()
        queue, found = [(cost[0], (0,))], 1
        while queue and found < self.probes:
            total, chosen = heapq.heappop(queue)
            last = chosen[-1]
            if last + 1 < len(cost):
                heapq.heappush(queue, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
                heapq.heappush(queue, (total + cost[last + 1], (*chosen, last + 1)))
            if len({move[i][0] for i in chosen}) == len(chosen):
                found += 1
                yield tuple(move[i] for i in chosen)


def _matrix(column) -> np.ndarray:
    """A batch's list column as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


class _Best:
    """The nearest rows of a set of queries, as rows stream by."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.rows = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)

    def see(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, HELD // max(1, self.vectors.size))
        for at in range(0, len(ids), step):
            part, names = vectors[at:at + step], ids[at:at + step]
            apart = self.vectors[:, None, :] - part[None, :, :]
            score = np.sqrt(np.einsum("qrd,qrd->qr", apart, apart))
            for q in range(len(self.ids)):
                old, known = self.rows[q]
                near = score[q]
                if len(old) == self.k:
                    hit = near <= old[-1]
                    if not hit.any():
                        continue
                    near, new = near[hit], names[hit]
                else:
                    new = names
                s, i = np.concatenate([old, near]), np.concatenate([known, new])
                order = np.lexsort((i, s))[:self.k]
                self.rows[q] = s[order], i[order]

    def batch(self) -> pa.RecordBatch:
        n = [len(s) for s, _ in self.rows]
        empty = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids, n)), pa.array(np.concatenate([i for _, i in self.rows] or empty)),
             pa.array(np.concatenate([s for s, _ in self.rows] or [np.zeros(0)]))], names=["q", "c", "score"])


def _search(k: int):
    """Streams buckets sorted by key, visits before rows."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best, ids, vectors = None, None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("t", "bucket", "i", "j")], 1)
            kinds, rows, x = batch.column("kind").to_numpy(), batch.column("id").to_numpy(), _matrix(batch.column("vector"))
            begin = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]).any(1)])
            for b, e in zip(begin, np.r_[begin[1:], len(rows)]):
                if tuple(names[b]) != key:
                    if best is not None:
                        yield best.batch()
                    key, best, ids, vectors = tuple(names[b]), None, [], []
                m = b + int((kinds[b:e] == 0).sum())
                if m > b:
                    ids.append(rows[b:m])
                    vectors.append(x[b:m])
                if m < e and ids:
                    best = best or _Best(np.concatenate(ids), np.concatenate(vectors), k)
                    best.see(rows[m:e], x[m:e])
        if best is not None:
            yield best.batch()
    return search


def _compare(block, k: int):
    """A block of queries against all rows of the task."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(*block.value, k)
        for batch in batches:
            if batch.num_rows:
                best.see(batch.column("id").to_numpy(), _matrix(batch.column("vector")))
        yield best.batch()
    return compare


def _chunked(index: DataFrame, visits: DataFrame) -> DataFrame:
    """Rows and visits by (t, bucket, i, j): i numbers the bucket's chunks of rows, j of visits."""
    both = (index.withColumn("kind", F.lit(1)).unionByName(visits.withColumn("kind", F.lit(0))))
    sizes = materialize(
        both.groupBy("t", "bucket").agg(F.sum("kind").alias("rows"), F.sum(1 - F.col("kind")).alias("seen"))
        .filter((F.col("rows") > CHUNK) | (F.col("seen") > CHUNK))
        .select("t", "bucket", F.ceil(F.col("rows") / CHUNK).cast("int").alias("ci"),
                F.greatest(F.lit(1), F.ceil(F.col("seen") / CHUNK)).cast("int").alias("cj")), "large-buckets")
    ci, cj = F.greatest(F.lit(1), F.coalesce("ci", F.lit(1))), F.coalesce("cj", F.lit(1))
    mine = lambda n: F.array(F.pmod(F.xxhash64("id"), n.cast("long")).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    return (both.join(sizes, ["t", "bucket"], "left")
            .withColumn("i", F.explode(F.when(F.col("kind") == 1, mine(ci)).otherwise(every(ci))))
            .withColumn("j", F.explode(F.when(F.col("kind") == 1, every(cj)).otherwise(mine(cj))))
            .select("t", "bucket", "i", "j", "kind", "id", "vector"))


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part, once each, vectors as arrays of float or double."""
    v = F.col("vector")
    fine = (F.col("id").isNotNull() & v.isNotNull() & (F.size("vector") > 0)
            & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vector", lambda x: x != 0))
    return rows.select(quoted(vec_id).cast("long").alias("id"), quoted(vector).alias("vector")).filter(fine)


def nearest(rows: DataFrame, queries, vec_id: str = "vec_id", vector: str = "embedding", *,
            k: int = NEAREST, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row that the condition
    ``queries`` (on a column ``id``) selects, nearest first, ties to the smaller id."""
    good = usable(rows, vec_id, vector)
    lengths = sorted(r[0] for r in good.select(F.size("vector")).distinct().collect())  # one, as a rule
    parts = [_of_one_length(good.filter(F.size("vector") == n) if len(lengths) > 1 else good, queries, k, tables, hashes, probes)
             for n in lengths]
    found = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double") if not parts else parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found


def _of_one_length(good: DataFrame, queries, k: int, tables: int, hashes: int, probes: int) -> DataFrame:
    spark = good.sparkSession
    # equal vectors: one class, named by its smallest id, with the k + 1 smallest
    order = Window.partitionBy("vector").orderBy("id")
    classes = materialize(
        good.dropDuplicates(["id", "vector"]).withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= k + 1)
        .groupBy("vector").agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("ids")), "vectors")
    asked = materialize(good.filter(queries).dropDuplicates(["id", "vector"]).withColumnRenamed("id", "query_id")
                        .join(classes.select("vector", F.col("id").alias("q")), "vector"), "queries")
    sample = [r[0] for r in classes.select("vector").orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).collect()]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = np.array(sample, np.float64)
    apart = np.sqrt(np.maximum((x**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * x @ x.T, 0))
    scale = float(apart.sum() / max(1, len(x) * (len(x) - 1))) or 1.0
    hashed = spark.sparkContext.broadcast(Hashes(x.shape[1], WIDTH * scale, tables, hashes, probes))

    def buckets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            yield pd.Series(list(hashed.value.buckets(np.stack(v).astype(np.float64))) if len(v) else [], dtype=object)

    def visits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            seen = hashed.value.visits(np.stack(v).astype(np.float64)) if len(v) else []
            yield pd.Series([[np.unique(t) for t in q] for q in seen], dtype=object)

    index = (classes.select("id", "vector", F.posexplode(pandas_udf(buckets, "array<long>")(F.col("vector"))).alias("t", "bucket")))
    looks = (asked.select(F.col("q").alias("id"), "vector").dropDuplicates(["id"])
             .select("id", "vector", F.posexplode(pandas_udf(visits, "array<array<long>>")(F.col("vector"))).alias("t", "seen"))
             .select("id", "vector", "t", F.explode("seen").alias("bucket")))
    found = materialize(
        _chunked(index, looks).repartition("t", "bucket", "i", "j")
        .sortWithinPartitions("t", "bucket", "i", "j", "kind")
        .mapInArrow(_search(k + 1), "q long, c long, score double"), "visited")
    return _few(_ranked(found, classes, asked, k), classes, asked, found, k)


def _ranked(found: DataFrame, classes: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The lists of all tables merged by class, classes spread out to ids."""
    by_class = Window.partitionBy("q").orderBy("score", "c")
    by_id = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.dropDuplicates(["q", "c"]).withColumn("__n", F.row_number().over(by_class)).filter(F.col("__n") <= k + 1)
            .join(classes.select(F.col("id").alias("c"), "ids"), "c")
            .select("q", "score", F.explode("ids").alias("vec_id"))
            .join(asked.select("q", "query_id"), "q").filter("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(by_id)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _few(ranked: DataFrame, classes: DataFrame, asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """``ranked``, with the queries that found fewer than k rows compared with all rows."""
    ranked = materialize(ranked, "nearest")
    full = ranked.filter(F.col("rank") == k).select("query_id")
    short = materialize(asked.join(full, "query_id", "left_anti"), "few-found")
    if not short.count():
        return ranked
    spark = ranked.sparkSession
    lists = []
    for block in batched(short.select("q", "vector").dropDuplicates(["q"]).toLocalIterator(), BLOCK):
        shared = spark.sparkContext.broadcast((np.array([r["q"] for r in block]), np.array([r["vector"] for r in block], np.float64)))
        lists.append(materialize(classes.select("id", "vector")
                                 .mapInArrow(_compare(shared, k + 1), "q long, c long, score double"), "compared"))
    again = lists[0]
    for more in lists[1:]:
        again = again.unionByName(more)
    return ranked.join(short.select("query_id"), "query_id", "left_anti").unionByName(_ranked(again, classes, short, k))


def op5_nearest(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), F.col("id") % 100 == 0)
