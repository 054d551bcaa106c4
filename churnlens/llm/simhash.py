"""SimHash near-dedup over a segment-popcount embedding.

A fingerprint is cut into 32 segments of two bits and mapped to the segments'
bit counts, a point of a 32-dimensional grid with coordinates 0 to 2. The
Manhattan distance of two points never exceeds the Hamming distance of the
fingerprints, so links at ``max_bits`` = 3 bits lie within Manhattan distance
3. Of the two halves of such a pair's points one lies within distance 1: the
range-join meets every fingerprint in its own cell of each half's grid and
with the cells one step up in one coordinate (the lower of two neighbours
reaches the upper). Pairs in a cell are tested by the Manhattan bound, the
survivors exactly by their differing bits.

Equal fingerprints are one node, so copies cost nothing. Inside a cell
only the links of a spanning forest leave the task, never all pairs; a cell
with more than ``CELL`` fingerprints is cut into chunks that meet all
members in tasks of their own. Tasks hold one chunk and one batch.

Counts are written as sorted bits (0: 00, 1: 01, 2: 11), so that the Manhattan
distance of two points is the number of differing bits of their codes.

Defined results: a null or empty text has fingerprint zero; texts of any length are read
whole; a null doc_id never names a group unless all of the group's are null; repeated rows have
equal results; an empty table gives an empty table; ``keep_one_of_each`` returns all columns as
they were, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from xxhash import xxh64_intdigest

from churnlens.llm.components import components
from churnlens.llm.text import field, in_small_batches, lower_words, packed, quoted, unpacked
from churnlens.operators.joins import materialize

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints of a cell that one task compares with the cell's other members.
CELL = 4096
PAIRS = 1 << 22  # comparisons held at once
LOW_BITS = 0x5555555555555555  # the lower bit of each segment


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """The fingerprint of a whole text, as a signed 64-bit number."""
    w = lower_words(text)
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(n)))) if len(w) >= n else [b" ".join(w)]
    h = np.array([xxh64_intdigest(g, SEED) for g in grams], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprints(text: Column) -> Column:
    return pandas_udf(_fingerprints, "long")(text)


def segment_counts(fp: Column) -> Column:
    """The 32 segments' bit counts as sorted bits."""
    high = F.shiftrightunsigned(fp, 1)
    both = fp.bitwiseAND(high).bitwiseAND(F.lit(LOW_BITS))
    some = fp.bitwiseOR(high).bitwiseAND(F.lit(LOW_BITS))
    return F.shiftleft(both, 1).bitwiseOR(some)


def _counts(fp: np.ndarray) -> np.ndarray:
    low, one = np.uint64(LOW_BITS), np.uint64(1)
    return ((fp & (fp >> one) & low) << one) | ((fp | (fp >> one)) & low)


def _cells(point: Column) -> Column:
    """Structs (cell, probe): each half's own cell, and the cells one step up, where it only visits."""
    def half(h: int) -> Column:
        code = F.shiftrightunsigned(point, 32 * h).bitwiseAND(F.lit(0xFFFFFFFF))
        name = lambda c: c.bitwiseOR(F.lit(h << 32))
        up = []
        for i in range(16):
            one, two = F.lit(1 << 2 * i), F.lit(2 << 2 * i)
            step = F.when(code.bitwiseAND(one) == 0, code.bitwiseOR(one)).when(
                code.bitwiseAND(two) == 0, code.bitwiseOR(two))
            up.append(F.struct(name(step).alias("cell"), F.lit(1).alias("probe")))
        return F.array(F.struct(name(code).alias("cell"), F.lit(0).alias("probe")), *up)
    return F.filter(F.concat(half(0), half(1)), lambda s: s["cell"].isNotNull())


class _Cell:
    """The members of one cell (or chunk) so far and the forest over them."""

    def __init__(self, max_bits: int):
        self.max_bits, self.members, self.label = max_bits, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _near(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(row, indexes of the members it links to), for rows that link at all."""
        step = max(1, PAIRS // max(1, len(self.members)))
        points = _counts(self.members)
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            i, j = np.nonzero(np.bitwise_count(_counts(part)[:, None] ^ points[None, :]) <= self.max_bits)
            bits = np.bitwise_count(part[i] ^ self.members[j])
            keep = (bits <= self.max_bits) & (bits > 0)
            i, j = i[keep], j[keep]
            if len(i):
                begin = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
                for r, js in zip(i[begin], np.split(j, begin[1:])):
                    yield at + int(r), js

    def _join(self, js: np.ndarray) -> Iterator[tuple[int, int]]:
        """Makes the members one tree; yields the links that this takes."""
        labels, first = np.unique(self.label[js], return_index=True)
        for other, k in zip(labels[1:], first[1:]):
            yield int(self.members[js[first[0]]]), int(self.members[js[k]])
            self.label[self.label == other] = labels[0]

    def add(self, rows: np.ndarray) -> Iterator[tuple[int, int]]:
        """Takes in members, yields links."""
        old = len(self.members)
        self.members = np.concatenate([self.members, rows])
        self.label = np.concatenate([self.label, np.arange(old, old + len(rows))])
        for r, js in self._near(rows):
            js = js[js < old + r]
            if len(js):
                yield from self._join(np.append(js, old + r))

    def visit(self, rows: np.ndarray) -> Iterator[tuple[int, int]]:
        """Yields the links of rows that are members of another cell."""
        for r, js in self._near(rows):
            yield int(rows[r]), int(self.members[js[0]])
            yield from self._join(js)


def _link(max_bits: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, chunks, probe = (batch.column(n).to_numpy() for n in ("cell", "chunk", "probe"))
            fp = batch.column("fp").to_numpy().view(np.uint64)
            begin = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]) | (chunks[1:] != chunks[:-1])])
            end = np.r_[begin[1:], len(cells)]
            members = np.add.reduceat(1 - probe, begin)
            # a run alone in its cell has nothing to meet, unless it is at the batch's border
            busy = (members > 0) & (end - begin > 1)
            busy[[0, -1]] = True
            out: list[tuple[int, int]] = []
            for b, e, m in zip(begin[busy], end[busy], members[busy]):
                if (cells[b], chunks[b]) != key:
                    key, cell = (cells[b], chunks[b]), _Cell(max_bits)
                out += cell.add(fp[b:b + m])
                if len(cell.members):
                    out += cell.visit(fp[b + m:e])
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
    return link


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect exactly
    the fingerprints connected by chains of at most ``max_bits`` differing bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the grid's halves cover distances up to 3")
    # the small table of nodes grows by a factor of up to 34 here: spread it first
    nodes = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    rows = (nodes.select("fp", F.explode(_cells(segment_counts(F.col("fp")))).alias("__c"))
            .select("fp", "__c.cell", "__c.probe"))
    own = (nodes.select(F.explode(F.filter(_cells(segment_counts(F.col("fp"))), lambda s: s["probe"] == 0)).alias("__c"))
           .groupBy("__c.cell").count().filter(F.col("count") > CELL))
    hot = materialize(own.select("cell", F.ceil(F.col("count") / CELL).cast("int").alias("__chunks")), "hot-cells")
    # a hot cell's members stay in one chunk each and visit all chunks
    chunks = F.transform(F.sequence(F.lit(0), F.col("__chunks") - 1),
                         lambda c: F.struct(c.alias("chunk"), F.lit(1).alias("probe")))
    mine = F.struct(F.pmod(F.xxhash64("fp"), F.col("__chunks").cast("long")).cast("int").alias("chunk"),
                    F.lit(0).alias("probe"))
    places = (F.when(F.col("__chunks").isNull(), F.array(F.struct(F.lit(0).alias("chunk"), F.col("probe"))))
              .when(F.col("probe") == 0, F.concat(F.array(mine), chunks)).otherwise(chunks))
    placed = (rows.join(hot, "cell", "left").select("cell", "fp", F.explode(places).alias("__p"))
              .select("cell", "__p.chunk", "__p.probe", "fp"))
    return (placed.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "probe")
            .mapInArrow(_link(max_bits), "a long, b long"))


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): rows has __doc, __text (hash of the text) and fp of every row; groups
    has fp, __root (smallest linked fingerprint) and component_id of every fingerprint."""
    rows = materialize(in_small_batches(docs).select(quoted(doc_id).alias("__doc"), F.xxhash64(quoted(text)).alias("__text"),
                                   fingerprints(quoted(text)).alias("fp")), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("__doc").alias("__least")), "nodes")
    stars = components(materialize(near_links(nodes.select("fp"), max_bits), "links"))
    rooted = nodes.join(stars.withColumnsRenamed({"a": "fp", "b": "__root"}), "fp", "left").withColumn(
        "__root", F.coalesce("__root", "fp"))
    least = rooted.groupBy("__root").agg(F.min("__least").alias("component_id"))
    return rows, materialize(rooted.join(least, "__root").select("fp", "__root", "component_id"), "groups")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     max_bits: int = MAX_BITS) -> DataFrame:
    """One row of every group: the one with the smallest doc_id (null last), of
    several with that id the one whose text hashes lowest, of equal rows one.
    The dropped rows' ids are joined against the texts, which are shuffled only
    if those are too many to broadcast."""
    rows, groups = near_groups(docs, text, doc_id, max_bits)
    # the first row of each fingerprint, then of each group, then beside every fingerprint: a
    # group of copies meets only as partial minima
    order = F.struct(F.col("__doc").isNull().alias("n"), F.col("__doc").alias("d"), F.col("__text").alias("t"))
    first = (rows.groupBy("fp").agg(F.min(order).alias("__f")).join(groups, "fp")
             .groupBy("__root").agg(F.min("__f").alias("__first")))
    first = materialize(groups.join(first, "__root").select("fp", "__first"), "first-rows")
    ranked = materialize(rows.join(first, "fp").select(F.col("__doc").alias("__d"), F.col("__text").alias("__t"),
                                                       (F.col("__first") == order).alias("__keep"))
                         .groupBy("__d", "__t", "__keep").agg(F.count(F.lit(1)).alias("__n"))
                         .filter("NOT __keep OR __n > 1").select("__d", "__t", "__keep"), "not-kept")
    every = packed(docs).withColumns({"__id": field(docs, doc_id), "__hash": F.xxhash64(field(docs, text))})
    same = F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__hash") == F.col("__t"))
    out = every.join(ranked.filter("NOT __keep"), same, "left_anti")
    equal = ranked.filter("__keep").select("__d", "__t")
    if equal.count():  # footer counts: rows that repeat a kept row as a whole
        once = out.join(equal, same, "left_semi").dropDuplicates(["__id", "__hash"])
        out = out.join(equal, same, "left_anti").unionByName(once)
    return unpacked(out, docs)


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows, groups = near_groups(docs)
    return rows.join(groups, "fp").select(F.col("__doc").alias("doc_id"),
                                          hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")
