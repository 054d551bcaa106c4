"""Sharding by histogram sort: equal bytes per shard from exact counts.

The documents are ordered by (hash of the text, doc_id), so equal texts are
neighbours. The borders between shards are found by counting: each round
sums the exact bytes in up to 256 intervals around every border that is
still open, in one aggregate over the keys, and goes on inside the interval
that holds the border, until the border is near enough to its target or the
interval holds one key. A text hash whose copies hold more than ``split_share`` of a shard is
refined further by doc_id, and rows equal in both by a number they are written with, so a
group of copies holding a third of the corpus is split, while any other group stays whole. The
rows are then exchanged once.

Rounds read a written table of keys and sizes, return at most 256 sums per
border to the driver, and use DataFrame operations only. Slots are
numbered inside (shard, two hash digits of doc_id), 256 pieces per shard, and
shifted by the pieces' exact counts, so no task numbers a whole shard.

Law: ``bytes`` (sizes near equal; each border is the key border nearest its
target, so shards differ by at most about one document, or one group of copies below ``split_share``).

Defined results: a null text has size 1 and the key and checksum of an empty
one; texts of any length count as a whole; a null doc_id comes first; repeated rows are rows like
others, whichever of them a border divides;
empty shards are possible when there are fewer rows than shards; an empty
table gives an empty table; columns other than the two named are left out, so none can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.text import quoted
from churnlens.operators.joins import materialize

SHARDS = 8
BUCKETS = 256
#: A border is near enough within this share of a shard's bytes; 0: the nearest key border.
TOLERANCE = 0.0
#: Default of ``split_share``: copies of one text are divided when they hold more than this of a shard.
SPLIT_SHARE = 0.01
KEY_DIGITS = 15  # hex digits of the text's md5 that order the rows


@dataclass
class Border:
    """A border still sought: its target and the interval [low, high) that holds it, with ``below`` bytes before."""
    target: float
    low: int
    high: int
    below: int


def _exact(v: int) -> Column:
    return F.lit(str(v)).cast("decimal(38,0)")


def _rounds(keys: DataFrame, key: str, borders: list[Border], near: float) -> list[tuple[int, int, int | None]]:
    """For each border: (splitter, bytes below it, bytes of the single key it fell into or None).

    A splitter s puts keys below s in front of the border. The third value is
    given when one key holds more than the tolerance on both sides of the target.
    """
    done: list[tuple[int, int, int | None] | None] = [None] * len(borders)
    while open_ := sorted({(b.low, b.high) for b, d in zip(borders, done) if d is None}):
        bucket = F.lit(None).cast("long")
        part = F.lit(None).cast("int")
        for i, (low, high) in enumerate(open_):
            col, lit = F.col(key), F.lit
            if low < -(2**62) or high > 2**62:  # the difference may not fit into a long
                col, lit = col.cast("decimal(38,0)"), _exact
            inside = (col >= lit(low)) & (col < lit(high))
            width = max(1, -(-(high - low) // BUCKETS))
            nth = F.call_function("div", col - lit(low), lit(width))
            part = F.when(inside, F.lit(i)).otherwise(part)
            bucket = F.when(inside, nth).otherwise(bucket)
        sums: dict[tuple[int, int], int] = {
            (r["p"], r["b"]): r["n"] for r in
            keys.select(part.alias("p"), bucket.alias("b"), "size").filter("p IS NOT NULL")
            .groupBy("p", "b").agg(F.sum("size").alias("n")).collect()}  # at most 256 rows per open border
        for k, b in enumerate(borders):
            if done[k] is not None:
                continue
            p = open_.index((b.low, b.high))
            width = max(1, -(-(b.high - b.low) // BUCKETS))
            below = b.below
            for at in range(-(-(b.high - b.low) // width)):
                n = sums.get((p, at), 0)
                low, high = b.low + at * width, min(b.high, b.low + (at + 1) * width)
                if below + n > b.target or high == b.high:
                    if b.target - below <= near:
                        done[k] = (low, below, None)
                    elif below + n - b.target <= near:
                        done[k] = (high, below + n, None)
                    elif high - low == 1:
                        done[k] = (low, below, n)
                    else:
                        borders[k] = Border(b.target, low, high, below)
                    break
                below += n
    return [d for d in done if d is not None]


def _nearer(borders: list[Border], found: list[tuple[int, int, int | None]]) -> list[int]:
    """Borders at single rows as the first value behind them: each row on its nearer side."""
    return [at + 1 if n is not None and below + n / 2 <= b.target else at for b, (at, below, n) in zip(borders, found)]


def splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
              split_share: float = SPLIT_SHARE) -> list[tuple[int, ...]]:
    """The shards - 1 borders as (key,), (key, doc) or (key, doc, row): rows that come before it in
    this order are in front of the border."""
    total, low, high = keys.agg(F.sum("size"), F.min("key"), F.max("key")).first()
    if not total:
        return []
    near = tolerance * total / shards
    borders = [Border(total * i / shards, low, high + 1, 0) for i in range(1, shards)]
    found = _rounds(keys, "key", [Border(b.target, b.low, b.high, b.below) for b in borders], near)
    split: list[tuple[int, ...]] = [(k,) for k, _, _ in found]
    # borders inside one text's copies: refine by doc_id, all such keys of the same text together
    for key in sorted({k for k, _, n in found if n is not None}):
        mine = [i for i, f in enumerate(found) if f[0] == key and f[2] is not None]
        n = found[mine[0]][2]
        if n <= split_share * total / shards:  # whole, on the nearer side
            for i in mine:
                split[i] = (key + (found[i][1] + n / 2 <= borders[i].target),)
            continue
        copies = keys.filter(F.col("key") == key)
        first, last, size = copies.agg(F.min("doc"), F.max("doc"), F.max("size")).first()
        inner = [Border(borders[i].target, first, last + 1, found[i][1]) for i in mine]
        docs = _rounds(copies, "doc", [Border(b.target, b.low, b.high, b.below) for b in inner], near)
        for i, b, doc, at in zip(mine, inner, docs, _nearer(inner, docs)):
            split[i] = (key, at)
            if doc[2] is not None and doc[2] > size:  # several rows of one text and id
                rows = copies.filter(F.col("doc").cast("decimal(38,0)") == _exact(doc[0]))
                one, end = rows.agg(F.min("row"), F.max("row")).first()
                last_of = [Border(b.target, one, end + 1, doc[1])]
                row = _rounds(rows, "row", [Border(b.target, one, end + 1, doc[1])], near)
                split[i] = (key, doc[0], _nearer(last_of, row)[0])
    return split


def shard_of(key: Column, doc: Column, row: Column, split: list[tuple[int, ...]]) -> Column:
    """The number of borders at or before a row."""
    out = F.lit(0)
    for border in split:
        after = F.lit(True)
        for at, col in reversed(list(zip(border, (key, doc, row)))):
            value = col.cast("decimal(38,0)")
            after = (value > _exact(at)) | (value == _exact(at)) & after
        out = out + after.cast("int")
    return out


def text_key(text: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, KEY_DIGITS), 16, 10).cast("long")


def shard_by_bytes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *,
                   shards: int = SHARDS, tolerance: float = TOLERANCE, split_share: float = SPLIT_SHARE) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row. Copies of one text that hold more than
    ``split_share`` of a shard's bytes may be divided between shards."""
    body = F.coalesce(quoted(text), F.lit(""))
    keys = materialize(docs.select(
        quoted(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), text_key(quoted(text)).alias("key"),
        F.coalesce(quoted(doc_id).cast("long"), F.lit(-(2**63))).alias("doc"),
        F.monotonically_increasing_id().alias("row")), "shard-keys")  # written, so a row keeps its number
    split = splitters(keys, shards, tolerance, split_share)
    placed = (keys.withColumn("shard", shard_of(F.col("key"), F.col("doc"), F.col("row"), split))
              .withColumn("__piece", F.substring(F.md5(F.col("doc").cast("string")), 1, 2)))
    pieces = (placed.groupBy("shard", "__piece").count()  # at most 256 rows per shard
              .withColumn("__before", F.sum("count").over(Window.partitionBy("shard").orderBy("__piece")) - F.col("count"))
              .select(F.col("shard").alias("__s"), F.col("__piece").alias("__p"), "__before"))
    inside = Window.partitionBy("shard", "__piece").orderBy("key", "doc", "row")
    return (placed.withColumn("__row", F.row_number().over(inside))
            .join(F.broadcast(pieces), (F.col("shard") == F.col("__s")) & (F.col("__piece") == F.col("__p")))
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("__before") + F.col("__row") - 1).cast("long").alias("slot")))


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return (shard_by_bytes(docs)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


#: CRC-32 byte by byte with a table built from its polynomial; borders by the middle of each row
#: (or of a small group of equal texts) in the order of the keys.
OP10_SQL = """
WITH RECURSIVE bits AS (SELECT range AS i, 0 AS n, range AS c FROM range(256) UNION ALL
  SELECT i, n + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM bits WHERE n < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE n = 8),
b AS (SELECT doc_id, coalesce(text, '') AS text, encode(coalesce(text, '')) AS raw FROM documents),
d AS (SELECT doc_id, (octet_length(raw) + 1)::BIGINT AS size, substr(md5(text), 1, 15) AS key,
             xor(list_reduce(list_transform(regexp_extract_all(hex(raw), '..'), lambda h: ('0x' || h)::BIGINT),
                             lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295)::BIGINT AS text_crc32
      FROM b, crc),
t AS (SELECT *, sum(size) OVER (PARTITION BY key) AS copies, sum(size) OVER () AS total,
             sum(size) OVER (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto,
             sum(size) OVER (ORDER BY key RANGE UNBOUNDED PRECEDING) AS group_upto FROM d),
m AS (SELECT *, CASE WHEN copies <= 0.01::DOUBLE * total::DOUBLE / 8 THEN group_upto - copies / 2 ELSE upto - size / 2 END AS middle FROM t),
s AS (SELECT *, len(list_filter([1, 2, 3, 4, 5, 6, 7], lambda i: middle > total * i / 8))::INT AS shard FROM m)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY substr(md5(coalesce(doc_id, -9223372036854775808)::VARCHAR), 1, 2), key,
                           doc_id NULLS FIRST) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM s
"""
