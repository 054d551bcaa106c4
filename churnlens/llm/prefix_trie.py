"""The prefix trie of conversations: which openings they share, and what sharing them saves.

The trie is built by van Emde Boas recursion. Sequences are cut at half the depth of
their block; the prefix up to the cut gets a name, which makes it the root of a forest below;
the upper trie and all lower forests are again blocks, of half the height, and are cut in the same
round. After ``log2(depth / BASE)`` rounds the blocks have ``BASE`` levels and are named in
place. Names are the first 128 bits of SHA-256 over what they stand for: a turn, the two halves
of a block, a root and the block below it. Equal prefixes of any two conversations get equal names,
so a node is an aggregate over its name and no task follows a whole path.

Totals over subtrees are grafted upward. In the lowest blocks every node passes its value to its at
most ``BASE`` ancestors there. Then, round by round, the totals of the forests below a cut
are added up at the cut node and grafted onto its ancestors in the upper block, so a
value climbs a path of length D in ``log2 D`` rounds.

Work is rows x rounds, every round an aggregate and a join in Spark. No conversation is
held in one task: positions come from a range partitioning, blocks hold at most ``BASE`` turns,
equal turns are counted before they move, and the joins that can meet a long conversation or
a frequent prefix are broadcast behind a size check or salted. The ids that end in a node are sorted
by range and joined into texts of at most a partition; a node whose ids span several
of them is hashed by one streaming task, as SHA-256 reads its input in order.

Defined results: rows without conv_id belong to no conversation; a null turn comes first, a null
role or text is empty, turns with equal numbers follow the hash of role and text, and repeated
rows are several turns; texts of any length count as a whole; an empty table has no nodes; columns
other than the four named are left out, so none can clash. ``%`` has the sign of the
dividend, as in SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.text import in_small_batches, n_words
from churnlens.operators.joins import join_small, materialize

#: Levels of a block that is not cut any more.
BASE = 4
#: Copies of one turn that a row stands for at most while they are spread out.
COPIES = 4096
ROOT = "0" * 32  # the name of the empty prefix


def _name(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turn_name(role: Column, text: Column) -> Column:
    return _name(F.char_length(role).cast("string"), F.lit(":"), role, text)


# --- Turns in order ---------------------------------------------------------------------

def ordered_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv, pos, name, words): the turns of every conversation, numbered from 1."""
    empty = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    counted = materialize(
        rows.filter(F.col(f"`{conv_id}`").isNotNull())
        .select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                turn_name(empty(role), empty(text)).alias("name"), n_words(F.col(f"`{text}`")).alias("words"))
        .groupBy("conv", "turn", "name").agg(F.first("words").alias("words"), F.count(F.lit(1)).alias("n")), "turns")
    sliced = materialize(counted.repartitionByRange("conv", F.col("turn").asc_nulls_first(), "name")
                         .withColumn("part", F.spark_partition_id()), "turns-in-slices")
    # what earlier slices hold of a conversation: at most one conversation a slice goes on from them
    held = sliced.groupBy("part", "conv").agg(F.sum("n").alias("held"))
    before = (held.withColumn("before", F.sum("held").over(Window.partitionBy("conv").orderBy("part")) - F.col("held"))
              .filter("before > 0").select("part", "conv", "before"))
    upto = F.sum("n").over(Window.partitionBy("part", "conv").orderBy(F.col("turn").asc_nulls_first(), "name")
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = F.coalesce(F.col("before"), F.lit(0)) + F.col("upto") - F.col("n")
    last = F.least(F.col("n"), (F.col("chunk") + 1) * COPIES)
    return (sliced.withColumn("upto", upto).join(F.broadcast(before), ["part", "conv"], "left")
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES))))
            .withColumn("i", F.explode(F.sequence(F.col("chunk") * COPIES + 1, last)))
            .select("conv", (first + F.col("i")).cast("long").alias("pos"), "name", "words"))


def lengths(steps: DataFrame) -> DataFrame:
    """(conv, len) of conversations that all have a turn."""
    return steps.groupBy("conv").agg(F.max("pos").alias("len"))


def rebuild(turns: DataFrame, group: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(steps, conversations): every conversation c with its first h turns replaced by the
    first h of conversation c - c % group, h being crc32(c) % (most + 1). Conversations are
    (conv, len) and may have no turns; both are written tables."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    convs = lengths(turns).select("conv", F.col("len").alias("n"), h.alias("h"),
                                  (F.col("conv") - F.col("conv") % group).alias("base"))
    convs = materialize(convs, "conversations")
    base = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = materialize(convs.join(base, "base", "left").withColumn(
        "lent", F.least(F.col("h"), F.coalesce(F.col("base_n"), F.lit(0)))), "rebuilt")
    opening = turns.filter((F.col("pos") <= most) & (F.col("conv") % group == 0)).withColumnRenamed("conv", "base")
    lent = (convs.filter("lent > 0").select("conv", "base", "lent").join(opening, "base")
            .filter("pos <= lent").select("conv", "pos", "name", "words"))
    short = convs.filter("lent < h").select("conv", (F.col("h") - F.col("lent")).alias("gap"))
    own = (join_small(turns.filter(F.col("pos") > h), short, "conv", "left")
           .select("conv", (F.col("pos") - F.coalesce(F.col("gap"), F.lit(0))).alias("pos"), "name", "words"))
    steps = materialize(own.unionByName(lent), "rebuilt-turns")
    return steps, convs.select("conv", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))


# --- The recursion downward: cuts and names -----------------------------------------------

def _blocks(steps: DataFrame) -> DataFrame:
    """(conv, j, turns): the lowest blocks, each with its at most BASE turns in order."""
    return materialize(
        steps.groupBy("conv", F.floor((F.col("pos") - 1) / BASE).alias("j"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "name", "words"))).alias("turns")), "blocks")


def _contents(blocks: DataFrame, rounds: int) -> list[DataFrame]:
    """Per round (from the lowest) the names of the full blocks: (conv, j, content)."""
    full = blocks.filter(F.size("turns") == BASE)
    whole = materialize(full.select("conv", "j", _name(*[F.col("turns")[i]["name"] for i in range(BASE)]).alias("content")),
                        "contents")
    out = [whole]
    for _ in range(rounds - 1):
        half = F.when(F.col("j") % 2 == 0, F.lit(0)).otherwise(1)
        pair = out[-1].groupBy("conv", F.floor(F.col("j") / 2).alias("j")).agg(
            F.max(F.when(half == 0, F.col("content"))).alias("a"), F.max(F.when(half == 1, F.col("content"))).alias("b"))
        out.append(materialize(pair.filter("a IS NOT NULL AND b IS NOT NULL")
                               .select("conv", "j", _name(F.col("a"), F.col("b")).alias("content")), "contents"))
    return out


def _roots(convs: DataFrame, contents: list[DataFrame]) -> DataFrame:
    """(conv, j, root): the name of the prefix before every lowest block. Each round cuts all
    blocks at half their height: the upper half keeps its root, the lower half's is named from that
    root and the content above the cut."""
    roots = convs.filter("len > 0").select("conv", F.lit(0).cast("long").alias("j"), F.unhex(F.lit(ROOT)).alias("root"))
    for content in reversed(contents):
        upper = content.filter("j % 2 = 0").select("conv", F.floor(F.col("j") / 2).alias("j"), "content")
        both = roots.join(upper, ["conv", "j"], "left").select("conv", F.explode(F.array(
            F.struct((F.col("j") * 2).alias("j"), F.col("root").alias("root")),
            F.struct((F.col("j") * 2 + 1).alias("j"), F.when(F.col("content").isNotNull(), _name(F.col("root"), F.col("content")))
                     .alias("root")))).alias("x"))
        roots = materialize(both.select("conv", "x.j", "x.root").filter("root IS NOT NULL"), "roots")
    return roots


def _paths(blocks: DataFrame, roots: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, j, root, names, words, len): the names of the prefixes that end in every lowest
    block; len only in the conversation's last block."""
    beyond = roots.filter("j > 0").select("conv", (F.col("j") - 1).alias("j"), F.col("root").alias("beyond"))
    last = convs.filter("len > 0").select("conv", F.floor((F.col("len") - 1) / BASE).alias("j"), "len")
    x = blocks.join(roots, ["conv", "j"]).join(beyond, ["conv", "j"], "left").join(last, ["conv", "j"], "left")
    names, above = [], F.col("root")
    for i in range(BASE):
        here = F.when(F.size("turns") > i, _name(above, F.col("turns")[i]["name"]))
        if i == BASE - 1:  # a cut has one name, on either side
            here = F.when(F.size("turns") > i, F.coalesce(F.col("beyond"), here))
        x = x.withColumn(f"p{i}", here)
        above = F.col(f"p{i}")
        names.append(above)
    return materialize(x.select("conv", "j", "root", F.array_compact(F.array(*names)).alias("names"),
                                F.col("turns.words").alias("words"), "len"), "paths")


def _levels(paths: DataFrame, *more: str) -> DataFrame:
    """One row for each prefix of ``paths``: conv, depth, name, parent and columns of the block."""
    x = paths.select("conv", "j", "root", "names", *more, F.posexplode("names").alias("i", "name"))
    return x.select("conv", (F.col("j") * BASE + F.col("i") + 1).alias("depth"), "name",
                    F.when(F.col("i") == 0, F.col("root")).otherwise(F.get("names", F.col("i") - 1)).alias("parent"), "i", *more)


def _nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: name, parent, depth, conv_id (smallest member), words, n_convs, n_ends."""
    members = _levels(paths, "words", "len").select(
        "conv", "depth", "name", "parent", F.get("words", F.col("i")).alias("words"),
        F.coalesce(F.col("depth") == F.col("len"), F.lit(False)).cast("long").alias("end"))
    top = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.unhex(F.lit(ROOT)).alias("name"),
                       F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("words"),
                       (F.col("len") == 0).cast("long").alias("end"))
    return materialize(members.unionByName(top).groupBy("name").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv").alias("conv_id"),
        F.max("words").alias("words"), F.count(F.lit(1)).alias("n_convs"), F.sum("end").alias("n_ends")), "nodes")


# --- The way back: totals grafted upward ----------------------------------------------------

_SUMS = ("leaves", "saved")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("name", "parent", "depth").agg(
        F.min("conv").alias("conv"), *[F.sum(c).cast("long").alias(c) for c in _SUMS])


def _lowest_totals(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Values added up within the lowest blocks: (name, parent, depth, conv, leaves, saved)."""
    value = nodes.filter("depth > 0").select(
        F.col("conv_id").alias("conv"), F.floor((F.col("depth") - 1) / BASE).alias("j"),
        ((F.col("depth") - 1) % BASE).alias("at"), (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")).filter("leaves > 0 OR saved > 0")
    climbing = paths.select("conv", "j", "root", "names").join(value, ["conv", "j"])
    return materialize(_summed(_levels(climbing, "at", *_SUMS).filter("i <= at")), "totals")


def _grafted(totals: list[DataFrame], paths: DataFrame, k: int) -> DataFrame:
    """One graft: what hangs below the cuts between blocks of BASE * 2^k levels, added to every
    node above the cut in the upper block."""
    height = BASE << k
    hanging = totals[0]
    for t in totals[1:]:
        hanging = hanging.unionByName(t)
    cuts = (hanging.filter((F.col("depth") - 1) % (2 * height) == height)
            .groupBy(F.col("parent").alias("cut"), F.col("depth")).agg(
                F.min("conv").alias("conv"), *[F.sum(c).cast("long").alias(c) for c in _SUMS])
            .select("conv", (F.floor((F.col("depth") - 1) / height) - 1).alias("block"), *_SUMS))
    upper = (paths.select("conv", "j", "root", "names", F.floor(F.col("j") / (1 << k)).alias("block"))
             .filter("block % 2 = 0"))
    return materialize(_summed(_levels(join_small(upper, cuts, ["conv", "block"]), *_SUMS)), "totals")


# --- Ends -------------------------------------------------------------------------------------

def _hash_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, ends_sha256) of sorted (name, ids): one running hash, texts as they come."""
    name, running = None, None
    done: list[tuple[bytes, str]] = []
    for batch in batches:
        for i in range(batch.num_rows):
            this, ids = batch.column("name")[i].as_py(), batch.column("ids")[i].as_py().encode()
            if this == name:
                running.update(b"," + ids)
            else:
                if running:
                    done.append((name, running.hexdigest()))
                name, running = this, hashlib.sha256(ids)
    if running:
        done.append((name, running.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())],
                                     names=["name", "ends_sha256"])


def ends_digests(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the nodes in which conversations end."""
    deep = paths.filter("len IS NOT NULL").select(F.element_at("names", -1).alias("name"), "conv")
    ends = materialize(deep.unionByName(convs.filter("len = 0").select(F.unhex(F.lit(ROOT)).alias("name"), "conv")), "ends")
    sliced = materialize(ends.repartitionByRange("name", "conv").withColumn("part", F.spark_partition_id()), "ends-in-slices")
    texts = materialize(sliced.groupBy("part", "name").agg(F.array_sort(F.collect_list("conv")).alias("ids"))
                        .select("part", "name", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids")), "end-ids")
    # names in several slices: at most one begins before each slice
    spread = materialize(texts.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"), "spread-ends")
    one = texts.join(F.broadcast(spread), "name", "left_anti").select("name", F.sha2("ids", 256).alias("ends_sha256"))
    if not spread.count():  # from the footers
        return one
    many = (in_small_batches(texts.join(F.broadcast(spread), "name", "left_semi")).repartition("name")
            .sortWithinPartitions("name", "part").select("name", "ids"))
    return one.unionByName(many.mapInArrow(_hash_in_order, "name binary, ends_sha256 string"))


# --- The operator -----------------------------------------------------------------------------

def prefix_trie(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. ``steps`` has conv, pos, name and words of every turn and
    ``convs`` conv and len of every conversation, both written tables."""
    deepest = convs.agg(F.max("len")).first()[0] or 0
    rounds = max(0, (-(-deepest // BASE) - 1).bit_length())
    blocks = _blocks(steps)
    roots = _roots(convs, _contents(blocks, rounds) if rounds else [])
    paths = _paths(blocks, roots, convs)
    nodes = _nodes(paths, convs)
    totals = [_lowest_totals(nodes, paths)]
    for k in range(rounds):
        totals.append(_grafted(totals, paths, k))

    # a node's row, the parts of its totals, its children and its ends, all under its name
    none = {"conv_id": "long", "depth": "long", "parent": "binary", "n_convs": "long", "n_children": "long",
            "leaves": "long", "saved": "long", "ends": "string"}
    none["conv_id"] = dict(convs.dtypes)["conv"]

    def facts(df: DataFrame, **values: Column) -> DataFrame:
        return df.select("name", *[values.get(c, F.lit(None)).cast(t).alias(c) for c, t in none.items()])
    col = F.col
    rows = facts(nodes, conv_id=col("conv_id"), depth=col("depth"), parent=col("parent"), n_convs=col("n_convs"),
                 leaves=((col("depth") == 0) & (col("n_convs") == col("n_ends"))).cast("long"))
    rows = rows.unionByName(facts(nodes.filter("depth > 0").select(col("parent").alias("name")), n_children=F.lit(1)))
    rows = rows.unionByName(facts(ends_digests(paths, convs), ends=col("ends_sha256")))
    for t in totals:
        rows = rows.unionByName(facts(t, leaves=col("leaves"), saved=col("saved")))
        rows = rows.unionByName(facts(t.filter("depth = 1").select(col("parent").alias("name"), *_SUMS),
                                      leaves=col("leaves"), saved=col("saved")))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    trie = materialize(rows.groupBy("name").agg(
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent", "n_convs")], zero("n_children").alias("n_children"),
        zero("leaves").alias("n_leaves"), zero("saved").alias("saved_tokens"),
        F.coalesce(F.max("ends"), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")), "trie")
    parents = trie.filter("n_children > 0").select(col("name").alias("parent"), col("conv_id").alias("parent_conv_id"))
    return join_small(trie, parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversation_trie(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text") -> DataFrame:
    """The prefix trie of a table of turns, as it is."""
    steps = materialize(ordered_turns(rows, conv_id, turn, role, text), "ordered-turns")
    return prefix_trie(steps, materialize(lengths(steps), "lengths"))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return prefix_trie(*rebuild(materialize(ordered_turns(rows), "ordered-turns")))


#: Prefixes as joined hashes of their turns; subtrees by the ancestors on the smallest member's path;
#: CRC-32 from its polynomial.
OP13_SQL = r"""
WITH RECURSIVE bits AS (SELECT range AS i, 0 AS n, range AS c FROM range(256) UNION ALL
  SELECT i, n + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM bits WHERE n < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE n = 8),
named AS (SELECT conv_id AS c, turn, text, substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS name
          FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT c, name, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS words,
                 row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, name) AS pos FROM named),
convs AS (SELECT c, count(*) AS n, c - c % 20 AS base,
                 xor(list_reduce(list_transform(regexp_extract_all(hex(encode(c::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT),
                                 lambda a, x: xor(a >> 8, any_value(t)[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 4 AS h
          FROM turns, crc GROUP BY c),
lent AS (SELECT a.*, least(a.h, coalesce(b.n, 0)) AS lent FROM convs a LEFT JOIN convs b ON a.base = b.c),
steps AS (SELECT l.c, pos AS d, name, words FROM lent l JOIN turns t ON t.c = l.base AND pos <= l.lent
          UNION ALL SELECT l.c, pos - h + lent, name, words FROM lent l JOIN turns t ON t.c = l.c AND pos > l.h),
member AS (SELECT c, 0 AS d, '' AS p, 0 AS words FROM lent UNION ALL
           SELECT c, d, string_agg(name, '') OVER (PARTITION BY c ORDER BY d), words FROM steps),
depth AS (SELECT c, max(d) AS len FROM member GROUP BY c),
node AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words,
                count(*) FILTER (d = len) AS n_ends, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = len) AS ends
         FROM member JOIN depth USING (c) GROUP BY p, d),
child AS (SELECT a.p, count(*) AS n_children FROM node b JOIN member a ON a.c = b.conv_id AND a.d = b.d - 1 GROUP BY a.p),
below AS (SELECT a.p, count(*) FILTER (b.n_convs = b.n_ends) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved
          FROM node b JOIN member a ON a.c = b.conv_id AND a.d <= b.d GROUP BY a.p),
above AS (SELECT b.p, a.p AS parent FROM node b JOIN member a ON a.c = b.conv_id AND a.d = b.d - 1)
SELECT n.conv_id, n.d::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM node n JOIN below USING (p) LEFT JOIN child USING (p) LEFT JOIN above USING (p) LEFT JOIN node q ON q.p = above.parent
"""
