"""Line dedup: lines found in several documents stay in one of them.

Lines are reduced to a 128-bit hash of their key, deduplicated inside each
document, range-partitioned by hash and sorted inside the partitions by
document and position; a stream over each hash meets the keeping document
first. The result is a bitmap of kept lines per document, compressed to runs,
instead of text; ``apply_bitmaps`` cuts the texts.

A hash held by a third of all documents must not meet in one task, so the
range partitioning is on (hash, salt) with the salt taken from the document:
each salted stream passes on only its first ``min_docs`` documents, which is
all the second stream over the whole hash needs (the keeper, and whether there
are enough documents). All steps are DataFrame operations.

The lines' table meets the repeated keys in a join that broadcasts them behind a size check and
salts the frequent ones beyond it, and each position of a text is counted once before a
text's positions are gathered, so neither a line of a third of all documents nor a document
that is repeated thousands of times comes together in one task.

Defined results: null and empty texts are one empty line; texts of any length are judged as a
whole; a null doc_id counts as one document below all others; rows that repeat a doc_id are one
document, their lines are decided alike and each row keeps its own bitmap; an empty table
gives an empty table; ``drop_repeated_lines`` returns all columns as they were, whatever their
names, and ``with_bitmaps`` takes over those it does not name itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.text import UPPER, WHITE, field, packed, quoted, unpacked
from churnlens.operators.joins import join_small, materialize, written_bytes
from churnlens.session import max_broadcast_bytes

MIN_CHARS = 20
MIN_DOCS = 3
SALTS = 64
NO_DOC = -(2**63)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, UPPER.lower())


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, text: str, doc_id: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(__doc, __text, __h1, __h2, __at): one row per line whose key is long enough.
    __doc and __text (a hash of the whole text) name the row; __h1 and __h2 the key."""
    key = line_key(F.col("__line"))
    return (docs.select(F.coalesce(quoted(doc_id).cast("long"), F.lit(NO_DOC)).alias("__doc"),
                        F.xxhash64(quoted(text)).alias("__text"),
                        F.posexplode(_lines(quoted(text))).alias("__at", "__line"))
            .withColumn("__line", key)
            .filter(F.char_length("__line") >= min_chars)
            .select("__doc", "__text", F.xxhash64("__line").alias("__h1"),
                    F.xxhash64(F.lit("second"), "__line").alias("__h2"), "__at"))


def _first(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first ``n`` documents of each key, each once: range-partitioned by the
    key, streamed by document, largest first."""
    stream = Window.partitionBy(*keys).orderBy(F.col("__doc").desc())
    return (df.repartitionByRange(*keys)
            .withColumns({"__rank": F.dense_rank().over(stream), "__last": F.lag("__doc").over(stream)})
            .filter((F.col("__rank") <= n) & (F.col("__last").isNull() | (F.col("__last") != F.col("__doc"))))
            .drop("__last"))


def repeated_keys(lines: DataFrame, min_docs: int = MIN_DOCS, salts: int = SALTS) -> DataFrame:
    """(__h1, __h2, __keeper) of the keys found in at least ``min_docs`` documents."""
    salted = lines.select("__h1", "__h2", "__doc", F.pmod(F.xxhash64("__doc"), F.lit(salts)).alias("__salt"))
    heads = _first(salted, ["__h1", "__h2", "__salt"], min_docs).select("__h1", "__h2", "__doc")
    return (_first(heads, ["__h1", "__h2"], min_docs)
            .groupBy("__h1", "__h2").agg(F.max("__doc").alias("__keeper"), F.max("__rank").alias("__n"))
            .filter(F.col("__n") >= min_docs).select("__h1", "__h2", "__keeper"))


def kept_runs(n_lines: Column, dropped: Column) -> Column:
    """Runs (start, len) of kept lines, from the sorted positions of the dropped ones."""
    ends = F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines.cast("int")))
    runs = F.zip_with(F.slice(ends, 1, F.size(ends) - 1), F.slice(ends, 2, F.size(ends) - 1),
                      lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("len")))
    return F.filter(runs, lambda r: r["len"] > 0)


def keep_bitmaps(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *,
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, salts: int = SALTS) -> DataFrame:
    """One row per document that loses lines: __doc, __text, __dropped (sorted positions
    of the lines that go, the complement of the bitmap)."""
    lines = materialize(line_hashes(docs, text, doc_id, min_chars), "lines")
    gone = (join_small(lines, repeated_keys(lines, min_docs, salts), ["__h1", "__h2"])
            .filter(F.col("__doc") < F.col("__keeper")).select("__doc", "__text", "__at").distinct())
    return gone.groupBy("__doc", "__text").agg(F.array_sort(F.collect_list("__at")).alias("__dropped"))


def _met(rows: DataFrame, maps: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """``rows`` with __n_lines, __n_dropped and __keep of their texts. Where a partition of the bitmaps is
    small, the texts are streamed past it without a sort."""
    maps = maps.withColumnsRenamed({"__doc": "__d", "__text": "__t"})
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if written_bytes(maps) <= parts * max_broadcast_bytes(rows.sparkSession):
        maps = maps.hint("shuffle_hash")
    dropped = F.coalesce("__dropped", F.array().cast("array<int>"))
    return (rows.withColumns({"__doc": F.coalesce(doc_id.cast("long"), F.lit(NO_DOC)), "__text": F.xxhash64(text)})
            .join(maps, (F.col("__doc") == F.col("__d")) & (F.col("__text") == F.col("__t")), "left")
            .withColumn("__n_lines", F.size(_lines(text)).cast("long"))
            .withColumn("__n_dropped", F.size(dropped).cast("long"))
            .withColumn("__keep", kept_runs(F.col("__n_lines"), dropped))
            .drop("__doc", "__text", "__d", "__t", "__dropped"))


def with_bitmaps(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **limits) -> DataFrame:
    """``docs`` with ``__n_lines``, ``__n_dropped`` and ``__keep``, the run-length compressed bitmap of kept lines.
    The texts are shuffled once."""
    return _met(docs, materialize(keep_bitmaps(docs, text, doc_id, **limits), "bitmaps"), quoted(doc_id), quoted(text))


def apply_bitmap(text: Column, keep: Column) -> Column:
    """The kept lines, joined by a newline."""
    lines = _lines(text)
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["len"]))), "\n")


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **limits) -> DataFrame:
    """``docs`` with the repeated lines cut out of the text; texts that lose none are
    unchanged (null stays null), all other columns too."""
    maps = materialize(keep_bitmaps(docs, text, doc_id, **limits), "bitmaps")
    body = field(docs, text)
    out = _met(packed(docs), maps, field(docs, doc_id), body)
    return unpacked(out, docs, **{text: F.when(F.col("__n_dropped") > 0, apply_bitmap(body, F.col("__keep"))).otherwise(body)})


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = F.when(F.col("__n_dropped") > 0, apply_bitmap(F.col("text"), F.col("__keep"))).otherwise(
        F.coalesce("text", F.lit("")))
    return with_bitmaps(docs).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
n AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key
      HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, n.key IS NOT NULL AND k.doc_id < n.keeper AS gone FROM k LEFT JOIN n USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
