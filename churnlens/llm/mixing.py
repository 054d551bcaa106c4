"""Mixing sources to target weights by capped water-filling.

Every source asks for a share of the corpus in proportion to its weight, but
no source may be used for more than ``max_epochs`` times its size. Sources
above their cap are clamped there and the excess is offered to the others in
proportion to their weights, until no source is above. A source's target
divided by its size gives its repetitions: the whole part goes to every
document, the rest to a seeded selection of documents.

The selection orders a source's documents by a seeded hash of doc_id and text, and takes
them from the front until the words meet the target (the document across the
border is taken when most of it fits), so a source misses its target by at
most half a document. Rows with the same hash are equal texts of one id: as many of them
are taken as fit, whichever. Only the border has to be found: sums per (source,
first three hash digits), a prefix sum over those at most 4096 rows per
source, and one look at the hashes of the two bins at the border. No
task ever holds a whole source, and the decision comes back to the documents
as one row per source: the hash at the border and how many of its rows are taken. Where that is
one of several rows, they are numbered by the part they are written in, so no task holds
all of them either.

Defined results: null and empty texts have size 0 and are taken 0 times (no
copies); texts of any length count as a whole; a null source is a source of its own, last in order;
a null doc_id is hashed as an empty string, beside the text, so rows without an id are a seeded
sample like any other; an empty table gives an empty table; ``mix`` returns all columns as they
were, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.text import field, n_words, packed, quoted, unpacked
from churnlens.operators.joins import materialize

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
BIN_DIGITS = 3  # hash digits of a bin: 16 ** 3 bins per source


def order_key(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    empty = F.lit("")
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), empty), F.lit(":"),
                          F.md5(F.coalesce(text, empty))))


def ranked(df: DataFrame, by: str, rank: str) -> DataFrame:
    """``df`` with its 0-based position in the order of the distinct column ``by``
    (nulls last): a range partitioning, one offset per partition, a row number inside."""
    parted = materialize(df.repartitionByRange(F.col(by).asc_nulls_last())
                         .withColumn("__part", F.spark_partition_id()), "ranked")
    offsets = (parted.groupBy("__part").count()  # at most one row per partition
               .withColumn("__before", F.sum("count").over(Window.orderBy("__part")) - F.col("count"))
               .select("__part", "__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(F.col(by).asc_nulls_last()))
    return (parted.withColumn("__row", inside).join(offsets, "__part")
            .withColumn(rank, F.col("__before") + F.col("__row") - 1).drop("__part", "__row", "__before"))


def water_fill(sources: DataFrame, weight: str, size: str, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (one row each) with a ``target`` column.

    Each round is one aggregate over the sources: those whose share of what is
    left exceeds their cap are clamped; it ends when no more are.
    """
    total = sources.agg(F.sum(size)).first()[0] or 0
    cap = (F.col(size) * max_epochs).cast("long")
    level, clamped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col(weight) * F.lit(level) >= cap
        got = sources.agg(F.sum(F.when(above, cap).otherwise(0)).alias("full"),
                          F.sum(F.when(above, 0).otherwise(F.col(weight))).alias("open"),
                          F.sum(above.cast("int")).alias("n")).first()
        if not got["open"] or got["n"] == clamped:
            break
        level, clamped = (total - got["full"]) / got["open"], got["n"]
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    if not got["open"]:
        return sources.withColumn("target", cap.cast("double"))
    return sources.withColumn("target", F.least(cap.cast("double"), F.col(weight) * F.lit(level)))


def plan_mix(sized: DataFrame, source: str = "source", size: str = "size", key: str = "__key", *,
             weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, __whole (copies for all) and __cut (k, the hash from
    which on documents get no extra copy, and how many, fit, of the n rows with that hash do)."""
    sources = ranked(sized.groupBy(source).agg(F.sum(size).cast("long").alias("source_size")), source, "__rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("__rank") % len(weights) + 1).cast("int"))
    sources = materialize(sources.withColumn("__w", weight.cast("long")), "sources")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = (water_fill(sources, "__w", "source_size", max_epochs)
            .withColumn("__whole", whole.cast("long"))
            .withColumn("__goal", F.col("target") - F.col("__whole") * F.col("source_size"))
            .select(F.col(source).alias("__source"), "source_size", "target", "__whole", "__goal"))
    same = F.col(source).eqNullSafe(F.col("__source"))

    first_of = lambda k: F.substring(k, 1, BIN_DIGITS)
    bins = sized.groupBy(source, first_of(F.col(key)).alias("__bin")).agg(F.sum(size).alias("__words"))
    upto = Window.partitionBy(source).orderBy("__bin")
    border = (bins.withColumn("__end", F.sum("__words").over(upto)).join(plan, same)
              .filter("__end > __goal")
              .withColumn("__nth", F.row_number().over(upto)).filter("__nth <= 2")
              .select("__source", "__bin", "__goal", (F.col("__end") - F.col("__words")).alias("__before")))
    # rows of one hash have one size; of a hash's n rows, those whose middle is not beyond the goal
    inside = Window.partitionBy("__source", "__bin").orderBy("__k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = (sized.filter(F.col(size) > 0).groupBy(source, F.col(key).alias("__k")).agg(
        F.max(size).alias("__s"), F.count(F.lit(1)).alias("__n")).withColumn("__b", first_of(F.col("__k"))))
    fit = F.floor((F.col("__goal") - F.col("__start")) / F.col("__s") + 0.5)
    cut = (each.join(border, same & (F.col("__b") == F.col("__bin")))
           .withColumn("__start", F.col("__before") + F.sum(F.col("__s") * F.col("__n")).over(inside) - F.col("__s") * F.col("__n"))
           .withColumn("__fit", F.greatest(F.lit(0), F.least(F.col("__n"), fit)).cast("long"))
           .filter("__fit < __n").groupBy(F.col("__source").alias("__cs"))
           .agg(F.min(F.struct(F.col("__k").alias("k"), F.col("__fit").alias("fit"), F.col("__n").alias("n"))).alias("__cut")))
    return materialize(plan.join(cut, F.col("__source").eqNullSafe(F.col("__cs")), "left")
                       .select("__source", "source_size", "target", "__whole", "__cut"), "mix")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (written) with ``__nth``, from 1 within each source: the part they were written in
    first, then the row there; ``__part`` and ``__at`` come with them."""
    held = rows.groupBy("__source", "__part").agg(F.count(F.lit(1)).alias("__held"))  # a row per source and part
    before = held.select(F.col("__source").alias("__bs"), F.col("__part").alias("__bp"),
                         (F.sum("__held").over(Window.partitionBy("__source").orderBy("__part")) - F.col("__held")).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__source", "__part").orderBy("__at"))
    return (rows.withColumn("__nth", inside)
            .join(before, F.col("__source").eqNullSafe(F.col("__bs")) & (F.col("__part") == F.col("__bp")))
            .withColumn("__nth", F.col("__nth") + F.col("__before")).drop("__bs", "__bp", "__before"))


def with_copies(rows: DataFrame, plan: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``rows`` (with __from, the source, __size and __key) that the mix knows, with ``__copies``
    and the columns of ``plan``."""
    some = F.col("__cut.k") == F.col("__key")
    met = rows.join(plan, F.col("__from").eqNullSafe(F.col("__source")), "left")
    extra = F.col("__cut").isNull() | (F.col("__key") < F.col("__cut.k"))

    def copies(extra: Column) -> Column:
        return F.when(F.col("__size") == 0, F.lit(0).cast("long")).otherwise(
            F.least(F.col("__whole") + F.when(F.col("__whole") < max_epochs, extra.cast("long")).otherwise(0),
                    F.lit(max_epochs).cast("long")))
    out = met.withColumn("__copies", copies(extra))
    if plan.filter("__cut.fit > 0 AND __cut.fit < __cut.n").isEmpty():  # a row per source
        return out
    # some rows of one hash are taken and some are not
    tied = materialize(met.filter(some & (F.col("__cut.fit") > 0)).withColumns(
        {"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "tied-rows")
    tied = _numbered(tied).withColumn("__copies", copies(F.col("__nth") <= F.col("__cut.fit")))
    rest = out.filter(~F.coalesce(some & (F.col("__cut.fit") > 0), F.lit(False)))
    return rest.unionByName(tied.select(*rest.columns))


def _sized(docs: DataFrame, text: str, doc_id: str, source: str, seed: int) -> DataFrame:
    return materialize(docs.select(quoted(doc_id).alias("doc_id"), quoted(source).alias("source"),
                                   n_words(quoted(text)).alias("size"),
                                   order_key(quoted(doc_id), quoted(text), seed).alias("__key")), "sizes")


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", *,
        weights: Sequence[int] = WEIGHTS, seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, columns unchanged."""
    plan = plan_mix(_sized(docs, text, doc_id, source, seed), weights=weights, max_epochs=max_epochs)
    rows = packed(docs).select("row", field(docs, source).alias("__from"), n_words(field(docs, text)).alias("__size"),
                               order_key(field(docs, doc_id), field(docs, text), seed).alias("__key"))
    taken = (with_copies(rows, plan.select("__source", "__whole", "__cut"), max_epochs).filter("__copies > 0")
             .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))))
    return unpacked(taken, docs)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    sized = _sized(docs, "text", "doc_id", "source", SEED)
    rows = sized.withColumnsRenamed({"source": "__from", "size": "__size"})
    return with_copies(rows, plan_mix(sized)).select(
        "doc_id", F.col("__size").alias("size"), "source_size", "target", (F.col("__size") * F.col("__copies")).alias("taken"))


#: Closed form of the water level: with sources by cap per weight, the first k
#: are clamped, where k is the first for which the next would not be.
OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
o AS (SELECT *, 3 * n / w AS ratio,
             coalesce(sum(3 * n) OVER (ORDER BY 3 * n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
             sum(w) OVER (ORDER BY 3 * n / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_,
             sum(n) OVER () AS total FROM w),
l AS (SELECT max(level) AS level FROM (SELECT (total - full_)::DOUBLE / open_::DOUBLE AS level FROM o
                                       WHERE (total - full_)::DOUBLE / open_::DOUBLE < ratio ORDER BY ratio LIMIT 1)),
t AS (SELECT source, n, CASE WHEN level IS NULL THEN 3.0 * n ELSE least((3 * n)::DOUBLE, w * level) END AS target FROM o, l),
g AS (SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS whole FROM t),
c AS (SELECT d.*, g.n, g.target, g.whole, g.target - g.whole * g.n AS goal,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, n AS source_size, target,
       (size * (whole + CASE WHEN whole < 3 AND upto - size / 2 <= goal THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
