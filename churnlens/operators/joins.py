"""Joins of a large frame with a per-key frame, broadcast only behind a size check.

``join_small(big, small, key, how)`` is the one way the library attaches a
per-user (or per-class) table to a larger frame:

1. ``small`` is written as a table in the shared folder (reliable: a lost
   executor does not lose it, and the size check does not recompute it);
2. if it holds at most ``max_rows`` rows (a footer-only count of the written
   table) in files below the byte limit it is broadcast — no shuffle of the large side at all;
3. otherwise both sides are shuffled on ``key``, and the keys that hold more
   than a fair share of the large side ("hot" keys) are salted: each one's
   large-side rows are spread over ``ceil(2 rows / share)`` sub-keys and only
   its small-side row is replicated that often (at most 3 x shuffle
   partitions extra rows in total). AQE's skew-join split stays on as a second line of
   defence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.session import max_broadcast_bytes, max_broadcast_rows, scratch_path

_SALT = "__salt"
_HOT = "__hot"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage (later actions read the written rows instead of
    recomputing them) and survives the loss of the executors that computed
    them. Unlike ``Dataset.checkpoint`` — whose eager count and checkpoint
    write each run the full lineage — the input is computed exactly once, and
    the read-back carries file-size statistics for the optimizer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def written_bytes(df: DataFrame) -> int:
    """Size of a written table's files, as the optimizer sees it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows in files of at most the byte limit.

    Called on tables written by ``materialize``: counting parquet reads only
    the row-group footers. (A ``limit(n + 1).count()`` would gather up to
    n + 1 rows from every task into a single partition.)
    """
    return written_bytes(df) <= max_broadcast_bytes(df.sparkSession) and df.count() <= max_rows


def join_small(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner", *,
               max_rows: int | None = None, already_materialized: bool = False,
               proven_rows: int | None = None) -> DataFrame:
    """Join ``big`` with ``small`` (at most one row per key of ``on``).

    ``proven_rows`` is a bound the caller knows from how ``small`` was built
    (e.g. one row per class): within the limit it is broadcast with no check.
    """
    spark = big.sparkSession
    limit = max_rows if max_rows is not None else max_broadcast_rows(spark)
    if proven_rows is not None and proven_rows <= limit:
        return big.join(F.broadcast(small), on, how)
    if not already_materialized:
        small = materialize(small, "small-side")
    if fits(small, limit):
        return big.join(F.broadcast(small), on, how)
    return salted_join(big, small, on, how)


def join_null_safe(big: DataFrame, small: DataFrame, on: list[str], *,
                   proven_rows: int | None = None) -> DataFrame:
    """Inner join on ``on`` where NULL equals NULL; ``small`` has one row per key and is
    broadcast when its bound is proven or its written size allows."""
    limit = max_broadcast_rows(big.sparkSession)
    if proven_rows is None or proven_rows > limit:
        small = materialize(small, "small-side")
    named = small.withColumnsRenamed({k: f"__key_{i}" for i, k in enumerate(on)})
    if proven_rows is not None and proven_rows <= limit or fits(small, limit):
        named = F.broadcast(named)
    same = F.lit(True)
    for i, k in enumerate(on):
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{i}"))
    return big.join(named, same, "inner").drop(*[f"__key_{i}" for i in range(len(on))])


def hot_keys(big: DataFrame, on: list[str]) -> DataFrame:
    """Keys holding more rows than one shuffle partition's fair share, with their salt count.

    ``share = rows / spark.sql.shuffle.partitions``; a key with ``n > share``
    rows gets ``ceil(2n / share)`` salts, so each salted piece holds at most
    half a fair share and lands next to ordinary keys without overloading its
    partition. Fewer than ``partitions`` keys can be hot and their salts sum
    to at most ``3 * partitions``: the table has a proven size bound and is
    safe to broadcast, and the small side grows by at most that many rows.
    """
    n_parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialize(big.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")), "key-counts")
    total = counts.agg(F.sum("__n")).first()[0] or 0
    share = max(1, total // max(1, n_parts))
    return (counts.filter(F.col("__n") > share)
            .select(*on, F.ceil(F.col("__n") * 2 / F.lit(share)).cast("int").alias(_HOT)))


def is_scan(df: DataFrame) -> bool:
    """Whether a plan only reads files, projects and filters: its tasks see the same rows in the
    same order whenever they run."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter"):
        node = node.children().head()
    return node.children().isEmpty() and node.nodeName() in ("LogicalRelation", "DataSourceV2ScanRelation", "Range", "LocalRelation")


def salted_join(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Shuffle join on ``on`` with each hot key spread over its own number of salts.

    ``how`` is one of inner / left / left_semi / left_anti; ``big`` is the left
    side. Exact: every large-side row meets exactly the one replica of its
    small-side row that carries its salt. The salt is the row's position in its
    task's input, so equal rows are spread too; it is the same when a scan is
    run again. A large side that is more than a scan is written first, as behind a
    shuffle a task that is run again may see its rows in another order.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not is_scan(big):
        big = materialize(big, "large-side")
    hot = F.broadcast(hot_keys(big, keys))
    b = (big.withColumn(_SALT, F.monotonically_increasing_id()).join(hot, keys, "left")
         .withColumn(_SALT, F.when(F.col(_HOT).isNotNull(), F.pmod(_SALT, F.col(_HOT).cast("long")))
                     .otherwise(F.lit(0)).cast("int"))
         .drop(_HOT))
    s = (small.join(hot, keys, "left")
         .withColumn(_SALT, F.explode(F.when(F.col(_HOT).isNotNull(),
                                             F.sequence(F.lit(0), F.col(_HOT) - 1))
                                      .otherwise(F.array(F.lit(0)))))
         .drop(_HOT))
    return b.join(s, keys + [_SALT], how).drop(_SALT)


def attach_features(features: DataFrame, new: DataFrame, names: list[str],
                    key: str = "userId") -> DataFrame:
    """Inner-join per-user feature columns ``names`` of ``new`` onto ``features``.

    Both sides hold one row per user, so there is no hot key; the physical
    join (broadcast, or sort-merge on co-partitioned aggregates) is Catalyst's.
    """
    return features.join(new.select(key, *names), key, "inner")


def rows_of_users(events: DataFrame, users: DataFrame, key: str = "userId",
                  *, max_rows: int | None = None) -> DataFrame:
    """Rows of ``events`` whose user is listed in ``users`` (a semi-join)."""
    return join_small(events, users.select(key).distinct(), key, "left_semi", max_rows=max_rows)
