"""A saved random forest as a table of nodes, applied by joins.

``forest_nodes`` reads the trees of a saved model as rows (tree, node, feature, threshold,
children, class statistics); ``walk_forest`` moves every row of a feature table from the roots
down, one join with that table per level, until all are in leaves, and adds up the leaves' class
shares as the classifier does. No model object is loaded: the nodes can be stored,
versioned, compared and queried like any table, and scoring needs no ML runtime. The node table is bounded by
trees x 2^(depth + 1) rows; it is broadcast behind the usual size check, so the walk of a
large table is one pass without a shuffle.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.operators.joins import join_small, materialize


def _stage(model_path: str) -> str:
    return f"{model_path.rstrip('/')}/stages/*_RandomForestClassifier_*"


def forest_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """The nodes of a saved pipeline's forest: tree, node, feature (-1 in leaves), threshold,
    categories (those that go left, for a categorical feature), left, right, stats (weight per
    class), share (class shares times the tree's weight), gain, rows."""
    # by place: the names of these columns differ between releases
    data = spark.read.parquet(f"{_stage(model_path)}/data").toDF("treeID", "nodeData")
    weights = spark.read.parquet(f"{_stage(model_path)}/treesMetadata").toDF("tree", "metadata", "w").drop("metadata")
    n = F.col("nodeData")
    leaf, categorical = n["leftChild"] < 0, n["split"]["numCategories"] >= 0
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    nodes = data.select(
        F.col("treeID").alias("tree"), n["id"].alias("node"),
        F.when(leaf, F.lit(-1)).otherwise(n["split"]["featureIndex"]).alias("feature"),
        F.when(~leaf & ~categorical, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(~leaf & categorical, n["split"]["leftCategoriesOrThreshold"]).alias("categories"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["impurityStats"].alias("stats"),
        F.when(total > 0, F.transform(n["impurityStats"], lambda x: x / total)).alias("share"),
        n["gain"].alias("gain"), n["rawCount"].alias("rows"))
    return (nodes.join(F.broadcast(weights), "tree")  # one row a tree
            .withColumn("share", F.transform("share", lambda x: x * F.col("w"))).drop("w"))


def walk_forest(rows: DataFrame, nodes: DataFrame, key: str = "userId", features: str = "features_scaled") -> DataFrame:
    """(key, probability, prediction) of every row: ``key`` is distinct, ``features`` a vector."""
    nodes = materialize(nodes, "forest")
    trees, classes = nodes.agg(F.count_distinct("tree"), F.max(F.size("stats"))).first()
    depth = _depth(nodes)
    step = nodes.select("tree", "node", "feature", "threshold", "categories", "left", "right", "share")
    at = rows.select(F.col(key).alias("__key"), vector_to_array(features).alias("x"),
                     F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        inner = step.filter("feature >= 0").drop("share")
        value = F.get("x", F.col("feature"))
        left = F.when(F.col("categories").isNotNull(), F.array_contains("categories", value)).otherwise(value <= F.col("threshold"))
        at = (join_small(at, inner, ["tree", "node"], "left", already_materialized=True)
              .select("__key", "x", "tree", F.when(F.col("feature").isNull(), F.col("node"))
                      .when(left, F.col("left")).otherwise(F.col("right")).alias("node")))
    leaves = step.filter("feature < 0").select("tree", "node", "share")
    found = join_small(at.select("__key", "tree", "node"), leaves, ["tree", "node"], already_materialized=True)
    votes = found.groupBy("__key").agg(*[F.sum(F.get("share", F.lit(c))).alias(f"v{c}") for c in range(classes)])
    total = sum((F.col(f"v{c}") for c in range(1, classes)), F.col("v0"))
    p = F.array(*[F.col(f"v{c}") / total for c in range(classes)])
    best = F.array_position(p, F.array_max(p)) - 1  # of equal classes the lower
    return votes.select(F.col("__key").alias(key), p.alias("probability"), best.cast("double").alias("prediction"))


def _depth(nodes: DataFrame) -> int:
    """Levels below the roots."""
    depth, here = 0, nodes.filter("node = 0")
    while True:
        below = here.filter("feature >= 0").select("tree", F.explode(F.array("left", "right")).alias("node"))
        if below.isEmpty():
            return depth
        depth += 1
        here = nodes.join(below, ["tree", "node"])


def feature_importances(nodes: DataFrame) -> DataFrame:
    """(feature, importance): gains weighted by rows, summed to 1 within each tree, then over
    trees, then to 1 again."""
    inner = nodes.filter("feature >= 0")
    per_tree = inner.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)).alias("g"))
    tree, every = Window.partitionBy("tree"), Window.partitionBy()  # at most features x trees rows
    shares = (per_tree.withColumn("s", F.col("g") / F.sum("g").over(tree)).groupBy("feature").agg(F.sum("s").alias("s")))
    return shares.select("feature", (F.col("s") / F.sum("s").over(every)).alias("importance"))
