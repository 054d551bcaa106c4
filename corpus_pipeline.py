"""The corpus pipeline: documents that quality rules keep, without lines that
repeat across documents, one of each group of near copies, mixed to the sources'
target weights, as token ids.

Every stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes each
result as Parquet into the session's shared folder and reads it as the next
stage's documents; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm.line_dedup import drop_repeated_lines
from churnlens.llm.mixing import mix
from churnlens.llm.pieces import encode_pieces
from churnlens.llm.quality import keep_good
from churnlens.llm.simhash import keep_one_of_each
from churnlens.session import scratch, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's verdict reject go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in several documents stay in one."""
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the scores of the best segmentations, instead of the text."""
    return encode_pieces(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing", mixing),
    ("SentencePiece", pieces),
]

#: SimHash (XXH64) and the lattice search are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch(spark):  # the stage's own tables go when its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
