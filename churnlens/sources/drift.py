"""What fields a JSON log really has: profile against the expected schema, in one pass.

Every line is parsed to a VARIANT, whatever its fields and types; one aggregate counts the kinds of
value per field. A log with extra, missing or mistyped fields is thus seen before the typed reader
(``read_event_log``) fails on it, and without the inference pass that would widen a mistyped column
for all rows. Lines and fields never leave the executors; the result has one row per field and kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.schema import EVENT_LOG

MALFORMED = "malformed"


def variant_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(v): each line of a JSON log as a VARIANT, NULL where it is no JSON object. Empty lines
    are left out."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    v = F.try_parse_json("value")
    return lines.select(F.when(F.schema_of_variant(v).startswith("OBJECT"), v).alias("v"))


def _kind(t: Column) -> Column:
    """Kind of a value from its VARIANT type name."""
    return (F.when(t == "VOID", "null").when(t == "STRING", "string").when(t == "BOOLEAN", "boolean")
            .when(t.rlike("^(BIGINT|INT|SMALLINT|TINYINT)$") | t.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
            .when(t.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number").when(t.startswith("ARRAY"), "array")
            .when(t.startswith("OBJECT"), "object").otherwise(F.lower(t)))


def field_kinds(lines: DataFrame) -> DataFrame:
    """(field, kind, n): how many lines hold a field with a kind of value; the lines that are no
    object have the kind 'malformed' and no field, all lines the kind 'lines' and no field. One pass."""
    named = F.map_entries(F.col("v").cast("map<string,variant>"))
    one = lambda field, kind: F.struct(field.alias("field"), kind.alias("kind"))
    nothing = F.lit(None).cast("string")
    seen = F.concat(F.array(one(nothing, F.lit("lines"))),
                    F.when(F.col("v").isNull(), F.array(one(nothing, F.lit(MALFORMED))))
                    .otherwise(F.transform(named, lambda e: one(e["key"], _kind(F.schema_of_variant(e["value"]))))))
    return lines.select(F.inline(seen)).groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n"))


def merged_schema(lines: DataFrame) -> str:
    """The type that holds every line, as text (fields merged over all lines)."""
    return lines.agg(F.schema_of_variant_agg("v")).first()[0]


def _fitting(t: T.DataType) -> list[str]:
    if isinstance(t, T.StringType):
        return ["string"]
    if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
        return ["integer", "number"]
    if isinstance(t, T.IntegralType):
        return ["integer"]
    return ["boolean"] if isinstance(t, T.BooleanType) else [t.typeName()]


def drift_report(kinds: DataFrame, schema: T.StructType = EVENT_LOG) -> DataFrame:
    """One row per field of the schema or the log: field, expected (type; NULL for extra fields),
    fits, mistyped, nulls, missing (lines without it) and kinds (those seen, as text)."""
    spark = kinds.sparkSession
    expected = spark.createDataFrame([(f.name, f.dataType.simpleString(), _fitting(f.dataType)) for f in schema.fields],
                                     "field string, expected string, fitting array<string>")
    total = kinds.filter("field IS NULL").agg(F.sum(F.when(F.col("kind") == "lines", F.col("n")).otherwise(-F.col("n")))).first()[0] or 0
    seen = kinds.filter("field IS NOT NULL").join(expected, "field", "full")
    fits = F.array_contains("fitting", F.col("kind"))
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return seen.groupBy("field", "expected").agg(
        count(fits).alias("fits"), count(F.col("expected").isNotNull() & ~fits & (F.col("kind") != "null")).alias("mistyped"),
        count(F.col("kind") == "null").alias("nulls"), (F.lit(total) - F.coalesce(F.sum("n"), F.lit(0))).cast("long").alias("missing"),
        F.concat_ws(",", F.sort_array(F.collect_set("kind"))).alias("kinds"))


def schema_drift(spark: SparkSession, path: str | list[str], schema: T.StructType = EVENT_LOG) -> DataFrame:
    return drift_report(field_kinds(variant_lines(spark, path)), schema)
