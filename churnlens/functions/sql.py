"""The time-part helpers as SQL functions, for queries written as SQL text.

``register_sql_functions(spark)`` defines ``to_days``, ``to_minutes``,
``to_hour``, ``to_month`` and ``to_day`` as SQL-bodied temporary functions.
The analyzer inlines their bodies, so SQL such as
``SELECT to_days(MAX(ts) - MIN(ts)) FROM log GROUP BY userId`` runs in
whole-stage codegen with no Python worker. Bodies equal ``functions.time``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from churnlens.functions.time import MS_PER_DAY, MS_PER_MINUTE

_INSTANT = "timestamp_millis(CAST(FLOOR(ms) AS BIGINT))"

SQL_FUNCTIONS = {
    "to_days": ("ms BIGINT", "INT", f"CAST(FLOOR(ms / {MS_PER_DAY}) AS INT)"),
    "to_minutes": ("ms BIGINT", "INT",
                   f"CAST(FLOOR(pmod(ms, {MS_PER_DAY}) / {MS_PER_MINUTE}) AS INT)"),
    "to_hour": ("ms DOUBLE", "FLOAT", f"CAST(hour({_INSTANT}) AS FLOAT)"),
    "to_month": ("ms DOUBLE", "FLOAT", f"CAST(month({_INSTANT}) AS FLOAT)"),
    "to_day": ("ms DOUBLE", "FLOAT", f"CAST(weekday({_INSTANT}) AS FLOAT)"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Define the helpers for this session; returns their names."""
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) "
                  f"RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
