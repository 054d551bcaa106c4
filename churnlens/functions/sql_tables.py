"""The feature job as SQL text: table functions with SQL bodies over scoped views.

``sql_scope`` gives DataFrames names for the text inside a ``with`` block. Views and functions get
names of their own per scope and are dropped at its end, so two scopes never see each other's
"current table" and nothing stays behind in the session; results made inside stay valid, as
Spark has put the functions' bodies into their plans.

    with sql_scope(spark, log=cleaned) as s:
        s.sql("SELECT userId, avg_sess_len FROM {session_means}()")
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from churnlens.functions.sql import register_sql_functions
from churnlens.operators.joins import materialize
from churnlens.schema import FEATURE_PAGES

#: Table functions over the view ``log`` (a cleaned log): name -> (parameters, columns, body).
LOG_FUNCTIONS = {
    "session_pages": ("", "userId STRING, sessionId BIGINT, page STRING, cnt BIGINT, avg_ts DOUBLE, min_ts BIGINT, max_ts BIGINT, "
                          "len_sum DOUBLE, len_n BIGINT, item_sum BIGINT, item_n BIGINT, gender_f INT, system STRING, churn BIGINT", """
        SELECT userId, sessionId, page, COUNT(page), AVG(ts), MIN(ts), MAX(ts), SUM(length), COUNT(length), SUM(itemInSession),
               COUNT(itemInSession), MAX(CASE WHEN gender = 'F' THEN 1 ELSE 0 END), MAX(userSystem), MAX(churn)
        FROM {log} GROUP BY userId, sessionId, page"""),
    "events_between": ("first_ms BIGINT, last_ms BIGINT", "userId STRING, page STRING, ts BIGINT, churn BIGINT", """
        SELECT userId, page, ts, churn FROM {log} WHERE ts BETWEEN first_ms AND last_ms"""),
    "bucket_counts": ("cancelled BOOLEAN", "hour FLOAT, events BIGINT", """
        SELECT to_hour(ts), COUNT(*) FROM {log} WHERE (churn > 0) = cancelled GROUP BY to_hour(ts)"""),
}
#: ... over the view ``base`` (the rows of ``session_pages``).
BASE_FUNCTIONS = {
    "session_means": ("", "userId STRING, avg_sess_len DOUBLE, n_sess BIGINT", """
        SELECT userId, AVG(to_minutes(b - a)), COUNT(sessionId)
        FROM (SELECT userId, sessionId, MIN(min_ts) AS a, MAX(max_ts) AS b FROM {base} GROUP BY userId, sessionId)
        GROUP BY userId"""),
    "user_scalars": ("", "userId STRING, churn BIGINT, avg_sess_p_day DOUBLE, avg_length DOUBLE, avg_items_p_sess DOUBLE, acc_age INT, "
                         "avg_sess_len DOUBLE, bin_gender INT, pref_user_system STRING", """
        SELECT userId, CASE WHEN c > 0 THEN 1 ELSE 0 END, n_sess / (to_days(b - a) + 1), TRY_DIVIDE(len_sum, len_n),
               TRY_DIVIDE(item_sum, item_n), to_days(b - a), avg_sess_len, g, COALESCE(NULLIF(s, ''), 'unknown')
        FROM (SELECT userId, MAX(churn) AS c, MIN(min_ts) AS a, MAX(max_ts) AS b, SUM(len_sum) AS len_sum, SUM(len_n) AS len_n,
                     SUM(item_sum) AS item_sum, SUM(item_n) AS item_n, MAX(gender_f) AS g, MAX(system) AS s
              FROM {base} GROUP BY userId) JOIN {session_means}() USING (userId)"""),
    "page_means": ("skipped STRING", "userId STRING, page STRING, avg_mhly_cnt DOUBLE", """
        SELECT userId, page, AVG(m) FROM (SELECT userId, page, AVG(cnt) AS m FROM {base}
                                          WHERE skipped IS NULL OR page <> skipped GROUP BY userId, page, to_month(avg_ts))
        GROUP BY userId, page"""),
}


class Scope:
    """Names of one block of SQL text."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names, self._drop = spark, {}, []
        self.prefix = f"scope_{uuid.uuid4().hex[:10]}_"

    def view(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(self.prefix + name)
        self.names[name] = self.prefix + name
        self._drop.append(f"DROP VIEW IF EXISTS {self.prefix + name}")

    def functions(self, functions: dict[str, tuple[str, str, str]]) -> None:
        for name, (parameters, columns, body) in functions.items():
            text = body.format(**self.names)
            self.spark.sql(f"CREATE TEMPORARY FUNCTION {self.prefix + name}({parameters}) RETURNS TABLE ({columns}) RETURN {text}")
            self.names[name] = self.prefix + name
            self._drop.insert(0, f"DROP TEMPORARY FUNCTION IF EXISTS {self.prefix + name}")

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text.format(**self.names))

    def close(self) -> None:
        for statement in self._drop:
            self.spark.sql(statement)
        self._drop = []


@contextmanager
def sql_scope(spark: SparkSession, **views: DataFrame) -> Iterator[Scope]:
    """Named DataFrames, with the table functions that belong to ``log`` and ``base``."""
    register_sql_functions(spark)
    scope = Scope(spark)
    try:
        for name, df in views.items():
            scope.view(name, df)
        if "log" in views:
            scope.functions(LOG_FUNCTIONS)
        if "base" in views:
            scope.functions(BASE_FUNCTIONS)
        yield scope
    finally:
        scope.close()


def _pages(pages: list[str]) -> tuple[str, str]:
    alias = [(p, p.replace(" ", "_")) for p in pages]
    return (", ".join("'{}' AS {}".format(p.replace("'", "\\'"), a) for p, a in alias),
            ", ".join(f"COALESCE(p.{a}, 0) AS {a}" for _, a in alias))


def feature_job_sql(pages: list[str] = FEATURE_PAGES) -> str:
    """The feature table as SQL text over the functions of a scope with ``base``."""
    found, columns = _pages(pages)
    return f"""
SELECT s.*, {columns}
FROM {{user_scalars}}() s
JOIN (SELECT * FROM (SELECT * FROM {{page_means}}(NULL)) PIVOT (SUM(avg_mhly_cnt) FOR page IN ({found}))) p USING (userId)"""


def user_features_sql(spark: SparkSession, cleaned: DataFrame) -> DataFrame:
    """``user_features``, written in SQL: one pass over the log, then its (written) base."""
    with sql_scope(spark, log=cleaned) as s:
        base = materialize(s.sql("SELECT * FROM {session_pages}()"), "sql-base")
    with sql_scope(spark, base=base) as s:
        return s.sql(feature_job_sql())
