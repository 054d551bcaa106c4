"""Event-log sources.

* ``read_event_log``: the raw JSON log, read with an explicit schema (no
  inference pass over the input).
* ``read_parquet`` / ``read_table``: columnar hand-offs between jobs and the
  given test tables.
* ``events_as_event_log``: adapter from the generic ``events`` test table to
  the event-log columns (the test data carries no page, session, agent...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.schema import EVENT_LOG, RAW_COLUMNS


#: Column with the text of lines that do not fit the schema.
BAD_LINE = "_corrupt_record"


def read_event_log(spark: SparkSession, path: str | list[str], fmt: str = "json", *,
                   bad_lines: str = "fail", all_fields: bool = False) -> DataFrame:
    """Read the raw event log (JSON lines by default) with the fixed schema.

    A JSON line that is malformed or holds a value that does not fit its
    column (``"ts": 2.5``) is an error with ``bad_lines='fail'``; with 'keep' its
    text is in the column ``_corrupt_record`` (see ``split_bad_lines``).
    ``all_fields`` also reads the fields outside the schema, with inferred
    types (one more pass over the text), for the profiles of a new log.
    """
    if fmt != "json":
        return spark.read.schema(EVENT_LOG).format(fmt).load(path)
    fields = list(EVENT_LOG.fields)
    if all_fields:
        known = {f.name for f in fields}
        fields += [f for f in spark.read.json(path).schema.fields if f.name not in known | {BAD_LINE}]
    if bad_lines == "fail":
        return spark.read.schema(T.StructType(fields)).json(path, mode="FAILFAST")
    if bad_lines != "keep":
        raise ValueError(f"bad_lines is 'fail' or 'keep', not {bad_lines!r}")
    fields.append(T.StructField(BAD_LINE, T.StringType()))
    return spark.read.schema(T.StructType(fields)).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE)


def split_bad_lines(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, texts of the lines that do not) of a log read with
    ``bad_lines='keep'``."""
    return (log.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE),
            log.filter(F.col(BAD_LINE).isNotNull()).select(BAD_LINE))


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given test tables, e.g. ``read_table(spark, dir, 'events')``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- Test-table adapter -------------------------------------------------------
# Fixed values of the adapter contract (shared with the SQL oracle): page per
# event_id % 15 for events that are neither views nor errors, and user agents
# per (user_id + event_id % 2) % 6 (index 5 = no agent).
ADAPTER_PAGES = [
    "About", "Add Friend", "Add to Playlist", "Downgrade", "Help", "Home",
    "Logout", "Roll Advert", "Save Settings", "Settings", "Submit Downgrade",
    "Submit Upgrade", "Thumbs Down", "Thumbs Up", "Upgrade",
]
ADAPTER_AGENTS = [
    "Mozilla/5.0 (Windows NT 6.1; WOW64)",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4)",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2)",
    "Mozilla/5.0 (X11; Linux x86_64)",
    "curl/7.0",
]
SESSION_SPAN_MS = 259_200_000  # three days


def _pick(index: Column, values: list[str]) -> Column:
    """values[index] as a CASE expression (NULL when out of range)."""
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(index == i, F.lit(v)) if expr is None
                else expr.when(index == i, F.lit(v)))
    return expr


def events_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapted log with NULL ``ts``, ``page``, ``gender`` and ``itemInSession`` on some rows
    (by event id), for the checks of the operators' NULL handling."""
    log = events_as_event_log(spark, sf_dir, keep=("event_id",))
    gaps = {"ts": 11, "page": 13, "gender": 7, "itemInSession": 5}
    return log.withColumns({c: F.when(F.col("event_id") % n != 1, F.col(c)) for c, n in gaps.items()}).drop("event_id")


def events_as_event_log(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``events`` test table shaped as a raw event log.

    Pure projection of the table: one output row per event, no shuffle.
    """
    ev = read_table(spark, sf_dir, "events")
    uid, eid = F.col("user_id"), F.col("event_id")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    etype, value = F.col("event_type"), F.col("value")
    page = (F.when(etype == "view", F.lit("NextSong"))
            .when((etype == "error") & (value > 170), F.lit("Cancellation Confirmation"))
            .when(etype == "error", F.lit("Error"))
            .otherwise(_pick(eid % 15, ADAPTER_PAGES)))
    return ev.select(
        F.when(uid % 50 == 7, F.lit(None).cast("string"))
         .when(uid % 25 == 0, F.lit(""))
         .otherwise(uid.cast("string")).alias("userId"),
        page.alias("page"),
        F.when(eid % 3 == 0, F.lit("free")).otherwise(F.lit("paid")).alias("level"),
        (uid * 1000 + F.floor(ms / float(SESSION_SPAN_MS)) % 1000).alias("sessionId"),
        ms.alias("ts"),
        F.when(uid % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        (eid % 97).alias("itemInSession"),
        _pick((uid + eid % 2) % 6, ADAPTER_AGENTS).alias("userAgent"),
        F.when((etype == "view") & (uid % 40 != 3), value).alias("length"),
        F.lit("Logged In").alias("auth"), *keep,
    ).select(*RAW_COLUMNS, *keep)
