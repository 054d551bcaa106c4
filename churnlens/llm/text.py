"""Small text helpers shared by the operators: words, lower-casing, word counts.

A word is a maximal run of characters other than space and U+0009 to U+000D
(``[^\\x20\\x09-\\x0D]+``). ``bytes.split()`` cuts UTF-8 at exactly those six
characters and ``bytes.lower()`` changes exactly A-Z, so Python code inside
tasks works on UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Bytes of text that a task hands to Python at once (Spark's own default is 64 MB).
BATCH_BYTES = 8 << 20


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold at most BATCH_BYTES, however long the texts.

    The setting is read when a plan runs, which is after this call, so it stays with the session."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    size = conf.get(key).lower().removesuffix("b")
    if not size.isdigit() or not 0 < int(size) <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def words(text: str | None) -> list[bytes]:
    """The words of a whole text as UTF-8 bytes; none for null."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """As ``words``, with A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def lower_az(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def n_words(col: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> DataFrame:
    """``df`` as one struct column ``row``: columns beside it clash with none of its own."""
    return df.select(F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(df.columns)]).alias("row"))


def field(df: DataFrame, name: str) -> Column:
    """The column ``name`` of ``df`` in what ``packed`` makes of it."""
    return F.col("row").getField(f"c{df.columns.index(name)}")


def unpacked(rows: DataFrame, df: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``df`` from rows of ``packed``, with new values for those in ``replaced``."""
    return rows.select(*[replaced.get(c, field(df, c)).alias(c) for c in df.columns])


def map_texts(df: DataFrame, text: str, function: Callable, result: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df.mapInArrow`` with a column ``text`` for ``function``, which returns the other columns
    and those of ``result``. Columns named in ``drop`` are left out, the others pass under
    names of their own, so no name is special."""
    kept = [c for c in df.columns if c != text and c not in drop]
    inside = df.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)], quoted(text).alias("text"))
    types = [f"c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
    out = inside.mapInArrow(function, ", ".join([*types, result]))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *[quoted(c) for c in out.columns[len(kept):]])
