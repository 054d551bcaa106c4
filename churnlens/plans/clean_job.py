"""Clean job: raw JSON event log -> cleaned parquet."""

from __future__ import annotations

from pyspark.sql import SparkSession

from churnlens.operators.clean import clean
from churnlens.operators.joins import materialize
from churnlens.session import ensure_core_conf, scratch
from churnlens.sources import read_event_log, split_bad_lines, write_parquet


def run_clean(spark: SparkSession, input_path: str, output_path: str, *,
              fmt: str = "json", mode: str = "errorifexists", bad_lines: str = "fail") -> str:
    """Read, clean and write the log.

    Text input (JSON) is parsed once: the kept columns are staged as parquet
    before the label's two reads. Lines that do not fit the schema are an
    error, or with ``bad_lines='keep'`` written to ``<output>.bad-lines``.
    """
    ensure_core_conf(spark)
    with scratch(spark):
        raw = read_event_log(spark, input_path, fmt, bad_lines=bad_lines)
        if fmt == "json" and bad_lines == "keep":
            raw, bad = split_bad_lines(materialize(raw, "raw-log"))
            write_parquet(bad, f"{output_path.rstrip('/')}.bad-lines", mode)
        staged = fmt not in ("parquet", "orc")
        return write_parquet(clean(raw, stage=staged), output_path, mode)
