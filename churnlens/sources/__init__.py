"""Readers and writers: event log (JSON/parquet), test-table adapter, sinks."""

from churnlens.sources.event_log import (
    events_as_event_log, events_with_nulls, read_event_log, read_parquet, read_table,
    split_bad_lines,
)
from churnlens.sources.table_sets import publish, published, read_published
from churnlens.sources.sinks import (
    load_model, read_fold_scores, read_metrics, save_model, write_event_log_json, write_fold_scores,
    write_metrics, write_parquet,
)

__all__ = [
    "events_as_event_log", "events_with_nulls", "read_event_log", "read_parquet",
    "publish", "published", "read_published", "read_table", "split_bad_lines", "write_fold_scores",
    "load_model", "read_fold_scores", "read_metrics", "save_model", "write_event_log_json",
    "write_metrics", "write_parquet",
]
