"""churnlens: churn analytics over a user event log, written as Spark DataFrame jobs.

Layers:

* ``sources``   – event-log readers, the test-table adapter, parquet/JSON/model sinks.
* ``functions`` – Column expressions (time parts, flags, user-system extraction).
* ``operators`` – DataFrame -> DataFrame building blocks (cleaning, user features,
  group comparisons, histograms, split and weights, ML stages, metrics, joins).
* ``plans``     – the batch jobs chained from operators (clean, features, train,
  evaluate, compare) and the query registry used by ``__spark_entry__``.
* ``streaming`` – intentionally empty: the event log is processed in batch.
"""

__version__ = "0.1.0"
