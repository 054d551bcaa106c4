"""Every registered query of the churn part and its SQL."""

from __future__ import annotations

from churnlens.plans import job_queries, model_queries, oracle, registry

QUERIES = {**registry.QUERIES, **job_queries.QUERIES, **model_queries.QUERIES}
ORACLE = {k: v for k, v in oracle.ORACLE.items() if k in registry.QUERIES} | job_queries.SQL | model_queries.SQL
