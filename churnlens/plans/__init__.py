"""Batch jobs chained from operators, and the query registry."""
