"""Operators of a training-data pipeline: URL filters, near and line duplicates,
quality rules, mixing, vector search, piece segmentation, language-model
scoring, personal data and sharding. Nothing else in the library imports this
subpackage."""
