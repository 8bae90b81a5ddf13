"""Operators: window features, enrichment, profiling, correlation, split,
evaluation and data checks. Each is ``DataFrame -> DataFrame``."""
