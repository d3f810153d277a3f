"""Rollout and support analytics as Spark DataFrame jobs.

Layout:
  functions/  column expressions (dates, ratios, rounding, money, HTML text)
  sources/    table loaders, test-data views, extraction jobs, append log
  operators/  summaries, metrics, causal estimators, data-quality checks
  streaming/  Structured Streaming ingest and roll-ups
  plans/      the named query catalog and its DuckDB oracle SQL
"""

__all__ = ["session"]
