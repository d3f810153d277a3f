"""Data-quality checks (Q1-Q6) as one result shape:
``(check, table_name, column_name, failed, total, ok)``.

Each check is one aggregate per table (several columns at once), turned
into rows with ``unpivot``; checks are combined with ``unionByName``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import money_parse_ok


def _rows(check: str, table: str, counts: DataFrame, total_col: str = "_total") -> DataFrame:
    """One aggregate row with a failure count per column -> one row per column."""
    cols = [c for c in counts.columns if c != total_col]
    long = counts.unpivot([total_col], cols, "column_name", "failed")
    return long.select(F.lit(check).alias("check"), F.lit(table).alias("table_name"),
                       "column_name", F.col("failed").cast("long").alias("failed"),
                       F.col(total_col).cast("long").alias("total"),
                       (F.col("failed") == 0).alias("ok"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _rows("not_null", table, counts)


def unique(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows whose key occurs more than once (a NULL key counts as a key)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_total"),
                         F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)),
                                    F.lit(0)).alias(key))
    return _rows("unique", table, counts)


def in_set(df: DataFrame, table: str, domains: dict[str, list[str]]) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(~F.coalesce(F.col(c).isin(v), F.lit(False))).alias(c)
                      for c, v in domains.items()])
    return _rows("in_set", table, counts)


def in_range(df: DataFrame, table: str, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(~F.coalesce(F.col(c).between(lo, hi), F.lit(False))).alias(c)
                      for c, (lo, hi) in bounds.items()])
    return _rows("in_range", table, counts)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
            table: str) -> DataFrame:
    """Child rows whose key has no parent row (left anti join)."""
    missing = child.select(child_key).join(
        parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")
    n_missing = missing.agg(F.count(F.lit(1))).scalar()
    counts = child.agg(F.count(F.lit(1)).alias("_total")).select("_total", n_missing.alias(child_key))
    return _rows("orphans", table, counts)


def freshness(df: DataFrame, table: str, ts_col: str, as_of: str, period_days: int) -> DataFrame:
    """Fails when the newest row is older than ``as_of - period_days``."""
    newest = df.agg(F.max(F.col(ts_col).cast("date")).alias("m"))
    stale = (F.col("m").isNull() | (F.col("m") < F.date_sub(F.to_date(F.lit(as_of)), period_days)))
    counts = newest.select(F.lit(1).alias("_total"), stale.cast("long").alias(ts_col))
    return _rows("freshness", table, counts)


def outside_calendar(df: DataFrame, table: str, date_col: str, start: str, end: str) -> DataFrame:
    """Rows dated outside the months from ``start`` to ``end`` (or undated):
    a roll-up on that calendar leaves them out."""
    low = F.trunc(F.to_date(F.lit(start)), "month")
    inside = F.col(date_col).between(low, F.last_day(F.to_date(F.lit(end))))
    counts = df.agg(F.count(F.lit(1)).alias("_total"), F.count_if(~F.coalesce(inside, F.lit(False))).alias(date_col))
    return _rows("outside_calendar", table, counts)


def parse_rate(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """Share of texts that fail to parse (hidden by a 0 default downstream)."""
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(~ok).alias(name) for name, ok in checks.items()])
    return _rows("parse_rate", table, counts)


def money_checks(col: str) -> dict[str, Column]:
    return {f"{col}": money_parse_ok(col), f"{col}(compat)": money_parse_ok(col, compat=True)}
