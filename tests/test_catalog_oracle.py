"""Every catalog query against its DuckDB oracle on the smallest scale, and
a few against themselves under different shuffle partition counts."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidewater.plans import catalog
from tidewater.sources.testdata import TABLES

# the catalog alone: the optional corpus operators have tests of their own
QUERIES = {k: q for k, q in entry.queries().items() if k in catalog.CATALOG}
ORACLE = {k: q for k, q in entry.oracle_sql().items() if k in catalog.CATALOG}


def canon(rows):
    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v
    return sorted((tuple(norm(v) for v in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = {"psm_scores", "psm_did", "synth_gap", "synth_placebo", "did_clustered_se",
                 "did_event_time_se", "did_event_time_bootstrap", "match_once", "psm_chain_match", "psm_chain_balance", "psm_chain_did"}
    assert set(QUERIES) - set(ORACLE) == rows_only


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, duck, key):
    sdf = QUERIES[key](spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = canon(tuple(r[c] for c in cols) for r in sdf.collect())
    cur = duck.execute(ORACLE[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = canon(tuple(r[i] for i in idx) for r in cur.fetchall())
    assert srows == drows


@pytest.mark.parametrize("key", ["regional_summary", "roi_3y", "psm_match", "keyword_top10",
                                 "avg_check", "did_cells", "kpi_monthly_full", "support_coverage"])
def test_same_result_under_other_partition_counts(spark, sf_dir, key):
    base = canon(QUERIES[key](spark, sf_dir).collect())
    for n in (1, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            assert canon(QUERIES[key](spark, sf_dir).collect()) == base
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "region_name" in df.columns


def test_flagship_scan_is_pruned_and_filtered(spark, sf_dir):
    plan = QUERIES["regional_summary"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "l_orderkey" in line)
    assert "GreaterThanOrEqual(l_shipdate" in scan
    read = scan[scan.index("ReadSchema: struct<") + len("ReadSchema: struct<"):]
    cols = {c.split(":")[0] for c in read.rstrip(">").split(",")}
    assert cols == {"l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate"}


def _plan(spark, sf_dir, key):
    return QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key,joins", [("row_counts", 0), ("top_k", 1), ("dq_in_set", 1), ("industry_share", 2), ("dq_range", 1)])
def test_only_needed_dimensions_are_joined(spark, sf_dir, key, joins):
    plan = QUERIES[key](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Join") for line in plan.splitlines()) == joins


@pytest.mark.parametrize("key", ["kpi_window", "kpi_cards", "kpi_cards_text"])
def test_window_reaches_the_scan_of_the_monthly_rollup(spark, sf_dir, key):
    assert "GreaterThanOrEqual(l_shipdate" in _plan(spark, sf_dir, key)


@pytest.mark.parametrize("key", ["roi_3y", "payback_month"])
def test_attribution_reads_the_rollouts_once(spark, sf_dir, key):
    scans = [x for x in _plan(spark, sf_dir, key).splitlines() if "FileScan parquet" in x and "l_shipdate" in x]
    assert len(scans) == 1
