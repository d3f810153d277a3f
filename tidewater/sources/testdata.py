"""Loaders for the parquet tables and the two domain views built on them.

``implementations`` and ``support_measures`` re-express the reference's
rollout and support tables over the star-schema test data (mapping in
FIXTURES.md). Both are lazy DataFrames: a query that needs three columns
reads three columns, and date filters on ``date_go_live`` reach the
lineitem scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.columns import money, nan_to_null

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table as a lazy DataFrame (its files are listed anew each
    time, so a rewritten path is never read through an old listing)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nation_region(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    # nation is a fixed 25-row dimension; the planner broadcasts it from its
    # file statistics (autoBroadcastJoinThreshold), so no hint is needed.
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias(f"{prefix}_nationkey"),
        F.col("n_name").alias(f"{prefix}_nation"),
        F.col("n_regionkey").alias(f"{prefix}_regionkey"),
    )


# Session settings naming a materialized rollout fact (see ``write_fact``), one
# per source folder; without one the view is computed from the source tables.
FACT_CONF = "spark.tidewater.implementations.path"


def fact_conf(sf_dir: str) -> str:
    """The setting that names the fact made from ``sf_dir``."""
    return f"{FACT_CONF}.{sf_dir.rstrip('/')}"


def write_fact(spark: SparkSession, sf_dir: str, path: str, partitions: int | None = None) -> None:
    """Materialize the rollout view once for many queries.

    Rows are range-partitioned and sorted by go-live date, so each parquet
    row group covers a narrow date range and the window filters
    (``date_go_live > cutoff``) skip most row groups from their min/max
    statistics. Point ``fact_conf(sf_dir)`` at ``path`` to use it.
    """
    df = _implementations_from_sources(spark, sf_dir, list(VIEW))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, "date_go_live").sortWithinPartitions("date_go_live", "org_id")
       .write.mode("overwrite").parquet(path))


def implementations(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The rollout view, or the given columns of it: from the materialized fact
    of this source if there is one, else computed from the source tables.

    Only dimensions that a column needs are joined (an inner join cannot be
    removed by the optimizer). Rollouts without their order, customer,
    supplier or part are therefore missing only where that dimension is asked
    for; ``dq_orphans`` counts them.
    """
    wanted = list(columns or VIEW)
    path = spark.conf.get(fact_conf(sf_dir), None)
    if path:
        return spark.read.parquet(path).select(*wanted)
    return _implementations_from_sources(spark, sf_dir, wanted)


def _view_columns() -> dict[str, tuple[str, Column]]:
    """Column -> (the dimensions it needs, its expression)."""
    go_live = F.col("l_shipdate").cast("date")
    capex = money("l_extendedprice")
    disc = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    status = (F.when(F.col("o_orderstatus") == "F", "go-live")
              .when(F.col("o_orderstatus") == "O", "pilot_ok")
              .when(F.col("l_linestatus") == "O", "pilot")
              .otherwise("planned"))
    return {
        "impl_key": ("", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                     go_live.cast("string"))),
        "org_id": ("orders", F.col("o_custkey")),
        "org_name": ("orders customer", F.col("c_name")),
        "solution_name": ("part", F.col("p_name")),
        "vendor_name": ("supplier", F.col("s_name")),
        "class_scm": ("part", F.col("p_type")),
        "region_name": ("orders customer cn", F.col("cn_nation")),
        "industry_name": ("orders customer", F.col("c_mktsegment")),
        "date_go_live": ("", go_live),
        "status": ("orders", status),
        "is_domestic": ("orders customer supplier cn sn", F.col("cn_regionkey") == F.col("sn_regionkey")),
        "capex": ("", capex),
        "revenue_uplift": ("", capex * (F.lit(1) - disc)),
        "opex_delta": ("", (capex * tax).cast("decimal(18,4)")),
        "inv_turnover_delta": ("", nan_to_null(F.col("l_quantity") / F.lit(25.0))),
        "lead_time_delta": ("orders", F.datediff("l_shipdate", "o_orderdate").cast("long")),
        "penalties_delta": ("", (capex * disc).cast("decimal(18,4)")),
    }


VIEW = ("impl_key", "org_id", "org_name", "solution_name", "vendor_name", "class_scm", "region_name", "industry_name",
        "date_go_live", "status", "is_domestic", "capex", "revenue_uplift", "opex_delta", "inv_turnover_delta",
        "lead_time_delta", "penalties_delta")


def _implementations_from_sources(spark: SparkSession, sf_dir: str, wanted: list[str]) -> DataFrame:
    """One row per rollout (a lineitem), with the wanted columns.

    The fact joins each dimension as a plain scan, nation last. The planner
    then decides broadcast vs sort-merge per dimension from that scan's own
    size (autoBroadcastJoinThreshold, re-checked at runtime by AQE): small
    dimensions are broadcast, large ones (orders, part, customer at scale)
    are shuffled on their keys. Joining customer to nation first would make
    the optimizer multiply their sizes and shuffle even tiny dimensions.
    """
    columns = _view_columns()
    needed = {d for c in wanted for d in columns[c][0].split()}
    j = table(spark, sf_dir, "lineitem")
    dimensions = [
        ("orders", "l_orderkey", "o_orderkey", lambda: table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")),
        ("customer", "o_custkey", "c_custkey", lambda: table(spark, sf_dir, "customer").select(
            "c_custkey", "c_name", "c_nationkey", "c_mktsegment")),
        ("supplier", "l_suppkey", "s_suppkey", lambda: table(spark, sf_dir, "supplier").select(
            "s_suppkey", "s_name", "s_nationkey")),
        ("part", "l_partkey", "p_partkey", lambda: table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")),
        ("cn", "c_nationkey", "cn_nationkey", lambda: _nation_region(spark, sf_dir, "cn")),
        ("sn", "s_nationkey", "sn_nationkey", lambda: _nation_region(spark, sf_dir, "sn")),
    ]
    for name, fk, pk, scan in dimensions:
        if name in needed:
            j = j.join(scan(), F.col(fk) == F.col(pk))
    return j.select(*[columns[c][1].alias(c) for c in wanted])


def org_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(org_id, industry_name, region_name) as the rollout view has them."""
    return table(spark, sf_dir, "customer").join(_nation_region(spark, sf_dir, "cn"), F.col("c_nationkey") == F.col("cn_nationkey")).select(
        F.col("c_custkey").alias("org_id"), F.col("c_mktsegment").alias("industry_name"), F.col("cn_nation").alias("region_name"))


# Measure types by k % 4, and the approval-date spreading rule.
MEASURE_TYPES = ["subsidy", "grant", "tax_benefit", "state_order"]
APPROVAL_EPOCH = "1995-01-01"
APPROVAL_STEP = 37
APPROVAL_SPAN_DAYS = 2400


def support_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per support grant, from ``events`` (FIXTURES.md mapping)."""
    # k is a column of its own, so that each event's JSON is parsed once
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "user_id", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    k = F.col("k")
    base = F.to_date(F.lit(APPROVAL_EPOCH))
    offset = (F.col("event_id") * APPROVAL_STEP % APPROVAL_SPAN_DAYS).cast("int")
    mt = (F.when(k % 4 == 0, MEASURE_TYPES[0]).when(k % 4 == 1, MEASURE_TYPES[1])
          .when(k % 4 == 2, MEASURE_TYPES[2]).otherwise(MEASURE_TYPES[3]))
    return ev.select(
        F.col("event_id").alias("support_id"),
        F.col("event_type").alias("program_name"),
        mt.alias("measure_type"),
        F.col("user_id").alias("recipient_id"),
        money("value").alias("amount_rub"),
        F.date_add(base, offset).alias("approval_date"),
        F.date_add(base, offset + k).alias("disbursement_date"),
        nan_to_null(k.cast("double")).alias("roi_pct"),
    )
