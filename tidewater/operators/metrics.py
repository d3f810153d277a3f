"""Declared metrics (README formulas) as Spark jobs.

Shape rules used throughout:
  * grand totals are scalar subqueries (``DataFrame.scalar()``), evaluated
    once, never a window over the whole table;
  * the as-of attribution of rollouts to grants works on the distinct
    (org, date) pairs, so no org ever produces grant x rollout pairs and a
    hot org's work is bounded by its number of distinct dates;
  * small per-group tables are broadcast only when their size is bounded by
    construction (calendar months, a fixed list).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.functions.columns import guarded_pct, month_end, round_half_even
from tidewater.operators.summaries import on_calendar, sum0, sum_flag


def effect_col():
    """Economic effect of a rollout (reference: revenue_uplift + opex_delta)."""
    return F.col("revenue_uplift") + F.col("opex_delta")


# -- M2 --------------------------------------------------------------------------------

def domestic_share(impl: DataFrame, by: list[str]) -> DataFrame:
    """installs_domestic / installs_all * 100 for each cut in ``by``."""
    return (impl.groupBy(*by)
            .agg(F.count(F.lit(1)).cast("long").alias("installs_all"),
                 sum_flag("is_domestic").alias("installs_domestic"))
            .withColumn("domestic_share_pct", guarded_pct("installs_domestic", "installs_all")))


# -- M3 --------------------------------------------------------------------------------

def first_support(support: DataFrame) -> DataFrame:
    """Earliest approval per recipient org (one row per org)."""
    return (support.groupBy(F.col("recipient_id").alias("org_id"))
            .agg(F.min("approval_date").alias("first_approval")))


def with_support_flag(impl: DataFrame, support: DataFrame) -> DataFrame:
    """Adds ``has_support``: the org had a grant approved on or before go-live.

    A left join of the rollouts (large) with one row per org; AQE splits a
    hot org's partition on the large side if it is skewed.
    """
    fs = first_support(support)
    return (impl.join(fs, "org_id", "left")
            .withColumn("has_support", F.coalesce(F.col("first_approval") <= F.col("date_go_live"),
                                                  F.lit(False))))


def support_coverage(impl: DataFrame, support: DataFrame, by: list[str]) -> DataFrame:
    flagged = with_support_flag(impl, support)
    return (flagged.groupBy(*by)
            .agg(F.count(F.lit(1)).cast("long").alias("impl_all"),
                 sum_flag("has_support").alias("impl_with_support"))
            .withColumn("support_coverage_pct", guarded_pct("impl_with_support", "impl_all")))


# -- M4 / M6 / M12: as-of attribution of rollouts to grants -----------------------------

def _grants_by_day(support: DataFrame) -> DataFrame:
    """One grant per (org, approval date): the smallest id wins."""
    return (support.groupBy(F.col("recipient_id").alias("org_id"), F.col("approval_date").alias("d"))
            .agg(F.min_by(F.struct("support_id", "program_name", "approval_date"), "support_id")
                 .alias("grant")))


def _carried(rows: DataFrame, support: DataFrame, value: str) -> DataFrame:
    """``rows`` (org_id, d and a struct ``value``) with the org's latest grant
    approved on or before d.

    Rows and grants are laid end to end and the last grant seen so far is
    carried forward per org in date order (grants first on a day), so the rows
    are read once and no org produces rows x grants pairs.
    """
    grants = _grants_by_day(support)
    laid = rows.select("org_id", "d", value, F.lit(None).cast(grants.schema["grant"].dataType).alias("grant")).unionByName(
        grants.select("org_id", "d", F.lit(None).cast(rows.schema[value].dataType).alias(value), "grant"))
    w = (Window.partitionBy("org_id").orderBy("d", F.col("grant").isNull())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (laid.withColumn("asof", F.last("grant", ignorenulls=True).over(w))
            .filter(F.col(value).isNotNull()).drop("grant"))


def asof_grants(keys: DataFrame, support: DataFrame) -> DataFrame:
    """For each distinct (org_id, date_go_live) in ``keys``: the org's latest
    grant approved on or before that date (ties: smallest support_id)."""
    dates = keys.select("org_id", F.col("date_go_live").alias("d")).distinct()
    found = _carried(dates.withColumn("key", F.struct("d")), support, "key")
    return found.select("org_id", F.col("d").alias("date_go_live"), "asof.support_id", "asof.program_name",
                        "asof.approval_date")


def _in_time(horizon_months: int):
    return F.col("date_go_live") <= F.add_months("approval_date", horizon_months)


def attributed(impl: DataFrame, support: DataFrame, horizon_months: int) -> DataFrame:
    """Rollouts attributed to the org's latest earlier grant within the horizon."""
    rows = impl.select("impl_key", "org_id", "date_go_live", effect_col().alias("effect"))
    asof = asof_grants(rows, support).filter(F.col("support_id").isNotNull())
    return rows.join(asof, ["org_id", "date_go_live"]).filter(_in_time(horizon_months))


def attributed_daily(impl: DataFrame, support: DataFrame, horizon_months: int) -> DataFrame:
    """As ``attributed``, on rollouts pre-aggregated per (org, date): all
    rollouts of an org on one day share their grant, so effect sum and count
    per (org, date) are attributed as one row. The pre-aggregation combines
    map-side (a hot org shrinks before the shuffle), and a window partition
    holds at most one row and one grant per day of an org."""
    daily = (impl.groupBy("org_id", F.col("date_go_live").alias("d"))
             .agg(sum0(effect_col()).alias("effect"), F.count(F.lit(1)).cast("long").alias("n")))
    found = _carried(daily.select("org_id", "d", F.struct("effect", "n").alias("day")), support, "day")
    return (found.filter(F.col("asof").isNotNull())
            .select("org_id", F.col("d").alias("date_go_live"), "day.effect", "day.n", "asof.support_id",
                    "asof.program_name", "asof.approval_date")
            .filter(_in_time(horizon_months)))


def roi_by_program(impl: DataFrame, support: DataFrame, horizon_months: int) -> DataFrame:
    """(sum of attributed effects - grant cost) / grant cost * 100 per program.

    Grant cost counts every grant of the program, also those that attract no
    rollout.
    """
    eff = (attributed_daily(impl, support, horizon_months).groupBy("program_name")
           .agg(sum0("effect").alias("effect_total"),
                F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_attributed")))
    cost = support.groupBy("program_name").agg(sum0("amount_rub").alias("grant_total"))
    out = cost.join(eff, "program_name", "left")
    e = F.coalesce(F.col("effect_total"), F.lit(0)).cast("double")
    c = F.col("grant_total").cast("double")
    return out.select(
        "program_name",
        c.alias("grant_total"),
        e.alias("effect_total"),
        F.coalesce("n_attributed", F.lit(0)).cast("long").alias("n_attributed"),
        F.when(c != 0, (e - c) / c * 100.0).alias("roi_pct"))


def payback_month(impl: DataFrame, support: DataFrame, horizon_months: int) -> DataFrame:
    """First month in which a program's cumulative attributed effect reaches its
    grant total (NULL if never). The running sum is per program over months."""
    monthly = (attributed_daily(impl, support, horizon_months)
               .groupBy("program_name", month_end("date_go_live").alias("date_month"))
               .agg(sum0("effect").alias("effect")))
    w = (Window.partitionBy("program_name").orderBy("date_month")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = monthly.withColumn("cum_effect", F.sum("effect").over(w))
    cost = support.groupBy("program_name").agg(sum0("amount_rub").alias("grant_total"))
    reached = (cum.join(cost, "program_name")
               .filter(F.col("cum_effect") >= F.col("grant_total"))
               .groupBy("program_name").agg(F.min("date_month").alias("payback_month")))
    return (cost.join(reached, "program_name", "left")
            .select("program_name", F.col("grant_total").cast("double").alias("grant_total"),
                    "payback_month"))


# -- M5 --------------------------------------------------------------------------------

def isi_components(impl: DataFrame, by: list[str]) -> DataFrame:
    """Inputs of the import-substitution index per cut.

    domestic_share: share of domestic rollouts; local_components: domestic
    share of capex (stand-in); rd_share: share of rollouts in status
    ``pilot`` (stand-in). All in percent.
    """
    dom_capex = F.when(F.col("is_domestic"), F.col("capex")).otherwise(F.lit(0))
    raw = ["n", "n_domestic", "capex_all", "capex_domestic", "n_pilot"]
    agg = (impl.groupBy(*by)
           .agg(F.count(F.lit(1)).cast("long").alias("n"),
                sum_flag("is_domestic").alias("n_domestic"),
                sum0("capex").alias("capex_all"),
                sum0(dom_capex).alias("capex_domestic"),
                F.count_if(F.col("status") == "pilot").cast("long").alias("n_pilot")))
    keys = [c for c in agg.columns if c not in raw]
    return agg.select(*keys,
                      guarded_pct("n_domestic", "n").alias("domestic_share"),
                      guarded_pct("capex_domestic", "capex_all").alias("local_components"),
                      guarded_pct("n_pilot", "n").alias("rd_share"))


def isi_index(components: DataFrame, weights: tuple[float, float, float]) -> DataFrame:
    w1, w2, w3 = weights
    return components.withColumn(
        "isi_index",
        F.col("domestic_share") * w1 + F.col("local_components") * w2 + F.col("rd_share") * w3)


# -- M7 / M8 / M9 / M11 -------------------------------------------------------------------

def domestic_cube(impl: DataFrame, dims: list[str]) -> DataFrame:
    """Domestic share on every combination of ``dims`` (CUBE + grouping_id)."""
    return (impl.cube(*dims)
            .agg(F.grouping_id(*dims).cast("long").alias("gid"),
                 F.count(F.lit(1)).cast("long").alias("impl_count"),
                 sum_flag("is_domestic").alias("domestic_count"))
            .withColumn("domestic_share",
                        round_half_even(guarded_pct("domestic_count", "impl_count"), 1)))


def region_heatmap(impl: DataFrame) -> DataFrame:
    """Region x quarter counts; the pivot values are the fixed list 1..4, so no
    extra job discovers them."""
    p = (impl.filter(F.col("region_name").isNotNull())
         .withColumn("q", F.quarter("date_go_live"))
         .groupBy("region_name").pivot("q", [1, 2, 3, 4]).count())
    return p.select("region_name", *[F.coalesce(F.col(str(i)), F.lit(0)).cast("long").alias(f"q{i}")
                                     for i in range(1, 5)])


def vendor_share(impl: DataFrame) -> DataFrame:
    """Vendor market share by count and by capex.

    The totals are scalar subqueries over the grouped per-vendor result (one
    row per vendor), not over the rollouts, so the rollouts are read once."""
    by_vendor = (impl.filter(F.col("vendor_name").isNotNull()).groupBy("vendor_name")
                 .agg(F.count(F.lit(1)).cast("long").alias("impl_count"),
                      sum0("capex").alias("capex_total")))
    tot_n = by_vendor.agg(F.sum("impl_count")).scalar()
    tot_c = by_vendor.agg(F.sum("capex_total")).scalar()
    return by_vendor.select(
        "vendor_name", "impl_count",
        F.col("capex_total").cast("double").alias("capex_total"),
        guarded_pct(F.col("impl_count"), tot_n).alias("share_count_pct"),
        guarded_pct(F.col("capex_total"), tot_c).alias("share_capex_pct"))


def hot_segments(impl: DataFrame, as_of: str, days: int, min_volume: int, k: int) -> DataFrame:
    """class x industry: rollouts in (as_of - days, as_of] vs the ``days`` before;
    segments with at least ``min_volume`` in the current period, top k by
    growth (ties by volume, then key). A segment without earlier rollouts has
    no growth figure and ranks before all others: it is the hottest."""
    d = F.col("date_go_live")
    end = F.to_date(F.lit(as_of))
    cur = (d > F.date_sub(end, days)) & (d <= end)
    prev = (d > F.date_sub(end, 2 * days)) & (d <= F.date_sub(end, days))
    seg = (impl.filter(d > F.date_sub(end, 2 * days)).filter(d <= end)
           .groupBy("class_scm", "industry_name")
           .agg(F.count_if(cur).cast("long").alias("n_current"),
                F.count_if(prev).cast("long").alias("n_previous")))
    growth = F.when(F.col("n_previous") > 0,
                    (F.col("n_current") - F.col("n_previous")).cast("double") / F.col("n_previous"))
    return (seg.filter(F.col("n_current") >= min_volume)
            .withColumn("growth", growth)
            .orderBy(F.col("growth").desc_nulls_first(), F.desc("n_current"), "class_scm", "industry_name")
            .limit(k))


# -- M13 / M14 / M15 ----------------------------------------------------------------------

def whatif_budget(roi: DataFrame, multipliers: list[float]) -> DataFrame:
    """Budget scenarios per program: budget = grant_total * m; implied rollouts
    = budget / cost_per_impl, cost_per_impl = grant_total / attributed.

    The scenarios are an array literal exploded per program row: no join.
    """
    cost_per_impl = F.when(F.col("n_attributed") > 0, F.col("grant_total") / F.col("n_attributed"))
    return (roi.select("program_name", "grant_total", "n_attributed", "roi_pct",
                       cost_per_impl.alias("cost_per_impl"),
                       F.explode(F.array(*[F.lit(float(m)) for m in multipliers])).alias("multiplier"))
            .withColumn("budget", F.col("grant_total") * F.col("multiplier"))
            .withColumn("implied_impls",
                        F.when(F.col("cost_per_impl") > 0, F.col("budget") / F.col("cost_per_impl"))))


def star_fact(impl: DataFrame) -> DataFrame:
    """Fact rows with natural dimension keys and a month key."""
    return impl.select(
        "impl_key", "org_id", "vendor_name", "solution_name", "class_scm", "region_name",
        "industry_name", "status", month_end("date_go_live").alias("date_month"), "date_go_live",
        "is_domestic", F.col("capex").cast("double").alias("capex"),
        effect_col().cast("double").alias("econ_effect"))


def star_dims(impl: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_vendor": impl.select("vendor_name").distinct(),
        "dim_solution": impl.select("solution_name", "vendor_name", "class_scm").distinct(),
        "dim_region": impl.select("region_name").distinct(),
        "dim_industry": impl.select("industry_name").distinct(),
        "dim_org": impl.select("org_id", "org_name", "region_name", "industry_name").distinct(),
    }


def support_monthly(spark: SparkSession, support: DataFrame, start: str, end: str) -> DataFrame:
    monthly = (support.groupBy(month_end("approval_date").alias("date_month"))
               .agg(F.count(F.lit(1)).cast("long").alias("support_count"),
                    sum0("amount_rub").cast("double").alias("total_support_amount")))
    return on_calendar(spark, monthly, start, end, ["support_count", "total_support_amount"])


def kpi_monthly_full(spark: SparkSession, kpi: DataFrame, impl: DataFrame, support: DataFrame,
                     start: str, end: str, weights: tuple[float, float, float]) -> DataFrame:
    """The 12 columns of the reference's kpi_monthly, all computed.

    Coverage and ISI inputs come from one grouped pass over the rollouts
    (joined once to each org's first approval) instead of one pass per
    metric; every monthly table has at most one row per calendar month, so
    the joins on ``date_month`` are between month-sized tables. ``kpi`` (the
    A1 columns) is re-derived in the same pass when its columns allow.
    """
    flagged = with_support_flag(impl, support)
    dom_capex = F.when(F.col("is_domestic"), F.col("capex")).otherwise(F.lit(0))
    monthly = (flagged.groupBy(month_end("date_go_live").alias("date_month"))
               .agg(F.count(F.lit(1)).cast("long").alias("impl_count"),
                    sum_flag("is_domestic").alias("domestic_impl_count"),
                    sum0(effect_col()).cast("double").alias("total_econ_effect"),
                    sum_flag("has_support").alias("impl_with_support"),
                    sum0("capex").alias("capex_all"),
                    sum0(dom_capex).alias("capex_domestic"),
                    F.count_if(F.col("status") == "pilot").cast("long").alias("n_pilot")))
    zero = ["impl_count", "domestic_impl_count", "total_econ_effect", "impl_with_support",
            "capex_all", "capex_domestic", "n_pilot"]
    cal = on_calendar(spark, monthly, start, end, zero)
    w1, w2, w3 = weights
    isi = (guarded_pct("domestic_impl_count", "impl_count") * w1
           + guarded_pct("capex_domestic", "capex_all") * w2
           + guarded_pct("n_pilot", "impl_count") * w3)
    full = cal.select(
        "date_month",
        F.year("date_month").cast("long").alias("year"),
        F.quarter("date_month").cast("long").alias("quarter"),
        "impl_count", "domestic_impl_count",
        guarded_pct("domestic_impl_count", "impl_count").alias("domestic_share_pct"),
        "total_econ_effect",
        F.when(F.col("impl_count") > 0, F.col("total_econ_effect") / F.col("impl_count"))
        .otherwise(F.lit(0.0)).alias("avg_econ_effect"),
        guarded_pct("impl_with_support", "impl_count").alias("support_coverage_pct"),
        F.when(F.col("impl_count") > 0, isi).otherwise(F.lit(0.0)).alias("isi_index"))
    sm = support_monthly(spark, support, start, end)
    return full.join(sm, "date_month").select(
        *kpi.columns, "support_count", "total_support_amount", "support_coverage_pct", "isi_index")


# -- M10: average check with an exact, skew-safe median ------------------------------------------

QUANTILE_BINS = 256


def exact_quantile(df: DataFrame, group: str, value: str, p: float) -> DataFrame:
    """Exact linear-interpolated quantile per group (``quantile_cont``) by
    counting, without a sort and without gathering any group's values.

    Each group has a bracket of values that holds the wanted rank. In a round
    the values in the bracket are counted in 256 bins; the bin that holds the
    rank becomes the bracket, from its least to its greatest value. Counts are
    combined before the shuffle, so only they move and a group (or one value)
    with a third of the rows is counted by all tasks; a bracket of one value is
    done, however often that occurs. The brackets (a row per group) are joined
    by whatever way their size asks for. Rows are written once and read per
    round (about log256 of the range over the spacing). Null and NaN values and
    null groups are left out.
    """
    from tidewater.session import materialize

    rows = materialize(df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).filter(
        "g is not null and v is not null and not isnan(v)"), "quantile-rows")
    pos = (F.col("n") - 1).cast("double") * p
    whole = materialize(rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).select(
        "g", F.floor(pos).cast("long").alias("lo"), F.ceil(pos).cast("long").alias("hi"), (pos - F.floor(pos)).alias("frac"),
        F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), "a", "b"), "quantile-bracket")
    done, open_ = whole.filter("a = b"), whole.filter("a < b")
    while not open_.isEmpty():
        bins = F.least(F.floor((F.col("v") - F.col("a")) / (F.col("b") - F.col("a")) * QUANTILE_BINS), F.lit(QUANTILE_BINS - 1))
        counts = rows.join(open_.select("g", "a", "b"), "g").filter("v between a and b").groupBy("g", bins.alias("bin")).agg(
            F.count("*").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        before = Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        found = counts.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0))).join(open_, "g").filter(
            "lo >= below + before and lo < below + before + c")
        narrowed = materialize(found.select(
            "g", "lo", "hi", "frac", (F.col("below") + F.col("before")).alias("below"), F.col("c").alias("inside"),
            F.col("least").alias("a"), F.col("most").alias("b")), "quantile-bracket")
        done, open_ = done.unionByName(narrowed.filter("a = b")), narrowed.filter("a < b")
    done = materialize(done, "quantile-found")
    # The upper of the two ranks: the same value where it occurs often enough.
    beyond = done.filter("hi >= below + inside").select("g", "a")
    upper = rows.join(beyond, "g").filter("v > a").groupBy("g").agg(F.min("v").alias("next"))
    return done.join(upper, "g", "left").select(
        F.col("g").alias(group), (F.col("a") + (F.coalesce("next", "a") - F.col("a")) * F.col("frac")).alias("q"))


def avg_check(impl: DataFrame, by: str = "vendor_name", approx: bool = False) -> DataFrame:
    """Average and median capex per vendor (or class). ``approx=True`` uses a
    bounded-memory sketch (``percentile_approx``) instead of the exact
    median."""
    base = (impl.filter(F.col(by).isNotNull()).groupBy(by)
            .agg(F.count(F.lit(1)).cast("long").alias("impl_count"),
                 (F.sum("capex").cast("double") / F.count(F.lit(1))).alias("avg_capex")))
    if approx:
        med = impl.groupBy(by).agg(F.percentile_approx(F.col("capex").cast("double"), 0.5, 10000)
                                   .alias("median_capex"))
    else:
        med = exact_quantile(impl, by, "capex", 0.5).withColumnRenamed("q", "median_capex")
    return base.join(med, by, "left")
