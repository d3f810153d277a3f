"""Window scans, grouped summaries, the monthly roll-up and KPI cards.

Null rules follow the reference's pandas group-bys: a null group key is
dropped, ``sum`` of nothing is 0, ``mean`` of nothing stays NULL, and
percentages with a zero denominator are 0.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.functions.columns import (days_before, guarded_pct, month_end, quarter_of,
                                         round_half_even, year_of)


# -- F1 / F2 / F3 / F4: scans -----------------------------------------------------

def recent(df: DataFrame, date_col: str, as_of: str, months_back: int = 12) -> DataFrame:
    """Rows whose date is strictly after ``as_of - 30 * months_back`` days.

    Strict: the reference compares a datetime string with a date string, so
    a row on the cutoff day itself falls out.
    """
    return df.filter(F.col(date_col) > days_before(as_of, 30 * months_back))


def window_start(as_of: str, months_back: int = 12) -> str:
    """First day of the first month whose end lies in ``recent``'s window."""
    first = date.fromisoformat(as_of) - timedelta(days=30 * months_back - 1)
    return first.replace(day=1).isoformat()


def since(df: DataFrame, date_col: str, start: str) -> DataFrame:
    return df.filter(F.col(date_col) >= F.to_date(F.lit(start)))


def count_rows(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(label).alias("dataset"), "n_rows")


# -- A2 / A3 / A4 / A8: grouped summary + top-k ---------------------------------------

def summary(df: DataFrame, key: str, measures: dict[str, Column], order_by: str,
            k: int | None = 10, derived: dict[str, Column] | None = None) -> DataFrame:
    """``groupBy(key).agg(measures)`` with pandas null rules, then the top k.

    Ties at the cut are broken by the key ascending, so the result is
    deterministic. The plan is partial aggregate -> exchange on key -> final
    aggregate -> TakeOrderedAndProject (no global sort of the groups).
    """
    out = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[m.alias(n) for n, m in measures.items()])
    for n, c in (derived or {}).items():
        out = out.withColumn(n, c)
    out = out.orderBy(F.col(order_by).desc(), F.col(key).asc())
    return out.limit(k) if k else out


def count_of(c: str) -> Column:
    return F.count(c).cast("long")


def sum0(c: Column | str) -> Column:
    """pandas ``sum``: 0 for a group of only nulls."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(c), F.lit(0))


def sum_flag(c: str) -> Column:
    return F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).cast("long")


def regional_summary(impl: DataFrame, k: int = 10) -> DataFrame:
    return summary(
        impl, "region_name",
        {"impl_count": count_of("impl_key"),
         "domestic_count": sum_flag("is_domestic"),
         "capex_total": sum0("capex").cast("double")},
        order_by="impl_count", k=k,
        derived={"domestic_share": round_half_even(guarded_pct("domestic_count", "impl_count"), 1)})


def industry_summary(impl: DataFrame, k: int = 10) -> DataFrame:
    return summary(
        impl, "industry_name",
        {"impl_count": count_of("impl_key"),
         "domestic_count": sum_flag("is_domestic"),
         "capex_total": sum0("capex").cast("double"),
         "revenue_uplift_total": sum0("revenue_uplift").cast("double")},
        order_by="impl_count", k=k,
        derived={"domestic_share": round_half_even(guarded_pct("domestic_count", "impl_count"), 1)})


def industry_share(impl: DataFrame, k: int = 10) -> DataFrame:
    """Pie slices: each of the top-k industries as a share of the top-k total
    (the chart normalises what it is given, after the cut)."""
    top = summary(impl, "industry_name", {"impl_count": count_of("impl_key")}, order_by="impl_count", k=k)
    # ``top`` has at most k rows, so the empty-partition window is k rows wide.
    total = F.sum("impl_count").over(Window.partitionBy())
    return top.select("industry_name", "impl_count",
                      guarded_pct(F.col("impl_count"), total).alias("share_pct"))


def program_summary(support: DataFrame, k: int = 10) -> DataFrame:
    return summary(
        support, "program_name",
        {"support_count": count_of("support_id"),
         "amount_total": sum0("amount_rub").cast("double"),
         "roi_mean": F.avg("roi_pct")},
        order_by="amount_total", k=k)


def top_k(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Most frequent values of ``key`` (generic A8)."""
    return summary(df, key, {"n": F.count(F.lit(1)).cast("long")}, order_by="n", k=k)


# -- A1: monthly roll-up on a complete calendar ------------------------------------

def month_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per month-end from ``start`` to ``end`` (both inclusive by month).

    Its size is fixed by the two parameters, not by the data.
    """
    return (spark.range(1)
            .select(F.explode(F.sequence(F.trunc(F.to_date(F.lit(start)), "month"),
                                         F.trunc(F.to_date(F.lit(end)), "month"),
                                         F.expr("interval 1 month"))).alias("m"))
            .select(F.last_day("m").alias("date_month")))


def on_calendar(spark: SparkSession, monthly: DataFrame, start: str, end: str,
                zero_cols: list[str]) -> DataFrame:
    """Left-join per-month aggregates onto the calendar; missing months get 0.

    ``monthly`` is first cut to the calendar's range, so it holds at most one
    row per calendar month: a proven bound, which makes the broadcast safe.
    """
    cal = month_calendar(spark, start, end)
    lo = F.last_day(F.to_date(F.lit(start)))
    hi = F.last_day(F.to_date(F.lit(end)))
    bounded = monthly.filter((F.col("date_month") >= lo) & (F.col("date_month") <= hi))
    out = cal.join(F.broadcast(bounded), "date_month", "left")
    return out.fillna(0, subset=zero_cols)


def kpi_monthly(spark: SparkSession, impl: DataFrame, start: str, end: str,
                statuses: list[str] | None = None) -> DataFrame:
    """Per month-end: year, quarter, count, domestic count and share, total and
    average effect (revenue_uplift + opex_delta). ``statuses=None`` counts
    every status, as the reference's loop does; a list restricts it."""
    src = impl if statuses is None else impl.filter(F.col("status").isin(statuses))
    monthly = (src.groupBy(month_end("date_go_live").alias("date_month"))
               .agg(F.count(F.lit(1)).cast("long").alias("impl_count"),
                    sum_flag("is_domestic").alias("domestic_impl_count"),
                    sum0(F.col("revenue_uplift") + F.col("opex_delta")).cast("double")
                    .alias("total_econ_effect")))
    cal = on_calendar(spark, monthly, start, end,
                      ["impl_count", "domestic_impl_count", "total_econ_effect"])
    return cal.select(
        "date_month",
        year_of("date_month").alias("year"),
        quarter_of("date_month").alias("quarter"),
        "impl_count", "domestic_impl_count",
        guarded_pct("domestic_impl_count", "impl_count").alias("domestic_share_pct"),
        "total_econ_effect",
        F.when(F.col("impl_count") > 0, F.col("total_econ_effect") / F.col("impl_count"))
        .otherwise(F.lit(0.0)).alias("avg_econ_effect"),
    )


def trend_series(kpi: DataFrame) -> DataFrame:
    """The two line charts' inputs, month order."""
    return kpi.select("date_month", "impl_count", "domestic_share_pct").orderBy("date_month")


# -- A5: KPI cards -------------------------------------------------------------------

def kpi_cards(kpi: DataFrame) -> DataFrame:
    """One row of card values over the months in ``kpi``.

    ``impl_total_window`` is what the reference labels "YTD": the sum over
    the selected window. "Last" means the latest month (``max_by``, no sort).
    The global aggregate of an empty input is one row of NULLs, so the card
    row is dropped when there is no month at all.
    """
    last = lambda c: F.max_by(c, "date_month")
    cols = [F.count(F.lit(1)).cast("long").alias("n_months"),
            sum0("impl_count").cast("long").alias("impl_total_window"),
            last("impl_count").alias("impl_last_month"),
            last("domestic_share_pct").alias("domestic_share_last"),
            F.avg("domestic_share_pct").alias("domestic_share_mean"),
            last("total_econ_effect").alias("econ_effect_last")]
    if "support_coverage_pct" in kpi.columns:
        cols += [last("support_coverage_pct").alias("support_coverage_last"),
                 last("support_count").alias("support_count_last")]
    out = kpi.agg(*cols).filter(F.col("n_months") > 0)
    return out.withColumn("domestic_share_gap",
                          F.col("domestic_share_last") - F.col("domestic_share_mean"))


# -- F11: card text ------------------------------------------------------------------

# The texts the cards print after their numbers.
CARD_PER_MONTH = " за месяц"
CARD_VS_MEAN = "% vs среднее"
CARD_EFFECT = " ₽ эффект"
CARD_MEASURES = " мер поддержки"


def kpi_cards_text(cards: DataFrame) -> DataFrame:
    """The cards as the page prints them: thousands separators without
    decimals, one decimal with a percent sign, a '+' before the month's
    count."""
    from tidewater.functions.columns import one_decimal, thousands

    return cards.select(
        thousands("impl_total_window").alias("impl_total_text"),
        F.concat(F.lit("+"), thousands("impl_last_month"), F.lit(CARD_PER_MONTH)).alias("impl_delta_text"),
        F.concat(one_decimal("domestic_share_last"), F.lit("%")).alias("domestic_share_text"),
        F.concat(one_decimal("domestic_share_gap"), F.lit(CARD_VS_MEAN)).alias("domestic_gap_text"),
        F.concat(thousands("econ_effect_last"), F.lit(CARD_EFFECT)).alias("effect_text"),
        F.concat(one_decimal("support_coverage_last"), F.lit("%")).alias("coverage_text"),
        F.concat(thousands("support_count_last"), F.lit(CARD_MEASURES)).alias("support_text"),
    )
