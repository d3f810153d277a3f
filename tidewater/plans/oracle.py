"""DuckDB SQL equivalents of the catalog queries (the correctness oracle).

Each string runs on the 14 pre-registered test tables. The two domain views
are inlined as CTEs; they differ from the Spark side only in the date
difference and JSON access tokens (FIXTURES.md).
"""

from __future__ import annotations

from tidewater.plans import params as P

IMPL = """
impl as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   cast(cast(l_shipdate as date) as varchar)) impl_key,
         o_custkey org_id, c_name org_name, p_name solution_name, s_name vendor_name,
         p_type class_scm, cn.n_name region_name, c_mktsegment industry_name,
         cast(l_shipdate as date) date_go_live,
         case when o_orderstatus = 'F' then 'go-live' when o_orderstatus = 'O' then 'pilot_ok'
              when l_linestatus = 'O' then 'pilot' else 'planned' end status,
         (cn.n_regionkey = sn.n_regionkey) is_domestic,
         cast(l_extendedprice as decimal(12,2)) capex,
         cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) revenue_uplift,
         cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) opex_delta,
         l_quantity / 25.0 inv_turnover_delta,
         date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) lead_time_delta,
         cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)) penalties_delta
  from lineitem join orders on l_orderkey = o_orderkey
                join customer on o_custkey = c_custkey
                join nation cn on c_nationkey = cn.n_nationkey
                join supplier on l_suppkey = s_suppkey
                join nation sn on s_nationkey = sn.n_nationkey
                join part on l_partkey = p_partkey
)"""

SUPPORT = """
support as (
  select event_id support_id, event_type program_name,
         case k % 4 when 0 then 'subsidy' when 1 then 'grant' when 2 then 'tax_benefit'
              else 'state_order' end measure_type,
         user_id recipient_id, cast(value as decimal(12,2)) amount_rub,
         date '1995-01-01' + cast(event_id * 37 % 2400 as int) approval_date,
         date '1995-01-01' + cast(event_id * 37 % 2400 + k as int) disbursement_date,
         cast(k as double) roi_pct
  from (select *, cast(json_extract_string(props, '$.k') as int) k from events) e
)"""


def cal(start: str = P.CAL_START, end: str = P.CAL_END) -> str:
    return f"""
cal as (
  select last_day(cast(m as date)) date_month
  from generate_series(date_trunc('month', date '{start}'), date_trunc('month', date '{end}'),
                       interval 1 month) t(m)
)"""


def recent_impl(as_of: str = P.AS_OF, months: int = P.MONTHS_BACK) -> str:
    return f"""
recent_impl as (select * from impl where date_go_live > date '{as_of}' - {30 * months})"""


def pct(num: str, den: str) -> str:
    return f"case when {den} > 0 then cast({num} as double) / cast({den} as double) * 100.0 else 0.0 end"


def r1(x: str) -> str:
    return f"round_even(({x}) * 10.0, 0) / 10.0"


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


def kpi_monthly_sql(statuses: list[str] | None = None) -> str:
    where = "" if statuses is None else "where status in (" + ",".join(f"'{s}'" for s in statuses) + ")"
    return f"""
monthly as (
  select last_day(date_go_live) date_month, count(*) impl_count,
         coalesce(sum(cast(is_domestic as bigint)), 0) domestic_impl_count,
         coalesce(sum(revenue_uplift + opex_delta), 0) total_econ_effect
  from impl {where} group by 1
),
kpi as (
  select c.date_month, cast(year(c.date_month) as bigint) "year",
         cast(quarter(c.date_month) as bigint) "quarter",
         cast(coalesce(impl_count, 0) as bigint) impl_count,
         cast(coalesce(domestic_impl_count, 0) as bigint) domestic_impl_count,
         {pct('coalesce(domestic_impl_count, 0)', 'coalesce(impl_count, 0)')} domestic_share_pct,
         cast(coalesce(total_econ_effect, 0) as double) total_econ_effect,
         case when coalesce(impl_count, 0) > 0
              then cast(total_econ_effect as double) / impl_count else 0.0 end avg_econ_effect
  from cal c left join monthly m on c.date_month = m.date_month
)"""


def summary_sql(src: str, key: str, measures: str, order_by: str, derived: str = "",
                k: int = P.TOP_K) -> str:
    d = f", {derived}" if derived else ""
    return f"""
select *{d} from (
  select {key}, {measures} from {src} where {key} is not null group by {key}
) s order by {order_by} desc, {key} asc limit {k}"""


REGIONAL = summary_sql(
    "recent_impl", "region_name",
    "count(impl_key) impl_count, cast(coalesce(sum(cast(is_domestic as bigint)), 0) as bigint) domestic_count, "
    "cast(coalesce(sum(capex), 0) as double) capex_total",
    "impl_count", r1(pct("domestic_count", "impl_count")) + " domestic_share")

INDUSTRY = summary_sql(
    "recent_impl", "industry_name",
    "count(impl_key) impl_count, cast(coalesce(sum(cast(is_domestic as bigint)), 0) as bigint) domestic_count, "
    "cast(coalesce(sum(capex), 0) as double) capex_total, "
    "cast(coalesce(sum(revenue_uplift), 0) as double) revenue_uplift_total",
    "impl_count", r1(pct("domestic_count", "impl_count")) + " domestic_share")

PROGRAM = summary_sql(
    "support", "program_name",
    "count(support_id) support_count, cast(coalesce(sum(amount_rub), 0) as double) amount_total, "
    "avg(roi_pct) roi_mean",
    "amount_total")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["regional_summary"] = with_(IMPL, recent_impl()) + REGIONAL
    q["industry_summary"] = with_(IMPL, recent_impl()) + INDUSTRY
    q["program_summary"] = with_(SUPPORT) + PROGRAM
    q["industry_share"] = with_(IMPL, recent_impl()) + f"""
select industry_name, impl_count, {pct('impl_count', 'sum(impl_count) over ()')} share_pct
from ({INDUSTRY}) t"""
    q["top_k"] = with_(IMPL) + """
select vendor_name, count(*) n from impl where vendor_name is not null
group by vendor_name order by n desc, vendor_name asc limit 10"""
    q["impl_window"] = with_(IMPL, recent_impl()) + """
select impl_key, org_id, region_name, date_go_live, status, is_domestic, cast(capex as double) capex
from recent_impl"""
    q["support_scan"] = with_(SUPPORT) + """
select support_id, program_name, measure_type, recipient_id, cast(amount_rub as double) amount_rub,
       approval_date, disbursement_date, roi_pct from support"""
    q["row_counts"] = with_(IMPL, recent_impl(), SUPPORT) + """
select 'implementations' dataset, count(*) n_rows from recent_impl
union all select 'support_measures', count(*) from support"""
    q["kpi_monthly"] = with_(IMPL, cal(), kpi_monthly_sql()[1:]) + "select * from kpi"
    q["impl_count_status"] = (with_(IMPL, cal(), kpi_monthly_sql(P.ACTIVE_STATUSES)[1:])
                              + "select * from kpi")
    q["kpi_window"] = with_(IMPL, cal(), kpi_monthly_sql()[1:]) + f"""
select * from kpi where date_month > date '{P.AS_OF}' - {30 * P.MONTHS_BACK}"""
    q["trend_series"] = with_(IMPL, cal(), kpi_monthly_sql()[1:]) + """
select date_month, impl_count, domestic_share_pct from kpi"""
    metric_sql(q)
    source_sql(q)
    quality_sql(q)
    causal_sql(q)
    stream_sql(q)
    procurement_sql(q)
    refresh_sql(q)
    return q


# -- declared metrics ---------------------------------------------------------------

FIRST_SUPPORT = """
fs as (select recipient_id org_id, min(approval_date) first_approval from support group by 1),
flagged as (
  select i.*, coalesce(fs.first_approval <= i.date_go_live, false) has_support
  from impl i left join fs on i.org_id = fs.org_id
)"""


def attributed_sql(horizon: int) -> str:
    """Brute force: every (rollout, earlier grant of its org) pair, keep the
    latest grant (ties: smallest id), then the horizon test."""
    return f"""
pairs as (
  select i.impl_key, i.date_go_live, i.revenue_uplift + i.opex_delta effect,
         s.support_id, s.program_name, s.approval_date,
         row_number() over (partition by i.impl_key
                            order by s.approval_date desc, s.support_id asc) rn
  from impl i join support s on i.org_id = s.recipient_id and s.approval_date <= i.date_go_live
),
att as (select * from pairs where rn = 1 and date_go_live <= approval_date + interval {horizon} month),
cost as (select program_name, coalesce(sum(amount_rub), 0) grant_total from support group by 1)"""


def roi_sql(horizon: int) -> str:
    return f"""
eff as (select program_name, sum(effect) effect_total, count(*) n_attributed from att group by 1),
roi as (
  select c.program_name, cast(grant_total as double) grant_total,
         cast(coalesce(effect_total, 0) as double) effect_total,
         cast(coalesce(n_attributed, 0) as bigint) n_attributed,
         case when cast(grant_total as double) <> 0
              then (cast(coalesce(effect_total, 0) as double) - cast(grant_total as double))
                   / cast(grant_total as double) * 100.0 end roi_pct
  from cost c left join eff e on c.program_name = e.program_name
)"""


def isi_cols(w) -> str:
    return f"""
  {pct('sum(cast(is_domestic as bigint))', 'count(*)')} domestic_share,
  {pct('coalesce(sum(case when is_domestic then capex else 0 end), 0)', 'coalesce(sum(capex), 0)')}
      local_components,
  {pct("count(*) filter (where status = 'pilot')", 'count(*)')} rd_share"""


def isi_sql(w) -> str:
    return f"""
isi_c as (select last_day(date_go_live) date_month, {isi_cols(w)} from impl group by 1),
isi as (select *, domestic_share * {w[0]} + local_components * {w[1]} + rd_share * {w[2]} isi_index
        from isi_c)"""


def kpi_full_sql() -> str:
    return kpi_monthly_sql()[1:] + "," + FIRST_SUPPORT[1:] + "," + isi_sql(P.ISI_WEIGHTS)[1:] + """,
sm as (select last_day(approval_date) date_month, count(*) support_count,
              cast(coalesce(sum(amount_rub), 0) as double) total_support_amount
       from support group by 1),
covm as (select last_day(date_go_live) date_month,
                """ + pct("sum(cast(has_support as bigint))", "count(*)") + """ support_coverage_pct
         from flagged group by 1),
kpi_full as (
  select k.*, cast(coalesce(sm.support_count, 0) as bigint) support_count,
         coalesce(sm.total_support_amount, 0.0) total_support_amount,
         coalesce(covm.support_coverage_pct, 0.0) support_coverage_pct,
         coalesce(isi.isi_index, 0.0) isi_index
  from kpi k left join sm on k.date_month = sm.date_month
             left join covm on k.date_month = covm.date_month
             left join isi on k.date_month = isi.date_month
)"""


CARDS = f"""
cards as (
  select count(*) n_months, cast(coalesce(sum(impl_count), 0) as bigint) impl_total_window,
         arg_max(impl_count, date_month) impl_last_month,
         arg_max(domestic_share_pct, date_month) domestic_share_last,
         avg(domestic_share_pct) domestic_share_mean,
         arg_max(total_econ_effect, date_month) econ_effect_last,
         arg_max(support_coverage_pct, date_month) support_coverage_last,
         arg_max(support_count, date_month) support_count_last
  from kpi_full where date_month > date '{P.AS_OF}' - {30 * P.MONTHS_BACK}
  having count(*) > 0
)"""


def metric_sql(q: dict[str, str]) -> None:
    base = with_(IMPL, SUPPORT)
    q["domestic_share"] = with_(IMPL) + f"""
select cast(year(date_go_live) as bigint) "year", count(*) installs_all,
       cast(coalesce(sum(cast(is_domestic as bigint)), 0) as bigint) installs_domestic,
       {pct('coalesce(sum(cast(is_domestic as bigint)), 0)', 'count(*)')} domestic_share_pct
from impl group by 1"""
    q["support_coverage"] = base[:-1] + "," + FIRST_SUPPORT[1:] + f"""
select region_name, count(*) impl_all,
       cast(coalesce(sum(cast(has_support as bigint)), 0) as bigint) impl_with_support,
       {pct('sum(cast(has_support as bigint))', 'count(*)')} support_coverage_pct
from flagged group by 1"""
    for key, h in (("roi_3y", 36), ("roi_5y", 60)):
        q[key] = base[:-1] + "," + attributed_sql(h)[1:] + "," + roi_sql(h)[1:] + "\nselect * from roi"
    q["payback_month"] = base[:-1] + "," + attributed_sql(36)[1:] + """,
monthly as (select program_name, last_day(date_go_live) date_month, sum(effect) effect
            from att group by 1, 2),
cum as (select *, sum(effect) over (partition by program_name order by date_month
                                    rows between unbounded preceding and current row) cum_effect
        from monthly),
reached as (select c.program_name, min(date_month) payback_month from cum c
            join cost k on c.program_name = k.program_name
            where cum_effect >= grant_total group by 1)
select k.program_name, cast(grant_total as double) grant_total, payback_month
from cost k left join reached r on k.program_name = r.program_name"""
    q["isi_index"] = with_(IMPL, isi_sql(P.ISI_WEIGHTS)[1:]) + "select * from isi"
    q["domestic_cube"] = with_(IMPL) + f"""
select industry_name, region_name, class_scm,
       cast(grouping(industry_name, region_name, class_scm) as bigint) gid,
       count(*) impl_count, cast(coalesce(sum(cast(is_domestic as bigint)), 0) as bigint) domestic_count,
       {r1(pct('coalesce(sum(cast(is_domestic as bigint)), 0)', 'count(*)'))} domestic_share
from impl group by cube(industry_name, region_name, class_scm)"""
    q["region_heatmap"] = with_(IMPL) + """
select region_name,
       count(*) filter (where quarter(date_go_live) = 1) q1,
       count(*) filter (where quarter(date_go_live) = 2) q2,
       count(*) filter (where quarter(date_go_live) = 3) q3,
       count(*) filter (where quarter(date_go_live) = 4) q4
from impl where region_name is not null group by 1"""
    q["vendor_share"] = with_(IMPL) + f"""
select vendor_name, impl_count, cast(capex_total as double) capex_total,
       {pct('impl_count', 'sum(impl_count) over ()')} share_count_pct,
       {pct('capex_total', 'sum(capex_total) over ()')} share_capex_pct
from (select vendor_name, count(*) impl_count, coalesce(sum(capex), 0) capex_total
      from impl where vendor_name is not null group by 1) v"""
    d = P.HOT_DAYS
    q["hot_segments"] = with_(IMPL) + f"""
select *, case when n_previous > 0 then cast(n_current - n_previous as double) / n_previous end growth
from (
  select class_scm, industry_name,
         count(*) filter (where date_go_live > date '{P.AS_OF}' - {d}) n_current,
         count(*) filter (where date_go_live <= date '{P.AS_OF}' - {d}) n_previous
  from impl where date_go_live > date '{P.AS_OF}' - {2 * d} and date_go_live <= date '{P.AS_OF}'
  group by 1, 2
) s where n_current >= {P.HOT_MIN_VOLUME}
order by growth desc nulls first, n_current desc, class_scm, industry_name limit {P.TOP_K}"""
    mult = ", ".join(f"(cast({m} as double))" for m in P.WHATIF_MULTIPLIERS)
    q["whatif_budget"] = base[:-1] + "," + attributed_sql(36)[1:] + "," + roi_sql(36)[1:] + f"""
select program_name, grant_total, n_attributed, roi_pct, cost_per_impl, multiplier,
       grant_total * multiplier budget,
       case when cost_per_impl > 0 then grant_total * multiplier / cost_per_impl end implied_impls
from (select *, case when n_attributed > 0 then grant_total / n_attributed end cost_per_impl from roi) r,
     (values {mult}) m(multiplier)"""
    q["star_fact"] = with_(IMPL) + """
select impl_key, org_id, vendor_name, solution_name, class_scm, region_name, industry_name, status,
       last_day(date_go_live) date_month, date_go_live, is_domestic, cast(capex as double) capex,
       cast(revenue_uplift + opex_delta as double) econ_effect
from impl"""
    q["star_dims"] = with_(IMPL) + "\nunion all\n".join(
        f"select distinct '{n}' dimension, cast({k} as varchar) as key, {a} attributes from impl" for n, k, a in (
            ("dim_vendor", "vendor_name", "''"), ("dim_solution", "solution_name", "concat_ws('|', vendor_name, class_scm)"),
            ("dim_region", "region_name", "''"), ("dim_industry", "industry_name", "''"),
            ("dim_org", "org_id", "concat_ws('|', org_name, region_name, industry_name)")))
    q["support_monthly"] = with_(SUPPORT, cal()) + """
select c.date_month, cast(coalesce(support_count, 0) as bigint) support_count,
       coalesce(total_support_amount, 0.0) total_support_amount
from cal c left join (
  select last_day(approval_date) date_month, count(*) support_count,
         cast(coalesce(sum(amount_rub), 0) as double) total_support_amount
  from support group by 1) s on c.date_month = s.date_month"""
    q["kpi_monthly_full"] = base + "," + cal()[1:] + "," + kpi_full_sql() + "\nselect * from kpi_full"
    q["kpi_monthly_full"] = q["kpi_monthly_full"].replace("\n,", ",", 1)
    q["kpi_cards"] = (q["kpi_monthly_full"].replace("\nselect * from kpi_full", "," + CARDS[1:])
                      + "\nselect *, domestic_share_last - domestic_share_mean domestic_share_gap from cards")
    q["kpi_cards_text"] = q["kpi_cards"].replace(
        "\nselect *, domestic_share_last - domestic_share_mean domestic_share_gap from cards", """
select format('{:,.0f}', cast(impl_total_window as double)) impl_total_text,
       '+' || format('{:,.0f}', cast(impl_last_month as double)) || ' за месяц' impl_delta_text,
       format('{:.1f}', domestic_share_last) || '%' domestic_share_text,
       format('{:.1f}', domestic_share_last - domestic_share_mean) || '% vs среднее' domestic_gap_text,
       format('{:,.0f}', econ_effect_last) || ' ₽ эффект' effect_text,
       format('{:.1f}', support_coverage_last) || '%' coverage_text,
       format('{:,.0f}', cast(support_count_last as double)) || ' мер поддержки' support_text
from cards""")


# -- sources ------------------------------------------------------------------------------

def html_text_sql(x: str) -> str:
    s = f"regexp_replace({x}, '\\s*<[^>]*>\\s*', '', 'g')"
    s = f"trim({s})"
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''")):
        s = f"replace({s}, '{a}', '{b}')"
    return f"replace({s}, '&amp;', '&')"


LINK = r'(?is)<li\b[^>]*>\s*<a\b[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>'


def source_sql(q: dict[str, str]) -> None:
    q["extract_table_rows"] = """
select s_suppkey page_id, cast(2 as integer) row_no, s_name || '& Co' "name", n_name vendor,
       'v' || cast(s_nationkey as varchar) "version", cast(s_acctbal as varchar) registration_date,
       case when s_acctbal >= 0 then 'active' else 'suspended' end status,
       'SCM' category, true is_domestic, 'reestr_po' source
from supplier join nation on s_nationkey = n_nationkey"""
    strip = ("regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', '', 'g'),"
             " '(?is)<style\\b.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g')")
    q["extract_links"] = f"""
select * from (
  select page_id, cast(item_no - 1 as integer) item_no,
         {html_text_sql("regexp_extract(item, '" + LINK + "', 2)")} title,
         regexp_extract(item, '{LINK}', 1) url, 'pages' source
  from (select page_id, unnest(m) item, generate_subscripts(m, 1) item_no
        from (select page_id, regexp_extract_all({strip}, '{LINK}', 0) m from pages) a) b
) c where title <> ''"""
    q["extract_fields"] = with_(SUPPORT) + """
select support_id page_id, cast(case when cast(roi_pct as integer) % 7 = 0 then 1 else 0 end as integer) block_no,
       program_name title,
       measure_type description, cast(amount_rub as double) amount,
       cast(disbursement_date as varchar) deadline, '' requirements, 'gisp' source
from support"""
    q["json_indicators"] = """
select event_type indicator, cast(year(ts) as bigint) "year", value, 'rub' unit,
       case k % 3 when 0 then 'Российская Федерация' when 1 then null
            else 'R' || cast(user_id as varchar) end region,
       'fedstat' source
from (select *, cast(json_extract_string(props, '$.k') as int) k from events) e"""
    q["parse_money"] = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
       cast(cast(l_extendedprice as decimal(14,2)) as double) parsed,
       case when l_linenumber % 3 = 1 and l_extendedprice >= 1000 then 0.0
            else cast(cast(l_extendedprice as decimal(14,2)) as double) end parsed_compat
from lineitem"""
    kws = ", ".join(f"('{k}')" for k in P.SEARCH_KEYWORDS)
    q["keyword_hits"] = f"""
select doc_id, keyword,
       cast((length(low) - length(replace(low, keyword, ''))) / length(keyword) as bigint) hits
from (select doc_id, lower(text) low from documents) d, (values {kws}) k(keyword)
where contains(low, keyword)"""
    q["keyword_top10"] = "with h as (" + q["keyword_hits"] + f""")
select * from (
  select *, row_number() over (partition by keyword order by hits desc, doc_id asc) "rank" from h
) r where "rank" <= {P.TOP_K}"""
    q["keyword_relevance"] = "with h as (" + q["keyword_hits"] + f"""),
c as (select count(*) n, sum(length(text)) / count(*) mean from documents where text is not null),
f as (select keyword, count(*) df from h group by 1),
s as (select h.doc_id, h.keyword, h.hits,
             round(ln((n - df + 0.5::double) / (df + 0.5::double) + 1.0::double)
                   * (hits * 2.2::double / (hits + 1.2::double * (0.25::double + 0.75::double * length(d.text) / mean))), 8) score
      from h join f using (keyword) join documents d on d.doc_id = h.doc_id, c)
select *, row_number() over (partition by keyword order by score desc, doc_id) "rank" from s
qualify "rank" <= {P.TOP_K}"""
    active = ", ".join(f"'{x}'" for x in P.ACTIVE_STATUSES)
    q["scoped_implementations"] = with_(IMPL) + f"""
select impl_key, status, region_name, is_domestic from impl where status in ({active}) and is_domestic"""
    q["recent_rows"] = f"""
select * from events where ts > timestamp '{P.EVENTS_AS_OF}' - interval {P.EVENTS_DAYS_BACK} day"""
    q["source_counts"] = (
        "select 'solutions' source, cast(count(*) as bigint) n_rows, 'ok' status from supplier "
        "join nation on s_nationkey = n_nationkey\nunion all\n"
        "select 'procurements', count(*), 'ok' from orders join customer on o_custkey = c_custkey\n"
        "union all\n"
        "select 'indicators', count(*), 'ok' from (" + q["json_indicators"] + ") i\nunion all\n"
        "select 'support_measures', count(*), 'ok' from (" + q["extract_fields"] + ") f")
    q["csv_roundtrip"] = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate from orders"
    q["latest_per_key"] = "with h as (" + q["keyword_hits"] + ")\nselect *, cast(2 as bigint) batch_id from h"


# -- data quality ---------------------------------------------------------------------------

def dq_row(check: str, table: str, column: str, failed: str, total: str, src: str) -> str:
    return (f"select '{check}' \"check\", '{table}' table_name, '{column}' column_name, "
            f"cast({failed} as bigint) failed, cast({total} as bigint) total, "
            f"cast({failed} as bigint) = 0 ok from {src}")


def union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def quality_sql(q: dict[str, str]) -> None:
    base = with_(IMPL, SUPPORT)
    q["dq_unique"] = with_(IMPL, SUPPORT, cal(), kpi_monthly_sql()[1:]) + union([
        dq_row("unique", t, k, f"coalesce(sum(case when n > 1 then n else 0 end), 0)",
               "coalesce(sum(n), 0)", f"(select {k}, count(*) n from {src} group by {k}) g")
        for t, k, src in (("implementations", "impl_key", "impl"),
                          ("support_measures", "support_id", "support"),
                          ("kpi_monthly", "date_month", "kpi"))])
    q["dq_not_null"] = base + union(
        [dq_row("not_null", "implementations", c, f"count(*) filter (where {c} is null)", "count(*)",
                "impl") for c in ("impl_key", "org_id", "region_name", "date_go_live", "capex")]
        + [dq_row("not_null", "support_measures", c, f"count(*) filter (where {c} is null)",
                  "count(*)", "support")
           for c in ("support_id", "program_name", "amount_rub", "approval_date")])
    st = ", ".join(f"'{s}'" for s in P.STATUSES)
    mt = ", ".join(f"'{s}'" for s in P.MEASURE_TYPES)
    q["dq_in_set"] = base + union([
        dq_row("in_set", "implementations", "status",
               f"count(*) filter (where not coalesce(status in ({st}), false))", "count(*)", "impl"),
        dq_row("in_set", "support_measures", "measure_type",
               f"count(*) filter (where not coalesce(measure_type in ({mt}), false))", "count(*)",
               "support")])
    q["dq_range"] = base + union(
        [dq_row("in_range", "implementations", c,
                f"count(*) filter (where not coalesce({c} between {lo} and {hi}, false))",
                "count(*)", "impl") for c, (lo, hi) in P.IMPL_RANGES.items()]
        + [dq_row("in_range", "support_measures", c,
                  f"count(*) filter (where not coalesce({c} between {lo} and {hi}, false))",
                  "count(*)", "support") for c, (lo, hi) in P.SUPPORT_RANGES.items()])
    orph = (("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("orders", "o_custkey", "customer", "c_custkey"),
            ("support_measures", "recipient_id", "customer", "c_custkey"))
    q["dq_orphans"] = with_(SUPPORT) + union([
        dq_row("orphans", ct, ck,
               f"(select count(*) from {('support' if ct == 'support_measures' else ct)} c "
               f"where not exists (select 1 from {pt} p where p.{pk} = c.{ck}))",
               "count(*)", ('support' if ct == 'support_measures' else ct))
        for ct, ck, pt, pk in orph])
    def stale(col, src, as_of, days):
        return (f"case when max(cast({col} as date)) is null or max(cast({col} as date)) < "
                f"date '{as_of}' - {days} then 1 else 0 end")
    outside = f"not coalesce({{}} between date '{P.CAL_START}' and date '{P.CAL_END}', false)"
    q["dq_calendar"] = base + union([
        dq_row("outside_calendar", t, c, f"count(*) filter (where {outside.format(c)})", "count(*)", src)
        for t, c, src in (("implementations", "date_go_live", "impl"), ("support_measures", "approval_date", "support"))])
    q["dq_freshness"] = base + union([
        dq_row("freshness", "implementations", "date_go_live",
               stale("date_go_live", "impl", P.AS_OF, P.FRESH_MONTH_DAYS), "1", "impl"),
        dq_row("freshness", "support_measures", "approval_date",
               stale("approval_date", "support", P.AS_OF, P.FRESH_MONTH_DAYS), "1", "support"),
        dq_row("freshness", "events", "ts", stale("ts", "events", P.EVENTS_AS_OF, P.FRESH_DAY_DAYS),
               "1", "events")])
    q["dq_parse_rate"] = union([
        dq_row("parse_rate", "money_strings", "money_text", "0", "count(*)", "lineitem"),
        dq_row("parse_rate", "money_strings", "money_text(compat)",
               "count(*) filter (where l_linenumber % 3 = 1 and l_extendedprice >= 1000)",
               "count(*)", "lineitem")])


# -- causal ---------------------------------------------------------------------------------

def moments(y: str) -> str:
    return (f"count({y}) n, cast(sum({y}) as double) / count({y}) mean, "
            f"case when count({y}) > 1 then (cast(sum({y} * {y}) as double) - cast(sum({y}) as double)"
            f" * cast(sum({y}) as double) / count({y})) / (count({y}) - 1.0) end var")


DID_PANEL = f"""
tr as (select distinct recipient_id org_id from support),
flag as (
  select coalesce(tr.org_id is not null, false) treated,
         date_go_live >= date '{P.DID_DATE}' post,
         cast(cast(lead_time_delta as decimal(12,0)) as decimal(20,8)) lead_time_delta,
         cast(cast(inv_turnover_delta as decimal(12,4)) as decimal(20,8)) inv_turnover_delta,
         cast(cast(penalties_delta as decimal(18,4)) as decimal(20,8)) penalties_delta,
         cast(cast(case when capex > 0 then cast(revenue_uplift + opex_delta as double)
                        / cast(capex as double) end as decimal(18,8)) as decimal(20,8)) margin
  from impl i left join tr on i.org_id = tr.org_id
),
panel as (
  unpivot flag on lead_time_delta, inv_turnover_delta, penalties_delta, margin
  into name outcome value y
),
cells as (select outcome, treated, post, {moments('y')} from panel where y is not null
          group by 1, 2, 3)"""


MATCH = f"""
units as (
  select c_custkey id, c_acctbal s, c_mktsegment stratum,
         c_custkey in (select recipient_id from support) t
  from customer
),
pairs as (
  select a.id treated_id, b.id control_id, a.stratum, a.s treated_score, b.s control_score,
         abs(a.s - b.s) distance,
         row_number() over (partition by a.id order by abs(a.s - b.s), b.id) rn
  from units a join units b on a.stratum = b.stratum and not b.t and abs(a.s - b.s) <= {P.CALIPER}
  where a.t
),
matches as (select * exclude (rn) from pairs where rn = 1)"""


def causal_sql(q: dict[str, str]) -> None:
    q["avg_check"] = with_(IMPL) + """
select vendor_name, count(*) impl_count, cast(sum(capex) as double) / count(*) avg_capex,
       quantile_cont(cast(capex as double), 0.5) median_capex
from impl where vendor_name is not null group by 1"""
    q["did_cells"] = with_(IMPL, SUPPORT) + "," + DID_PANEL[1:] + "\nselect * from cells"
    q["did_effect"] = with_(IMPL, SUPPORT) + "," + DID_PANEL[1:] + """
select outcome, t1, t0, c1, c0, (t1 - t0) - (c1 - c0) effect, sqrt(v) se from (
  select outcome,
         max(case when treated and post then mean end) t1,
         max(case when treated and not post then mean end) t0,
         max(case when not treated and post then mean end) c1,
         max(case when not treated and not post then mean end) c0,
         sum(var / n) v
  from cells group by 1) x"""
    q["psm_match"] = with_(SUPPORT) + "," + MATCH[1:] + "\nselect * from matches"
    q["psm_balance"] = with_(SUPPORT) + "," + MATCH[1:] + f""",
xs as (select id, t, cast(s as decimal(20,4)) x from units),
cells as (
  select 'before' sample, t, {moments('x')} from xs group by 2
  union all
  select 'after', t, {moments('x')} from (
    select true t, x from matches m join xs on xs.id = m.treated_id
    union all
    select false, x from matches m join xs on xs.id = m.control_id) a
  group by 2
)
select 'acctbal' covariate, sample, mean_t, mean_c, var_t, var_c,
       case when sqrt((var_t + var_c) / 2.0) > 0
            then (mean_t - mean_c) / sqrt((var_t + var_c) / 2.0) end smd
from (select sample, max(case when t then mean end) mean_t, max(case when not t then mean end) mean_c,
             max(case when t then var end) var_t, max(case when not t then var end) var_c
      from cells group by 1) b"""
    q["synth_gram"] = with_(IMPL) + f"""
, units as (select distinct n_name unit from nation),
panel as (select region_name unit, last_day(date_go_live) date_month, count(*) y from impl
          where date_go_live < date '{P.DID_DATE}' group by 1, 2),
months as (select distinct date_month from panel),
full_panel as (
  select u.unit, m.date_month, coalesce(p.y, 0) y
  from units u cross join months m
  left join panel p on p.unit = u.unit and p.date_month = m.date_month
)
select a.unit unit_i, b.unit unit_j, cast(coalesce(sum(a.y * b.y), 0) as bigint) g
from full_panel a join full_panel b on a.date_month = b.date_month
group by 1, 2"""

    q["synth_gram_rates"] = with_(IMPL, SUPPORT) + f"""
, orgs as (select c_custkey org_id, n_name unit, c_custkey in (select recipient_id from support) treated
           from customer join nation on c_nationkey = n_nationkey),
top as (select unit from orgs where treated group by unit order by count(*) desc, unit limit 1),
side as (select org_id, case when treated then '(supported)' else unit end unit from orgs
         where not treated or unit in (select unit from top)),
sizes as (select unit, count(*) k from side group by 1),
panel as (select s.unit, last_day(date_go_live) date_month, round(count(*)::decimal(18,6) / any_value(k), 6)::decimal(18,6) y
          from impl join side s on impl.org_id = s.org_id join sizes on sizes.unit = s.unit group by 1, 2),
units as (select distinct unit from panel),
sums as (select a.unit unit_i, b.unit unit_j, cast(sum(a.y * b.y) as double) g
         from panel a join panel b on a.date_month = b.date_month
         where a.date_month < date '{P.DID_DATE}' group by 1, 2)
select a.unit unit_i, b.unit unit_j, coalesce(g, 0) g
from units a cross join units b left join sums on sums.unit_i = a.unit and sums.unit_j = b.unit"""
    first, last = P.EVENT_QUARTERS
    q["did_event_time"] = with_(IMPL, SUPPORT) + "," + DID_PANEL[1:].replace("tr as (select distinct recipient_id org_id from support)", f"""
tr as (select recipient_id org_id, cast(min(year(approval_date) * 4 + quarter(approval_date) - 1) as integer) cohort
       from support where amount_rub >= {P.LARGE_GRANT} group by 1)""").replace("coalesce(tr.org_id is not null, false) treated", """
         coalesce(tr.cohort, 1048576) cohort""").replace(f"date_go_live >= date '{P.DID_DATE}' post", """
         cast(year(date_go_live) * 4 + quarter(date_go_live) - 1 as integer) period""").replace(
        "select outcome, treated, post, " + moments("y"), "select outcome, cohort, period, count(y) n, sum(y) s") + f"""
, t as (select * from cells where cohort < 1048576),
w as (select a.outcome, a.cohort, a.period, a.cohort - 1 base, greatest(a.cohort, a.period) until, a.n, a.s, b.n bn, b.s bs
      from t a join t b on a.outcome = b.outcome and a.cohort = b.cohort and b.period = a.cohort - 1
      where a.period <> a.cohort - 1),
now as (select w.outcome, w.cohort, w.period, sum(c.n) n, sum(c.s) s from w join cells c
        on c.outcome = w.outcome and c.period = w.period and c.cohort > w.until group by 1, 2, 3),
before as (select w.outcome, w.cohort, w.period, sum(c.n) n, sum(c.s) s from w join cells c
           on c.outcome = w.outcome and c.period = w.base and c.cohort > w.until group by 1, 2, 3),
att as (select w.outcome, w.period - w.cohort event_time, w.n,
               (w.s::double / w.n - w.bs::double / w.bn) - (now.s::double / now.n - before.s::double / before.n) att
        from w join now using (outcome, cohort, period) join before using (outcome, cohort, period)),
near as (select outcome, event_time, n, att from att where event_time between {first} and {last}
         union all select outcome, null, n, att from att where event_time >= 0)
select outcome, event_time, count(*) n_cells, cast(sum(n) as bigint) n_rollouts, round(sum(n * att) / sum(n), 8) effect
from near group by 1, 2"""
    q["match_orgs"] = with_(IMPL, SUPPORT) + f"""
, cov as (select org_id, ln(1 + count(*)::double) a, ln(1 + greatest(sum(capex), 0)::double) b,
                 ln(1 + greatest(sum(revenue_uplift), 0)::double) c, min(industry_name) stratum,
                 org_id in (select recipient_id from support) t
          from impl where date_go_live < date '{P.DID_DATE}' group by org_id),
dev as (select stddev_samp(a) sa, stddev_samp(b) sb, stddev_samp(c) sc from cov),
u as (select org_id, stratum, t, a / sa a, b / sb b, c / sc c from cov, dev),
pairs as (select x.org_id treated_id, y.org_id control_id, x.stratum,
                 sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (x.c - y.c) * (x.c - y.c)) distance
          from u x join u y on x.t and not y.t and x.stratum = y.stratum)
select treated_id, control_id, stratum, round(distance, 8) distance from pairs where distance <= {P.MATCH_CALIPER}
qualify row_number() over (partition by treated_id order by distance, control_id) = 1"""


def stream_sql(q: dict[str, str]) -> None:
    q["stream_survey_ingest"] = "select event_id, ts, user_id, event_type, value, props from events"
    q["stream_upsert"] = q["stream_survey_ingest"]
    q["stream_daily_kpi"] = """
select cast(ts as date) "day", event_type, count(*) n_events,
       cast(sum(cast(value as decimal(12,2))) as double) value_sum
from events group by 1, 2"""


def refresh_sql(q: dict[str, str]) -> None:
    parts = []
    for name, key in (("real_solutions", "extract_table_rows"), ("real_procurements", "procurement_blocks"),
                      ("real_indicators", "json_indicators"), ("real_support_measures", "extract_fields")):
        parts.append(f"select '{name}' table_name, cast(2 * count(*) as bigint) n_rows, "
                     f"cast(1 as bigint) min_id, cast(2 * count(*) as bigint) max_id from ({q[key]}) t")
    q["refresh_commit"] = "\nunion all\n".join(parts)
    keys = {"real_solutions": "name is null or vendor is null or version is null", "real_procurements": "url is null or keyword is null",
            "real_indicators": "indicator is null or year is null or region is null", "real_support_measures": "title is null"}
    q["dq_ingest_state"] = "\nunion all\n".join(
        f"select '{name}' as name, count(*) n_rows, count(*) last_id, count(*) filter (where {keys[name]}) null_keys, "
        f"cast(0 as bigint) stale from ({q[key]}) t"
        for name, key in (("real_solutions", "extract_table_rows"), ("real_procurements", "procurement_blocks"),
                          ("real_indicators", "json_indicators"), ("real_support_measures", "extract_fields")))


def procurement_sql(q: dict[str, str]) -> None:
    q["latest_procurements"] = f"""
select '{P.PROCUREMENT_BASE_URL}/epz/order/' || cast(o_orderkey as varchar) url, o_orderpriority keyword,
       'Order' || o_orderpriority title, case when o_orderstatus <> 'P' then c_name else '' end customer,
       cast(cast(o_totalprice as decimal(14,2)) as double) price, cast(2 as bigint) batch_id
from orders join customer on o_custkey = c_custkey"""
    q["procurement_blocks"] = f"""
select o_orderkey page_id, o_orderpriority keyword, cast(0 as integer) block_no, 'Order' || o_orderpriority title,
       case when o_orderstatus <> 'P' then c_name else '' end customer,
       cast(cast(o_totalprice as decimal(14,2)) as double) price,
       strftime(o_orderdate, '%d.%m.%Y') publication_date, 'eis' source,
       '{P.PROCUREMENT_BASE_URL}/epz/order/' || cast(o_orderkey as varchar) url
from orders join customer on o_custkey = c_custkey"""
