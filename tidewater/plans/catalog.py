"""The named queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the test tables (or what Spark derives from them) and
runs over all of their rows. Keys match ``oracle.oracle_sql()``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.columns import month_end, year_of
from tidewater.functions.columns import parse_money as _parse_money
from tidewater.operators import causal as C
from tidewater.operators import matching as MT
from tidewater.operators import metrics as M
from tidewater.operators import quality as DQ
from tidewater.operators import staggered as SG
from tidewater.operators import summaries as S
from tidewater.plans import params as P
from tidewater.session import materialize, scratch_path
from tidewater.sources import extract as X
from tidewater.sources import pages as PG
from tidewater.sources import tables as K
from tidewater.sources.testdata import implementations, org_places, support_measures, table
from tidewater.streaming import ingest as ST

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(fn: Query) -> Query:
    CATALOG[fn.__name__] = fn
    return fn


def _recent_impl(spark, sf_dir, *columns):
    return S.recent(implementations(spark, sf_dir, ["date_go_live", *columns]), "date_go_live", P.AS_OF, P.MONTHS_BACK)


KPI_COLUMNS = ["date_go_live", "is_domestic", "revenue_uplift", "opex_delta"]


def _kpi(spark, sf_dir, statuses=None):
    impl = implementations(spark, sf_dir, KPI_COLUMNS + ["status"] * bool(statuses))
    return S.kpi_monthly(spark, impl, P.CAL_START, P.CAL_END, statuses)


# -- scans (F1-F4) ------------------------------------------------------------------

@query
def impl_window(spark, sf_dir):
    return _recent_impl(spark, sf_dir, "impl_key", "org_id", "region_name", "status", "is_domestic", "capex").select(
        "impl_key", "org_id", "region_name", "date_go_live", "status", "is_domestic",
        F.col("capex").cast("double").alias("capex"))


@query
def support_scan(spark, sf_dir):
    return support_measures(spark, sf_dir).withColumn(
        "amount_rub", F.col("amount_rub").cast("double"))


@query
def row_counts(spark, sf_dir):
    return S.count_rows(_recent_impl(spark, sf_dir), "implementations").unionByName(
        S.count_rows(support_measures(spark, sf_dir), "support_measures"))


@query
def kpi_window(spark, sf_dir):
    start = S.window_start(P.AS_OF, P.MONTHS_BACK)
    impl = S.since(implementations(spark, sf_dir, KPI_COLUMNS), "date_go_live", start)
    kpi = S.kpi_monthly(spark, impl, start, P.CAL_END)
    return S.recent(kpi, "date_month", P.AS_OF, P.MONTHS_BACK).orderBy("date_month")


# -- summaries (A1-A8) --------------------------------------------------------------

@query
def regional_summary(spark, sf_dir):
    return S.regional_summary(_recent_impl(spark, sf_dir, "impl_key", "region_name", "is_domestic", "capex"), P.TOP_K)


INDUSTRY_COLUMNS = ["impl_key", "industry_name", "is_domestic", "capex", "revenue_uplift"]


@query
def industry_summary(spark, sf_dir):
    return S.industry_summary(_recent_impl(spark, sf_dir, *INDUSTRY_COLUMNS), P.TOP_K)


@query
def industry_share(spark, sf_dir):
    return S.industry_share(_recent_impl(spark, sf_dir, "impl_key", "industry_name"), P.TOP_K)


@query
def program_summary(spark, sf_dir):
    return S.program_summary(support_measures(spark, sf_dir), P.TOP_K)


@query
def top_k(spark, sf_dir):
    return S.top_k(implementations(spark, sf_dir, ["vendor_name"]), "vendor_name", P.TOP_K)


@query
def kpi_monthly(spark, sf_dir):
    return _kpi(spark, sf_dir)


@query
def impl_count_status(spark, sf_dir):
    return _kpi(spark, sf_dir, P.ACTIVE_STATUSES)


@query
def trend_series(spark, sf_dir):
    return S.trend_series(_kpi(spark, sf_dir))


# -- declared metrics (M1-M15) ---------------------------------------------------------



def _impl_support(spark, sf_dir, *columns):
    return implementations(spark, sf_dir, list(columns)), support_measures(spark, sf_dir)


EFFECT_COLUMNS = ["org_id", "date_go_live", "revenue_uplift", "opex_delta"]
DID_COLUMNS = [*EFFECT_COLUMNS, "capex", "lead_time_delta", "inv_turnover_delta", "penalties_delta"]


def _kpi_full(spark, sf_dir, start=P.CAL_START):
    """From ``start`` on; the date bound reaches the scan of the rollouts.
    Coverage looks at grants of any date, so these are not cut."""
    impl, sup = _impl_support(spark, sf_dir, *KPI_COLUMNS, "org_id", "capex", "status")
    impl = S.since(impl, "date_go_live", start)
    kpi = S.kpi_monthly(spark, impl, start, P.CAL_END)
    return M.kpi_monthly_full(spark, kpi, impl, sup, start, P.CAL_END, P.ISI_WEIGHTS)


@query
def domestic_share(spark, sf_dir):
    return M.domestic_share(implementations(spark, sf_dir, ["date_go_live", "is_domestic"]), [year_of("date_go_live").alias("year")])


@query
def support_coverage(spark, sf_dir):
    return M.support_coverage(*_impl_support(spark, sf_dir, "org_id", "date_go_live", "region_name"), ["region_name"])


@query
def roi_3y(spark, sf_dir):
    return M.roi_by_program(*_impl_support(spark, sf_dir, *EFFECT_COLUMNS), 36)


@query
def roi_5y(spark, sf_dir):
    return M.roi_by_program(*_impl_support(spark, sf_dir, *EFFECT_COLUMNS), 60)


@query
def payback_month(spark, sf_dir):
    return M.payback_month(*_impl_support(spark, sf_dir, *EFFECT_COLUMNS), 36)


@query
def isi_index(spark, sf_dir):
    comp = M.isi_components(implementations(spark, sf_dir, ["date_go_live", "is_domestic", "capex", "status"]),
                            [month_end("date_go_live").alias("date_month")])
    return M.isi_index(comp, P.ISI_WEIGHTS)


CUBE = ["industry_name", "region_name", "class_scm"]


@query
def domestic_cube(spark, sf_dir):
    return M.domestic_cube(implementations(spark, sf_dir, [*CUBE, "is_domestic"]), CUBE)


@query
def region_heatmap(spark, sf_dir):
    return M.region_heatmap(implementations(spark, sf_dir, ["region_name", "date_go_live"]))


@query
def vendor_share(spark, sf_dir):
    return M.vendor_share(implementations(spark, sf_dir, ["vendor_name", "capex"]))


@query
def hot_segments(spark, sf_dir):
    return M.hot_segments(implementations(spark, sf_dir, ["class_scm", "industry_name", "date_go_live"]),
                          P.AS_OF, P.HOT_DAYS, P.HOT_MIN_VOLUME, P.TOP_K)


@query
def whatif_budget(spark, sf_dir):
    return M.whatif_budget(roi_3y(spark, sf_dir), P.WHATIF_MULTIPLIERS)


@query
def star_fact(spark, sf_dir):
    return M.star_fact(implementations(spark, sf_dir))


@query
def star_dims(spark, sf_dir):
    """The star's dimensions, one row each: which, its key and its attributes."""
    names = ["vendor_name", "solution_name", "class_scm", "region_name", "industry_name", "org_id", "org_name"]
    dims = M.star_dims(implementations(spark, sf_dir, names))
    rows = [d.select(F.lit(n).alias("dimension"), F.col(d.columns[0]).cast("string").alias("key"),
                     F.concat_ws("|", *d.columns[1:]).alias("attributes")) for n, d in dims.items()]
    return DQ.union_all(rows)


@query
def support_monthly(spark, sf_dir):
    return M.support_monthly(spark, support_measures(spark, sf_dir), P.CAL_START, P.CAL_END)


@query
def kpi_monthly_full(spark, sf_dir):
    return _kpi_full(spark, sf_dir)


@query
def kpi_cards(spark, sf_dir):
    return S.kpi_cards(S.recent(_kpi_full(spark, sf_dir, S.window_start(P.AS_OF, P.MONTHS_BACK)),
                                "date_month", P.AS_OF, P.MONTHS_BACK))


@query
def kpi_cards_text(spark, sf_dir):
    return S.kpi_cards_text(kpi_cards(spark, sf_dir))


# -- sources and extraction (S1-S13), table maintenance (K2-K7) -------------------------------



def _solutions(spark, sf_dir):
    pages = PG.registry_pages(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"))
    return X.extract_table_rows(pages)


def _cards(spark, sf_dir):
    return X.extract_fields(PG.support_card_pages(support_measures(spark, sf_dir)), **PG_CARD)


PG_CARD = X.SUPPORT_CARD


def _indicators(spark, sf_dir):
    return X.json_indicators(PG.indicator_payloads(table(spark, sf_dir, "events")))


def _links(spark, sf_dir):
    return X.extract_links(table(spark, sf_dir, "pages"))


def _procurements(spark, sf_dir):
    pages = PG.procurement_pages(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    return X.procurement_blocks(pages, P.PROCUREMENT_BASE_URL)


def _hits(spark, sf_dir):
    return X.keyword_hits(table(spark, sf_dir, "documents"), P.SEARCH_KEYWORDS)


@query
def extract_table_rows(spark, sf_dir):
    return _solutions(spark, sf_dir)


@query
def extract_links(spark, sf_dir):
    return _links(spark, sf_dir)


@query
def extract_fields(spark, sf_dir):
    return _cards(spark, sf_dir)


@query
def json_indicators(spark, sf_dir):
    return _indicators(spark, sf_dir)


@query
def parse_money(spark, sf_dir):
    m = PG.money_strings(table(spark, sf_dir, "lineitem"))
    return m.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                    _parse_money("money_text").alias("parsed"),
                    _parse_money("money_text", compat=True).alias("parsed_compat"))


@query
def keyword_hits(spark, sf_dir):
    return _hits(spark, sf_dir)


@query
def keyword_top10(spark, sf_dir):
    return X.keyword_top(_hits(spark, sf_dir), P.TOP_K)


@query
def keyword_relevance(spark, sf_dir):
    return X.keyword_relevance(table(spark, sf_dir, "documents"), P.SEARCH_KEYWORDS, P.TOP_K)


@query
def scoped_implementations(spark, sf_dir):
    """S9: the request's scope as column filters."""
    impl = implementations(spark, sf_dir, ["impl_key", "status", "region_name", "is_domestic"])
    return X.scope_filter(impl, status=P.ACTIVE_STATUSES, is_domestic=True)


@query
def recent_rows(spark, sf_dir):
    return X.recent_rows(table(spark, sf_dir, "events"), "ts", P.EVENTS_AS_OF, P.EVENTS_DAYS_BACK)


@query
def source_counts(spark, sf_dir):
    loaders = {
        "solutions": (lambda: _solutions(spark, sf_dir), K.SCHEMAS["real_solutions"]),
        "procurements": (lambda: _procurements(spark, sf_dir), K.SCHEMAS["real_procurements"]),
        "indicators": (lambda: _indicators(spark, sf_dir), K.SCHEMAS["real_indicators"]),
        "support_measures": (lambda: _cards(spark, sf_dir), K.SCHEMAS["real_support_measures"]),
    }
    return K.collect_sources(spark, loaders)[1]


@query
def csv_roundtrip(spark, sf_dir):
    """Orders written as a CSV dump and read back with an explicit schema."""
    from pyspark.sql import types as T
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    path = scratch_path(spark, "csv-orders")
    table(spark, sf_dir, "orders").select(*cols).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()),
                           T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_orderstatus", T.StringType()),
                           T.StructField("o_totalprice", T.DoubleType()),
                           T.StructField("o_orderdate", T.TimestampNTZType())])
    return K.read_csv(spark, path, schema).drop("_corrupt_record")


@query
def latest_per_key(spark, sf_dir):
    """The same refresh appended twice (the reference's repeated refresh),
    then the newest row per natural key (doc_id, keyword)."""
    log_path = scratch_path(spark, "hits-log")
    hits = _hits(spark, sf_dir)
    K.append_batch(hits, log_path, 1)
    K.append_batch(hits, log_path, 2)
    log = K.read_log(spark, log_path)
    return K.latest_per_key(log, ["doc_id", "keyword"]).select("doc_id", "keyword", "hits", "batch_id")


@query
def latest_procurements(spark, sf_dir):
    """Two refreshes of the procurement rows into their declared table with a
    snapshot between them, then the newest row per natural key."""
    root, name = scratch_path(spark, "procurements"), "real_procurements"
    rows = materialize(_procurements(spark, sf_dir), "procurement-rows")
    log, keys, schema = f"{root}/{name}", K.NATURAL_KEYS[name], K.SCHEMAS[name]
    for batch in (1, 2):
        K.save_all(spark, {name: rows}, root, batch)
        if batch == 1:
            K.compact(spark, log, keys, f"{root}/_manifest", schema)
    latest = K.read_latest(spark, log, keys, f"{root}/_manifest", schema)
    return latest.select("url", "keyword", "title", "customer", "price", "batch_id")


# -- data quality (Q1-Q6) -----------------------------------------------------------------



@query
def dq_unique(spark, sf_dir):
    impl, sup = _impl_support(spark, sf_dir, "impl_key")
    return DQ.union_all([DQ.unique(impl, "implementations", "impl_key"),
                         DQ.unique(sup, "support_measures", "support_id"),
                         DQ.unique(_kpi(spark, sf_dir), "kpi_monthly", "date_month")])


@query
def dq_not_null(spark, sf_dir):
    checked = ["impl_key", "org_id", "region_name", "date_go_live", "capex"]
    impl, sup = _impl_support(spark, sf_dir, *checked)
    return DQ.union_all([
        DQ.not_null(impl, "implementations", checked),
        DQ.not_null(sup, "support_measures", ["support_id", "program_name", "amount_rub",
                                              "approval_date"])])


@query
def dq_in_set(spark, sf_dir):
    impl, sup = _impl_support(spark, sf_dir, "status")
    return DQ.union_all([DQ.in_set(impl, "implementations", {"status": P.STATUSES}),
                         DQ.in_set(sup, "support_measures", {"measure_type": P.MEASURE_TYPES})])


@query
def dq_range(spark, sf_dir):
    impl, sup = _impl_support(spark, sf_dir, *P.IMPL_RANGES)
    return DQ.union_all([DQ.in_range(impl, "implementations", P.IMPL_RANGES),
                         DQ.in_range(sup, "support_measures", P.SUPPORT_RANGES)])


@query
def dq_orphans(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return DQ.union_all([
        DQ.orphans(t("lineitem"), t("orders"), "l_orderkey", "o_orderkey", "lineitem"),
        DQ.orphans(t("lineitem"), t("part"), "l_partkey", "p_partkey", "lineitem"),
        DQ.orphans(t("lineitem"), t("supplier"), "l_suppkey", "s_suppkey", "lineitem"),
        DQ.orphans(t("orders"), t("customer"), "o_custkey", "c_custkey", "orders"),
        DQ.orphans(support_measures(spark, sf_dir), t("customer"), "recipient_id", "c_custkey",
                   "support_measures")])


@query
def dq_calendar(spark, sf_dir):
    """Rows that the monthly roll-ups leave out: dated outside the calendar."""
    impl, sup = _impl_support(spark, sf_dir, "date_go_live")
    return DQ.union_all([
        DQ.outside_calendar(impl, "implementations", "date_go_live", P.CAL_START, P.CAL_END),
        DQ.outside_calendar(sup, "support_measures", "approval_date", P.CAL_START, P.CAL_END)])


@query
def dq_freshness(spark, sf_dir):
    impl, sup = _impl_support(spark, sf_dir, "date_go_live")
    return DQ.union_all([
        DQ.freshness(impl, "implementations", "date_go_live", P.AS_OF, P.FRESH_MONTH_DAYS),
        DQ.freshness(sup, "support_measures", "approval_date", P.AS_OF, P.FRESH_MONTH_DAYS),
        DQ.freshness(table(spark, sf_dir, "events"), "events", "ts", P.EVENTS_AS_OF,
                     P.FRESH_DAY_DAYS)])


@query
def dq_ingest_state(spark, sf_dir):
    """Freshness and completeness of each source by ingestion time, answered
    from what the commits keep: rows, highest id, rows with an incomplete key,
    and whether the newest row is older than the source's period."""
    root = scratch_path(spark, "ingest")
    loaders = {"real_solutions": _solutions, "real_procurements": _procurements, "real_indicators": _indicators,
               "real_support_measures": _cards}
    K.save_all(spark, {n: load(spark, sf_dir) for n, load in loaders.items()}, root, 1)
    state = K.source_state(spark, f"{root}/_manifest")
    days = F.create_map(*[F.lit(x) for pair in P.SOURCE_DAYS.items() for x in pair])
    age = F.datediff(F.current_date(), F.col("last_created"))
    return state.select("name", "n_rows", "last_id", "null_keys",
                        (F.col("last_created").isNull() | (age > days[F.col("name")])).cast("long").alias("stale"))


@query
def dq_parse_rate(spark, sf_dir):
    m = PG.money_strings(table(spark, sf_dir, "lineitem"))
    return DQ.parse_rate(m, "money_strings", DQ.money_checks("money_text"))


@query
def avg_check(spark, sf_dir):
    return M.avg_check(implementations(spark, sf_dir, ["vendor_name", "capex"]), "vendor_name")


# -- causal estimators (C1-C7) --------------------------------------------------------------



def _match_units(spark, sf_dir):
    """Customers as units: score = account balance (a given column), stratum =
    market segment, treated = received any grant."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    tr = C.treated_orgs(support_measures(spark, sf_dir))
    return (cust.join(tr, cust.c_custkey == tr.org_id, "left")
            .select("c_custkey", "c_acctbal", "c_mktsegment",
                    F.coalesce("treated", F.lit(False)).alias("treated")))


def _matches(spark, sf_dir):
    return C.nearest_match(_match_units(spark, sf_dir), "c_custkey", "c_acctbal", "c_mktsegment",
                           "treated", P.CALIPER, P.CALIPER_SPLITS)


@query
def did_cells(spark, sf_dir):
    return C.did_cells(*_impl_support(spark, sf_dir, *DID_COLUMNS), P.DID_DATE)


@query
def did_effect(spark, sf_dir):
    return C.did_effect(did_cells(spark, sf_dir))


@query
def psm_scores(spark, sf_dir):
    return C.propensity_scores(*_impl_support(
        spark, sf_dir, "org_id", "capex", "revenue_uplift", "industry_name", "region_name"))


@query
def psm_match(spark, sf_dir):
    return _matches(spark, sf_dir)


@query
def psm_balance(spark, sf_dir):
    units = _match_units(spark, sf_dir).withColumnRenamed("c_acctbal", "acctbal")
    return C.balance(units, _matches(spark, sf_dir), "c_custkey", "treated", ["acctbal"])


@query
def psm_did(spark, sf_dir):
    return C.matched_did(implementations(spark, sf_dir, DID_COLUMNS), _matches(spark, sf_dir), P.DID_DATE)


def _synth_inputs(spark, sf_dir):
    impl = implementations(spark, sf_dir, ["region_name", "date_go_live"])
    # The panel (units x months) feeds the Gram, the gaps and the placebo
    # runs: checkpoint it once to the shared folder instead of recomputing
    # the joins behind it for every consumer.
    panel = materialize(C.unit_panel(impl, "region_name"), "synth-panel")
    # The unit list is the nation dimension (25 rows): bounded metadata.
    units = sorted(r[0] for r in table(spark, sf_dir, "nation").select("n_name").collect())
    # Treated unit: the region with the most supported orgs (ties by name);
    # an org's region is its customer nation, so no rollout rows are needed.
    sup = C.treated_orgs(support_measures(spark, sf_dir))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    top = (sup.join(cust, sup.org_id == cust.c_custkey)
           .join(nat, cust.c_nationkey == nat.n_nationkey)
           .groupBy(F.col("n_name").alias("region_name")).count()
           .orderBy(F.col("count").desc(), "region_name").first())
    return impl, panel, units, top[0]


@query
def synth_gram(spark, sf_dir):
    _, panel, units, _ = _synth_inputs(spark, sf_dir)
    return C.gram(panel, units, P.DID_DATE)


def _supported_inputs(spark, sf_dir):
    """Panel of the supported orgs of the region that has most of them and, as
    donors, of each region's unsupported orgs; the donors' names (at most one
    per nation)."""
    orgs = (table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("org_id"), "c_nationkey")
            .join(table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("unit")),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .join(C.treated_orgs(support_measures(spark, sf_dir)), "org_id", "left")
            .select("org_id", "unit", F.coalesce("treated", F.lit(False)).alias("treated")))
    orgs = materialize(orgs, "synth-orgs")
    top = orgs.filter("treated").groupBy("unit").count().orderBy(F.col("count").desc(), "unit").first()
    panel = materialize(C.supported_unit_panel(implementations(spark, sf_dir, ["org_id", "date_go_live"]), orgs,
                                               top[0] if top else ""), "synth-rates")
    donors = sorted(r[0] for r in panel.filter(F.col("unit") != C.TREATED).select("unit").distinct().collect())
    return panel, donors


@query
def synth_gram_rates(spark, sf_dir):
    panel, donors = _supported_inputs(spark, sf_dir)
    return C.gram(panel, [C.TREATED, *donors], P.DID_DATE)


@query
def synth_gap(spark, sf_dir):
    """The supported orgs against a synthetic control of unsupported ones."""
    panel, donors = _supported_inputs(spark, sf_dir)
    w = C.synth_weights(C.gram(panel, [C.TREATED, *donors], P.DID_DATE), [C.TREATED], donors)
    return C.synth_gap(panel, w, S.month_calendar(spark, P.CAL_START, P.CAL_END), [C.TREATED])


@query
def synth_placebo(spark, sf_dir):
    """Every donor in the place of the supported orgs, from the other donors."""
    panel, donors = _supported_inputs(spark, sf_dir)
    units = [C.TREATED, *donors]
    w = materialize(C.synth_weights(C.gram(panel, units, P.DID_DATE), units, donors), "synth-weights")
    gaps = materialize(C.synth_gap(panel, w, S.month_calendar(spark, P.CAL_START, P.CAL_END), units), "synth-gaps")
    return C.placebo_test(gaps, P.DID_DATE, C.TREATED)


# -- grants that start at different times (C1), matching on covariates (C2-C5) -----------------

def _staggered_inputs(spark, sf_dir):
    return implementations(spark, sf_dir, DID_COLUMNS), support_measures(spark, sf_dir)


@query
def did_event_time(spark, sf_dir):
    """Effect by quarters since an org's first large grant."""
    impl, sup = _staggered_inputs(spark, sf_dir)
    cells = materialize(SG.org_cells(impl, SG.first_grant(sup, P.LARGE_GRANT)).groupBy(*SG.CELL).agg(
        F.sum("n").alias("n"), F.sum("s").cast("decimal(38,8)").alias("s")), "cells")
    found = SG.event_time_effects(SG.cohort_effects(cells), *P.EVENT_QUARTERS)
    return found.withColumn("effect", F.round("effect", 8))


@query
def did_event_time_se(spark, sf_dir):
    impl, sup = _staggered_inputs(spark, sf_dir)
    return SG.staggered_did(impl, sup, P.LARGE_GRANT, *P.EVENT_QUARTERS)


@query
def did_event_time_bootstrap(spark, sf_dir):
    impl, sup = _staggered_inputs(spark, sf_dir)
    return SG.bootstrap_errors(SG.org_cells(impl, SG.first_grant(sup, P.LARGE_GRANT)), P.REPLICATES, *P.EVENT_QUARTERS)


COVARIATE_COLUMNS = ["org_id", "date_go_live", "capex", "revenue_uplift"]


def _covariates(spark, sf_dir):
    return MT.org_covariates(implementations(spark, sf_dir, COVARIATE_COLUMNS), support_measures(spark, sf_dir), P.DID_DATE,
                             org_places(spark, sf_dir))


@query
def match_orgs(spark, sf_dir):
    """Nearest unsupported org by size, spending and revenue (each in its own
    deviations) within the industry."""
    units = MT.standardised(materialize(_covariates(spark, sf_dir), "covariates"), MT.NUMERIC)
    found = MT.nearest_control(units, "org_id", "industry_name", P.MATCH_CALIPER, len(MT.NUMERIC))
    return found.withColumn("distance", F.round("distance", 8))


@query
def match_once(spark, sf_dir):
    """One-to-one matching on the account balance."""
    return MT.match_once(_match_units(spark, sf_dir), "c_custkey", "c_acctbal", "c_mktsegment", "treated", P.CALIPER,
                         P.CALIPER_SPLITS)


def _chain(spark, sf_dir):
    """Score, whitening and matches, written once."""
    units = MT.fitted_scores(_covariates(spark, sf_dir), MT.NUMERIC, MT.CATEGORICAL)
    units = materialize(MT.whitened(materialize(units, "scored"), ["logit", *MT.NUMERIC]), "whitened")
    dims = units.agg(F.max(F.size("z"))).first()[0] or 1
    return units, materialize(MT.nearest_control(units, "org_id", "industry_name", P.MATCH_CALIPER, dims), "chain-matches")


@query
def psm_chain_match(spark, sf_dir):
    return _chain(spark, sf_dir)[1]


@query
def psm_chain_balance(spark, sf_dir):
    units, matches = _chain(spark, sf_dir)
    return C.balance(units, matches, "org_id", "treated", ["logit", *MT.NUMERIC])


@query
def psm_chain_did(spark, sf_dir):
    _, matches = _chain(spark, sf_dir)
    return MT.matched_did(implementations(spark, sf_dir, DID_COLUMNS), matches, P.DID_DATE, P.REPLICATES)


# -- streaming (T1-T3) ------------------------------------------------------------------------



@query
def stream_survey_ingest(spark, sf_dir):
    return ST.survey_ingest(spark, table(spark, sf_dir, "events"))


@query
def stream_upsert(spark, sf_dir):
    return ST.upsert(spark, table(spark, sf_dir, "events"))


@query
def stream_daily_kpi(spark, sf_dir):
    return ST.daily_kpi(spark, table(spark, sf_dir, "events"))


@query
def refresh_commit(spark, sf_dir):
    """The refresh run twice: all four sources extracted, stored with dense
    surrogate ids and one commit per refresh; per table the committed rows
    and their id range. A refresh with a source that fails commits nothing and
    is an error: its rows would only be missing from the counts."""
    root = scratch_path(spark, "refresh")
    loaders = {
        "real_solutions": (lambda: _solutions(spark, sf_dir), K.SCHEMAS["real_solutions"]),
        "real_procurements": (lambda: _procurements(spark, sf_dir), K.SCHEMAS["real_procurements"]),
        "real_indicators": (lambda: _indicators(spark, sf_dir), K.SCHEMAS["real_indicators"]),
        "real_support_measures": (lambda: _cards(spark, sf_dir), K.SCHEMAS["real_support_measures"]),
    }
    for batch in (1, 2):
        datasets, _ = K.collect_sources(spark, loaders, every=True)
        K.save_all(spark, datasets, root, batch)
    parts = [K.read_log(spark, f"{root}/{name}", f"{root}/_manifest")
             .agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                  F.min("id").cast("long").alias("min_id"), F.max("id").cast("long").alias("max_id"))
             .select(F.lit(name).alias("table_name"), "n_rows", "min_id", "max_id")
             for name in loaders]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def procurement_blocks(spark, sf_dir):
    return _procurements(spark, sf_dir)


@query
def did_clustered_se(spark, sf_dir):
    return C.did_clustered_se(*_impl_support(spark, sf_dir, *DID_COLUMNS), P.DID_DATE)
