import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators import summaries as S

IMPL_SCHEMA = ("impl_key string, region_name string, date_go_live date, is_domestic boolean, "
               "capex decimal(12,2), revenue_uplift decimal(18,4), opex_delta decimal(18,4), "
               "status string, industry_name string")


def impl(spark, rows):
    return spark.createDataFrame(rows, IMPL_SCHEMA)


def row(key, region, day, dom=True, capex=10, status="go-live"):
    from decimal import Decimal
    return (key, region, day, dom, Decimal(capex), Decimal(capex), Decimal(0), status, "I")


def test_null_group_key_dropped_and_sum_of_nulls(spark):
    d = dt.date(2020, 1, 5)
    df = impl(spark, [row("1", "a", d), row("2", None, d), row("3", "b", d, capex=5)])
    df = df.withColumn("capex", F.when(F.col("region_name") == "b", None).otherwise(F.col("capex")))
    out = {r.region_name: r for r in S.regional_summary(df).collect()}
    assert set(out) == {"a", "b"}
    assert out["b"].capex_total == 0.0 and out["b"].impl_count == 1


def test_tie_at_rank_ten_keeps_first_keys(spark):
    d = dt.date(2020, 1, 5)
    rows = [row(str(i), f"r{i:02d}", d) for i in range(12)]
    got = [r.region_name for r in S.regional_summary(impl(spark, rows)).collect()]
    assert got == [f"r{i:02d}" for i in range(10)]


def test_cutoff_day_is_excluded(spark):
    # as_of 2020-12-31, 12 months back -> cutoff 2020-01-05 (360 days)
    cutoff = dt.date(2020, 12, 31) - dt.timedelta(days=360)
    rows = [row(str(i), "a", cutoff + dt.timedelta(days=i)) for i in (-1, 0, 1)]
    got = [r.impl_key for r in S.recent(impl(spark, rows), "date_go_live", "2020-12-31", 12).collect()]
    assert got == ["1"]


def test_empty_month_gets_zeros(spark):
    rows = [row("1", "a", dt.date(2020, 1, 5), dom=True), row("2", "a", dt.date(2020, 3, 5), dom=False)]
    out = S.kpi_monthly(spark, impl(spark, rows), "2020-01-01", "2020-03-31").orderBy("date_month")
    got = [(r.date_month, r.impl_count, r.domestic_share_pct, r.avg_econ_effect) for r in out.collect()]
    assert got == [(dt.date(2020, 1, 31), 1, 100.0, 10.0), (dt.date(2020, 2, 29), 0, 0.0, 0.0),
                   (dt.date(2020, 3, 31), 1, 0.0, 10.0)]


def test_statuses_filter_readme_form(spark):
    rows = [row("1", "a", dt.date(2020, 1, 5), status="pilot"),
            row("2", "a", dt.date(2020, 1, 6), status="go-live")]
    out = S.kpi_monthly(spark, impl(spark, rows), "2020-01-01", "2020-01-31", ["go-live", "pilot_ok"])
    assert out.first().impl_count == 1


def test_cards_on_empty_input_give_no_row(spark):
    kpi = S.kpi_monthly(spark, impl(spark, []), "2020-01-01", "2020-02-28").filter("false")
    assert S.kpi_cards(kpi).count() == 0


def test_rollup_total_equals_rows_in_range(spark, sf_dir):
    from tidewater.sources.testdata import implementations
    im = implementations(spark, sf_dir)
    kpi = S.kpi_monthly(spark, im, "1995-01-01", "2002-03-31")
    assert kpi.agg(F.sum("impl_count")).first()[0] == im.count()


def test_industry_shares_sum_to_100(spark, sf_dir):
    from tidewater.sources.testdata import implementations
    share = S.industry_share(implementations(spark, sf_dir))
    assert abs(share.agg(F.sum("share_pct")).first()[0] - 100.0) < 1e-9


def test_cube_totals_equal_leaf_sums(spark, sf_dir):
    from tidewater.operators import metrics as M
    from tidewater.sources.testdata import implementations
    cube = M.domestic_cube(implementations(spark, sf_dir), ["industry_name", "region_name", "class_scm"])
    grand = cube.filter("gid = 7").first()
    leaves = cube.filter("gid = 0").agg(F.sum("impl_count"), F.sum("domestic_count")).first()
    assert (grand.impl_count, grand.domestic_count) == (leaves[0], leaves[1])
    by_ind = cube.filter("gid = 3").agg(F.sum("impl_count")).first()[0]
    assert by_ind == grand.impl_count


def test_materialized_fact_gives_the_same_answers(spark, sf_dir):
    from tidewater.plans import catalog
    from tidewater.session import scratch_path
    from tidewater.sources import testdata as TD
    base = sorted(catalog.regional_summary(spark, sf_dir).collect())
    path = scratch_path(spark, "fact")
    TD.write_fact(spark, sf_dir, path)
    spark.conf.set(TD.fact_conf(sf_dir), path)
    try:
        impl = catalog.S.recent(TD.implementations(spark, sf_dir), "date_go_live", catalog.P.AS_OF)
        plan = impl._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(date_go_live), GreaterThan(date_go_live" in plan
        assert sorted(catalog.regional_summary(spark, sf_dir).collect()) == base
        other = sf_dir.replace("sf0.001", "sf0.01")  # another source is not answered from this fact
        assert TD.implementations(spark, other, ["capex"]).count() > 5 * impl.sparkSession.read.parquet(path).count()
        src = TD._implementations_from_sources(spark, sf_dir, list(TD.VIEW)).schema
        assert [(f.name, f.dataType) for f in impl.schema] == [(f.name, f.dataType) for f in src]
    finally:
        spark.conf.unset(TD.fact_conf(sf_dir))
