import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import causal as C
from tidewater.operators import metrics as M

IMPL = ("impl_key string, org_id long, date_go_live date, revenue_uplift decimal(18,4), "
        "opex_delta decimal(18,4), capex decimal(12,2)")
SUP = "support_id long, program_name string, recipient_id long, amount_rub decimal(12,2), approval_date date"


def test_roi_attributes_effect_to_latest_grant_only(spark):
    impl = spark.createDataFrame(
        [("i1", 7, dt.date(2020, 6, 1), Decimal(100), Decimal(0), Decimal(1))], IMPL)
    sup = spark.createDataFrame(
        [(1, "early", 7, Decimal(10), dt.date(2020, 1, 1)),
         (2, "late", 7, Decimal(20), dt.date(2020, 3, 1))], SUP)
    out = {r.program_name: r for r in M.roi_by_program(impl, sup, 36).collect()}
    assert out["late"].effect_total == 100.0 and out["late"].n_attributed == 1
    assert out["early"].effect_total == 0.0 and out["early"].grant_total == 10.0
    assert out["early"].roi_pct == -100.0


def test_asof_attribution_equals_brute_force(spark):
    rnd = random.Random(3)
    impls = [(f"i{i}", rnd.randint(1, 4), dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60)),
              Decimal(1), Decimal(0), Decimal(1)) for i in range(300)]
    grants = [(j, "p", rnd.randint(1, 4), Decimal(1),
               dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60))) for j in range(80)]
    got = {r.impl_key: r.support_id for r in M.attributed(
        spark.createDataFrame(impls, IMPL), spark.createDataFrame(grants, SUP), 36).collect()}
    want = {}
    for key, org, d, *_ in impls:
        cands = [(g[4], -g[0]) for g in grants if g[2] == org and g[4] <= d]
        if cands:
            want[key] = -max(cands)[1]
    assert got == want


def test_did_recovers_planted_effect(spark):
    rows = []
    for treated, base, jump in ((True, 10, 4), (False, 10, 1)):
        for post in (False, True):
            for k in range(3):
                rows.append((treated, post, Decimal(base + (jump if post else 0) + k - 1)))
    long = spark.createDataFrame(rows, "treated boolean, post boolean, y decimal(20,8)").withColumn(
        "outcome", F.lit("y"))
    eff = C.did_effect(C.moment_cells(long, ["outcome", "treated", "post"])).first()
    assert abs(eff.effect - 3.0) < 1e-12


def test_matching_equals_brute_force_and_respects_caliper(spark):
    rnd = random.Random(11)
    units = [(i, round(rnd.uniform(0, 100), 2), rnd.choice("xy"), rnd.random() < 0.3)
             for i in range(200)]
    df = spark.createDataFrame(units, "id long, s double, st string, t boolean")
    cal = 3.0
    got = {r.treated_id: (r.control_id, r.distance)
           for r in C.nearest_match(df, "id", "s", "st", "t", cal, 4).collect()}
    want = {}
    for i, s, st, t in units:
        if not t:
            continue
        c = sorted((abs(s - s2), j) for j, s2, st2, t2 in units if not t2 and st2 == st
                   and abs(s - s2) <= cal)
        if c:
            want[i] = (c[0][1], c[0][0])
    assert got == want
    assert all(d <= cal for _, d in got.values())


def test_synthetic_control_recovers_weights(spark):
    rnd = np.random.default_rng(5)
    months = [dt.date(2019, 1, 31) + dt.timedelta(days=31 * m) for m in range(24)]
    a, b, c = rnd.normal(50, 10, 24), rnd.normal(50, 10, 24), rnd.normal(50, 10, 24)
    y = 0.3 * a + 0.7 * b
    rows = [(u, m, float(v)) for u, series in (("A", a), ("B", b), ("C", c), ("T", y))
            for m, v in zip(months, series)]
    panel = spark.createDataFrame(rows, "unit string, date_month date, y double")
    # gram() expects integer outcomes; build the Gram here from the double panel
    g = (panel.alias("p").join(panel.alias("q"), "date_month")
         .groupBy(F.col("p.unit").alias("unit_i"), F.col("q.unit").alias("unit_j"))
         .agg(F.sum(F.col("p.y") * F.col("q.y")).alias("g")))
    w = {r.donor: r.weight for r in C.synth_weights(g, ["T"]).collect()}
    assert abs(w["A"] - 0.3) < 1e-4 and abs(w["B"] - 0.7) < 1e-4 and abs(w["C"]) < 1e-4
    cal = spark.createDataFrame([(m,) for m in months], "date_month date")
    gap = C.synth_gap(panel, C.synth_weights(g, ["T"]), cal, ["T"])
    assert gap.agg(F.max(F.abs("gap"))).first()[0] < 1e-2


def test_simplex_weights_never_worse_than_uniform():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(30, 5))
    y = rnd.normal(size=30)
    g, b = x.T @ x, x.T @ y
    w = C.simplex_weights(g, b)
    u = np.full(5, 0.2)
    assert w.min() >= 0 and abs(w.sum() - 1) < 1e-9
    assert np.sum((y - x @ w) ** 2) <= np.sum((y - x @ u) ** 2) + 1e-9


def test_exact_quantile_matches_numpy_on_skewed_groups(spark):
    rnd = random.Random(2)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice("abc"), float(rnd.randint(0, 50)))
            for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r.q for r in M.exact_quantile(df, "g", "v", 0.5).collect()}
    for g in got:
        assert got[g] == float(np.quantile([v for k, v in rows if k == g], 0.5))


def test_star_dims_are_distinct_natural_keys(spark, sf_dir):
    from tidewater.sources.testdata import implementations
    impl = implementations(spark, sf_dir)
    dims = M.star_dims(impl)
    assert dims["dim_vendor"].count() == impl.select("vendor_name").distinct().count()
    fact = M.star_fact(impl)
    assert fact.join(dims["dim_org"], ["org_id", "region_name", "industry_name"], "left_anti").count() == 0


def test_roi_exact_when_one_org_holds_a_third_of_rows(spark, sf_dir):
    from pyspark.sql.window import Window
    from tidewater.sources.testdata import implementations, support_measures
    hot = 3
    impl = implementations(spark, sf_dir).withColumn(
        "org_id", F.when(F.xxhash64("impl_key") % 3 == 0, F.lit(hot)).otherwise(F.col("org_id")))
    sup = support_measures(spark, sf_dir)
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = sorted(tuple(r) for r in M.roi_by_program(impl, sup, 36).collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    # brute force: every (rollout, earlier grant of its org) pair, latest grant wins
    pairs = (impl.join(sup, (impl.org_id == sup.recipient_id) & (sup.approval_date <= impl.date_go_live))
             .withColumn("rn", F.row_number().over(Window.partitionBy("impl_key").orderBy(
                 F.col("approval_date").desc(), F.col("support_id").asc())))
             .filter("rn = 1")
             .filter(F.col("date_go_live") <= F.add_months("approval_date", 36)))
    eff = {r[0]: (r[1], r[2]) for r in pairs.groupBy("program_name").agg(
        F.sum(F.col("revenue_uplift") + F.col("opex_delta")), F.count(F.lit(1))).collect()}
    for program, grant_total, effect_total, n, _ in got:
        e, c = eff.get(program, (0, 0))
        assert (effect_total, n) == (float(e), c)


def test_did_clustered_se_matches_numpy(spark):
    rnd = np.random.default_rng(9)
    rows = []
    for org in range(40):
        treated = org < 15
        for _ in range(int(rnd.integers(2, 12))):
            post = bool(rnd.random() < 0.5)
            rows.append((f"i{len(rows)}", org, dt.date(2020, 6, 1) if post else dt.date(2019, 6, 1),
                         int(rnd.integers(-50, 50)), treated))
    impl = spark.createDataFrame(
        [(k, o, d, lt, Decimal(1), Decimal(0), Decimal(1), 0.0, Decimal(0))
         for k, o, d, lt, _ in rows],
        "impl_key string, org_id long, date_go_live date, lead_time_delta long, "
        "revenue_uplift decimal(18,4), opex_delta decimal(18,4), capex decimal(12,2), "
        "inv_turnover_delta double, penalties_delta decimal(18,4)")
    sup = spark.createDataFrame([(o, "p", o, Decimal(1), dt.date(2019, 1, 1)) for o in range(15)], SUP)
    got = {r.outcome: r for r in C.did_clustered_se(impl, sup, "2020-01-01").collect()}["lead_time_delta"]
    y = np.array([r[3] for r in rows], float)
    t = np.array([r[4] for r in rows])
    p = np.array([r[2] >= dt.date(2020, 1, 1) for r in rows])
    org = np.array([r[1] for r in rows])
    psi = np.zeros(len(rows))
    effect = 0.0
    for tv in (True, False):
        for pv in (True, False):
            m = (t == tv) & (p == pv)
            sgn = 1.0 if tv == pv else -1.0
            effect += sgn * y[m].mean()
            psi[m] = sgn * (y[m] - y[m].mean()) / m.sum()
    s = np.array([psi[org == g].sum() for g in np.unique(org)])
    g = len(s)
    assert abs(got.effect - effect) < 1e-9
    assert abs(got.se_cluster - np.sqrt((s ** 2).sum() * g / (g - 1))) < 1e-9
    assert got.n_clusters == g


def test_simplex_reaches_the_optimum_on_collinear_donors():
    rng = np.random.default_rng(3)
    base = rng.poisson(40, (40, 1)) + rng.poisson(3, (40, 24))
    y, x = base[:, 0].astype(float), base[:, 1:].astype(float)
    g, b = x.T @ x, x.T @ y
    w = C.simplex_weights(g, b)
    assert C.duality_gap(g, b, w) <= 1e-6 * np.diag(g).max() and abs(w.sum() - 1) < 1e-9 and w.min() >= 0


def test_matches_at_the_edge_of_the_caliper(spark):
    rows = [(1, 0.075, "a", True), (2, 0.125, "a", False)]
    df = spark.createDataFrame(rows, "id long, s double, st string, t boolean")
    assert C.nearest_match(df, "id", "s", "st", "t", 0.05, 4).count() == 1


def test_placebo_without_a_ratio_has_no_p_value(spark):
    rows = [(u, dt.date(2000, m, 28), g) for u, pre, post in (("A", 0.0, 5.0), ("B", 1.0, 2.0), ("C", 2.0, 2.0))
            for m, g in ((1, pre), (2, post))]
    gaps = spark.createDataFrame(rows, "treated_unit string, date_month date, gap double")
    assert {r.p_value for r in C.placebo_test(gaps, "2000-02-01", "A").collect()} == {None}
    assert {r.p_value for r in C.placebo_test(gaps, "2000-02-01", "B").collect()} == {0.5}


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile_by_counts(spark, p):
    """Heavy tails, ties, one value with most rows, groups of one and two rows."""
    rnd = np.random.default_rng(6)
    groups = {"tail": np.exp(rnd.normal(0, 9, 501)), "ties": rnd.integers(0, 4, 400) / 4, "one": np.array([3.25]),
              "two": np.array([-1e9, 1e-9]), "hot": np.concatenate([np.full(900, 7.125), rnd.normal(7, 1e-7, 301)])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("ties", None), (None, 1.0), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: r.q for r in M.exact_quantile(df, "g", "v", p).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx(float(np.quantile(vs, p)), rel=1e-12)



def test_did_clustered_se_reads_the_rollouts_once(spark, sf_dir):
    """Sums per org are written once; cells and influences are both taken from them."""
    from tidewater.plans import catalog

    files = catalog.CATALOG["did_clustered_se"](spark, sf_dir).inputFiles()
    assert files and all("cluster-sums" in f for f in files)
