"""Matching on several covariates against all pairs and plain sequential code."""
import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import matching as M
from tidewater.operators import staggered as S
from tidewater.plans import catalog

SCHEMA = "id long, stratum string, treated boolean, z array<double>"


def all_pairs(rows, caliper):
    out = []
    for i, s, t, z in rows:
        if t:
            near = [(float(np.sqrt(sum((a - b) * (a - b) for a, b in zip(z, w)))), j) for j, r, c, w in rows if not c and r == s]
            near = [n for n in near if n[0] <= caliper]
            if near:
                out.append((i, min(near)[1], s, min(near)[0]))
    return sorted(out)


def points(rng, n, dims):
    """Clusters of very different density, far points, repeated points."""
    centres = rng.normal(0, 3, (4, dims))
    rows = []
    for i in range(n):
        kind = rng.integers(4)
        z = {0: centres[0] + rng.normal(0, 0.01, dims), 1: centres[1] + rng.normal(0, 1, dims),
             2: rng.normal(0, 8, dims), 3: np.round(rng.normal(0, 1, dims))}[int(kind)]
        rows.append((int(i * 7 % (7 * n + 1)), "ab"[int(rng.integers(2))], bool(rng.random() < 0.4), [float(x) for x in z]))
    return rows


@pytest.mark.parametrize("dims,caliper,levels", [(1, 0.5, 7), (2, 0.7, 4), (3, 2.0, 7), (3, 1.0, 1)])
def test_nearest_equals_all_pairs(spark, dims, caliper, levels):
    rows = points(np.random.default_rng(dims), 500, dims)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in M.nearest_control(df, "id", "stratum", caliper, dims, levels=levels).collect())
    want = all_pairs(rows, caliper)
    assert [g[:3] for g in got] == [w[:3] for w in want] and len(want) > 30
    assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_cells_around_a_point_are_compiled(spark):
    """Four dimensions have 81 cells around a point: still code that Spark can compile."""
    rows = points(np.random.default_rng(4), 200, 4)
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        got = sorted(tuple(r)[:3] for r in M.nearest_control(spark.createDataFrame(rows, SCHEMA), "id", "stratum", 3.0, 4).collect())
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
    assert got == [w[:3] for w in all_pairs(rows, 3.0)] and len(got) > 10


@pytest.mark.parametrize("query", ["psm_chain_did", "psm_chain_balance"])
def test_the_chain_sends_no_orgs_through_the_driver(spark, sf_dir, monkeypatch, query):
    """Orgs, matches and cells are merged, however few bytes their files have; what the rollout
    view joins (orders, nations) is left to the planner."""
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    for module in (M, catalog):
        monkeypatch.setattr(module, "materialize", lambda d, name, write=module.materialize: write(seen(d), name))
    final = catalog.CATALOG[query](spark, sf_dir)
    if query == "psm_chain_balance":
        seen(final)
    joins = re.findall(r"Broadcast\w*Join (?:\[(\w+)|\w+)", "".join(plans))
    assert len(plans) > 8 and set(joins) <= {"l_orderkey", "c_nationkey"}


def test_covariates_of_orgs_given_apart(spark):
    """Same rows whether the rollouts carry industry and region or the orgs do; an org listed twice counts twice."""
    day = dt.date(1999, 1, 1)
    rollouts = [(1, day, 1.0, 2.0), (1, day, 3.0, None), (2, day, -9.0, 0.0), (3, day, 1.0, 1.0), (None, day, 1.0, 1.0), (1, dt.date(2001, 1, 1), 7.0, 7.0)]
    places = [(1, "b", "x"), (1, "a", "y"), (2, None, "x"), (4, "a", "a"), (None, "a", "a")]
    impl = spark.createDataFrame(rollouts, "org_id long, date_go_live date, capex double, revenue_uplift double")
    orgs = spark.createDataFrame(places, "org_id long, industry_name string, region_name string")
    support = spark.createDataFrame([(2,)], "recipient_id long")
    order = ["org_id", "treated", "n_impl", "capex_total", "revenue_total", "industry_name", "region_name"]
    got, want = (sorted(map(tuple, d.select(order).collect()), key=str) for d in (
        M.org_covariates(impl, support, "2000-01-01", orgs), M.org_covariates(impl.join(orgs, "org_id"), support, "2000-01-01")))
    assert got == want and [g[0] for g in got] == [1, 2]


def test_nulls_and_empty(spark):
    rows = [(1, "a", True, [0.0]), (2, "a", False, [None]), (3, None, False, [0.0]), (4, "a", False, [float("nan")]), (5, "a", False, [0.25])]
    got = M.nearest_control(spark.createDataFrame(rows, SCHEMA), "id", "stratum", 1.0, 1).collect()
    assert [(r.treated_id, r.control_id, r.distance) for r in got] == [(1, 5, 0.25)]
    assert M.nearest_control(spark.createDataFrame([], SCHEMA), "id", "stratum", 1.0, 1).count() == 0


def sequential(rows, caliper):
    """Take the nearest free pair again and again."""
    pairs = sorted((abs(a[1] - b[1]), a[0], b[0], a[2]) for a in rows if a[3] for b in rows
                   if not b[3] and a[2] == b[2] and abs(a[1] - b[1]) <= caliper)
    used_t, used_c, out = set(), set(), []
    for d, t, c, s in pairs:
        if t not in used_t and c not in used_c:
            used_t.add(t)
            used_c.add(c)
            out.append((t, c, s, d))
    return sorted(out)


@pytest.mark.parametrize("digits", [3, 0])
def test_once_equals_the_sequential_order(spark, digits):
    rng = np.random.default_rng(digits)
    rows = [(int(i), float(np.round(rng.normal(0, 6), digits)), "ab"[int(rng.integers(2))], bool(rng.random() < 0.5)) for i in range(160)]
    df = spark.createDataFrame(rows, "id long, s double, stratum string, t boolean")
    got = sorted(tuple(r) for r in M.match_once(df, "id", "s", "stratum", "t", 2.0).collect())
    assert [g[:3] for g in got] == [w[:3] for w in sequential(rows, 2.0)]


def test_many_units_of_one_score_are_paired_in_few_rounds(spark, monkeypatch):
    """Counted ties on both sides, rows of equal steps, and 60 units of a score."""
    rows, at = [], iter(np.random.default_rng(8).permutation(2000).tolist())
    for s, t, n in ((0.0, True, 60), (1.0, False, 60), (10.0, True, 50), (9.0, False, 20), (11.0, False, 20),
                    (20.0, False, 30), (19.0, True, 9), (21.0, True, 9), (30.0, True, 3), (31.0, False, 4), (32.0, True, 3), (33.0, False, 2),
                    (40.0, True, 40), (41.5, False, 30), (42.5, True, 20)):
        rows += [(next(at), s, "a", t) for _ in range(n)]
    df = spark.createDataFrame(rows, "id long, s double, stratum string, t boolean")
    writes = []
    monkeypatch.setattr(M, "materialize", lambda d, name, write=M.materialize: writes.append(name) or write(d, name))
    got = sorted(tuple(r) for r in M.match_once(df, "id", "s", "stratum", "t", 2.0).collect())
    assert [g[:3] for g in got] == [w[:3] for w in sequential(rows, 2.0)]
    assert writes.count("once-round") <= 10


def test_whitening_gives_unit_covariance_and_drops_dependent_directions(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 2)) @ np.array([[3.0, 1.0], [0.0, 0.1]])
    df = spark.createDataFrame([(float(a), float(b), float(a + b)) for a, b in x], "a double, b double, c double")
    z = np.array([r.z for r in M.whitened(df, ["a", "b", "c"]).collect()])
    assert z.shape[1] == 2 and np.allclose(np.cov(z.T), np.eye(2), atol=1e-6)


def test_covariates_do_not_sort_the_rollouts(spark):
    """An org of two industries keeps the least; the rollouts themselves are hashed, not sorted."""
    day = dt.date(1999, 1, 1)
    impl = spark.createDataFrame([(1, day, 1.0, 2.0, "b", "x"), (1, day, 3.0, 2.0, "a", "y"), (1, day, 5.0, None, "b", None), (2, day, -9.0, 0.0, None, "x"),
                                  (2, dt.date(2001, 1, 1), 7.0, 7.0, "a", "a")],
                                 "org_id long, date_go_live date, capex double, revenue_uplift double, industry_name string, region_name string")
    support = spark.createDataFrame([(2, day, 1.0)], "recipient_id long, approval_date date, amount_rub double")
    df = M.org_covariates(impl, support, "2000-01-01")
    got = {r.org_id: r for r in df.collect()}
    assert np.allclose([got[1].n_impl, got[1].capex_total, got[1].revenue_total], np.log1p([3, 9, 4]))
    assert (got[1].industry_name, got[1].region_name, got[1].treated) == ("a", "x", False)
    assert np.allclose([got[2].n_impl, got[2].capex_total, got[2].revenue_total], np.log1p([1, 0, 0]))
    assert (got[2].industry_name, got[2].region_name, got[2].treated) == (None, "x", True)
    steps = [line for line in M.org_covariates(impl, support, "2000-01-01")._jdf.queryExecution().sparkPlan().toString().splitlines()
             if "Aggregate(" in line and "capex" in line]
    assert "HashAggregate" in steps[-1]


@pytest.fixture(scope="module")
def chain(spark):
    """Large orgs are supported more often and improve faster on their own;
    support adds 3."""
    rng = np.random.default_rng(5)
    impl, grants = [], []
    for org in range(300):
        size = float(rng.normal(0, 1))
        treated = rng.random() < 1 / (1 + np.exp(-1.5 * size))
        if treated:
            grants.append((org, dt.date(2000, 1, 1), 1.0))
        for post in (False, True):
            for _ in range(4):
                gain = (3.0 if treated else 0.0) + 4.0 * size if post else 0.0
                impl.append((org, dt.date(2001 if post else 1999, 3, 1), float(np.round(gain + rng.normal(0, 0.5), 3)),
                             float(np.exp(3 + size)), float(np.exp(2 + size)), "ab"[org % 2], "x"))
    return (spark.createDataFrame(impl, "org_id long, date_go_live date, y double, capex double, revenue_uplift double, "
                                        "industry_name string, region_name string"),
            spark.createDataFrame(grants, "recipient_id long, approval_date date, amount_rub double"))


def test_score_match_balance_and_did(spark, chain):
    impl, support = chain
    y = {"y": F.col("y").cast("decimal(18,4)")}
    units = M.fitted_scores(M.org_covariates(impl, support, "2000-06-01"), M.NUMERIC, M.CATEGORICAL)
    units = M.whitened(units, ["logit", *M.NUMERIC])
    dims = len(units.first().z)
    matches = M.nearest_control(units, "org_id", "industry_name", 1.0, dims)
    rows = [(r.org_id, r.industry_name, r.treated, r.z) for r in units.collect()]
    assert sorted((r.treated_id, r.control_id) for r in matches.collect()) == [p[:2] for p in all_pairs(rows, 1.0)]
    r = M.matched_did(impl, matches, "2000-06-01", 100, y).first()
    naive = M.matched_did(impl, units.crossJoin(units.limit(1)).filter("1 = 0").select(
        F.lit(0).alias("treated_id"), F.lit(0).alias("control_id")), "2000-06-01", 5, y)
    assert naive.count() == 0
    assert abs(r.effect - 3.0) < 4 * r.se + 0.5 and r.low < r.effect < r.high


def test_bootstrap_error_equals_numpy(spark, chain):
    impl, _ = chain
    y = {"y": F.col("y").cast("decimal(18,4)")}
    pairs = [(t, 150 + t % 40) for t in range(100)]
    matches = spark.createDataFrame(pairs, "treated_id long, control_id long")
    got = M.matched_did(impl, matches, "2000-06-01", 60, y).first()
    weight = {True: {t: 1 for t, _ in pairs}, False: {}}
    for _, c in pairs:
        weight[False][c] = weight[False].get(c, 0) + 1
    rows = [(r.org_id, r.date_go_live.year == 2001, r.y) for r in impl.collect()]
    drawn = {r.id: r for r in spark.range(300).select(
        "id", *[S.poisson_weight(F.col("id"), F.lit(k)).alias(f"w{k}") for k in range(60)]).collect()}

    def effect(w):
        total = 0.0
        for t in (True, False):
            for p in (True, False):
                some = [(v, weight[t][o] * w(o)) for o, post, v in rows if o in weight[t] and post == p]
                total += (1 if t == p else -1) * sum(v * k for v, k in some) / sum(k for _, k in some)
        return total

    effects = [effect(lambda o, k=k: drawn[o][f"w{k}"]) for k in range(60)]
    assert got.effect == pytest.approx(effect(lambda o: 1), abs=1e-9)
    assert got.se == pytest.approx(np.std(effects, ddof=1), rel=1e-9)
