"""Staggered grants: planted effects, plain numpy, resampling."""
import datetime as dt
from decimal import Context, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import staggered as S

def out():
    return {"y": F.col("y").cast("decimal(18,4)")}


def day(period):
    return dt.date(period // 4, period % 4 * 3 + 2, 11)


def world(rng, orgs=240, noise=1.0):
    """Cohorts start in three different quarters; early cohorts have larger and
    growing effects; every period has a common shock and orgs differ in level."""
    first, periods = 2000 * 4, range(2000 * 4, 2000 * 4 + 12)
    shock = {p: float(rng.normal(0, 3)) for p in periods}
    rows, grants = [], []
    for org in range(orgs):
        cohort = [first + 3, first + 6, first + 9, None][org % 4]
        level = float(rng.normal(0, 2))
        if cohort:
            grants += [(org, day(cohort), 500.0), (org, day(cohort + 2), 900.0), (org, day(first), 5.0)]
        for p in periods:
            for _ in range(int(rng.integers(0, 4))):
                gain = 0.0 if cohort is None or p < cohort else {3: 10.0, 6: 4.0, 9: 1.0}[cohort - first] + 0.5 * (p - cohort)
                rows.append((org, day(p), p, cohort, round(level + shock[p] + gain + float(rng.normal(0, noise)), 4)))
    return rows, grants


def frames(spark, rows, grants):
    impl = spark.createDataFrame([(r[0], r[1], r[4]) for r in rows], "org_id long, date_go_live date, y double")
    sup = spark.createDataFrame(grants, "recipient_id long, approval_date date, amount_rub double")
    return impl, sup


def plain(rows, weight=None):
    """Event-time effects and clustered errors from the rows themselves."""
    weight = weight or {}
    y = np.array([r[4] for r in rows])
    org, period = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    cohort = np.array([r[3] or S.NEVER for r in rows])
    w = np.array([weight.get(o, 1) for o in org], float)
    effects = {}
    for g in sorted(set(cohort) - {S.NEVER}):
        for t in sorted(set(period)):
            masks = [(cohort == g) & (period == t), (cohort == g) & (period == g - 1),
                     (cohort > max(g, t)) & (period == t), (cohort > max(g, t)) & (period == g - 1)]
            if t == g - 1 or any(w[m].sum() == 0 for m in masks):
                continue
            means = [np.average(y[m], weights=w[m]) for m in masks]
            psi = sum(sign * np.where(m, w * (y - mu) / w[m].sum(), 0) for sign, m, mu in zip((1, -1, -1, 1), masks, means))
            effects[g, t] = (means[0] - means[1] - means[2] + means[3], w[masks[0]].sum(), psi, masks[0])
    out = {}
    for e in [*range(-4, 9), None]:
        some = [v for (g, t), v in effects.items() if (t - g == e if e is not None else t >= g)]
        if some:
            n = sum(v[1] for v in some)
            effect = sum(v[0] * v[1] for v in some) / n
            psi = sum(v[1] / n * v[2] + (v[0] - effect) / n * v[3] for v in some)
            out[e] = (effect, {o: psi[org == o].sum() for o in set(org)})
    return out


@pytest.fixture(scope="module")
def rows():
    return world(np.random.default_rng(3))


def test_effects_and_errors_equal_the_plain_sums(spark, rows):
    impl, sup = frames(spark, *rows)
    got = {r.event_time: r for r in S.staggered_did(impl, sup, 100.0, outcomes=out()).collect()}
    want = plain(rows[0])
    assert set(got) == set(want)
    for e, (effect, by_org) in want.items():
        g = got[e].n_orgs
        assert got[e].effect == pytest.approx(effect, abs=1e-9)
        assert got[e].se == pytest.approx(np.sqrt(sum(v * v for v in by_org.values()) * g / (g - 1)), rel=1e-9)


def test_planted_effects_are_recovered_where_one_event_date_is_biased(spark, rows):
    impl, sup = frames(spark, *rows)
    got = {r.event_time: r for r in S.staggered_did(impl, sup, 100.0, outcomes=out()).collect()}
    assert got[0].effect == pytest.approx(5.0, abs=4 * got[0].se)  # mean of 10, 4 and 1
    assert got[2].effect == pytest.approx(6.0, abs=4 * got[2].se)
    assert all(abs(got[e].effect) < 4 * got[e].se for e in (-2, -3))
    # the 2x2 form with one event date in the middle
    y = np.array([r[4] for r in rows[0]])
    t = np.array([r[3] is not None for r in rows[0]])
    post = np.array([r[2] >= 2000 * 4 + 6 for r in rows[0]])
    simple = y[t & post].mean() - y[t & ~post].mean() - y[~t & post].mean() + y[~t & ~post].mean()
    true = np.mean([{3: 10.0, 6: 4.0, 9: 1.0}[r[3] - 8000] + 0.5 * (r[2] - r[3]) for r in rows[0] if r[3] and r[2] >= r[3]])
    assert got[None].effect == pytest.approx(true, abs=4 * got[None].se) and abs(simple - true) > 1.0


def test_bootstrap_agrees_with_the_clustered_error(spark, rows):
    impl, sup = frames(spark, *rows)
    per_org = S.org_cells(impl, S.first_grant(sup, 100.0), out())
    got = {r.event_time: r for r in S.bootstrap_errors(per_org, 80).collect()}
    one = {r.event_time: r for r in S.staggered_did(impl, sup, 100.0, outcomes=out()).collect()}
    for e in (None, 0, 2):
        assert got[e].replicates == 80 and got[e].se_bootstrap == pytest.approx(one[e].se, rel=0.35)
        assert got[e].low < one[e].effect < got[e].high


def test_replicates_equal_weighted_plain_sums(spark, rows):
    impl, sup = frames(spark, *rows)
    cells = S.resampled(S.org_cells(impl, S.first_grant(sup, 100.0), out()), "org_id", S.CELL, 3)
    got = {(r.replicate, r.event_time): r.effect for r in S.event_time_effects(
        S.cohort_effects(cells, ["replicate"]), keys=["replicate"]).collect()}
    drawn = spark.range(240).select("id", *[S.poisson_weight(F.col("id"), F.lit(k)).alias(f"w{k}") for k in range(3)]).collect()
    for k in range(3):
        for e, (effect, _) in plain(rows[0], {r.id: r[f"w{k}"] for r in drawn}).items():
            assert got[k, e] == pytest.approx(effect, abs=1e-9)


def test_poisson_weights(spark):
    w = np.array([r[0] for r in spark.range(20000).select(S.poisson_weight(F.col("id"), F.lit(7))).collect()])
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05
    assert abs((w == 0).mean() - np.exp(-1)) < 0.015


def test_nobody_supported_and_no_rollouts(spark, rows):
    impl, sup = frames(spark, *rows)
    assert S.staggered_did(impl, sup, 1e9, outcomes=out()).count() == 0
    assert S.staggered_did(impl.limit(0), sup, outcomes=out()).count() == 0


def test_weights_of_a_task_are_those_of_the_column(spark):
    units = spark.range(-150, 150).select(F.when(F.col("id") != 0, F.col("id")).alias("id"))
    rows = units.select(F.xxhash64(F.lit("bootstrap"), "id").alias("seed"),
                        F.array(*[S.poisson_weight(F.col("id"), F.lit(k)) for k in range(20)]).alias("w")).collect()
    got = S.poisson_weights(np.array([r.seed for r in rows]), 20)
    assert got.tolist() == [r.w for r in rows]


def test_resampled_sums_are_exact_and_rows_are_not_repeated(spark):
    big = [Decimal("-12345678901234567890.12345678"), Decimal("0.00000001"), Decimal("-0.5"), Decimal("99999999999.99999999")]
    rows = [(i % 40, ["a", "b", None][i % 3], i % 2 == 0, i % 5, big[i % 4] * (i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "unit long, outcome string, post boolean, n long, s decimal(38,8)").repartition(3)
    got = S.resampled(df, "unit", ["outcome", "post"], 12)
    assert "Generate" not in got._jdf.queryExecution().toString()
    weight = {r.id: r.w for r in spark.range(40).select("id", F.array(*[S.poisson_weight(F.col("id"), F.lit(k)) for k in range(12)]).alias("w")).collect()}
    want = {}
    for unit, outcome, post, n, s in rows:
        for k, w in enumerate(weight[unit]):
            if w:
                a, b = want.get((k, outcome, post), (0, Decimal(0)))
                want[k, outcome, post] = a + w * n, Context(prec=60).add(b, Context(prec=60).multiply(s, w))
    assert {(r.replicate, r.outcome, r.post): (r.n, r.s) for r in got.collect()} == want


def test_influences_are_not_grouped_by_event_time(spark):
    """An org's influences on all event times come from one row of weights."""
    per_org = spark.createDataFrame([("y", c, p, o, 1, Decimal(o)) for o, c in ((1, 8), (2, 9), (3, S.NEVER), (4, S.NEVER)) for p in range(5, 12)],
                                    "outcome string, cohort int, period int, org_id long, n long, s decimal(38,8)")
    effects = S.cohort_effects(per_org.groupBy(*S.CELL).agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    errors = S.influence_errors(per_org, effects)
    assert {r.n_orgs for r in errors.collect()} <= {3, 4}
    plan = errors._jdf.queryExecution().optimizedPlan().toString()
    assert not any("org_id" in line and "event_time" in line for line in plan.splitlines() if "Aggregate [" in line)
