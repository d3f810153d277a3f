"""Impact estimators declared by the README: DID, propensity matching with a
balance table, DID on the matched sample, synthetic control with placebos.

Scale rules:
  * DID cells are exact decimal sums (sum y, sum y^2, n), so cell means and
    variances do not depend on row order;
  * nearest-neighbour matching never emits all pairs of a stratum: rows go to
    (stratum, sub-bucket) groups of width caliper/k; a treated row meets the
    as-of neighbours inside its own sub-bucket and only the extreme control
    of each of the k sub-buckets on either side: at most 2 + 2k candidates;
  * synthetic control works on the unit x unit Gram matrix (months joined with
    themselves, summed in Spark); the simplex weights are solved per treated
    unit in tasks, from that matrix as one row of checked size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewater.functions.columns import month_end
from tidewater.session import materialize


# -- C1: difference in differences ------------------------------------------------------------

def did_outcomes() -> dict[str, Column]:
    """Outcomes as exact decimals (margin is our stand-in: effect / capex)."""
    margin = F.when(F.col("capex") > 0,
                    (F.col("revenue_uplift") + F.col("opex_delta")).cast("double")
                    / F.col("capex").cast("double"))
    return {
        "lead_time_delta": F.col("lead_time_delta").cast("decimal(12,0)"),
        "inv_turnover_delta": F.col("inv_turnover_delta").cast("decimal(12,4)"),
        "penalties_delta": F.col("penalties_delta").cast("decimal(18,4)"),
        "margin": margin.cast("decimal(18,8)"),
    }


def treated_orgs(support: DataFrame) -> DataFrame:
    return support.select(F.col("recipient_id").alias("org_id")).distinct().withColumn(
        "treated", F.lit(True))


def moment_cells(long: DataFrame, by: list[str], y: str = "y", w: Column | None = None) -> DataFrame:
    """n, mean and sample variance per cell from exact sums (weights optional)."""
    wc = w if w is not None else F.lit(1)
    yv = F.col(y)
    agg = (long.filter(yv.isNotNull()).groupBy(*by)
           .agg(F.sum(wc).cast("long").alias("n"),
                F.sum(yv * wc).alias("s1"), F.sum(yv * yv * wc).alias("s2")))
    n = F.col("n").cast("double")
    s1, s2 = F.col("s1").cast("double"), F.col("s2").cast("double")
    return agg.select(*by, "n", (s1 / n).alias("mean"),
                      F.when(F.col("n") > 1, (s2 - s1 * s1 / n) / (n - 1.0)).alias("var"))


def did_cells(impl: DataFrame, support: DataFrame, event_date: str) -> DataFrame:
    """n, mean and variance per (outcome, treated, post).

    One grouped pass over the rollouts computes count, sum and sum of squares
    of every outcome at once (four cells); only that tiny result is turned
    into one row per outcome.
    """
    outs = did_outcomes()
    flagged = (impl.join(treated_orgs(support), "org_id", "left")
               .select(F.coalesce("treated", F.lit(False)).alias("treated"),
                       (F.col("date_go_live") >= F.to_date(F.lit(event_date))).alias("post"),
                       *[c.alias(n) for n, c in outs.items()]))
    aggs = []
    for n in outs:
        y = F.col(n)
        aggs += [F.count(y).alias(f"{n}__n"),
                 F.sum(y).cast("decimal(38,8)").alias(f"{n}__s1"),
                 F.sum(y * y).cast("decimal(38,16)").alias(f"{n}__s2")]
    wide = flagged.groupBy("treated", "post").agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("outcome"), F.col(f"{n}__n").alias("n"),
                 F.col(f"{n}__s1").alias("s1"), F.col(f"{n}__s2").alias("s2"))
        for n in outs]))
    long = wide.select("treated", "post", rows.alias("r")).select("r.outcome", "treated", "post",
                                                                   "r.n", "r.s1", "r.s2")
    n = F.col("n").cast("double")
    s1, s2 = F.col("s1").cast("double"), F.col("s2").cast("double")
    return long.filter(F.col("n") > 0).select(
        "outcome", "treated", "post", F.col("n").cast("long").alias("n"), (s1 / n).alias("mean"),
        F.when(F.col("n") > 1, (s2 - s1 * s1 / n) / (n - 1.0)).alias("var"))


def did_effect(cells: DataFrame) -> DataFrame:
    """(T1 - T0) - (C1 - C0) per outcome; SE = sqrt(sum of var / n) over cells."""
    def pick(t: bool, p: bool, c: str) -> Column:
        return F.max(F.when((F.col("treated") == t) & (F.col("post") == p), F.col(c)))
    se_part = F.sum(F.col("var") / F.col("n"))
    out = cells.groupBy("outcome").agg(
        pick(True, True, "mean").alias("t1"), pick(True, False, "mean").alias("t0"),
        pick(False, True, "mean").alias("c1"), pick(False, False, "mean").alias("c0"),
        se_part.alias("_v"))
    return out.select("outcome", "t1", "t0", "c1", "c0",
                      ((F.col("t1") - F.col("t0")) - (F.col("c1") - F.col("c0"))).alias("effect"),
                      F.sqrt("_v").alias("se"))


def did_clustered_se(impl: DataFrame, support: DataFrame, event_date: str,
                     cluster: str = "org_id") -> DataFrame:
    """DID effect with a cluster-robust standard error (clusters = orgs).

    The estimate is a signed sum of four cell means, so each rollout's
    influence is sign(cell) * (y - cell mean) / cell size. Influences are
    summed per org (map-side combined, so a hot org shrinks before the
    shuffle), squared and summed; G / (G - 1) corrects for G clusters. The
    cell table is 16 rows (4 outcomes x 4 cells), a proven bound for the
    broadcast.
    """
    outs = did_outcomes()
    # one pass over the rollouts: count and exact sum of every outcome per org
    # and cell, written once; only these sums meet the treated orgs
    flagged = impl.select(*dict.fromkeys([cluster, "org_id"]), (F.col("date_go_live") >= F.to_date(F.lit(event_date))).alias("post"),
                          *[c.alias(n) for n, c in outs.items()])
    keys = [*dict.fromkeys([cluster, "org_id"]), "post"]
    sums = flagged.groupBy(*keys).agg(*[x for n in outs for x in (F.count(n).alias(f"{n}__n"), F.sum(n).alias(f"{n}__s"))])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("outcome"), F.col(f"{n}__n").alias("n"), F.col(f"{n}__s").cast("double").alias("s"))
                               for n in outs]))
    per_org = materialize(sums.join(treated_orgs(support), "org_id", "left").select(
        F.col(cluster).alias("cluster"), F.coalesce("treated", F.lit(False)).alias("treated"), "post",
        *[f"{n}__{x}" for n in outs for x in "ns"]), "cluster-sums").select("cluster", "treated", "post", rows.alias("r")).select(
        "r.outcome", "cluster", "treated", "post", "r.n", "r.s").filter("n > 0")
    cells = per_org.groupBy("outcome", "treated", "post").agg(
        F.sum("n").alias("cell_n"), (F.sum("s") / F.sum("n")).alias("m"))
    sign = (F.when(F.col("treated") == F.col("post"), F.lit(1.0)).otherwise(F.lit(-1.0)))
    psi = (per_org.join(F.broadcast(cells), ["outcome", "treated", "post"])
           .select("outcome", "cluster",
                   (sign * (F.col("s") - F.col("n") * F.col("m")) / F.col("cell_n")).alias("psi")))
    per_cluster = psi.groupBy("outcome", "cluster").agg(F.sum("psi").alias("s"))
    g = F.count(F.lit(1))
    se = per_cluster.groupBy("outcome").agg(
        g.cast("long").alias("n_clusters"),
        F.when(g > 1, F.sqrt(F.sum(F.col("s") * F.col("s")) * g / (g - 1))).alias("se_cluster"))
    eff = (cells.groupBy("outcome").agg(F.sum(F.when(F.col("treated") == F.col("post"), F.col("m"))
                                                .otherwise(-F.col("m"))).alias("effect")))
    return eff.join(se, "outcome")


# -- C2: propensity scores ----------------------------------------------------------------------

def org_features(impl: DataFrame) -> DataFrame:
    """Org-level covariates: size (rollouts), capex and revenue, industry, region."""
    return (impl.groupBy("org_id")
            .agg(F.count(F.lit(1)).cast("double").alias("n_impl"),
                 F.sum("capex").cast("double").alias("capex_total"),
                 F.sum("revenue_uplift").cast("double").alias("revenue_total"),
                 F.min("industry_name").alias("industry_name"),
                 F.min("region_name").alias("region_name")))


def propensity_scores(impl: DataFrame, support: DataFrame, max_iter: int = 25) -> DataFrame:
    """Logistic regression of treatment on org covariates (pyspark.ml, trained
    with distributed aggregation); score = P(treated).

    The org feature table (one row per org) is checkpointed to the shared
    folder first: the indexer, scaler and solver each pass over it, and
    without the cut every pass would redo the rollout joins behind it.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    data = materialize(org_features(impl).join(treated_orgs(support), "org_id", "left")
                       .withColumn("label", F.coalesce(F.col("treated"), F.lit(False))
                                   .cast("double")), "psm-features")
    stages = [StringIndexer(inputCols=["industry_name", "region_name"],
                            outputCols=["ind_ix", "reg_ix"], handleInvalid="keep"),
              OneHotEncoder(inputCols=["ind_ix", "reg_ix"], outputCols=["ind_oh", "reg_oh"]),
              VectorAssembler(inputCols=["n_impl", "capex_total", "revenue_total"], outputCol="num"),
              StandardScaler(inputCol="num", outputCol="num_s"),
              VectorAssembler(inputCols=["num_s", "ind_oh", "reg_oh"], outputCol="features"),
              LogisticRegression(maxIter=max_iter, regParam=0.01, tol=1e-6)]
    model = Pipeline(stages=stages).fit(data)
    return model.transform(data).select(
        "org_id", F.col("label").cast("boolean").alias("treated"),
        vector_to_array("probability")[1].alias("score"))


# -- C3: nearest-neighbour matching within a caliper ------------------------------------------------

def nearest_match(units: DataFrame, id_col: str, score_col: str, stratum_col: str,
                  treated_col: str, caliper: float, k: int = 4) -> DataFrame:
    """Each treated unit's nearest control (with replacement) in its stratum with
    |score difference| <= caliper; ties by distance, then control id.

    Exact: a control within the caliper lies at most k sub-buckets away, one
    more where a bucket number is rounded, so k + 1 are looked at on each side
    and the distance itself decides.
    """
    width = caliper / k
    u = units.select(F.col(id_col).alias("id"), F.col(score_col).cast("double").alias("s"),
                     F.col(stratum_col).alias("stratum"), F.col(treated_col).alias("t"),
                     F.floor(F.col(score_col).cast("double") / width).alias("sb"))
    tr = u.filter("t").drop("t")
    # controls: one candidate per distinct (stratum, score), the smallest id
    ct = (u.filter(~F.col("t")).groupBy("stratum", "sb", "s").agg(F.min("id").alias("cid")))

    # level 1: as-of neighbours inside the treated row's own sub-bucket
    both = (ct.select("stratum", "sb", "s", F.struct(F.col("s").alias("cs"), "cid").alias("c"),
                      F.lit(None).cast("long").alias("tid"))
            .unionByName(tr.select("stratum", "sb", "s",
                                   F.lit(None).cast("struct<cs:double,cid:bigint>").alias("c"),
                                   F.col("id").alias("tid"))))
    order = [F.col("s"), F.col("tid").asc_nulls_first()]
    w_below = Window.partitionBy("stratum", "sb").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    w_above = Window.partitionBy("stratum", "sb").orderBy(*order).rowsBetween(
        Window.currentRow, Window.unboundedFollowing)
    near = (both.withColumn("below", F.last("c", ignorenulls=True).over(w_below))
            .withColumn("above", F.first("c", ignorenulls=True).over(w_above))
            .filter(F.col("tid").isNotNull()))
    cand1 = near.select("tid", "stratum", "s", F.explode(F.array("below", "above")).alias("c"))

    # level 2: extreme controls of the k sub-buckets on each side
    summary = ct.groupBy("stratum", "sb").agg(
        F.max_by(F.struct(F.col("s").alias("cs"), "cid"), F.struct(F.col("s"), -F.col("cid")))
        .alias("top"),
        F.min_by(F.struct(F.col("s").alias("cs"), "cid"), F.struct(F.col("s"), F.col("cid")))
        .alias("bottom"))
    offs = F.array(*[F.lit(o) for o in range(-k - 1, k + 2) if o])
    tr_off = tr.select(F.col("id").alias("tid"), "stratum", "s", "sb",
                       F.explode(offs).alias("off"))
    cand2 = (tr_off.join(summary.withColumnRenamed("sb", "nsb"),
                         (tr_off.stratum == summary.stratum) & (tr_off.sb + tr_off.off == F.col("nsb")))
             .select("tid", tr_off.stratum, "s",
                     F.when(F.col("off") < 0, F.col("top")).otherwise(F.col("bottom")).alias("c")))

    cands = (cand1.unionByName(cand2).filter(F.col("c").isNotNull())
             .withColumn("dist", F.abs(F.col("s") - F.col("c.cs")))
             .filter(F.col("dist") <= caliper))
    best = cands.groupBy("tid", "stratum", "s").agg(
        F.min_by(F.struct("c", "dist"), F.struct("dist", F.col("c.cid"))).alias("b"))
    return best.select(F.col("tid").alias("treated_id"), F.col("b.c.cid").alias("control_id"),
                       "stratum", F.col("s").alias("treated_score"),
                       F.col("b.c.cs").alias("control_score"), F.col("b.dist").alias("distance"))


# -- C4: balance table ------------------------------------------------------------------------------

def balance(units: DataFrame, matches: DataFrame, id_col: str, treated_col: str,
            covariates: list[str]) -> DataFrame:
    """Standardised mean difference of each covariate before and after matching.

    After matching, the control side is the matched controls with repeats
    (one row per match), i.e. weighted by how often each was used.
    """
    long = units.select(F.col(id_col).alias("id"), F.col(treated_col).alias("t"),
                        *[F.col(c).cast("decimal(20,4)").alias(c) for c in covariates]
                        ).unpivot(["id", "t"], covariates, "covariate", "x")
    before = moment_cells(long, ["covariate", "t"], "x").withColumn("sample", F.lit("before"))
    matched_t = matches.select(F.col("treated_id").alias("id"), F.lit(True).alias("t"))
    matched_c = matches.select(F.col("control_id").alias("id"), F.lit(False).alias("t"))
    after_rows = matched_t.unionByName(matched_c).hint("merge").join(long.drop("t").hint("merge"), "id")
    after = moment_cells(after_rows, ["covariate", "t"], "x").withColumn("sample", F.lit("after"))
    cells = before.unionByName(after)

    def pick(t: bool, c: str) -> Column:
        return F.max(F.when(F.col("t") == t, F.col(c)))
    out = cells.groupBy("covariate", "sample").agg(
        pick(True, "mean").alias("mean_t"), pick(False, "mean").alias("mean_c"),
        pick(True, "var").alias("var_t"), pick(False, "var").alias("var_c"))
    pooled = F.sqrt((F.col("var_t") + F.col("var_c")) / 2.0)
    return out.withColumn("smd", F.when(pooled > 0, (F.col("mean_t") - F.col("mean_c")) / pooled))


# -- C5: DID on the matched sample --------------------------------------------------------------------

def matched_did(impl: DataFrame, matches: DataFrame, event_date: str) -> DataFrame:
    """DID cells and effect using matched treated orgs and their controls,
    controls weighted by their match count."""
    tw = matches.groupBy(F.col("treated_id").alias("org_id")).agg(F.lit(1).alias("w")).withColumn(
        "treated", F.lit(True))
    cw = matches.groupBy(F.col("control_id").alias("org_id")).agg(
        F.count(F.lit(1)).alias("w")).withColumn("treated", F.lit(False))
    weights = tw.unionByName(cw)
    outs = did_outcomes()
    panel = (impl.join(weights, "org_id")
             .select("treated", "w",
                     (F.col("date_go_live") >= F.to_date(F.lit(event_date))).alias("post"),
                     *[c.cast("decimal(20,8)").alias(n) for n, c in outs.items()])
             .unpivot(["treated", "post", "w"], list(outs), "outcome", "y"))
    cells = moment_cells(panel, ["outcome", "treated", "post"], w=F.col("w"))
    return did_effect(cells)


# -- C6 / C7: synthetic control ------------------------------------------------------------------------

# The unit made of supported orgs, and the most units that a matrix may have.
TREATED = "(supported)"
MAX_UNITS = 1000


def unit_panel(impl: DataFrame, unit_col: str) -> DataFrame:
    """Outcome per (unit, month): rollout count."""
    return (impl.groupBy(F.col(unit_col).alias("unit"), month_end("date_go_live").alias("date_month"))
            .agg(F.count(F.lit(1)).cast("long").alias("y")))


def supported_unit_panel(impl: DataFrame, orgs: DataFrame, treated_unit: str) -> DataFrame:
    """Rollouts per org and month: of the supported orgs of ``treated_unit``
    (unit ``TREATED``), and of the unsupported orgs of every unit, which serve
    as donors. ``orgs`` has org_id, unit, treated; a month without rollouts has
    no row. Rates are decimals, so sums of products are exact."""
    side = orgs.filter(~F.col("treated") | (F.col("unit") == treated_unit)).select(
        "org_id", F.when(F.col("treated"), TREATED).otherwise(F.col("unit")).alias("unit"))
    sizes = side.groupBy("unit").agg(F.count("*").alias("n_orgs"))
    counts = impl.select("org_id", month_end("date_go_live").alias("date_month")).join(side, "org_id").groupBy(
        "unit", "date_month").agg(F.count("*").alias("n"))
    return counts.join(sizes, "unit").select(
        "unit", "date_month", F.round(F.col("n").cast("decimal(18,0)") / F.col("n_orgs"), 6).cast("decimal(18,6)").alias("y"))


def gram(panel: DataFrame, units: list[str], before: str) -> DataFrame:
    """G[i, j] = sum over pre-period months of y_i * y_j, for all unit pairs
    (0 where two units share no month): the panel joined with itself by month,
    products summed per pair before the shuffle. Integers stay integers, and
    decimals are summed exactly."""
    past = panel.filter(F.col("date_month") < F.to_date(F.lit(before))).filter(F.col("unit").isin(units))
    left = past.select("date_month", F.col("unit").alias("unit_i"), F.col("y").alias("a"))
    right = past.select("date_month", F.col("unit").alias("unit_j"), F.col("y").alias("b"))
    product = F.sum(F.col("a") * F.col("b"))
    whole = panel.schema["y"].dataType in (T.LongType(), T.IntegerType())
    sums = left.join(right, "date_month").groupBy("unit_i", "unit_j").agg(product.cast("long" if whole else "double").alias("g"))
    names = F.array(*[F.lit(u) for u in units])
    pairs = panel.sparkSession.range(1).select(F.explode(names).alias("unit_i")).select("unit_i", F.explode(names).alias("unit_j"))
    return pairs.join(sums, ["unit_i", "unit_j"], "left").select("unit_i", "unit_j", F.coalesce("g", F.lit(0)).alias("g"))


def _simplex_projection(v: np.ndarray) -> np.ndarray:
    """Euclidean projection onto {w >= 0, sum w = 1} (sort-based)."""
    u = np.sort(v)[::-1]
    css = np.cumsum(u)
    idx = np.arange(1, len(v) + 1)
    rho = np.nonzero(u * idx > (css - 1))[0][-1]
    theta = (css[rho] - 1) / (rho + 1.0)
    return np.maximum(v - theta, 0.0)


def duality_gap(g: np.ndarray, b: np.ndarray, w: np.ndarray) -> float:
    """How far w can be from the optimum of w'Gw - 2b'w on the simplex: the
    gradient's product with the way to the best corner."""
    grad = 2.0 * (g @ w - b)
    return float(grad @ w - grad.min())


def _on_support(g: np.ndarray, b: np.ndarray, support: np.ndarray) -> np.ndarray | None:
    """The optimum with these weights free, the others zero and the sum one;
    None if it has a negative weight."""
    n = len(support)
    system = np.zeros((n + 1, n + 1))
    system[:n, :n] = 2.0 * g[np.ix_(support, support)]
    system[:n, n] = system[n, :n] = 1.0
    right = np.append(2.0 * b[support], 1.0)
    free = np.linalg.lstsq(system, right, rcond=None)[0][:n]
    if free.min() < -1e-9:
        return None
    w = np.zeros(len(b))
    w[support] = np.maximum(free, 0.0)
    return w / w.sum()


def simplex_weights(g: np.ndarray, b: np.ndarray, tol: float = 1e-8, most: int = 200_000) -> np.ndarray:
    """argmin w'Gw - 2b'w on the simplex, to a duality gap of ``tol`` times the
    scale of G. Accelerated projected gradient finds which weights are not
    zero, a linear system then their values; raises if it does not converge."""
    n = len(b)
    if n == 0:
        return np.zeros(0)
    scale = max(float(np.max(np.abs(np.diag(g)))), 1e-12)
    gs, bs = g / scale, b / scale
    lip = max(float(np.linalg.eigvalsh(gs).max()), 1e-12) * 2.0
    w = v = np.full(n, 1.0 / n)
    t = 1.0
    for step in range(most):
        new = _simplex_projection(v - 2.0 * (gs @ v - bs) / lip)
        if (v - new) @ (new - w) > 0:  # the momentum points uphill: start it anew
            t, v = 1.0, w
            new = _simplex_projection(v - 2.0 * (gs @ v - bs) / lip)
        t_new = (1.0 + np.sqrt(1.0 + 4.0 * t * t)) / 2.0
        v = new + (t - 1.0) / t_new * (new - w)
        w, t = new, t_new
        if step % 50 == 0:
            tries = [w, _on_support(gs, bs, np.flatnonzero(w > 1e-7))]
            for x in tries:
                if x is not None and duality_gap(gs, bs, x) <= tol:
                    return x
    raise ArithmeticError(f"no convergence in {most} steps: duality gap {duality_gap(gs, bs, w):.3g}")


WEIGHT_SCHEMA = T.StructType([T.StructField("treated_unit", T.StringType()),
                              T.StructField("donor", T.StringType()),
                              T.StructField("weight", T.DoubleType())])


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per row one treated unit, the donors and the packed Gram matrix."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            index = {u: k for k, u in enumerate(sorted({e["unit_i"] for e in row.entries}))}
            g = np.zeros((len(index), len(index)))
            for e in row.entries:
                g[index[e["unit_i"]], index[e["unit_j"]]] = e["g"]
            donors = [u for u in sorted(row.donors) if u != row.treated_unit and u in index]
            at = [index[u] for u in donors]
            w = simplex_weights(g[np.ix_(at, at)], g[at, index[row.treated_unit]])
            yield pd.DataFrame({"treated_unit": row.treated_unit, "donor": donors, "weight": w})


def synth_weights(gram_long: DataFrame, treated_units: list[str], donors: list[str] | None = None) -> DataFrame:
    """Simplex weights over the donors (all units if not given) for every unit
    in ``treated_units``. The matrix is packed into one row, which goes to the
    tasks; it has at most MAX_UNITS units, more are an error."""
    packed = gram_long.select("unit_i", "unit_j", F.col("g").cast("double").alias("g")).agg(
        F.count("*").alias("n"), F.collect_list(F.struct("unit_i", "unit_j", "g")).alias("entries"))
    packed = packed.select(F.when(F.col("n") > MAX_UNITS ** 2, F.raise_error(F.lit("too many units"))).otherwise(
        F.col("entries")).alias("entries"))
    names = F.array(*[F.lit(u) for u in treated_units])
    pool = F.array(*[F.lit(u) for u in donors]) if donors else F.transform("entries", lambda e: e["unit_i"])
    each = gram_long.sparkSession.range(1).select(F.explode(names).alias("treated_unit")).repartition("treated_unit")
    each = each.crossJoin(F.broadcast(packed)).select("treated_unit", F.array_distinct(pool).alias("donors"), "entries")
    return each.mapInPandas(_solve, WEIGHT_SCHEMA)


def synth_gap(panel: DataFrame, weights: DataFrame, months: DataFrame,
              treated_units: list[str]) -> DataFrame:
    """y(treated) - sum_i w_i y_i(month) for every calendar month."""
    y = panel.select("unit", "date_month", "y")
    synth = (weights.join(y.withColumnRenamed("unit", "donor"), "donor")
             .groupBy("treated_unit", "date_month")
             .agg(F.sum(F.col("weight") * F.col("y")).alias("synthetic")))
    actual = y.withColumnRenamed("unit", "treated_unit")
    grid = months.withColumn("treated_unit", F.explode(F.array(*[F.lit(u) for u in treated_units])))
    return (grid.join(actual, ["treated_unit", "date_month"], "left")
            .join(synth, ["treated_unit", "date_month"], "left")
            .select("treated_unit", "date_month",
                    F.coalesce("y", F.lit(0)).cast("double").alias("actual"),
                    F.coalesce("synthetic", F.lit(0.0)).alias("synthetic"))
            .withColumn("gap", F.col("actual") - F.col("synthetic")))


def placebo_test(gaps: DataFrame, before: str, treated_unit: str) -> DataFrame:
    """Post/pre RMSPE ratio per unit and the treated unit's rank-based p-value."""
    pre = F.col("date_month") < F.to_date(F.lit(before))
    r = gaps.groupBy("treated_unit").agg(
        F.sqrt(F.avg(F.when(pre, F.col("gap") * F.col("gap")))).alias("pre_rmspe"),
        F.sqrt(F.avg(F.when(~pre, F.col("gap") * F.col("gap")))).alias("post_rmspe"))
    r = r.withColumn("ratio", F.when(F.col("pre_rmspe") > 0, F.col("post_rmspe") / F.col("pre_rmspe")))
    # units without a pre-period error have no ratio and are not ranked; if the
    # treated unit is one of them there is no p-value
    n_units = r.agg(F.count("ratio")).scalar()
    treated_ratio = r.filter(F.col("treated_unit") == treated_unit).agg(F.max("ratio")).scalar()
    at_least = r.agg(F.count_if(F.col("ratio") >= treated_ratio)).scalar()
    return r.select("treated_unit", "pre_rmspe", "post_rmspe", "ratio",
                    (F.col("treated_unit") == treated_unit).alias("is_treated"),
                    F.when(treated_ratio.isNotNull(), at_least / n_units).alias("p_value"))
