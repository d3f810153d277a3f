"""Matching on several covariates: score, match, balance and DID in one chain.

Units are orgs with covariates from before the event. The propensity score is
fitted until it converges and is itself a covariate; numeric covariates are
whitened (their covariance becomes the unit matrix), so distances do not depend
on scales or correlations.

The nearest control within a caliper is found exactly, without pairs of a
stratum: controls are summed into a tree of grid cells (each level four times
finer, each cell with its size and one member). A treated point starts at the
cells around it; a cell is left as soon as it cannot hold anything nearer than
the best member seen, a cell of one control is settled at once, and only the
others are opened into their finer cells. Equal points are looked up once.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.causal import did_effect, did_outcomes, treated_orgs
from tidewater.operators.staggered import resampled
from tidewater.session import materialize

LEVELS = 7
FINER = 4
NUMERIC = ["n_impl", "capex_total", "revenue_total"]
CATEGORICAL = ["industry_name", "region_name"]


# -- covariates and score -----------------------------------------------------------------

def org_covariates(impl: DataFrame, support: DataFrame, before: str, orgs: DataFrame | None = None) -> DataFrame:
    """Per org with rollouts before the event: whether it was supported, and
    its size, spending and revenue (log scale), industry and region. The last
    two are columns of the rollouts, or of ``orgs`` (org_id, industry_name,
    region_name), which then meet the sums per org, not the rollouts.

    Orgs are joined by merging: a file of few bytes may hold so many of them
    that the driver has no room to broadcast them."""
    past = impl.filter(F.col("date_go_live") < F.to_date(F.lit(before)))
    # the least of strings makes Spark sort its rows: only the few (org, industry, region) are, not the rollouts
    parts = past.groupBy("org_id", *([] if orgs else ["industry_name", "region_name"])).agg(
        F.count("*").alias("n"), F.sum("capex").alias("capex"), F.sum("revenue_uplift").alias("revenue"))
    if orgs:
        parts = parts.hint("merge").join(orgs.hint("merge"), "org_id")
    sums = parts.groupBy("org_id").agg(
        F.log1p(F.sum("n").cast("double")).alias("n_impl"),
        F.log1p(F.greatest(F.sum("capex"), F.lit(0)).cast("double")).alias("capex_total"),
        F.log1p(F.greatest(F.sum("revenue"), F.lit(0)).cast("double")).alias("revenue_total"),
        F.min("industry_name").alias("industry_name"), F.min("region_name").alias("region_name"))
    return sums.hint("merge").join(treated_orgs(support).hint("merge"), "org_id", "left").withColumn("treated", F.coalesce("treated", F.lit(False)))


def fitted_scores(units: DataFrame, numeric: list[str], categorical: list[str], most: int = 400) -> DataFrame:
    """``units`` with ``score`` = P(treated) by logistic regression and its
    ``logit``. Raises where the fit has not converged after ``most`` steps."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    data = materialize(units.withColumn("label", F.col("treated").cast("double")), "score-units")
    codes, hot = [f"_{c}_code" for c in categorical], [f"_{c}_hot" for c in categorical]
    stages = [StringIndexer(inputCols=categorical, outputCols=codes, handleInvalid="keep"),
              OneHotEncoder(inputCols=codes, outputCols=hot),
              VectorAssembler(inputCols=numeric, outputCol="_num"), StandardScaler(inputCol="_num", outputCol="_scaled"),
              VectorAssembler(inputCols=["_scaled", *hot], outputCol="features"),
              LogisticRegression(maxIter=most, regParam=0.01, tol=1e-8)]
    model = Pipeline(stages=stages).fit(data)
    if model.stages[-1].summary.totalIterations >= most:
        raise ArithmeticError(f"the score did not converge in {most} steps")
    score = vector_to_array("probability")[1]
    return model.transform(data).withColumn("score", score).withColumn(
        "logit", F.log(F.col("score") / (1.0 - F.col("score")))).select(*units.columns, "score", "logit")


def whitened(units: DataFrame, covariates: list[str]) -> DataFrame:
    """``units`` with ``z``: the covariates centred and turned so that their
    covariance is the unit matrix (Mahalanobis distance). Directions without
    variance are left out. The covariance matrix is one aggregate."""
    pairs = [(i, j) for i in range(len(covariates)) for j in range(i, len(covariates))]
    row = units.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(covariates)],
                    *[F.covar_samp(covariates[i], covariates[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(covariates), len(covariates)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"] or 0.0
    values, vectors = np.linalg.eigh(cov)
    keep = values > max(float(values.max(initial=0.0)), 1e-300) * 1e-9
    turn = (vectors[:, keep] / np.sqrt(values[keep])).T
    centred = [F.col(c) - (row[f"m{i}"] or 0.0) for i, c in enumerate(covariates)]
    z = [sum((x * float(t) for x, t in zip(centred, line)), F.lit(0.0)) for line in turn] or [F.lit(0.0)]
    return units.withColumn("z", F.array(*z))


def standardised(units: DataFrame, covariates: list[str]) -> DataFrame:
    """``units`` with ``z``: every covariate in units of its own deviation."""
    row = units.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(covariates)
                      for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    z = [(F.col(c) - row[f"m{i}"]) / row[f"s{i}"] if row[f"s{i}"] else F.lit(0.0) for i, c in enumerate(covariates)]
    return units.withColumn("z", F.array(*z))


# -- nearest control in several dimensions ---------------------------------------------------

def _squares(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x)


def _distance(a: str, b: str) -> Column:
    return F.sqrt(_squares(F.zip_with(a, b, lambda x, y: x - y)))


def _to_cell(z: str, cell: str, width: float) -> Column:
    """The least distance from a point to any point of a cell."""
    return F.sqrt(_squares(F.zip_with(z, cell, lambda x, c: F.greatest(c * width - x, x - (c + 1) * width, F.lit(0.0)))))


def _cell(z: str, width) -> Column:
    return F.transform(z, lambda x: F.floor(x / width))


def _around(home: str, dimensions: int) -> Column:
    """The cells that touch a cell, itself among them. One expression over a
    constant list of steps: written out they would be more code than Spark can
    compile."""
    steps = F.array(*[F.array(*[F.lit(o).cast("long") for o in step]) for step in itertools.product((-1, 0, 1), repeat=dimensions)])
    return F.transform(steps, lambda step: F.zip_with(home, step, lambda x, o: x + o))


def cell_tree(points: DataFrame, caliper: float, levels: int = LEVELS) -> DataFrame:
    """(level, stratum, cell, parent, n, member, at) of points (stratum, id, z)."""
    rows = points.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).withColumn(
        "width", F.lit(float(caliper)) / F.pow(F.lit(float(FINER)), F.col("level")))
    rows = rows.withColumn("cell", F.transform("z", lambda x: F.floor(x / F.col("width"))))
    return rows.groupBy("level", "stratum", "cell").agg(F.count("*").alias("n"), F.min(F.struct("id", "z")).alias("m")).select(
        "level", "stratum", "cell", F.transform("cell", lambda c: F.floor(c / FINER)).alias("parent"), "n",
        F.col("m.id").alias("member"), F.col("m.z").alias("at"))


def nearest_control(units: DataFrame, id_col: str, stratum_col: str, caliper: float, dimensions: int,
                    treated_col: str = "treated", levels: int = LEVELS) -> DataFrame:
    """Each treated unit's nearest control (with replacement) by the Euclidean
    distance of ``z`` (``dimensions`` numbers) in its stratum, at most
    ``caliper`` away; ties by control id. Units with a null in ``z`` or without
    a stratum take no part."""
    u = units.select(F.col(id_col).alias("id"), F.col(stratum_col).alias("stratum"), F.col(treated_col).alias("t"), "z").filter(
        "id is not null and stratum is not null and not exists(z, x -> x is null or isnan(x))")
    u = materialize(u, "match-units")
    # a point becomes many cells: as many tasks as the session has, however few bytes the points are
    tasks = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = u.repartition(tasks, "stratum", "z")
    controls = materialize(dealt.filter("not t").groupBy("stratum", "z").agg(F.min("id").alias("id")), "match-controls")
    tree = materialize(cell_tree(controls, caliper, levels), "match-cells")
    points = dealt.filter("t").groupBy("stratum", "z").agg(F.min("id").alias("point"))
    frontier = points.withColumn("home", _cell("z", float(caliper))).select(
        "point", "stratum", "z", F.explode(_around("home", dimensions)).alias("cell"))
    seen = None
    for level in range(levels):
        width = caliper / FINER ** level
        here = tree.filter(F.col("level") == level)
        if level:  # opened cells become their finer ones
            met = frontier.withColumnRenamed("cell", "parent").hint("merge").join(here.hint("merge"), ["stratum", "parent"])
        else:
            met = frontier.hint("merge").join(here.hint("merge"), ["stratum", "cell"])
        met = materialize(met.select("point", "stratum", "z", "cell", "n", "member", _distance("z", "at").alias("d"),
                                     _to_cell("z", "cell", width).alias("least")), "match-level")
        found = met.select("point", "member", "d")
        seen = found if seen is None else seen.unionByName(found)
        seen = materialize(seen.groupBy("point").agg(F.min(F.struct("d", "member")).alias("b")).select(
            "point", F.col("b.member").alias("member"), F.col("b.d").alias("d")), "match-best")
        bound = seen.select("point", (F.least("d", F.lit(float(caliper))) * (1 + 1e-9) + 1e-12).alias("bound"))
        frontier = materialize(met.filter("n > 1").hint("merge").join(bound.hint("merge"), "point").filter("least <= bound").select(
            "point", "stratum", "z", "cell"), "match-open")
        if frontier.isEmpty():
            break
    else:
        last = controls.select("stratum", _cell("z", caliper / FINER ** (levels - 1)).alias("cell"), F.col("id").alias("member"),
                               F.col("z").alias("at"))
        found = frontier.hint("merge").join(last.hint("merge"), ["stratum", "cell"]).select("point", "member", _distance("z", "at").alias("d"))
        seen = seen.unionByName(found).groupBy("point").agg(F.min(F.struct("d", "member")).alias("b")).select(
            "point", F.col("b.member").alias("member"), F.col("b.d").alias("d"))
    best = points.hint("merge").join(seen.filter(F.col("d") <= caliper).hint("merge"), "point").select("stratum", "z", "member", "d")
    return u.filter("t").hint("merge").join(best.hint("merge"), ["stratum", "z"]).select(
        F.col("id").alias("treated_id"), F.col("member").alias("control_id"), "stratum", F.col("d").alias("distance"))


# -- one-to-one matching -----------------------------------------------------------------------

def match_once(units: DataFrame, id_col: str, score_col: str, stratum_col: str, treated_col: str, caliper: float,
               k: int = 4) -> DataFrame:
    """Matching without replacement: the pairs that taking the nearest free pair
    again and again gives (ties by treated id, then control id), found in rounds.
    In a round every score with free units looks for its nearest free scores of
    the other side; where they name each other their units are paired by rank,
    as the sequential order would. Units of equal score are paired by rank
    before. Rounds do not grow with the number of units of one score."""
    u = units.select(F.col(id_col).alias("id"), F.col(score_col).cast("double").alias("s"), F.col(stratum_col).alias("stratum"),
                     F.col(treated_col).alias("t")).filter("id is not null and s is not null and stratum is not null")
    u = materialize(u, "once-units")
    both = u.groupBy("stratum", "s").agg(F.count_if("t").alias("a"), F.count_if(~F.col("t")).alias("b")).filter("a > 0 and b > 0")
    ranked = _ranked(u.join(both.select("stratum", "s"), ["stratum", "s"], "left_semi"))
    done = materialize(ranked.filter("t").select("stratum", "s", "nth", F.col("id").alias("treated_id")).join(
        ranked.filter("not t").select("stratum", "s", "nth", F.col("id").alias("control_id")), ["stratum", "s", "nth"]).select(
        "treated_id", "control_id", "stratum", F.lit(0.0).alias("distance")), "once-equal")
    pairs = done
    while True:
        gone = done.select(F.explode(F.array(F.struct(F.col("treated_id").alias("id"), F.lit(True).alias("t")),
                                             F.struct(F.col("control_id").alias("id"), F.lit(False).alias("t")))).alias("g")).select("g.*")
        u = materialize(u.join(gone.hint("merge"), ["id", "t"], "left_anti").dropDuplicates(["stratum", "s", "t", "id"]), "once-free")
        met = materialize(_meetings(u, caliper, k), "once-meetings")
        called = u.hint("merge").join(met.hint("merge"), ["stratum", "s", "t"]).filter("not first_only or id = first")
        ranked = _ranked(called.select("stratum", "place", "t", "id", "s"), "place")
        done = materialize(ranked.filter("t").select("stratum", "place", "nth", F.col("id").alias("treated_id"), F.col("s").alias("ts")).hint("merge").join(
            ranked.filter("not t").select("stratum", "place", "nth", F.col("id").alias("control_id"), F.col("s").alias("cs")),
            ["stratum", "place", "nth"]).select("treated_id", "control_id", "stratum", F.abs(F.col("ts") - F.col("cs")).alias("distance")), "once-round")
        if done.isEmpty():
            return pairs
        pairs = pairs.unionByName(done)


def _nearest_scores(scores: DataFrame, caliper: float, k: int) -> DataFrame:
    """(stratum, s, t, d, o) for each side's scores (stratum, s, t): the nearest
    scores of the other side, at most ``caliper`` away; two rows where one below
    and one above are equally near. Scores meet in sub-buckets as in
    ``nearest_match``."""
    u = scores.select("stratum", "s", "t", F.floor(F.col("s") / (caliper / k)).alias("sb"))
    below = Window.partitionBy("stratum", "sb").orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = Window.partitionBy("stratum", "sb").orderBy("s").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    sides = [F.when(F.col("t") == F.lit(t), F.col("s")) for t in (True, False)]
    other = [F.when(F.col("t"), f(sides[1], ignorenulls=True).over(w)).otherwise(f(sides[0], ignorenulls=True).over(w))
             for f, w in ((F.last, below), (F.first, above))]
    inside = u.withColumn("others", F.array(*other)).select("stratum", "s", "t", F.explode("others").alias("o"))
    ends = u.groupBy("stratum", "sb", (~F.col("t")).alias("t")).agg(F.max("s").alias("top"), F.min("s").alias("bottom"))
    offsets = F.explode(F.array(*[F.lit(o) for o in range(-k - 1, k + 2) if o])).alias("off")
    across = u.select("stratum", "s", "t", "sb", offsets).withColumn("sb", F.col("sb") + F.col("off")).hint("merge").join(
        ends.hint("merge"), ["stratum", "sb", "t"]).select("stratum", "s", "t", F.when(F.col("off") < 0, F.col("top")).otherwise(F.col("bottom")).alias("o"))
    near = inside.unionByName(across).withColumn("d", F.abs(F.col("s") - F.col("o"))).filter(F.col("d") <= caliper)
    best = near.groupBy("stratum", "s", "t").agg(F.collect_set(F.struct("d", "o")).alias("c"))
    return best.select("stratum", "s", "t", F.explode(F.filter("c", lambda x: x["d"] == F.array_min("c")["d"])).alias("c")).select(
        "stratum", "s", "t", "c.d", "c.o")


def _meetings(units: DataFrame, caliper: float, k: int) -> DataFrame:
    """(stratum, s, t, place, first, first_only): the scores of each side whose
    units are paired by rank of their ids in this round, and where.

    Scores that are each other's nearest meet, all their units at once: the
    sequential order takes the smallest free ids of both until a side is used
    up. So it does where one score has a nearest one on either side, equally
    far. A score that is also equally near to one that has nearer ones waits
    for these, as units left over there come first if their ids are smaller.
    In longer rows of equal steps only the smallest ids that name each other
    are paired."""
    scores = materialize(units.groupBy("stratum", "s", "t").agg(F.min("id").alias("first")), "once-scores")
    near = materialize(_nearest_scores(scores, caliper, k), "once-near")
    back = near.select("stratum", F.col("o").alias("s"), F.col("s").alias("o"), (~F.col("t")).alias("t"), F.lit(True).alias("back"))
    names = scores.select("stratum", F.col("s").alias("o"), (~F.col("t")).alias("t"), F.col("first").alias("theirs"))
    edges = near.hint("merge").join(back.hint("merge"), ["stratum", "s", "o", "t"], "left").join(
        names.hint("merge"), ["stratum", "o", "t"])
    settled = edges.groupBy("stratum", "s", "t").agg(
        F.bool_and(F.col("back").isNotNull()).alias("clean"), F.count("*").alias("degree"),
        F.collect_list(F.struct("theirs", "o")).alias("others")).filter("clean").drop("clean")
    sides = materialize(settled.hint("merge").join(scores, ["stratum", "s", "t"]), "once-sides")
    mine = sides.select("stratum", "s", "t", "degree", "first", F.array_min("others")["o"].alias("named"), F.explode("others.o").alias("o"))
    theirs = sides.select("stratum", F.col("s").alias("o"), (~F.col("t")).alias("t"), F.col("degree").alias("their_degree"),
                          F.col("first").alias("theirs"), F.array_min("others")["o"].alias("names"))
    met = materialize(mine.hint("merge").join(theirs.hint("merge"), ["stratum", "o", "t"]), "once-met")
    middles = met.groupBy("stratum", "s", "t", "degree").agg(F.count("*").alias("known"), F.max("their_degree").alias("far")).filter(
        "known = degree and far = 1 and (t or degree = 2)").select("stratum", "s", "t", F.lit(True).alias("middle"))
    marked = met.hint("merge").join(middles.hint("merge"), ["stratum", "s", "t"], "left").withColumn("middle", F.coalesce("middle", F.lit(False)))
    marked = marked.filter("middle or (t and o = named and s = names)")
    ends = F.explode(F.array(F.struct("s", "t", "first"), F.struct(F.col("o").alias("s"), (~F.col("t")).alias("t"), F.col("theirs").alias("first")))).alias("e")
    return marked.select("stratum", F.struct("middle", F.col("s").alias("place")).alias("at"), ends).groupBy(
        "stratum", "e.s", "e.t", "e.first").agg(F.max("at").alias("at")).select(
        "stratum", "s", "t", "first", "at.place", (~F.col("at.middle")).alias("first_only"))


def _ranked(units: DataFrame, by: str = "s") -> DataFrame:
    """Units with their rank (from 0) by id among those of the same stratum,
    score (or other column ``by``) and side. Rows are sorted by range and counted per partition, so a
    score that a third of the rows share is not one task."""
    rows = materialize(units.repartitionByRange(F.col("stratum"), F.col(by), F.col("t"), F.col("id")).sortWithinPartitions(
        "stratum", by, "t", "id").select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")), "ranked")
    key = ["stratum", by, "t"]
    parts = rows.groupBy(*key, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = parts.select(*key, F.col("_part").alias("_earlier"), F.col("_n").alias("_m"))
    offset = parts.join(before, key).groupBy(*key, "_part", "_first").agg(
        F.sum(F.when(F.col("_earlier") < F.col("_part"), F.col("_m")).otherwise(0)).alias("_offset"))
    return rows.join(offset, [*key, "_part"]).withColumn("nth", F.col("_row") - F.col("_first") + F.col("_offset")).drop(
        "_part", "_row", "_first", "_offset")


# -- DID on a matched sample, with resampled errors ------------------------------------------------

def matched_cells(impl: DataFrame, matches: DataFrame, event_date: str, outcomes: dict[str, Column] | None = None) -> DataFrame:
    """n and exact sum of every outcome per org and side of the event, controls
    counted as often as they are matched."""
    outs = outcomes or did_outcomes()
    weights = matches.groupBy(F.col("treated_id").alias("org_id")).agg(F.lit(1).cast("long").alias("w")).withColumn(
        "treated", F.lit(True)).unionByName(
        matches.groupBy(F.col("control_id").alias("org_id")).agg(F.count("*").alias("w")).withColumn("treated", F.lit(False)))
    rows = impl.select("org_id", (F.col("date_go_live") >= F.to_date(F.lit(event_date))).alias("post"),
                       *[c.alias(n) for n, c in outs.items()])
    sums = rows.groupBy("org_id", "post").agg(*[x for n in outs for x in (F.count(n).alias(f"{n}__n"), F.sum(n).alias(f"{n}__s"))])
    cells = F.explode(F.array(*[F.struct(
        F.lit(n).alias("outcome"), (F.col("w") * F.col(f"{n}__n")).alias("n"),
        (F.col("w") * F.col(f"{n}__s").cast("decimal(30,8)")).cast("decimal(38,8)").alias("s")) for n in outs]))
    return sums.hint("merge").join(weights.hint("merge"), "org_id").select("org_id", "treated", "post", cells.alias("c")).select(
        "c.outcome", "treated", "post", "org_id", "c.n", "c.s").filter("n > 0")


def _effects(cells: DataFrame, keys: list[str]) -> DataFrame:
    mean = F.col("s").cast("double") / F.col("n")
    sides = cells.groupBy(*keys, "outcome").agg(
        F.count("*").alias("cells"), F.sum(F.when(F.col("treated") == F.col("post"), mean).otherwise(-mean)).alias("effect"))
    return sides.filter("cells = 4").drop("cells")


def matched_did(impl: DataFrame, matches: DataFrame, event_date: str, replicates: int = 200,
                outcomes: dict[str, Column] | None = None) -> DataFrame:
    """DID effect on the matched sample, with the error and 95 % interval over
    bootstrap replicates of the orgs (one grouped pass over the org sums)."""
    per_org = materialize(matched_cells(impl, matches, event_date, outcomes), "matched-cells")
    cell = ["outcome", "treated", "post"]
    whole = per_org.groupBy(*cell).agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,8)").alias("s"))
    errors = _effects(resampled(per_org, "org_id", cell, replicates), ["replicate"]).groupBy("outcome").agg(
        F.count("*").alias("replicates"), F.stddev_samp("effect").alias("se"),
        F.percentile("effect", F.lit(0.025)).alias("low"), F.percentile("effect", F.lit(0.975)).alias("high"))
    n = per_org.groupBy("outcome").agg(F.count_distinct("org_id").alias("n_orgs"))
    return _effects(whole, []).join(n, "outcome").join(errors, "outcome")
