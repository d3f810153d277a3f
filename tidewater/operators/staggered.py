"""Difference in differences for grants that start at different times.

Orgs are grouped into cohorts by the period of their first grant. A cohort's
effect in a period is its change since the period before its grant, less the
change of the orgs that had no grant by then. (With one common event date,
orgs supported early would serve as controls for late ones, and the estimate is
biased wherever effects differ by cohort or grow with time.)

Scale: rollouts are summed once per (org, period); a hot org is combined before
the shuffle. Everything after that is cohort x period tables, whose size is
bounded by the square of the number of calendar periods, whatever the data. The
standard error sums each org's influence; the bootstrap gives every org a
Poisson weight per replicate, so both work from the same sums.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from decimal import Context

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.causal import did_outcomes
from tidewater.session import materialize

NEVER = 1 << 20
CELL = ["outcome", "cohort", "period"]


def quarter_index(c) -> Column:
    """Quarters as consecutive numbers."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.year(c) * 4 + F.quarter(c) - 1).cast("int")


def first_grant(support: DataFrame, at_least: float = 0.0) -> DataFrame:
    """org_id and the period of its first grant of this size or more."""
    large = support.filter(F.col("amount_rub") >= at_least)
    return large.groupBy(F.col("recipient_id").alias("org_id")).agg(F.min(quarter_index("approval_date")).alias("cohort"))


def org_sums(impl: DataFrame, grants: DataFrame, outcomes: dict[str, Column]) -> DataFrame:
    """org_id, cohort, period, and n and the exact sum s of every outcome side
    by side; one pass over the rollouts."""
    rows = impl.select("org_id", quarter_index("date_go_live").alias("period"), *[c.alias(n) for n, c in outcomes.items()])
    sums = rows.groupBy("org_id", "period").agg(*[x for n in outcomes for x in (F.count(n).alias(f"{n}__n"), F.sum(n).alias(f"{n}__s"))])
    return sums.join(grants, "org_id", "left").withColumn("cohort", F.coalesce("cohort", F.lit(NEVER)))


def _by_outcome(sums: DataFrame, outcomes: dict[str, Column]) -> DataFrame:
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("outcome"), F.col(f"{n}__n").alias("n"),
                                         F.col(f"{n}__s").cast("decimal(38,8)").alias("s")) for n in outcomes]))
    return sums.select("org_id", "cohort", "period", cells.alias("c")).select(
        "c.outcome", "cohort", "period", "org_id", "c.n", "c.s").filter("n > 0")


def org_cells(impl: DataFrame, grants: DataFrame, outcomes: dict[str, Column] | None = None) -> DataFrame:
    """n and the exact sum s of every outcome per org and period, with the
    org's cohort; one pass over the rollouts."""
    outs = outcomes or did_outcomes()
    return _by_outcome(org_sums(impl, grants, outs), outs)


def cohort_effects(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per outcome, cohort and period other than the base: ``att`` with
    the four cells it is made of. ``cells`` has outcome, cohort, period, n, s;
    ``keys`` names more columns that keep estimates apart (replicates)."""
    keys = [*(keys or []), "outcome"]
    treated = cells.filter(F.col("cohort") < NEVER)
    base = treated.select(*keys, "cohort", (F.col("period") + 1).alias("_next"), F.col("n").alias("base_n"), F.col("s").alias("base_s"))
    wanted = treated.join(base.filter("_next = cohort").drop("_next"), [*keys, "cohort"]).filter("period <> cohort - 1").select(
        *keys, "cohort", "period", (F.col("cohort") - 1).alias("base"), F.greatest("cohort", "period").alias("until"),
        "n", "s", "base_n", "base_s")

    def control(at: str, prefix: str) -> DataFrame:
        """What the orgs without a grant by then sum up to in the period ``at``."""
        other = cells.select(*keys, F.col("cohort").alias("_other"), F.col("period").alias("_at"), F.col("n").alias("_n"),
                             F.col("s").alias("_s"))
        asked = wanted.select(*keys, "cohort", "period", F.col(at).alias("_at"), "until")
        return asked.join(other, [*keys, "_at"]).filter("_other > until").groupBy(*keys, "cohort", "period").agg(
            F.sum("_n").alias(f"{prefix}_n"), F.sum("_s").alias(f"{prefix}_s"))

    by = [*keys, "cohort", "period"]
    out = wanted.join(control("period", "now"), by).join(control("base", "then"), by)

    def mean(n: str, s: str) -> Column:
        return F.col(s).cast("double") / F.col(n)

    return out.withColumns({
        "mean_n": mean("n", "s"), "mean_base": mean("base_n", "base_s"),
        "mean_now": mean("now_n", "now_s"), "mean_then": mean("then_n", "then_s")}).withColumn(
        "att", (F.col("mean_n") - F.col("mean_base")) - (F.col("mean_now") - F.col("mean_then"))).withColumn(
        "event_time", F.col("period") - F.col("cohort"))


def _targets(effects: DataFrame, first: int, last: int) -> DataFrame:
    """Each effect once for its event time and, from the grant on, once for the
    average over all event times (event_time null)."""
    near = effects.filter(F.col("event_time").between(first, last))
    total = effects.filter("event_time >= 0").withColumn("event_time", F.lit(None).cast("int"))
    return near.unionByName(total)


def event_time_effects(effects: DataFrame, first: int = -4, last: int = 8, keys: list[str] | None = None) -> DataFrame:
    """Cohort effects joined by time since the grant, weighted by the cohort's
    rollouts; event_time null is the average from the grant on."""
    return _targets(effects, first, last).groupBy(*(keys or []), "outcome", "event_time").agg(
        F.count("*").alias("n_cells"), F.sum("n").alias("n_rollouts"),
        (F.sum(F.col("n") * F.col("att")) / F.sum("n")).alias("effect"))


def influence_errors(per_org: DataFrame, effects: DataFrame, first: int = -4, last: int = 8) -> DataFrame:
    """Standard errors of ``event_time_effects`` with orgs as clusters: every
    cell mean's influence is spread over the rollouts it is made of, that of the
    cohorts' weights over the rollouts they count; it is summed per org, squared
    and summed; G / (G - 1) corrects for G orgs."""
    targets = _targets(effects, first, last)
    sums = targets.groupBy("outcome", "event_time").agg(
        F.sum("n").alias("_all"), (F.sum(F.col("n") * F.col("att")) / F.sum("n")).alias("_effect"))
    targets = targets.join(sums, (targets["outcome"] == sums["outcome"]) & targets["event_time"].eqNullSafe(sums["event_time"])).select(
        targets["*"], (F.col("n") / F.col("_all")).alias("w"), ((F.col("att") - F.col("_effect")) / F.col("_all")).alias("shift"))
    cohorts = per_org.select("outcome", F.col("cohort").alias("_other")).distinct()

    def piece(sign: int, period: str, n: str, mean: str, whose: Column, shift=0.0) -> Column:
        a = sign * F.col("w") / F.col(n)
        return F.struct(whose.alias("cohort"), F.col(period).alias("period"), a.alias("a"), (a * F.col(mean) - shift).alias("b"))

    own = targets.select("outcome", "event_time", F.explode(F.array(
        piece(1, "period", "n", "mean_n", F.col("cohort"), F.col("shift")), piece(-1, "base", "base_n", "mean_base", F.col("cohort")))).alias("p"))
    others = targets.join(cohorts, "outcome").filter("_other > until").select("outcome", "event_time", F.explode(F.array(
        piece(-1, "period", "now_n", "mean_now", F.col("_other")), piece(1, "base", "then_n", "mean_then", F.col("_other")))).alias("p"))
    # a column pair per event time, so that an org's row meets one row of
    # weights and its influences on all of them are summed side by side; at most
    # (periods + 1) ^ 2 cells x outcomes
    times = [*range(first, last + 1), None]

    def at(time: int | None, value: str) -> Column:
        return F.sum(F.when(F.col("event_time").eqNullSafe(F.lit(time).cast("int")), F.col(value)))

    weights = own.unionByName(others).select("outcome", "event_time", "p.*").groupBy(*CELL).agg(
        *[x for i, time in enumerate(times) for x in (at(time, "a").alias(f"a{i}"), at(time, "b").alias(f"b{i}"))])
    met = per_org.withColumn("s", F.col("s").cast("double")).join(F.broadcast(weights), CELL)
    psi = met.groupBy("outcome", "org_id").agg(
        *[F.sum(F.col(f"a{i}") * F.col("s") - F.col(f"b{i}") * F.col("n")).alias(f"psi{i}") for i in range(len(times))])
    totals = psi.groupBy("outcome").agg(
        *[x for i in range(len(times)) for x in (F.count(f"psi{i}").alias(f"g{i}"), F.sum(F.col(f"psi{i}") * F.col(f"psi{i}")).alias(f"q{i}"))])
    each = totals.select("outcome", F.explode(F.array(*[F.struct(
        F.lit(time).cast("int").alias("event_time"), F.col(f"g{i}").alias("g"), F.col(f"q{i}").alias("q"))
        for i, time in enumerate(times)])).alias("t")).select("outcome", "t.*").filter("g > 0")
    g = F.col("g")
    return each.select("outcome", "event_time", g.alias("n_orgs"), F.when(g > 1, F.sqrt(F.col("q") * g / (g - 1))).alias("se"))


# -- resampling ---------------------------------------------------------------------------

# Cumulative probabilities of a Poisson variable of mean one; beyond the last
# the chance is 1e-10.
_POISSON = []
_p = _c = 2.718281828459045 ** -1
for _k in range(1, 13):
    _POISSON.append(_c)
    _p /= _k
    _c += _p


def poisson_weight(unit, replicate) -> Column:
    """How often a unit is drawn in a replicate: Poisson(1) from a hash, the
    same for all rows of the unit and in every run."""
    u = (F.xxhash64(F.lit("bootstrap"), unit, replicate).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53))
    return sum(((u >= c).cast("int") for c in _POISSON), F.lit(0))


_DIGITS = Context(prec=60)


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


_P1, _P2, _P3, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def poisson_weights(seeds: np.ndarray, replicates: int) -> np.ndarray:
    """``poisson_weight`` of many units (rows) in all replicates (columns), given
    each unit's xxhash64 with "bootstrap": the hash takes the replicate last."""
    k = np.arange(replicates, dtype=np.uint64)
    h = (seeds.view(np.uint64) + _P5 + np.uint64(4))[:, None] ^ (k * _P1)
    h = _rotated(h, 23) * _P2 + _P3
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    u = ((h ^ (h >> np.uint64(32))) & np.uint64((1 << 53) - 1)) / float(1 << 53)
    w = np.zeros(u.shape, np.int64)
    for c in _POISSON:
        more = u >= c
        if not more.any():
            break
        w += more
    return w


def _summed(by: list[str], replicates: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task and cell: the weighted sums of all replicates at once, and how
    many rows each replicate draws. A decimal's 16 bytes are summed as the halves
    of its lower word and its upper word, so sums are exact. Memory is that of
    the cells."""
    def rows_of(cells: dict[tuple, np.ndarray], types: list[pa.Field]) -> Iterator[pa.RecordBatch]:
        for some in itertools.batched(cells.items(), 500):
            sums = np.concatenate([v for _, v in some]).tolist()
            columns = [[key[i] for key, _ in some for _ in range(replicates)] for i in range(len(by))]
            yield pa.RecordBatch.from_pydict({
                "replicate": pa.array(np.tile(np.arange(replicates, dtype=np.int32), len(some))),
                **{t.name: pa.array(c, t.type) for t, c in zip(types, columns)}, "n": pa.array([v[0] for v in sums], pa.int64()),
                "s": pa.array([_DIGITS.scaleb((v[3] << 64) + (v[2] << 32) + v[1], -8) for v in sums], pa.decimal128(38, 8)),
                "drawn": pa.array([v[4] for v in sums], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, seen, types = {}, 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.schema.field(b) for b in by]
            codes, values = np.zeros(batch.num_rows, np.int64), []
            for b in by:
                coded = batch[b].dictionary_encode(null_encoding="encode")
                values.append(coded.dictionary.to_pylist())
                codes = codes * len(values[-1]) + coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            cells, starts = np.unique(codes[order], return_index=True)
            seeds, unit = np.unique(batch["_seed"].to_numpy(), return_inverse=True)
            w = poisson_weights(seeds, replicates)[unit[order]]
            s = batch["s"]
            words = np.frombuffer(s.buffers()[1], np.int64)[2 * s.offset:2 * (s.offset + len(s))].reshape(-1, 2)[order]
            parts = [batch["n"].to_numpy()[order], words[:, 0] & 0xFFFFFFFF, (words[:, 0] >> 32) & 0xFFFFFFFF, words[:, 1]]
            found = np.stack([np.add.reduceat(x, starts) for x in [*(w * p[:, None] for p in parts), (w > 0).astype(np.int64)]], axis=2)
            for code, sums in zip(cells.tolist(), found):
                key = []
                for v in reversed(values):
                    code, at = divmod(code, len(v))
                    key.append(v[at])
                key = tuple(reversed(key))
                if key in kept:
                    kept[key] += sums
                else:
                    kept[key] = sums.copy()
            seen += batch.num_rows
            if seen > 1 << 26:  # far from where sums of halves would pass 63 bits
                yield from rows_of(kept, types)
                kept, seen = {}, 0
        yield from rows_of(kept, types)

    return run


def resampled(rows: DataFrame, unit: str, by: list[str], replicates: int) -> DataFrame:
    """Weighted sums of n and s per replicate and ``by``, in one grouped pass:
    each row counts in the replicates that draw its unit. A task sums its rows
    with the weights of all replicates, so no row is repeated for them."""
    seeded = rows.select(F.xxhash64(F.lit("bootstrap"), F.col(unit)).alias("_seed"), *by, F.col("n").cast("long").alias("n"),
                         F.coalesce(F.col("s"), F.lit(0)).cast("decimal(38,8)").alias("s"))
    schema = T.StructType([T.StructField("replicate", T.IntegerType()), *[T.StructField(b, rows.schema[b].dataType) for b in by],
                           T.StructField("n", T.LongType()), T.StructField("s", T.DecimalType(38, 8)), T.StructField("drawn", T.LongType())])
    return seeded.mapInArrow(_summed(by, replicates), schema).filter("drawn > 0").groupBy("replicate", *by).agg(
        F.sum("n").alias("n"), F.sum("s").cast("decimal(38,8)").alias("s"))


def bootstrap_errors(per_org: DataFrame, replicates: int = 100, first: int = -4, last: int = 8) -> DataFrame:
    """Standard deviation and 95 % interval of the event-time effects over
    bootstrap replicates of orgs."""
    cells = materialize(resampled(per_org, "org_id", CELL, replicates), "replicate-cells")
    each = event_time_effects(cohort_effects(cells, ["replicate"]), first, last, ["replicate"])
    return each.groupBy("outcome", "event_time").agg(
        F.count("*").alias("replicates"), F.stddev_samp("effect").alias("se_bootstrap"),
        F.percentile("effect", F.lit(0.025)).alias("low"), F.percentile("effect", F.lit(0.975)).alias("high"))


def staggered_did(impl: DataFrame, support: DataFrame, at_least: float = 0.0, first: int = -4, last: int = 8,
                  outcomes: dict[str, Column] | None = None) -> DataFrame:
    """Event-time effects with org-clustered errors."""
    outs = outcomes or did_outcomes()
    per_org = _by_outcome(materialize(org_sums(impl, first_grant(support, at_least), outs), "org-sums"), outs)
    cells = materialize(per_org.groupBy(*CELL).agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,8)").alias("s")), "cells")
    effects = materialize(cohort_effects(cells), "cohort-effects")
    found, errors = event_time_effects(effects, first, last), influence_errors(per_org, effects, first, last)
    return found.join(errors, (found["outcome"] == errors["outcome"]) & found["event_time"].eqNullSafe(errors["event_time"])).select(
        found["*"], "n_orgs", "se")
