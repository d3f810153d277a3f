import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, score long, anchor long, packed binary, row_no string"
OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, "x") for r in rows], SCHEMA).repartition(3)


def brute_force(rows):
    """Every anchor against every row, in plain Python integers."""
    known = [(i, v, label, [math.floor(256 * float(np.float32(x))) for x in vec])
             for i, (v, vec, label) in enumerate(rows)
             if v is not None and label is not None and vec is not None
             and all(x is not None and math.isfinite(x) for x in vec)]
    out = []
    for i, a, label, q in known:
        if a % 100:
            continue
        ranked = sorted(((-sum(x * y for x, y in zip(q, w)), b, other) for j, b, other, w in known if j != i))
        for p, b, other in [r for r in ranked if r[2] == label][:5]:
            foes = [r for r in ranked if r[2] != label and -80 * p <= -100 * r[0] <= -100 * p][:5]
            out += [(a, b, n, foe[1], -p, -foe[0]) for n, foe in enumerate(foes, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(OUT).collect())


@pytest.mark.parametrize("dims", [1, 8, 13, 64])
def test_equals_all_scores(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(int(i), [float(x) for x in rng.normal(0.2, 0.3, dims)], int(rng.integers(3))) for i in range(0, 900, 4)]
    got = rows_of(H.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0))
    assert got == brute_force(rows) and got


def test_nulls_ties_repeats_and_short_vectors(spark):
    one, two = [0.5, 0.25, -0.125], [0.4, 0.25, -0.125]
    rows = ([(0, one, 1), (100, one, 1), (100, one, 1), (7, one, 1), (8, one, 2), (9, one, 2), (9, one, 2), (3, two, 2), (4, two, 0)]
            + [(300, one, None), (400, None, 1), (500, [None, 1.0, 1.0], 1), (600, [float("nan"), 0.0, 0.0], 2),
               (700, [float("inf"), 0.0, 0.0], 2), (None, one, 2), (800, [], 1), (11, [0.5], 2)])
    got = rows_of(H.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0))
    assert got == brute_force(rows)
    assert {r[0] for r in got} == {0, 100, 800} and None not in {r[3] for r in got}


def test_many_equal_vectors(spark):
    rows = [(i, [0.25, -0.5], i % 2) for i in range(500)]
    assert rows_of(H.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0)) == brute_force(rows)


def test_many_chunks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 9)], int(rng.integers(4))) for i in range(0, 1500, 5)]
    monkeypatch.setattr(H, "ANCHORS_PER_CHUNK", 3)
    assert rows_of(H.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0)) == brute_force(rows)


def test_empty_and_no_anchors(spark):
    for rows in ([], [(1, [0.5], 1), (2, [0.5], 2)]):
        df = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0)
        assert df.columns == OUT and df.count() == 0


def test_huge_components_are_an_error(spark):
    with pytest.raises(ValueError):
        H.hard_negatives(frame(spark, [(0, [1e30], 1)]), F.col("vec_id") % 100 == 0)


@pytest.mark.parametrize("planes", [2, 9, 23])
def test_planes_and_tables_give_inner_products(planes):
    rng = np.random.default_rng(planes)
    most = 1 << (planes - 1)
    values = rng.integers(-most, most, (50, 24))
    packed = H.packed_planes(values, planes)
    assert (H.unpacked(packed) == values).all()
    assert (H.scores(packed, H.subset_sums(values[:7])) == values @ values[:7].T).all()
