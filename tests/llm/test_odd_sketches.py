import re

import numpy as np
import pandas as pd
import pytest

from tidewater.llm import odd_sketches as O
from tidewater.llm.shingles import shingle_sets


def brute_force(docs):
    """All pairs of sets of word tuples."""
    sets = {}
    for i, (_, text) in enumerate(docs):
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = frozenset(tuple(w[i:i + 2]) for i in range(max(1, len(w) - 1))) if w else frozenset()
    different = sorted(set(sets.values()), key=len)
    root = {s: s for s in different}

    def find(x):
        while root[x] is not x:
            x = root[x]
        return x

    for i, a in enumerate(different):
        for b in different[i + 1:]:
            both = len(a & b)
            if both and 100 * both >= 80 * (len(a) + len(b) - both):
                root[find(a)] = find(b)
    least = {}
    for i, s in sets.items():
        if s and docs[i][0] is not None:
            least[find(s)] = min(least.get(find(s), docs[i][0]), docs[i][0])
    out = []
    for i, (doc, _) in enumerate(docs):
        comp = least.get(find(sets[i])) if sets[i] else doc
        out.append((doc, len(sets[i]), comp, doc == comp))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_all_pairs(docs, rows):
    assert result(O.near_duplicates(docs)) == brute_force(rows)


def test_odd_ids_and_empty(spark, odd, none):
    got = result(O.near_duplicates(odd))
    assert got == brute_force([tuple(r) for r in odd.collect()])
    df = O.near_duplicates(none)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"] and df.count() == 0


def family(rng, base, members, most, words=60):
    """Edited copies of one base; edits come from few words, so that members
    may be nearer to each other than to the base."""
    for _ in range(members):
        out = list(base)
        for i in rng.choice(len(out), rng.integers(0, most + 1), replace=False):
            out[i] = f"r{rng.integers(6)}"
        yield " ".join(out[:len(out) - int(rng.integers(0, 4))])


@pytest.mark.parametrize("most", [4, 9])
def test_large_families_lose_no_link(spark, most):
    """Buckets of hundreds of members, of which many link to others than the
    most central one only."""
    rng = np.random.default_rng(most)
    bases = [[f"b{k}-{i}" for i in range(n)] for k, n in enumerate((60, 90, 25))]
    texts = [t for base in bases for t in family(rng, base, 330, most)]
    docs = [(int(d), t) for d, t in zip(rng.permutation(5000), texts)]
    got = result(O.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)))
    assert got == brute_force(docs) and len({g[2] for g in got}) > 5


def test_blocks_join_what_similar_pairs_join(spark):
    """Far from the bucket's centre: chains of members that only their
    neighbours resemble."""
    rng = np.random.default_rng(2)
    stem = [f"s{i}" for i in range(40)]
    tokens, n = [], 90
    for i in range(n):
        tokens.append(next(iter(shingle_sets([" ".join(stem + [f"c{j}" for j in range(i, i + 20)])], 2))))
    samples = O.folded(O.samples_of(tokens))
    order = rng.permutation(n)
    block = pd.DataFrame({"key": 1, "i": 0, "j": 0, "node": np.arange(n), "comp": np.arange(n), "n": [len(t) for t in tokens],
                          "sketch": list(samples), "tokens": tokens}).iloc[order]
    block = pd.concat([block.assign(asks=True), block.assign(asks=False)])
    links = O.block_links(block)
    assert len(links) == n - 1 and (abs(links.a - links.b) <= 4).all()


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(1)
    for similarity in (0.7, 0.8, 0.9, 0.97):
        both = int(2000 * similarity)
        flips = []
        for _ in range(60):
            pool = rng.integers(1, 1 << 63, 2000, dtype=np.uint64)
            only = (2000 - both) // 2
            a, b = np.sort(pool[:both + only]), np.sort(np.concatenate([pool[:both], pool[both + only:]]))
            x, y = O.folded(O.samples_of([a, b])).view(np.uint64)
            flips.append(int(np.bitwise_count(x ^ y).sum()))
        assert abs(np.mean(O.estimated_similarity(np.array(flips))) - similarity) < 0.02
        assert similarity < 0.8 or max(flips) <= O.MOST_FLIPS


def test_most_flips_bounds_the_risk():
    assert O.most_flips(0.8, risk=0.5) < O.most_flips(0.8, risk=1e-3) < O.MOST_FLIPS < O.BITS / 2
    assert (1 - 0.8 ** O.BAND_ROWS) ** O.BANDS < 2e-11
