import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import common
from tidewater.llm import exact_dedup as E
from tidewater.llm import graph
from tidewater.llm import ngram_join as N


def test_exact_groups_match_plain_grouping(docs, rows):
    norm = {d: re.sub("[\x20\x09-\x0d]+", " ", t or "") for d, t in rows}
    got = {r.doc_id: r for r in E.duplicate_groups(docs).collect()}
    assert len(got) == len(rows)
    for d, t in norm.items():
        same = sorted(x for x, y in norm.items() if y == t)
        assert (got[d].keep_id, got[d].group_size, got[d].kept) == (same[0], len(same), d == same[0])
        assert got[d].text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_exact_drop_keeps_columns_and_one_row_of_each_text(docs, rows, odd):
    left = E.drop_duplicates(docs)
    assert left.columns == docs.columns
    norm = Counter(re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows)
    assert left.count() == len(norm)
    kept = Counter((r.doc_id, r.text) for r in E.drop_duplicates(odd).collect())
    assert sum(kept.values()) == 4 and set(kept.values()) == {1}  # BASE, null, the near copy, another text


def test_exact_on_an_empty_table(none):
    assert E.duplicate_groups(none).count() == 0


def test_bloom_flags_every_repeated_digest(spark):
    import pandas as pd

    rng = np.random.default_rng(3)
    digests = [rng.bytes(32) for _ in range(3000)]
    repeated = set(digests[:50])
    df = spark.createDataFrame(pd.DataFrame({"digest": digests + digests[:50]})).repartition(5)
    rows = E.possibly_repeated(df, 3050).collect()
    assert all(r.maybe for r in rows if bytes(r.digest) in repeated)
    assert sum(r.maybe for r in rows) < 200


def test_a_full_filter_changes_nothing(monkeypatch, docs, rows):
    monkeypatch.setattr(E, "filter_bits", lambda n: E.SEGMENT_BITS)
    monkeypatch.setattr(E, "_slots", lambda d, bits: np.zeros((len(d), E.PROBES), np.uint32))
    assert sum(r.kept for r in E.duplicate_groups(docs).collect()) == len(
        {re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows})


def test_near_components_match_all_pairs(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(docs).collect()}
    assert got == N.brute_force(rows)
    assert got[9013][1] == got[9014][1] == 9010 and got[9015][1] == 9015
    assert got[9005][1] == got[9006][1] and got[9001] == (0, 9001)


def test_near_odd_ids_and_empty(odd, none):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.near_duplicates(odd).collect()), key=str)
    assert [g for g in got if g[0] == 1] == [(1, 116, 1)] * 2
    assert (2, 116, 1) in got and (2, 1, 2) in got and (3, 0, 3) in got
    assert (None, 116, 1) in got and (None, 0, None) in got
    assert N.near_duplicates(none).count() == 0


def test_near_finds_links_between_many_random_copies(spark):
    """A family around one base with zero to nine edits: some members link
    only to others than the pivot."""
    rng = np.random.default_rng(5)
    base = [f"t{i}" for i in range(90)]
    rows = []
    for d in range(160):
        words = list(base)
        for i in rng.choice(90, rng.integers(0, 7), replace=False):
            words[i] = f"r{rng.integers(40)}"
        rows.append((d, " ".join(words[:90 - int(rng.integers(0, 8))])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    ref = N.brute_force(rows)
    assert got == ref and len({c for _, c in ref.values()}) > 5


def test_near_drop_leaves_one_row_of_each_group(spark, docs, rows, odd, none):
    left = N.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    want = N.brute_force(rows)
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, (_, c) in want.items() if d == c)
    kept = Counter((r.doc_id, r.text) for r in N.drop_near_duplicates(odd).collect())
    base = odd.filter("doc_id = 1").first().text
    assert kept == {(1, base): 1, (2, "another text"): 1, (3, None): 2, (None, None): 1}
    assert N.drop_near_duplicates(none).columns == none.columns and N.drop_near_duplicates(none).count() == 0
    unnamed = spark.createDataFrame([(None, base), (None, base + " end"), (None, "other words")], "doc_id long, text string")
    assert len({r.text for r in N.drop_near_duplicates(unnamed).collect()}) == N.drop_near_duplicates(unnamed).count() == 2


def test_rows_that_the_filters_cannot_tell_are_joined(spark, monkeypatch):
    """Filters of eight bits: nearly every row is met in the exact join."""
    monkeypatch.setattr(common.IdFilter, "__init__", _tiny(common.IdFilter.__init__))
    rows = [(i % 300, f"text {i % 400}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    least = {}
    for d, t in rows:
        least[t] = min(d, least.get(t, d))
    assert sorted((r.doc_id, r.text) for r in E.drop_duplicates(docs).collect()) == sorted((d, t) for t, d in least.items())


def _tiny(init):
    def made(self, ids, col, per_id=16, max_bits=1 << 28):
        init(self, ids, col, per_id, 8)
    return made


@pytest.mark.parametrize("links", [[], [(1, 1)], [(1, 2), (2, 3), (5, 4), (7, 6), (6, 5)], [(i, i + 1) for i in range(40)]])
def test_components(spark, links):
    found = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    root = {}
    for a, b in links:
        root.setdefault(a, a)
        root.setdefault(b, b)
    for _ in links:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    want = {n: r for n, r in root.items() if any(n in l for l in links if l[0] != l[1])}
    assert {r.node: r.root for r in found} == want
