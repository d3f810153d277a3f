import hashlib

import numpy as np
import pytest

from tidewater.llm import decontaminate as D
from tidewater.llm import passages as S
from tidewater.llm import pii as P
from tidewater.llm import repeats as R

from .conftest import BASE, near


def test_repeats_match_brute_force(docs, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.drop_repeats(docs, with_bytes=False).collect()}
    assert got == R.brute_force(rows)
    assert got[9011][1] == got[9011][0] and got[9032][1] > 600


def test_repeats_odd_ids_short_chunks_and_empty(odd, none, monkeypatch):
    rows = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in R.drop_repeats(odd).collect()), key=str)
    size = len(BASE)
    assert rows.count((1, size, size)) == 2  # the null id's copy comes first
    assert (None, size, 0) in rows and (3, 0, 0) in rows
    assert R.drop_repeats(none).count() == 0


def test_cells_do_not_depend_on_where_chunks_end(monkeypatch):
    text = "".join(chr(97 + int(c)) for c in np.random.default_rng(1).integers(0, 26, 5000))
    whole = [(at + o[p], int(k)) for c, s, d, o in R.chunks([text], 100) for at, n, _, h in [c.cells(s, 100, 24)]
             for at, n, k, p in zip(at, n, h, np.searchsorted(s, at, "right") - 1)]
    assert sum(n for c, s, d, o in R.chunks([text], 100) for n in c.cells(s, 100, 24)[1]) == 5000 - 99
    assert len(whole) < 200


ITEMS = [("i1", BASE), ("i2", "base3 base4"), ("i3", None), ("i4", "..."), ("i5", BASE), (None, "base50 base51 base52"),
         ("10", " ".join(f"base{i}" for i in range(40, 52))), ("9", "One")]


def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string")


def test_decontamination_matches_brute_force(spark, docs, rows):
    got = {r.doc_id: tuple(r)[1:] for r in D.digest(D.scan(docs, bench(spark))).collect()}
    want = D.brute_force(rows, [i for i in ITEMS if i[0] is not None])
    null = D.brute_force(rows, ITEMS)
    assert set(got) == set(want)
    for d, r in got.items():
        assert r[2:4] == want[d][2:4] and (r[0], r[1], r[4]) == (null[d][0], null[d][1], null[d][4])


def test_decontamination_in_shards_is_the_same(spark, docs, monkeypatch):
    one = sorted(map(tuple, D.digest(D.scan(docs, bench(spark))).collect()))
    monkeypatch.setattr(D, "SHARD_WORDS", 20)
    assert sorted(map(tuple, D.digest(D.scan(docs, bench(spark))).collect())) == one


def test_decontaminate_cuts_only_hit_runs(spark, docs, none):
    before = {r.doc_id: r.text for r in docs.collect()}
    clean = D.decontaminate(docs, bench(spark))
    assert clean.columns == docs.columns
    after = {r.doc_id: r.text for r in clean.collect()}
    assert 9010 not in after and after[9015] != before[9015]
    assert all(after[d] == t for d, t in before.items() if t and "base" not in t.lower() and "one" not in t.lower())
    assert D.decontaminate(none, bench(spark)).count() == 0
    assert D.decontaminate(docs, spark.createDataFrame([], "item_id string, text string")).count() == len(before)


def test_base_spans_match_python(spark, none):
    texts = ["a@b@c.d", "a@b.c_d@e.f", "x a@b.c.@x.y", "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004", "4111 1111 1111 1111",
             "4111-1111-1111-1111 5", "+1 (203) 555-8282. +44", "😀 é a.b@c.de 1.1.1.1", None, "", "+12345678901234567 +1234567890",
             "5 5 5", "a" * 30000, "1." * 10000, "+1" + "(" * 3000, "1 " * 20000, "password=ab12cd34ef56ab78cd90 call (415) 555-1234"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in P.find_pii(docs.selectExpr("*", "1 as kind", "2 as score", "3 as start")).collect()}
    for d, want in P.brute_force(rows).items():
        assert (got[d].n_email, got[d].n_ip, got[d].n_card, got[d].n_phone, got[d].base_sha256) == want
    assert got[8].spans == "" and got[8].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert P.find_pii(none).count() == 0


def test_added_spans_and_redaction(spark, odd):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        key = "".join(rng.choice(list("0123456789abcdef"), 24))
        rows.append((i, f"word password={key} tail" if i % 2 else f"plain {'lorem' * 4} +1 415-555-{1000 + i} x 1.2.3.{i}"))
    rows += [(1000, "token: 9f8e7d6c5b4a39281706f5e4 end"), (1001, "nothing here"), (1002, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in P.find_pii(docs).collect()}
    assert "secret:7:31" in found[1000] and found[1001] == ""
    text = {r.doc_id: r.text for r in P.redact(docs).collect()}
    assert text[1000] == "token: [SECRET] end" and text[1001] == "nothing here" and text[1002] is None
    assert P.find_pii(odd).count() == 8


def test_chain_prefers_the_cheaper_order():
    line = [(i, i + 100) for i in range(0, 60, 5)]
    noise = [(7, 300), (22, 20), (41, 250)]
    best = S.chains(line + noise)
    assert best[0] == line and len(best) == 1
    assert S.chains([(0, 5), (10, 3)]) == []


def test_passages_exact_fuzzy_and_odd(spark, odd, none):
    filler = [" ".join(f"f{d}_{i}" for i in range(70)) for d in range(8)]
    rows = [(1, f"{filler[0]} {BASE} {filler[1]}"), (2, f"{filler[2]} {BASE}"), (3, f"{near(BASE, 20, 55, 90)} {filler[3]}"),
            (4, f"{filler[4]} {' '.join(BASE.split()[:30])} {filler[5]}"), (5, filler[6]), (6, None), (7, "")]
    got = {r.doc_id: r for r in S.find_passages(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as seed", "2 as doc")).collect()}
    assert set(got) == {2, 3}
    assert (got[2].start_word, got[2].end_word, got[2].source_doc_id, got[2].source_start, got[2].identity) == (70, 190, 1, 70, 1.0)
    assert (got[3].start_word, got[3].end_word, got[3].matched_words) == (0, 120, 117)
    assert {r.doc_id for r in S.find_passages(odd).collect()} <= {1, 2}
    assert S.find_passages(none).count() == 0
    left = {r.doc_id: r.text for r in S.drop_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left[2] == filler[2] and left[3] == filler[3] and left[6] is None


def test_pii_model_is_fitted_on_half_of_all_known_candidates(spark, monkeypatch):
    from tidewater.llm import pii

    class Fitted(Exception):
        pass

    class Recorder:
        def __init__(self, **_):
            pass

        def fit(self, rows):
            raise Fitted(rows.count())

    monkeypatch.setattr(pii, "GBTClassifier", Recorder)
    docs = spark.range(6_000).selectExpr("id doc_id", "concat('a', id, '@b.org at 1.2.3.', id % 300, ' and 9.9.', id, '.1') text")
    with pytest.raises(Fitted) as found:
        pii.find_pii(docs)
    assert found.value.args[0] > 15_000  # a sample of 20,000 would give 10,000
