import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from tidewater.llm import language_model as L
from tidewater.llm import packing as K
from tidewater.llm import toxicity as X
from tidewater.llm import warc as W
from tidewater.session import scratch_path


def test_packing_round_trip(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(K.default_tokenizer())
    pieces = K.pack(docs).collect()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    for d, t in rows:
        want = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        mine = sorted(by_doc[d], key=lambda p: p.start)
        assert [i for p in mine for i in p.ids] == want
        at = 0
        for p in mine:
            assert p.start == at and p.offset == 0 and p.doc_tokens == len(want)
            assert p.length & (p.length - 1) == 0 and p.length <= 2048
            assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
            at += p.length
        assert len(mine) == len(want) // 2048 + bin(len(want) % 2048).count("1")


def test_packing_odd_and_empty(odd, none):
    assert K.pack(odd).filter("start = 0").count() == 8
    assert K.pack(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 5000])
def test_binary_cuts(n):
    cuts = K.binary_cuts(n)
    assert sum(size for _, size in cuts) == n and [s for _, s in cuts] == sorted((s for _, s in cuts), reverse=True)


def test_language_model_matches_dictionaries(docs, rows, monkeypatch):
    some = [r for r in rows if r[0] < 30 or r[0] in (9001, 9002, 9003, 9021, 9030)]
    want = L.brute_force(some)
    chosen = docs.filter(docs.doc_id.isin([r[0] for r in some]))
    for head, piece in ((1 << 19, 1 << 18), (200, 500)):  # all in the head and whole; mostly joined and in pieces
        monkeypatch.setattr(L, "HEAD_STRINGS", head)
        monkeypatch.setattr(L, "HEAD_WORDS", head)
        monkeypatch.setattr(L, "PIECE", piece)
        got = {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in L.score(chosen).collect()}
        assert set(got) == set(want)
        for d, w in want.items():
            assert got[d][:4] == w[:4]
            assert got[d][4:] == pytest.approx(w[4:], rel=1e-9)


def test_language_model_odd_and_empty(odd, none):
    got = L.score(odd).collect()
    assert len(got) == 8 and all(r.held_out for r in got if r.doc_id is None)
    assert L.score(none).count() == 0


def test_string_probabilities_sum_to_one(spark):
    """Over all bytes in one context, seen or not."""
    rows = [(int.from_bytes(b"abcd" + bytes([s])), 5 * (s == 101) + 2 * (s == 102), 1) for s in range(256)]
    df = spark.createDataFrame(rows, "key long, train long, total long").repartition(2, "total")
    total = sum(10 ** r.value for r in L.string_scores(df).collect())
    assert total == pytest.approx(1, rel=1e-9)


def test_log_kt_matches_lgamma():
    for a, b in [(0, 0), (1, 0), (3, 9), (1500, 20), (123456, 654321)]:
        want = math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)
        assert L.log_kt(np.array([a], float), np.array([b], float))[0] == pytest.approx(want, rel=1e-10, abs=1e-9)


def test_toxicity_on_held_out_rows(spark, none):
    rng = random.Random(4)
    vocabulary, bad = [f"word{i}" for i in range(300)], ["vileone", "grimly", "nastiest", "foulish", "meanest", "wretch"]
    rows, labels = [], []
    for d in range(1500):
        words = rng.choices(vocabulary, k=rng.randint(20, 60))
        toxic = d % 9 == 0
        if toxic:
            words += rng.sample(bad, 3)
        rng.shuffle(words)
        rows.append((d, " ".join(words)))
        labels.append((d, int(toxic) if d % 50 else None))
    rows += [(5000, None), (5001, ""), (None, "vileone grimly wretch")]
    labels += [(1, 0), (1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'old' as score", "1 as extra")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = X.fit(docs, marks)
    assert {e[2:] for e in model.entries if e[0] == "w"} <= set(bad) | set(vocabulary) and len(model.accuracies)
    out = X.scored(docs, model).collect()
    assert len(out) == len(rows) and out[0].extra == 1
    judged = [(r.predicted, int(r.doc_id % 9 == 0)) for r in out if r.held_out and r.doc_id is not None and r.doc_id < 1500]
    assert sum(p == y for p, y in judged) >= 0.98 * len(judged)
    held = {r.doc_id: r.held_out for r in out}
    assert all(held[d] == (zlib.crc32(str(d).encode()) % 5 == 0) for d in range(1500))
    assert all(0 <= r.score <= 1 for r in out) and not any(r.predicted for r in out if r.doc_id in (5000, 5001))
    left = X.drop_toxic(docs, model)
    assert left.columns == docs.columns and left.filter("score = 'old'").count() == left.count()
    assert X.scored(none, model).count() == 0
    nothing = X.fit(docs, marks.filter("false"))
    assert {r.score for r in X.scored(docs, nothing).collect()} == {0.0}


def test_label_model_recovers_planted_accuracies():
    """Two voters copy each other, two are independent."""
    rng = np.random.default_rng(8)
    n, share = 200_000, 0.2
    y = rng.random(n) < share
    def vote(hit, miss):
        return np.where(y, rng.random(n) < hit, rng.random(n) < miss)
    a, b, c, d = vote(.7, .02), vote(.5, .01), vote(.6, .05), vote(.4, .02)
    v = np.stack([a, b, c, d, np.where(rng.random(n) < .9, d, vote(.4, .02))], axis=1).astype(float)
    _, accuracy, within = X.label_model(v.T @ v, n, share, 5)
    assert accuracy[:3] == pytest.approx([.68, .49, .55], abs=.05)
    assert within[3, 4] > 5 * abs(within[0, 1])


def test_warc_round_trip(spark):
    same = "x" * 1200
    rows = [(1, "http://www.A.org:80/b?c#d", "<p>é\r\n\r\nWARC/1.1 bait</p>"), (2, None, None), (3, "http://a.org/\r\nX: y", same),
            (4, "https://b.org/", same), (5, "not a url", same), (None, "http://n.org", same), (6, "http://a.org/s", "y" * 999),
            (7, "http://a.org/s", "y" * 999), (8, "http://a.org/z", same), (8, "http://a.org/z", same)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as page", "3 as size").repartition(3)
    index = W.capture_index(spark, W.write_archives(pages, scratch_path(spark, "t-warc")))
    got = index.collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page, []).append(r)
    for page, _, html in rows:
        raw = (html or "").encode()
        for r in by[None if page is None else str(page)]:
            assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
            again = html == same and page != 8
            assert (r.record_type, r.refers) == (("revisit", "8") if again else ("response", None))
    order = [W._order(tuple(r)) for r in got]
    assert order == sorted(order)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.capture_index(spark, W.write_archives(empty, scratch_path(spark, "t-warc"))).count() == 0


def test_archives_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 20_000)
    pages = spark.range(60).selectExpr("id page_id", "concat('http://h.org/', id % 4) url", "repeat(cast(id as string), 1500) html").coalesce(1)
    path = W.write_archives(pages, scratch_path(spark, "t-warc"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    assert len(files) > 5 and sum(len(list(W.parse_archive(f.path, f.content))) for f in files) == 60


def test_loser_tree():
    rng = random.Random(1)
    for k in range(12):
        runs = [sorted((rng.randrange(50),) for _ in range(rng.randrange(9))) for _ in range(k)]
        assert list(W.LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)


@pytest.mark.parametrize("url,key", [
    ("http://www.Example.com:80/a/b?q=1#f", "com,example)/a/b?q=1"), ("https://x.y.org:8443", "org,y,x:8443)/"),
    (None, ""), ("nonsense", "nonsense"), ("http://[bad", "http://[bad")])
def test_url_key(url, key):
    assert W.url_key(url) == key
