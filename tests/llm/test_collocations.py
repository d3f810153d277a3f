import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def brute_force(rows, least, top=2000):
    """Every phrase of every piece counted one by one, in Python integers."""
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(5, len(w) - i) + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {}
    many = [(lang, g, a) for (lang, g), a in f.items() if len(g) > 1 and a >= least]
    for lang, g, a in many:
        if any(y == lang and len(h) > len(g) and b >= a and any(h[i:i + len(g)] == g for i in range(len(h)))
               for y, h, b in many):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, best in found.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1))


def phrases(df):
    return sorted(tuple(r) for r in df.collect())


def words(rng, n, vocabulary):
    at = np.minimum(rng.zipf(1.3, n) - 1, vocabulary - 1)
    seps = rng.choice([" ", " ", " ", " ", "  ", "\t", ", ", ".", "! ", "\n", "\x0b"], n)
    return "".join(f"{'W' if i % 3 else 'w'}{i}{s}" for i, s in zip(at, seps))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    stock = "the quick brown fox jumps over the lazy dog. Once upon a time"
    out = [(i, words(rng, int(rng.integers(1, 120)), 40) + (stock if i % 3 == 0 else ""), ["en", "de", None][i % 3 - (i % 7 == 0)])
           for i in range(120)]
    return out + [(200, None, "en"), (201, "", "fr"), (202, " \t.,;", "fr"), (203, "a a a a a a a a", "fr"), (203, "a a a a a a a a", "fr"),
                  (None, "Ärger über Ärger über ÄRGER ! İ i̇ nul\x00 x\x00", "und"), (204, "x " * 3000, "es"), (205, "é" * 700 + " z", "es")]


@pytest.mark.parametrize("least,top", [(2, 2000), (5, 2000), (3, 7), (120, 50)])
def test_equals_counting_every_phrase(spark, rows, least, top):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    docs = docs.select("*", *[F.lit(None).cast("int").alias(c) for c in ("n", "w1", "f", "words", "id", "segment", "rank")])
    got = phrases(C.collocations(docs, least=least, top=top))
    assert got == brute_force(rows, least, top)
    assert got or least > 100


def test_without_any_pruning(spark, rows, monkeypatch):
    """All slots pass: the counts are the same."""
    monkeypatch.setattr(C, "frequent_slots", lambda texts, least, f=C.frequent_slots: (
        f(texts, least)[0], np.full(8192, 255, np.uint8)))
    assert phrases(C.collocations(spark.createDataFrame(rows, SCHEMA), least=3)) == brute_force(rows, 3)


def test_empty(spark):
    for found in ([], [(1, None, None)], [(1, "one two three", "en")]):
        df = C.collocations(spark.createDataFrame(found, SCHEMA))
        assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and df.count() == 0


def test_long_texts_are_cut_at_breaks():
    text = b"aa bb. cc dd! ee" * 50 + b"x" * 300 + b"; tail"
    parts = list(C.pieces_of(text, 64))
    assert [p for part in parts for p in re.split(rb"[.!;]", part)] == re.split(rb"[.!;]", text)
    assert max(len(p) for p in parts) < 400
    assert list(C.pieces_of(b"y" * 500, 64)) == [b"y" * 500]


@pytest.mark.parametrize("cut", [1, 2, 3, 7, 1000])
def test_flows_over_batches(cut):
    """Groups that reach over batch borders are added up."""
    rng = np.random.default_rng(cut)
    grams = rng.integers(1, 3, (400, 5))
    for row, size in zip(grams, rng.integers(1, 6, 400)):
        row[size:] = 0
    grams = grams[np.lexsort(grams.T[::-1])]
    n = rng.integers(1, 4, 400)
    want = Counter()
    for row, count in zip(grams, n):
        for k in range(1, 6):
            if row[k - 1]:
                want[(*row[:k], *[0] * (5 - k))] += count
    frame = pd.DataFrame(grams, columns=C._COLS).assign(n=n)
    got = Counter()
    for out in C._flows(1)(frame.iloc[i:i + cut] for i in range(0, 400, cut)):
        for r in out.itertuples(index=False):
            got[(r.w1, r.w2, r.w3, r.w4, r.w5)] += r.f
    assert got == want
