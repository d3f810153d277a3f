import random
import zlib

from tidewater.llm import language_model as L


def test_context_of_more_than_four_bytes_counts(spark):
    """The letter after "aaaaa" follows from the one before it, six bytes back."""
    rng = random.Random(6)
    rows = [(d, "".join(rng.choice(["qaaaaax", "waaaaay"]) for _ in range(60))) for d in range(200)]
    got = [r for r in L.score(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.held_out]
    assert len(got) == sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 5
    assert all(r.bits_per_byte < 1.3 / 7 for r in got)  # one bit in seven bytes is drawn; without that context two are


def test_counts_sent_in_parts_are_the_same(spark, monkeypatch):
    rows = spark.createDataFrame([(d, f"text {d} of some words {d * 7919}") for d in range(300)], "doc_id long, text string").coalesce(1)
    one = sorted(map(tuple, L.score(rows).collect()))
    monkeypatch.setattr(L, "HELD_KEYS", 10)
    assert sorted(map(tuple, L.score(rows).collect())) == one
