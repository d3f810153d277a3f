"""Exact deduplication with two-pass Bloom filtering.

Pass 1 reads the texts once, keeps a SHA-256 of each normalised text and sets
bits for it in a pair of bit arrays: ``once`` (some text set this bit) and
``twice`` (at least two did). Pairs from different tasks merge associatively.
Pass 2 tests every row: a row whose bits are all in ``twice`` possibly repeats
and is shuffled by its digest; every other row is certainly unique and passes
straight through. False positives only cost shuffle, never change the result.

Defined results: a null text counts as empty, empty texts equal each other;
a null id sorts first; of rows that agree in text and id, one arbitrary row
stays; an empty table gives an empty table. Extra columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import attach, keep_rows, table
from tidewater.session import materialize

SEGMENT_BITS = 1 << 20
PROBES = 4
# The broadcast filter never exceeds this (128 MB). A larger corpus gets a
# fuller filter: more rows are shuffled, the result is the same.
MAX_BITS = 1 << 30


def normalised(text: str):
    """Every run of white space becomes one blank; null becomes empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]{2,}|[\\x09-\\x0D]", " ")


def filter_bits(rows: int) -> int:
    """16 bits a row, a power of two between one segment and MAX_BITS."""
    return min(MAX_BITS, max(SEGMENT_BITS, 1 << (16 * max(rows, 1) - 1).bit_length()))


def _slots(digests: pd.Series, bits: int) -> np.ndarray:
    """Bit positions of each digest, one row per digest, a column per probe."""
    words = np.frombuffer(b"".join(bytes(d) for d in digests), dtype="<u8").reshape(-1, 4)
    return (words[:, :PROBES] & np.uint64(bits - 1)).astype(np.uint32)


def _pack(slots: np.ndarray) -> bytes:
    dense = np.zeros(SEGMENT_BITS, dtype=bool)
    dense[slots] = True
    return np.packbits(dense).tobytes()


def _local_filters(bits: int):
    """Per task: the once/twice arrays of its rows, cut into segments. A
    segment with few set bits is sent as positions, a full one as bits."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once = np.zeros(0, np.uint32)
        twice = np.zeros(0, np.uint32)
        for batch in batches:
            if len(batch):
                slots = np.sort(_slots(batch["digest"], bits), axis=1)
                own = np.ones(slots.shape, bool)  # a row counts once for a bit that two of its probes share
                own[:, 1:] = slots[:, 1:] != slots[:, :-1]
                mine = slots[own]
                seen, count = np.unique(mine, return_counts=True)
                again = np.concatenate([seen[count > 1], np.intersect1d(once, seen, assume_unique=True)])
                twice = np.union1d(twice, again)
                once = np.union1d(once, seen)
        segment = once // SEGMENT_BITS
        for s in np.unique(segment):
            a = (once[segment == s] % SEGMENT_BITS).astype(np.uint32)
            b = (twice[twice // SEGMENT_BITS == s] % SEGMENT_BITS).astype(np.uint32)
            dense = 4 * len(a) > SEGMENT_BITS // 8
            yield pd.DataFrame({"segment": [int(s)], "dense": [dense],
                                "once": [_pack(a) if dense else a.tobytes()],
                                "twice": [_pack(b) if dense else b.tobytes()]})
    return run


def _merge_segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows arrive sorted by segment; one segment is held at a time."""
    def bits(row, name):
        raw = getattr(row, name)
        if row.dense:
            return np.unpackbits(np.frombuffer(raw, np.uint8)).astype(bool)
        out = np.zeros(SEGMENT_BITS, dtype=bool)
        out[np.frombuffer(raw, np.uint32)] = True
        return out

    current, once, twice = None, None, None
    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.segment != current:
                if current is not None:
                    yield pd.DataFrame({"segment": [current], "twice": [np.packbits(twice).tobytes()]})
                current, once, twice = row.segment, np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
            new = bits(row, "once")
            twice |= bits(row, "twice") | (once & new)
            once |= new
    if current is not None:
        yield pd.DataFrame({"segment": [current], "twice": [np.packbits(twice).tobytes()]})


def possibly_repeated(signatures: DataFrame, rows: int) -> DataFrame:
    """``signatures`` (any columns plus ``digest``, 32 bytes) with a boolean
    column ``maybe``: false only where the digest occurs once."""
    spark = signatures.sparkSession
    bits = filter_bits(rows)
    local = signatures.select("digest").mapInPandas(
        _local_filters(bits), "segment long, dense boolean, once binary, twice binary")
    merged = (local.repartition("segment").sortWithinPartitions("segment")
              .mapInPandas(_merge_segments, "segment long, twice binary"))
    packed = np.zeros(bits // 8, np.uint8)  # at most MAX_BITS / 8 bytes reach the driver
    for row in merged.toLocalIterator():
        at = row.segment * (SEGMENT_BITS // 8)
        packed[at:at + SEGMENT_BITS // 8] = np.frombuffer(row.twice, np.uint8)
    shared = spark.sparkContext.broadcast(packed.tobytes())

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        twice = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            if len(batch):
                slots = _slots(batch["digest"], bits)
                hit = (twice[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1
                yield batch.assign(maybe=hit.all(axis=1))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in signatures.schema)
    return signatures.mapInPandas(test, f"{schema}, maybe boolean")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, ``keep_id`` (smallest id with an equal
    text), ``group_size``, ``kept`` and ``text_sha256`` of the normalised text."""
    signatures = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row_no"),
                    F.unhex(F.sha2(normalised(text_col).cast("binary"), 256)).alias("digest")),
        "exact-signatures")
    rows = signatures.count()
    tested = materialize(possibly_repeated(signatures, rows), "exact-tested")
    unique = tested.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
    maybe = tested.filter("maybe").drop("maybe")
    groups = maybe.groupBy("digest").agg(
        F.count("*").alias("group_rows"), F.min(F.struct("doc_id", "row_no")).alias("first"))
    joined = attach(maybe, groups, "digest", rows)
    repeated = joined.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("group_rows").alias("group_size"),
        (F.col("row_no") == F.col("first.row_no")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
    return unique.unionByName(repeated)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without later copies, all columns kept. Rows are dropped by id
    and text; of copies that share even the id with the row that stays, one
    stays. Texts are shuffled only for the few rows that filters of the dropped
    and kept keys leave open."""
    decided = materialize(duplicate_groups(docs, id_col, text_col).select(
        "doc_id", F.unhex("text_sha256").alias("digest"), "kept"), "exact-decided")
    return keep_rows(docs, decided, id_col, F.unhex(F.sha2(normalised(text_col).cast("binary"), 256)))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents"))


OP5_SQL = """
with t as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) text_sha256
           from documents)
select doc_id, min(doc_id) over g keep_id, count(*) over g group_size,
       doc_id = min(doc_id) over g kept, text_sha256
from t window g as (partition by text_sha256)
"""
