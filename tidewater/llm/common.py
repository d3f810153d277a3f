"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import materialize

# White space of the contracts: blank, tab, newline, vertical tab, form feed, return.
BLANKS = "[\\x20\\x09-\\x0D]"
# ASCII-only lower-casing, as the contracts ask for A-Z.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc32_bucket(id_col: str, n: int):
    """crc32 of the id written as text, modulo n (null id: null)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def tasks_for(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partition count that gives tasks of about ``per_task`` rows, never
    fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_task))


def drawn(rows: DataFrame, total: int, limit: int, *by: str) -> DataFrame:
    """The ``limit`` rows of smallest hash of the ``by`` columns, ties by these
    columns. Of many rows only those below a hash that about twice as many
    rows as asked for fall under are sorted, so what tasks send on does not
    grow with the table."""
    hashed = rows.withColumn("_draw", F.xxhash64(*by))
    if total > 2 * limit:
        hashed = hashed.filter(F.col("_draw") < -(1 << 63) + int((1 << 64) * (2 * limit / total)))
    return hashed.orderBy("_draw", *by).limit(limit).drop("_draw")


def attach(rows: DataFrame, groups: DataFrame, key: str, total: int) -> DataFrame:
    """Left-join per-key results to rows without a hot task.

    ``groups`` has one row per key with its row count in ``group_rows``. Keys
    that hold at least 1/1000 of ``total`` (and 1,000 rows) number at most
    1,000, so they are broadcast; every other key is too small to weigh on a
    shuffle partition.
    """
    least = max(1000, math.ceil(total / 1000))
    hot = groups.filter(F.col("group_rows") >= least)
    cold = groups.filter(F.col("group_rows") < least)
    value = [c for c in groups.columns if c != key]
    tagged = rows.join(F.broadcast(hot.select(key, F.struct(*value).alias("_hot"))), key, "left")
    done = tagged.filter(F.col("_hot").isNotNull()).select(*rows.columns, "_hot.*")
    rest = tagged.filter(F.col("_hot").isNull()).drop("_hot").join(cold, key, "left")
    return done.unionByName(rest.select(done.columns))


def located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows as (doc_id, row_no, text). Where ids are unique row_no is 0, which
    takes next to no room when rows are shuffled; otherwise it numbers the rows
    in the order they are read."""
    ids = docs.groupBy(id_col).count().filter((F.col("count") > 1) | F.col(id_col).isNull()).limit(1)
    row_no = F.monotonically_increasing_id() if ids.count() else F.lit(0).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), row_no.alias("row_no"), F.col(text_col).alias("text"))


class IdFilter:
    """A test of 64-bit ids that is false only for ids not in the table it was
    made from: a bit array of about ``per_id`` bits an id, at most ``max_bits``
    (32 MB) whatever the table's size, broadcast to the tasks."""

    def __init__(self, ids: DataFrame, col: str, per_id: int = 16, max_bits: int = 1 << 28):
        self.bits = min(max_bits, max(1 << 16, 1 << (per_id * max(1, ids.count()) - 1).bit_length()))
        block = min(self.bits, 1 << 20)
        slot = F.pmod(F.xxhash64(F.col(col).cast("long")), F.lit(self.bits))
        blocks = ids.select(slot.alias("slot")).distinct().groupBy((F.col("slot") / block).cast("long").alias("block")).agg(
            F.collect_list((F.col("slot") % block).cast("int")).alias("slots"))
        packed = np.zeros(self.bits // 8, np.uint8)
        for row in blocks.toLocalIterator():
            dense = np.zeros(block, bool)
            dense[row.slots] = True
            packed[row.block * (block // 8):(row.block + 1) * (block // 8)] = np.packbits(dense)
        self.shared = ids.sparkSession.sparkContext.broadcast(packed.tobytes())

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        at = xxhash64(ids) & np.uint64(self.bits - 1)
        packed = np.frombuffer(self.shared.value, np.uint8)
        return (packed[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1).astype(bool)

    def column(self, key: str):
        """The test as a column expression over the column ``key``."""
        return F.pandas_udf(lambda ids: pd.Series(self(ids.to_numpy())), "boolean")(F.col(key))


def keep_rows(docs: DataFrame, decided: DataFrame, id_col: str, digest) -> DataFrame:
    """The rows of ``docs`` that ``decided`` keeps, all columns kept.

    ``decided`` has doc_id, digest and kept for all rows of ``docs``; ``digest``
    is the same digest as an expression over ``docs``. Rows are told apart by
    id and digest; where an id and digest are both kept and dropped, one of
    their rows stays.

    No text is shuffled to look its row up: a broadcast filter of the dropped
    keys lets almost every kept row through, and a filter of the kept keys that
    it stops tells the rows that are dropped for certain. Only rows that both
    filters stop (about one in 100) are joined."""
    key = F.xxhash64("doc_id", "digest").alias("key")
    gone = materialize(decided.filter("not kept").select("doc_id", "digest", key).distinct(), "rows-dropped")
    dropped = IdFilter(gone, "key", per_id=128)
    spared = materialize(
        decided.filter("kept").select("doc_id", "digest", key).filter(dropped.column("key")).distinct(), "rows-spared")
    stopped = IdFilter(spared, "key", per_id=128)
    doubtful = spared.join(gone.select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest"), F.lit(True).alias("one")),
                           F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("digest") == F.col("gone_digest")), "left").select(
        F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"), "one")
    marked = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("doc_id"), digest.alias("digest")).select(
        "*", key).withColumn("hit", dropped.column("key"))
    met = marked.filter("hit").filter(stopped.column("key")).join(
        doubtful, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest")))
    one = met.filter("one").groupBy("doc_id", "digest").agg(F.first("doc").alias("doc"))
    return (marked.filter("not hit").select("doc.*").unionByName(met.filter("one is null").select("doc.*"))
            .unionByName(one.select("doc.*")))


def xxhash64(ids: np.ndarray, seed: int | np.ndarray = 42) -> np.ndarray:
    """Spark's xxhash64 of longs, as unsigned numbers (fixed constants of the
    published algorithm). A second column takes the first one's hash as seed."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (
        11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))

    def turn(x, n):
        return x << np.uint64(n) | x >> np.uint64(64 - n)

    value = np.asarray(ids).astype(np.int64).view(np.uint64)
    h = np.asarray(seed, np.uint64) + p5 + np.uint64(8) ^ turn(value * p2, 31) * p1
    h = turn(h, 27) * p1 + p4
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    return h ^ h >> np.uint64(32)
