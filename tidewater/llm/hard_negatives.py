"""Hard-negative mining with Four-Russians scoring.

Vectors are rows of small integers. For every anchor the rows of its own label
with the highest inner products are its positives; for each positive the
hardest rows of other labels whose score lies in a band below the positive's
are its negatives. Every anchor is scored against every row, exactly:

1. Rows are packed once: the two's-complement bit planes of eight neighbouring
   dimensions are one byte per plane, so a row is planes x groups bytes.
2. For each anchor and each group of eight dimensions a table holds the sums of
   all 256 subsets of its eight components. A byte of a row is an index into
   the table; the sums of a plane's groups, shifted by the plane's weight and
   added up, are the inner product.
3. Anchors are broadcast in chunks of bounded size. Each chunk reads the packed
   rows twice, first for the positives, then, with their scores, for the
   negatives. A task keeps the best rows per anchor seen so far, so what it
   sends on does not grow with its rows.

Defined results: rows with a null label, a null vector, or a null or
non-finite component take no part, nor do rows with a null id, which no result
could name. Missing trailing components count as zero. Rows are told apart by
themselves, not by their ids: repeated rows are each other's positives, and a
repeated anchor is an anchor each time. Equal scores are ordered by id. An
empty table, or one without anchors, gives an empty result. Components of
2^22 or more after scaling are an error, as scores could pass 64 bits. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import table
from tidewater.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# A negative's score lies within these hundredths of its positive's.
LOW, HIGH = 80, 100
ANCHORS_PER_CHUNK = 2048
ANCHORS_PER_TABLE = 64
ROWS_PER_BLOCK = 4096
KEPT_ROWS = 200_000
MAX_COMPONENT = 1 << 22


def packed_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """Rows of integers (n, dims) to bytes (n, planes, groups): bit d of byte
    (p, g) is bit p of component 8 g + d."""
    n, dims = values.shape
    groups = -(-dims // 8)
    out = np.zeros((n, planes, groups), np.uint8)
    for p in range(planes):
        out[:, p] = np.packbits(((values >> p) & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def unpacked(packed: np.ndarray) -> np.ndarray:
    """The integers of packed rows, dimensions filled up to whole bytes."""
    planes = packed.shape[1]
    bits = np.unpackbits(packed, axis=2, bitorder="little").astype(np.int64)
    weights = np.int64(1) << np.arange(planes, dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.einsum("npd,p->nd", bits, weights)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables (groups, 256, anchors): the sum of each subset of the eight
    components of a group, built by doubling."""
    count, dims = anchors.shape
    tables = np.zeros((dims // 8, 256, count), np.int64)
    for d in range(8):
        tables[:, 1 << d:2 << d] = tables[:, :1 << d] + anchors[:, d::8].T[:, None, :]
    most = int(np.abs(tables).max(initial=0))
    return tables.astype(np.int32) if most * max(1, dims // 8) < 1 << 31 else tables


def scores(packed: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Inner products (rows, anchors) by table lookups."""
    n, planes, groups = packed.shape
    total = np.zeros((n, tables.shape[2]), np.int64)
    for p in range(planes):
        plane = np.zeros((n, tables.shape[2]), tables.dtype)
        for g in range(groups):
            plane += tables[g][packed[:, p, g]]
        if p == planes - 1:
            total -= plane.astype(np.int64) << p
        else:
            total += plane.astype(np.int64) << p
    return total


def packed_rows(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """vec_id, label, row_no and the packed planes of all rows that take part."""
    id_type = vectors.schema[id_col].dataType.simpleString()
    x = F.col("x")
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < math.inf))
    known = vectors.select(F.col(id_col).alias("vec_id"), label.alias("label"), F.col(vector_col).alias("x")).filter(
        "vec_id is not null and label is not null and x is not null").filter(finite)
    shape = known.agg(F.max(F.size(x)).alias("dims"), F.min(F.array_min(scaled)).alias("low"),
                      F.max(F.array_max(scaled)).alias("high")).first()
    dims, most = shape.dims or 1, max(-(shape.low or 0), (shape.high or 0) + 1)
    if most > MAX_COMPONENT:
        raise ValueError(f"components of up to {most} are too large for 64-bit scores")
    planes = most.bit_length() + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.zeros((len(batch), 8 * -(-dims // 8)), np.int64)
            for i, row in enumerate(batch["x"]):
                values[i, :len(row)] = np.floor(np.asarray(row, np.float64) * SCALE)
            rows = packed_planes(values, planes).reshape(len(batch), -1)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "row_no": batch["row_no"],
                                "planes": planes, "packed": [r.tobytes() for r in rows]})

    numbered = known.withColumn("row_no", F.monotonically_increasing_id()).select("vec_id", "label", "row_no", "x")
    label_type = known.schema["label"].dataType.simpleString()
    return numbered.mapInPandas(run, f"vec_id {id_type}, label {label_type}, row_no long, planes int, packed binary")


class Chunk:
    """Anchors of one chunk with their subset-sum tables."""

    def __init__(self, ids, labels, row_nos, packed, positives=None):
        self.ids, self.labels, self.row_nos, self.packed = ids, labels, row_nos, packed
        self.positives = positives  # per anchor the distinct scores of its positives

    def tables(self) -> list[tuple[int, np.ndarray]]:
        whole = unpacked(self.packed)
        return [(at, subset_sums(whole[at:at + ANCHORS_PER_TABLE])) for at in range(0, len(whole), ANCHORS_PER_TABLE)]


def _cube(batch: pd.DataFrame) -> np.ndarray:
    planes = int(batch["planes"].iloc[0])
    return np.frombuffer(b"".join(batch["packed"]), np.uint8).reshape(len(batch), planes, -1)


def best(frame: pd.DataFrame, keys: list[str], limit: int) -> pd.DataFrame:
    """The first rows of each key by score, id and row."""
    frame = frame.sort_values([*keys, "score", "vec_id", "row_no"], ascending=[True] * len(keys) + [False, True, True])
    return frame[frame.groupby(keys, sort=False).cumcount() < limit]


def _scan(rows: DataFrame, chunk, pick: Callable, keys: list[str], limit: int, id_type: str) -> DataFrame:
    """``pick`` of every block of rows and table of anchors, cut to the best
    rows per key in each task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors, tables = chunk.value, None
        kept, size = [], 0
        for batch in batches:
            tables = tables or anchors.tables()
            for at in range(0, len(batch), ROWS_PER_BLOCK):
                block = batch.iloc[at:at + ROWS_PER_BLOCK]
                packed = _cube(block)
                for first, sums in tables:
                    found = pick(anchors, first, scores(packed, sums), block)
                    if len(found):
                        kept.append(found)
                        size += len(found)
                if size > KEPT_ROWS:
                    kept = [best(pd.concat(kept), keys, limit)]
                    size = 0
        if kept:
            yield best(pd.concat(kept), keys, limit)

    return rows.mapInPandas(run, ", ".join(f"{k} long" for k in keys) + f", vec_id {id_type}, row_no long, score long")


def _first(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "row_no")
    return rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= limit)


def _same_label(limit: int) -> Callable:
    def pick(anchors: Chunk, first: int, found: np.ndarray, block: pd.DataFrame) -> pd.DataFrame:
        ids, labels, row_nos = (block[c].to_numpy() for c in ("vec_id", "label", "row_no"))
        out = []
        mine = anchors.labels[first:first + found.shape[1]]
        for label in pd.unique(mine):
            at = np.flatnonzero(labels == label)
            if not len(at):
                continue
            cols = np.flatnonzero(mine == label)
            part = found[np.ix_(at, cols)]
            # The anchor itself may be among the best, so one row more is let through.
            least = np.partition(part, -min(limit + 1, len(at)), axis=0)[-min(limit + 1, len(at))]
            i, j = np.nonzero(part >= least)
            anchor = anchors.row_nos[first + cols[j]]
            other = row_nos[at[i]] != anchor
            out.append(pd.DataFrame({"anchor": anchor, "vec_id": ids[at[i]], "row_no": row_nos[at[i]],
                                     "score": part[i, j]})[other])
        return best(pd.concat(out), ["anchor"], limit) if out else pd.DataFrame()
    return pick


def _other_label(limit: int, low: int, high: int) -> Callable:
    def pick(anchors: Chunk, first: int, found: np.ndarray, block: pd.DataFrame) -> pd.DataFrame:
        ids, labels, row_nos = (block[c].to_numpy() for c in ("vec_id", "label", "row_no"))
        out = []
        for j in range(found.shape[1]):
            wanted = anchors.positives.get(int(anchors.row_nos[first + j]))
            if wanted is None:
                continue
            column = found[:, j]
            floors, ceilings = -(-low * wanted // 100), high * wanted // 100
            at = np.flatnonzero((labels != anchors.labels[first + j]) & (column >= floors.min()) & (column <= ceilings.max()))
            if not len(at):
                continue
            at = at[np.lexsort((row_nos[at], ids[at], -column[at]))]
            falling = -column[at]
            for positive, floor, ceiling in zip(wanted, floors, ceilings):
                start = np.searchsorted(falling, -ceiling)
                stop = min(start + limit, np.searchsorted(falling, -floor, side="right"))
                if start < stop:
                    these = at[start:stop]
                    out.append((anchors.row_nos[first + j], positive, ids[these], row_nos[these], column[these]))
        if not out:
            return pd.DataFrame()
        times = [len(o[2]) for o in out]
        return pd.DataFrame({
            "anchor": np.repeat([o[0] for o in out], times), "positive_score": np.repeat([o[1] for o in out], times),
            "vec_id": np.concatenate([o[2] for o in out]), "row_no": np.concatenate([o[3] for o in out]),
            "score": np.concatenate([o[4] for o in out])})
    return pick


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score. ``is_anchor`` is a condition
    on ``vec_id``; ``label`` defaults to the column of that name."""
    spark = vectors.sparkSession
    rows = materialize(packed_rows(vectors, id_col, vector_col, F.col("label") if label is None else label), "packed-rows")
    id_type = rows.schema["vec_id"].dataType.simpleString()
    anchors = rows.filter(is_anchor)
    chunks = -(-anchors.count() // ANCHORS_PER_CHUNK)
    result = None
    for number in range(chunks):
        these = anchors.filter(F.pmod(F.xxhash64("row_no"), F.lit(chunks)) == number).toPandas()
        if these.empty:
            continue
        chunk = [these[c].to_numpy() for c in ("vec_id", "label", "row_no")] + [_cube(these)]
        shared = spark.sparkContext.broadcast(Chunk(*chunk))
        friends = materialize(_first(_scan(rows, shared, _same_label(positives), ["anchor"], positives, id_type),
                                     ["anchor"], positives), "positives")
        shared.unpersist()
        by_anchor = friends.select("anchor", "score").distinct().toPandas().groupby("anchor")["score"]
        shared = spark.sparkContext.broadcast(Chunk(*chunk, {int(a): np.sort(s.to_numpy()) for a, s in by_anchor}))
        keys = ["anchor", "positive_score"]
        foes = materialize(_first(_scan(rows, shared, _other_label(negatives, low, high), keys, negatives, id_type),
                                  keys, negatives), "negatives")
        shared.unpersist()
        mined = friends.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(
            foes.select(*keys, F.col("nth").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                        F.col("score").alias("negative_score")), keys).join(
            anchors.select(F.col("row_no").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        mined = materialize(mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                         "negative_score"), "hard-negatives")
        result = mined if result is None else result.unionByName(mined)
    if result is None:
        return spark.createDataFrame([], f"anchor_id {id_type}, positive_id {id_type}, rank int, negative_id {id_type}, "
                                         "positive_score long, negative_score long")
    return result


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


OP13_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select a.vec_id anchor_id, b.vec_id other_id, a.label = b.label same,
         cast(list_inner_product(a.q, b.q) as bigint) score
  from v a join v b on a.vec_id <> b.vec_id
  where a.vec_id % 100 = 0),
p as (
  select anchor_id, other_id positive_id, score positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, positive_id,
       cast(row_number() over w as integer) as rank, other_id negative_id, positive_score, score negative_score
from p join s on s.anchor_id = p.anchor_id and not same
     and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, other_id)
qualify row_number() over w <= 5
"""
