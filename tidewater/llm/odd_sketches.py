"""Near-duplicate documents by odd sketches of MinHash samples.

Documents are sets of 2-word shingles; two link when their Jaccard similarity
is at least 0.8. Links decide the components.

1. Equal sets collapse to one class. Of each set 256 MinHash samples are taken.
   They are folded into a parity bitmap of 512 bits (the odd sketch: every
   sample flips one bit). Where two sets agree in a sample the flips cancel, so
   the population count of the XOR of two sketches tells how many samples
   differ, most precisely where few do.
2. Bands of four samples make buckets. A pair at 0.8 misses all 48 bands with
   probability 1e-11.
3. In a small bucket all pairs are looked at, in a large one each member and
   the most central one. Only pairs whose XOR count is at most ``MOST_FLIPS``
   become candidates; a pair at 0.8 exceeds it with probability below 1e-9.
   Candidates are confirmed on the whole sets.
4. What is left in large buckets are pairs of different components. The members
   outside a bucket's main component meet all members in blocks: sketches are
   compared within a task, nearest pairs are confirmed first, and members that
   a confirmed link has joined are not compared again. A block sends on at most
   one link per member, never its pairs.

Defined results: null, empty and wordless texts have no shingles and stay
alone, under their own id; a null id is in its set's class but never names a
component unless no other id is there; repeated rows are reported one by one,
and all rows with the id of the one that stays count as kept; an empty table
gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import IdFilter, attach, table
from tidewater.llm.graph import components
from tidewater.llm.shingles import mix, shingle_sets
from tidewater.session import materialize

WORDS = 2
# Similarity as a fraction of integers: 100 * |A & B| >= 80 * |A | B|.
NUM, DEN = 80, 100
SAMPLES = 256
BITS = 512
BANDS, BAND_ROWS = 48, 4
# Different sets of fewer shingles are never as similar as 0.8 (4 of 5).
LEAST_SIZE = 4
SMALL_BUCKET = 16
BLOCK = 256
RISK = 1e-9
_rng = np.random.default_rng(20250305)
_SEEDS = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1)
_FOLD = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
_PLACES = _rng.integers(1, 1 << 63, BAND_ROWS, dtype=np.uint64) | np.uint64(1)
_BAND = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)
GATHERED = 50_000


def most_flips(similarity: float, samples: int = SAMPLES, bits: int = BITS, risk: float = RISK) -> int:
    """The XOR count that a pair of this similarity exceeds with probability
    ``risk``. Each differing sample flips two bits (chosen anew each time)."""
    state = np.zeros(bits + 1)
    state[0] = 1
    down = np.arange(bits + 1) / bits
    chance, total = (1 - similarity) / similarity, np.zeros(bits + 1)
    weight = similarity ** samples
    for differing in range(samples + 1):
        total += weight * state
        weight *= chance * (samples - differing) / (differing + 1)
        for _ in range(2):
            stepped = np.zeros(bits + 1)
            stepped[1:] += (state * (1 - down))[:-1]
            stepped[:-1] += (state * down)[1:]
            state = stepped
    tail = total[::-1].cumsum()[::-1]
    return int(np.flatnonzero(tail >= risk)[-1])


def estimated_similarity(flips, samples: int = SAMPLES, bits: int = BITS):
    """The similarity that an XOR count stands for."""
    differing = np.log1p(-2 * np.minimum(flips, bits / 2 - 0.5) / bits) / (2 * np.log1p(-2 / bits))
    return 1 - differing / samples


MOST_FLIPS = most_flips(NUM / DEN)


def samples_of(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples (sets, SAMPLES) of sets that are not empty."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), SAMPLES), np.uint64)
    for i, seed in enumerate(_SEEDS):
        out[:, i] = np.minimum.reduceat(values * seed, starts)
    return out


def folded(samples: np.ndarray) -> np.ndarray:
    """Odd sketches (sets, BITS / 64) as longs: each sample flips a bit."""
    bit = (mix(samples ^ _FOLD) % np.uint64(BITS)).astype(np.int64) + BITS * np.arange(len(samples))[:, None]
    odd = np.bincount(bit.ravel(), minlength=BITS * len(samples)).reshape(len(samples), BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples[:, :BANDS * BAND_ROWS].reshape(len(samples), BANDS, BAND_ROWS)
    return mix((rows * _PLACES).sum(axis=2, dtype=np.uint64) + _BAND).view(np.int64)


def _set_id(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, set_id, sketch and bands of each document's set."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, sets, size = [], [], 0

            def rows() -> pd.DataFrame:
                full = [i for i, s in enumerate(sets) if len(s)]
                sketches, bands = [()] * len(sets), [()] * len(sets)
                if full:
                    samples = samples_of([sets[i] for i in full])
                    for i, sketch, keys in zip(full, folded(samples), band_keys(samples)):
                        sketches[i], bands[i] = sketch, keys if len(sets[i]) >= LEAST_SIZE else ()
                return pd.DataFrame({"doc_id": pd.Series(ids, dtype=batch["doc_id"].dtype), "n": [len(s) for s in sets],
                                     "set_id": [_set_id(s) for s in sets], "sketch": sketches, "bands": bands})

            for doc, s in zip(batch["doc_id"], shingle_sets(list(batch["text"]), words)):
                ids.append(doc)
                sets.append(s)
                size += len(s)
                if size > GATHERED:
                    yield rows()
                    ids, sets, size = [], [], 0
            if ids:
                yield rows()

    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {id_type}, n long, set_id binary, sketch array<long>, bands array<long>")


def whole_sets(docs: DataFrame, words: int, wanted: DataFrame) -> DataFrame:
    """node and tokens of the classes ``wanted`` (node, set_id, first_doc).
    Only documents that name a class are taken up, so copies are not shuffled."""
    by_doc = IdFilter(wanted.select(F.xxhash64("first_doc").alias("h")).distinct(), "h")
    by_set = IdFilter(wanted.select(F.conv(F.substring(F.hex("set_id"), 1, 15), 16, 10).cast("long").alias("h")), "h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[by_doc(batch["h"].to_numpy(np.int64))] if len(batch) else batch
            ids, rows, size = [], [], 0
            for s in shingle_sets(list(batch["text"]), words):
                key = _set_id(s)
                if by_set(np.array([int.from_bytes(key[:8], "big") >> 4], np.int64))[0]:
                    ids.append(key)
                    rows.append(s.view(np.int64))
                    size += len(s)
                if size > 500_000:
                    yield pd.DataFrame({"set_id": ids, "tokens": rows})
                    ids, rows, size = [], [], 0
            if ids:
                yield pd.DataFrame({"set_id": ids, "tokens": rows})

    found = docs.select(F.xxhash64("doc_id").alias("h"), "text").mapInPandas(run, "set_id binary, tokens array<long>")
    return found.groupBy("set_id").agg(F.first("tokens").alias("tokens")).join(
        wanted.select("set_id", "node", "n"), "set_id").select("node", "n", "tokens")


def flips(a: str, b: str):
    """The population count of the XOR of two sketch columns."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, c: s + c)


def promising(a_n: str, a_sketch: str, b_n: str, b_sketch: str):
    """Sizes and sketches that a link may have."""
    return (DEN * F.least(a_n, b_n) >= NUM * F.greatest(a_n, b_n)) & (flips(a_sketch, b_sketch) <= MOST_FLIPS)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar."""
    a, b = (sets.select(F.col("node").alias(x), F.col("tokens").alias(f"t{x}")) for x in "ab")
    shared = F.size(F.array_intersect("ta", "tb"))
    union = F.size("ta") + F.size("tb") - shared
    return pairs.join(a, "a").join(b, "b").filter(DEN * shared >= NUM * union).select("a", "b")


def band_rows(classes: DataFrame) -> DataFrame:
    """key, node, n, sketch and group_rows of the buckets with two members or more."""
    rows = classes.select("node", F.explode("bands").alias("key"))
    buckets = materialize(rows.groupBy("key").agg(F.count("*").alias("group_rows")).filter("group_rows > 1"), "buckets")
    met = attach(rows, buckets, "key", classes.count() * BANDS).filter("group_rows is not null")
    return met.join(classes.select("node", "n", "sketch"), "node").select("key", "node", "n", "sketch", "group_rows")


def candidates(met: DataFrame) -> DataFrame:
    """(a, b): all promising pairs of small buckets; in large ones those with
    the most central member, which meets most other rows."""
    small = met.filter(F.col("group_rows") <= SMALL_BUCKET)
    one, two = (small.select("key", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    near = one.join(two, "key").filter((F.col("a") < F.col("b")) & promising("na", "sa", "nb", "sb")).select("a", "b")
    large = met.filter(F.col("group_rows") > SMALL_BUCKET)
    weights = large.groupBy("node").agg(F.sum("group_rows").alias("weight"))
    weighed = materialize(large.drop("group_rows").join(weights, "node"), "large-buckets")
    pivots = materialize(weighed.groupBy("key").agg(
        F.count("*").alias("group_rows"), F.max(F.struct("weight", "node", "n", "sketch")).alias("p")).select(
        "key", "group_rows", F.col("p.node").alias("a"), F.col("p.n").alias("na"), F.col("p.sketch").alias("sa")), "pivots")
    starred = attach(weighed.select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")),
                     pivots, "key", weighed.count())
    star = starred.filter((F.col("a") != F.col("b")) & promising("na", "sa", "nb", "sb"))
    return near.union(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()


def _block_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows arrive sorted by block; a block is at most 2 * BLOCK rows."""
    key, parts = None, []
    for batch in batches:
        same = (batch[["key", "i", "j"]] != batch[["key", "i", "j"]].shift()).any(axis=1).cumsum()
        for _, group in batch.groupby(same, sort=False):
            this = tuple(group[["key", "i", "j"]].iloc[0])
            if this != key and parts:
                yield block_links(pd.concat(parts))
                parts = []
            key = this
            parts.append(group)
    if parts:
        yield block_links(pd.concat(parts))


def block_links(block: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that join the components of a block's askers and members
    as far as similar pairs do. Pairs are confirmed nearest first; those of one
    component are passed over."""
    asking, asked = block[block["asks"]], block[~block["asks"]]
    links = []
    if len(asking) and len(asked):
        sketch = np.stack(block["sketch"].to_list()).astype(np.int64).view(np.uint64)
        n = block["n"].to_numpy(np.int64)
        asks = block["asks"].to_numpy(bool)
        count = np.zeros((len(asking), len(asked)), np.int32)
        for w in range(sketch.shape[1]):
            count += np.bitwise_count(sketch[asks, w][:, None] ^ sketch[~asks, w][None, :])
        small, large = (f(n[asks][:, None], n[~asks][None, :]) for f in (np.minimum, np.maximum))
        comp, node = block["comp"].to_numpy(), block["node"].to_numpy()
        tokens = block["tokens"].to_list()
        i, j = np.nonzero((count <= MOST_FLIPS) & (DEN * small >= NUM * large) & (comp[asks][:, None] != comp[~asks][None, :]))
        order = np.argsort(count[i, j], kind="stable")
        left, right = np.flatnonzero(asks)[i[order]], np.flatnonzero(~asks)[j[order]]
        root = {}

        def find(x):
            top = x
            while top in root:
                top = root[top]
            while x != top:
                root[x], x = top, root[x]
            return top

        for a, b in zip(left, right):
            ra, rb = find(comp[a]), find(comp[b])
            if ra == rb:
                continue
            shared = len(np.intersect1d(tokens[a], tokens[b], assume_unique=True))
            if DEN * shared >= NUM * (len(tokens[a]) + len(tokens[b]) - shared):
                root[ra] = rb
                links.append((node[a], node[b]))
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def open_blocks(met: DataFrame, grouped: DataFrame) -> DataFrame:
    """Blocks of the large buckets that hold more than one component: key, i, j,
    asks, node, comp, n, sketch. Members outside the bucket's main component ask;
    all members are asked."""
    rows = met.filter(F.col("group_rows") > SMALL_BUCKET).join(grouped, "node", "left").withColumn(
        "comp", F.coalesce("root", "node")).drop("root", "group_rows")
    rows = materialize(rows, "large-members")
    parts = rows.groupBy("key", "comp").agg(F.count("*").alias("c"))
    buckets = parts.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("main"), F.sum("c").alias("group_rows")).filter(
        "main.c < group_rows").select(
        "key", "group_rows", F.col("main.comp").alias("main"), (F.col("group_rows") - F.col("main.c")).alias("others"))
    found = attach(rows, materialize(buckets, "open-buckets"), "key", rows.count()).filter("group_rows is not null")
    blocks = {"asked": F.ceil(F.col("group_rows") / BLOCK).cast("int"), "askers": F.ceil(F.col("others") / BLOCK).cast("int")}
    found = found.withColumns(blocks)
    place = F.xxhash64("node", "key")
    fields = ["key", "i", "j", "asks", "node", "comp", "n", "sketch"]
    asking = found.filter("comp <> main").withColumns({
        "i": F.pmod(place, F.col("askers")).cast("int"), "asks": F.lit(True)}).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("asked") - 1)))
    asked = found.withColumns({
        "j": F.pmod(place, F.col("asked")).cast("int"), "asks": F.lit(False)}).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("askers") - 1)))
    return asking.select(fields).unionByName(asked.select(fields))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = materialize(sketched(docs, words), "sketched")
    total = found.count()
    classes = found.filter("n > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("first_doc"), F.count("*").alias("group_rows"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    met = materialize(band_rows(classes), "band-rows")
    pairs = materialize(candidates(met), "candidates")
    live = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(
        met.filter(F.col("group_rows") > SMALL_BUCKET).select("node")).distinct()
    sets = materialize(whole_sets(docs, words, classes.select("node", "n", "set_id", "first_doc").join(live, "node")), "whole-sets")
    links = materialize(confirmed(pairs, sets), "links")
    grouped = materialize(components(links), "grouped")
    blocks = open_blocks(met, grouped).join(sets.select("node", "tokens"), "node")
    blocks = blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    across = blocks.mapInPandas(_block_links, "a long, b long")
    linked = materialize(components(links.unionByName(across)), "linked")

    named = classes.select("set_id", "node", "first_doc", "group_rows").join(linked, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    first = named.groupBy("root").agg(F.min("first_doc").alias("component_id"), F.count("*").alias("group_rows"))
    named = attach(named.select("root", "set_id", F.col("group_rows").alias("copies")), first, "root", total).select(
        "set_id", F.col("copies").alias("group_rows"), "component_id")
    return attach(found.select("doc_id", "n", "set_id"), named, "set_id", total).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP11_SQL = """
with recursive w as (
  select doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
           lambda x: x <> '') w
  from documents),
s as (
  select doc_id, list_sort(case when len(w) < 2 then w else list_distinct(list_transform(
           range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end) s
  from w),
classes as (select s, min(doc_id) c, len(s) n from s where len(s) > 0 group by s),
t as (select c, n, unnest(s) g from classes),
links as (
  select a.c x, b.c y
  from t a join t b on a.g = b.g and a.c < b.c and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.c, b.c, a.n, b.n
  having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges as (select x, y from links union select y, x from links),
reach as (
  select c node, c root from classes
  union
  select r.node, e.y from reach r join edges e on r.root = e.x),
roots as (select node, min(root) component from reach group by node)
select doc_id, cast(len(s.s) as bigint) n_shingles, coalesce(component, doc_id) component_id,
       doc_id = coalesce(component, doc_id) kept
from s left join classes using (s) left join roots on node = c
"""
