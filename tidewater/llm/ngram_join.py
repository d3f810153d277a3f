"""N-gram Jaccard join over a token-group matrix.

Documents are sets of 5-word shingles; two link when their Jaccard similarity
is at least 0.75. All links decide the components; none is lost.

1. Equal sets collapse to one. Of each set the first tokens in hash order are
   taken: so many that similar sets share at least ``margin`` of them. A set
   with fewer tokens that occur elsewhere is done; the others are live, and
   only their whole sets are kept.
2. Live sets are partitioned into groups: each is compared with the most
   central set (the pivot) among those that share a min-hash with it, and
   verified links join sets into groups. A group is connected already, so only
   links between groups are left to find.
3. The token-group matrix stores each group's token union with the sizes of
   its members. A token that occurs in one group only cannot link; what a set
   shares with other groups bounds its overlap with any of them. A query set
   meets a group at the rarest of these tokens (similar sets must meet there),
   and only groups that the bound lets through are opened.
4. Opened members are verified on the whole sets. The smaller group asks the
   larger one, so a group of many copies is never compared with itself.

Defined results: null, empty and wordless texts have no shingles and stay
alone, under their own id; a null id is in its set's class but never names it;
repeated rows are reported one by one; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import IdFilter, attach, keep_rows, table
from tidewater.llm.graph import components
from tidewater.llm.shingles import shingle_sets
from tidewater.session import materialize

WORDS = 5
# Similarity as a fraction of integers: 100 * |A & B| >= 75 * |A | B|.
NUM, DEN = 75, 100
MIN_HASHES = 8
SKETCH = 128
_SEEDS = [np.uint64(0x5851F42D4C957F2D * (2 * i + 3) & (1 << 64) - 1) for i in range(MIN_HASHES)]


def least_overlap(n: np.ndarray | int):
    """ceil(t * n): shared tokens that any partner of a set of n needs."""
    return (NUM * n + DEN - 1) // DEN


def margin(n):
    """Prefix tokens beyond the shortest valid prefix, plus one: a tenth."""
    return (n + 9) // 10


def prefix_length(n):
    return n - least_overlap(n) + margin(n)


def _set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def text_digest(text_col: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))


def shingled(docs: DataFrame, id_col: str, text_col: str, words: int, digests: bool) -> DataFrame:
    """doc_id, digest (of the text, if asked for), n, set_id and the min-hashes
    of each document's set."""
    id_type = docs.schema[id_col].dataType.simpleString()
    mins = [f"m{i}" for i in range(MIN_HASHES)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for s in shingle_sets(list(batch["text"]), words):
                least = [int((s * k).min().view(np.int64)) if len(s) else 0 for k in _SEEDS]
                rows.append((len(s), _set_id(s), *least))
            out = pd.DataFrame(rows, columns=["n", "set_id", *mins])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            out.insert(1, "digest", batch["digest"].to_numpy())
            yield out

    digest = text_digest(text_col) if digests else F.lit(None).cast("binary")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), digest.alias("digest")).mapInPandas(
        run, f"doc_id {id_type}, digest binary, n long, set_id long, " + ", ".join(f"{m} long" for m in mins))


def token_arrays(docs: DataFrame, id_col: str, text_col: str, words: int, wanted: IdFilter) -> DataFrame:
    """doc_id, set_id and the whole sets of documents; rows whose set is
    certainly not wanted are left out."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, rows, size = [], [], 0
            for doc, s in zip(batch["doc_id"], shingle_sets(list(batch["text"]), words)):
                key = _set_id(s) if len(s) else None
                if key is not None and wanted(np.array([key]))[0]:
                    ids.append((doc, key))
                    rows.append(s.view(np.int64))
                    size += len(s)
                if size > 500_000:
                    yield pd.DataFrame(ids, columns=["doc_id", "set_id"]).assign(tokens=rows)
                    ids, rows, size = [], [], 0
            if ids:
                yield pd.DataFrame(ids, columns=["doc_id", "set_id"]).assign(tokens=rows)

    return docs.selectExpr(f"`{id_col}` doc_id", f"`{text_col}` text").mapInPandas(
        run, f"doc_id {id_type}, set_id long, tokens array<long>")


def prefix_tokens(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """One row per prefix token of each document: token, set_id."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, ids, size = [], [], 0
            for s in shingle_sets(list(batch["text"]), words):
                if not len(s):
                    continue
                tokens.append(s[:prefix_length(len(s))].view(np.int64))
                ids.append(np.full(len(tokens[-1]), _set_id(s)))
                size += len(tokens[-1])
                if size > 200_000:
                    yield pd.DataFrame({"token": np.concatenate(tokens), "set_id": np.concatenate(ids)})
                    tokens, ids, size = [], [], 0
            if tokens:
                yield pd.DataFrame({"token": np.concatenate(tokens), "set_id": np.concatenate(ids)})

    return docs.selectExpr(f"`{text_col}` text").mapInPandas(run, "token long, set_id long")


def live_sets(docs: DataFrame, classes: DataFrame, text_col: str, words: int) -> DataFrame:
    """set_id of the sets that can have a partner. One shares at least
    margin(ceil(t * n)) prefix tokens with this set, n being the set's size.
    (Copies repeat a token's row, which can only let a set through.)"""
    by_token = Window.partitionBy("token")
    shared = (prefix_tokens(docs, text_col, words)
              .withColumn("lo", F.min("set_id").over(by_token)).withColumn("hi", F.max("set_id").over(by_token))
              .filter("lo <> hi").groupBy("set_id").agg(F.count("*").alias("shared")))
    need = F.expr(f"(({NUM} * n + {DEN - 1}) div {DEN} + 9) div 10")
    return shared.join(classes, "set_id").filter(F.col("shared") >= need).select("set_id")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids whose whole sets are similar."""
    a, b = (sets.select(F.col("set_id").alias(x), F.col("tokens").alias(f"t{x}")) for x in "ab")
    shared = F.size(F.array_intersect("ta", "tb"))
    union = F.size("ta") + F.size("tb") - shared
    return pairs.join(a, "a").join(b, "b").filter(DEN * shared >= NUM * union).select("a", "b")


def similar_sizes(n, low, high):
    """Some size in [low, high] can be similar to n."""
    return (DEN * n >= NUM * low) & (DEN * high >= NUM * n)


def within_reach(n, reach, low, other_reach):
    """The overlap that a link of sizes n and low needs is within what either
    side shares at most: 100 * o >= 75 * (n + low - o)."""
    return (NUM + DEN) * F.least(reach, other_reach) >= NUM * (n + low)


def pivot_pairs(sets: DataFrame, total: int) -> DataFrame:
    """(a, b): set b with the pivot a of each min-hash it shares. The pivot is
    the member whose tokens occur most often (by its first SKETCH tokens in
    hash order), so it lies in the middle of a family of copies."""
    sketch = sets.select("set_id", F.explode(F.slice("tokens", 1, SKETCH)).alias("token"))
    often = sketch.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    centre = sketch.join(often, "token").groupBy("set_id").agg(F.sum("df").alias("weight"))
    hashes = sets.join(centre, "set_id", "left").select(
        "set_id", "n", F.coalesce("weight", F.lit(0)).alias("weight"), F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(f"m{i}").alias("m")) for i in range(MIN_HASHES)])).alias("key"))
    hashes = materialize(hashes, "min-hashes")
    pivots = hashes.groupBy("key").agg(F.count("*").alias("group_rows"), F.max(F.struct("weight", "set_id", "n")).alias("p")).filter(
        "group_rows > 1")
    met = attach(hashes.select("key", "set_id", "n"), pivots, "key", total)
    return met.filter((F.col("p.set_id") != F.col("set_id")) & similar_sizes(F.col("n"), F.col("p.n"), F.col("p.n"))).select(
        F.col("p.set_id").alias("a"), F.col("set_id").alias("b")).distinct()


def opened_pairs(sets: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): query set a and member b of a group that the matrix lets through.
    ``known`` has set_id, n, grp and group_size. Within a group the matrix
    keeps sets of nearly equal size (a band) apart, so its bounds are tight."""
    by_token, by_set = Window.partitionBy("token"), Window.partitionBy("set_id")
    least = F.expr(f"({NUM} * n + {DEN - 1}) div {DEN}")
    tokens = sets.select("set_id", F.explode("tokens").alias("token")).join(known, "set_id")
    kept = (tokens.withColumn("df", F.count("*").over(by_token))
            .withColumn("lo", F.min("grp").over(by_token)).withColumn("hi", F.max("grp").over(by_token))
            .filter("lo <> hi").drop("lo", "hi")
            .withColumn("reach", F.count("*").over(by_set)).filter(F.col("reach") >= least)
            .withColumn("nth", F.row_number().over(by_set.orderBy("df", "token")))
            .filter(F.col("nth") <= F.col("reach") - least + 1))
    kept = materialize(kept.select("token", "set_id", "n", "reach", "grp", "group_size"), "matrix-tokens")
    kept = kept.withColumn("band", F.floor(50 * F.log("n")))
    matrix = kept.groupBy("token", "grp", "band").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("reach").alias("far"),
        F.first("group_size").alias("size")).withColumnsRenamed({"grp": "other", "band": "other_band"})
    asked = kept.join(matrix, "token").filter(
        (F.struct("group_size", "grp") < F.struct(F.col("size"), F.col("other")))
        & similar_sizes(F.col("n"), F.col("low"), F.col("high"))
        & within_reach(F.col("n"), F.col("reach"), F.col("low"), F.col("far")))
    opened = asked.select("set_id", "n", "reach", "other", "other_band").distinct()
    members = kept.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("reach").alias("far"),
                          F.col("grp").alias("other"), F.col("band").alias("other_band")).distinct()
    return opened.join(members, ["other", "other_band"]).filter(
        similar_sizes(F.col("n"), F.col("nb"), F.col("nb"))
        & within_reach(F.col("n"), F.col("reach"), F.col("nb"), F.col("far"))).select(F.col("set_id").alias("a"), "b").distinct()


def classified(docs: DataFrame, id_col: str, text_col: str, words: int, digests: bool) -> DataFrame:
    """One row per document: doc_id, digest, n, component_id and root, a set of
    its component (null without words)."""
    found = materialize(shingled(docs, id_col, text_col, words, digests), "shingled")
    total = found.count()
    mins = [f"m{i}" for i in range(MIN_HASHES)]
    classes = materialize(found.filter("n > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("first_doc"), F.count("*").alias("group_rows"), F.first("n").alias("n"),
        *[F.first(m).alias(m) for m in mins]), "set-classes")
    live = materialize(live_sets(docs, classes, text_col, words), "live-sets")
    arrays = token_arrays(docs, id_col, text_col, words, IdFilter(live, "set_id"))
    one = classes.join(live, "set_id", "left_semi").select("set_id", "first_doc", "n", *mins)
    sets = materialize(arrays.join(one, "set_id").filter(F.col("doc_id").eqNullSafe(F.col("first_doc")))
                       .drop("doc_id", "first_doc").dropDuplicates(["set_id"]), "live-tokens")
    links = materialize(verified(materialize(pivot_pairs(sets, total), "pivot-pairs"), sets), "pivot-links")
    groups = materialize(components(links), "groups")
    sizes = groups.groupBy("root").agg(F.count("*").alias("group_size"))
    known = sets.select("set_id", "n").join(
        groups.join(sizes, "root").select(F.col("node").alias("set_id"), "root", "group_size"), "set_id", "left").select(
        "set_id", "n", F.coalesce("root", "set_id").alias("grp"), F.coalesce("group_size", F.lit(1)).alias("group_size"))
    across = verified(materialize(opened_pairs(sets, known), "opened-pairs"), sets)
    linked = materialize(components(links.union(across)), "components")

    named = classes.join(linked.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id"))
    first = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = named.join(first, "root").select("set_id", "group_rows", "component_id", "root")
    some = F.col("n") > 0
    return attach(found.select("doc_id", "digest", "n", "set_id"), named, "set_id", total).select(
        "doc_id", "digest", "n", F.when(some, F.col("root")).alias("root"),
        F.when(some, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    return classified(docs, id_col, text_col, words, False).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of smallest id (a null
    id comes last), ties by the text's digest; of rows equal in both, one.
    Another text under a dropped row's id is a row of its own. Texts without
    words are in no component and all stay."""
    found = materialize(classified(docs, id_col, text_col, WORDS, True), "near-classified")
    grouped = found.filter("root is not null")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    first = grouped.groupBy("root").agg(F.count("*").alias("group_rows"), F.min(order).alias("first"))
    met = materialize(attach(grouped.select("root", "doc_id", "digest"), first, "root", found.count()).select(
        "root", "doc_id", "digest",
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))).alias("kept")), "near-met")
    again = met.filter("kept").groupBy("root", "doc_id", "digest").count().filter("count > 1")
    decided = (met.select("doc_id", "digest", "kept")
               .unionByName(again.select("doc_id", "digest", F.lit(False).alias("kept")))
               .unionByName(found.filter("root is null").select("doc_id", "digest", F.lit(True).alias("kept"))))
    return keep_rows(docs, decided, id_col, text_digest(text_col))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def brute_force(docs: list[tuple], words: int = WORDS) -> dict:
    """All pairs of sets of word tuples (for tests on small data)."""
    import re

    sets = {}
    for doc_id, text in docs:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[doc_id] = {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and DEN * both >= NUM * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {d: (len(sets[d]), find(d)) for d in ids}
