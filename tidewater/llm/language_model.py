"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions down a binary tree. For each context of
0 to ``DEPTH`` preceding bytes and each decision the training texts give two
counts, and these a Krichevsky-Trofimov estimate. Context-tree weighting mixes
the estimates of all depths: a node's weighted probability is half its own
estimate's and half the product of its children's, so the mixing weights
follow from the counts. A text ends with a symbol of its own (byte 255, which
UTF-8 never has) and starts in a context of such symbols, so the probabilities
of all texts sum to one. A text's code length is -log2 of its probability.

The counts of all (context, byte) strings and of all words are summed over the
whole training part in Spark. The tree is worked on in partitions by the two
nearest context bytes; only depths 0 and 1 (at most 65,280 nodes) are put
together on the driver. Scoring broadcasts the most frequent strings and words
(``HEAD_STRINGS``, ``HEAD_WORDS``); the rarer ones are joined by shuffle, so no
table's size is bounded by the driver or a worker.

Base score: add-0.1 smoothed unigrams of words, the sum over tokens of
log10((c + 0.1) / (N + 0.1 (V + 1))), with the end of a text as one token.

Defined results: a null text is empty: one token, and the end symbol alone; a
null id is held out; repeated rows are scored (and counted) one by one;
without training rows every decision has probability one half; an empty table
gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import crc32_bucket, located, table, tasks_for
from tidewater.llm.shingles import mix, word_hashes
from tidewater.session import materialize

HELD_OUT_OF = 10
DEPTH = 6
HEAD_STRINGS = 1 << 19
HEAD_WORDS = 1 << 18
PIECE = 1 << 18
HELD_KEYS = 1_000_000
BUCKETS = 1 << 12
PENDING_KEYS = 500_000
TREE_KEYS = 400_000
END = b"\xff"
# The end token's hash; no word can contain a blank, so none is hashed like it.
END_TOKEN = 0x5DEECE66D1234567
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def pieces(texts: list[str | None]) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """Batches of (text number, context bytes, text bytes) of bounded size.
    Long texts are cut after a blank; the last piece ends with END."""
    batch, size = [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass") + END
        at, context = 0, END * DEPTH
        while at < len(raw):
            to = len(raw)
            if to - at > PIECE and (m := BLANK.search(raw, at + PIECE)):
                to = m.end()
            batch.append((i, context, raw[at:to]))
            size += to - at
            context = (context + raw[max(0, to - DEPTH):to])[-DEPTH:]
            at = to
            if size > PIECE:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def grams(batch: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte with its context as one number, and the batch's text numbers."""
    raw = np.frombuffer(b"".join(c + r for _, c, r in batch), np.uint8).astype(np.int64)
    n = len(raw) - DEPTH
    found = raw[:n]
    for k in range(1, DEPTH + 1):
        found = found << 8 | raw[k:n + k]
    sizes = np.array([len(r) for _, _, r in batch])
    ends = np.cumsum(sizes + DEPTH)
    inside = np.ones(len(raw), bool)
    for k in range(DEPTH):  # strings that start in a piece's last bytes reach into the next piece
        inside[ends - 1 - k] = False
    return found[inside[:len(found)]], np.repeat([i for i, _, _ in batch], sizes)


def words(batch: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and the text numbers. Ends are left to the caller."""
    found, counts = word_hashes([r.removesuffix(END) for _, _, r in batch])
    return found.view(np.int64), np.repeat([i for i, _, _ in batch], counts)


class Counts:
    """Counts of keys in two columns, merged whenever many have gathered."""

    def __init__(self):
        self.keys, self.columns, self.size = [], [], 0

    def add(self, keys: np.ndarray, counted: np.ndarray) -> None:
        """Keys of one batch; ``counted`` tells which also count for training."""
        order = np.sort(keys)
        first = np.flatnonzero(np.diff(order, prepend=order[0] - 1)) if len(order) else np.zeros(0, int)
        total = np.diff(first, append=len(order))
        unique = order[first]
        if counted.all():
            train = total
        else:
            some = np.sort(keys[counted])
            train = np.searchsorted(some, unique, "right") - np.searchsorted(some, unique, "left")
        self.put(unique, np.stack([train, total]))

    def put(self, keys: np.ndarray, columns: np.ndarray) -> None:
        """Counts of distinct keys."""
        self.keys.append(keys)
        self.columns.append(columns)
        self.size += len(keys)
        if self.size > PENDING_KEYS:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) != 1:
            keys = np.concatenate(self.keys or [np.zeros(0, np.int64)])
            columns = np.concatenate(self.columns or [np.zeros((2, 0), np.int64)], axis=1)
            order = np.argsort(keys, kind="stable")
            keys, columns = keys[order], columns[:, order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
            self.keys = [keys[first]]
            self.columns = [np.add.reduceat(columns, first, axis=1) if len(first) else columns]
        self.size = 0  # what is merged stays, new batches gather on top
        return self.keys[0], self.columns[0]


COUNTED = "is_word boolean, bucket int, n long, key binary, train binary, total binary"


def packed(column: np.ndarray) -> bytes:
    """Numbers by byte planes: all lowest bytes first, the highest last. Sorted
    keys and small counts then compress well where they are shuffled."""
    return np.ascontiguousarray(column, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def bucket_of(is_word: bool, keys: np.ndarray) -> np.ndarray:
    """Strings go by their two nearest context bytes, words by themselves."""
    by = keys if is_word else keys >> 8 & 65535
    return (mix(by.view(np.uint64)) % np.uint64(BUCKETS)).astype(np.int32)


def bucket_rows(is_word: bool, bucket: int, keys, trained, total) -> dict:
    return {"is_word": is_word, "bucket": int(bucket), "n": len(keys), "key": packed(keys), "train": packed(trained), "total": packed(total)}


def count_strings(rows: DataFrame) -> DataFrame:
    """One row per kind and bucket: its keys in order with their corpus counts.
    A task sends what it counted, cut by bucket, once HELD_KEYS keys have
    gathered; a bucket's parts are added up one after another."""
    def sent(is_word: bool, counts: Counts) -> Iterator[pd.DataFrame]:
        keys, (trained, total) = counts.merge()
        bucket = bucket_of(is_word, keys)
        order = np.argsort(bucket, kind="stable")
        bucket, keys, trained, total = bucket[order], keys[order], trained[order], total[order]
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(first[1:], len(keys))
        for at in range(0, len(first), 256):
            yield pd.DataFrame([bucket_rows(is_word, bucket[i], keys[i:j], trained[i:j], total[i:j])
                                for i, j in zip(first[at:at + 256], ends[at:at + 256])])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = [Counts(), Counts()]
        for batch in batches:
            train = ~batch["held_out"].to_numpy(bool)
            for part in pieces(list(batch["text"])):
                for is_word, (keys, text) in enumerate((grams(part), words(part))):
                    tables[is_word].add(keys, train[text])
                    if len(tables[is_word].keys) == 1 and len(tables[is_word].keys[0]) > HELD_KEYS:
                        yield from sent(bool(is_word), tables[is_word])
                        tables[is_word] = Counts()
            n = len(train)
            tables[1].add(np.full(n, END_TOKEN), train)
        for is_word, counts in enumerate(tables):
            yield from sent(bool(is_word), counts)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, counts = None, Counts()
        for batch in batches:
            for r in batch.itertuples(index=False):
                if (r.is_word, r.bucket) != current:
                    if current is not None:
                        keys, columns = counts.merge()
                        yield pd.DataFrame([bucket_rows(*current, keys, *columns)])
                    current, counts = (r.is_word, r.bucket), Counts()
                counts.put(unpacked(r.key), np.stack([unpacked(r.train), unpacked(r.total)]))
        if current is not None:
            keys, columns = counts.merge()
            yield pd.DataFrame([bucket_rows(*current, keys, *columns)])

    return (rows.mapInPandas(run, COUNTED).repartition("is_word", "bucket")
            .sortWithinPartitions("is_word", "bucket").mapInPandas(add_up, COUNTED))


def spread(counted: DataFrame) -> DataFrame:
    """(key, train, total), one row per key."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                yield pd.DataFrame({"key": unpacked(r.key), "train": unpacked(r.train), "total": unpacked(r.total)})

    return counted.mapInPandas(run, "key long, train long, total long")


_HALVES = np.array([math.lgamma(i + 0.5) for i in range(1024)])
_WHOLES = np.array([math.lgamma(i + 1) for i in range(1024)])


def _log_gamma(n: np.ndarray, shift: float, small: np.ndarray) -> np.ndarray:
    """log gamma(n + shift) of whole n, by table and by Stirling's series."""
    x = np.maximum(n + shift, 100.0)
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)
    return np.where(n < 1024, small[np.minimum(n, 1023).astype(np.int64)], series)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _log_gamma(n0, 0.5, _HALVES) + _log_gamma(n1, 0.5, _HALVES) - math.log(math.pi) - _log_gamma(n0 + n1, 1.0, _WHOLES)


class Level:
    """The nodes of one depth: keys (context, then 1 and the decisions so far),
    counts, and the logs of own and weighted probability."""

    def __init__(self, keys, n0, n1, below=None):
        self.keys, self.n0, self.n1 = keys, n0, n1
        own = log_kt(n0, n1)
        self.weighted = own if below is None else np.logaddexp(own, below) - math.log(2)
        self.stop = np.ones(len(keys)) if below is None else np.exp(own - math.log(2) - self.weighted)
        self.one = (n1 + 0.5) / (n0 + n1 + 1)

    def up(self, mask: int) -> tuple["Level", np.ndarray]:
        """The level of the parents, and each node's parent."""
        keys, parent = np.unique(self.keys & mask, return_inverse=True)
        sums = [np.bincount(parent, x, len(keys)) for x in (self.n0, self.n1, self.weighted)]
        return Level(keys, sums[0], sums[1], sums[2]), parent


def decisions(key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each bit of the last byte: the node (context << 8 | place) and the bit."""
    context, symbol = key >> 8 << 8, key & 255
    for j in range(8):
        yield context | 1 << j | symbol >> (8 - j), symbol >> (7 - j) & 1


def levels(node: np.ndarray, bit: np.ndarray, n: np.ndarray) -> list[tuple[Level, np.ndarray | None]]:
    """Levels DEPTH down to 2 of the counts of one decision. Decisions share no
    nodes, so one at a time needs an eighth of the memory."""
    keys, at = np.unique(node, return_inverse=True)
    out = [(Level(keys, np.bincount(at, n * (1 - bit), len(keys)), np.bincount(at, n * bit, len(keys))), None)]
    for depth in range(DEPTH - 1, 1, -1):
        level, parent = out[-1][0].up((1 << 8 * (depth + 1)) - 1)
        out[-1] = out[-1][0], parent
        out.append((level, None))
    return out


def _buckets(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, training and whole counts of buckets, several small ones at a time."""
    got, size = [], 0
    for batch in batches:
        for r in batch.itertuples(index=False):
            got.append((unpacked(r.key), unpacked(r.train), unpacked(r.total)))
            size += r.n
            if size > TREE_KEYS:
                yield tuple(map(np.concatenate, zip(*got)))
                got, size = [], 0
    if got:
        yield tuple(map(np.concatenate, zip(*got)))


def _tree_top(strings: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For every node of depth 1: the mixture so far and the weight left."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, n, _ in _buckets(batches):
            if n.any():
                for node, bit in decisions(key[n > 0]):
                    level = levels(node, bit, n[n > 0].astype(float))[-1][0]
                    yield pd.DataFrame({"node": level.keys & 0xFFFF, "n0": level.n0, "n1": level.n1, "below": level.weighted})

    found = strings.mapInPandas(run, "node long, n0 double, n1 double, below double").groupBy("node").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below")).toPandas().sort_values("node")
    mixture, left = np.full(1 << 16, 0.5), np.zeros(1 << 16)
    if not len(found):
        return mixture, left
    one = Level(*(found[c].to_numpy() for c in ("node", "n0", "n1", "below")))
    root, parent = one.up(0xFF)
    root_mixture, root_left = root.stop * root.one, 1 - root.stop
    # decisions never seen at depth 1 end at the root, and else at one half
    place = np.arange(1 << 16) & 0xFF
    at = np.minimum(np.searchsorted(root.keys, place), len(root.keys) - 1)
    known = root.keys[at] == place
    mixture = np.where(known, root_mixture[at] + root_left[at] / 2, 0.5)
    mixture[one.keys] = root_mixture[parent] + root_left[parent] * one.stop * one.one
    left[one.keys] = root_left[parent] * (1 - one.stop)
    return mixture, left


def string_scores(strings: DataFrame) -> DataFrame:
    """(key, total, value): log10 probability of each string's last byte.
    A row of ``strings`` is a bucket: all strings of some pairs of nearest
    context bytes; rows of single strings are put into buckets first."""
    if dict(strings.dtypes)["key"] == "bigint":
        strings = strings.withColumn("bucket", F.shiftright("key", 8).bitwiseAND(F.lit(65535)) % BUCKETS).groupBy("bucket").applyInPandas(
            lambda b: pd.DataFrame([bucket_rows(False, b["bucket"].iat[0], *(b[c].to_numpy() for c in ("key", "train", "total")))]), COUNTED)
    top = strings.sparkSession.sparkContext.broadcast(_tree_top(strings))

    def scored(key: np.ndarray, train: np.ndarray, total: np.ndarray) -> pd.DataFrame:
        n = train.astype(float)
        mixture, left = top.value
        seen = n > 0
        value = np.zeros(len(key))
        for node, bit in decisions(key):
            p = mixture[node & 0xFFFF] + left[node & 0xFFFF] / 2
            below = levels(node[seen], bit[seen], n[seen]) if seen.any() else []
            before = None
            for depth, (level, _) in enumerate(reversed(below), 2):  # mixture so far and weight left, from depth 2 down
                if before is None:
                    before, rest = mixture[level.keys & 0xFFFF], left[level.keys & 0xFFFF]
                else:
                    parent = below[DEPTH - depth][1]
                    before, rest = before[parent], rest[parent]
                before, rest = before + rest * level.stop * level.one, rest * (1 - level.stop)
                want = node & (1 << 8 * (depth + 1)) - 1
                at = np.minimum(np.searchsorted(level.keys, want), len(level.keys) - 1)
                p = np.where(level.keys[at] == want, before[at] + rest[at] / 2, p)
            value += np.log10(np.where(bit == 1, p, 1 - p))
        return pd.DataFrame({"key": key, "total": total, "value": value})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bucket in _buckets(batches):
            yield scored(*bucket)

    return strings.mapInPandas(run, "key long, total long, value double")


class Lookup:
    """Values of frequent keys: a direct-mapped table, and a sorted list for
    keys whose slot is taken by a more frequent one."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(8, (2 * len(keys) + 1).bit_length())
        slot = self._slot(keys)
        self.key, self.value = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits)
        self.key[slot[::-1]], self.value[slot[::-1]] = keys[::-1], values[::-1]  # the first of a slot is written last
        rest = self.key[slot] != keys
        order = np.argsort(keys[rest])
        self.keys, self.values = keys[rest][order], values[rest][order]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values, and where they were found."""
        slot = self._slot(keys)
        found = self.key[slot] == keys
        value = np.where(found, self.value[slot], 0.0)
        miss = np.flatnonzero(~found)
        if len(miss) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys[miss]), len(self.keys) - 1)
            hit = self.keys[at] == keys[miss]
            value[miss[hit]] = self.values[at[hit]]
            found[miss[hit]] = True
        return value, found


def _head(values: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of the most frequent keys, ``most`` at most, in falling
    order: those at or above the least step of frequency (sixteenths of a
    doubling) that no more than ``most`` reach."""
    step = F.floor(16 * F.log2("total"))
    steps = values.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # at most a thousand rows
    least, size = None, 0
    for r in steps:
        size += r["count"]
        if size > most:
            break
        least = r.step
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0)
    rows = values.filter(step >= least).select("key", "value", "total").toPandas().sort_values(["total", "key"], ascending=[False, True])
    return rows["key"].to_numpy(np.int64), rows["value"].to_numpy(float)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", of: int = HELD_OUT_OF) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score and bits_per_byte."""
    spark = docs.sparkSession
    rows = located(docs, id_col, text_col).withColumn(
        "held_out", F.coalesce(crc32_bucket("doc_id", of) == 0, F.lit(True)))
    counted = materialize(count_strings(rows), "lm-counts")
    log_words = materialize(spread(counted.filter("is_word")).filter("train > 0").select(
        "key", "train", "total", F.log10(F.col("train") + 0.1).alias("value")), "lm-words")
    n, v = log_words.agg(F.coalesce(F.sum("train"), F.lit(0)), F.count("*")).first()
    strings = counted.filter("not is_word")
    held = strings.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    by_context = strings.repartition(tasks_for(spark, held, TREE_KEYS), "bucket")
    log_strings = materialize(string_scores(by_context), "lm-scores")
    shared = spark.sparkContext.broadcast((_head(log_strings, HEAD_STRINGS), _head(log_words, HEAD_WORDS)))
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame], misses: bool) -> Iterator[pd.DataFrame]:
        """Sums over the keys of the heads, or else each other key with its row."""
        heads = [Lookup(*head) for head in shared.value]
        for batch in batches:
            size = len(batch)
            sums, hits, seen = np.zeros((2, size)), np.zeros((2, size), np.int64), np.zeros((2, size), np.int64)

            def look(which, keys, text):
                value, found = heads[which](keys)
                if misses:
                    of = text[~found]
                    yield pd.DataFrame({"doc_id": batch["doc_id"].array[of], "row_no": batch["row_no"].to_numpy()[of],
                                        "is_word": bool(which), "key": keys[~found]})
                else:
                    sums[which] += np.bincount(text, value, size)
                    hits[which] += np.bincount(text[found], minlength=size)
                    seen[which] += np.bincount(text, minlength=size)

            for part in pieces(list(batch["text"])):
                yield from look(0, *grams(part))
                yield from look(1, *words(part))
            yield from look(1, np.full(size, END_TOKEN), np.arange(size))
            if not misses:
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].array, "row_no": batch["row_no"], "held_out": batch["held_out"],
                    "n_bytes": seen[0] - 1, "n_tokens": seen[1], "n_known": hits[1], "log_words": sums[1], "log_strings": sums[0]})

    # texts are read once for the sums and once for the rare keys, as these take more room than the texts
    firsts = rows.mapInPandas(
        lambda batches: scan(batches, False),
        f"doc_id {id_type}, row_no long, held_out boolean, n_bytes long, n_tokens long, n_known long, log_words double, log_strings double")
    rare = rows.mapInPandas(lambda batches: scan(batches, True), f"doc_id {id_type}, row_no long, is_word boolean, key long")
    values = log_words.select(F.lit(True).alias("is_word"), "key", "value").union(
        log_strings.select(F.lit(False).alias("is_word"), "key", "value"))
    seconds = rare.join(values.hint("shuffle_hash"), ["is_word", "key"], "left").groupBy(
        F.col("doc_id").alias("_doc"), F.col("row_no").alias("_row")).agg(
        F.sum(F.when(F.col("is_word"), F.coalesce("value", F.lit(-1.0)))).alias("more_words"),
        F.sum(F.when(~F.col("is_word"), F.col("value"))).alias("more_strings"),
        F.count_if(F.col("is_word") & F.col("value").isNotNull()).alias("more_known"))
    joined = firsts.join(
        seconds, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row_no") == F.col("_row")), "left")
    zero = F.lit(0)
    total = F.col("log_strings") + F.coalesce("more_strings", zero)
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_words") + F.coalesce("more_words", zero) - F.col("n_tokens") * math.log10(n + 0.1 * (v + 1))).alias("base_score"),
        total.alias("score"), (-total / math.log10(2) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))


def op10_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents")).drop("bits_per_byte")


def brute_force(docs: list[tuple], of: int = HELD_OUT_OF) -> dict:
    """The same scores from dictionaries of nodes (for tests on small data)."""
    import zlib
    from collections import Counter, defaultdict

    held = {d: zlib.crc32(str(d).encode()) % of == 0 for d, _ in docs}
    lower = {c: c + 32 for c in range(65, 91)}
    tokens = {d: [*re.findall("[^\x20\x09-\x0d]+", (t or "").translate(lower)), None] for d, t in docs}
    c = Counter(w for d, _ in docs if not held[d] for w in tokens[d])
    n, v = sum(c.values()), len(c)
    node: dict[tuple[bytes, str], list[int]] = defaultdict(lambda: [0, 0])

    def coded(t):
        raw = END * DEPTH + (t or "").encode() + END
        for i in range(DEPTH, len(raw)):
            bits = f"{raw[i]:08b}"
            for j in range(8):
                yield raw[i - DEPTH:i], bits[:j], int(bits[j])

    for d, t in docs:
        if not held[d]:
            for context, prefix, bit in coded(t):
                for k in range(DEPTH + 1):
                    node[context[DEPTH - k:], prefix][bit] += 1
    below: dict = defaultdict(float)
    weighted, own = {}, {}
    for (context, prefix), (a, b) in sorted(node.items(), key=lambda x: -len(x[0][0])):
        k = context, prefix
        own[k] = math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)
        weighted[k] = own[k] if len(context) == DEPTH else np.logaddexp(own[k], below[k]) - math.log(2)
        if context:
            below[context[1:], prefix] += weighted[k]

    def one(context, prefix):
        p, left = 0.0, 1.0
        for k in range(DEPTH + 1):
            key = context[DEPTH - k:], prefix
            if key not in node:
                return p + left / 2
            a, b = node[key]
            stop = 1.0 if k == DEPTH else math.exp(own[key] - math.log(2) - weighted[key])
            p, left = p + left * stop * (b + .5) / (a + b + 1), left * (1 - stop)
        return p

    out = {}
    for d, t in docs:
        total = sum(math.log10(p if bit else 1 - p) for context, prefix, bit in coded(t) for p in [one(context, prefix)])
        base = sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in tokens[d])
        out[d] = (held[d], len(tokens[d]), sum(c[w] > 0 for w in tokens[d]), n, base, total)
    return out
