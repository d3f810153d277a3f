"""Toxicity by weak supervision.

1. Lexicon entries (words and word beginnings) are mined from a bounded,
   balanced sample of labelled rows: at most ``SAMPLE_PER_CLASS`` rows a class,
   those of the smallest id hashes. They are dealt into lexicon voters; pattern
   voters look at the form of a text.
2. A generative label model looks at votes only: the second moments of all
   votes over all documents (a voters x voters matrix summed in Spark). With
   the class share known, a rank-one factor of the covariances gives each
   voter's accuracy (its vote's difference between the classes); what that
   factor leaves unexplained is the voters' correlation within a class. Both
   give each document a posterior probability of being toxic.
3. A linear classifier over entries and patterns is trained on the posterior
   labels of a bounded sample and scores every document.

Rows whose crc32(id as text) mod 5 is 0 are held out: their labels are never
read, and they take no part in the moments or the classifier's sample.

Defined results: null and empty texts are scored like any other text without
entries; a document with several labels is toxic if one says so; null labels
are left out; with no label of one class every score is that class share
(0 without labels); a null id is never a training row; repeated rows are
scored one by one; an empty table gives an empty one; extra columns pass
through, and one named like a result is replaced by it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import crc32_bucket, drawn, table
from tidewater.session import materialize

HELD_OUT_OF = 5
SAMPLE_PER_CLASS = 10_000
CLASSIFIER_ROWS = 40_000
ENTRIES = 96
MOST_VOTERS = 16
PREFIXES = (4, 5)
LEAST_SUPPORT = 5
# Entries far less telling than the best one are chance finds in copied texts.
LEAST_GAIN = 0.2
WORD = re.compile(r"[^\W\d_]+")

# Pattern voters: a name and what of a text's form it votes on.
PATTERNS = {
    "shouting": lambda text, words: sum(1 for w in words if len(w) > 2 and w.isupper()) > 0.3 * max(1, len(words)),
    "exclaiming": lambda text, words: text.count("!") > 0.05 * max(1, len(words)),
    "asking": lambda text, words: text.count("?") > 0.05 * max(1, len(words)),
    "stretched": lambda text, words: re.search(r"(\w)\1{3}", text) is not None,
    "marked": lambda text, words: re.search(r"[*#$%&]{3}", text) is not None,
    "brief": lambda text, words: len(words) < 20,
}


def entry_keys(words: set[str]) -> Iterator[str]:
    """What of a text's words can be an entry: ``w=`` a word, ``p=`` a beginning."""
    for w in words:
        yield f"w={w}"
        for n in PREFIXES:
            if len(w) >= n:
                yield f"p={w[:n]}"


@dataclass
class ToxicityModel:
    entries: dict[str, int] = field(default_factory=dict)  # entry -> feature number
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(PATTERNS)))
    bias: float = 0.0
    share: float = 0.0  # of toxic rows among the training labels
    accuracies: np.ndarray = field(default_factory=lambda: np.zeros(0))
    correlations: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    @property
    def lexicons(self) -> int:
        """Lexicon voters: two entries or more each, dealt by rank, so that
        voters overlap in what they find and their agreement can be measured."""
        return max(1, min(MOST_VOTERS, len(self.entries) // 2))

    def features(self, text: str | None) -> list[int]:
        """Numbers of the entries (from 0) and then patterns that hold."""
        text = text or ""
        words = WORD.findall(text)
        found = {self.entries[k] for k in entry_keys({w.lower() for w in words}) if k in self.entries}
        base = len(self.entries)
        return [*sorted(found), *(base + i for i, p in enumerate(PATTERNS.values()) if p(text, words))]

    def score(self, features: list[int]) -> float:
        if not self.entries:
            return self.share
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[features].sum(), -30, 30))))

    def votes(self, features: list[int]) -> np.ndarray:
        """One vote per lexicon voter (entries dealt by rank), then per pattern."""
        v = np.zeros(self.lexicons + len(PATTERNS))
        for f in features:
            v[f % self.lexicons if f < len(self.entries) else self.lexicons + f - len(self.entries)] = 1
        return v


def mined_entries(sample: DataFrame, text_col: str) -> list[str]:
    """The entries that tell the classes apart best, by the likelihood-ratio
    statistic of their document counts, most telling first. Equal texts count
    once. ``sample`` has a boolean ``is_toxic``."""
    texts = sample.groupBy(F.col(text_col).alias("text")).agg(F.max("is_toxic").alias("is_toxic"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["is_toxic"]):
                counts[bool(toxic)].update(set(entry_keys({w.lower() for w in WORD.findall(text or "")})) | {""})
        keys = list(counts[True] | counts[False])
        yield pd.DataFrame({"entry": keys, "pos": [counts[True][k] for k in keys], "neg": [counts[False][k] for k in keys]})

    counted = texts.mapInPandas(count, "entry string, pos long, neg long").groupBy("entry").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    totals = counted.filter("entry = ''").first()
    if not totals or not totals.pos or not totals.neg:
        return []
    p, n = F.lit(float(totals.pos)), F.lit(float(totals.neg))
    rate = (F.col("pos") + F.col("neg")) / (p + n)
    gain = 2 * (F.col("pos") * F.log((F.col("pos") + 0.5) / (p * rate + 0.5))
                + F.col("neg") * F.log((F.col("neg") + 0.5) / (n * rate + 0.5)))
    telling = counted.filter((F.col("entry") != "") & (F.col("pos") >= LEAST_SUPPORT)
                             & (F.col("pos") / p > 15 * (F.col("neg") + 1) / n))
    best = telling.select("entry", "pos", gain.alias("gain")).orderBy(F.desc("gain"), "entry").limit(ENTRIES).collect()
    return [r.entry for r in best if r.gain >= LEAST_GAIN * best[0].gain
            and not any(_covers(r.entry, o.entry) and o.pos >= 0.9 * r.pos for o in best)]


def _covers(a: str, b: str) -> bool:
    """Entry a is a beginning that holds wherever b does."""
    return a != b and a[0] == "p" and b[2:].startswith(a[2:]) and (b[0] == "w" or len(b) > len(a))


def label_model(moments: np.ndarray, rows: int, share: float, lexicons: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the sums of votes (diagonal) and of pairs of votes: the votes'
    means, each voter's accuracy and the covariances within a class.

    Covariance = share (1 - share) a a' + W. Off the diagonal W is small but
    for correlated voters, so ``a`` is fitted to the off-diagonal entries by
    alternating updates, weighing down the pairs that fit worst."""
    mean = np.diag(moments) / rows
    cov = moments / rows - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = cov / np.outer(scale, scale)
    off = ~np.eye(len(mean), dtype=bool)
    live = np.diag(cov) > 1e-9
    weight = off & np.outer(live, live)
    b = np.where(live & (np.arange(len(mean)) < lexicons), 0.5, 0.0)  # lexicons lean to toxic
    w = weight.astype(float)
    for _ in range(200):
        top, low = (w * corr) @ b, w @ (b * b)
        b = np.clip(0.5 * b + 0.5 * np.where(low > 1e-9, top / np.maximum(low, 1e-9), 0), -0.98, 0.98)
        w = weight / (0.05 + np.abs(corr - np.outer(b, b)))
    spread = max(share * (1 - share), 1e-6)
    accuracy = np.clip(b * scale / np.sqrt(spread), -1, 1)
    within = cov - spread * np.outer(accuracy, accuracy)
    return mean, accuracy, within


def posteriors(votes: np.ndarray, mean: np.ndarray, accuracy: np.ndarray, within: np.ndarray,
               share: float, lexicons: int) -> np.ndarray:
    """The probability of being toxic of each row of ``votes``. A voter that
    finds nothing abstains. One that votes gives the log of its hit rates in
    the two classes, divided by one plus its correlations (within a class) with
    the other voters of that row, so that voters that repeat each other count
    about once. Rows without a vote share the toxic mass that is left."""
    hit = np.clip(mean + (1 - share) * accuracy, 1e-4, 1)
    miss = np.clip(mean - share * accuracy, 2e-3, 1)
    scale = np.sqrt(np.maximum(np.diag(within), 1e-9))
    together = np.clip(within / np.outer(scale, scale), 0, 1)
    np.fill_diagonal(together, 0)
    evidence = votes * np.log(hit / miss) / (1 + votes * (votes @ together))
    prior = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    p = 1 / (1 + np.exp(-np.clip(prior + evidence.sum(axis=1), -30, 30)))
    none = ~votes[:, :lexicons].any(axis=1)
    if none.any():
        rest = (share * len(votes) - p[~none].sum()) / none.sum()
        p[none] = np.clip(rest, 1e-3, share / 2)
    return p


def fit_linear(rows: list[list[int]], target: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels with a small ridge, by Newton steps
    on the normal matrix of the (few hundred) features."""
    x = np.zeros((len(rows), size + 1), np.float32)
    x[:, size] = 1
    for i, features in enumerate(rows):
        x[i, features] = 1
    w = np.zeros(size + 1)
    ridge = np.full(size + 1, 0.5)
    ridge[size] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge) + 1e-6 * np.eye(size + 1)
        step = np.linalg.solve(hessian.astype(float), x.T @ (target - p) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w[:size], float(w[size])


def with_features(docs: DataFrame, model: ToxicityModel, id_col: str, text_col: str) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"],
                                "features": [shared.value.features(t) for t in batch["text"]]})

    return docs.select(F.col(id_col).alias("doc_id"), _held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text")).mapInPandas(
        run, f"doc_id {id_type}, held_out boolean, features array<int>")


def _held_out(id_col: str):
    return F.coalesce(crc32_bucket(id_col, HELD_OUT_OF) == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> ToxicityModel:
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).filter(
        F.col("_id").isNotNull() & F.col("_y").isNotNull()).filter(~_held_out("_id")).groupBy("_id").agg(
        (F.max("_y") > 0).alias("is_toxic"))
    counts = {r.is_toxic: r["count"] for r in known.groupBy("is_toxic").count().collect()}
    if not counts.get(True) or not counts.get(False):
        return ToxicityModel(share=float(bool(counts.get(True))))
    share = counts[True] / (counts[True] + counts[False])
    sample = drawn(known.filter("is_toxic"), counts[True], SAMPLE_PER_CLASS, "_id").union(
        drawn(known.filter("not is_toxic"), counts[False], SAMPLE_PER_CLASS, "_id"))
    # at most 2 * SAMPLE_PER_CLASS ids: a bounded broadcast
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col)).join(F.broadcast(sample), "_id")
    model = ToxicityModel({e: i for i, e in enumerate(mined_entries(rows, text_col))}, share=share)
    if not model.entries:
        return model
    found = materialize(with_features(docs, model, id_col, text_col).filter(~F.col("held_out")), "toxicity-features")
    shared = spark.sparkContext.broadcast(model)
    size = model.lexicons + len(PATTERNS)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((size, size)), 0
        for batch in batches:
            if len(batch):
                v = np.array([shared.value.votes(f) for f in batch["features"]])
                total += v.T @ v
                n += len(v)
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": [*i.ravel(), -1], "j": [*j.ravel(), -1], "s": [*total.ravel(), n]})

    summed = found.mapInPandas(moments, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    matrix, n = np.zeros((size, size)), 0
    for r in summed:
        if r.i < 0:
            n = r.s
        else:
            matrix[r.i, r.j] = r.s
    if not n:
        return model
    mean, model.accuracies, within = label_model(matrix, n, share, model.lexicons)
    scale = np.sqrt(np.maximum(np.diag(within), 1e-9))
    model.correlations = within / np.outer(scale, scale)
    rows = [list(r.features) for r in drawn(found, int(n), CLASSIFIER_ROWS, "doc_id").select("features").collect()]
    target = posteriors(np.array([model.votes(f) for f in rows]), mean, model.accuracies, within, share,
                        model.lexicons)
    model.weights, model.bias = fit_linear(rows, target, len(model.entries) + len(PATTERNS))
    return model


def scored(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            m = shared.value
            yield batch.assign(score=[m.score(m.features(t)) for t in batch[text_col]])

    results = ("held_out", "score", "predicted")
    named = docs.drop(*[c for c in docs.columns if c.lower() in results]).withColumn("held_out", _held_out(id_col))
    schema = T.StructType([*named.schema.fields, T.StructField("score", T.DoubleType())])
    return named.mapInPandas(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the model calls toxic."""
    plain = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, plain))
    return scored(docs.toDF(*plain), model, at[id_col], at[text_col]).filter("predicted = 0").select(plain).toDF(*docs.columns)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select("doc_id", "held_out", "score", "predicted")
