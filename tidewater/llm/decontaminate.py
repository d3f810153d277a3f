"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items are inserted into one suffix automaton over words.
Documents stream through it word by word; the state tracks the longest suffix
of the words read so far that occurs in some item. Where that length reaches
the window (10 words) an item window ends here; shorter items count when the
whole item is a suffix of the match. The words of all such windows are hit.

The automaton is broadcast. Items are dealt into shards of at most
``SHARD_WORDS`` words, one automaton each, and documents stream past the
shards one after another, so no broadcast grows with the benchmark.

Defined results: null and wordless texts have no words and no hits; null items
and wordless items match nothing; items with equal texts all count; a null
item id is matched but left out of the id list; an empty benchmark leaves all
documents clean; an empty table gives an empty one. Repeated document rows are
judged one by one. Extra columns pass through; one named like a result column
is replaced by it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import LOWER, table

WINDOW = 10
# About 300 bytes of automaton per word: a shard stays under 150 MB.
SHARD_WORDS = 500_000
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER)) if text else []


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the items of a state."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.window = window
        self.next: list[dict[str, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.names: list[str] = []
        sequences: dict[tuple[str, ...], list[int]] = {}
        for name, words in items:
            if words:
                sequences.setdefault(tuple(words), []).append(len(self.names))
                self.names.append(name)
        self.shortest = min((min(len(s), window) for s in sequences), default=0)
        for s in sequences:
            last = 0
            for w in s:
                last = self._extend(last, w)
        # whole items shorter than a window, by the state that holds them
        self.whole: dict[int, list[tuple[int, list[int]]]] = {}
        # items that contain the strings of a state of window length
        self.owners: dict[int, set[int]] = {}
        for s, ids in sequences.items():
            v = 0
            for i, w in enumerate(s):
                v = self.next[v][w]
                if i + 1 >= window:
                    u = v
                    while self.length[self.link[u]] >= window:
                        u = self.link[u]
                    self.owners.setdefault(u, set()).update(ids)
            if len(s) < window:
                self.whole.setdefault(v, []).append((len(s), ids))

    def _extend(self, last: int, w: str) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: str, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int]], set[int]]:
        """Half-open word ranges of the windows found, and the items found."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        root = nxt[0]
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        v = matched = 0
        for i, w in enumerate(words):
            if v == 0 and w not in root:
                continue
            while v and w not in nxt[v]:
                v = link[v]
                matched = length[v]
            if w in nxt[v]:
                v = nxt[v][w]
                matched += 1
            if matched < self.shortest:
                continue
            if matched >= window:
                spans.append((i + 1 - window, i + 1))
            u = v
            while u > 0:
                for size, ids in self.whole.get(u, ()):
                    if size <= matched:
                        spans.append((i + 1 - size, i + 1))
                        found.update(ids)
                # the longest suffix of the match that lies in u
                if min(matched, length[u]) >= window > length[link[u]]:
                    found.update(self.owners.get(u, ()))
                u = link[u]
        return spans, found


def _shards(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> list[ItemAutomaton]:
    """Read item by item; a shard closes when it has SHARD_WORDS words."""
    out, items, size = [], [], 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    for row in rows.toLocalIterator():
        words = words_of(row.text)
        items.append((row.item, words))
        size += len(words)
        if size >= SHARD_WORDS:
            out.append(ItemAutomaton(items, window))
            items, size = [], 0
    return [*out, ItemAutomaton(items, window)] if items or not out else out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from the first to the last word of each span."""
    at = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    kept, done = [], 0
    for a, b in spans:
        kept.append(text[done:at[a][0]])
        done = at[b - 1][1]
    return "".join([*kept, text[done:]])


REPORT = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("longest_hit", T.LongType()),
          ("hit_items", T.ArrayType(T.StringType())), ("clean_text", T.StringType())]


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """``docs`` plus n_words, n_hit, longest_hit (words of the longest hit
    run), hit_items (sorted as strings) and, if asked for, clean_text (the
    text without its hit runs; the very same text if there are none)."""
    automata = _shards(benchmark, item_col, item_text_col, window)
    shared = [docs.sparkSession.sparkContext.broadcast(a) for a in automata]
    report = [(n, t) for n, t in REPORT if with_text or n != "clean_text"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {n for n, _ in report} and c != text_col])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch[text_col]:
                words = words_of(text)
                spans, items = [], set()
                for part in shared:
                    got, ids = part.value.scan(words)
                    spans += got
                    items |= {part.value.names[i] for i in ids if part.value.names[i] is not None}
                spans = _merged(spans)
                sizes = [b - a for a, b in spans]
                row = [len(words), sum(sizes), max(sizes, default=0), sorted(items)]
                rows.append([*row, _without(text, spans) if spans else text] if with_text else row)
            made = pd.DataFrame(rows, columns=[n for n, _ in report], index=batch.index, dtype=object)
            yield pd.concat([batch, made], axis=1)

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in report)])
    return docs.mapInPandas(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_run: int = 0,
                  max_coverage: float = 0.0, drop_coverage: float = 0.8, window: int = WINDOW) -> DataFrame:
    """Remove benchmark text. A document is touched when its longest hit run
    exceeds ``max_run`` words or its hit share exceeds ``max_coverage``; it then
    loses its hit runs, or goes as a whole above ``drop_coverage``. All other
    documents stay as they are."""
    plain = [f"c{i}" for i in range(len(docs.columns))]  # no input column can clash with the scan's
    text_at = plain[docs.columns.index(text_col)]
    seen = scan(docs.toDF(*plain), benchmark, text_at, window=window, with_text=True)
    share = F.col("n_hit") / F.greatest(F.col("n_words"), F.lit(1))
    over = (F.col("longest_hit") > max_run) | (share > max_coverage)
    text = F.when(over, F.col("clean_text")).otherwise(F.col(text_at))
    kept = seen.filter(~(over & (share > drop_coverage)))
    return kept.select(*[(text if c == text_at else F.col(c)).alias(n) for c, n in zip(plain, docs.columns)])


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns of a scan."""
    return scanned.select(
        F.col(id_col).alias("doc_id"), "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lean = scan(docs, table(spark, sf_dir, "benchmark"))
    return digest(lean)


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> dict:
    """Every window against every document position (for tests on small data)."""
    out = {}
    for doc_id, text in docs:
        words = words_of(text)
        hit, ids = set(), set()
        for item_id, item_text in items:
            item = words_of(item_text)
            n = min(window, len(item))
            for start in range(len(item) - n + 1 if n else 0):
                for at in range(len(words) - n + 1):
                    if words[at:at + n] == item[start:start + n]:
                        hit.update(range(at, at + n))
                        ids.add(str(item_id))
        joined = ",".join(sorted(ids))
        out[doc_id] = (len(words), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), bool(hit))
    return out
