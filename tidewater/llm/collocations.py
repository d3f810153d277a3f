"""Phrase collocations from a weighted de Bruijn graph.

Texts are cut into pieces at punctuation and line ends, pieces into words.
Nodes are runs of words, edges the longest grams (five words) that join two
overlapping nodes, weighted by how often they occur.

1. A first pass counts words and word pairs by hash slot. A slot is never too
   low, so what stays below ``least`` is certainly in no candidate; pieces are
   also ended there. This saves shuffle only. A quarter of ``least`` is asked
   for: with all of it a small corpus would shuffle next to nothing and a
   larger one out of proportion more.
2. A second pass gives one row per place: the edge that starts there, or, in
   the last places of a piece, the shorter gram up to its end. Equal rows are
   added up in the task, then dealt by their first three words.
3. Rows are sorted, so that edges leaving a node stand together. The flow out
   of a node plus the pieces that end in it is the node's count; this gives the
   counts of all shorter phrases without counting them in the texts.
4. Unary paths are compacted: a phrase whose whole flow goes into one longer
   phrase (equal counts) is only a part of that one and is dropped. A longer
   phrase of equal count passes through phrases of all lengths between with
   the same count, so one word more is all that has to be looked at.
5. Cuts look up the counts of both parts; scores are exact integers of up to 38
   digits. The best of each language are ranked in two steps, so no language
   is sorted in one task.

Words are told apart by 64-bit hashes of language and word. The words of
candidates are read from the texts in a third pass; should two share a hash,
that is noticed and raises.

Defined results: a null text counts as empty, a null language as ``und``;
repeated rows count each time; an empty table gives an empty result; ids and
other columns are not looked at. Of texts longer than a chunk the pieces are
worked off chunk by chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import IdFilter, table
from tidewater.llm.shingles import mix
from tidewater.session import materialize

LONGEST = 5
LEAST = 100
TOP = 2000
BREAKS = b".,;:!?\n\v\f\r"
CHUNK_BYTES = 4_000_000
HELD_ROWS = 1_000_000
# Words and pairs below this part of ``least`` end a piece.
RARE = 4
SEGMENT = 1 << 16
# Hash slots: one for 32 bytes of text, at most 128 MB in a task and 16 MB as
# a broadcast bit set. Fuller slots let more places through, nothing else.
BYTES_PER_SLOT, MAX_SLOTS = 32, 1 << 27
RANK_SALTS = 32
_COLS = [f"w{i}" for i in range(1, LONGEST + 1)]

_rng = np.random.default_rng(20250112)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(BREAKS)] = True
_IS_APART = _IS_BREAK.copy()
_IS_APART[[0x20, 0x09]] = True
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_VALUE[_IS_APART] = 0
_PLACES = _rng.integers(1, 1 << 63, LONGEST, dtype=np.uint64) | np.uint64(1)
_STEP, _FAR_STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_POWER = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full((1 << 16) - 1, _STEP)]))
_FAR = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full((1 << 16) - 1, _FAR_STEP)]))


def pieces_of(text: bytes, limit: int) -> Iterator[bytes]:
    """A text in parts of at most ``limit`` bytes that end at a break; a piece
    longer than that stays whole."""
    while len(text) > limit:
        cut = max(text.rfind(bytes([b]), 0, limit) for b in BREAKS)
        if cut < 0:
            later = [at for at in (text.find(bytes([b]), limit) for b in BREAKS) if at >= 0]
            if not later:
                break
            cut = min(later)
        yield text[:cut]
        text = text[cut + 1:]
    yield text


def chunks(batches: Iterator[pd.DataFrame], limit: int = CHUNK_BYTES) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language each, about ``limit`` bytes at a time."""
    for batch in batches:
        for lang, group in batch.groupby("lang", sort=False):
            part, size = [], 0
            for text in group["text"]:
                for piece in pieces_of(text.encode("utf-8", "surrogatepass"), limit):
                    if part and size + len(piece) > limit:
                        yield lang, part
                        part, size = [], 0
                    part.append(piece)
                    size += len(piece)
            if part:
                yield lang, part


class Words:
    """The words of some texts: hash ids, places, and whether a word is joined
    to the next one (same piece)."""

    def __init__(self, lang: str, texts: list[bytes]):
        raw = self.raw = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        apart = _IS_APART[raw]
        first = ~apart
        first[1:] &= apart[:-1]
        self.starts = np.flatnonzero(first)
        if not len(self.starts):
            self.ids, self.joined = np.zeros(0, np.uint64), np.zeros(0, bool)
            return
        at = np.arange(len(raw))
        at -= np.maximum.accumulate(np.where(first, at, 0))
        value = _VALUE[raw] * _POWER[at & 0xFFFF]
        if at.max() > 0xFFFF:
            value *= _FAR[at >> 16]
        salt = np.frombuffer(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), np.uint64)
        ids = mix(np.add.reduceat(value, self.starts) + salt)
        ids[ids == 0] = 1  # 0 stands for "no word"
        self.ids = ids
        breaks = np.cumsum(_IS_BREAK[raw], dtype=np.int32)[self.starts]
        self.joined = np.append(breaks[1:] == breaks[:-1], False)

    def pairs(self) -> np.ndarray:
        """A key for each word and the next one."""
        return mix(self.ids[:-1] * _PLACES[0] + self.ids[1:] * _PLACES[1])

    def text(self, i: int) -> bytes:
        start = self.starts[i]
        stop = self.starts[i + 1] if i + 1 < len(self.starts) else len(self.raw)
        word = self.raw[start:stop]
        return word[:len(word) - int(_IS_APART[word].sum())].tobytes()


def _slot_counts(slots: int, least: int):
    """Per task: the counts (at most ``least``) of hash slots in segments, as
    positions and counts, and the number of words per language."""
    top = min(least, 255)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, total = np.zeros(slots, np.uint8), {}
        for lang, texts in chunks(batches):
            words = Words(lang, texts)
            if not len(words.ids):
                continue
            total[lang] = total.get(lang, 0) + len(words.ids)
            keys = np.concatenate([words.ids, words.pairs()[words.joined[:-1]]])
            slot, n = np.unique((keys & np.uint64(slots - 1)).astype(np.int64), return_counts=True)
            counts[slot] = np.minimum(counts[slot] + np.minimum(n, top), top)
        for lang, n in total.items():
            number = int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=2).digest(), "little")
            yield pd.DataFrame({"segment": [-1 - number], "lang": [lang], "n": [n], "slots": [None], "counts": [None]})
        for segment in range(slots // SEGMENT):
            part = counts[segment * SEGMENT:(segment + 1) * SEGMENT]
            used = np.flatnonzero(part)
            if len(used):
                dense = 3 * len(used) > SEGMENT
                yield pd.DataFrame({"segment": [segment], "lang": [None], "n": [None],
                                    "slots": [None if dense else used.astype(np.uint16).tobytes()],
                                    "counts": [(part if dense else part[used]).tobytes()]})
    return run


_SLOT_ROWS = "segment long, lang string, n long, slots binary, counts binary"


def _merged_slots(least: int):
    """Rows arrive sorted by segment; a segment becomes a bit set of the slots
    that reach ``least``. Rows of word totals go through."""
    top = min(least, 255)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held = None, np.zeros(SEGMENT, np.int32)

        def packed():
            return pd.DataFrame({"segment": [current], "lang": [None], "n": [None], "slots": [None],
                                 "counts": [np.packbits(held >= top).tobytes()]})

        for batch in batches:
            totals = batch[batch["segment"] < 0]
            if len(totals):
                yield totals
            for row in batch[batch["segment"] >= 0].itertuples(index=False):
                if row.segment != current:
                    if current is not None:
                        yield packed()
                    current, held = row.segment, np.zeros(SEGMENT, np.int32)
                counts = np.frombuffer(row.counts, np.uint8)
                if row.slots is None:
                    held += counts
                else:
                    held[np.frombuffer(row.slots, np.uint16)] += counts
                np.minimum(held, top, out=held)
        if current is not None:
            yield packed()
    return run


def frequent_slots(texts: DataFrame, least: int) -> tuple[DataFrame, np.ndarray]:
    """Words per language, and the bit set of slots that reach ``least``."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = min(MAX_SLOTS, max(SEGMENT, 1 << (size // BYTES_PER_SLOT).bit_length()))
    merged = materialize(texts.mapInPandas(_slot_counts(slots, least), _SLOT_ROWS).repartition("segment")
                         .sortWithinPartitions("segment").mapInPandas(_merged_slots(least), _SLOT_ROWS), "slots")
    bits = np.zeros(slots // 8, np.uint8)
    for row in merged.filter("segment >= 0").select("segment", "counts").toLocalIterator():
        at = row.segment * (SEGMENT // 8)
        bits[at:at + SEGMENT // 8] = np.frombuffer(row.counts, np.uint8)
    return merged.filter("segment < 0").groupBy("lang").agg(F.sum("n").alias("n")), bits


def combined(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows added up. Rows of the same first two words stand together,
    which compresses well in the shuffle. (Rows whose order key collides may
    stay apart; they meet later.)"""
    rest = mix((grams * _PLACES).sum(axis=1, dtype=np.uint64))
    first = grams[:, 0] & np.uint64(0xFFFFFF0000000000) | grams[:, 1] >> np.uint64(24) & np.uint64(0xFFFF000000)
    order = np.argsort(first | rest & np.uint64(0xFFFFFF))
    grams = grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    return grams[starts], np.add.reduceat(counts[order], starts)


def longest_grams(words: Words, frequent) -> np.ndarray:
    """A row for each place with a frequent word: the words from there on, up
    to five, the end of the piece, or a rare word or pair; 0 where there is none."""
    ids = words.ids
    known = frequent(ids)
    on = words.joined.copy()
    on[:-1] &= known[:-1] & known[1:]
    at = np.flatnonzero(on)
    on[at] = frequent(words.pairs()[at])
    padded = np.concatenate([ids, np.zeros(LONGEST, np.uint64)])
    grams = np.zeros((len(ids), LONGEST), np.uint64)
    grams[:, 0] = ids
    going = np.concatenate([on, np.zeros(LONGEST, bool)])
    live = on
    for k in range(1, LONGEST):
        grams[:, k] = np.where(live, padded[k:k + len(ids)], 0)
        live = live & going[k:k + len(ids)]
    return grams[known]


def gram_rows(texts: DataFrame, bits) -> DataFrame:
    """w1..w5, n: the longest gram of every place, added up in the task as far
    as ``HELD_ROWS`` rows go."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed = bits.value
        mask = np.uint64(8 * len(packed) - 1)

        def frequent(keys: np.ndarray) -> np.ndarray:
            slot = keys & mask
            return (packed[(slot >> np.uint64(3)).astype(np.int64)]
                    >> (np.uint64(7) - (slot & np.uint64(7))).astype(np.uint8) & 1).astype(bool)

        held, size, joined = [], 0, 0

        def added_up():
            return combined(np.concatenate([g for g, _ in held]), np.concatenate([n for _, n in held]))

        def rows(grams, n):
            return pd.DataFrame(grams.view(np.int64), columns=_COLS).assign(n=n)

        for lang, part in chunks(batches):
            words = Words(lang, part)
            grams = longest_grams(words, frequent) if len(words.ids) else ()
            if len(grams):
                held.append(combined(grams, np.ones(len(grams), np.int64)))
                size += len(held[-1][0])
            if size > max(HELD_ROWS // 2, 2 * joined):
                held = [added_up()]
                size = joined = len(held[0][0])
                if size > HELD_ROWS:
                    yield rows(*held[0])
                    held, size, joined = [], 0, 0
        if held:
            yield rows(*added_up())

    return texts.mapInPandas(run, ", ".join(f"{c} long" for c in _COLS) + ", n long")


def _flows(least: int):
    """Sorted gram rows to phrase counts: (size, w1..w5, f). The count of a
    phrase is the sum of the rows that begin with it. Those of three words and
    more are whole; of one and two words a partition has a part."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, [0] * LONGEST

        def rows(k: int, grams: np.ndarray, f: np.ndarray) -> pd.DataFrame:
            fine = (grams[:, k] != 0) & ((f >= least) | (k < 2))
            grams = grams[fine].copy()
            grams[:, k + 1:] = 0
            return pd.DataFrame(grams, columns=_COLS).assign(size=k + 1, f=f[fine])

        for batch in batches:
            if not len(batch):
                continue
            grams, n = batch[_COLS].to_numpy(np.int64), batch["n"].to_numpy(np.int64)
            before = np.concatenate([grams[:1] if last is None else last, grams[:-1]])
            differs = np.logical_or.accumulate(grams != before, axis=1)
            out = []
            for k in range(LONGEST):
                starts = np.flatnonzero(differs[:, k])
                if len(starts) == 0:  # the whole batch continues the held phrase
                    held[k] += int(n.sum())
                    continue
                sums = np.add.reduceat(n, starts)
                done = held[k] + int(n[:starts[0]].sum())
                ended = grams[starts[0] - 1:starts[0]] if starts[0] else last
                if ended is not None and done:
                    out.append(rows(k, ended, np.array([done])))
                out.append(rows(k, grams[starts[:-1]], sums[:-1]))
                held[k] = int(sums[-1])
            last = grams[-1:]
            found = pd.concat(out) if out else ()
            if len(found):
                yield found
        if last is not None:
            yield pd.concat([rows(k, last, np.array([held[k]])) for k in range(LONGEST)])
    return run


def phrase_counts(grams: DataFrame, least: int) -> DataFrame:
    """(words, f): every phrase of one to five words that occurs at least
    ``least`` times, words as hash ids."""
    dealt = grams.repartition("w1", "w2", "w3").sortWithinPartitions(*_COLS)
    flows = materialize(dealt.mapInPandas(
        _flows(least), ", ".join(f"{c} long" for c in _COLS) + ", size int, f long"), "flows")
    short = flows.filter("size < 3").groupBy("size", *_COLS).agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return flows.filter("size >= 3").select("size", *_COLS, "f").unionByName(short).select(
        F.slice(F.array(*_COLS), F.lit(1), F.col("size")).alias("words"), "f")


def spelled(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, lang, word) of the words with the wanted ids, read from the texts."""
    wanted = IdFilter(ids, "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        told = set()
        for lang, part in chunks(batches):
            words = Words(lang, part)
            some, at = np.unique(words.ids, return_index=True)
            fine = wanted(some.view(np.int64)) if len(some) else np.zeros(0, bool)
            rows = [(int(i), words.text(a)) for i, a in zip(some[fine].view(np.int64), at[fine])]
            new = [(i, lang, w.decode("utf-8", "surrogatepass")) for i, w in rows if (i, w) not in told]
            told.update(r for r in rows)
            if len(told) > 1_000_000:
                told.clear()
            if new:
                yield pd.DataFrame(new, columns=["id", "lang", "word"])

    found = texts.mapInPandas(run, "id long, lang string, word string").join(ids, "id", "left_semi").distinct()
    return found.groupBy("id").agg(
        F.count("*").alias("spellings"), F.first("lang").alias("lang"), F.first("word").alias("word")).select(
        "id", "lang", F.when(F.col("spellings") > 1, F.raise_error(F.lit("two words share a 64-bit hash")))
        .otherwise(F.col("word")).alias("word"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 top: int = TOP) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).alias("text")).filter("text is not null")
    totals, bits = frequent_slots(texts, max(1, least // RARE))
    shared = spark.sparkContext.broadcast(bits)
    phrases = materialize(phrase_counts(gram_rows(texts, shared), least), "phrases")
    shared.unpersist()
    longer = phrases.filter(F.size("words") > 1)
    inside = longer.filter(F.size("words") > 2).select(
        F.explode(F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))).alias("words"),
        "f").distinct()
    kept = materialize(longer.join(inside, ["words", "f"], "left_anti"), "compacted")

    part = phrases.withColumnRenamed("f", "part_f").withColumnRenamed("words", "part")
    cuts = kept.select("words", "f", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut"))
    cuts = cuts.withColumns({"head": F.expr("slice(words, 1, cut)"), "rest": F.expr("slice(words, cut + 1, size(words))")})
    cuts = cuts.join(part.select(F.col("part").alias("head"), F.col("part_f").alias("l")), "head").join(
        part.select(F.col("part").alias("rest"), F.col("part_f").alias("r")), "rest")

    each = kept.select("words", F.posexplode("words").alias("place", "id"))
    names = materialize(spelled(texts, materialize(each.select("id").distinct(), "word-ids")), "spelled")
    phrase = each.join(names, "id").groupBy("words").agg(
        F.first("lang").alias("lang"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda p: p["word"]), " ").alias("phrase"))

    def exact(col):
        return F.col(col).cast("decimal(19,0)")

    scored = cuts.join(phrase, "words").join(F.broadcast(totals) if totals.count() < 10_000 else totals, "lang")
    scored = scored.withColumn("product", F.lit(1000).cast("decimal(4,0)") * exact("f"))
    scored = scored.select("lang", "phrase", "words", F.col("f").alias("a"), "n", F.struct(
        F.expr("(product * cast(n as decimal(15,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))").alias("score"),
        "cut", "l", "r").alias("cut"))
    lowest = scored.groupBy("lang", "phrase", "words", "a", "n").agg(F.min("cut").alias("cut")).select(
        "lang", "phrase", "words", "a", "n", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = lowest.withColumn("salt", F.pmod(F.xxhash64("words"), F.lit(RANK_SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(
        F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = """
with pieces as (
  select row_number() over () p, lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') w
  from (select coalesce(lang, 'und') lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\\x0A-\\x0D]')) piece from documents)),
totals as (select lang, sum(len(w)) n from pieces group by lang),
grams as (
  select lang, k, w[i:i + k - 1] g
  from pieces, range(1, 6) sizes(k), unnest(range(1, len(w) - k + 2)) places(i)),
f as (select lang, k, g, count(*) a from grams group by lang, k, g having count(*) >= 100),
kept as (
  select * from f c where k > 1 and not exists (
    select 1 from f y where y.lang = c.lang and y.k > c.k and y.a >= c.a and y.k <= 5
      and contains(' ' || array_to_string(y.g, ' ') || ' ', ' ' || array_to_string(c.g, ' ') || ' '))),
cuts as (
  select c.lang, c.g, c.a, x.a l, y.a r, n, i,
         (1000 * c.a::hugeint * n::hugeint) // (x.a::hugeint * y.a::hugeint) score
  from kept c, unnest(range(1, c.k)) cut(i), f x, f y, totals t
  where t.lang = c.lang and x.lang = c.lang and y.lang = c.lang
    and x.g = c.g[1:i] and y.g = c.g[i + 1:]),
lowest as (
  select * from cuts qualify row_number() over (partition by lang, g order by score, i) = 1)
select lang, cast(row_number() over w as bigint) as rank, array_to_string(g, ' ') phrase, a, l, r,
       cast(n as bigint) n, cast(score as bigint) score
from lowest
window w as (partition by lang order by score desc, a desc, array_to_string(g, ' '))
qualify row_number() over w <= 2000
"""
