"""Removal of repeated byte strings by distributed prefix doubling.

Every byte covered by a string of ``length`` bytes that also starts earlier
(in a document of smaller id, or earlier in the same one) is removed.

Suffixes are ranked by ever longer prefixes: positions are sorted by the pair
(rank of the first half, rank at the offset of the half), positions whose pair
is unique leave, the others get a new rank; this ends at the threshold. Two
steps before the first sort keep positions out that need no ranking:

* Windows that share their least hashed k-gram (their anchor) form a cell, of
  about forty windows. Cells are compared by anchor: one row per cell is
  shuffled, not one per position. An anchor that occurs in one cell only proves
  all windows of that cell unique; cells with equal content (all bytes of all
  their windows) are equal window by window, so all but the earliest are
  repeats as a whole.
* What is left, the earliest cells of different content around one anchor, is
  compared again in runs of at most ``RUN`` windows at the same distance from
  the anchor, by the bytes that all windows of such a run have in common. Only
  runs that share those but differ elsewhere, at the edges of repeated
  passages, go on to the doubling, position by position.

Equal strings are told by 64-bit hashes of each half (128 bits together).

Defined results: a null text has no bytes; repeated rows come one after
another, so the second is removed wherever it has ``length`` bytes; null ids
come first; rows of one id are ordered as they are read; an empty table gives
an empty one; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import IdFilter, located, table, xxhash64
from tidewater.llm.shingles import mix
from tidewater.session import materialize

LENGTH = 100
GRAM = 24
RUN = 8
CHUNK = 1 << 18
_rng = np.random.default_rng(7)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWER = np.ones(2 * CHUNK + 1, np.uint64)
_POWER[1:] = np.uint64(_BASE)
_POWER = np.multiply.accumulate(_POWER)
_BACK = np.ones(2 * CHUNK + 1, np.uint64)
_BACK[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
_BACK = np.multiply.accumulate(_BACK)


class Chunk:
    """Some bytes with hashes of any of their substrings."""

    def __init__(self, raw: np.ndarray):
        self.size = len(raw)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * _POWER[:len(raw)], out=self.sums[1:])

    def hashes(self, start: np.ndarray | slice, length) -> np.ndarray:
        at = np.arange(self.size - length + 1) if isinstance(start, slice) else start
        return mix((self.sums[at + length] - self.sums[at]) * _BACK[at])

    def cells(self, starts: np.ndarray, length: int, gram: int):
        """(start, windows, anchor position, anchor hash) of the cells;
        ``starts`` are where documents begin. No window crosses into another
        document."""
        none = np.zeros(0, np.int64)
        if self.size < length:
            return none, none, none, none
        key = self.hashes(slice(None), gram)
        low = key >> np.uint64(24) << np.uint64(24) | np.arange(len(key), dtype=np.uint64)
        span, width = length - gram + 1, 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
        anchor = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        doc = np.zeros(self.size, np.int64)
        doc[starts[1:]] = 1
        doc = np.cumsum(doc)
        inside = doc[:len(anchor)] == doc[length - 1:length - 1 + len(anchor)]
        at = np.flatnonzero(inside)
        if not len(at):
            return none, none, none, none
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(anchor[at]) != 0)
        first = np.flatnonzero(new)
        return at[first], np.diff(first, append=len(at)), anchor[at[first]], key[anchor[at[first]]].view(np.int64)


def chunks(texts: list[str | None], length: int) -> Iterator[tuple[Chunk, np.ndarray, np.ndarray, np.ndarray]]:
    """The texts' bytes in pieces of bounded size: a chunk, where documents
    start in it, which they are, and at what byte of theirs. Long documents
    span chunks that overlap by all but one byte of a window."""
    parts: list[tuple[int, int, bytes]] = []
    size = 0

    def made():
        starts = np.cumsum([0, *(len(p[2]) for p in parts[:-1])])
        return (Chunk(np.frombuffer(b"".join(p[2] for p in parts), np.uint8)), starts,
                np.array([p[0] for p in parts]), np.array([p[1] for p in parts]))

    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        at = 0
        while len(raw) - at >= length:
            piece = raw[at:at + CHUNK]
            if parts and size + len(piece) > CHUNK:
                yield made()
                parts, size = [], 0
            parts.append((i, at, piece))
            size += len(piece)
            at += CHUNK - length + 1
    if parts:
        yield made()


FOUND = "doc_id long, row_no long, start long, windows int, anchor long, content long"


def _cells(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per cell, with the hashes of its anchor and its content."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, starts, docs, offsets in chunks(list(batch["text"]), length):
                at, n, _, anchor = chunk.cells(starts, length, gram)
                part = np.searchsorted(starts, at, "right") - 1
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].array[docs[part]], "row_no": batch["row_no"].to_numpy()[docs[part]],
                    "start": at - starts[part] + offsets[part], "windows": n.astype(np.int32), "anchor": anchor,
                    "content": chunk.hashes(at, length - 1 + n).view(np.int64)})

    return rows.mapInPandas(run, FOUND)


def _key(cells: DataFrame) -> DataFrame:
    return cells.select(F.xxhash64("doc_id", "row_no", "start").alias("cell"))


def _finer(rows: DataFrame, length: int, gram: int, cells: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """The runs of the given cells or, with ``runs``, the positions of these
    with the ranks of their four quarters. Both are found again from the texts
    by filters that let a few more through than asked for: that adds
    comparisons of true positions, never a wrong result."""
    in_cells = IdFilter(_key(cells), "cell")
    in_runs = IdFilter(_key(runs), "cell") if runs is not None else None
    quarter = length // 4

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["doc_id"].fillna(0).to_numpy(np.int64)
            numbers = batch["row_no"].to_numpy()
            # Spark leaves the seed as it is for a null column
            seeds = xxhash64(numbers, np.where(batch["doc_id"].isna(), np.uint64(42), xxhash64(ids)))
            for chunk, starts, docs, offsets in chunks(list(batch["text"]), length):
                at, n, anchor, _ = chunk.cells(starts, length, gram)
                part = np.searchsorted(starts, at, "right") - 1
                doc, shift = docs[part], offsets[part] - starts[part]
                keep = np.flatnonzero(in_cells(xxhash64(at + shift, seeds[doc]).view(np.int64)))
                if not len(keep):
                    continue
                # from cells to runs of equal distance from the anchor
                cell = np.repeat(keep, n[keep])
                pos = np.repeat(at[keep] - np.cumsum(n[keep]) + n[keep], n[keep]) + np.arange(len(cell))
                band = (anchor[cell] - pos) // RUN
                new = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (band[1:] != band[:-1])]))
                size, cell, band, first = np.diff(new, append=len(cell)), cell[new], band[new], pos[new]
                doc, shift = doc[cell], shift[cell]
                if in_runs is None:
                    core = chunk.hashes(anchor[cell] - RUN * band, length - RUN + 1)
                    yield pd.DataFrame({
                        "doc_id": batch["doc_id"].array[doc], "row_no": numbers[doc], "start": first + shift,
                        "windows": size.astype(np.int32), "anchor": mix(core + band.astype(np.uint64)).view(np.int64),
                        "content": chunk.hashes(first, length - 1 + size).view(np.int64)})
                    continue
                keep = in_runs(xxhash64(first + shift, seeds[doc]).view(np.int64))
                first, size, doc, shift = first[keep], size[keep], doc[keep], shift[keep]
                pos = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
                doc, shift = np.repeat(doc, size), np.repeat(shift, size)
                yield pd.DataFrame({"doc_id": batch["doc_id"].array[doc], "row_no": numbers[doc], "start": pos + shift}
                                   | {f"r{i}": chunk.hashes(pos + i * quarter, quarter).view(np.int64) for i in range(4)})

    schema = FOUND if runs is None else "doc_id long, row_no long, start long, " + ", ".join(f"r{i} long" for i in range(4))
    return rows.mapInPandas(run, schema)


def _compared(found: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Of cells or runs: those that repeat an earlier one as a whole, and the
    earliest ones that share their anchor with others of different content."""
    place = F.struct("doc_id", "row_no", "start")
    anchor = Window.partitionBy("anchor")
    # one shuffle by anchor serves both windows
    found = (found.repartition("anchor")
             .withColumn("first", F.min(place).over(Window.partitionBy("anchor", "content")))
             .withColumn("low", F.min("content").over(anchor)).withColumn("high", F.max("content").over(anchor))
             .select("doc_id", "row_no", "start", "windows", (place == F.col("first")).alias("is_first"),
                     (F.col("low") != F.col("high")).alias("open"))
             .filter("not is_first or open"))
    found = materialize(found, name)
    return found.filter("not is_first"), found.filter("is_first and open")


def prefix_doubling(positions: DataFrame, ranks: list[str]) -> DataFrame:
    """Positions with ranks of consecutive stretches of equal length, doubled
    until one rank covers all: (doc_id, row_no, start) of the positions whose
    string also starts earlier. Each round sorts positions by their rank pairs
    in Spark; those with a pair of their own are unique and leave."""
    while len(ranks) > 1:
        pair = Window.partitionBy(*ranks[:2])
        stay = positions.withColumn("_n", F.count("*").over(pair)).filter("_n > 1")
        halves = [F.xxhash64(a, b).alias(f"{a}{b}") for a, b in zip(ranks[::2], ranks[1::2])]
        if len(ranks) == 2:  # the pair is the whole string: no new name needed
            first = F.min(F.struct("doc_id", "row_no", "start")).over(pair)
            return stay.withColumn("_first", first).filter(
                F.struct("doc_id", "row_no", "start") != F.col("_first")).select("doc_id", "row_no", "start")
        positions = stay.select("doc_id", "row_no", "start", *halves)
        ranks = [f"{a}{b}" for a, b in zip(ranks[::2], ranks[1::2])]
    raise ValueError("at least two ranks are needed")


def repeated_ranges(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, row_no, ranges): byte ranges covered by repeated strings."""
    if length % 4:
        raise ValueError("length must be a multiple of four")
    cells, open_cells = _compared(_cells(rows, length, gram), "repeat-cells")
    runs, open_runs = _compared(_finer(rows, length, gram, open_cells), "repeat-runs")
    end = F.col("start") + F.col("windows") - 1 + length
    whole = cells.union(runs).select("doc_id", "row_no", F.struct("start", end.alias("end")).alias("range"))
    single = prefix_doubling(_finer(rows, length, gram, open_cells, open_runs), [f"r{i}" for i in range(4)]).select(
        "doc_id", "row_no", F.struct("start", (F.col("start") + length).alias("end")).alias("range"))
    return whole.union(single).groupBy("doc_id", "row_no").agg(F.collect_list("range").alias("ranges"))


def _cut(raw: bytes, ranges) -> tuple[bytes, int]:
    """The bytes outside the ranges, and how many maximal runs went."""
    kept, runs, done = [], 0, 0
    for start, end in sorted((r["start"], r["end"]) for r in ranges):
        if start > done or not runs:
            kept.append(raw[done:start])
            runs += 1
        done = max(done, end)
    return b"".join([*kept, raw[done:]]), runs


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 gram: int = GRAM, with_bytes: bool = True) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked
    for, the remaining bytes (a cut may fall inside a character)."""
    rows = located(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    ranges = repeated_ranges(rows, length, gram).withColumnsRenamed({"doc_id": "_doc", "row_no": "_row"})
    joined = rows.join(ranges, rows["doc_id"].eqNullSafe(ranges["_doc"]) & (rows["row_no"] == ranges["_row"]), "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch["text"], batch["ranges"]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                kept, runs = _cut(raw, ranges) if ranges is not None else (raw, 0)
                row = (len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if with_bytes else row)
            made = pd.DataFrame(out, columns=names[1:])
            made.insert(0, "doc_id", batch["doc_id"].array)
            yield made

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    names = [part.split()[0] for part in schema.split(", ")]
    return joined.select("doc_id", "text", "ranges").mapInPandas(run, schema)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"), with_bytes=False)


def brute_force(docs: list[tuple], length: int = LENGTH) -> dict:
    """Every string of every document in a set, in order (for small data)."""
    seen: set[bytes] = set()
    out = {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - length + 1):
            s = raw[at:at + length]
            if s in seen:
                gone[at:at + length] = True
            seen.add(s)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        runs = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        out[doc_id] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out
