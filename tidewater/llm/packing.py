"""Power-of-two packing: no sequence crosses a document.

Each document's tokens (and an end id) are cut into as many pieces of
``MAX_LENGTH`` as fit and then into the binary digits of what is left, longest
first. A piece is a whole sequence of a power-of-two length, so there is no
padding, and training draws batches from buckets of equal length.

Tokenising: the vocabulary and special tokens of the tokenizers file are run
by tiktoken, which gives the same ids (a byte-level file's ids are its merge
order; a test compares whole tables) in about a quarter of the time.

``sequence_id`` packs (bucket, task, number in task): unique and free of any
shuffle. Defined results: null and empty texts have the end id only (one piece
of length 1); repeated rows are packed again, each under sequence ids of its
own; null ids are kept; an empty table gives an empty one; extra columns are
ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import table

MAX_LENGTH = 2048
END_ID = 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load_encoding(path: str):
    """A byte-level BPE file of the tokenizers library as a tiktoken encoding.
    Such files write each byte as a printable character: visible Latin-1
    characters stand for themselves, the other bytes follow from 256 on."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(visible))
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=special)

# Ids that a task gathers before it sends rows on (2 MB as 32-bit numbers).
HELD_IDS = 500_000


def binary_cuts(n: int, longest: int = MAX_LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens, longest first."""
    cuts, at, size = [], 0, longest
    while at < n:
        while size > n - at:
            size >>= 1
        cuts.append((at, size))
        at += size
    return cuts


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         max_length: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if asked for, the ids themselves."""
    if max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    path = tokenizer or default_tokenizer()
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + (", ids array<int>" if with_ids else ""))
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = load_encoding(path)
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, size = [], 0
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = encoding.encode_to_numpy(text or "", allowed_special="all")
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for start, length in binary_cuts(len(ids), max_length):
                    piece = ids[start:start + length]
                    number = (length.bit_length() - 1) << 58 | task << 34 | made
                    made += 1
                    row = (doc, start, length, zlib.crc32(piece.tobytes()), len(ids), number, 0)
                    rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                size += len(ids) if with_ids else 0
                if len(rows) > 20_000 or size > HELD_IDS:
                    yield pd.DataFrame(rows, columns=names)
                    rows, size = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return docs.selectExpr(f"`{id_col}` doc_id", f"`{text_col}` text").mapInPandas(run, schema)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
