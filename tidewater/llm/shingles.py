"""Word and shingle hashes of texts, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]  # A-Z are lower-cased
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_BLANK] = 0
_POWER = np.ones(1 << 16, np.uint64)
_POWER[1:] = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.multiply.accumulate(_POWER)
_FAR = np.ones(1 << 16, np.uint64)
_FAR[1:] = np.uint64(0xD1342543DE82EF95)
_FAR = np.multiply.accumulate(_FAR)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
BATCH_BYTES = 250_000


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs without the six blanks, A-Z lowered)
    of all texts one after another, and how many each text has."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    blank = _BLANK[raw]
    first = ~blank
    first[1:] &= blank[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    at = np.arange(len(raw))
    at -= np.maximum.accumulate(np.where(first, at, 0))
    value = _BYTE[raw] * _POWER[at & 0xFFFF]
    if at.max() > 0xFFFF:
        value *= _FAR[at >> 16]
    words = mix(np.add.reduceat(value, starts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return words, np.diff(np.searchsorted(starts, ends), prepend=0)


def shingle_sets(texts: list[str | None], size: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, ascending. A text of fewer
    words is one shingle as a whole; none without words."""
    i = 0
    while i < len(texts):
        j, total, encoded = i, 0, []
        while j < len(texts) and (j == i or total < BATCH_BYTES):
            encoded.append((texts[j] or "").encode("utf-8", "surrogatepass"))
            total += len(encoded[-1])
            j += 1
        words, counts = word_hashes(encoded)
        n = len(words)
        rows = np.zeros(n, np.uint64)
        for k in range(min(size, n)):
            rows[:n - k] += words[k:] * _PLACE[k]
        rows = mix(rows)
        at = 0
        for count in counts:
            if count >= size:
                yield np.unique(rows[at:at + count - size + 1])
            elif count:
                whole = (words[at:at + count] * _PLACE[8:8 + count]).sum(dtype=np.uint64, keepdims=True)
                yield mix(whole + _PLACE[20 + count:21 + count])
            else:
                yield np.zeros(0, np.uint64)
            at += count
        i = j
