"""Word shingles of whole texts as 64-bit hashes, computed on bytes without a loop over words.

Words are runs of bytes other than ASCII white space, lower-cased in A-Z only. A shingle is
five words in a row; a shorter text is one shingle of all its words. Equal hashes count as
equal shingles: for 10^9 different ones, a clash anywhere has a chance of about 3 %, and it
could matter only between texts within one shingle of the threshold.
"""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5

_RNG = np.random.default_rng(20_240_607)
_LETTER = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SHORT = np.uint64(0xA0761D6478BD642F)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end) of an array of bytes; equal bytes, equal hashes."""
    power = np.multiply.accumulate(np.full(len(raw), _BASE, dtype=np.uint64))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_LETTER[raw] * power)])
    back = np.multiply.accumulate(np.full(len(raw), _BASE_INVERSE, dtype=np.uint64))
    return mixed((total[ends] - total[starts]) * back[starts])


def word_hashes(texts: list[bytes], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in a row, and the words of each text; ``fold`` lower-cases A-Z first."""
    joined = b" ".join(t.lower() if fold else t for t in texts)
    raw = np.frombuffer(joined, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    inside = np.concatenate([[False], ~_SPACE[raw], [False]])
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    words = span_hashes(raw, starts, ends)
    firsts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return words, np.diff(np.searchsorted(starts, firsts))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Per text its distinct shingle hashes in ascending order; empty without words."""
    hashes, counts = word_hashes(texts)
    n = len(hashes)
    rolled = np.zeros(max(0, n - words + 1), dtype=np.uint64)
    for k in range(words):
        rolled = rolled * _STEP + hashes[k : k + len(rolled)]
    rolled = mixed(rolled)
    out, at = [], 0
    for count in counts.tolist():
        if count >= words:
            out.append(np.unique(rolled[at : at + count - words + 1]))
        elif count:
            whole = _SHORT + np.uint64(count)
            with np.errstate(over="ignore"):
                for h in hashes[at : at + count]:
                    whole = whole * _STEP + h
            out.append(mixed(np.array([whole], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
        at += count
    return out


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)
