"""Token ids of whole texts, by a tokenizer file of the ``tokenizers`` library.

The library's byte-pair model is asked once for each distinct word; the words of a batch
of texts are then looked up together. A byte-level model never joins bytes across a word border, and a space
followed by a non-space always opens a new word, so the ids are those of the whole text.
A text that holds a special token's string goes to the library whole.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: The word pattern and the byte alphabet of the byte-level vocabulary.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = (*range(33, 127), *range(161, 173), *range(174, 256))

#: Entries of the two look-up tables of one Python worker; a full table keeps what was asked for last.
CACHE_PIECES = 300_000
CACHE_WORDS = 150_000
#: Ids that the table of pieces holds at most for each of its entries, and bytes of a piece that outlasts a full table.
PIECE_IDS = 16
PIECE_BYTES = 64
#: Bytes of texts that share their look-ups: pieces that occur once in it are dear, and larger texts repeat more of theirs.
TEXT_BYTES = 4 << 20
#: Pieces that are learned at once, so that temporaries stay small.
LEARNED = 50_000

_OPENING = re.compile(r"(?= \S)")
_CODERS: dict[str, "Coder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    spare = (b for b in range(256) if b not in PRINTABLE)
    return {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(spare)}


class Coder:
    """Ids of texts, with tables that a Python worker keeps from task to task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        before = described["pre_tokenizer"] or {}
        self.whole = Tokenizer.from_file(path)
        self.by_word = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not described["normalizer"]
        specials = [re.escape(t["content"]) for t in described["added_tokens"]]
        self.special = re.compile("|".join(specials)) if specials else None
        self.letters = byte_letters()
        self.words = regex.compile(WORD)
        self.model = self.whole.model
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.batches = 0
        #: Pieces seen, and of each where its ids begin in ``flat``, how many they are, whether it opens with a space or is empty, and when it was last asked for.
        self.pieces = pa.array([], pa.string())
        self.flat = np.empty(0, dtype="<u4")
        self.starts, self.sizes, self.odd, self.asked = (np.empty(0, dtype=t) for t in (np.int64, np.int32, bool, np.int32))

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                spelled = "\u0120" + word[1:] if word[0] == " " and word.isascii() and word[1:].isalpha() else word.encode().decode("latin-1").translate(self.letters)
                ids = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
            if len(self.known) >= CACHE_WORDS // 2:
                self.known, self.older = {}, self.known
            self.known[word] = ids
        return ids

    def _opened(self, piece: str) -> bytes:
        """The ids of a text without special tokens that keeps together what a word may span."""
        return b"".join(map(self._word, self.words.findall(piece)))

    def _split(self, pieces: list[str]) -> tuple[list[bool], np.ndarray, bytes]:
        """Of pieces: which are odd, how many ids each other has, and those ids. The others are one text, each behind a space that opens a word."""
        odd = [not p or p[0].isspace() for p in pieces]
        sizes = np.zeros(len(pieces), dtype=np.int32)
        if all(odd):
            return odd, sizes, b""
        words = self.words.findall(" " + " ".join([p for p, o in zip(pieces, odd) if not o]))
        blobs = [self.known.get(w) or self._word(w) for w in words]
        opens = np.flatnonzero(np.fromiter((w[0] == " " for w in words), dtype=bool, count=len(words)))
        sizes[~np.array(odd)] = np.add.reduceat(np.fromiter(map(len, blobs), dtype=np.int32, count=len(blobs)) // 4, opens)
        return odd, sizes, b"".join(blobs)

    def _learn(self, new: pa.Array) -> None:
        """Add pieces to the table."""
        odd, sizes, blobs = zip(*(self._split(new.slice(a, LEARNED).to_pylist()) for a in range(0, len(new), LEARNED)))
        flat, size = np.frombuffer(b"".join(blobs), dtype="<u4"), np.concatenate(sizes)
        self.pieces = pa.concat_arrays([self.pieces, new])
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(size, dtype=np.int64) - size])
        self.flat, self.sizes, self.odd = (np.concatenate(both) for both in ((self.flat, flat), (self.sizes, size), (self.odd, np.concatenate(odd))))
        self.asked = np.concatenate([self.asked, np.full(len(new), self.batches, dtype=np.int32)])

    def _found(self, pieces: pa.Array) -> np.ndarray:
        """Where distinct pieces stand in the table, all of them after this."""
        if len(self.pieces) > CACHE_PIECES or len(self.flat) > PIECE_IDS * CACHE_PIECES:
            self._trim()
        self.batches += 1
        at = pc.index_in(pieces, value_set=self.pieces)
        known = len(self.pieces)
        missing = at.is_null()
        if at.null_count:
            self._learn(pieces.filter(missing))
        at = at.fill_null(0).to_numpy().copy()
        at[missing.to_numpy(zero_copy_only=False)] = known + np.arange(len(self.pieces) - known)
        self.asked[at] = self.batches
        return at

    def _trim(self) -> None:
        """Keep the half that was asked for last, without long pieces."""
        order = np.argsort(-self.asked, kind="stable")[: CACHE_PIECES // 2]
        keep = np.sort(order[pc.binary_length(self.pieces).to_numpy()[order] <= PIECE_BYTES])
        self.pieces, sizes = self.pieces.take(pa.array(keep)), self.sizes[keep]
        self.flat = self.flat[_runs(self.starts[keep], sizes)]
        self.starts, self.sizes, self.odd, self.asked = np.cumsum(sizes, dtype=np.int64) - sizes, sizes, self.odd[keep], self.asked[keep]

    def _alone(self, text: str) -> bytes:
        if self.by_word and not (self.special and self.special.search(text)):
            return b"".join(map(self._opened, _OPENING.split(text)))
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (unsigned, 32 bits), and how many each text has.

        No special tokens are put around a text. NULL counts as empty.
        """
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not len(texts):
            return np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64)
        parts = pc.split_pattern(texts, " ")
        bounds = parts.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        coded = parts.flatten().dictionary_encode()
        at = self._found(coded.dictionary)[coded.indices.to_numpy()]
        first = bounds[:-1]
        inner = self.odd[at]
        inner[first] = False
        alone = np.logical_or.reduceat(inner, first) | (not self.by_word)
        if self.special:
            alone |= pc.match_substring_regex(texts, self.special.pattern).to_numpy(zero_copy_only=False)
        opening = coded.dictionary.take(coded.indices.take(pa.array(first))).to_pylist()
        blobs = [self._alone(texts[i].as_py()) if by_itself else self._opened(word) for i, (word, by_itself) in enumerate(zip(opening, alone.tolist()))]
        own = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // 4
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(blobs), dtype="<u4")])
        starts, taken = self.starts[at], self.sizes[at]
        taken[np.repeat(alone, np.diff(bounds))] = 0
        starts[first], taken[first] = len(self.flat) + np.cumsum(own) - own, own
        return flat[_runs(starts, taken)], np.add.reduceat(taken, first, dtype=np.int64)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``, one run after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + int(starts.max(initial=0)) < 1 << 31 else np.int64
    places = np.repeat((starts - (ends - sizes)).astype(kind), sizes)
    places += np.arange(total, dtype=kind)
    return places


def coder(path: str) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]
