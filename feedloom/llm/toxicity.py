"""Toxicity from a lexicon that tolerates misspelling, and from the words around each term.

The lexicon is a trie of whole words and of stems (which any ending may follow). A
Levenshtein automaton of each term, run over the trie instead of over one term, accepts the
words within the term's edits; its states are sets of (trie node, edits) and are made as
words reach them. For every word accepted, the window around it tells quotation (marks
that open before and close after it, reporting words) from abuse (words of address). A
logistic curve over the weighted terms gives the score.

Lexicon and curve are learned from a bounded sample of labelled documents. Every text is
scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import labelled_sample, slices, spare

#: Bound of the fit: labelled documents in the order of a hash of their ids.
FIT_DOCUMENTS = 10_000
#: A term enters the lexicon by the likelihood ratio of its two class counts and the share of toxic documents.
LEAST_RATIO = 25.0
LEAST_SHARE = 0.6
MOST_TERMS = 400
CANDIDATES = 50_000
STEMS = (4, 5, 6, 7)
#: Words on either side of a term that decide its reading.
WINDOW = 6
#: Made states and transitions one task keeps; beyond, it starts anew.
MOST_STATES = 20_000

REPORTING = frozenset("said says wrote called calls quoted quote term word sagte schrieb nannte zitat wort dit écrit mot terme citation dijo escribió llamó palabra cita".split())
ADDRESS = frozenset("you your youre du dich dir ihr euch tu toi vous ton tú te usted tus".split())

_WORD = re.compile(r"[^\W\d_]+")
_MARKS = re.compile("[\"“”„«»‘’]")


def edits_for(term: str, stem: bool) -> int:
    """Edits a term tolerates: short terms and stems none, so that ordinary words stay out."""
    size = len(term)
    if stem:
        return 0 if size < 7 else 1
    return 0 if size < 5 else 1 if size < 9 else 2


@dataclass
class Term:
    text: str
    stem: bool
    weight: float


@dataclass
class Lexicon:
    """A trie of terms, and the automaton over it, made state by state."""

    terms: list[Term]
    nodes: list[dict[str, int]] = field(default_factory=lambda: [{}])
    whole: dict[int, int] = field(default_factory=dict)
    stems: dict[int, int] = field(default_factory=dict)
    reach: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self) -> None:
        for k, term in enumerate(self.terms):
            at, edits = 0, edits_for(term.text, term.stem)
            self.reach[0] = max(self.reach[0], edits)
            for c in term.text:
                if c not in self.nodes[at]:
                    self.nodes[at][c] = len(self.nodes)
                    self.nodes.append({})
                    self.reach.append(0)
                at = self.nodes[at][c]
                self.reach[at] = max(self.reach[at], edits)
            (self.stems if term.stem else self.whole)[at] = k
        self._restart()

    def _restart(self) -> None:
        self.sets: list[dict[int, int]] = []
        self.found: list[tuple[int, int] | None] = []
        self.fixed: list[bool] = []
        self.moves: list[dict[str, int]] = []
        self.numbers: dict[tuple, int] = {}
        self.start = self._state({0: 0}, None)

    def _state(self, reached: dict[int, int], stem: tuple[int, int] | None) -> int:
        """The number of a state; ``reached`` maps trie nodes to their fewest edits so far."""
        open_nodes = list(reached)
        while open_nodes:  # letters of a term that the word leaves out
            node = open_nodes.pop()
            for child in self.nodes[node].values():
                e = reached[node] + 1
                if e <= self.reach[child] and e < reached.get(child, 9):
                    reached[child] = e
                    open_nodes.append(child)
        for node, e in reached.items():
            k = self.stems.get(node)
            if k is not None and e <= edits_for(self.terms[k].text, True) and (stem is None or (e, -self.terms[k].weight) < (stem[1], -self.terms[stem[0]].weight)):
                stem = (k, e)
        key = (stem, tuple(sorted(reached.items())))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.sets)
            best = stem
            for node, e in reached.items():
                k = self.whole.get(node)
                if k is not None and e <= edits_for(self.terms[k].text, False) and (best is None or (e, -self.terms[k].weight) < (best[1], -self.terms[best[0]].weight)):
                    best = (k, e)
            self.sets.append(reached)
            self.found.append(best)
            self.fixed.append(stem is not None and stem[1] == 0)
            self.moves.append({})
        return number

    def _step(self, state: int, c: str) -> int:
        reached: dict[int, int] = {}
        for node, e in self.sets[state].items():
            if e < self.reach[node]:  # a letter too many
                reached[node] = min(e + 1, reached.get(node, 9))
            for letter, child in self.nodes[node].items():
                cost = e + (letter != c)
                if cost <= self.reach[child]:
                    reached[child] = min(cost, reached.get(child, 9))
        found = self.found[state]
        stem = found if found is not None and self.terms[found[0]].stem else None
        following = self._state(reached, stem) if reached or stem else -1
        self.moves[state][c] = following
        return following

    def look_up(self, word: str) -> tuple[int, int] | None:
        """The nearest term that accepts ``word`` and its edits; of equally near ones the heavier."""
        if len(self.sets) > MOST_STATES:
            self._restart()
        state, moves = self.start, self.moves
        for c in word:
            following = moves[state].get(c)
            state = self._step(state, c) if following is None else following
            if state < 0:
                return None
            if self.fixed[state]:
                break
        return self.found[state]


def readings(text: str, lexicon: Lexicon, accepted: dict[str, tuple[int, int]]) -> tuple[list[tuple[int, int, float]], int]:
    """Each term in a text as (term, edits, share read as quotation), and the words of the text."""
    words = [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text)]
    out = []
    for i, (word, a, b) in enumerate(words):
        hit = accepted.get(word)
        if hit is None:
            continue
        left, right = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
        around = {w for w, _, _ in words[left:right]}
        opens = len(_MARKS.findall(text, words[left][1], a))
        closes = len(_MARKS.findall(text, b, words[right - 1][2] + 1))
        quoted = 0.8 * (opens % 2 == 1 and closes > 0) + 0.3 * bool(around & REPORTING) - 0.3 * bool(around & ADDRESS)
        out.append((*hit, min(1.0, max(0.0, quoted))))
    return out, len(words)


def features(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    """Per text: weight of exact and of misspelled terms, each by reading, their density, the heaviest, a constant."""
    out = np.zeros((len(texts), 7))
    out[:, 6] = 1
    if not texts or not lexicon.terms:
        return out
    lowered = pc.utf8_lower(pa.array(texts, pa.string()))
    parts = pc.split_pattern_regex(lowered, r"[^\p{L}]+")
    bounds = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    accepted = {w: hit for w in coded.dictionary.to_pylist() if (hit := lexicon.look_up(w))}
    if not accepted:
        return out
    is_hit = pc.is_in(coded.dictionary, value_set=pa.array(list(accepted), pa.string())).to_numpy(zero_copy_only=False)
    counts = np.add.reduceat(is_hit[coded.indices.to_numpy()].astype(np.int64), bounds[:-1] - bounds[0])
    for i in np.flatnonzero(counts):
        hits, n_words = readings(texts[i], lexicon, accepted)
        for k, edits, quoted in hits:
            weight = lexicon.terms[k].weight
            out[i, 2 * (edits > 0)] += weight * (1 - quoted)
            out[i, 2 * (edits > 0) + 1] += weight * quoted
            if not edits:
                out[i, 5] = max(out[i, 5], weight * (1 - quoted))
        out[i, 4] = len(hits) / max(n_words, 1)
    out[:, :4] = np.log1p(out[:, :4])
    out[:, 4] = np.log1p(100 * out[:, 4])
    return out


@dataclass
class ToxicModel:
    lexicon: Lexicon
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(texts, self.lexicon) @ self.weights, -30, 30)))


def fit_curve(rows: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps; the constant is not shrunk."""
    at, shrink = np.zeros(rows.shape[1]), np.full(rows.shape[1], ridge)
    shrink[-1] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(rows @ at, -30, 30)))
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(shrink)
        move = np.linalg.solve(hessian, rows.T @ (labels - p) - shrink * at)
        at = at + move * min(1.0, 4 / max(1e-9, float(np.abs(move).max())))
    return at


def _terms_of(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def choose_terms(counts: Iterable[tuple[str, int, int]], toxic: int, clean: int) -> list[Term]:
    """Terms that mark toxic documents, from (term, toxic documents, clean documents with it).

    Of terms of which one begins with the other the better one stays: by likelihood ratio,
    then whole words before stems, then the longer.
    """
    ranked = []
    for name, t, c in counts:
        share = t / toxic if toxic else 0
        if not t or t / (t + c) < LEAST_SHARE or share <= (c / clean if clean else 0):
            continue
        expected = (t + c) * toxic / (toxic + clean)
        ratio = 2 * (t * math.log(t / expected) + (c * math.log(c / (t + c - expected)) if c else 0))
        if ratio >= LEAST_RATIO:
            ranked.append((ratio, not name.endswith("*"), len(name), name, math.log((t + 0.5) / (c + 0.5) * (clean + 1) / (toxic + 1))))
    chosen: list[Term] = []
    for _, whole, _, name, weight in sorted(ranked, reverse=True):
        text = name.rstrip("*")
        if len(chosen) < MOST_TERMS and not any(text.startswith(c.text) and c.stem or c.text.startswith(text) and not whole or c.text == text for c in chosen):
            chosen.append(Term(text, not whole, max(weight, 0.1)))
    return chosen


def fit(docs: DataFrame, labels: DataFrame, documents: int = FIT_DOCUMENTS) -> ToxicModel:
    """A model learned from the texts of ``docs(doc_id, text)`` that ``labels(doc_id, label)`` marks.

    Takes the ``documents`` labels first in a hash order of their ids. NULL ids, labels and
    texts teach nothing. Without toxic rows the lexicon is empty and every score is the same.
    """
    sample = labelled_sample(docs, labels, documents, "toxic-sample")
    size = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    least = max(2, math.floor(LEAST_RATIO / (2 * math.log(1 + clean / max(toxic, 1)) + 1e-9) * 0.5)) if toxic else 2

    def counted(wanted: frozenset[str] | None, most: int | None = None) -> dict[str, int]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, "text"):
                    found: Counter[str] = Counter()
                    for text in batch.column("text").to_pylist():
                        terms = _terms_of(text)
                        found.update(terms if wanted is None else terms & wanted)
                    yield pa.RecordBatch.from_pydict({"term": list(found), "n": list(found.values())}, schema=pa.schema([("term", pa.string()), ("n", pa.int64())]))

        rows = sample.where(F.col("label") == (1 if wanted is None else 0)).select("text").mapInArrow(run, "term string, n long")
        sums = rows.groupBy("term").agg(F.sum("n").alias("n"))
        if wanted is None:
            sums = sums.where(F.col("n") >= least).orderBy(F.desc("n"), "term").limit(most)
        return {r["term"]: r["n"] for r in sums.collect()}

    in_toxic = counted(None, CANDIDATES) if toxic else {}
    in_clean = counted(frozenset(in_toxic)) if in_toxic else {}
    lexicon = Lexicon(choose_terms([(t, n, in_clean.get(t, 0)) for t, n in in_toxic.items()], toxic, clean))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(lexicon.terms)
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = features(batch.column("text").to_pylist(), own)
                yield pa.RecordBatch.from_arrays([batch.column("o"), batch.column("label"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["o", "label", "x"])

    rows = sorted(sample.mapInArrow(featured, "o long, label int, x binary").collect(), key=lambda r: (r["o"], r["label"], r["x"]))
    if not rows:
        return ToxicModel(lexicon, np.zeros(7))
    return ToxicModel(lexicon, fit_curve(np.stack([np.frombuffer(r["x"]) for r in rows]), np.array([r["label"] for r in rows])))


def score(docs: DataFrame, model: ToxicModel, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the toxicity of each whole text, in 0 to 1.

    NULL text counts as empty, an empty text has no terms. Equal texts score alike; every
    row is kept, an empty table stays empty, and a column already called ``name`` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    (whole_text,) = spare(docs, "whole_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col("text"), F.lit("")).alias(whole_text))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]], f"`{name}` double"])
    terms, weights = model.lexicon.terms, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ToxicModel(Lexicon(terms), weights)
        for whole in batches:
            for batch in slices(whole, whole_text):
                found = own.scores(batch.column(whole_text).to_pylist())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found)], names=[*kept, name])

    return rows.mapInArrow(run, schema)
