"""Spelling variants of a corpus's words, found through an index of variable-length grams.

1. Words are counted over all texts (combined in each task, then by word).
2. A gram dictionary is built from the vocabulary level by level: grams of two letters, then, for every gram more
   frequent than a bound, those one letter longer. Only frequent grams are kept, with their counts: a gram is
   extended exactly as long as it is frequent. The bound grows with the vocabulary, so the dictionary never has more than
   GRAMS entries a level and can be broadcast.
3. A word, with marks at both ends, is decomposed: from each place the gram that the dictionary gives, unless the gram before
   covers it. Whether a gram is in a decomposition depends on ``cap`` places up to its end, no others, so one edit affects at
   most the grams that end within ``cap`` places of each other; the greatest number of them is the word's own bound.
4. Two words one edit apart share all but the affected grams of each. Merging inverted lists for that many, the longest
   lists can be set aside: the rarest ``bound + 1`` grams of both words hold a shared one. Lists are keyed by gram, place and
   length, and words meet by an equi-join on them.
5. Each pair that meets is verified by its edit distance.

``cap`` is half the marked length of the shorter word, so a decomposition always has a gram that no single edit reaches: no pair is missed.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import slices, stored
from feedloom.llm.shingles import span_hashes

TEXT_BYTES = 2 << 20
#: Words a task counts before it passes the counts on.
HELD_WORDS = 200_000
#: Shortest word, in code points.
LEAST = 6
#: Fewest occurrences of a word.
OFTEN = 5
#: A form occurs at least so many times as often as its variant.
FACTOR = 5
SHORTEST_GRAM = 2
LONGEST_GRAM = 8
#: Frequent grams of one length, at most.
GRAMS = 20_000
#: Up to this many words a gram counts as rare.
RARE = 8

COUNTS = "word string, n long"
TOKENS = "key long, role int, word string, n long"
#: Roles of a token: of words of equal length, of the shorter and of the longer word.
EQUAL, SHORTER, LONGER = 0, 1, 2


def _zero_bytes(longest: int) -> np.ndarray:
    """Tables that carry a crc32 over 0 to ``longest`` further bytes, a byte of the checksum at a time."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    tables = np.empty((longest + 1, 4, 256), dtype=np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for k in range(longest):
        tables[k + 1] = (tables[k] >> 8) ^ step[tables[k] & 0xFF]
    return tables


#: Runs of more bytes are summed one by one.
_CARRIED = 64
_TABLES = _zero_bytes(_CARRIED)


def joined_crc32(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of two byte strings in a row from their own crc32 and the second's length, up to _CARRIED."""
    out = second.copy()
    for k in range(4):
        out ^= _TABLES[lengths, k, (first >> np.uint32(8 * k)) & np.uint32(0xFF)]
    return out


def runs_of_letters(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in a row with A-Z lower-cased, the starts and ends of runs of letters there, and each run's text.

    Letters are A-Z, a-z and U+00C0 to U+00FF, whose UTF-8 is C3 and one more byte.
    """
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    upper = (raw >= 0x41) & (raw <= 0x5A)
    low = raw + upper.astype(np.uint8) * np.uint8(32)
    inside = ((low >= 0x61) & (low <= 0x7A)) | (raw == 0xC3)
    inside[1:] |= raw[:-1] == 0xC3
    edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    firsts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return low, starts, ends, np.searchsorted(firsts, starts, side="right") - 1


def counted(texts: list[bytes], ids: list[int | None], least: int, slips: int | None) -> Counter:
    """Words of at least ``least`` code points and their occurrences; see ``vocabulary`` for ``slips``."""
    low, starts, ends, text = runs_of_letters(texts)
    if not len(starts):
        return Counter()
    lengths = ends - starts
    _, at, which = np.unique(span_hashes(low, starts, ends), return_index=True, return_inverse=True)
    words = [low[a:z].tobytes() for a, z in zip(starts[at].tolist(), ends[at].tolist())]
    times, found = np.bincount(which, minlength=len(words)), Counter()
    if slips:
        named = np.array([i is not None for i in ids])
        own = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], dtype=np.uint32)
        sums = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
        crc = joined_crc32(own[text], sums[which], np.minimum(lengths, _CARRIED))
        for k in np.flatnonzero(lengths > _CARRIED).tolist():
            crc[k] = zlib.crc32(words[which[k]], int(own[text[k]]))
        slipped = np.flatnonzero((crc % np.uint32(slips) == 0) & named[text])
        times -= np.bincount(which[slipped], minlength=len(words))
        for k in slipped.tolist():
            word = words[which[k]].decode()
            gone = int(crc[k]) % len(word)
            word = word[:gone] + word[gone + 1 :]
            if len(word) >= least:
                found[word] += 1
    for word, n in zip(words, times.tolist()):
        if n and len(word) >= least and len(word := word.decode()) >= least:
            found[word] += n
    return found


def _batch(counts: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame, least: int = LEAST, often: int = OFTEN, slips: int | None = None) -> DataFrame:
    """(word, n): the words of ``docs(doc_id, text)`` that have ``least`` code points and occur ``often`` times.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF; only A-Z is lower-cased. With ``slips`` = s a run whose crc32, taken
    with its document's id as ``<doc_id>:<run>``, s divides loses the code point of that crc32 modulo its length: planted typing slips, 1 in s.

    NULL and empty texts have no words; rows that repeat count each time; a row without doc_id has no slips. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for whole in batches:
            for batch in slices(whole, "bytes", TEXT_BYTES):
                held.update(counted(batch.column("bytes").to_pylist(), batch.column("doc_id").to_pylist(), least, slips))
                if len(held) >= HELD_WORDS:
                    yield _batch(held)
                    held = Counter()
        if held:
            yield _batch(held)

    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes"))
    counts = rows.mapInArrow(run, COUNTS)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def marked(word: str) -> str:
    return f"^{word}$"


def cap_of(length: int) -> int:
    """Longest gram for words of ``length`` and ``length + 1`` code points."""
    return max(SHORTEST_GRAM, min(LONGEST_GRAM, (length + 2) // 2))


def decompose(word: str, cap: int, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """The variable grams of a word as (place, gram), ends ascending."""
    s, grams, reach = marked(word), [], 0
    for i in range(len(s) - 1):
        j = i + SHORTEST_GRAM
        while j - i < cap and j < len(s) and s[i:j] in frequent:
            j += 1
        if j > reach:
            grams.append((i, s[i:j]))
            reach = j
    return grams


def affected(grams: list[tuple[int, str]], cap: int) -> int:
    """The most grams that one inserted, deleted or replaced code point can affect."""
    ends = [i + len(g) for i, g in grams]
    most, a = 0, 0
    for z, end in enumerate(ends):
        while end - ends[a] >= cap:
            a += 1
        most = max(most, z - a + 1)
    return most


def rarest(word: str, cap: int, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """The grams of which a word one edit away must share one: all but the longest lists that may be set aside."""
    grams = decompose(word, cap, frequent)
    return sorted(grams, key=lambda g: (frequent.get(g[1], 0), g[1], g[0]))[: affected(grams, cap) + 1]


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The dictionary of a stored table of words: grams of more than RARE words, or more where it would outgrow GRAMS a level, with counts.

    A gram is counted only if the one a letter shorter is in the dictionary.
    """
    spark = words.sparkSession
    places = words.agg(F.sum(F.length("word") + 1).alias("places")).first()["places"] or 0
    bound = max(RARE, -(-places // GRAMS))
    found: dict[str, int] = {}
    for q in range(SHORTEST_GRAM, LONGEST_GRAM + 1):
        sent = spark.sparkContext.broadcast({g for g in found if len(g) == q - 1})

        def run(batches: Iterator[pa.RecordBatch], q: int = q, sent=sent) -> Iterator[pa.RecordBatch]:
            shorter, held = sent.value, Counter()
            for batch in batches:
                for word in batch.column("word").to_pylist():
                    s = marked(word)
                    held.update(s[i : i + q] for i in range(len(s) - q + 1) if q == SHORTEST_GRAM or s[i : i + q - 1] in shorter)
                if len(held) >= HELD_WORDS:
                    yield _batch(held)
                    held = Counter()
            yield _batch(held)

        level = words.select("word").mapInArrow(run, COUNTS).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > bound).collect()
        if not level:
            break
        found.update((r["word"], r["n"]) for r in level)
    return found


def _tokens(frequent, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def key(kind: int, length: int, place: int, gram: str) -> int:
        return xxhash.xxh3_64_intdigest(f"{kind} {length} {place} {gram}") - (1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = frequent.value
        for batch in batches:
            keys, roles, of = [], [], []
            for w, word in enumerate(batch.column("word").to_pylist()):
                n = len(word)
                for i, g in rarest(word, cap_of(n), grams):
                    keys += [key(0, n, i, g), key(1, n, i, g), key(1, n, i + 1, g)]
                    roles += [EQUAL, SHORTER, SHORTER]
                if n > least:
                    longer = rarest(word, cap_of(n - 1), grams)
                    keys += [key(1, n - 1, i, g) for i, g in longer]
                    roles += [LONGER] * len(longer)
                of += [w] * (len(keys) - len(of))
            take = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(roles, pa.int32()), batch.column("word").take(take), batch.column("n").take(take)], names=["key", "role", "word", "n"])

    return run


def near_words(words: DataFrame, least: int = LEAST) -> DataFrame:
    """(a, a_n, b, b_n) for every two words of a stored ``words(word, n)`` that are one edit apart, once; each has ``least`` code points, 2 at least."""
    if least < 2:
        raise ValueError("words of one code point may share no gram with their near words")
    sent = words.sparkSession.sparkContext.broadcast(frequent_grams(words))
    tokens = stored(words.mapInArrow(_tokens(sent, least), TOKENS), "gram-tokens", 10_000)
    left = tokens.where(F.col("role") != LONGER).select("key", F.col("role").alias("a_role"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = tokens.where(F.col("role") != SHORTER).select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    once = (F.col("a_role") == SHORTER) | (F.col("a") < F.col("b"))
    return left.join(right, (left["key"] == right["key"]) & once & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n").distinct()


def group_variants(words: DataFrame, least: int = LEAST, factor: int = FACTOR) -> DataFrame:
    """``words(word, n)``, each word once, with n_near, form, form_n and root.

    * n_near: how many words are exactly one inserted, deleted or replaced code point away;
    * form, form_n: of these the one of the largest n (the least in code-point order of several), if that is at least ``factor`` times the word's; else NULL;
    * root: where the forms of forms end; the word itself without a form. Counts grow along forms, so there is an end.

    An empty table gives an empty one.
    """
    words = stored(words.select("word", "n"), "variant-words", 10_000)
    near = stored(near_words(words, least), "variant-pairs", 10_000)
    both = near.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(near.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    found = words.join(best, "word", "left").withColumn("f", F.when(-F.col("best.m") >= factor * F.col("n"), F.col("best")))
    found = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("f.near").alias("form"), (-F.col("f.m")).alias("form_n")), "variant-forms", 10_000)

    roots = found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots", 10_000)
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
