"""Benchmark items found in texts, also with other numbers, names and units.

Texts and items become sequences of symbols: words in lower case without outer punctuation, and
typed placeholders for numbers, for units behind numbers and, on a second level, for runs of names.
Windows of symbols are hashed, the windows of texts that may occur in an item are joined with those
of the items by hash. A window that is mostly slots says little without their values, so its hash
takes them in: it meets verbatim copies alone. A window whose slots hold the item's own values counts as it is; of the others on one diagonal
(text position less item position) the most that agree count: each value of the item stands for one value of
the text. A name that stands for two others makes another story, and none of the diagonal's others
count. An item leaks into a text when enough of its windows count: of all, or of those that are mostly words.

A Bloom filter of fixed size, made of the items, keeps almost all windows of texts in the
task that makes them; it is a filter only, the hash join decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import bitmap, slices, slots_set, spare
from feedloom.llm.shingles import mixed

WINDOW = 8
#: Shorter items are one window of their own length, down to this.
SHORTEST = 3
#: Share of words from which a window may have other values in its slots; share of an item's windows that must count.
WORDS = 0.5
COVERAGE = 0.5
#: States of the search for windows that agree.
STATES = 5_000
BLOOM_BITS = 24

#: Units that are slots behind a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ounce ounces pound pounds gram grams "
    "kilogram kilograms ton tons meter meters metre metres kilometer kilometers kilometre kilometres ml l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kph "
    "percent dollar dollars cent cents euro euros usd eur degree degrees kb mb gb tb hz khz mhz ghz w kw v".split()
)
_OUTER = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:%|st|nd|rd|th)?|zero|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|hundred|thousand|million")
_QUANTITY = re.compile(r"([+-]?\d[\d.,]*)([a-z]{1,4})")

WORD, NUMBER, UNIT, CAPITAL, NONE = range(5)
_SYMBOLS = {NUMBER: 0x6E756D626572, UNIT: 0x756E6974, CAPITAL: 0x6E616D65}
_STEP = np.uint64(0xD6E8FEB86659FD93)
_VERBATIM = np.uint64(0x9E3779B97F4A7C15)
KNOWN = 200_000
_KNOWN: dict[str, tuple[int, int, bool, str]] = {}

HITS = "doc_id long, text_hash long, level int, size int, at long, hash long, slots array<struct<o:int,kind:int,value:string>>"


def read_word(token: str) -> tuple[int, int, bool, str]:
    """A token's hash, kind, whether it ends a sentence, and its bare form."""
    found = _KNOWN.get(token)
    if found is None:
        bare = _OUTER.sub("", token)
        low = bare.lower()
        quantity = _QUANTITY.fullmatch(low)
        if not bare:
            kind = NONE
        elif _NUMBER.fullmatch(low) or (quantity and quantity[2] in UNITS):
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        elif len(bare) > 1 and bare[0].isupper() and bare[1:].islower():
            kind = CAPITAL
        else:
            kind = WORD
        if len(_KNOWN) >= KNOWN:
            _KNOWN.clear()
        found = _KNOWN[token] = (xxhash.xxh3_64_intdigest(low.encode()), kind, token.rstrip("\"')]»”").endswith((".", "!", "?", ":")), low)
    return found


class Symbols:
    """Symbol sequences of several texts on one level: hashes, hashes of the words behind them, kinds, owner of each symbol, and bare forms."""

    def __init__(self, hashes, own, kinds, owner, word, forms):
        self.hashes, self.own, self.kinds, self.owner, self.word, self.forms = hashes, own, kinds, owner, word, forms
        counts = np.bincount(owner, minlength=0) if len(owner) else np.empty(0, dtype=np.int64)
        self.first = np.cumsum(counts) - counts

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the windows that lie in one text; those without enough words are hashed with their values."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        rolled = np.full(n, np.uint64(size))
        for k in range(size):
            rolled = rolled * _STEP + self.hashes[k : k + n]
        words = np.concatenate([[0], np.cumsum(self.kinds == WORD)])
        poor = np.flatnonzero(words[size:] - words[:n] < WORDS * size)
        verbatim = np.full(len(poor), _VERBATIM)
        for k in range(size):
            verbatim = verbatim * _STEP + self.own[poor + k]
        rolled[poor] = verbatim
        at = np.flatnonzero(self.owner[:n] == self.owner[size - 1 :])
        return at, mixed(rolled[at])

    def slots(self, at: int, size: int) -> list[dict]:
        found = np.flatnonzero(self.kinds[at : at + size] != WORD)
        return [{"o": int(k), "kind": int(self.kinds[at + k]), "value": self.forms[self.word[at + k]]} for k in found]


def symbols(texts: pa.Array) -> tuple[Symbols, Symbols]:
    """Level 0: numbers and units are slots. Level 1: so are runs of names."""
    parts = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    bounds = parts.offsets.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    coded = parts.flatten().dictionary_encode()
    seen = [read_word(t) for t in coded.dictionary.to_pylist()]
    at = coded.indices.to_numpy().astype(np.int64)
    hashes = np.array([s[0] for s in seen], dtype=np.uint64)
    kinds = np.array([s[1] for s in seen], dtype=np.int8)
    ends = np.array([s[2] for s in seen], dtype=bool)
    forms = [s[3] for s in seen]
    kept = np.flatnonzero(kinds[at] != NONE) if len(at) else at
    at, owner = at[kept], owner[kept]
    own, kind = hashes[at], kinds[at].copy()
    inner = np.zeros(len(at), dtype=bool)
    inner[1:] = owner[1:] == owner[:-1]
    after_number, opens = np.zeros(len(at), dtype=bool), ~inner
    after_number[1:] = inner[1:] & (kind[:-1] == NUMBER)
    opens[1:] |= ends[at[:-1]]
    kind[(kind == UNIT) & ~after_number] = WORD
    kind[(kind == CAPITAL) & opens] = WORD

    def level(kind: np.ndarray, chosen: np.ndarray) -> Symbols:
        shown = own.copy()
        for k, symbol in _SYMBOLS.items():
            shown[kind == k] = np.uint64(symbol)
        # A run of names has the words of all of them behind it.
        place = np.arange(len(at)) - np.repeat(chosen, np.diff(np.append(chosen, len(at))))
        behind = np.add.reduceat(mixed(own + place.astype(np.uint64) * _STEP), chosen) if len(chosen) else own
        return Symbols(shown[chosen], behind, kind[chosen], owner[chosen], at[chosen], forms)

    plain = np.where(kind == CAPITAL, WORD, kind).astype(np.int8)
    follows = np.zeros(len(at), dtype=bool)
    follows[1:] = inner[1:] & (kind[1:] == CAPITAL) & (kind[:-1] == CAPITAL)
    return level(plain, np.arange(len(at))), level(kind, np.flatnonzero(~follows))


def _bloom_slots(hashes: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << BLOOM_BITS) - 1)
    return [(hashes >> np.uint64(shift)) & mask for shift in (0, 20, 40)]


def _size_of(n: int, window: int) -> int:
    return window if n >= window else n


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, level, size, at, hash, slots, n_windows, n_rich) of every window of every item of ``items(item_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, rows = batch.column("item_id").to_pylist(), []
                for name, text in zip(ids, batch.column("text").to_pylist()):
                    for number, level in enumerate(symbols(pa.array([text], pa.string()))):
                        size = _size_of(len(level.hashes), window)
                        if size < SHORTEST:
                            continue
                        at, hashes = level.windows(size)
                        for a, h in zip(at.tolist(), hashes.view(np.int64).tolist()):
                            rows.append({"item_id": name, "level": number, "size": size, "at": a, "hash": h, "slots": level.slots(a, size)})
                        own = rows[len(rows) - len(at) :]
                        n_rich = sum(size - len(r["slots"]) >= WORDS * size for r in own)
                        for row in own:
                            row |= {"n_windows": len(at), "n_rich": n_rich}
                yield from _batches(rows, schema)

    schema = "item_id long, level int, size int, at long, hash long, slots array<struct<o:int,kind:int,value:string>>, n_windows long, n_rich long"
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


_SLOTS = pa.list_(pa.struct([("o", pa.int32()), ("kind", pa.int32()), ("value", pa.string())]))


def _batches(rows: list[dict], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [f.split(" ") for f in schema.split(", ")]
    typed = pa.schema([(n, kinds.get(k, _SLOTS)) for n, k in fields])
    for a in range(0, len(rows), 5_000):
        yield pa.RecordBatch.from_pylist(rows[a : a + 5_000], schema=typed)


def text_hits(docs: DataFrame, bloom: np.ndarray, sizes: list[int]) -> DataFrame:
    """The windows of texts that the filter lets pass, with their slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, texts, rows = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), []
                for number, level in enumerate(symbols(batch.column("text"))):
                    for size in sizes:
                        at, hashes = level.windows(size)
                        passed = reduce(np.logical_and, [slots_set(bloom, s) for s in _bloom_slots(hashes)])
                        for a, h in zip(at[passed].tolist(), hashes[passed].view(np.int64).tolist()):
                            row = int(level.owner[a])
                            rows.append({"doc_id": ids[row], "text_hash": texts[row], "level": number, "size": size, "at": a - int(level.first[row]), "hash": h, "slots": level.slots(a, size)})
                yield from _batches(rows, HITS)

    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, HITS)


def most_agreeing(windows: list[tuple[int, dict]], states: int = STATES) -> list[int]:
    """Positions of as many windows (position, {key: value}) as agree on one value per key.

    Windows are taken in the order of their positions. A state holds the values that the windows counted so far have given to
    keys still to come; of states alike the one that counts most stays. Windows side by side share their keys, so there are few. Beyond
    ``states`` of them those that count least go: only there, with many values of several readings that all return later, could more windows agree.
    """
    readings: dict = {}
    for _, means in windows:
        for key, b in means.items():
            readings.setdefault(key, set()).add(b)
    windows = sorted(((at, {k: b for k, b in means.items() if len(readings[k]) > 1}) for at, means in windows), key=lambda w: (w[0], sorted(w[1].items())))
    last = {key: i for i, (_, means) in enumerate(windows) for key in means}
    held: dict[frozenset, tuple[int, tuple | None]] = {frozenset(): (0, None)}
    for i, (at, means) in enumerate(windows):
        gone = {key for key in means if last[key] == i}
        now: dict[frozenset, tuple[int, tuple | None]] = {}
        for state, (count, chain) in held.items():
            given = dict(state)
            fits = all(given.get(key, b) == b for key, b in means.items())
            ways = [({**given, **means}, count + 1, (at, chain))] if fits else []
            if not fits or means.keys() - given.keys():  # a window that asks nothing new is never passed over
                ways.append((given, count, chain))
            for values, n, places in ways:
                kept = frozenset((k, b) for k, b in values.items() if k not in gone)
                if kept not in now or now[kept][0] < n:
                    now[kept] = (n, places)
        if len(now) > states:
            now = dict(sorted(now.items(), key=lambda s: (-s[1][0], sorted(s[0])))[:states])
        held = now
    _, chain = max(held.values(), key=lambda s: s[0])
    places = []
    while chain is not None:
        places.append(chain[0])
        chain = chain[1]
    return places[::-1]


def agreeing(windows: list[tuple[int, list[tuple[int, str, str]]]]) -> tuple[list[int], bool]:
    """Item positions of the windows of a diagonal that count, and whether any has another value in a slot.

    A window is (position, slots), a slot (kind, value in the item, value in the text).
    """
    same = [at for at, slots in windows if all(a == b for _, a, b in slots)]
    names: dict[str, str] = {}
    others = []
    for at, slots in windows:
        if all(a == b for _, a, b in slots):
            continue
        for kind, a, b in slots:
            if kind == CAPITAL and names.setdefault(a, b) != b:
                return same, False
        means = {}
        if all(means.setdefault((kind, a), b) == b for kind, a, b in slots):
            others.append((at, means))
    counted = most_agreeing(others)
    return same + counted, bool(counted)


def _agreeing(windows: list) -> tuple[list[int], bool]:
    return agreeing([(w["at"], [(p["kind"], p["a"], p["b"]) for p in w["pairs"]]) for w in windows])


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """Items that leak into texts: doc_id, text_hash, item_id, covered, n_windows, coverage, reworded.

    ``covered`` of the item's ``n_windows`` windows (all, or those that are mostly words, whichever are better covered)
    occur in the text with agreeing slots, on the better of the two levels; ``reworded`` says whether any slot holds another value. One row per pair
    of a text and an item that reach ``coverage``.

    NULL and empty texts and items have no windows, items of fewer than three symbols neither.
    A NULL doc_id is kept as such; rows that repeat a doc_id are told apart by their
    text, and equal rows count once. Empty tables give no rows; other columns are not read.
    """
    wanted = item_windows(items, window)
    sizes = [r["size"] for r in wanted.select("size").distinct().collect()]
    hashed = wanted.select(F.explode(F.array(*[F.shiftrightunsigned("hash", k).bitwiseAND(F.lit((1 << BLOOM_BITS) - 1)) for k in (0, 20, 40)])).alias("s"))
    bloom = bitmap(hashed, F.col("s"), BLOOM_BITS)
    hits = text_hits(docs, bloom, sorted(sizes))
    item_side = wanted.select("item_id", "level", "size", "hash", "n_windows", "n_rich", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    met = hits.join(item_side, ["hash", "level", "size"])
    alike = F.size("slots") == F.size("item_slots")
    paired = F.transform(F.arrays_zip("slots", "item_slots"), lambda p: F.struct(p["slots"]["kind"].alias("kind"), p["item_slots"]["value"].alias("a"), p["slots"]["value"].alias("b")))
    met = met.where(alike).withColumn("pairs", paired)
    rich = F.col("size") - F.size("slots") >= WORDS * F.col("size")
    per = ["doc_id", "text_hash", "item_id", "level", "n_windows", "n_rich"]
    lines = met.groupBy(*per, (F.col("at") - F.col("item_at")).alias("diagonal")).agg(
        F.collect_set(F.struct(F.col("item_at").alias("at"), "pairs")).alias("windows"), F.collect_set(F.when(rich, F.col("item_at"))).alias("rich")
    )
    lines = lines.withColumn("counted", F.udf(_agreeing, "struct<places: array<bigint>, reworded: boolean>")("windows"))
    places = F.array_distinct(F.flatten(F.collect_list("counted.places")))
    found = lines.groupBy(*per).agg(
        F.size(places).cast("long").alias("of_all"),
        F.size(F.array_intersect(places, F.flatten(F.collect_list("rich")))).cast("long").alias("of_rich"),
        F.max("counted.reworded").alias("reworded"),
    )
    by_rich = F.col("of_rich") * F.col("n_windows") > F.col("of_all") * F.col("n_rich")
    found = found.withColumn("covered", F.when(by_rich, F.col("of_rich")).otherwise(F.col("of_all"))).withColumn("n_windows", F.when(by_rich, F.col("n_rich")).otherwise(F.col("n_windows")))
    found = found.withColumn("coverage", F.col("covered") / F.col("n_windows")).where(F.col("coverage") >= coverage)
    best = found.groupBy("doc_id", "text_hash", "item_id").agg(F.max_by(F.struct("covered", "n_windows", "coverage", "reworded"), F.struct("coverage", -F.col("level"))).alias("b"))
    return best.select("doc_id", "text_hash", "item_id", "b.*")


def without_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` into which no item leaks."""
    own_id, own_hash = spare(docs, "own_id", "own_hash")
    dirty = leaks(docs, items, window, coverage).select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(own_hash))
    return docs.join(dirty, same, "left_anti")
