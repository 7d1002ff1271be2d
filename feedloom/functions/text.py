"""Text cleaning and tokenising as chains of built-in expressions.

Every pattern is valid in Java and in RE2 with the same meaning, so the whole chain can
be checked against another engine. The tokeniser follows the published Penn Treebank
conventions; a sentence ends at a token's final period, unless the token is a known
abbreviation, instead of where a trained model says.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.urls import SPACE

# What cleaning deletes.
NOISE = r"@[^ ]+|http[^ ]+|www[^\n][^ ]+|#[^ ]+|[0-9]"
NOISE_AND_NEGATION = NOISE + "|n't"
LEADING_NON_LETTERS = r"^[^a-zA-Z]*"

# Treebank conventions. Rules run in order on text padded with one space at
# both ends; the period of a token is judged after the split.
ABBREVIATIONS = (
    "mr mrs ms dr prof rev hon gen col capt lt sgt sen rep gov pres st jr sr "
    "jan feb mar apr jun jul aug sep sept oct nov dec "
    "inc corp co ltd bros vs etc al ed vol approx dept univ ave blvd"
).split()
KEEPS_PERIOD = rf"^(?:\.+|(?:\p{{L}}\.)+|(?i:{'|'.join(ABBREVIATIONS)})\.)\z"
CLOSERS = "[\\])}>\"'»”’]*"
HIGH = r"[\x{1680}-\x{3000}]"
HIGH_SPACE = r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
Rules = tuple[tuple[str, str], ...]
HIGH_RULES: Rules = ((HIGH_SPACE, r" "),)
RULES: Rules = (
    (r"[\t-\r\x{1c}-\x{1f}\x{85}\x{a0}]", r" "),
    # the last period of a text always stands alone
    (rf"([^.])\.({CLOSERS}) *\z", r"$1 . $2 "),
    # opening quotes
    (r"`+", r" $0 "),
    (r"([ (\[{<])(?:\"|'')", r"$1 `` "),
    # punctuation, brackets and typographic quotes
    (r"([:,])([^\p{Nd}])", r" $1 $2"),
    (r"\.{2,}", r" $0 "),
    (r"[;@#$%&?!*\[\](){}<>«»“”‘’„]", r" $0 "),
    (r"--", r" -- "),
)
APOSTROPHE_RULES: Rules = (
    (r"(?i)'([abce-lo-ru-z0-9_])([^\p{L}\p{N}_])", r"' $1$2"),
    (r"([^'])' ", r"$1 ' "),
    (r"([^' ])('[sS]|'[mM]|'[dD]) ", r"$1 $2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", r"$1 $2 "),
    (r"(?i) (d)('ye) ", r" $1 $2 "),
    (r"(?i) (more)('n) ", r" $1 $2 "),
    (r"(?i) ('t)(is|was) ", r" $1 $2 "),
)
CLOSING_RULES: Rules = (
    (r"''", r" '' "),
    (r"\"", r" '' "),
    (r"(?i) (can)(not) ", r" $1 $2 "),
    (r"(?i) (gim|lem)(me) ", r" $1 $2 "),
    (r"(?i) (gon|wan)(na) ", r" $1 $2 "),
    (r"(?i) (got)(ta) ", r" $1 $2 "),
)
TOKEN_RULES: Rules = (*HIGH_RULES, *RULES, *APOSTROPHE_RULES, *CLOSING_RULES)
WORD = r"[\p{L}\p{N}_]{2,}"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    A column named inside a lambda may be replaced by its whole expression and computed
    again per element; a lambda's own variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _apply(text: Column, rules: Rules) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def _apply_where(text: Column, needed: Callable[[Column], Column], rules: Rules) -> Column:
    """Rules that change nothing on most texts run only where a cheap test says so."""
    return bind(text, lambda t: F.when(needed(t), _apply(t, rules)).otherwise(t))


def _parted(token: Column) -> Column:
    """A token without its period, and the period, unless an abbreviation keeps it."""
    ends = token.endswith(".") & ~token.rlike(KEEPS_PERIOD)
    return F.when(ends, F.array(F.substring(token, F.lit(1), F.length(token) - 1), F.lit("."))).otherwise(F.array(token))


def treebank_tokens(text: Column) -> Column:
    """Treebank-style tokens of a whole text."""
    text = F.concat(F.lit(" "), text, F.lit(" "))
    text = _apply(_apply_where(text, lambda t: t.rlike(HIGH), HIGH_RULES), RULES)
    text = _apply_where(text, lambda t: F.contains(t, F.lit("'")), APOSTROPHE_RULES)
    tokens = F.filter(F.split(_apply(text, CLOSING_RULES), " "), lambda t: t != "")
    return F.flatten(F.transform(tokens, _parted))


def normalise(text: Column, negation: str = "drop") -> Column:
    """Lower-case and delete mentions, links, tags and digits.

    ``drop`` also deletes ``n't`` and everything before the first ASCII letter;
    ``expand`` leaves both in place.
    """
    if negation == "expand":
        return F.regexp_replace(F.lower(text), NOISE, "")
    if negation != "drop":
        raise ValueError(f"negation must be 'drop' or 'expand', not {negation!r}")
    return F.regexp_replace(F.regexp_replace(F.lower(text), NOISE_AND_NEGATION, ""), LEADING_NON_LETTERS, "")


def clean_text(text: Column, negation: str = "drop") -> Column:
    """Cleaned tokens longer than one character, joined by spaces."""
    kept = F.filter(treebank_tokens(normalise(text, negation)), lambda t: F.length(t) > 1)
    joined = F.array_join(kept, " ")
    return F.replace(joined, F.lit("n't"), F.lit("not")) if negation == "expand" else joined


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores, in any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def without_stop_words(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Drop stop words; the list is a parameter because libraries disagree on it."""
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(*stop_words))


def ngrams(tokens: Column, longest: int = 3) -> Column:
    """All 1..longest-grams of a token array, shortest first, joined by spaces.

    Each length zips the one before with the words shifted by one, so the work is linear
    in the text.
    """

    def grow(words: Column, grams: Column, n: int) -> Column:
        if n > longest:
            return grams
        pairs = F.zip_with(grams, F.slice(words, n, F.size(words)), lambda g, w: F.concat(g, F.lit(" "), w))
        return F.concat(grams, bind(F.filter(pairs, lambda g: g.isNotNull()), lambda longer: grow(words, longer, n + 1)))

    return bind(tokens, lambda words: grow(words, words, 2))


def contains_any(text: Column, words: Sequence[str], case_sensitive: bool = False) -> Column:
    """True when a text holds any word as a literal substring; the text is folded once.

    NULL text never matches.
    """
    if not words:
        return F.lit(False)

    def any_in(folded: Column) -> Column:
        return reduce(Column.__or__, [F.contains(folded, F.lit(w if case_sensitive else w.lower())) for w in words])

    return F.coalesce(any_in(text) if case_sensitive else bind(F.lower(text), any_in), F.lit(False))


def contained_words(text: Column, words: Sequence[str], case_sensitive: bool = False) -> Column:
    """The words a text holds, as an array."""
    if not words:
        return F.array().cast("array<string>")

    def found_in(folded: Column) -> Column:
        return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(folded, w if case_sensitive else F.lower(w)))

    return bind(text if case_sensitive else F.lower(text), found_in)
