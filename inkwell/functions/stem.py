"""The Porter stemmer as native column expressions.

Each stage is a list of suffixes, of which the first that fits decides: if the rest of the word
measures up, the suffix is replaced, else the word stays. The measure counts how often
vowels are followed by consonants. Apply it to a vocabulary, not to every occurrence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published suffixes and what replaces them.
PLURALS = (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", ""))
DOUBLE = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"),
    ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"),
    ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
)
LONG = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
LAST = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "sion", "tion", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
)
MENDED = ("at", "bl", "iz")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _shape(word: Column) -> Column:
    """c or v for each letter; y is a vowel behind a consonant."""
    marked = F.regexp_replace(F.regexp_replace(word, "(^|[aeiou])y", "$1Y"), "yy", "yY")
    return F.regexp_replace(F.regexp_replace(marked, "[^aeiouy]", "c"), "[aeiouy]", "v")


def _measure(shape: Column) -> Column:
    return (F.char_length(shape) - F.char_length(F.replace(shape, F.lit("vc"), F.lit("")))) / 2


def _without(word: Column, letters: int) -> Column:
    return F.left(word, F.char_length(word) - letters)


def _closed(word: Column, shape: Column) -> Column:
    """Ends in consonant, vowel, consonant, the last not w, x or y."""
    return shape.endswith("cvc") & ~word.rlike("[wxy]$")


def _shaped(word: Column, use: Callable[[Column, Column], Column]) -> Column:
    return _let(word, lambda w: _let(_shape(w), lambda s: use(w, s)))


def _first_fitting(w: Column, cases: list[tuple[str, Column]]) -> Column:
    chain = F
    for suffix, value in cases:
        chain = chain.when(w.endswith(suffix), value)
    return chain.otherwise(w)


def _replaced(word: Column, rules: tuple[tuple[str, str], ...], above: int) -> Column:
    """The suffix replaced where the rest's measure is above a number."""

    def step(w: Column, s: Column) -> Column:
        return _first_fitting(w, [
            (suffix, F.when(_measure(_without(s, len(suffix))) > above, F.concat(_without(w, len(suffix)), F.lit(new))).otherwise(w))
            for suffix, new in rules
        ])

    return _shaped(word, step)


def _past(word: Column) -> Column:
    """Suffixes of past and progressive forms; what is left gets a proper end."""

    def mended(w: Column, s: Column) -> Column:
        doubled = s.endswith("cc") & (F.right(w, F.lit(1)) == F.substring(w, -2, 1)) & ~w.rlike("[lsz]$")
        return (
            F.when(w.rlike(f"({'|'.join(MENDED)})$"), F.concat(w, F.lit("e")))
            .when(doubled, _without(w, 1))
            .when((_measure(s) == 1) & _closed(w, s), F.concat(w, F.lit("e")))
            .otherwise(w)
        )

    def step(w: Column, s: Column) -> Column:
        cases = [("eed", F.when(_measure(_without(s, 3)) > 0, _without(w, 1)).otherwise(w))]
        for suffix in ("ed", "ing"):
            rest = _without(w, len(suffix))
            cases.append((suffix, F.when(_without(s, len(suffix)).contains("v"), _shaped(rest, mended)).otherwise(w)))
        return _first_fitting(w, cases)

    return _shaped(word, step)


def _final_y(word: Column) -> Column:
    def step(w: Column, s: Column) -> Column:
        return F.when(w.endswith("y") & _without(s, 1).contains("v"), F.concat(_without(w, 1), F.lit("i"))).otherwise(w)

    return _shaped(word, step)


def _last(word: Column) -> Column:
    def step(w: Column, s: Column) -> Column:
        # Of sion and tion the first letter stays.
        cuts = [(suffix, 3 if suffix in ("sion", "tion") else len(suffix)) for suffix in LAST]
        return _first_fitting(w, [(x, F.when(_measure(_without(s, n)) > 1, _without(w, n)).otherwise(w)) for x, n in cuts])

    return _shaped(word, step)


def _final_e(word: Column) -> Column:
    def drop(w: Column, s: Column) -> Column:
        rest, shape = _without(w, 1), _without(s, 1)
        fits = (_measure(shape) > 1) | ((_measure(shape) == 1) & ~_closed(rest, shape))
        return F.when(w.endswith("e") & fits, rest).otherwise(w)

    def single(w: Column, s: Column) -> Column:
        return F.when(w.endswith("ll") & (_measure(s) > 1), _without(w, 1)).otherwise(w)

    return _shaped(_shaped(word, drop), single)


def porter_stem(word: Column) -> Column:
    """The stem of a lower-case word; words of one or two letters stay. Null stays null."""
    plural = F.transform(F.array(word), lambda w: _first_fitting(w, [(x, F.concat(_without(w, len(x)), F.lit(new))) for x, new in PLURALS]))
    stem = _final_y(_past(F.element_at(plural, 1)))
    stem = _replaced(_replaced(stem, DOUBLE, 0), LONG, 0)
    return F.when(F.char_length(word) <= 2, word).otherwise(_final_e(_last(stem)))
