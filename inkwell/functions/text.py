"""Text cleaning and tokenizing as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.schema import STOP_WORDS, WHITESPACE

_SPACE_CLASS = f"[{WHITESPACE}]"


def clean_punct(text: Column) -> Column:
    """Lower case, delete ASCII punctuation, strip white space at both ends.

    Punctuation is deleted, not replaced: ``end.Start`` becomes ``endstart``.
    """
    return F.btrim(F.regexp_replace(F.lower(text), r"\p{Punct}", ""), F.lit(WHITESPACE))


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<([^>]+)>", "")


def drop_stop_words(words: Column, min_length: int = 1) -> Column:
    """Words that are not on the stop list and have at least ``min_length`` letters."""
    return F.filter(
        words,
        lambda w: ~w.isin(STOP_WORDS) & (F.char_length(w) >= min_length),
    )


def clean_text(text: Column, min_length: int = 3) -> Column:
    """Lower case, drop tags, turn punctuation into spaces, drop digits, stop
    words and words under ``min_length`` letters; words joined by one space."""
    bare = F.regexp_replace(strip_tags(F.lower(text)), r"\p{Punct}+", " ")
    bare = F.regexp_replace(F.regexp_replace(bare, _SPACE_CLASS + "+", " "), "[0-9]+", "")
    return F.array_join(drop_stop_words(F.split(bare, " "), min_length), " ")


def letters_only(text: Column) -> Column:
    """Lower case, everything but a-z into a space, stop words dropped."""
    words = F.split(F.regexp_replace(F.lower(text), "[^a-z]+", " "), " ")
    return F.array_join(drop_stop_words(words), " ")


def tokens(clean: Column) -> Column:
    """Tokens of a cleaned text without stop words.

    Splitting on runs of white space yields the same words as splitting on each
    one, because the empty tokens in between are on the stop list.
    """
    return drop_stop_words(F.split(clean, r"\s+"))


def plural_stem(word: Column) -> Column:
    """Plural suffixes only: -sses to -ss, -ies to -i, -ss kept, -s dropped."""
    size = F.char_length(word)
    return (
        F.when(size <= 2, word)
        .when(word.endswith("sses") | word.endswith("ies"), F.left(word, size - 2))
        .when(word.endswith("ss") | ~word.endswith("s"), word)
        .otherwise(F.left(word, size - 1))
    )


def comment_sentences(text: Column) -> Column:
    """Array of arrays: the lines of a comment, each stripped and split at ``'. '``."""
    return F.transform(
        F.split(text, "\n"),
        lambda line: F.split(F.btrim(line, F.lit(WHITESPACE)), r"\. "),
    )
