"""Toxicity scores: a bag of subword vectors, averaged, under a linear softmax.

A word's bag holds the word and its 3 to 5 characters in a row, word ends marked, so a
misspelled word shares most of its vectors with the right one. See
:mod:`inkwell.llm.subwords` for the model; vectors and softmax are learned jointly.

Defined results: a null text counts as empty; a text without words gets the score of the
learned bias alone. Repeated rows get equal scores. Labels other than 0 and 1, null
labels and null keys teach nothing; without any usable label the score is 0.5. Other
columns are returned as they are, one named like the score column is replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from inkwell.llm import subwords, textnum
from inkwell.llm.subwords import Model

#: The most labelled documents that the classifier is fitted on.
TRAIN_ROWS = 8000
#: Few of the rows are toxic, so a small table is read until that many steps were taken.
LEAST_STEPS = 600
TOXIC = 0.5


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words of each text and of the character n-grams inside them."""
    codes, starts, ends = textnum.flatten([t.lower() for t in texts])
    ws, we = textnum.word_runs(codes)
    owners = np.searchsorted(ends, ws, side="right")
    words = subwords.buckets(textnum.run_hashes(codes, ws, we).astype(np.uint32))
    # Words between marks: a word end is one mark, two words share it.
    lengths = we - ws
    to = np.cumsum(lengths + 1) - lengths
    marked = np.zeros(int(lengths.sum() + len(lengths) + 1), np.uint32)
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    marked[np.repeat(to, lengths) + place] = codes[np.repeat(ws, lengths) + place]
    owner_at = np.append(np.repeat(owners, lengths + 1), 0)
    space = marked == 0
    parts, whose = [words], [owners]
    for n in (3, 4, 5):
        grams = subwords.buckets(subwords.char_ngrams(marked, n))
        whole = np.ones(len(grams), bool)
        for k in range(1, n - 1):
            whole &= ~space[k : k + len(grams)]
        parts.append(grams[whole])
        whose.append(owner_at[: len(grams)][whole])
    order = np.argsort(np.concatenate(whose).astype(np.int32), kind="stable")
    found, of = np.concatenate(parts)[order], np.concatenate(whose)[order]
    return found, np.searchsorted(of, np.arange(len(texts)), side="right")


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Learn from the labelled rows of ``documents`` (key, text)."""
    return subwords.fit(documents, labels, key, label, features, rows, rate=1.0, epochs=8, least=LEAST_STEPS)


def score(documents: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``documents`` with the probability that a text is toxic."""
    return subwords.apply(documents, model, features, column)
