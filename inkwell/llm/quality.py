"""Quality classifier: supervised subword embeddings, averaged per document.

The features of a text are its tokens (runs without white space, case and punctuation
kept), each two tokens in a row, and each 2 to 4 characters in a row, hashed into 2^18
buckets. See :mod:`inkwell.llm.subwords` for the model.

Defined results: a null text counts as empty; a text without features, such as an empty
one, gets the score of the learned bias alone. Repeated rows get equal scores. Labels
other than 0 and 1, null labels and null keys teach nothing. Without any usable label the
score is 0.5. Other columns of the input are returned as they are, one named like the
score column is replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from inkwell.llm import subwords, textnum
from inkwell.llm.subwords import Model

#: The most labelled documents that the classifier is fitted on.
TRAIN_ROWS = 6000
KEEP = 0.7


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of tokens, token pairs and character n-grams of each text."""
    codes, starts, ends = textnum.flatten(texts)
    ts, te = textnum.token_runs(codes)
    tokens = textnum.run_hashes(codes, ts, te).astype(np.uint32)
    pairs = tokens[:-1] * np.uint32(0x85EBCA6B) + tokens[1:] + np.uint32(1)
    low, high = np.searchsorted(ts, starts), np.searchsorted(ts, ends)
    kinds = [(subwords.buckets(tokens), low, high), (subwords.buckets(pairs), low, np.maximum(low, high - 1))]
    for n in (2, 3, 4):
        kinds.append((subwords.buckets(subwords.char_ngrams(codes, n)), starts, np.maximum(starts, ends - n + 1)))
    return joined(kinds)


def joined(kinds: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Parts of several kinds of features, put together for each text.

    A kind is given by its buckets and, for each text, where its part starts and ends.
    """
    sizes = np.stack([high - low for _, low, high in kinds], axis=1)
    ends = np.cumsum(sizes.ravel())
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    for k, (found, low, high) in enumerate(kinds):
        length = sizes[:, k]
        total = int(length.sum())
        within = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
        to = (ends.reshape(sizes.shape)[:, k] - length) if total else length
        out[np.repeat(to, length) + within] = found[np.repeat(low, length) + within]
    return out, ends.reshape(sizes.shape)[:, -1]


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Learn from the labelled rows of ``documents`` (key, text)."""
    return subwords.fit(documents, labels, key, label, features, rows)


def score(documents: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``documents`` with the probability that a text is good."""
    return subwords.apply(documents, model, features, column)
