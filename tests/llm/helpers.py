"""Rows that every operator has to bear, and brute-force versions."""

import re

LONG = "lorem ipsum dolor sit amet " * 12_000
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, spans string, license string"
ODD = [None, "", " \n\t", "a", "é" * 30, "\U0001f600 " * 40, LONG, "x" * 100_000, "İ" * 5 + " token=abcdefghijklmnop"]


def documents(spark, texts):
    """Rows with ids from 0, one without an id, and columns whose names clash with results."""
    rows = [(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "a row without id " * 5, None, None, None, None, None, None)], SCHEMA)


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def links(texts, threshold=0.8):
    """class and links of each text, by all pairs."""
    sets = [shingles(t) for t in texts]
    label, count = list(range(len(texts))), [0] * len(texts)
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * len(sets[i] | sets[j]) - 1e-9:
                count[i] += 1
                count[j] += 1
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return {i: (label[i], count[i]) for i in range(len(texts))}
