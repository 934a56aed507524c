"""Language identification by rank-order profiles.

A profile lists the most frequent n-grams (1 to 3 letters, word ends marked) by rank.
A text's own profile is compared with that of each language: an n-gram that the text has
at rank i and the language at rank j is ``|i - j|`` out of place, one the language does
not have is out of place by the profile's length. The nearest language is predicted; its
score is one minus its distance over the largest possible one.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Where no
language could be learned every text is ``und``. Equal distances go to the language first
in order. Rows without text or language teach nothing. Repeated rows get equal results;
other columns are returned as they are, those named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import textnum
from inkwell.llm.shipping import map_batches
from inkwell.operators.terms import top_per_group

#: N-grams of a profile.
PROFILE = 400
NONE = "und"
_MARK = 1


@lru_cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each text as integers, 21 bits a character; end of each text's part."""
    codes, starts, ends = textnum.flatten([t.lower() for t in texts])
    ws, we = textnum.runs(_letters()[codes])
    lengths = we - ws
    total = int(lengths.sum())
    marked = np.full(total + len(lengths) + 1, _MARK, np.int64)
    within = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    # A mark before each word and one at the end.
    to = np.cumsum(lengths + 1) - lengths
    marked[np.repeat(to, lengths) + within] = codes[np.repeat(ws, lengths) + within]
    owner = np.searchsorted(ends, ws, side="right").astype(np.int32)
    owners = np.append(np.repeat(owner, lengths + 1), 0)
    word = marked != _MARK
    one, two = marked[:-1], (marked[:-1] << 21) | marked[1:]
    three = (two[:-1] << 21) | marked[2:]
    # No n-gram reaches over a mark: a pair has a letter, a triple one in its middle. The
    # mark before a word belongs to that word's text, so what starts at the last letter of
    # a text ends at a mark, too.
    kinds = [(one, word[:-1]), (two, word[:-1] | word[1:]), (three, word[1:-1])]
    found = np.concatenate([g[keep] for g, keep in kinds])
    of = np.concatenate([owners[: len(g)][keep] for g, keep in kinds])
    order = np.argsort(of, kind="stable")
    return found[order], np.searchsorted(of[order], np.arange(len(texts)), side="right")


def learn(documents: DataFrame, lang: str = "lang", profile: int = PROFILE) -> dict[str, list[int]]:
    """The n-grams of each language, the most frequent first (equal counts: smaller first).

    Learned from all texts. Tasks count the n-grams of their texts; counts are summed per
    language and only profiles reach the driver.
    """
    usable = documents.select(F.col(lang).cast("string").alias("lang"), "text").where("lang is not null and text is not null")
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = np.array(batch.column("lang").to_pylist(), object), batch.column("text").to_pylist()
            for name in sorted(set(langs)):
                for _, held in textnum.slices([t for t, k in zip(texts, langs) if k == name]):
                    kinds, n = np.unique(ngrams(held)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(kinds), pa.string()), pa.array(kinds), pa.array(n)], ["lang", "gram", "n"])

    summed = map_batches(usable, count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = top_per_group(summed, "lang", [F.desc("n"), F.asc("gram")], ["gram"], profile)
    out: dict[str, list[int]] = {}
    for r in sorted(best.select("lang", "rank", "gram").collect()):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def distances(grams: np.ndarray, known: np.ndarray, ranks: np.ndarray, profile: int) -> tuple[np.ndarray, int]:
    """Out-of-place distance of one text to each language, and the largest possible.

    ``known`` are the sorted n-grams of all profiles, ``ranks`` their rank in each language
    (``profile`` or more: not there).
    """
    kinds, counts = np.unique(grams, return_counts=True)
    top = np.lexsort((kinds, -counts))[:profile]
    kinds = kinds[top]
    at = np.minimum(np.searchsorted(known, kinds), len(known) - 1)
    there = known[at] == kinds
    own = np.arange(len(kinds))
    apart = np.abs(ranks[at[there]] - own[there][:, None])
    apart[ranks[at[there]] >= profile] = profile
    return apart.sum(0) + profile * int((~there).sum()), profile * len(kinds)


def predict(documents: DataFrame, profiles: dict[str, list[int]], profile: int = PROFILE) -> DataFrame:
    """``documents`` (with a column ``text``) with ``lang_pred`` and ``score``."""
    names = sorted(profiles)
    known = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
    ranks = np.full((max(1, len(known)), max(1, len(names))), profile, np.int64)
    for j, name in enumerate(names):
        ranks[np.searchsorted(known, np.array(profiles[name], np.int64)), j] = np.arange(len(profiles[name]))
    kept = [f for f in documents.schema.fields if f.name not in ("lang_pred", "score")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", lang_pred string, score double"
    columns = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for _, held in textnum.slices(batch.column("text").to_pylist()):
                found, ends = ngrams(held)
                for a, b in zip([0, *ends[:-1]], ends):
                    if a == b or not names:
                        langs.append(NONE)
                        scores.append(0.0)
                        continue
                    apart, most = distances(found[a:b], known, ranks, profile)
                    best = int(apart.argmin())
                    langs.append(names[best])
                    scores.append(1.0 - float(apart[best]) / most)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in columns], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*columns, "lang_pred", "score"],
            )

    return map_batches(documents, run, schema)
