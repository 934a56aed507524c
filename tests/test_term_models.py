"""Stemmer, linear models on term tables, exact samples and Gaussian naive Bayes against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.functions.stem import DOUBLE, LAST, LONG, PLURALS, porter_stem
from inkwell.learning import gaussian, linear
from inkwell.operators import sample, terms
from inkwell.plans import catalog
from inkwell.sources.tables import table

# Stemmer


def is_consonant(word, i):
    if word[i] in "aeiou":
        return False
    return word[i] != "y" or i == 0 or not is_consonant(word, i - 1)


def measure(word):
    kinds = [is_consonant(word, i) for i in range(len(word))]
    return sum(not a and b for a, b in zip(kinds, kinds[1:]))


def has_vowel(word):
    return any(not is_consonant(word, i) for i in range(len(word)))


def is_closed(word):
    return (
        len(word) > 2 and is_consonant(word, len(word) - 1) and not is_consonant(word, len(word) - 2)
        and is_consonant(word, len(word) - 3) and word[-1] not in "wxy"
    )


def plain_stem(word):
    if len(word) <= 2:
        return word

    def replaced(word, rules, above):
        for suffix, new in rules:
            if word.endswith(suffix):
                rest = word[: len(word) - len(suffix)]
                return rest + new if measure(rest) > above else word
        return word

    for suffix, new in PLURALS:
        if word.endswith(suffix):
            word = word[: len(word) - len(suffix)] + new
            break
    if word.endswith("eed"):
        word = word[:-1] if measure(word[:-3]) > 0 else word
    else:
        for suffix in ("ed", "ing"):
            if word.endswith(suffix):
                rest = word[: len(word) - len(suffix)]
                if has_vowel(rest):
                    word = rest
                    if word.endswith(("at", "bl", "iz")):
                        word += "e"
                    elif len(word) > 1 and word[-1] == word[-2] and is_consonant(word, len(word) - 1) and is_consonant(word, len(word) - 2) and word[-1] not in "lsz":
                        word = word[:-1]
                    elif measure(word) == 1 and is_closed(word):
                        word += "e"
                break
    if word.endswith("y") and has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = replaced(replaced(word, DOUBLE, 0), LONG, 0)
    for suffix in LAST:
        if word.endswith(suffix):
            rest = word[: len(word) - (3 if suffix in ("sion", "tion") else len(suffix))]
            word = rest if measure(rest) > 1 else word
            break
    if word.endswith("e"):
        rest = word[:-1]
        if measure(rest) > 1 or (measure(rest) == 1 and not is_closed(rest)):
            word = rest
    return word[:-1] if word.endswith("ll") and measure(word) > 1 else word


def test_known_stems(spark):
    known = dict(
        caresses="caress", ponies="poni", ties="ti", cats="cat", feed="feed", agreed="agre", plastered="plaster", bled="bled",
        motoring="motor", sing="sing", conflated="conflat", troubled="troubl", sized="size", hopping="hop", falling="fall",
        hissing="hiss", failing="fail", filing="file", happy="happi", sky="sky", relational="relat", conditional="condit",
        digitizer="digit", operator="oper", hopefulness="hope", formality="formal", triplicate="triplic", electrical="electr",
        goodness="good", revival="reviv", adjustment="adjust", adoption="adopt", effective="effect", probate="probat", rate="rate",
        cease="ceas", controller="control", roll="roll", generalizations="gener", oscillators="oscil",
    )
    rows = spark.createDataFrame(list(known.items()), "word string, stem string")
    wrong = rows.select("word", "stem", porter_stem(F.col("word")).alias("found")).where("stem <> found").collect()
    assert wrong == []


def test_stems_of_a_whole_vocabulary_equal_plain_version(spark):
    words = terms.stems(catalog._tokenized(spark, "/root/testdata/sf0.01"))
    odd = ["yy", "yyy", "byyb", "ayyed", "sayings", "eed", "ing", "aing", "é", "éing", "42s", "s", "ss", "sss", "ied", "llll", ""]
    odd += [a + b for a in ("tr", "happ", "oscill", "rel", "y", "gy") for b in [x for x, _ in (*PLURALS, *DOUBLE, *LONG)] + [*LAST, "ed", "ing", "eed", "e", "ll"]]
    found = words.collect() + spark.createDataFrame([(w,) for w in odd], "token string").select("token", porter_stem(F.col("token")).alias("stem")).collect()
    assert len(found) > 10_000
    assert [(r["token"], r["stem"], plain_stem(r["token"])) for r in found if r["stem"] != plain_stem(r["token"])] == []


def test_stemmed_bags_keep_rows_apart(spark):
    rows = [(None, ["cats", "cat"]), (None, ["cat"]), (1, ["running", "runs"]), (1, ["runs"]), (2, []), (3, None)]
    found = terms.stemmed_bags(spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")).collect()
    assert sorted((str(r["doc_id"]), r["stem"], r["n"]) for r in found) == [("1", "run", 1), ("1", "run", 2), ("None", "cat", 1), ("None", "cat", 2)]


# Linear models


def random_rows(spark, count=120):
    r = np.random.default_rng(6)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(count):
        y = int(r.random() < 0.4)
        own = r.choice(words[:20] if y else words[15:], size=r.integers(0, 25))
        rows.append((i % 30 or None, y if r.random() < 0.95 else None, own.tolist()))
    return spark.createDataFrame(rows, "doc_id bigint, class int, tokens array<string>")


@pytest.mark.parametrize("loss", [linear.LOGISTIC, linear.SQUARED_HINGE], ids=lambda x: x.name)
def test_linear_passes_equal_plain_gradient_and_lower_the_loss(spark, loss):
    tokenized = random_rows(spark)
    idf = linear.smoothed_idf(tokenized)
    rows = linear.weigh_rows(tokenized, idf)
    assert rows.count() == 120
    model = linear.fit(rows, "class", loss, passes=6, penalty=0.01)
    known = rows.where("class is not null").orderBy("_row").collect()
    names = sorted({t["token"] for r in known for t in r["terms"]})
    x = np.zeros((len(known), len(names) + 1))
    x[:, -1] = 1
    for i, r in enumerate(known):
        for t in r["terms"]:
            x[i, names.index(t["token"])] = t["value"]
        assert not r["terms"] or abs(sum(t["value"] ** 2 for t in r["terms"]) - 1) < 1e-9
    side, n = np.array([2 * r["class"] - 1 for r in known]), len(known)
    reach = (np.abs(x) * np.abs(x).sum(1, keepdims=True)).sum(0) / n
    w, hold, losses = np.zeros(len(names) + 1), np.full(len(names) + 1, 0.01), []
    hold[-1] = 0
    for _ in range(6):
        m = x @ w
        if loss is linear.LOGISTIC:
            losses.append(np.log1p(np.exp(-side * m)).mean())
            slope = -side / (1 + np.exp(side * m))
        else:
            losses.append((np.maximum(1 - side * m, 0) ** 2).mean())
            slope = -2 * side * np.maximum(1 - side * m, 0)
        w = w - (x.T @ slope / n + hold * w) / (loss.bend * reach + hold)
    mine = {r["token"]: r["weight"] for r in model.weights.collect()}
    assert np.allclose([mine[t] for t in names] + [mine[linear.BIAS]], w, atol=1e-9)
    assert np.allclose(model.losses, losses)
    assert all(b < a for a, b in zip(model.losses, model.losses[1:]))
    predicted = linear.predict(model, rows).collect()
    assert len(predicted) == 120 and {r["prediction"] for r in predicted} == {0, 1}
    hits = sum(r["prediction"] == r["class"] for r in predicted if r["class"] is not None)
    assert hits > 0.85 * n


def test_linear_model_bears_empty_and_unknown(spark):
    none = random_rows(spark).where("false")
    rows = linear.weigh_rows(none, linear.smoothed_idf(none))
    model = linear.fit(rows, "class", passes=2)
    other = linear.weigh_rows(random_rows(spark, 5), linear.smoothed_idf(random_rows(spark)))
    assert model.weights.count() == 0
    assert [r["margin"] for r in linear.predict(model, other).collect()] == [0.0] * 5


def test_linear_blocks_of_any_size_give_the_same_model(spark, monkeypatch):
    tokenized = random_rows(spark).repartition(3)
    idf = linear.smoothed_idf(tokenized)
    found = []
    for size in (linear.BLOCK, 40, 1):
        monkeypatch.setattr(linear, "BLOCK", size)
        rows = linear.weigh_rows(tokenized, idf)
        model = linear.fit(rows, "class", passes=3, penalty=0.01)
        margins = sorted((str(r["doc_id"]), str(r["class"]), round(r["margin"], 9)) for r in linear.predict(model, rows).collect())
        found.append(({r["token"]: round(r["weight"], 9) for r in model.weights.collect()}, margins))
    assert len(found[0][1]) == 120 and found[0] == found[1] == found[2]


def test_linear_pass_moves_weights_and_not_terms(spark):
    rows = linear.weigh_rows(random_rows(spark), linear.smoothed_idf(random_rows(spark)))
    blocks = linear._packed(rows.select("_row", "terms"))
    places = linear._places(blocks)
    weights = places.select("token").distinct().selectExpr("token", "1.5D as weight")
    plan = linear._met(blocks, places, linear.keep(weights, "weights"))._jdf.queryExecution().executedPlan().toString()
    # Weights go to their places, and those of a block to the block; nothing else moves.
    assert plan.count("Exchange hashpartitioning(token") == 1 and plan.count("Exchange hashpartitioning(block") == 1
    assert plan.count("Exchange") == 2 and "SortMergeJoin" not in plan


# Exact samples


def test_exact_split_takes_exact_shares(many_partitions):
    spark = many_partitions
    rows = [(i, g) for g, n in (("a", 1000), ("b", 7), ("c", 1), (None, 333)) for i in range(n)]
    frame = spark.createDataFrame(rows, "key bigint, grp string")
    for fraction in (0, 0.3, 0.5, 0.8, 1):
        found = sample.exact_split(frame, "key", fraction, 80, ["grp"]).collect()
        assert len(found) == len(rows)
        for group, n in (("a", 1000), ("b", 7), ("c", 1), (None, 333)):
            assert sum(r["chosen"] for r in found if r["grp"] == group) == math.floor(n * fraction + 0.5)
    again = sample.exact_split(frame.repartition(13), "key", 0.5, 80, ["grp"]).where("chosen").drop("chosen")
    first = sample.exact_split(frame, "key", 0.5, 80, ["grp"]).where("chosen").drop("chosen")
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))


def test_exact_split_of_copies_and_null_keys(spark):
    rows = [(5,)] * 400 + [(None,)] * 101 + [(i,) for i in range(10, 110)]
    found = sample.exact_split(spark.createDataFrame(rows, "key bigint"), "key", 0.8).collect()
    assert len(found) == 601 and sum(r["chosen"] for r in found) == 481
    assert sample.exact_split(spark.createDataFrame([], "key bigint"), "key", 0.8).count() == 0


def test_exact_split_has_no_global_sort(spark, capsys):
    sample.exact_split(spark.range(1000), "id", 0.8).explain()
    plan = capsys.readouterr().out
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_samplers_treat_a_null_key_as_a_value(spark):
    rows = spark.createDataFrame([(None, 1.0, 0), (None, 2.0, 0), *[(i, float(i), 0) for i in range(6)]], "key bigint, v double, c int")
    assert sample.systematic_sample(rows, "key", "v", "c", [0], 8).count() == 8
    assert any(sample.pick_one(rows, "key", seed).head()["key"] is not None for seed in range(1, 9))


# Gaussian naive Bayes


def test_gaussian_equals_plain_densities(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(i % 3, 1 + i % 3, 5)] + [7.0], i % 3) for i in range(200)]
    odd = [(900, None, 1), (901, [float("nan")] * 6, 1), (902, [None] * 6, 0), (903, [float("inf")] * 6, 2), (904, [1.0] * 6, None)]
    frame = spark.createDataFrame(rows + odd, "id int, v array<double>, label int")
    model = gaussian.fit(frame, "v", "label")
    found = {p["id"]: p["prediction"] for p in gaussian.predict(model, frame, "v", "label").collect()}
    assert set(found) == {*range(200), 904}
    x, y = np.array([v for _, v, _ in rows]), np.array([c for _, _, c in rows])
    more = 1e-9 * x.var(0).max() + 1e-12
    scores = np.stack([
        np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * (x[y == c].var(0) + more)) + (x - x[y == c].mean(0)) ** 2 / (x[y == c].var(0) + more)).sum(1)
        for c in range(3)
    ])
    assert [found[i] for i in range(200)] == scores.argmax(0).tolist()
    assert (scores.argmax(0) == y).mean() > 0.5
    assert gaussian.predict(gaussian.fit(frame.where("false"), "v", "label"), frame, "v", "label").count() == 0


