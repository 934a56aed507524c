import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from inkwell.functions.numbers import rounded
from inkwell.operators import terms


@pytest.fixture(scope="module")
def tiny(spark):
    rows = [(1, ["a", "a", "b"]), (2, ["a", "c"]), (3, [])]
    return spark.createDataFrame(rows, "doc_id int, tokens array<string>")


@pytest.fixture(scope="module")
def corpus(spark):
    dice = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [
        (d, f"s{min(d % 5, 1)}", [dice.choice(words[: 1 + d % 60]) for _ in range(dice.randrange(40))])
        for d in range(200)
    ]
    return spark.createDataFrame(rows, "doc_id int, source string, tokens array<string>").repartition(5).cache()


def brute(corpus):
    documents = {r.doc_id: (r.source, Counter(r.tokens)) for r in corpus.collect()}
    df = Counter(t for _, bag in documents.values() for t in bag)
    n = sum(1 for _, bag in documents.values() if bag)
    return {
        (d, t): (source, k / sum(bag.values()), math.log(n / df[t]))
        for d, (source, bag) in documents.items()
        for t, k in bag.items()
    }


def test_tiny_case(tiny):
    found = {(r.doc_id, r.token): (r.tf, r.idf) for r in terms.tf_idf(tiny).collect()}
    ln2 = math.log(2)
    assert found == {
        (1, "a"): (2 / 3, 0.0), (1, "b"): (1 / 3, ln2), (2, "a"): (0.5, 0.0), (2, "c"): (0.5, ln2),
    }


def test_documents_without_tokens_do_not_count(tiny):
    assert {r.token: r.df for r in terms.document_frequencies(tiny).collect()} == {"": 2, "a": 2, "b": 1, "c": 1}


def test_weights_equal_brute_force(corpus):
    expected = brute(corpus)
    rows = terms.tf_idf(corpus).collect()
    assert len(rows) == len(expected)
    for r in rows:
        source, tf, idf = expected[r.doc_id, r.token]
        assert r.source == source and r.tf == tf and r.idf == pytest.approx(idf)
        assert r.tf_idf == pytest.approx(tf * idf) and r.idf >= 0


def test_joined_weights_equal_direct_ones(corpus):
    order = ["doc_id", "token"]
    columns = ["doc_id", "token", "tf", "idf", "tf_idf"]
    direct = terms.tf_idf(corpus).select(columns).orderBy(order).collect()
    assert terms.tf_idf_by_pair(corpus, "doc_id").select(columns).orderBy(order).collect() == direct


def test_tf_sums_to_one(corpus):
    for r in terms.term_frequencies(corpus).groupBy("doc_id").agg(F.sum("tf").alias("s")).collect():
        assert r.s == pytest.approx(1.0)


def test_top_per_group_with_ties_and_a_hot_group(spark):
    dice = random.Random(2)
    rows = [("hot" if i % 3 else f"g{i % 4}", i, dice.randrange(20)) for i in range(900)]
    frame = spark.createDataFrame(rows, "g string, id int, v int").repartition(6)
    found = terms.top_per_group(frame, "g", [F.desc("v"), F.asc("id")], ["id"], 10, salts=4).collect()
    expected = set()
    for group in {g for g, _, _ in rows}:
        best = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[2], r[1]))[:10]
        expected |= {(*r, i + 1) for i, r in enumerate(best)}
    assert {tuple(r) for r in found} == expected


def test_item_specificity_has_a_witness(spark):
    weights = spark.createDataFrame(
        [(0, "b", 2.0), (0, "a", 2.0), (0, "c", 1.0), (1, "z", 0.5)], "class int, token string, tf_idf double"
    )
    found = {r["class"]: (r.specificity, r.token) for r in terms.item_specificity(weights).collect()}
    assert found == {0: (2.0, "a"), 1: (0.5, "z")}


def test_boosted_counts(spark):
    words = spark.createDataFrame([("x",), ("x",), ("y",), ("z",)], "token string")
    found = {r.token: (r.n, r.weight) for r in terms.boosted_counts(words, "z", 5).collect()}
    assert found == {"z": (6, 1.0), "x": (2, 2 / 6), "y": (1, 1 / 6)}


def test_vocabulary_conflation(spark):
    frame = spark.createDataFrame([(["cats", "cat", "cat", "ponies"],)], "tokens array<string>")
    found = {r.stem: (r.n, r.forms) for r in terms.conflated_vocabulary(frame).collect()}
    assert found == {"cat": (3, 2), "poni": (1, 1)}


def test_letter_counts(spark):
    texts = spark.createDataFrame([("bcb x",), ("aa",), ("",)], "text string")
    found = {r.char: r.n for r in terms.letter_counts(texts, "text", "bcx").collect()}
    assert found == {"b": 2, "c": 1, "x": 1, " ": 3}


def test_frequencies_over_rows_equal_those_of_the_whole(spark, corpus):
    rows = corpus.select(F.concat_ws("/", "doc_id", "source").alias("doc_id"), "tokens")
    halves = rows.select("doc_id", F.slice("tokens", 1, 7).alias("tokens")).unionByName(
        rows.where(F.size("tokens") > 7).select("doc_id", F.expr("slice(tokens, 8, 100)").alias("tokens"))
    )
    order = ["doc_id", "token"]
    found = terms.term_frequencies_over_rows(halves.repartition(6), "doc_id").orderBy(order).collect()
    assert found == terms.term_frequencies(rows).orderBy(order).collect()


def test_mutual_information_equals_plain_entropies(spark):
    import math

    rows = [("a", 0), ("a b", 0), ("b", 1), ("b c", 1), ("", 1), ("c", None), ("a b c", 0)]
    frame = spark.createDataFrame([(t.split(), c) for t, c in rows], "tokens array<string>, class int")
    found = {r["token"]: (r["df"], r["mi"]) for r in terms.mutual_information(frame, "class").collect()}
    used = [(set(t.split()), c) for t, c in rows if c is not None]
    assert set(found) == {"a", "b", "c"}
    for token in found:
        mi = 0.0
        for there in (True, False):
            for c in (0, 1):
                n = sum((token in w) == there and x == c for w, x in used)
                if n:
                    mi += n / 6 * math.log(n * 6 / (sum((token in w) == there for w, _ in used) * sum(x == c for _, x in used)))
        assert found[token] == (sum(token in w for w, _ in used), pytest.approx(mi))
    assert terms.top_informative(terms.mutual_information(frame, "class"), 1).head()["token"] == "a"
    assert terms.mutual_information(frame.where("class is null"), "class").count() == 0


def test_naive_bayes_bears_null_and_repeated_keys(spark):
    rows = [(1, 0, "a a"), (2, 0, "a"), (3, 1, "b b b"), (None, 1, "b b b"), (3, 0, "a a"), (None, 0, "")]
    frame = spark.createDataFrame([(k, c, t.split()) for k, c, t in rows], "doc_id bigint, class int, tokens array<string>")
    found = terms.naive_bayes(frame, "doc_id", "class").collect()
    assert sorted(map(str, found)) == sorted(
        f"Row(doc_id={k}, class={c}, prediction={int('b' in t)})" for k, c, t in rows
    )


def test_cross_validation_equals_fits_without_the_fold(spark):
    import math
    import random

    from inkwell.operators.evaluate import weighted_f1, weighted_f1_by

    r = random.Random(7)
    rows = [(i, c, [r.choice("abcdef" if c else "defghi") for _ in range(r.randrange(0, 6))]) for i in range(60) for c in [int(r.random() < 0.4)]]
    rows += [(60, None, ["a"]), (61, 1, ["only", "here"])]
    frame = spark.createDataFrame(rows, "id int, class int, tokens array<string>")
    found = terms.cross_validated_bayes(frame, "class", F.col("id") % 3, 3, [0.5, 1.0])
    want = []
    for fold in range(3):
        train = [(c, t) for i, c, t in rows if c is not None and i % 3 != fold]
        known = {w for _, t in train for w in t}
        for smoothing in (0.5, 1.0):
            for i, c, t in rows:
                if c is None or i % 3 != fold:
                    continue
                scores = []
                for k in (0, 1):
                    own = [w for x, u in train if x == k for w in u]
                    score = math.log((sum(x == k for x, _ in train) + 1) / (len(train) + 2))
                    score += sum(math.log((own.count(w) + smoothing) / (len(own) + smoothing * len(known))) for w in t if w in known)
                    scores.append(score)
                want.append((fold, smoothing, c, int(scores[1] > scores[0])))
    assert sorted(map(tuple, found.select("fold", "smoothing", "class", "prediction").collect())) == sorted(want)
    one = weighted_f1(found.where("fold = 1 and smoothing = 1.0")).head()
    assert weighted_f1_by(found, ["fold", "smoothing"]).where("fold = 1 and smoothing = 1.0").head()[2:] == tuple(one)
    assert terms.cross_validated_bayes(frame.where("class is null"), "class", F.lit(0), 3, [1.0]).count() == 0


def test_cross_validation_looks_up_its_counts(spark):
    rows = [(i, i % 2, [f"w{i % 5}", "all"]) for i in range(30)]
    frame = spark.createDataFrame(rows, "id int, class int, tokens array<string>")
    found = terms.cross_validated_bayes(frame, "class", F.col("id") % 3, 3, [0.5])
    assert found.count() == 30
    # Counts of other folds are added up once a token, not once for each of its occurrences.
    assert "concat_ws" not in found._jdf.queryExecution().optimizedPlan().toString()


def group_rows(spark):
    dice = random.Random(9)
    made = []
    for i in range(300):
        words = [f"w{int(dice.paretovariate(0.7)) % 400}" for _ in range(dice.choice([0, 1, 2, 5, 60]))]
        made.append((i if i % 40 else None, dice.choice(["a", "a", "a", "b", None]), words))
    # A group of fewer entries than are asked for, equal rows, and one with weights of 0 alone.
    made += [(900, "c", ["rare", "w1"]), (901, "d", ["w1"]), (901, "d", ["w1"]), (902, "e", []), (903, "f", None)]
    return spark.createDataFrame(made, "doc_id int, source string, tokens array<string>")


@pytest.mark.parametrize("k", [1, 7, 100])
def test_top_weights_are_the_first_of_all_weights(spark, k):
    rows = group_rows(spark)
    weights = terms.tf_idf(rows).select("source", "doc_id", "token", F.round("tf_idf", 6).alias("tf_idf"))
    order = [F.desc("tf_idf"), F.asc("token"), F.asc("doc_id")]
    key = lambda r: tuple(str(x) for x in r)
    expected = terms.top_per_group(weights, "source", order, ["doc_id", "token"], k).collect()
    found = terms.top_weights(rows, "source", ["doc_id"], k).select("source", "doc_id", "token", "tf_idf", "rank").collect()
    assert sorted(map(key, found)) == sorted(map(key, expected))


def test_top_weights_rank_few_entries(spark, monkeypatch):
    dice = random.Random(2)
    made = [(i, "a", [f"w{dice.randrange(2000)}" for _ in range(2 if i % 5 == 0 else 100)]) for i in range(200)]
    rows = spark.createDataFrame(made, "doc_id int, source string, tokens array<string>")
    ranked, top = [], terms.top_per_group
    monkeypatch.setattr(terms, "top_per_group", lambda found, *more: ranked.append(found.count()) or top(found, *more))
    assert terms.top_weights(rows, "source", ["doc_id"], 5).count() == 5
    # Before, all 16,000 entries were ranked.
    assert len(ranked) == 2 and max(ranked) < 200


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("weights", [terms.tf_idf, lambda rows: terms.tf_idf_by_pair(rows, "doc_id")])
def test_many_weights_are_joined_without_a_sort(spark, corpus, monkeypatch, weights):
    order = ["doc_id", "token"]
    columns = ["doc_id", "token", "tf", "idf", "tf_idf"]
    expected = weights(corpus).select(columns).orderBy(order).collect()
    monkeypatch.setattr(terms, "HASHED_TOKENS", 0)
    found = weights(corpus)
    joins = re.findall(r"\w+Join", plan_of(found))
    assert joins[0] == "ShuffledHashJoin"
    assert found.select(columns).orderBy(order).collect() == expected


def test_joined_weights_of_repeated_and_missing_keys(spark, monkeypatch):
    rows = [(1, ["a", "b", "a"]), (1, ["a"]), (None, ["a", "c"]), (2, []), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id int, tokens array<string>")
    columns = ["doc_id", "token", "tf", "idf"]
    expected = [(1, "a", 2 / 3, 3)] * 2 + [(1, "a", 1.0, 3)] * 2 + [(1, "b", 1 / 3, 1)]
    for limit in (terms.HASHED_TOKENS, 0):
        monkeypatch.setattr(terms, "HASHED_TOKENS", limit)
        found = sorted(tuple(r) for r in terms.tf_idf_by_pair(frame, "doc_id").select(columns).collect())
        assert found == sorted((d, t, tf, pytest.approx(math.log(1 / df))) for d, t, tf, df in expected)


def test_rounded_is_round(spark):
    ties = spark.range(40000).select(((F.col("id") + 0.5) / 1e6).alias("x"))
    shares = spark.range(1, 300).select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda k: k / F.col("id"))).alias("x"))
    odd = spark.createDataFrame([(x,) for x in (None, math.nan, math.inf, -math.inf, -0.0, -1.2345675, 1e-9, 999.9999995, 1e3, 123456789.1234565, 1e300)], "x double")
    both = ties.union(shares).union(odd).withColumn("found", rounded(F.col("x")))
    assert both.where(~F.col("found").eqNullSafe(F.round("x", 6))).collect() == []


def test_a_bag_takes_one_pass_over_the_tokens(corpus):
    plan = terms.term_bags(corpus)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction") == 1 and plan.count("sort_array") == 1
