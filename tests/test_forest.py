"""The random forest on token tables."""

import inspect
import math
import random
from types import CodeType

import pytest

from inkwell.learning import forest, linear, logistic
from inkwell.operators import terms
from inkwell.plans import catalog, jobs


@pytest.fixture(scope="module")
def documents(spark):
    dice = random.Random(4)
    rows = []
    for i in range(400):
        side = int(i % 5 < 2)
        words = [f"w{dice.randrange(30)}" for _ in range(12)] + ["all"] * 3
        # Marked by several tokens, one of them by its count.
        words += [f"mark{k}" for k in range(12) if dice.random() < (0.8 if side else 0.05)] + ["often"] * (4 if side else 1)
        rows.append((i % 390, side, " ".join(words)))
    return spark.createDataFrame([*rows, (None, 0, "")], "doc_id int, class int, review string").repartition(3)


def grown(documents):
    tokenized = terms.with_tokens(documents)
    idf = linear.smoothed_idf(tokenized)
    blocks = forest.features(tokenized, idf)
    return blocks, forest.fit(blocks, "class"), {r.token: r.idf for r in idf.collect()}


@pytest.mark.parametrize("block", [50, 1 << 19])
def test_a_forest_is_whole_and_predicts(documents, monkeypatch, block):
    monkeypatch.setattr(linear, "BLOCK", block)
    blocks, model, idf = grown(documents)
    nodes = {(r.tree, r.node): r for r in model.collect()}
    assert {t for t, _ in nodes} == set(range(forest.TREES)) and max(n for _, n in nodes) < forest.NUMBERS
    for (tree, node), r in nodes.items():
        assert r.p0 + r.p1 == pytest.approx(1)
        children = [(tree, 2 * node) in nodes, (tree, 2 * node + 1) in nodes]
        assert children == [r.token is not None] * 2
        if r.token is not None:
            count = r.threshold / idf[r.token]
            assert count == pytest.approx(math.floor(count) + 0.5) and r.token not in ("", "all")
    found = forest.predictions(model, blocks).collect()
    assert len(found) == 401 and sum(r.prediction == r["class"] for r in found) > 380
    # Every row by hand, from its tokens.
    wanted = []
    for r in terms.bags_in_rows(terms.with_tokens(documents)).collect():
        weights, votes = {t.token: t.value * idf[t.token] for t in r.terms}, 0.0
        for tree in range(forest.TREES):
            node = 1
            while nodes[tree, node].token is not None:
                node = 2 * node + (weights.get(nodes[tree, node].token, 0.0) > nodes[tree, node].threshold)
            votes += nodes[tree, node].p1 - nodes[tree, node].p0
        wanted.append((r.doc_id, r["class"], float(votes > 0)))
    key = lambda r: (r[0] is not None, r)
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)


def test_the_split_with_the_most_gain(spark):
    rows = [(1, "a", 1, 1.0, 2.0, 3.0), (1, "a", 4, 1.0, 0.0, 5.0), (1, "b", 1, 1.0, 9.0, 1.0), (2, "a", 1, 1.0, 1.0, 1.0)]
    sums = spark.createDataFrame(rows, "node int, token string, bin int, idf double, n0 double, n1 double")
    totals = spark.createDataFrame([(1, 10.0, 10.0), (2, 2.0, 2.0)], "node int, t0 double, t1 double")

    def gini(a, b):
        return 1 - (a * a + b * b) / (a + b) ** 2

    def gain(r0, r1):
        l0, l1 = 10 - r0, 10 - r1
        return 0.5 - (l0 + l1) / 20 * gini(l0, l1) - (r0 + r1) / 20 * gini(r0, r1)

    best = max([("a", 1, 2, 8), ("a", 4, 0, 5), ("b", 1, 9, 1)], key=lambda s: gain(s[2], s[3]))
    assert [(r.node, r.token, r.bin, r.r0, r.r1) for r in forest._best(sums, totals).collect()] == [(1, *best)]


def test_models_are_saved_and_loaded_without_a_vocabulary_on_the_driver(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    wanted = catalog.QUERIES["model_roundtrip"](spark, folder)
    monkeypatch.setattr(logistic, "DRIVER_TERMS", 0)
    monkeypatch.setattr(catalog.L, "fit_tfidf", None)
    found = catalog.QUERIES["model_roundtrip"](spark, folder)
    assert found.columns == wanted.columns and sorted(found.collect()) == sorted(wanted.collect())


def test_loaded_models_that_differ_are_told(spark, documents, monkeypatch):
    tokenized = terms.with_tokens(documents.where("doc_id is not null"))
    sizes = tokenized.groupBy("doc_id").count().collect()
    load = jobs.load_tables
    for at, column in ((1, "same_logistic"), (2, "same_forest")):

        def other(*arguments, at=at):
            tables = list(load(*arguments))
            tables[at] = tables[at].limit(0) if at == 1 else tables[at].withColumn("p1", 1 - tables[at]["p1"]).withColumn("p0", 1 - tables[at]["p0"])
            return tables

        monkeypatch.setattr(jobs, "load_tables", other)
        found = jobs.table_roundtrip(tokenized, "doc_id", "class").collect()
        # Rows that share a key meet each other, as in a join by key.
        assert len(found) == sum(r["count"] ** 2 for r in sizes) and not all(r[column] for r in found)


@pytest.mark.parametrize("module", [forest, logistic])
def test_tasks_name_no_module_of_the_package(module):
    def inner(code, task):
        assert not task or "linear" not in code.co_names, code.co_name
        for c in code.co_consts:
            if isinstance(c, CodeType):
                inner(c, task or "batches" in c.co_varnames[: c.co_argcount])

    for _, function in inspect.getmembers(module, inspect.isfunction):
        inner(function.__code__, False)
    inner(logistic._Rows.__init__.__code__, False)
