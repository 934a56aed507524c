import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.learning import features, topics
from inkwell.learning.special import digamma, trigamma


def test_special_functions():
    assert digamma(np.array([1.0, 0.5])) == pytest.approx([-0.5772156649015329, -1.9635100260214235], abs=1e-13)
    assert trigamma(np.array([1.0, 0.5])) == pytest.approx([np.pi**2 / 6, np.pi**2 / 2], abs=1e-12)
    x = np.array([1e-3, 0.05, 3.0, 40.0, 1e6])
    assert digamma(x + 1) - digamma(x) == pytest.approx(1 / x, rel=1e-9)


def one_by_one(counts, share, start, prior):
    """MLlib's loop for one document."""
    expected = lambda g: np.exp(digamma(g) - digamma(g.sum()))
    found, moved = start, 1.0
    held = expected(found)
    while moved > topics.SETTLED:
        last, found = found, held * (share.T @ (counts / (share @ held + 1e-100))) + prior
        held = expected(found)
        moved = np.abs(found - last).mean()
    return found, np.outer(counts / (share @ held + 1e-100), held) * share


def test_shares_settle_as_they_do_one_document_at_a_time():
    rng = np.random.default_rng(1)
    sizes = [3, 1, 40, 7, 400]
    starts = np.cumsum([0, *sizes[:-1]])
    counts, share = rng.gamma(1.0, 5.0, sum(sizes)), rng.random((sum(sizes), 3)) * 0.01
    start, prior = rng.gamma(100.0, 0.01, (len(sizes), 3)), np.array([0.2, 0.3, 0.5])
    found, adds = topics.settle(starts, counts, share, start, prior)
    for d, (a, n) in enumerate(zip(starts, sizes)):
        own, added = one_by_one(counts[a : a + n], share[a : a + n], start[d], prior)
        assert found[d] == pytest.approx(own) and adds[a : a + n] == pytest.approx(added)


def groups(spark, rows=400):
    both = [["dragon", "king", "sword"], ["cover", "print", "paper"]]
    made = [(i if i % 50 else None, both[i % 2] * 4 + [f"word{i}", f"other{i}"]) for i in range(rows)]
    return spark.createDataFrame([*made, (1, []), (2, None)], "doc_id int, tokens array<string>")


def test_topics_are_the_two_groups_on_any_layout(spark):
    found = []
    for parts in (1, 5):
        model = topics.fit(groups(spark).repartition(parts), "doc_id", rounds=30)
        assert model.weights.count() == 6 + 800
        top = topics.heaviest(model, 3).collect()
        assert [(r["topic"], r["rank"]) for r in top] == [(t, k) for t in (0, 1) for k in range(3)]
        sets = [{r["token"] for r in top if r["topic"] == t} for t in (0, 1)]
        assert sorted(map(sorted, sets)) == [["cover", "paper", "print"], ["dragon", "king", "sword"]]
        assert sum(topics.heaviest(model, 10_000).toPandas()["weight"]) == pytest.approx(2)
        found.append([(r["topic"], r["token"], pytest.approx(r["weight"])) for r in top])
    assert found[0] == found[1]


def test_no_token_gives_no_topic(spark):
    assert topics.heaviest(topics.fit(groups(spark).where("doc_id = 0"), "doc_id")).count() == 0


def test_the_query_takes_more_tokens_than_a_vector_has_room_for(spark, tmp_path, monkeypatch):
    from inkwell.plans import catalog

    monkeypatch.setattr(features, "VOCABULARY", 50)
    monkeypatch.setattr(catalog, "DRIVER_TERMS", 50, raising=False)
    texts = [(i, f"dragon king falls w{i}x w{i}y", "en", "src1", 20) for i in range(200)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = catalog.lda_topics(spark, str(tmp_path))
    assert found.columns == ["topic", "rank", "weight", "token"] and found.count() == 20
    assert found.where(F.col("weight") <= 0).count() == 0
