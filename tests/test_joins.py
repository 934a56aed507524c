import random

import pytest
from pyspark.sql import functions as F

from inkwell.operators.joins import enrich
from inkwell.operators.profile import flag_ratio
from inkwell.plans.jobs import ratio_features


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key; some have none."""
    dice = random.Random(3)
    rows = [
        (i, None if i % 50 == 0 else "hot" if i % 3 == 0 else f"k{dice.randrange(120)}", dice.random() < 0.3)
        for i in range(3000)
    ]
    return spark.createDataFrame(rows, "id int, key string, flag boolean").repartition(5).cache()


def test_enrich_keeps_hot_and_long_keys(spark, skewed):
    stats = flag_ratio(skewed, "key", "flag").where("key is not null")
    assert enrich(skewed, stats, "key").count() == skewed.where("key is not null").count()
    assert enrich(skewed, stats, "key", "left").count() == 3000
    rows = spark.createDataFrame([("x" * 500,)] * 50 + [("a",), ("b",)], "key string")
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    assert enrich(rows, counts, "key").groupBy("key").count().count() == 3


def test_ratio_features_keep_all_rows(spark):
    rows = spark.createDataFrame([(1, "b1", "u1", True), (2, None, "u2", False), (3, "b9", None, True)], "id int, book string, user string, flag boolean")
    found = ratio_features(rows, rows.where("id = 1"), ("book", "user"), "flag").collect()
    assert {r.id: (r.book_ratio, r.user_ratio) for r in found} == {1: (1.0, 1.0), 2: (None, None), 3: (None, None)}


def test_ratio_features_can_be_learned_from_train_rows_only(spark):
    rows = spark.createDataFrame(
        [(1, "b1", "u1", True), (2, "b1", "u2", False), (3, "b2", "u1", True), (4, "b1", "u1", False)],
        "id int, book string, user string, flag boolean",
    )
    found = ratio_features(rows, rows.where("id < 4"), ("book", "user"), "flag").collect()
    assert {r.id: (r.book_ratio, r.user_ratio) for r in found} == {
        1: (0.5, 1.0), 2: (0.5, 0.0), 3: (1.0, 1.0), 4: (0.5, 1.0),
    }
