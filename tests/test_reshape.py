import random

import pytest
from pyspark.sql import functions as F

from inkwell.learning.features import with_clean_review
from inkwell.operators import joins, profile, reshape


def test_explode_keeps_order_and_drops_empty_reviews(toy_reviews):
    rows = reshape.explode_sentences(toy_reviews).collect()
    found = {(r.review_id, r.pos): (r["class"], r.reviews) for r in rows}
    assert found["r1", 1] == ("1", "He's dead, Jim!")
    assert found["r4", 2] == (None, "No class")
    assert found["r4", 3] == ("1", None)
    assert {r.review_id for r in rows} == {"r1", "r2", "r4"}


EXPECTED = {
    ("r1", "0"): "Hello  there. Bye.",
    ("r1", "1"): "He's dead, Jim!",
    ("r2", "0"): "...",
    ("r4", "0"): "Fine",
    ("r4", None): "No class",
    ("r4", "1"): "",
}


def test_nested_and_flat_assembly_agree(toy_reviews):
    nested = reshape.assemble_nested(toy_reviews).collect()
    flat = reshape.assemble_reviews(reshape.explode_sentences(toy_reviews)).collect()
    for rows in (nested, flat):
        assert {(r.review_id, r["class"]): r.review for r in rows} == EXPECTED


def test_clean_toy_documents(toy_reviews):
    rows = with_clean_review(reshape.assemble_nested(toy_reviews)).collect()
    clean = {(r.review_id, r["class"]): r.review for r in rows}
    assert clean["r1", "0"] == "hello  there bye"
    assert clean["r1", "1"] == "hes dead jim"
    assert clean["r2", "0"] == ""


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_assembly_does_not_depend_on_blocks_or_partitions(many_partitions, block):
    spark = many_partitions
    rows = [(f"r{i % 3 if i % 2 else 0}", i, str(i % 2), None if i % 7 == 0 else f"s{i}") for i in range(300)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "review_id string, pos int, class string, reviews string").repartition(7)
    expected = {}
    for r, p, c, t in sorted(rows, key=lambda x: x[1]):
        expected.setdefault((r, c), []).extend([t] if t else [])
    found = reshape.assemble_reviews(frame, block=block).collect()
    assert {(r.review_id, r["class"]): r.review for r in found} == {k: " ".join(v) for k, v in expected.items()}


def test_left_join_multiplies_and_keeps_unmatched(spark):
    documents = spark.createDataFrame(
        [("a", "0", "x"), ("b", "0", "y"), ("c", "1", "z"), (None, "1", "n")], "review_id string, class string, review string"
    )
    reviews = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("q", 5)], "review_id string, rating int")
    mine = joins.attach_reviews(documents, reviews)
    plain = documents.join(reviews, "review_id", "left")
    assert mine.columns == plain.columns
    assert sorted(map(str, mine.collect())) == sorted(map(str, plain.collect()))


def test_a_hot_review_is_split(spark):
    """With small thresholds standing for a large table, AQE cuts the hot key."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        ids = F.concat(F.lit("k"), F.col("id") % 20_000)
        documents = spark.range(20_000).select(ids.alias("review_id"), F.lit("0").alias("class"))
        reviews = spark.range(120_000).select(
            F.when(F.col("id") % 3 == 0, "k7").otherwise(ids).alias("review_id"), F.md5(F.col("id").cast("string")).alias("user_id")
        )
        found = joins.attach_reviews(documents, reviews).agg(F.count("user_id"), F.max("user_id"))
        assert found.collect()[0][0] == 120_000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_complement(spark):
    rows = spark.range(10)
    assert sorted(r.id for r in joins.complement(rows, rows.where("id < 4"), "id").collect()) == list(range(4, 10))


def test_split_comments(spark):
    comments = spark.createDataFrame([(1, "A b. C\n D. "), (2, None)], "id int, text string")
    rows = reshape.split_comments(comments).orderBy("id", "line", "part").collect()
    # Each line is stripped before it is split, so the last full stop stays.
    assert [(r.id, r.line, r.part, r.review) for r in rows] == [(1, 0, 0, "A b"), (1, 0, 1, "C"), (1, 1, 0, "D.")]


def test_counts_are_keyed_and_have_a_total(toy_reviews):
    rows = profile.class_counts(reshape.assemble_nested(toy_reviews)).collect()
    found = {(r["class"], r.is_total): r.n for r in rows}
    assert found == {(0, 0): 3, (1, 0): 2, (None, 0): 1, (None, 1): 6}


def test_class_text_that_is_no_number_is_null(spark):
    rows = profile.class_counts(spark.createDataFrame([("x",), ("1",)], "class string")).collect()
    assert {(r["class"], r.is_total): r.n for r in rows} == {(None, 0): 1, (1, 0): 1, (None, 1): 2}
