import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from inkwell.operators import order, profile


def test_running_totals_over_several_ranges(many_partitions):
    dice = random.Random(1)
    rows = [(g, i, dice.randrange(9)) for g in ("a", "b", "c") for i in range(200 if g == "a" else 20)]
    frame = many_partitions.createDataFrame(rows, "g string, x int, n int").repartition(5)
    found = order.running_totals(frame, "x", ["n"], ["g"])
    assert found.columns == ["g", "x", "n", "upto_n", "all_n"]
    for r in found.collect():
        assert r.upto_n == sum(n for g, x, n in rows if g == r.g and x <= r.x)
        assert r.all_n == sum(n for g, x, n in rows if g == r.g)


@pytest.mark.parametrize("steps", [1, 4, 7, 100, 1000])
def test_quantiles_equal_numpy(many_partitions, steps):
    dice = random.Random(steps)
    groups = {
        "many": [dice.gauss(0, 1) for _ in range(500)],
        "ties": [float(dice.randrange(4)) for _ in range(300)],
        "two": [1.0, 5.0],
        "one": [3.0],
        None: [2.0, 8.0, 4.0],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("one", None)]
    frame = many_partitions.createDataFrame(rows, "g string, v double").repartition(4)
    found = order.quantile_grid(frame, "v", steps, ["g"]).collect()
    assert len(found) == len(groups) * (steps + 1)
    for r in found:
        assert r.quantile == pytest.approx(np.quantile(groups[r.g], r.j / steps), abs=1e-9)
        assert r.p == pytest.approx(r.j / steps)


def test_only_wanted_ranges_are_summed(many_partitions):
    frame = many_partitions.range(1000).withColumn("n", F.lit(1).cast("bigint"))
    some = order.running_totals(frame, "id", ["n"], wanted=F.col("before_n") == 0).collect()
    assert 0 < len(some) < 1000
    assert all(r.upto_n == r.id + 1 and r.all_n == 1000 for r in some)


def test_quantiles_without_groups(many_partitions):
    frame = many_partitions.range(101)
    found = {r.j: r.quantile for r in order.quantile_grid(frame, "id", 4).collect()}
    assert found == {0: 0, 1: 25, 2: 50, 3: 75, 4: 100}


def test_describe_equals_pandas(spark):
    dice = random.Random(8)
    frame = spark.createDataFrame([(dice.random(), dice.randrange(5)) for _ in range(400)], "x double, y int")
    expected = frame.toPandas().describe()
    for r in profile.describe(frame, ["x", "y"]).collect():
        mine = [r["count"], r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]]
        assert mine == pytest.approx(list(expected[r["column"]]))


def test_label_codes_follow_label_order(many_partitions):
    rows = [("b",), ("a",), ("b",), ("c",), (None,)]
    frame = many_partitions.createDataFrame(rows, "label string")
    found = order.encode_labels(frame, "label").collect()
    assert sorted(map(tuple, found), key=str) == [("a", 0), ("b", 1), ("b", 1), ("c", 2), (None, None)]
    flags = many_partitions.createDataFrame([(True,), (False,)], "flag boolean")
    assert {r.flag: r.code for r in order.encode_labels(flags, "flag").collect()} == {False: 0, True: 1}


def test_auc_counts_ties_as_half(many_partitions):
    dice = random.Random(6)
    rows = [(dice.randrange(2), float(dice.randrange(12))) for _ in range(300)]
    frame = many_partitions.createDataFrame(rows, "label int, score double").repartition(4)
    pairs = [(p > n) + 0.5 * (p == n) for a, p in rows if a == 1 for b, n in rows if b == 0]
    expected = sum(pairs) / len(pairs)
    assert order.area_under_roc(frame, "label", "score").first()["auc"] == pytest.approx(expected)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderROC", numBins=0)
    assert evaluator.evaluate(frame) == pytest.approx(expected)


def test_auc_of_one_class_is_null(spark):
    frame = spark.createDataFrame([(1, 0.5)], "label int, score double")
    assert order.area_under_roc(frame, "label", "score").first()["auc"] is None


def test_scaling(spark):
    frame = spark.createDataFrame([(0, 2), (0, 4), (0, 3), (1, 7), (2, 1)], "class int, v int")
    found = profile.scale_by_class(frame, "v", "class").collect()
    # A class with one value has no range: null, where the division would fail.
    assert sorted(map(str, found)) == sorted(
        map(str, spark.createDataFrame([(0, 2, 0.0), (0, 4, 1.0), (0, 3, 0.5), (1, 7, None), (2, 1, None)], "class int, v int, scaled double").collect())
    )
    assert sorted(r.scaled for r in profile.scale(frame, "v").collect()) == pytest.approx([0, 1 / 6, 1 / 3, 0.5, 1])


def test_null_counts_and_correlation(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 1.0)], "x double, y double")
    assert {r["column"]: r.nulls for r in profile.null_counts(frame).collect()} == {"x": 1, "y": 0}
    full = frame.where(F.col("x").isNotNull())
    found = {(r.x, r.y): r.r for r in profile.correlation_matrix(full, ["x", "y"]).collect()}
    assert found["x", "y"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])
    assert found["x", "x"] == pytest.approx(1) and found["y", "x"] == found["x", "y"]


def test_mean_total_length(spark):
    frame = spark.createDataFrame(
        [("r1", True, 4), ("r1", True, 6), ("r2", False, 3), ("r3", False, 5)], "review_id string, has_spoiler boolean, length int"
    )
    found = profile.mean_total_length(frame, "review_id", "has_spoiler").collect()
    assert {r.has_spoiler: r.avg_length for r in found} == {True: 10.0, False: 4.0}
