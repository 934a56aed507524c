from hashlib import md5

import pytest
from pyspark.sql import functions as F

from inkwell.operators import sample


def test_split_is_disjoint_complete_and_stable(spark):
    rows = spark.range(5000).withColumn("c", F.col("id") % 3)
    train, test = sample.split(rows, "id")
    a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
    assert not a & b and len(a | b) == 5000 and 0.77 < len(a) / 5000 < 0.83
    again, _ = sample.split(rows.repartition(9), "id")
    assert {r.id for r in again.collect()} == a
    other, _ = sample.split(rows, "id", seed=81)
    assert {r.id for r in other.collect()} != a


@pytest.mark.parametrize("m", [1, 5, 10, 101])
def test_systematic_sample_equals_the_loop(spark, m):
    sizes = {0: 400, 1: 37, 2: 9}
    rows = [(c, c * 1000 + i, float(i * 7 % 31)) for c, n in sizes.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "class int, id int, v double")
    found = {}
    for part in (frame, frame.repartition(7)):
        drawn = sample.systematic_sample(part, "id", "v", "class", (0, 1), m)
        found = {(r["class"], r.j): (r.id, r.v) for r in drawn.collect()}
        expected = {}
        for c in (0, 1):
            listed = sorted((r for r in rows if r[0] == c), key=lambda r: md5(str(r[1]).encode()).hexdigest())
            step = max(len(listed) // m, 1)
            for j, r in enumerate(listed[::step][:m]):
                expected[c, j] = r[1:]
        assert found == expected


def test_sorted_curve_rises_over_the_grid(spark):
    rows = spark.createDataFrame([(0, 0.9), (0, 0.1), (0, 0.5), (1, 1.0)], "class int, y double")
    found = sample.sorted_curve(rows, "y", "class", 5).orderBy("class", "j").collect()
    assert [(r["class"], r.j, r.x, r.y) for r in found] == [
        (0, 0, 0.0, 0.1), (0, 1, 0.25, 0.5), (0, 2, 0.5, 0.9), (1, 0, 0.0, 1.0),
    ]


def test_bounded_scan_and_pick(spark):
    rows = spark.range(100).repartition(6)
    assert [r.id for r in sample.first_rows(rows, "id", 3).collect()] == [0, 1, 2]
    first = min(range(100), key=lambda i: md5(f"7:{i}".encode()).hexdigest())
    assert sample.pick_one(rows, "id", 7).first().id == first


def test_null_keys_and_whole_samples_lose_no_row(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,), (None,)], "id int")
    train, test = sample.split(rows, "id")
    assert train.count() + test.count() == 4
    assert sample.split(rows, "id", 1.0)[0].count() == 4
