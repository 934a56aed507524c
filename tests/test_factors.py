"""Co-occurrence, latent factors, kernel maps, lines kept aside and item lookup against plain versions."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from inkwell.learning import classifiers, cooccurrence, factors, features, kernel
from inkwell.operators import evaluate, sample, terms
from inkwell.plans import catalog
from inkwell.sources import files, tables

FOLDER = "/root/testdata/sf0.001"


def test_pairs_and_their_information(spark):
    texts = [["a", "b", "a", "c"], ["b", None, "b"], [], None, ["d"], ["a", "b", "a", "c"]]
    found = spark.createDataFrame([(t,) for t in texts], "tokens array<string>")
    plain = Counter()
    for tokens in filter(None, texts):
        for i, a in enumerate(tokens):
            for j, b in enumerate(tokens):
                if i != j and abs(i - j) <= 2 and a and b:
                    plain[a, b] += 1
    got = {(r.token, r.context): r.n for r in cooccurrence.pair_counts(found, 2).collect()}
    assert got == dict(plain)
    single = Counter()
    for (a, _), n in plain.items():
        single[a] += n
    total = sum(single.values())
    pmi = {p: math.log(n * total / (single[p[0]] * single[p[1]])) for p, n in plain.items()}
    got = {(r.token, r.context): r.pmi for r in cooccurrence.positive_pmi(found, 2).collect()}
    assert got.keys() == {p for p, x in pmi.items() if x > 0}
    assert all(abs(got[p] - pmi[p]) < 1e-12 for p in got)
    assert cooccurrence.positive_pmi(found.where("false")).count() == 0


def check_factors(found, dense, row_keys, column_keys, row, column, size):
    """Values, vectors and signs against numpy."""
    u, s, vt = np.linalg.svd(dense, full_matrices=False)
    np.testing.assert_allclose(found.values, s[:size], rtol=0, atol=1e-6 * s[0])
    left = {r[row]: r.factors for r in found.rows.collect()}
    right = {r[column]: r.factors for r in found.columns.collect()}
    a = np.array([left.get(k, [0.0] * size) for k in row_keys])
    b = np.array([right.get(k, [0.0] * size) for k in column_keys])
    # The factors give the best approximation of their rank, and are orthonormal.
    best = (u[:, :size] * s[:size]) @ vt[:size]
    np.testing.assert_allclose((a * found.values) @ b.T, best, atol=1e-4 * s[0])
    np.testing.assert_allclose(b.T @ b, np.eye(size), atol=1e-8)
    assert ((b**3).sum(0) > 0).all()


def test_factors_of_the_documents_equal_numpy(spark):
    documents = tables.table(spark, FOLDER, "documents").count()
    weights = terms.smoothed_weights(catalog._tokenized(spark, FOLDER), "doc_id", documents)
    rows = weights.toPandas()
    dense = rows.pivot_table(index="doc_id", columns="token", values="weight", aggfunc="sum", fill_value=0.0)
    found = factors.truncated_svd(weights, "doc_id", "token", "weight", 5)
    check_factors(found, dense.to_numpy(float), list(dense.index), list(dense.columns), "doc_id", "token", 5)


def test_factors_do_not_follow_the_partitions(spark):
    rng = np.random.default_rng(1)
    dense = rng.normal(size=(30, 12)) * np.geomspace(1, 0.01, 12)
    entries = spark.createDataFrame([(int(i), int(j), float(dense[i, j])) for i in range(30) for j in range(12)], "r int, c int, x double")
    one = factors.truncated_svd(entries.coalesce(1), "r", "c", "x", 3)
    many = factors.truncated_svd(entries.repartition(7), "r", "c", "x", 3)
    check_factors(one, dense, range(30), range(12), "r", "c", 3)
    np.testing.assert_allclose(one.values, many.values, rtol=1e-12)
    both = one.rows.join(many.rows.withColumnRenamed("factors", "other"), "r").collect()
    assert len(both) == 30
    for r in both:
        np.testing.assert_allclose(r.factors, r.other, atol=1e-7)


def test_factors_of_odd_tables(spark):
    schema = "r string, c string, x double"
    empty = factors.truncated_svd(spark.createDataFrame([], schema), "r", "c", "x", 2)
    assert empty.values == () and empty.rows.count() == 0 and empty.columns.columns == ["c", "factors"]
    # Rank 1, with a repeated entry and entries that do not count.
    rows = [("a", "x", 1.0), ("a", "x", 2.0), ("a", "y", 4.0), (None, "x", 1.0), ("b", None, 1.0), ("b", "x", None), ("b", "y", float("nan")), ("c", "y", 0.0)]
    found = factors.truncated_svd(spark.createDataFrame(rows, schema), "r", "c", "x", 2)
    np.testing.assert_allclose(found.values, [5.0])
    assert [(r.r, round(r.factors[0], 9)) for r in found.rows.collect()] == [("a", 1.0)]
    assert {r.c: round(r.factors[0], 9) for r in found.columns.collect()} == {"x": 0.6, "y": 0.8}


def test_factors_of_many_blocks(spark, monkeypatch):
    """Blocks of a few entries, a row longer than a block, and shards of a few columns."""
    for name, number in (("BLOCK", 16), ("LEAST", 8), ("SHARD", 16), ("LEAST_PLACES", 4), ("_CHUNK", 5)):
        monkeypatch.setattr(factors, name, number)
    rng = np.random.default_rng(5)
    dense = rng.normal(size=(25, 90)) * (rng.random((25, 90)) < 0.08)
    dense[3] = rng.normal(size=90)
    entries = [(f"r{i}", int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    made = spark.createDataFrame(entries, "r string, c int, x double")
    for passes in (1, 20):
        found = factors.truncated_svd(made, "r", "c", "x", 3, passes=passes)
        if passes > 1:
            check_factors(found, dense, [f"r{i}" for i in range(25)], range(90), "r", "c", 3)
        right = np.array([r.factors for r in found.columns.collect()])
        np.testing.assert_allclose(right.T @ right, np.eye(3), atol=1e-8)


def test_the_start_is_the_hash_that_sql_gives(spark):
    keys = spark.createDataFrame([("",), ("a",), ("\u00e4 long word",)], "k string")
    rows = keys.selectExpr("xxhash64(k) as code", *factors._start_of("k", 4)).collect()
    np.testing.assert_array_equal(factors._start(np.array([r[0] for r in rows]), 4), [r[1:] for r in rows])


def test_word_vectors_leave_no_pairs(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from inkwell.session import shared_dir

    folder = Path(urlparse(shared_dir(spark)).path)
    there = lambda: {p.name for n in ("pairs", "single", "words", "entries", "blocks") for p in folder.glob(f"{n}-*")}
    old = there()
    texts = spark.createDataFrame([(["a", "b", "c"],), (["a", "c", "c"],)], "tokens array<string>")
    assert cooccurrence.word_vectors(texts, 1, 2).rows.count()
    assert there() == old


def test_word_vectors_bring_like_words_together(spark):
    # cat and dog never meet, but have the same neighbours; so have car and bus.
    texts = [[w, "fur", "purr"] for w in ("cat", "dog")] * 20 + [[w, "road", "wheel"] for w in ("car", "bus")] * 20
    found = cooccurrence.word_vectors(spark.createDataFrame([(t,) for t in texts], "tokens array<string>"), 2, 2)
    vector = {r.token: np.array(r.factors) for r in found.rows.collect()}
    like = lambda a, b: vector[a] @ vector[b] / np.linalg.norm(vector[a]) / np.linalg.norm(vector[b])
    assert like("cat", "dog") > 0.99 and like("car", "bus") > 0.99 and abs(like("cat", "car")) < 0.2


def test_mapped_products_are_near_the_kernel(spark):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(40, 3))
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, x array<double>")
    fourier = kernel.FourierMap(3, 0.5, 4096)
    z = np.array([r.z for r in rows.select("id", fourier.of("x").alias("z")).orderBy("id").collect()])
    exact = np.exp(-0.5 * ((points[:, None] - points[None]) ** 2).sum(-1))
    # Five standard deviations of a mean of 4096 draws.
    assert np.abs(z @ z.T - exact).max() < 5 / math.sqrt(4096)
    ways, shifts = fourier.drawn()
    np.testing.assert_allclose(z, np.sqrt(2 / 4096) * np.cos(points @ ways.T + shifts), atol=1e-12)
    odd = spark.createDataFrame([(0, None), (1, [1.0, None, 2.0]), (2, [1.0]), (3, [1.0, 2.0, float("nan")]), (4, [1.0, 2.0, 3.0])], rows.schema)
    assert [r.id for r in kernel.mapped(odd, "x", fourier).select("id").collect()] == [4]


def test_a_ring_needs_the_kernel(spark):
    rng = np.random.default_rng(3)
    turn, far = rng.uniform(0, 2 * np.pi, 400), np.where(np.arange(400) % 2, 2.0, 0.7) + rng.normal(0, 0.15, 400)
    points = [(i, [float(r * math.cos(t)), float(r * math.sin(t))], i % 2) for i, (r, t) in enumerate(zip(far, turn))]
    rows = spark.createDataFrame(points, "id int, x array<double>, class int")

    def f1(found, estimator):
        train, test = sample.split(found, "id")
        return evaluate.weighted_f1(estimator.fit(train).transform(test)).first().weighted_f1

    assert f1(kernel.mapped(rows, "x", kernel.FourierMap(2, 1.0, 64)), kernel.kernel_svc()) > 0.95
    assert f1(features.dense_features(rows, "x"), classifiers.linear_svc("features")) < 0.75


def test_each_line_is_read_or_kept_aside(spark, tmp_path):
    lines = [
        '{"review_id": "r1", "rating": 4, "review_sentences": [["0", "Hi"]]}', '{"review_id": "r2"}', "{}",
        '{"review_id": "r3", "unknown": [1]}', '{"review_id": "r4", "rating": null}',
        "", "  \r", '{"review_id": "r5", "rat', "[1, 2]", "null", "12", "text", '{"review_id": "r6", "rating": "five"}',
        '{"review_id": "r7", "has_spoiler": 3}', '{"review_id": "r8", "review_sentences": "none"}',
    ]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.json").write_text("\n".join(lines) + "\n")
    (tmp_path / "a" / "two.json").write_text('{"review_id": "r9"}\n{"cut')
    good, bad = files.read_reviews_apart(spark, str(tmp_path / "a"))
    assert sorted(str(r.review_id) for r in good.collect()) == ["None", "r1", "r2", "r3", "r4", "r9"]
    assert good.columns == files.REVIEW.fieldNames()
    assert good.where("review_id = 'r1'").first().review_sentences == [["0", "Hi"]]
    found = [(r.reason, r.line, r.file.rsplit("/", 1)[1]) for r in bad.collect()]
    of = lambda reason, held, file="one.json": [(reason, x, file) for x in held]
    assert sorted(found) == sorted(
        of(files.EMPTY, lines[5:7]) + of(files.NO_OBJECT, lines[7:12]) + of(files.OTHER_TYPE, lines[12:]) + of(files.NO_OBJECT, ['{"cut'], "two.json")
    )
    assert good.count() + bad.count() == len(lines) + 2


def test_one_item_reads_few_files(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 200)).alias("item")
    )
    path = str(tmp_path / "items")
    files.write_by_item(rows, path, "item", "id")
    every = len(spark.read.parquet(path).inputFiles())
    for item in ("s7", "hot", "missing"):
        found = files.read_item(spark, path, "item", item)
        assert sorted(r.id for r in found.collect()) == sorted(r.id for r in rows.where(F.col("item") == item).collect())
    plan = files.read_item(spark, path, "item", "s7")
    plan.collect()
    scan = plan._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = scan.metrics().apply("numFiles").value()
    assert 0 < read < every / 10
    # The frequent item is spread over several files.
    hot = files.read_item(spark, path, "item", "hot").select(F.input_file_name().alias("f")).distinct().count()
    assert hot > 3


def test_rows_are_laid_out_by_item_in_one_reading(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(2_000).select("id", F.when(F.col("id") % 7 != 0, F.concat(F.lit("s"), F.col("id") % 5)).alias("item"))
    files.write_by_item(rows.mapInArrow(counted, "id bigint, item string"), str(tmp_path / "items"), "item", "id")
    assert read.value == 2_000
    assert spark.read.parquet(str(tmp_path / "items")).count() == 2_000


def test_pairs_are_counted_in_bounded_shares(spark):
    texts = [([f"w{(i * j) % 37}" for j in range(50)],) for i in range(100)] + [([],), (None,)]
    rows = spark.createDataFrame(texts, "tokens array<string>").coalesce(1)
    dealt = cooccurrence.in_shares(rows, 500)
    sizes = dealt.rdd.mapPartitions(lambda part: [sum(len(r[0] or []) for r in part)]).collect()
    assert sum(sizes) == 5_000 and max(sizes) <= 1_000
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))
    counts = lambda of: sorted(map(tuple, cooccurrence.pair_counts(of, 3).collect()))
    assert counts(dealt) == counts(rows)
    assert cooccurrence.in_shares(rows.where("false")).count() == 0


def test_a_pass_leaves_no_images(spark, monkeypatch):
    from pathlib import Path
    from urllib.parse import urlparse

    from inkwell.session import shared_dir

    folder = Path(urlparse(shared_dir(spark)).path)
    there = lambda: {p.name for p in folder.glob("images-*")}
    old, seen, best = there(), [], factors._best
    monkeypatch.setattr(factors, "_best", lambda *given: seen.append(len(there() - old)) or best(*given))
    rng = np.random.default_rng(4)
    entries = [(int(i), int(j), float(rng.normal())) for i in range(30) for j in range(20)]
    made = spark.createDataFrame(entries, "r int, c int, x double")
    factors.truncated_svd(made, "r", "c", "x", 2, spare=1, depth=2, passes=3, tolerance=0.0)
    assert seen == [2, 2, 2] and there() == old
