import random
import tracemalloc
from pathlib import Path

import duckdb
import numpy as np
from helpers import ODD, documents, links, shingles, words

from inkwell.llm import decontam, licenses, ngram_join, queries
from inkwell.llm.sieve import sieve

FOLDER = "/root/testdata/sf0.001"


def changed(rng, base, share):
    return " ".join(w if rng.random() > share else f"w{rng.randrange(10**6)}" for w in base)


def groups_of(rng):
    """Copies, near copies, texts that share a passage, and short ones."""
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    near, loose, passage = new(300), new(300), new(80)
    texts = [changed(rng, near, 0.01) for _ in range(40)] + [changed(rng, loose, 0.03) for _ in range(25)]
    texts += [" ".join(near)] * 10 + [" ".join(new(40) + passage + new(40)) for _ in range(20)]
    return texts + ["one two three", "One, two three!", "one two", "five words are one shingle"] * 2


def check(spark, texts):
    found = ngram_join.classes(documents(spark, texts)).collect()
    assert len(found) == len(texts) + 1
    want = links(texts)
    assert {r["doc_id"]: (r["class_id"], r["links"]) for r in found if r["doc_id"] is not None} == want
    assert [(r["class_id"], r["links"]) for r in found if r["doc_id"] is None] == [(None, 0)]


def test_links_equal_all_pairs(spark):
    check(spark, groups_of(random.Random(3)) + ODD + ODD)


def test_large_buckets_are_split_and_cut(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 12)
    monkeypatch.setattr(ngram_join, "TILE", 6000)
    check(spark, groups_of(random.Random(4)))


def test_join_query_and_empty_table(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())
    want = links([texts[i] for i in range(len(texts))])
    rows = queries.op4_ngram_jaccard_join(spark, FOLDER).collect()
    assert {r["doc_id"]: (r["class_id"], r["links"]) for r in rows} == want
    assert ngram_join.classes(documents(spark, []).limit(0)).count() == 0


def test_texts_under_one_id_are_told_apart(spark):
    rng = random.Random(8)
    a, b = ([f"{x}{rng.randrange(10**6)}" for _ in range(300)] for x in "ab")
    near_a, near_b = changed(rng, a, 0.004), changed(rng, b, 0.004)
    a, b = " ".join(a), " ".join(b)
    rows = [(1, b), (1, a), (2, near_a), (5, near_b), (6, a), (6, a)]
    found = ngram_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    # Each row with the links that unique ids would give it; both classes have 1 as smallest id.
    assert sorted((r["doc_id"], r["class_id"], r["links"]) for r in found) == [
        (1, 1, 1), (1, 1, 3), (2, 1, 3), (5, 1, 1), (6, 1, 3), (6, 1, 3)
    ]
    rows = [(1, a), (1, b), (2, near_a)]
    found = ngram_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"], r["links"]) for r in found) == [(1, 1, 0), (1, 1, 1), (2, 1, 1)]


def test_tables_in_between_are_deleted(spark):
    from inkwell.session import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    result = ngram_join.classes(documents(spark, groups_of(random.Random(2))))
    assert {p.name.split("-")[0] for p in set(folder.iterdir()) - before} == {"classes"}
    assert result.count() > 0


def test_runs_reach_the_recall():
    assert ngram_join.runs_needed(0.999) > ngram_join.runs_needed(0.9) >= 1


def test_sieve_keeps_all_keys(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "'t' AS text")
    kept = {r["doc_id"] for r in sieve(rows, rows.where("doc_id % 100 = 7"), "doc_id").collect()}
    assert {i for i in range(20_000) if i % 100 == 7} <= kept and len(kept) < 260


def edits(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(line[j] + 1, new[-1] + 1, line[j - 1] + (x != y)))
        line = new
    return line[-1]


def test_passages_are_found_up_to_the_distance(spark):
    rng = random.Random(9)
    new = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    items = [new(n) for n in (1, 2, 4, 8, 15, 20, 30, 45, 60, 60)]
    texts, want = [], set()
    for k, item in enumerate(items):
        for _ in range(12):
            w = list(item)
            for _ in range(int(0.2 * len(item))):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = [f"n{rng.randrange(10**6)}"] * rng.randrange(2)
            texts.append(" ".join([f"f{rng.randrange(10**6)}" for _ in range(50)] + w + ["end."] * 3).title())
            want.add((len(texts) - 1, k))
    rows = documents(spark, texts + ODD)
    benchmark = spark.createDataFrame(
        [*[(k, " ".join(w), 1) for k, w in enumerate(items)], (97, None, 1), (98, "", 1), (None, "x y", 1)], "item_id bigint, text string, edits int")
    found = decontam.contaminated(rows, benchmark).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(want - pairs) <= 2
    for r in found:
        assert edits(items[r["item_id"]], words((texts + ODD)[r["doc_id"]][r["start"] : r["end"]])) == r["edits"]
        assert r["edits"] <= int(0.2 * len(items[r["item_id"]]) + 1e-9)
    small = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(rows, benchmark, portion=600).collect()}
    assert small == pairs
    assert decontam.contaminated(rows.limit(0), benchmark).count() == 0
    assert decontam.contaminated(rows, benchmark.limit(0)).count() == 0


def test_each_kind_of_edit_is_found_at_every_size():
    rng = random.Random(12)
    sizes = (1, 5, 12, 38, 59, 150, 400)
    items = [[f"i{k}w{rng.randrange(n * 3)}" for _ in range(n)] for k, n in enumerate(sizes)]
    near = decontam.Items(list(range(len(items))), [" ".join(w) for w in items], decontam.SHARE)
    filler = lambda: [f"f{rng.randrange(10**6)}" for _ in range(30)]
    texts, want = [], set()
    for k, (n, item) in enumerate(zip(sizes, items)):
        for most in (0, n // 10, n // 5):
            for turn in range(18):
                even = [int((i + 0.5) * n / most) for i in range(most)]
                places = set(even if turn % 2 else rng.sample(range(n), most))
                put = [["x y".split()[turn % 2]], None, []][turn % 3]
                w = [t for i, word in enumerate(item) for t in ([word] if i not in places else [word, "new"] if put is None else put)]
                texts.append(" ".join(filler() + w + filler()))
                want.add((len(texts) - 1, k))
    found = decontam.matches(near, texts)
    assert {(t, k) for t, k, *_ in found} == want
    for t, k, start, end, distance in found:
        assert edits(items[k], words(texts[t][start:end])) == distance <= len(items[k]) // 5


def test_walks_and_tables_reach_the_recall_at_every_size():
    rng = np.random.default_rng(3)
    for size in (5, 9, 14, 20, 38, 59, 100, 150, 320):
        setting = decontam.level(size, decontam.SHARE)
        assert setting in decontam.LEVELS
        # Other trials than those that chose the setting.
        for kind, found in decontam.recall(size, decontam.SHARE, setting, 500).items():
            assert found >= 0.985, (size, kind, found)
        # Windows of other words meet no item.
        item = decontam.sketch(rng.integers(1, 2**63, (1, size), dtype=np.uint64), setting, True)
        assert not (decontam.sketch(rng.integers(1, 2**63, (200, size), dtype=np.uint64), setting, False) == item).any()
    assert decontam.level(decontam.MEASURED + 1, decontam.SHARE) is None


def test_decontamination_query_loses_nothing_to_the_tables(spark):
    rows = queries.op7_decontamination(spark, FOLDER).collect()
    connection = duckdb.connect()
    texts = connection.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' WHERE text IS NOT NULL").fetchall()
    items = connection.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet' ORDER BY 1").fetchall()
    every = decontam.Items([i for i, _ in items], [t for _, t in items], decontam.SHARE)
    # Without the walks, every window that the exact count leaves is verified.
    every.meet = lambda cut, chosen: np.ones(len(chosen), bool)
    want = [(texts[t][0], *rest) for t, *rest in decontam.matches(every, [t for _, t in texts])]
    assert {r[:2] for r in rows} == {w[:2] for w in want} and len(rows) == len(want) > 0
    assert sorted(map(tuple, rows)) == sorted(want)


def test_one_long_item_does_not_widen_the_others():
    texts = [f"a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(5_000)] + [" ".join(f"w{j}" for j in range(4_000)), "alone"]
    tracemalloc.start()
    items = decontam.Items(list(range(len(texts))), texts, decontam.SHARE)
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()
    long = " ".join(w for j, w in enumerate(texts[5_000].split()) if j % 6)
    found = decontam.matches(items, [texts[7] + " x", long, "it is alone"])
    assert [(t, k, d) for t, k, _, _, d in found] == [(0, 7, 0), (1, 5_000, 667), (2, 5_001, 0)]


def test_portions_are_released_one_after_the_other(spark):
    texts = [f"p{i} q{i} r{i} s{i} t{i}" for i in range(12)]
    benchmark = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    found = decontam.contaminated(documents(spark, texts), benchmark, portion=400)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(i, i) for i in range(12)}
    # The result's plan would hold the tables of every portion.
    assert "MapInArrow" not in found._jdf.queryExecution().toString()


def test_decontamination_query_finds_all_copies(spark):
    connection = duckdb.connect()
    exact = connection.sql(
        f"SELECT doc_id, item_id FROM '{FOLDER}/documents.parquet' d, '{FOLDER}/benchmark.parquet' b WHERE contains(d.text, b.text)").fetchall()
    rows = queries.op7_decontamination(spark, FOLDER).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows if r["edits"] == 0} >= set(exact)


def test_licenses_equal_brute_force(spark):
    rng = random.Random(2)
    texts = list(ODD) + list(licenses.TEMPLATES.values()) * 2
    for text in licenses.TEMPLATES.values():
        w = text.split()
        texts.append(" ".join(["filler"] * rng.randrange(300) + w[: int(len(w) * 0.93) + 1] + ["more words here"] * 50))
        texts.append(changed(rng, w, 0.5))
    rows = licenses.scan(documents(spark, texts)).collect()
    want = {
        (i, name) for i, text in enumerate(texts) for name, template in licenses.TEMPLATES.items()
        if len(shingles(text) & shingles(template)) >= 0.8 * len(shingles(template))
    }
    assert {(r["doc_id"], r["license"]) for r in rows if r["doc_id"] is not None} == want
    for r in rows:
        assert set(words(texts[r["doc_id"]][r["start"] : r["end"]])) <= set(words(licenses.TEMPLATES[r["license"]]))
    assert licenses.scan(documents(spark, []).limit(0)).count() == 0


def test_short_licenses_are_found(spark):
    short = {"spdx": "SPDX-License-Identifier: MIT", "one": "WTFPL", "none": " . ", "same": "spdx license identifier mit",
             "long": licenses.TEMPLATES["MIT notice"]}
    texts = [None, "", "x WTFPL", "wtfpl", "SPDX-License-Identifier", "identifier MIT", "// spdx license-identifier: mit, wtfpl, WTFPL",
             "SPDX License", "Identifier MIT", "İ SPDX License Identifier MIT", "Released under the MIT License. WTFPL", "WTFPLS"]
    rows = licenses.scan(documents(spark, texts), short).where("doc_id is not null").collect()
    found = {(r["doc_id"], r["license"]): texts[r["doc_id"]][r["start"] : r["end"]] for r in rows}
    spdx = {(i, n): t for i, t in ((6, "spdx license-identifier: mit"), (9, "SPDX License Identifier MIT")) for n in ("spdx", "same")}
    once = {(2, "one"): "WTFPL", (3, "one"): "wtfpl", (6, "one"): "wtfpl", (10, "one"): "WTFPL"}
    assert found == spdx | once | {(10, "long"): "Released under the MIT License"} and len(rows) == len(found)
    assert all(r["share"] == 1.0 for r in rows)
    assert licenses.scan(documents(spark, texts), {"none": " . "}).count() == 0
