import gzip
import json

import pytest

from inkwell import session
from inkwell.schema import REVIEW
from inkwell.sources import files


def test_gzip_json_with_the_declared_schema(spark, tmp_path):
    row = {
        "user_id": "u1", "timestamp": "2017-08-30", "review_sentences": [[0, "Hello"], [1, "He's dead"]],
        "rating": 5, "has_spoiler": True, "book_id": "b1", "review_id": "r1",
    }
    path = tmp_path / "reviews.json.gz"
    with gzip.open(path, "wt") as out:
        out.write(json.dumps(row) + "\n" + json.dumps({"review_id": "r2"}) + "\n")
    found = {r.review_id: r for r in files.read_reviews(spark, str(path), partitions=3).collect()}
    # The class of a sentence is text, as the mixed pair is read as strings.
    assert found["r1"].review_sentences == [["0", "Hello"], ["1", "He's dead"]]
    assert found["r1"].rating == 5 and found["r2"].review_sentences is None
    files.convert_reviews(spark, str(path), str(tmp_path / "reviews"))
    again = spark.read.parquet(str(tmp_path / "reviews"))
    assert again.schema == REVIEW and again.count() == 2


def test_reviews_survive_json(spark, toy_reviews, tmp_path):
    files.write_reviews(toy_reviews, str(tmp_path / "json"))
    again = files.read_reviews(spark, str(tmp_path / "json"))
    assert sorted(map(str, again.collect())) == sorted(map(str, toy_reviews.select(again.columns).collect()))


def test_awkward_text_survives_csv(spark, tmp_path):
    rows = [(1, 0, 'say "hi", he\nsaid'), (2, 1, "back\\slash \\\" end"), (3, None, "a,b\r\nc"), (4, 1, None),
            (5, 1, ""), (6, 0, "  lead and trail  "), (7, 0, " "), (8, 1, "null")]
    frame = spark.createDataFrame(rows, "doc_id bigint, class int, review string")
    files.write_documents_csv(frame, str(tmp_path / "csv"))
    found = {r.doc_id: r for r in files.read_documents_csv(spark, str(tmp_path / "csv")).collect()}
    assert {k: (v["class"], v.review) for k, v in found.items()} == {d: (c, t) for d, c, t in rows}


def test_kept_tables_lie_in_the_shared_folder(spark):
    frame = session.keep(spark.range(5), "numbers")
    assert session.shared_dir(spark).removeprefix("file:") in frame.inputFiles()[0]
    assert frame.count() == 5


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_a_bad_line_is_not_read_silently(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"review_id": "r1"}\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_reviews(spark, str(tmp_path / "bad.json")).collect()
    assert files.read_reviews(spark, str(tmp_path / "bad.json"), mode="PERMISSIVE").count() == 2
