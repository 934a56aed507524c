"""Registered queries against their SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as spark_entry
from oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
# The training-data queries have tests of their own.
OTHER = {n for n in spark_entry.queries() if re.match(r"op\d+_|pipeline", n)}
SLOW = OTHER | {"tfidf_classifiers", "word2vec_classifiers", "sentence_classifier", "lda_topics"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = spark_entry.queries()[name](spark, FOLDER)
    assert compare(frame, duck, spark_entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(spark_entry.queries()) - set(spark_entry.oracle_sql()) - SLOW))
def test_query_has_rows(spark, name):
    assert spark_entry.queries()[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry_has_a_stable_schema(spark):
    frame = spark_entry.entry(spark)
    assert frame.columns == ["doc_id", "class", "source", "token", "tf", "idf", "tf_idf"]
    assert frame.count() > 0
