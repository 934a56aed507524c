import re
import string

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from inkwell.functions import text as X
from inkwell.schema import STOP_WORDS, WHITESPACE

TEXTS = [
    "Hello  there. Bye.",
    "He's dead, Jim!",
    "...",
    "",
    "end.Start don't  stop",
    "  Ünïcode  spaces \x1c",
    " a  b ",
    "one\ttwo\n\nthree\x0bfour",
    "The 12 <b>bold</b> men, and 3rd-rate ideas; glasses!",
    "ÉCOLE straße <a href='x>y'>link</a>",
    "x < y > z",
]


def column(spark, expression, texts=TEXTS):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [row[1] for row in frame.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]


def test_the_lists_are_complete():
    assert len(STOP_WORDS) == 180 and "" in STOP_WORDS
    assert sorted(WHITESPACE) == [c for c in map(chr, range(0x110000)) if c.isspace()]


def test_clean_punct_deletes_and_strips(spark):
    delete = str.maketrans("", "", string.punctuation)
    assert column(spark, X.clean_punct) == [t.lower().translate(delete).strip() for t in TEXTS]


def test_tokens_equal_the_ml_stages(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "t string").select(
        X.clean_punct(F.col("t")).alias("t")
    )
    found = Tokenizer(inputCol="t", outputCol="w").transform(frame)
    found = StopWordsRemover(inputCol="w", outputCol="s", stopWords=STOP_WORDS).transform(found)
    for row in found.select("s", X.tokens(F.col("t")).alias("mine")).collect():
        assert row.mine == row.s


def test_clean_text_follows_the_filter_chain(spark):
    def chain(t):
        t = re.sub(r"<([^>]+)>", "", t.lower())
        t = re.sub("([%s])+" % re.escape(string.punctuation), " ", t)
        t = re.sub(r"[0-9]+", "", re.sub(r"(\s)+", " ", t))
        return " ".join(w for w in t.split() if w not in STOP_WORDS and len(w) >= 3)

    assert column(spark, X.clean_text) == [chain(t) for t in TEXTS]


def test_letters_only(spark):
    def plain(t):
        words = re.sub("[^a-zA-Z]", " ", t.lower()).split()
        return " ".join(w for w in words if w not in STOP_WORDS)

    assert column(spark, X.letters_only) == [plain(t) for t in TEXTS]


@pytest.mark.parametrize(
    "word, stem",
    [("caresses", "caress"), ("ponies", "poni"), ("caress", "caress"), ("cats", "cat"), ("is", "is"), ("cat", "cat")],
)
def test_plural_stem(spark, word, stem):
    assert column(spark, X.plural_stem, [word]) == [stem]


def test_comment_sentences(spark):
    comment = "A fine tale. \n  The end surprised me. Truly. Yes\n\nend. "
    expected = [line.strip().split(". ") for line in comment.split("\n")]
    assert column(spark, X.comment_sentences, [comment]) == [expected]
