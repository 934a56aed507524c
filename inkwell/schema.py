"""Input schema and fixed word lists."""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("review_sentences", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("rating", T.LongType()),
        T.StructField("has_spoiler", T.BooleanType()),
        T.StructField("book_id", T.StringType()),
        T.StructField("review_id", T.StringType()),
    ]
)

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("class", T.IntegerType()),
        T.StructField("review", T.StringType()),
    ]
)

# The English stop-word list, 179 words.
_ENGLISH = """
a about above after again against ain all am an and any are aren aren't as at be because
been before being below between both but by can couldn couldn't d did didn didn't do
does doesn doesn't doing don don't down during each few for from further had hadn hadn't
has hasn hasn't have haven haven't having he her here hers herself him himself his how i
if in into is isn isn't it it's its itself just ll m ma me mightn mightn't more most
mustn mustn't my myself needn needn't no nor not now o of off on once only or other our
ours ourselves out over own re s same shan shan't she she's should should've shouldn
shouldn't so some such t than that that'll the their theirs them themselves then there
these they this those through to too under until up ve very was wasn wasn't we were
weren weren't what when where which while who whom why will with won won't wouldn
wouldn't y you you'd you'll you're you've your yours yourself yourselves
"""

# The empty string is on the list too: two spaces in a row make an empty token.
STOP_WORDS: list[str] = [*_ENGLISH.split(), ""]

# Every character that counts as white space at the end of a text.
WHITESPACE = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
