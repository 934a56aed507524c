"""Term counts, term weights and key terms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.stem import porter_stem
from inkwell.functions.text import clean_punct, plural_stem, tokens
from inkwell.operators.derive import compute_once
from inkwell.operators.joins import enrich
from inkwell.session import keep, scratch

# The stop list holds the empty string, so no token is empty and '' can stand for
# the document itself: its document frequency is the number of documents.
DOCUMENT_MARK = ""
#: Tokens beyond which idf is too large to be sent to every task; rows then meet it in hash tables, unsorted.
HASHED_TOKENS = 1 << 18
#: Entries weighed to find a limit for the others, as a multiple of those wanted; more give a higher limit.
FIRST = 16


def with_tokens(documents: DataFrame, text: str = "review") -> DataFrame:
    """Replace the text by its tokens, stop words and empty tokens left out."""
    return compute_once(documents, "tokens", tokens(clean_punct(F.col(text)))).drop(text)


def token_rows(tokenized: DataFrame) -> DataFrame:
    """One row per token occurrence.

    The outer form, because Spark repeats the input of the inner one in a filter.
    """
    kept = [c for c in tokenized.columns if c != "tokens"]
    return tokenized.select(*kept, F.explode_outer("tokens").alias("token")).where(
        F.col("token").isNotNull()
    )


def token_counts(tokenized: DataFrame) -> DataFrame:
    """Occurrences of each token in the corpus."""
    return token_rows(tokenized.select("tokens")).groupBy("token").agg(F.count("*").alias("n"))


def _starts(tokenized: DataFrame) -> DataFrame:
    """Rows with the number of their tokens, the tokens ``_sorted``, and the places where a new one starts.

    A document is one row, so its tokens are counted inside the row: sorted, equal
    tokens stand together and each run is one term. No shuffle takes place.
    """
    kept = [c for c in tokenized.columns if c != "tokens"]
    ordered = tokenized.select(
        *kept, F.size("tokens").alias("n_tokens"), F.sort_array("tokens").alias("_sorted")
    )
    places = F.sequence(F.lit(0), F.col("n_tokens") - 1)

    def starts(i: Column) -> Column:
        token = F.get("_sorted", i)
        return F.when(i == 0, token.isNotNull()).otherwise(token != F.get("_sorted", i - 1))

    return ordered.withColumn("_starts", F.when(F.col("n_tokens") > 0, F.filter(places, starts)))


def _term(at: Column, i: Column) -> tuple[Column, Column]:
    """Token and n of the ``i``-th term, which starts at ``at``."""
    n = F.coalesce(F.get("_starts", i + 1), F.col("n_tokens")) - at
    return F.get("_sorted", at).alias("token"), n.alias("n")


def term_bags(tokenized: DataFrame) -> DataFrame:
    """One row per (document, token): occurrences ``n`` and document total ``n_tokens``."""
    kept = [c for c in tokenized.columns if c != "tokens"]
    placed = _starts(tokenized).select("*", F.posexplode_outer("_starts").alias("_i", "_at"))
    return placed.where(F.col("_at").isNotNull()).select(*kept, "n_tokens", *_term(F.col("_at"), F.col("_i")))


def bags_in_rows(tokenized: DataFrame) -> DataFrame:
    """Rows with their tokens replaced by ``terms``, an array of token and number of occurrences ``value``, sorted by token."""
    kept = [c for c in tokenized.columns if c != "tokens"]

    def term(at: Column, i: Column) -> Column:
        token, n = _term(at, i)
        return F.struct(token, n.cast("double").alias("value"))

    none = F.array().cast("array<struct<token:string,value:double>>")
    return _starts(tokenized).select(*kept, F.coalesce(F.transform("_starts", term), none).alias("terms"))


def term_frequencies(tokenized: DataFrame) -> DataFrame:
    """Share of each token in its document."""
    return term_bags(tokenized).withColumn("tf", F.col("n") / F.col("n_tokens")).drop("n", "n_tokens")


def term_frequencies_over_rows(tokenized: DataFrame, key: str) -> DataFrame:
    """Share of each token in documents that lie in several rows, such as sentences.

    Sentences are joined by spaces, so their tokens are those of the whole document and
    the text need not be assembled. Each row is counted by itself first; a document of
    any length is summed by many tasks.
    """
    counts = term_bags(tokenized.select(key, "tokens")).groupBy(key, "token").agg(F.sum("n").alias("n"))
    totals = (
        tokenized.groupBy(key).agg(F.sum(F.size("tokens")).alias("n_tokens")).where(F.col("n_tokens") > 0)
    )
    return enrich(counts, keep(totals, "totals"), key).select(
        key, "token", (F.col("n") / F.col("n_tokens")).alias("tf")
    )


def document_frequencies(tokenized: DataFrame) -> DataFrame:
    """Documents per token; the row of ``DOCUMENT_MARK`` counts all that have a token."""
    return (
        tokenized.where(F.size("tokens") > 0)
        .select(
            F.explode(F.concat(F.array(F.lit(DOCUMENT_MARK)), F.array_distinct("tokens"))).alias("token")
        )
        .groupBy("token")
        .agg(F.count("*").alias("df"))
    )


def inverse_document_frequencies(tokenized: DataFrame) -> DataFrame:
    """token, df and idf = ln(N / df); N counts documents with at least one token."""
    df = keep(document_frequencies(tokenized), "df")
    n = df.where(F.col("token") == DOCUMENT_MARK).select("df").scalar()
    return df.where(F.col("token") != DOCUMENT_MARK).withColumn("idf", F.ln(n / F.col("df")))


def _hashed(stats: DataFrame, tokens: DataFrame) -> DataFrame:
    """``stats`` for a join in hash tables, one a partition, if there are many ``tokens``; sorting the other side costs more."""
    return stats.hint("shuffle_hash") if tokens.count() > HASHED_TOKENS else stats


def weigh(frequencies: DataFrame, idf: DataFrame) -> DataFrame:
    """Add idf and tf_idf to term frequencies.

    A window by token would put all rows of a common word in one task; a join with one
    row per token lets adaptive execution cut such words.
    """
    return (
        enrich(frequencies, _hashed(idf, idf), "token")
        .drop("df")
        .withColumn("tf_idf", F.col("tf") * F.col("idf"))
    )


def tf_idf(tokenized: DataFrame) -> DataFrame:
    """tf, idf and tf_idf of every token in every document."""
    return weigh(term_frequencies(tokenized), inverse_document_frequencies(tokenized))


def tf_idf_by_pair(tokenized: DataFrame, key: str) -> DataFrame:
    """The same weights from a tf table and a (document, token) idf table joined on both keys.

    The tf table is kept, and documents, frequencies and pairs are taken from it, so the
    texts are tokenized once.
    """
    tf = keep(term_frequencies(tokenized), "tf")
    pairs = tf.select(key, "token")
    df = pairs.groupBy("token").agg(F.count("*").alias("df"))
    n = pairs.agg(F.count_distinct(key)).scalar()
    by_token = keep(df.withColumn("idf", F.ln(n / F.col("df"))), "idf")
    # Not hashed: in the order of their tokens, pairs take half the bytes on the way to the second join.
    idf = enrich(pairs, by_token, "token").drop("df")
    return tf.join(_hashed(idf, by_token), [key, "token"]).withColumn("tf_idf", F.col("tf") * F.col("idf"))


def item_specificity(weights: DataFrame, label: str = "class") -> DataFrame:
    """Largest tf_idf per class and the token that has it (first by name among equals).

    Documents without a class count for idf only.
    """
    return weights.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.max("tf_idf").alias("specificity"),
        F.min_by("token", F.struct(-F.round("tf_idf", 9), F.col("token"))).alias("token"),
    )


def terms_of(tokenized: DataFrame, idf: DataFrame, item: Column) -> DataFrame:
    """Weighted terms of the wanted documents only, against corpus-wide idf."""
    return weigh(term_frequencies(tokenized.where(item)), idf)


def top_per_group(
    rows: DataFrame, group: str, order: Sequence[Column], spread: Sequence[str], k: int, salts: int = 64
) -> DataFrame:
    """First ``k`` rows of each group under ``order``, numbered by ``rank``.

    Each group is cut into ``salts`` slices and only the first k of a slice meet,
    so a group with a large share of the rows is still ranked by many tasks.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts))
    slices = Window.partitionBy(group, "_salt").orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    return (
        rows.withColumn("_salt", salt)
        .withColumn("_rank", F.row_number().over(slices))
        .where(F.col("_rank") <= k)
        .drop("_salt", "_rank")
        .withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= k)
    )


def top_weights(tokenized: DataFrame, group: str, spread: Sequence[str], k: int, digits: int = 6) -> DataFrame:
    """The ``k`` entries of each group with the largest tf_idf, to ``digits`` digits; equal ones by token, then ``spread``.

    An entry's tf_idf is at most its tf times the largest idf. So some entries of large tf are weighed
    first, ``FIRST`` times ``k`` a group or more; of all entries only those are weighed, moved and ranked that could
    come before the k-th of them. What is left out cannot be among the first ``k``.
    """
    spark = tokenized.sparkSession
    with scratch(spark):
        tf = keep(term_frequencies(tokenized.select(group, *spread, "tokens")), "tf")
        idf = keep(inverse_document_frequencies(tokenized), "idf")
        most = idf.agg(F.max("idf")).scalar()
        # Histograms of tf, sixteen steps for each halving: a few hundred rows a group.
        step = F.floor(-16 * F.log2("tf"))
        steps = tf.groupBy(group, step.alias("_step")).agg(F.count("*").alias("_n"))
        above = F.sum("_n").over(Window.partitionBy(group).orderBy("_step")) - F.col("_n")
        cuts = keep(steps.withColumn("_above", above).where(F.col("_above") < FIRST * k).groupBy(group).agg(F.max("_step").alias("_cut")), "cuts")

        def of_group(rows: DataFrame, limits: DataFrame) -> DataFrame:
            return rows.join(limits.withColumnRenamed(group, "_group"), F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")

        rounded = F.round("tf_idf", digits).alias("tf_idf")
        order = [F.desc("tf_idf"), F.asc("token"), *[F.asc(c) for c in spread]]

        def ranked(frequencies: DataFrame) -> DataFrame:
            weights = weigh(frequencies, idf).select(group, *spread, "token", rounded)
            return top_per_group(weights, group, order, [*spread, "token"], k)

        first = ranked(of_group(tf, cuts).where(step <= F.col("_cut")).drop("_cut"))
        # Less than k entries set no limit. Rounding moves a weight by half a digit.
        least = first.groupBy(group).agg(F.when(F.count("*") == k, F.min("tf_idf") - 2 * 10.0**-digits).alias("_least"))
        candidates = of_group(tf, keep(least, "least")).where(F.col("_least").isNull() | (F.col("tf") * most >= F.col("_least")))
        return keep(ranked(candidates.drop("_least")), "top", lasting=True)


def boosted_counts(terms: DataFrame, term: str, times: int, k: int = 100) -> DataFrame:
    """Counts of a short term list with one term added ``times`` times; the ``k``
    most frequent and their weight against the most frequent one."""
    extra = terms.sparkSession.range(1).select(
        F.explode(F.array_repeat(F.lit(term), times)).alias("token")
    )
    counts = (
        terms.select("token")
        .unionByName(extra)
        .groupBy("token")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(k)
    )
    # At most k rows are left here.
    return counts.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy()))


def smoothed_weights(tokenized: DataFrame, key: str, documents: int) -> DataFrame:
    """key, token and weight n * ln((N + 1) / (df + 1)) of every token of every document.

    N is the number of all documents, also of those without a token. No token is left out.
    """
    bags = keep(term_bags(tokenized.select(key, "tokens")).select(key, "token", "n"), "bags")
    df = keep(bags.groupBy("token").agg(F.count("*").alias("df")), "df")
    weight = F.col("n") * F.ln((F.lit(documents) + 1) / (F.col("df") + 1))
    return enrich(bags, df, "token").select(key, "token", weight.alias("weight"))


def naive_bayes(tokenized: DataFrame, key: str, label: str) -> DataFrame:
    """key, label and prediction of multinomial naive Bayes fitted on the same documents.

    Sums by class and token, smoothed by one; no token is left out. Equal scores go to
    the smaller class. A document without a token gets the most frequent class. Documents are told
    apart by a row number, so null and repeated keys do no harm.
    """
    documents = keep(tokenized.where(F.col(label).isNotNull()).withColumn("_row", F.monotonically_increasing_id()), "labelled")
    bags = keep(term_bags(documents.select("_row", label, "tokens")).select("_row", label, "token", "n"), "bags")
    cells = bags.groupBy("token", label).agg(F.sum("n").alias("n"))
    cells = keep(cells.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct(label, "n"))).alias("by_class")), "cells")
    # One row per class reaches the driver, as in any fitted model.
    sizes = {r[0]: r[1] for r in documents.groupBy(label).agg(F.count("*")).collect()}
    totals = {r[0]: r[1] for r in bags.groupBy(label).agg(F.sum("n")).collect()}
    classes, kinds, size = sorted(sizes), cells.count(), sum(sizes.values())
    if not classes:
        return documents.select(key, label, F.col(label).alias("prediction"))
    likelihood = [
        F.sum(F.col("n") * (F.ln(F.coalesce(F.col("by_class")[F.lit(c)], F.lit(0)) + 1) - math.log(totals.get(c, 0) + kinds))).alias(f"_{i}")
        for i, c in enumerate(classes)
    ]
    sums = enrich(bags, cells, "token").groupBy("_row").agg(*likelihood)
    scored = documents.select("_row", key, label).join(sums, "_row", "left")
    scores = [
        F.struct(
            (F.coalesce(f"_{i}", F.lit(0.0)) + math.log((sizes[c] + 1) / (size + len(classes)))).alias("score"),
            F.lit(-i).alias("order"),
            F.lit(c).cast(tokenized.schema[label].dataType).alias("guess"),
        )
        for i, c in enumerate(classes)
    ]
    return scored.select(key, label, F.array_max(F.array(*scores))["guess"].alias("prediction"))


def cross_validated_bayes(
    tokenized: DataFrame, label: str, fold: Column, folds: int, smoothings: Sequence[float]
) -> DataFrame:
    """fold, smoothing, class and prediction of each document under naive Bayes fitted without its fold.

    Counts by token, class and fold are taken once; a fold's model is the total minus the fold's own
    counts, so no data is read again for a fold or a smoothing. ``fold`` is a number from 0. A
    document is scored by all smoothings at once. Its tokens meet one row of counts each. Tokens
    that only the document's fold has are unknown to its model and left out. Equal scores go to
    the smaller class. Folds, classes and smoothings are few: their totals are on the driver.
    """
    rows = keep(
        tokenized.where(F.col(label).isNotNull()).select(label, fold.cast("int").alias("_fold"), "tokens")
        .withColumn("_row", F.monotonically_increasing_id()),
        "labelled",
    )
    bags = keep(term_bags(rows).select("_row", label, "_fold", "token", "n"), "bags")
    sizes = {(r[0], r[1]): r[2] for r in rows.groupBy("_fold", label).agg(F.count("*")).collect()}
    classes = sorted({c for _, c in sizes})
    # A token's counts by class and fold, one row a token.
    cells = bags.groupBy("token", label, "_fold").agg(F.sum("n").alias("n"))
    named = F.concat_ws("/", F.col("_fold"), F.col(label))
    by_fold = cells.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct(named, "n"))).alias("_counts"))

    def count(k, c):
        return F.coalesce(F.col("_counts")[F.concat_ws("/", F.lit(k), F.lit(c))], F.lit(0).cast("bigint"))

    # Added up once a token, so that its many occurrences only look them up: for each fold, by class, without it.
    others = [[sum((count(j, c) for j in range(folds) if j != k), F.lit(0).cast("bigint")) for c in classes] for k in range(folds)]
    none = F.array().cast("array<bigint>")
    counts = keep(by_fold.select("token", F.array(*[F.array(*of) if of else none for of in others]).alias("_without")), "counts")

    def without(k, c):
        return F.col("_without")[k][classes.index(c)]

    # Occurrences by class, and kinds of tokens, without each fold: one row.
    sums = counts.agg(*[
        F.sum(without(k, c)).alias(f"n_{k}_{i}") for k in range(folds) for i, c in enumerate(classes)
    ], *[
        F.count_if(sum((without(k, c) for c in classes), F.lit(0)) > 0).alias(f"v_{k}") for k in range(folds)
    ]).first()
    if not classes or not sums[0]:
        return rows.select("_fold", F.lit(0.0).alias("smoothing"), label, F.col(label).alias("prediction")).where("false")

    def pick(of_fold):
        found = F.lit(None)
        for k in range(folds):
            found = F.when(F.col("_fold") == k, of_fold(k)).otherwise(found)
        return found

    known = enrich(bags, counts, "token")
    # A fold beyond the last has no model and no counts.
    of_fold = F.get("_without", F.col("_fold"))
    known = known.select("_row", "_fold", "n", *[of_fold[i].alias(f"o_{i}") for i in range(len(classes))])
    known = known.where(sum((F.col(f"o_{i}") for i in range(len(classes))), F.lit(0)) > 0)
    parts = []
    for a, smoothing in enumerate(smoothings):
        for i in range(len(classes)):
            rest = pick(lambda k, i=i, s=smoothing: F.lit(math.log((sums[f"n_{k}_{i}"] or 0) + s * sums[f"v_{k}"] or 1)))
            parts.append(F.sum(F.col("n") * (F.ln(F.col(f"o_{i}") + F.lit(float(smoothing))) - rest)).alias(f"s_{a}_{i}"))
    scored = rows.select("_row", "_fold", label).join(known.groupBy("_row").agg(*parts), "_row", "left")
    results = []
    for a, smoothing in enumerate(smoothings):
        options = []
        for i, c in enumerate(classes):
            prior = pick(lambda k, c=c: F.lit(math.log(
                (sum(sizes.get((j, c), 0) for j in range(folds) if j != k) + 1)
                / (sum(n for (j, _), n in sizes.items() if j != k) + len(classes))
            )))
            score = F.coalesce(F.col(f"s_{a}_{i}"), F.lit(0.0)) + prior
            options.append(F.struct(score.alias("score"), F.lit(-i).alias("order"), F.lit(c).cast(rows.schema[label].dataType).alias("value")))
        results.append(F.struct(F.lit(float(smoothing)).alias("smoothing"), F.array_max(F.array(*options))["value"].alias("prediction")))
    return scored.select(F.col("_fold").alias("fold"), label, F.inline(F.array(*results)))


def mutual_information(tokenized: DataFrame, label: str) -> DataFrame:
    """token, df and mi, in nats, of a token's presence in a document with the document's class.

    Documents without a class take no part; those without a token count as documents. From
    document frequencies by class: one row for each token and class, then one a token. A
    class's size, one number each, is all that the driver sees.
    """
    rows = keep(tokenized.where(F.col(label).isNotNull()).select(label, F.array_distinct("tokens").alias("tokens")), "labelled")
    sizes = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count("*")).collect()}
    total = float(sum(sizes.values()))
    cells = rows.select(label, F.explode("tokens").alias("token")).groupBy("token", label).agg(F.count("*").alias("n"))
    found = cells.groupBy("token").agg(
        F.sum("n").alias("df"), F.map_from_entries(F.collect_list(F.struct(label, "n"))).alias("_by_class")
    )
    df, mi = F.col("df"), F.lit(0.0)
    for value, size in sorted(sizes.items()):
        with_token = F.coalesce(F.col("_by_class")[F.lit(value)], F.lit(0))
        for n, margin in ((with_token, df), (size - with_token, total - df)):
            # An empty cell adds nothing.
            mi = mi + F.when(n > 0, n / total * F.ln(n * total / (margin * F.lit(float(size))))).otherwise(0.0)
    return found.select("token", "df", mi.alias("mi"))


def top_informative(ranked: DataFrame, k: int) -> DataFrame:
    """The ``k`` tokens with the most information; equal ones (to nine digits) by name."""
    return ranked.orderBy(F.round("mi", 9).desc(), "token").limit(k)


def conflated_vocabulary(tokenized: DataFrame) -> DataFrame:
    """Occurrences and word forms per plural stem, from the counted vocabulary."""
    return (
        token_counts(tokenized)
        .groupBy(plural_stem(F.col("token")).alias("stem"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("forms"))
    )


def stems(tokenized: DataFrame) -> DataFrame:
    """token and stem, each token of the corpus once. A kept table."""
    words = tokenized.select(F.explode(F.array_distinct("tokens")).alias("token")).distinct()
    return keep(compute_once(words, "stem", porter_stem(F.col("token"))), "stems")


def stemmed_bags(tokenized: DataFrame) -> DataFrame:
    """One row per (document, stem) and the occurrences ``n`` of all its forms.

    Tokens are counted in the row, each distinct token of the corpus is stemmed once, and the
    stems are joined back. Documents are told apart by a row number, so repeated and null keys
    do no harm.
    """
    kept = [c for c in tokenized.columns if c != "tokens"]
    rows = keep(tokenized.withColumn("_row", F.monotonically_increasing_id()), "rows")
    counted = enrich(term_bags(rows).drop("n_tokens"), stems(rows), "token")
    return counted.groupBy("_row", *kept, "stem").agg(F.sum("n").alias("n")).drop("_row")


def letter_counts(texts: DataFrame, text: str, letters: str) -> DataFrame:
    """Occurrences of each of the letters, and of the spaces set between them."""
    kept = F.col("_kept")
    counts = [(F.char_length(kept) - F.char_length(F.replace(kept, F.lit(c), F.lit(""))), c) for c in letters]
    spaces = F.greatest(F.char_length(kept) - 1, F.lit(0))
    found = compute_once(texts, "_kept", F.regexp_replace(text, f"[^{letters}]+", "")).agg(
        F.array(
            *[F.struct(F.lit(c).alias("char"), F.sum(n).alias("n")) for n, c in [*counts, (spaces, " ")]]
        ).alias("found")
    )
    return found.select(F.inline("found"))
