"""One query for each operator: whole tables in, the contract's columns out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import (
    ann, bpe, decontam, langid, licenses, ngram_join, periodic, quality, secrets, toxicity, transducer, vector_codes, warc,
)
from inkwell.operators.derive import compute_once
from inkwell.session import keep
from inkwell.sources.tables import table

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def fold(key: str, folds: int) -> Column:
    """Fold of a row by the checksum of its key; a null key counts as an empty one, so no fold is null."""
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.pmod(F.crc32(name.cast("binary")), F.lit(folds))


def op1_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find(table(spark, sf, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(secrets.written(F.col("spans"), tuple(secrets.BASE)), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang", (fold("doc_id", 4) == 2).alias("held_out"))
    profiles = langid.learn(documents.where(~F.col("held_out")))
    return langid.predict(documents.drop("lang"), profiles).select("doc_id", "held_out", "lang_pred", "score")


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    model = toxicity.fit(documents, table(spark, sf, "labels").where(fold("doc_id", 5) != 0))
    return toxicity.score(documents, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted")
    )


def op4_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf, "documents"))


def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.round_trip(documents, public_tokenizers.path(VOCABULARY)).drop("text")


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text", (fold("doc_id", 4) == 2).alias("held_out"))
    model = quality.fit(documents, table(spark, sf, "labels").where(fold("doc_id", 4) != 2))
    return quality.score(documents, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= quality.KEEP).cast("int").alias("predicted")
    )


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op8_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


def op9_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return warc.round_trip(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _with_repeats(documents: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, chosen by the checksum of doc_id, ends in copies of a few words.

    Such a text of n words repeats p of them from word a on. A null doc_id has no checksum.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    some = compute_once(documents.select("doc_id", "text"), "_words", words)
    n, g = F.size("_words"), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("_words", a + 1, p), times)), 1, n - a)
    repeated = F.array_join(F.concat(F.slice("_words", 1, a), tail), " ")
    return some.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.find(_with_repeats(table(spark, sf, "documents"))).drop("text")
    # The longest run; of equal ones the first by start, then period.
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("later"), (-r["period"]).alias("wider")
    )))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = F.col("longest.length"), -F.col("longest.wider")
    return found.select("*", longest.alias("longest")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("longest.later")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    rows, codebooks = vector_codes.compress(vectors, "vec_id", "embedding")
    rows = keep(rows, "codes")
    by_label = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(keep(by_label, "errors"), F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.sha2(F.lit(vector_codes.written(codebooks)), 256).alias("codebooks_sha256"),
    )


def op13_bpe_transducer(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    path = public_tokenizers.path(RANKS)
    return transducer.round_trip(documents, path, public_tokenizers.PATTERN).drop("text")


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scans, op2_language_id, op3_toxicity, op4_ngram_jaccard_join, op5_bpe, op6_quality, op7_decontamination,
        op8_license_scans, op9_nearest_neighbours, op10_warc, op11_periodic_runs, op12_vector_codes, op13_bpe_transducer,
    )
}


def _codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Rounds of assigning and moving as tables, one after the other."""
    distance = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""near_{i} AS (
            SELECT n, p.part, arg_min(entry, distance * 1000 + entry) AS entry, min(distance) AS distance
            FROM (SELECT q.n, q.part, b.entry, {distance}::BIGINT AS distance FROM parts_ q JOIN book_{i} b ON q.part = b.part) p
            GROUP BY n, p.part)""")
        if i < rounds:
            steps.append(f"""sums_{i} AS (
                SELECT part, entry, list(floor(total / number) ORDER BY place) AS c FROM (
                    SELECT a.part, a.entry, place, sum(q.v[place])::DOUBLE AS total, count(*) AS number
                    FROM near_{i} a JOIN parts_ q ON a.n = q.n AND a.part = q.part, unnest(range(1, len(q.v) + 1)) AS u(place)
                    GROUP BY a.part, a.entry, place) GROUP BY part, entry),
            book_{i + 1} AS (
                SELECT b.part, b.entry, coalesce(s.c, b.c)::BIGINT[] AS c
                FROM book_{i} b LEFT JOIN sums_{i} s ON s.part = b.part AND s.entry = b.entry)""")
    return f"""
        WITH kept_ AS (
            SELECT row_number() OVER (ORDER BY vec_id) - 1 AS n, vec_id, label,
                list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts_ AS (
            SELECT n, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS v
            FROM kept_, unnest(range({parts})) AS u(part)),
        book_0 AS (SELECT part, n AS entry, v AS c FROM parts_ WHERE n < {entries}),
        {", ".join(steps)},
        codes_ AS (
            SELECT n, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
            FROM near_{rounds} GROUP BY n)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book_{rounds}) AS codebooks_sha256
        FROM codes_ JOIN kept_ USING (n)
    """


# Payloads and the archive's decisions, and the rounds of the codebooks, as SQL sees them.
ORACLE = {
    "op10_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
        FROM g
    """,
    "op12_vector_codes": _codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE),
}
