"""The same queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from inkwell.functions.stem import DOUBLE, LAST, LONG, MENDED, PLURALS
from inkwell.learning.cooccurrence import WINDOW
from inkwell.learning.gaussian import SHARE, TINY
from inkwell.learning.linear import PASSES
from inkwell.plans.catalog import (
    BOOK, BOOST, BOOST_TIMES, FEATURES, FOLDS, LENGTH_POINTS, LETTERS, LONG_DOCUMENT, PENALTY, RATIO_POINTS,
    SMOOTHINGS,
)
from inkwell.schema import STOP_WORDS, WHITESPACE
from inkwell.sources.files import NO_OBJECT, OTHER_TYPE
from inkwell.sources.tables import LONG_LINE

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)
_SPACE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13)" + "".join(
    f" || chr({ord(c)})" for c in WHITESPACE[5:]
)
_SPACE_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"


def _clean(text: str) -> str:
    bare = f"regexp_replace(lower({text}), '[!-/:-@\\[-`{{-~]', '', 'g')"
    return f"trim({bare}, {_SPACE})"


def _words(text: str, separator: str = r"\s") -> str:
    return f"unnest(regexp_split_to_array({text}, '{separator}'))"


_DOCUMENTS = """documents_ AS (
    SELECT d.doc_id, d.text AS review, d.source, d.n_chars, l.toxic AS class
    FROM documents d JOIN labels l USING (doc_id))"""

_ALL_DOCUMENTS = _DOCUMENTS.replace("documents d JOIN", "documents d LEFT JOIN")

_TOKENS = f"""{_ALL_DOCUMENTS}, split_ AS (
    SELECT doc_id, class, source, {_words(_clean('review'), '[ \\x09-\\x0d]')} AS token FROM documents_),
tokens_ AS (SELECT * FROM split_ WHERE token NOT IN ({_STOP}))"""

_TF = f"""{_TOKENS}, bags_ AS (
    SELECT doc_id, class, source, token, count(*) AS n FROM tokens_ GROUP BY ALL),
tf_ AS (SELECT *, n / sum(n) OVER (PARTITION BY doc_id) AS tf FROM bags_),
idf_ AS (
    SELECT token, count(*) AS df, ln((SELECT count(DISTINCT doc_id) FROM tokens_) / count(*)) AS idf
    FROM bags_ GROUP BY token)"""

_WEIGHTS = f"""{_TF}, weights_ AS (
    SELECT doc_id, class, source, token, tf, idf, tf * idf AS tf_idf FROM tf_ JOIN idf_ USING (token))"""

_TFIDF = f"""WITH {_WEIGHTS}
SELECT doc_id, class, source, token, round(tf, 6) AS tf, round(idf, 6) AS idf, round(tf_idf, 6) AS tf_idf
FROM weights_"""

_LINES = f"""lines_ AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS reviews,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents JOIN labels USING (doc_id)),
sentences_ AS (
    SELECT doc_id::VARCHAR AS review_id, doc_id, pos::INTEGER AS pos, reviews,
        CASE WHEN length(reviews) > {LONG_LINE} THEN '1' ELSE '0' END AS class FROM lines_),
reviews_ AS (
    SELECT doc_id::VARCHAR AS review_id, source AS book_id, lang AS user_id,
        toxic = 1 AS has_spoiler, quality::BIGINT AS rating FROM documents JOIN labels USING (doc_id)),
nested_ AS (
    SELECT review_id, class, string_agg(reviews, ' ' ORDER BY pos) AS review
    FROM sentences_ GROUP BY review_id, class)"""

_ALL_LINES = _LINES.replace("documents JOIN labels", "documents LEFT JOIN labels")

_SENTENCES = f"""WITH {_ALL_LINES}
SELECT review_id, book_id, user_id, has_spoiler, rating, pos, class, reviews
FROM sentences_ JOIN reviews_ USING (review_id)"""

_LENGTHS = f"""{_LINES}, lengths_ AS (
    SELECT review_id, class, has_spoiler, length({_clean('review')}) AS length
    FROM nested_ JOIN reviews_ USING (review_id))"""

_SCALED = f"""{_DOCUMENTS}, scaled_ AS (
    SELECT doc_id, class, round((length(review) - min(length(review)) OVER c)
        / nullif(max(length(review)) OVER c - min(length(review)) OVER c, 0), 6) AS scaled
    FROM documents_ WINDOW c AS (PARTITION BY class))"""


def _sampled(rows: str, label: str, key: str, value: str, m: int) -> str:
    return f"""listed_ AS (
    SELECT {label}, {key}, {value},
        row_number() OVER (PARTITION BY {label} ORDER BY md5({key}::VARCHAR), {key}) - 1 AS idx,
        greatest(count(*) OVER (PARTITION BY {label}) // {m}, 1) AS step FROM {rows}),
sample_ AS (
    SELECT {label}, {key}, {value}, idx // step AS j FROM listed_
    WHERE idx % step = 0 AND idx < step * {m})"""


def _describe(column: str) -> str:
    quartiles = ", ".join(
        f"round(quantile_cont({column}, {p}), 6) AS p{round(100 * p)}" for p in (0.25, 0.5, 0.75)
    )
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", round(avg({column}), 6) AS mean,
    round(stddev_samp({column}), 6) AS std, round(min({column}), 6) AS min, {quartiles},
    round(max({column}), 6) AS max FROM lineitem"""


_USER = """SELECT user_id, count_if(event_type = 'error')::BIGINT AS flagged, count(*) AS total,
    count_if(event_type = 'error') / count(*) AS ratio FROM events GROUP BY user_id"""
_BOOK = """SELECT source AS book_id, count_if(toxic = 1)::BIGINT AS flagged, count(*) AS total,
    count_if(toxic = 1) / count(*) AS ratio FROM documents JOIN labels USING (doc_id) GROUP BY source"""

_REVIEW_RATIOS = f"""{_LINES}, ratios_ AS (
    SELECT r.*, count_if(has_spoiler) OVER b / count(*) OVER b AS book_id_ratio,
        count_if(has_spoiler) OVER u / count(*) OVER u AS user_id_ratio
    FROM reviews_ r WINDOW b AS (PARTITION BY book_id), u AS (PARTITION BY user_id))"""

_SPLIT = f"substr(md5('80:' || doc_id::VARCHAR), 1, 8) < '{round(0.8 * 0xFFFFFFFF):08x}'"

_PREDICTED = f"""{_DOCUMENTS}, predicted_ AS (
    SELECT doc_id, class, n_chars, (n_chars > {LONG_DOCUMENT})::INTEGER AS prediction FROM documents_),
scores_ AS (
    SELECT label, count_if(class = label) AS support, count_if(prediction = label) AS predicted,
        count_if(class = label AND prediction = label) AS hits
    FROM predicted_, (SELECT unnest([0, 1]) AS label) GROUP BY label),
rates_ AS (
    SELECT label, support, hits, coalesce(hits / nullif(predicted, 0), 0) AS precision,
        coalesce(hits / nullif(support, 0), 0) AS recall,
        coalesce(2 * hits / nullif(support + predicted, 0), 0) AS f1 FROM scores_)"""


def _stop_free(text: str, separator: str, keep: str = "true") -> str:
    """Words of a text without stop words, joined by spaces, as a scalar subquery."""
    return f"""coalesce((SELECT string_agg(w, ' ' ORDER BY i) FROM (
        SELECT unnest(string_split({text}, '{separator}')) AS w,
            generate_subscripts(string_split({text}, '{separator}'), 1) AS i)
        WHERE w NOT IN ({_STOP}) AND {keep}), '')"""


def _clean_text(text: str) -> str:
    step = f"regexp_replace(lower({text}), '<([^>]+)>', '', 'g')"
    step = f"regexp_replace({step}, '[!-/:-@\\[-`{{-~]+', ' ', 'g')"
    step = f"regexp_replace({step}, '{_SPACE_CLASS}+', ' ', 'g')"
    return f"regexp_replace({step}, '[0-9]+', '', 'g')"


_LETTERS_ONLY = f"""plain_ AS (
    SELECT doc_id, regexp_replace(lower(text), '[^a-z]+', ' ', 'g') AS text FROM documents),
letters_ AS (SELECT doc_id, {_stop_free('text', ' ')} AS processed_review FROM plain_)"""

_ML_TOKENS = f"""{_TOKENS}, counts_ AS (
    SELECT doc_id, class, token, count(*) AS n FROM tokens_ GROUP BY ALL)"""

_EMPTY_DOUBLE = "NULL::DOUBLE"


def _linear(slope: str, bend: float, result: str) -> str:
    """All passes of a linear model over term weights, one table each."""
    passes = []
    for i in range(PASSES):
        passes.append(f"""slope_{i} AS (
            SELECT t.doc_id, {slope} AS slope FROM train_ t
            LEFT JOIN (SELECT doc_id, sum(value * weight) AS total FROM x_ JOIN w_{i} USING (token) GROUP BY doc_id) s USING (doc_id)
            CROSS JOIN b_{i}),
        w_{i + 1} AS (
            SELECT token, any_value(weight) - (sum(slope * value) / (SELECT count(*) FROM train_) + {PENALTY} * any_value(weight))
                    / ({bend} * any_value(reach) + {PENALTY}) AS weight,
                any_value(reach) AS reach
            FROM w_{i} JOIN x_ USING (token) JOIN slope_{i} USING (doc_id) GROUP BY token),
        b_{i + 1} AS (
            SELECT any_value(bias) - avg(slope) / ({bend} * any_value(reach)) AS bias, any_value(reach) AS reach
            FROM b_{i} CROSS JOIN slope_{i})""")
    margin = "coalesce(total, 0) + bias"
    passed = ", ".join(passes).replace("{margin}", margin).replace("{side}", "(2 * class - 1)")
    return f"""WITH {_ML_TOKENS.replace("LEFT JOIN", "JOIN")}, train_ AS (SELECT doc_id, class FROM documents_ WHERE {_SPLIT}),
idf_ AS (
    SELECT token, ln(((SELECT count(*) FROM train_) + 1) / (count(*) + 1)) AS idf
    FROM counts_ WHERE {_SPLIT} GROUP BY token),
raw_ AS (SELECT doc_id, token, n * idf AS value FROM counts_ JOIN idf_ USING (token) WHERE idf <> 0),
all_ AS (SELECT doc_id, token, value / sqrt(sum(value * value) OVER (PARTITION BY doc_id)) AS value FROM raw_),
x_ AS (SELECT * FROM all_ WHERE {_SPLIT}), test_ AS (SELECT * FROM all_ WHERE NOT ({_SPLIT})),
mass_ AS (SELECT doc_id, coalesce(sum(abs(value)), 0) + 1 AS mass FROM train_ LEFT JOIN x_ USING (doc_id) GROUP BY doc_id),
w_0 AS (
    SELECT token, 0.0::DOUBLE AS weight, sum(abs(value) * mass) / (SELECT count(*) FROM train_) AS reach
    FROM x_ JOIN mass_ USING (doc_id) GROUP BY token),
b_0 AS (SELECT 0.0::DOUBLE AS bias, avg(mass) AS reach FROM mass_),
{passed},
margin_ AS (
    SELECT d.doc_id, d.class, {margin} AS margin FROM documents_ d
    LEFT JOIN (SELECT doc_id, sum(value * weight) AS total FROM test_ JOIN w_{PASSES} USING (token) GROUP BY doc_id) s USING (doc_id)
    CROSS JOIN b_{PASSES} WHERE NOT ({_SPLIT}))
{result}"""


def _stem_stages() -> str:
    """One table a stage: each word and its letters' shape, v or c."""
    marked = "regexp_replace(regexp_replace(w, '(^|[aeiou])y', '\\1Y', 'g'), 'yy', 'yY', 'g')"
    shape = f"regexp_replace(regexp_replace({marked}, '[^aeiouy]', 'c', 'g'), '[aeiouy]', 'v', 'g')"

    def measure(cut: int, of: str = "s") -> str:
        return f"len(regexp_extract_all(left({of}, len({of}) - {cut}), 'vc'))"

    def cases(found: list[tuple[str, str, str]]) -> str:
        lines = " ".join(f"WHEN suffix(w, '{x}') THEN CASE WHEN {test} THEN {new} ELSE w END" for x, test, new in found)
        return f"CASE {lines} ELSE w END"

    def cut(x: str, new: str = "") -> str:
        return f"left(w, len(w) - {len(x)}) || '{new}'"

    closed = "(suffix(s, 'cvc') AND NOT regexp_matches(w, '[wxy]$'))"
    open_before_e = "NOT (suffix(left(s, len(s) - 1), 'cvc') AND NOT regexp_matches(left(w, len(w) - 1), '[wxy]$'))"
    past = cases([("eed", f"{measure(3)} > 0", "left(w, len(w) - 1)")] + [
        (x, f"contains(left(s, len(s) - {len(x)}), 'v')", f"'+' || left(w, len(w) - {len(x)})") for x in ("ed", "ing")
    ])
    # A + before the word says that its end has to be mended.
    mended = f"""CASE WHEN NOT mend THEN w WHEN regexp_matches(w, '({"|".join(MENDED)})$') THEN w || 'e'
        WHEN suffix(s, 'cc') AND right(w, 1) = left(right(w, 2), 1) AND NOT regexp_matches(w, '[lsz]$') THEN left(w, len(w) - 1)
        WHEN {measure(0)} = 1 AND {closed} THEN w || 'e' ELSE w END"""
    last = [(x, f"{measure(3 if x in ('sion', 'tion') else len(x))} > 1", cut("ion" if x in ("sion", "tion") else x)) for x in LAST]
    stages = [
        cases([(x, "true", cut(x, new)) for x, new in PLURALS]),
        past,
        mended,
        "CASE WHEN suffix(w, 'y') AND contains(left(s, len(s) - 1), 'v') THEN left(w, len(w) - 1) || 'i' ELSE w END",
        cases([(x, f"{measure(len(x))} > 0", cut(x, new)) for x, new in DOUBLE]),
        cases([(x, f"{measure(len(x))} > 0", cut(x, new)) for x, new in LONG]),
        cases(last),
        f"""CASE WHEN suffix(w, 'e') AND ({measure(1)} > 1 OR ({measure(1)} = 1 AND {open_before_e}))
            THEN left(w, len(w) - 1) ELSE w END""",
        f"CASE WHEN suffix(w, 'll') AND {measure(0)} > 1 THEN left(w, len(w) - 1) ELSE w END",
    ]
    tables = ["stage_0 AS (SELECT DISTINCT token, token AS w, false AS mend FROM tokens_)"]
    for i, stage in enumerate(stages):
        tables.append(f"""stage_{i + 1} AS (
            SELECT token, ltrim(new, '+') AS w, prefix(new, '+') AND new <> '+' AND len(token) > 2 AND NOT prefix(w, '+') AS mend FROM (
                SELECT token, w, {stage} AS new FROM (SELECT token, w, mend, {shape} AS s FROM stage_{i})))""")
    return ", ".join(tables) + f""", stems_ AS (
        SELECT token, CASE WHEN len(token) <= 2 THEN token ELSE w END AS stem FROM stage_{len(stages)})"""


_STEMS = f"{_TOKENS}, {_stem_stages()}"

_FOLD = f"(('0x' || left(md5(doc_id::VARCHAR), 7))::BIGINT % {FOLDS})::INTEGER"

_LOGISTIC = ("-{side} / (1 + exp({side} * ({margin})))", 0.25)
_HINGE = ("-2 * {side} * greatest(1 - {side} * ({margin}), 0)", 2.0)

ORACLE: dict[str, str] = {
    "json_roundtrip": _SENTENCES,
    "csv_roundtrip": f"WITH {_ALL_DOCUMENTS} SELECT doc_id, class, {_clean('review')} AS review FROM documents_",
    "bounded_scan": "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 5000",
    "hash_pick": """SELECT doc_id, source, n_chars FROM documents
ORDER BY md5('7:' || doc_id::VARCHAR), doc_id LIMIT 1""",
    "explode_sentences": _SENTENCES,
    "assemble_reviews": """SELECT conv_id AS review_id, role AS class, string_agg(text, ' ' ORDER BY turn) AS review
FROM conversations GROUP BY conv_id, role""",
    "assemble_nested": f"""WITH {_ALL_LINES}
SELECT review_id, class, review, book_id, user_id, rating, has_spoiler FROM nested_ JOIN reviews_ USING (review_id)""",
    "review_left_join": f"""WITH {_ALL_LINES}
SELECT review_id, class, review, book_id, rating, has_spoiler FROM nested_ LEFT JOIN reviews_ USING (review_id)""",
    "split_sentences": f"""WITH lines_ AS (
    SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS l,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM conversations)
SELECT conv_id, turn, line::INTEGER AS line,
    (generate_subscripts(string_split(trim(l, {_SPACE}), '. '), 1) - 1)::INTEGER AS part,
    unnest(string_split(trim(l, {_SPACE}), '. ')) AS review FROM lines_""",
    "class_counts": f"""WITH {_ALL_LINES}
SELECT class::INTEGER AS class, count(*) AS n, grouping(class)::INTEGER AS is_total
FROM nested_ GROUP BY ROLLUP (class)""",
    "avg_length_by_class": f"WITH {_LENGTHS.replace(_LINES, _ALL_LINES)} SELECT class, round(avg(length), 6) AS avg_length FROM lengths_ GROUP BY class",
    "avg_total_length": f"""WITH {_LENGTHS} SELECT has_spoiler, round(avg(total), 6) AS avg_length
FROM (SELECT review_id, has_spoiler, sum(length) AS total FROM lengths_ GROUP BY ALL) GROUP BY has_spoiler""",
    "stopped_length": f"""WITH {_TOKENS}
SELECT d.doc_id, d.class, count(t.token)::INTEGER AS length
FROM documents_ d LEFT JOIN tokens_ t USING (doc_id) GROUP BY d.doc_id, d.class""",
    "null_audit": "WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count_if({c} IS NULL)::BIGINT AS nulls FROM j"
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    "user_ratio": f"SELECT user_id, flagged, total, round(ratio, 6) AS ratio FROM ({_USER})",
    "book_ratio": f"SELECT book_id, flagged, total, round(ratio, 6) AS ratio FROM ({_BOOK})",
    "ratio_features": f"""WITH {_REVIEW_RATIOS} SELECT review_id, round(book_id_ratio, 6) AS book_id_ratio,
    round(user_id_ratio, 6) AS user_id_ratio FROM ratios_""",
    "minmax_length": f"""WITH {_DOCUMENTS}, l AS (
    SELECT doc_id, class, length({_clean('review')})::INTEGER AS length FROM documents_)
SELECT doc_id, class, length, round((length - min(length) OVER c)
    / nullif(max(length) OVER c - min(length) OVER c, 0), 6) AS scaled FROM l WINDOW c AS (PARTITION BY class)""",
    "minmax_rating": """SELECT c_custkey, round((c_acctbal - min(c_acctbal) OVER ())
    / nullif(max(c_acctbal) OVER () - min(c_acctbal) OVER (), 0), 6) AS scaled FROM customer""",
    "describe_numeric": " UNION ALL ".join(_describe(c) for c in FEATURES),
    "correlation_matrix": " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS r FROM lineitem"
        for x in FEATURES
        for y in FEATURES
    ),
    "label_encode": """SELECT event_id, event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS code FROM events""",
    "systematic_sample": f"""WITH {_SCALED}, {_sampled('scaled_', 'class', 'doc_id', 'scaled', RATIO_POINTS)}
SELECT class, doc_id, scaled, j FROM sample_""",
    "sorted_curve": f"""WITH {_SCALED}, {_sampled('scaled_', 'class', 'doc_id', 'scaled', LENGTH_POINTS)}
SELECT class, (row_number() OVER c - 1)::INTEGER AS j, round((row_number() OVER c - 1) / {LENGTH_POINTS - 1}.0, 6)::DOUBLE AS x,
    scaled AS y FROM sample_ WINDOW c AS (PARTITION BY class ORDER BY scaled)""",
    "ratio_curve": f"""WITH named_ AS (
    SELECT 'user' AS series, user_id::VARCHAR AS key, ratio FROM ({_USER})
    UNION ALL SELECT 'book', book_id, ratio FROM ({_BOOK})),
scaled_ AS (
    SELECT series, key, (ratio - min(ratio) OVER s) / nullif(max(ratio) OVER s - min(ratio) OVER s, 0) AS scaled
    FROM named_ WINDOW s AS (PARTITION BY series)),
{_sampled('scaled_', 'series', 'key', 'scaled', RATIO_POINTS)}
SELECT series, (row_number() OVER c - 1)::INTEGER AS j, round((row_number() OVER c - 1) / {RATIO_POINTS - 1}.0, 6)::DOUBLE AS x,
    round(scaled, 6) AS y FROM sample_ WINDOW c AS (PARTITION BY series ORDER BY scaled)""",
    "quantile_curve": f"""WITH {_DOCUMENTS}, q AS (
    SELECT class, quantile_cont(length(review), [{', '.join(str(j / (LENGTH_POINTS - 1)) for j in range(LENGTH_POINTS))}]) AS found
    FROM documents_ GROUP BY class)
SELECT class, (generate_subscripts(found, 1) - 1)::BIGINT AS j,
    round((generate_subscripts(found, 1) - 1) / {LENGTH_POINTS - 1}.0, 6)::DOUBLE AS p, round(unnest(found), 6) AS quantile FROM q""",
    "token_counts": f"WITH {_TOKENS} SELECT token, count(*) AS n FROM tokens_ GROUP BY token",
    "tf": f"WITH {_TF} SELECT doc_id, class, source, token, round(tf, 6) AS tf FROM tf_",
    "sentence_tf": f"""WITH documents_ AS (
    SELECT conv_id || '/' || role AS doc_id, string_agg(text, ' ' ORDER BY turn) AS review FROM conversations GROUP BY conv_id, role),
split_ AS (SELECT doc_id, {_words(_clean('review'), '[ \\x09-\\x0d]')} AS token FROM documents_)
SELECT doc_id, token, round(count(*) / sum(count(*)) OVER (PARTITION BY doc_id), 6) AS tf
FROM split_ WHERE token NOT IN ({_STOP}) GROUP BY doc_id, token""",
    "idf": f"WITH {_TF} SELECT token, df, round(idf, 6) AS idf FROM idf_",
    "tfidf": _TFIDF,
    "tfidf_join": _TFIDF,
    "item_specificity": f"""WITH {_WEIGHTS}, ranked_ AS (
    SELECT class, token, max(tf_idf) OVER (PARTITION BY class) AS specificity,
        row_number() OVER (PARTITION BY class ORDER BY round(tf_idf, 9) DESC, token) AS r FROM weights_ WHERE class IS NOT NULL)
SELECT class, round(specificity, 6) AS specificity, token FROM ranked_ WHERE r = 1""",
    "top_terms_for_source": f"""WITH {_WEIGHTS} SELECT doc_id, token, round(tf_idf, 6) AS tf_idf FROM weights_
WHERE source = '{BOOK}' ORDER BY round(tf_idf, 6) DESC, token, doc_id LIMIT 100""",
    "bottom_terms": f"""WITH {_WEIGHTS} SELECT doc_id, token, round(tf_idf, 6) AS tf_idf FROM weights_
WHERE source = '{BOOK}' ORDER BY round(tf_idf, 6), token, doc_id LIMIT 100""",
    "top_terms_per_source": f"""WITH {_WEIGHTS}, ranked_ AS (
    SELECT source, doc_id, token, round(tf_idf, 6) AS tf_idf, row_number() OVER (
        PARTITION BY source ORDER BY round(tf_idf, 6) DESC, token, doc_id)::INTEGER AS rank FROM weights_)
SELECT source, doc_id, token, tf_idf, rank FROM ranked_ WHERE rank <= 100""",
    "boosted_term_counts": f"""WITH {_WEIGHTS}, top_ AS (
    SELECT token FROM weights_ WHERE source = '{BOOK}' ORDER BY round(tf_idf, 6) DESC, token, doc_id LIMIT 100),
bag_ AS (SELECT token FROM top_ UNION ALL SELECT unnest({[BOOST] * BOOST_TIMES})),
counts_ AS (SELECT token, count(*) AS n FROM bag_ GROUP BY token ORDER BY n DESC, token LIMIT 100)
SELECT token, n, round(n / max(n) OVER (), 6) AS weight FROM counts_""",
    "clean_punct": f"SELECT doc_id, {_clean('text')} AS review FROM documents",
    "clean_text": f"""WITH bare_ AS (SELECT conv_id, turn, {_clean_text('text')} AS text FROM conversations),
clean_ AS (SELECT conv_id AS review_id, turn AS pos, {_stop_free('text', ' ', 'length(w) >= 3')} AS clean_review FROM bare_)
SELECT * FROM clean_ WHERE clean_review <> ''""",
    "clean_pages": f"""WITH bare_ AS (SELECT page_id, {_clean_text('html')} AS text FROM pages)
SELECT page_id, {_stop_free('text', ' ', 'length(w) >= 3')} AS text FROM bare_""",
    "letters_only": f"WITH {_LETTERS_ONLY} SELECT doc_id, processed_review FROM letters_",
    "char_counts": f"""WITH {_LETTERS_ONLY}, chars_ AS (
    SELECT doc_id, unnest(string_split(processed_review, '')) AS char FROM letters_),
kept_ AS (SELECT doc_id, char FROM chars_ WHERE contains('{LETTERS}', char) AND char <> ''),
grid_ AS (SELECT unnest(string_split('{LETTERS}', '')) AS char)
SELECT char, count(doc_id)::BIGINT AS n FROM grid_ LEFT JOIN kept_ USING (char) GROUP BY char
UNION ALL SELECT ' ', sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM kept_ GROUP BY doc_id)""",
    "vocabulary_conflation": f"""WITH {_TOKENS}, vocabulary_ AS (SELECT token, count(*) AS n FROM tokens_ GROUP BY token)
SELECT CASE WHEN length(token) <= 2 THEN token
    WHEN token LIKE '%sses' OR token LIKE '%ies' THEN left(token, length(token) - 2)
    WHEN token LIKE '%ss' OR token NOT LIKE '%s' THEN token
    ELSE left(token, length(token) - 1) END AS stem, sum(n)::BIGINT AS n, count(*) AS forms
FROM vocabulary_ GROUP BY stem""",
    "split_counts": f"""WITH {_DOCUMENTS} SELECT {_SPLIT} AS train, class, count(*) AS n FROM documents_ GROUP BY ALL""",
    "split_anti": f"WITH {_ALL_DOCUMENTS} SELECT doc_id, class FROM documents_ WHERE NOT ({_SPLIT})",
    "weighted_f1": f"""WITH {_PREDICTED} SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
    sum(support)::BIGINT AS n FROM rates_""",
    "auc": f"""WITH {_DOCUMENTS}, ranks_ AS (
    SELECT class, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2 AS r FROM documents_)
SELECT count_if(class = 1)::BIGINT AS positives, count_if(class = 0)::BIGINT AS negatives,
    round((sum(r) FILTER (class = 1) - count_if(class = 1) * (count_if(class = 1) + 1) / 2)
        / (count_if(class = 1) * count_if(class = 0)), 6) AS auc FROM ranks_""",
    "confusion_matrix": f"""WITH {_PREDICTED}
SELECT y AS class, p AS prediction, count(predicted_.class) AS n
FROM (SELECT unnest([0, 0, 1, 1]) AS y, unnest([0, 1, 0, 1]) AS p)
LEFT JOIN predicted_ ON class = y AND prediction = p GROUP BY y, p""",
    "class_report": f"""WITH {_PREDICTED}
SELECT label::VARCHAR AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
    support::BIGINT AS support FROM rates_
UNION ALL SELECT 'accuracy', {_EMPTY_DOUBLE}, {_EMPTY_DOUBLE}, round(sum(hits) / sum(support), 6), sum(support)::BIGINT FROM rates_
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM rates_
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
    round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM rates_""",
    "count_vector_terms": f"WITH {_ML_TOKENS} SELECT doc_id, token, n FROM counts_",
    "ml_tfidf_terms": f"""WITH {_ML_TOKENS}, df_ AS (
    SELECT token, ln(((SELECT count(*) FROM documents_) + 1) / (count(*) + 1)) AS w FROM counts_ GROUP BY token)
SELECT doc_id, token, round(n * w, 6) AS weight FROM counts_ JOIN df_ USING (token)""",
    "nb_predictions": f"""WITH {_ML_TOKENS.replace("LEFT JOIN", "JOIN")},
size_ AS (SELECT count(DISTINCT token) AS v FROM counts_),
prior_ AS (
    SELECT class, ln((count(*) + 1) / ((SELECT count(*) FROM documents_) + 2)) AS lp FROM documents_ GROUP BY class),
total_ AS (SELECT class, sum(n) AS total FROM counts_ GROUP BY class),
cell_ AS (SELECT class, token, sum(n) AS n FROM counts_ GROUP BY class, token),
score_ AS (
    SELECT d.doc_id, d.class, p.class AS guess, p.lp + coalesce(sum(
        c.n * (ln(coalesce(k.n, 0) + 1) - ln(t.total + s.v))), 0) AS score
    FROM documents_ d CROSS JOIN prior_ p JOIN total_ t ON t.class = p.class CROSS JOIN size_ s
    LEFT JOIN counts_ c ON c.doc_id = d.doc_id LEFT JOIN cell_ k ON k.token = c.token AND k.class = p.class
    GROUP BY d.doc_id, d.class, p.class, p.lp)
SELECT doc_id, class, arg_max(guess, score) AS prediction FROM score_ GROUP BY doc_id, class""",
    "lr_term_weights": _linear(*_LOGISTIC, f"""SELECT token, round(weight, 6) AS weight FROM w_{PASSES}
UNION ALL SELECT '', round(bias, 6) FROM b_{PASSES}"""),
    "lr_term_predictions": _linear(*_LOGISTIC, """SELECT doc_id, class, (margin > 0)::INTEGER AS prediction,
    round(1 / (1 + exp(-margin)), 6) AS p1 FROM margin_"""),
    "lr_auc": _linear(*_LOGISTIC, """, rounded_ AS (SELECT class, round(margin, 9) AS m FROM margin_),
ranks_ AS (SELECT class, rank() OVER (ORDER BY m) + (count(*) OVER (PARTITION BY m) - 1) / 2 AS r FROM rounded_)
SELECT count_if(class = 1)::BIGINT AS positives, count_if(class = 0)::BIGINT AS negatives,
    round((sum(r) FILTER (class = 1) - count_if(class = 1) * (count_if(class = 1) + 1) / 2)
        / (count_if(class = 1) * count_if(class = 0)), 6) AS auc FROM ranks_"""),
    "svc_term_predictions": _linear(
        *_HINGE, "SELECT doc_id, class, (margin > 0)::INTEGER AS prediction, round(margin, 6) AS margin FROM margin_"
    ),
    "nb_cross_validation": f"""WITH {_ML_TOKENS.replace("LEFT JOIN", "JOIN")},
fold_of_ AS (SELECT doc_id, {_FOLD} AS fold FROM documents_),
docs_ AS (SELECT doc_id, class, fold FROM documents_ JOIN fold_of_ USING (doc_id)),
bags_ AS (SELECT doc_id, class, fold, token, n FROM counts_ JOIN fold_of_ USING (doc_id)),
folds_ AS (SELECT unnest(range({FOLDS}))::INTEGER AS fold),
grid_ AS (SELECT unnest({list(SMOOTHINGS)})::DOUBLE AS smoothing),
classes_ AS (SELECT DISTINCT class AS guess FROM docs_),
cell_ AS (
    SELECT f.fold, b.class AS guess, b.token, sum(b.n) AS n FROM folds_ f JOIN bags_ b ON b.fold <> f.fold
    GROUP BY f.fold, b.class, b.token),
known_ AS (SELECT DISTINCT fold, token FROM cell_),
kinds_ AS (SELECT fold, count(*) AS v FROM known_ GROUP BY fold),
total_ AS (SELECT fold, guess, sum(n) AS t FROM cell_ GROUP BY fold, guess),
prior_ AS (
    SELECT f.fold, c.guess, ln((count_if(d.class = c.guess) + 1) / (count(*) + (SELECT count(*) FROM classes_))) AS lp
    FROM folds_ f JOIN docs_ d ON d.fold <> f.fold CROSS JOIN classes_ c GROUP BY f.fold, c.guess),
score_ AS (
    SELECT d.doc_id, d.class, d.fold, g.smoothing, p.guess, any_value(p.lp) + coalesce(sum(
        CASE WHEN k.token IS NOT NULL THEN b.n * (ln(coalesce(c.n, 0) + g.smoothing) - ln(t.t + g.smoothing * v.v)) END), 0) AS score
    FROM docs_ d CROSS JOIN grid_ g JOIN prior_ p ON p.fold = d.fold JOIN total_ t ON t.fold = d.fold AND t.guess = p.guess
    JOIN kinds_ v ON v.fold = d.fold LEFT JOIN bags_ b ON b.doc_id = d.doc_id
    LEFT JOIN known_ k ON k.fold = d.fold AND k.token = b.token
    LEFT JOIN cell_ c ON c.fold = d.fold AND c.token = b.token AND c.guess = p.guess
    GROUP BY d.doc_id, d.class, d.fold, g.smoothing, p.guess),
guess_ AS (SELECT doc_id, class, fold, smoothing, arg_max(guess, score) AS prediction FROM score_ GROUP BY ALL),
f1_ AS (
    SELECT fold, smoothing, c.guess, count_if(class = c.guess) AS support,
        coalesce(2 * count_if(class = c.guess AND prediction = c.guess)
            / nullif(count_if(class = c.guess) + count_if(prediction = c.guess), 0), 0) AS f1
    FROM guess_ CROSS JOIN classes_ c GROUP BY fold, smoothing, c.guess)
SELECT fold, smoothing, round(sum(f1 * support) / sum(support), 6) AS weighted_f1, sum(support)::BIGINT AS n
FROM f1_ GROUP BY fold, smoothing""",
    "json_quarantine": f"""WITH {_ALL_DOCUMENTS}, lines_ AS (
    SELECT doc_id, CASE WHEN {_SPLIT} THEN '' WHEN class IS NULL THEN '{NO_OBJECT}' ELSE '{OTHER_TYPE}' END AS reason FROM documents_)
SELECT reason, count(*) AS n, (sum(doc_id) FILTER (reason = ''))::BIGINT AS keys FROM lines_ GROUP BY reason""",
    "item_lookup": f"""WITH {_WEIGHTS}
SELECT source, doc_id, token, round(tf_idf, 6) AS tf_idf FROM weights_ WHERE source = '{BOOK}'""",
    "cooccurrence_pmi": f"""WITH bare_ AS (SELECT conv_id, turn, {_clean_text('text')} AS text FROM conversations),
clean_ AS (SELECT conv_id, turn, {_stop_free('text', ' ', 'length(w) >= 3')} AS clean_review FROM bare_),
words_ AS (
    SELECT conv_id, turn, unnest(string_split(clean_review, ' ')) AS w,
        generate_subscripts(string_split(clean_review, ' '), 1) AS i FROM clean_ WHERE clean_review <> ''),
pairs_ AS (
    SELECT a.w AS token, b.w AS context, count(*) AS n FROM words_ a JOIN words_ b USING (conv_id, turn)
    WHERE b.i <> a.i AND b.i BETWEEN a.i - {WINDOW} AND a.i + {WINDOW} GROUP BY a.w, b.w),
single_ AS (SELECT token, sum(n) AS met FROM pairs_ GROUP BY token),
pmi_ AS (
    SELECT p.token, p.context, n, ln(n * (SELECT sum(met) FROM single_)::DOUBLE / (s.met::DOUBLE * c.met)) AS pmi
    FROM pairs_ p JOIN single_ s ON s.token = p.token JOIN single_ c ON c.token = p.context)
SELECT token, context, n, round(pmi, 6) AS pmi FROM pmi_ WHERE pmi > 0""",
    "mutual_information": f"""WITH {_ML_TOKENS.replace("LEFT JOIN", "JOIN")},
size_ AS (SELECT class, count(*)::DOUBLE AS size FROM documents_ GROUP BY class),
all_ AS (SELECT sum(size) AS total FROM size_),
df_ AS (SELECT token, count(*) AS df FROM counts_ GROUP BY token),
cell_ AS (
    SELECT token, df, size, total, count(c.doc_id) AS n
    FROM df_ CROSS JOIN size_ s CROSS JOIN all_ LEFT JOIN counts_ c USING (token, class) GROUP BY ALL),
mi_ AS (
    SELECT token, df, sum(CASE WHEN n > 0 THEN n / total * ln(n * total / (df * size)) ELSE 0 END
        + CASE WHEN size - n > 0 THEN (size - n) / total * ln((size - n) * total / ((total - df) * size)) ELSE 0 END) AS mi
    FROM cell_ GROUP BY token, df)
SELECT token, df, round(mi, 6) AS mi FROM mi_ ORDER BY round(mi, 9) DESC, token LIMIT 100""",
    "porter_vocabulary": f"WITH {_STEMS} SELECT token, stem FROM stems_",
    "stemmed_term_counts": f"""WITH {_STEMS}
SELECT doc_id, stem, count(*) AS n FROM tokens_ JOIN stems_ USING (token) GROUP BY doc_id, stem""",
    "exact_split": f"""WITH {_ALL_DOCUMENTS}
SELECT doc_id, class, row_number() OVER (PARTITION BY class ORDER BY left(md5('80:' || doc_id::VARCHAR), 15), doc_id)
    <= floor(count(*) OVER (PARTITION BY class) * 0.8 + 0.5) AS chosen FROM documents_""",
    "gnb_predictions": f"""WITH entries_ AS (
    SELECT vec_id, label, {_SPLIT.replace("doc_id", "vec_id")} AS train, unnest(embedding)::DOUBLE AS x,
        generate_subscripts(embedding, 1) AS place FROM embeddings),
more_ AS (SELECT {SHARE} * max(v) + {TINY} AS more FROM (SELECT var_pop(x) AS v FROM entries_ WHERE train GROUP BY place)),
class_ AS (
    SELECT label AS guess, place, avg(x) AS m, var_pop(x) + any_value(more) AS v, count(*) AS n
    FROM entries_, more_ WHERE train GROUP BY label, place),
prior_ AS (SELECT guess, ln(n / sum(n) OVER ()) AS lp FROM class_ WHERE place = 1),
score_ AS (
    SELECT vec_id, label, guess, any_value(lp) - sum(ln(2 * pi() * v) + (x - m) * (x - m) / v) / 2 AS score
    FROM entries_ JOIN class_ USING (place) JOIN prior_ USING (guess) WHERE NOT train GROUP BY vec_id, label, guess)
SELECT vec_id, label, arg_max(guess, score) AS prediction FROM score_ GROUP BY vec_id, label""",
    "model_roundtrip": f"WITH {_DOCUMENTS} SELECT doc_id, true AS same_logistic, true AS same_forest FROM documents_",
    "feature_table": f"""WITH {_REVIEW_RATIOS}, plain_ AS (
    SELECT doc_id::VARCHAR AS review_id, regexp_replace(lower(string_agg(reviews, ' ' ORDER BY pos)), '[^a-z]+', ' ', 'g') AS text
    FROM sentences_ GROUP BY doc_id)
SELECT review_id, has_spoiler::BIGINT AS has_spoiler, round(book_id_ratio, 6) AS book_id_ratio,
    round(user_id_ratio, 6) AS user_id_ratio,
    round((rating - min(rating) OVER ()) / nullif(max(rating) OVER () - min(rating) OVER (), 0), 6) AS rating,
    {_stop_free('text', ' ')} AS processed_review FROM ratios_ JOIN plain_ USING (review_id)""",
}
