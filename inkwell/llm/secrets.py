"""Secret scans: patterns, and a randomness test battery under false-discovery control.

Only DataFrame functions are used. Two kinds of spans are found in each whole text.

*Base spans*, the leftmost matches of three patterns that do not overlap within a kind:
``assign`` (a named secret, the whole match; the value has 12 characters or more),
``access`` (18 or more) and ``hex`` (16 or more). Shorter matches are dropped.

*Random spans* (``random``) are runs of 20 or more letters, digits and ``+/_=-`` that
no base span overlaps, and that look random in their encoding. The encoding is inferred
from the characters: hex, base 32, letters and digits, or base 64. Three tests give
p-values under the hypothesis that the characters are drawn evenly and independently:
chi-squared against the uniform alphabet, the number of runs above and below the middle of
the alphabet, and the correlation of each character with the next. Fisher's method
combines them.

False discoveries are runs that are not random. Under the hypothesis p-values are uniform,
so within a stratum (encoding and length class) the p-values over one half tell how many
random runs there are, and the excess among small p-values how many are not (Storey). The
p-value from which on a run counts as random is the smallest at which at most ``SHARE`` of the
accepted runs are estimated to be not random. Short runs, whose tests are weak, are so
held against runs of their own length. Strata are few and p-values are counted in 100 bins, so the
thresholds come from a table of bounded size.

Defined results: a null or empty text has no spans. Repeated rows get equal spans. Rows
with a null key are scanned like others. Positions are code points, the end exclusive.
Columns other than those named are returned as they are; clashing ones are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.operators.derive import compute_once
from inkwell.session import keep

# The base patterns, in the order of their kinds, and the least length of
# what they find.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": (ASSIGN, 12), "access": (r"AKIA[A-Z0-9]+", 18), "hex": (r"[0-9a-f]+", 16)}
# What scans the text: the same matches as BASE, without the many short ones of hex.
_SCANS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"(?<![0-9a-f])[0-9a-f]{16,}"}
KINDS = (*BASE, "random")

RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: Encodings in the order in which they are tried: their characters, and a pattern that text in it has.
ENCODINGS = {
    "hex": ("0123456789abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$"),
    "HEX": ("0123456789ABCDEF", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$"),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$"),
    "base36": ("0123456789abcdefghijklmnopqrstuvwxyz", r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$"),
    "base62": (
        "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
        r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9]+=*$",
    ),
    "base64": (
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
        r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/]+=*$",
    ),
    "base64url": (
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
        r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9_-]+=*$",
    ),
}
#: The estimated share of accepted runs that are not random is at most this.
SHARE = 0.1
#: A run with a smaller p-value than this is never accepted.
LEAST_P = 0.01
_BINS = 100
REDACTED = "[redacted]"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, kind: str, none, join) -> Column:
    """What ``join`` makes of each value and all before it; ``none`` joins without effect.

    An array that grows by one costs the square of its length, so the values are cut into as many blocks
    as each has values, and the blocks' totals run on their own.
    """
    start = F.lit(none).cast(kind)

    def along(block: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(start.alias("at"), F.array().cast(f"array<{kind}>").alias("out")),
            lambda done, x: let(join(done["at"], x), lambda now: F.struct(
                now.alias("at"), F.concat(done["out"], F.array(now)).cast(f"array<{kind}>").alias("out")
            )),
        )["out"]

    def joined(blocks: Column) -> Column:
        totals = along(F.transform(blocks, lambda b: F.coalesce(F.get(b, F.size(b) - 1), start)))
        return let(totals, lambda t: F.flatten(F.transform(blocks, lambda b, i: let(
            F.coalesce(F.get(t, i - 1), start), lambda before: F.transform(b, lambda x: join(before, x))
        ))))

    return let(values, lambda v: let(F.transform(blocks_of(v), along), joined))


def blocks_of(values: Column) -> Column:
    """An array cut into about as many pieces as each of them is long; ``values`` is named more than once."""
    wide = F.greatest(F.ceil(F.sqrt(F.size(values))), F.lit(1)).cast("int")
    last = F.greatest(F.floor((F.size(values) - 1) / wide), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * wide + 1, wide))


def located(text: Column, pattern: str) -> Column:
    """Start, end and string of all matches of a pattern, from the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pieces = F.filter(
        F.zip_with(between, found, lambda gap, run: F.struct(
            (F.char_length(gap) + F.char_length(run)).alias("moves"), F.char_length(run).alias("length"), run.alias("run")
        )),
        lambda p: p["run"].isNotNull(),
    )

    def placed(v: Column) -> Column:
        ends = running(F.transform(v, lambda p: p["moves"]), "int", 0, lambda a, x: a + x)
        return F.zip_with(
            v, ends, lambda p, end: F.struct((end - p["length"]).alias("start"), end.alias("end"), p["run"].alias("run"))
        )

    return let(pieces, placed)


def _spans_of(text: Column, order: int, kind: str) -> Column:
    pattern, least = BASE[kind]
    value = lambda s: F.regexp_extract(s["run"], pattern, 2) if kind == "assign" else s["run"]
    return F.transform(
        F.filter(located(text, _SCANS[kind]), lambda s: F.char_length(value(s)) >= least),
        lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("kind"), s["end"].alias("end")),
    )


def _base_spans(text: Column) -> Column:
    """Base spans as an array of (start, place of the kind, end), sorted."""
    parts = [_spans_of(text, order, kind) for order, kind in enumerate(BASE)]
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.when(text.rlike("|".join(_SCANS.values())), F.array_sort(F.concat(*parts))).otherwise(none)


def _encoding(run: Column) -> Column:
    """Name of the first encoding that a run fits; null: none."""
    return F.coalesce(*[F.when(run.rlike(p), F.lit(name)) for name, (_, p) in ENCODINGS.items()])


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal distribution, to seven digits (a rational fit)."""
    # The usual constants of this approximation of the error function.
    weights = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    series = lambda t: reduce(lambda a, w: (a + w) * t, reversed(weights), F.lit(0.0))
    near = let(1 / (1 + F.abs(z) / 2**0.5 * 0.3275911), series) * F.exp(-z * z / 2) / 2
    return let(F.greatest(near, F.lit(1e-12)), lambda tail: F.when(z >= 0, tail).otherwise(1 - tail))


def p_value(run: Column, encoding: Column) -> Column:
    """The battery's p-value of a run under even, independent characters of its encoding."""
    alphabets = F.create_map(*[F.lit(x) for name, (letters, _) in ENCODINGS.items() for x in (name, letters)])

    def of_codes(v: Column) -> Column:
        codes, size, n = v["codes"], v["size"], F.size(v["codes"])
        counts = F.transform(
            F.array_distinct(codes), lambda c: F.pow(F.size(F.filter(codes, lambda x: x == c)).cast("double"), F.lit(2.0))
        )
        return let(
            F.struct(
                codes.alias("codes"),
                size.alias("size"),
                n.cast("double").alias("n"),
                (_total(counts) * size / n - n).alias("chi"),
                F.transform(codes, lambda c: c * 2 >= size).alias("high"),
                (_total(codes) / n).alias("mean"),
            ),
            of_counts,
        )

    def neighbours(values: Column, both) -> Column:
        n = F.size(values)
        return F.zip_with(F.slice(values, F.lit(2), n - 1), F.slice(values, F.lit(1), n - 1), both)

    def of_counts(v: Column) -> Column:
        codes, mean, n = v["codes"], v["mean"], v["n"]
        ups = F.size(F.filter(v["high"], lambda h: h)).cast("double")
        return let(
            F.struct(
                n.alias("n"),
                v["chi"].alias("chi"),
                (v["size"] - 1).alias("free"),
                _total(neighbours(v["high"], lambda a, b: (a != b).cast("double"))).alias("changes"),
                (2 * ups * (n - ups) / n).alias("expected"),
                _total(F.transform(codes, lambda c: (c - mean) * (c - mean))).alias("squares"),
                _total(neighbours(codes, lambda a, b: (a - mean) * (b - mean))).alias("products"),
            ),
            of_sums,
        )

    def of_sums(v: Column) -> Column:
        # Chi-squared made normal by Wilson and Hilferty.
        even = (F.pow(F.greatest(v["chi"], F.lit(1e-9)) / v["free"], F.lit(1 / 3)) - (1 - 2 / (9 * v["free"]))) / F.sqrt(2 / (9 * v["free"]))
        # Runs above and below the middle: one more than changes, expected one more, too.
        spread = v["expected"] * (v["expected"] - 1) / (v["n"] - 1)
        runs = F.when(spread > 0, F.abs(v["changes"] - v["expected"]) / F.sqrt(spread)).otherwise(F.lit(12.0))
        # Correlation of each character with the next one.
        serial = F.when(v["squares"] > 0, F.abs(v["products"] / v["squares"] + 1 / v["n"]) * F.sqrt(v["n"])).otherwise(F.lit(12.0))
        sides = [let(even, _upper_tail), 2 * let(runs, _upper_tail), 2 * let(serial, _upper_tail)]
        # Fisher: minus twice the sum of the logarithms is chi-squared with 6 degrees of freedom.
        half = reduce(lambda a, b: a + b, [-F.ln(F.least(p, F.lit(1.0))) for p in sides])
        return let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))

    def of_alphabet(alphabet: Column) -> Column:
        letters = F.split(F.regexp_replace(run, "=+$", ""), "(?!^)(?!$)")
        return let(
            F.struct(
                F.transform(letters, lambda c: (F.instr(alphabet, c) - 1).cast("double")).alias("codes"),
                F.char_length(alphabet).cast("double").alias("size"),
            ),
            of_codes,
        )

    return let(alphabets[encoding], of_alphabet)


def _length_class(run: Column) -> Column:
    """0: 20 to 31 characters, 1: to 63, 2: to 127, 3: longer."""
    n = F.char_length(run)
    return F.when(n < 32, 0).when(n < 64, 1).when(n < 128, 2).otherwise(3)


def scan(documents: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry``, base and runs of each row: its base spans, and the runs to be tested.

    base holds (start, place of the kind in KINDS, end); runs holds (start, end, encoding,
    length class, p) of runs that overlap no base span and fit an encoding.
    """
    return _tested(documents.select(F.struct(*[F.col(c) for c in carry]).alias("_carried"), _whole(text)))


def _whole(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).alias("_whole")


def _tested(rows: DataFrame) -> DataFrame:
    """base and runs of each text in ``_whole``, beside the other columns."""
    carried = [c for c in rows.columns if c != "_whole"]
    rows = compute_once(rows, "base", _base_spans(F.col("_whole")))
    none = F.array().cast("array<struct<start:int,end:int,run:string>>")
    runs = F.when(F.col("_whole").rlike(RUN), located(F.col("_whole"), RUN)).otherwise(none)
    rows = compute_once(rows, "_runs", runs)
    free = F.when((F.size("base") == 0) | (F.size("_runs") == 0), F.col("_runs")).otherwise(_apart(F.col("_runs"), F.col("base")))
    encoded = F.filter(
        F.transform(free, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["run"].alias("run"), _encoding(r["run"]).alias("encoding"))),
        lambda r: r["encoding"].isNotNull(),
    )
    tested = F.transform(
        encoded,
        lambda r: F.struct(
            r["start"].alias("start"),
            r["end"].alias("end"),
            r["encoding"].alias("encoding"),
            _length_class(r["run"]).alias("length_class"),
            p_value(r["run"], r["encoding"]).alias("p"),
        ),
    )
    return rows.select(*carried, "base", tested.alias("runs"))


def _apart(runs: Column, base: Column) -> Column:
    """The runs that overlap no base span; both are sorted by start.

    All are put into one order. A run is met by a base span before it that ends after the run's start, or by the
    next base span after it if that starts before the run's end.
    """
    far = F.lit(2**31 - 1)
    spans = F.array_sort(F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(-1).alias("run"), b["end"].alias("end"))),
        F.transform(runs, lambda r, i: F.struct(r["start"].alias("start"), i.alias("run"), r["end"].alias("end"))),
    ))

    def chosen(v: Column) -> Column:
        ends = running(F.transform(v, lambda s: F.when(s["run"] < 0, s["end"]).otherwise(0)), "int", 0, F.greatest)
        later = F.reverse(F.transform(v, lambda s: F.when(s["run"] < 0, s["start"]).otherwise(far)))
        starts = F.reverse(running(later, "int", 2**31 - 1, F.least))
        met = F.zip_with(v, F.arrays_zip(ends.alias("end"), starts.alias("start")), lambda s, o: F.struct(
            s["run"].alias("run"), ((o["end"] <= s["start"]) & (o["start"] >= s["end"])).alias("free")
        ))
        return F.transform(F.filter(met, lambda m: (m["run"] >= 0) & m["free"]), lambda m: F.get(runs, m["run"]))

    return let(spans, chosen)


def thresholds(scanned: DataFrame, share: float = SHARE) -> DataFrame:
    """encoding, length_class and least_p: from which p-value on a run counts as random.

    At most one row for each encoding and length class; a stratum where no threshold
    reaches the share is left out.
    """
    bin_ = F.least(F.floor(F.col("r.p") * _BINS), F.lit(_BINS - 1)).cast("int")
    counts = (
        scanned.select(F.explode("runs").alias("r"))
        .groupBy("r.encoding", "r.length_class", bin_.alias("bin"))
        .agg(F.count("*").alias("n"))
        .groupBy("encoding", "length_class")
        .agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin"), F.sum("n").alias("n"))
    )
    at_least = lambda b: F.aggregate(
        F.map_entries("by_bin"), F.lit(0).cast("bigint"), lambda a, e: a + F.when(e["key"] >= b, e["value"]).otherwise(0)
    )
    # Truly random runs, from the upper half of the p-values; one more to be careful with few.
    random_runs = F.least((at_least(F.lit(_BINS // 2)) + 1) * 2.0, F.col("n").cast("double"))
    accepted = F.filter(
        F.sequence(F.lit(int(LEAST_P * _BINS)), F.lit(_BINS - 1)),
        lambda b: 1 - F.least(random_runs * (1 - b / _BINS) / F.greatest(at_least(b), F.lit(1)), F.lit(1.0)) <= share,
    )
    return counts.select("encoding", "length_class", (F.get(accepted, F.lit(0)) / _BINS).alias("least_p")).where("least_p is not null")


def find(
    documents: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), share: float = SHARE, twice: bool = False
) -> DataFrame:
    """The columns ``carry`` and spans of each row: (start, kind, end) by start, then kind as in KINDS.

    The scan is read for the thresholds and for the result, so it is kept as a table in the
    shared folder. With ``twice`` the texts are scanned a second time instead, and nothing is
    written: for carried columns that are as large as the texts.
    """
    if twice:
        counted = _tested(documents.select(_whole(text)))
        scanned = _tested(documents.select(*[F.col(c).alias(f"_carried_{c}") for c in carry], _whole(text)))
        carried = {c: F.col(f"`_carried_{c}`") for c in carry}
    else:
        counted = scanned = keep(scan(documents, text, carry), "secrets")
        carried = {c: F.col("_carried")[c] for c in carry}
    limits = thresholds(counted, share).agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.concat_ws("/", "encoding", "length_class"), F.col("least_p")))
        ).alias("_limits")
    )
    limits = limits.select(F.coalesce("_limits", F.create_map().cast("map<string,double>")).alias("_limits"))
    chosen = F.filter("runs", lambda r: r["p"] >= F.col("_limits")[F.concat_ws("/", r["encoding"], r["length_class"])])
    extra = F.transform(
        chosen, lambda r: F.struct(r["start"].alias("start"), F.lit(len(BASE)).alias("kind"), r["end"].alias("end"))
    )
    named = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.concat("base", extra))
    spans = F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), named[s["kind"]].alias("kind"), s["end"].alias("end")))
    # One row with at most a number for each stratum.
    found = scanned.join(F.broadcast(limits))
    return found.select(*[value.alias(c) for c, value in carried.items() if c != "spans"], spans.alias("spans"))


def written(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """The spans of some kinds as ``kind:start:end``, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, by: str = REDACTED) -> Column:
    """The text with each span, or run of overlapping spans, replaced.

    Places in a text are found by walking it, so the text is cut into blocks of spans first.
    """

    def filled(gaps: Column) -> Column:
        base = gaps[0]["start"]
        part = F.substring(text, base + 1, F.get(gaps, F.size(gaps) - 1)["end"] - base)
        return let(part, lambda own: F.array_join(
            F.transform(gaps, lambda g: F.concat(F.substring(own, g["start"] - base + 1, g["end"] - g["start"]), F.lit(by))), ""
        ))

    def between(reached: Column) -> Column:
        gaps = F.filter(
            F.transform(spans, lambda s, i: F.struct(F.coalesce(F.get(reached, i - 1), F.lit(0)).alias("start"), s["start"].alias("end"))),
            lambda g: g["end"] >= g["start"],
        )
        tail = F.substring(text, F.get(reached, F.size(reached) - 1) + 1, F.char_length(text))
        return let(gaps, lambda g: F.concat(F.array_join(F.transform(blocks_of(g), filled), ""), tail))

    ends = running(F.transform(spans, lambda s: s["end"]), "int", 0, F.greatest)
    return F.when(F.size(spans) == 0, text).otherwise(let(ends, between))
