"""Secrets: fixed formats, and tokens that pass a battery of randomness tests.

A long token gets the encoding whose alphabet fits it. Three tests ask
whether it looks like uniform noise in that alphabet: chi-squared of the symbol counts, the number
of runs above and below the middle, and the lag-1 serial correlation. Their smallest p-value, times
three, is the token's. Per encoding and length class a false-discovery cut (Benjamini-Hochberg over
the whole corpus) tells which tokens are not random; it never rejects one whose p-value random
tokens miss only at the rate ``FALSE_NEGATIVE``. The tests have little power on short tokens, so
a token must also be likelier as uniform symbols than as text: a likelihood ratio, whose evidence grows with each
symbol. What remains is reported as ``random``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import let, replace_spans, spans

# The formats, in order, and the least number of characters of a match (of group 2 for assign).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_ASSIGN = 12
KINDS = ("assign", "access", "hex", "random")

TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Encodings, the first that fits counts: name, pattern of a whole token, alphabet in order.
ENCODINGS = (
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    ("base32", r"^[A-Z2-7]+=*$", UPPER + "234567"),
    ("base36", r"^([0-9a-z]+|[0-9A-Z]+)$", DIGITS + LOWER),
    ("base62", r"^[0-9A-Za-z]+$", UPPER + LOWER + DIGITS),
    ("base64", r"^[0-9A-Za-z+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^[0-9A-Za-z_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
)
FALSE_DISCOVERY = 0.05
#: Share of random tokens that the battery may take for not random.
FALSE_NEGATIVE = 0.02
# Fixed values of the text model: symbols, their classes (vowel and consonant of each case, digit, other) and the chances (in
# hundredths) of the next class after each, and of the first; a letter's share within its class (at least half a hundredth of all
# letters, for other languages); the chance of a symbol that repeats the last one or follows it in the alphabet.
SYMBOLS, VOWELS = UPPER + LOWER + DIGITS + "+/_-", "AEIOUY"
LETTER_SHARES = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2, 6.1, 7, 0.5, 0.77, 4, 2.4, 6.7, 7.5, 1.9, 0.5, 6, 6.3, 9.1, 2.8, 0.98, 2.4, 0.5, 2, 0.5)
FOLLOWS = (
    (12, 76, 1, 3, 2, 6),
    (55, 32, 1, 2, 2, 8),
    (4, 26, 10, 53, 2, 5),
    (28, 12, 35, 17, 3, 5),
    (2, 3, 2, 3, 80, 10),
    (25, 40, 6, 9, 15, 5),
)
FIRST, IN_ORDER = (20, 40, 8, 17, 10, 5), 25
#: p-values are counted in bins of an eighth of a power of two, down to 2^-60.
BINS, BINS_PER_BIT = 480, 8


def _tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution, by the logistic approximation (error below 0.0003)."""
    a = F.abs(z)
    return F.lit(2.0) / (F.lit(1.0) + F.exp(F.least(a * 1.5976 + a * a * a * 0.070566, F.lit(700.0))))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _p_value(token: Column, alphabet: Column) -> Column:
    """Smallest of the three p-values times three, for a token of at least 20 symbols."""
    text = F.regexp_replace(token, "=+$", "")
    one_case = (F.length(alphabet) < 40) & (F.substring(alphabet, 1, 1) == "0")
    folded = F.when(one_case, F.lower(text)).otherwise(text)

    def battery(s: Column) -> Column:
        n, k, x = s["n"], s["k"], s["x"]
        squares = _total(F.transform(F.array_distinct(s["c"]), lambda c: F.pow(n - F.length(F.replace(s["t"], c, F.lit(""))), F.lit(2.0))))
        uniform = _tail((squares * k / n - n - (k - 1)) / F.sqrt((k - 1) * 2.0 * (n - 1) / n))
        high = F.transform(x, lambda v: (v >= k / 2).cast("double"))
        n1 = _total(high)
        n2 = n - n1
        after = F.slice(high, F.lit(2), F.size(x) - 1)
        runs = _total(F.zip_with(F.slice(high, F.lit(1), F.size(x) - 1), after, lambda a, b: F.abs(a - b))) + 1
        both = n1 * n2 * 2.0
        spread = both * (both - n) / (n * n * (n - 1))
        run_p = F.when(spread > 0, _tail((runs - both / n - 1) / F.sqrt(spread))).otherwise(0.0)
        # from the mean, which is computed once: within the lambdas it would be for each symbol
        off = let(_total(x) / n, lambda mean: F.transform(x, lambda v: v - mean))
        vary = _total(F.transform(off, lambda v: v * v))
        lagged = let(off, lambda o: _total(F.zip_with(F.slice(o, F.lit(1), F.size(o) - 1), F.slice(o, F.lit(2), F.size(o) - 1), lambda a, b: a * b)))
        serial = F.when(vary > 0, _tail((lagged / vary + 1 / n) * F.sqrt(n))).otherwise(0.0)
        return F.least(F.least(uniform, run_p, serial) * 3.0, F.lit(1.0))

    def start(t: Column) -> Column:
        symbols = F.split(t, "")
        chars = F.filter(symbols, lambda c: c != "")
        value = F.transform(chars, lambda c: F.position(c, alphabet).cast("double") - 1)
        return F.struct(
            t.alias("t"),
            chars.alias("c"),
            value.alias("x"),
            F.length(t).cast("double").alias("n"),
            F.length(alphabet).cast("double").alias("k"),
        )

    return let(let(folded, start), battery)


def _symbol_classes() -> list[int]:
    letter = lambda c: (0 if c.upper() in VOWELS else 1) + (2 if c in UPPER else 0)
    return [letter(c) if c.isalpha() else 4 if c in DIGITS else 5 for c in SYMBOLS]


def _symbol_bits() -> list[float]:
    """Of each symbol, within its class."""
    share = dict(zip(UPPER, LETTER_SHARES))
    total = {v: sum(x for c, x in share.items() if (c in VOWELS) == v) for v in (True, False)}
    chance = lambda c: share[c] / total[c in VOWELS] if c in share else 0.1 if c in DIGITS else 0.5
    return [-math.log2(chance(c.upper())) for c in SYMBOLS]


def _evidence(token: Column, alphabet: Column) -> Column:
    """Bits in favour of uniform symbols of the alphabet against symbols of text."""
    array = lambda values: F.array(*[F.lit(v) for v in values])
    bits = lambda chances: [-math.log2(v / 100) for v in chances]
    classes, own = array(_symbol_classes()), array(_symbol_bits())
    follows, first = array(b for row in FOLLOWS for b in bits(row)), array(bits(FIRST))
    in_order = bits([IN_ORDER])[0]

    def total(x: Column) -> Column:
        """Of symbols by their places in ``SYMBOLS``."""
        kind = lambda i: F.element_at(classes, i)

        def step(a: Column, b: Column) -> Column:
            usual = F.element_at(follows, kind(a) * len(FIRST) + kind(b) + 1) + F.element_at(own, b)
            return F.when((b - a).isin(0, 1), F.least(usual, F.lit(in_order))).otherwise(usual)

        rest = F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), step)
        start = F.element_at(first, kind(x[0]) + 1) + F.element_at(own, x[0])
        return start + _total(rest) - F.size(x) * F.log2(F.length(alphabet))

    symbols = F.filter(F.split(F.regexp_replace(token, "=+$", ""), ""), lambda c: c != "")
    return let(F.transform(symbols, lambda c: F.position(c, F.lit(SYMBOLS))), total)


def _encoding(token: Column) -> Column:
    """(name, alphabet) of the first encoding that fits, null where none does."""
    cases = [
        F.when(token.rlike(pattern), F.struct(F.lit(name).alias("name"), F.lit(alphabet).alias("alphabet")))
        for name, pattern, alphabet in ENCODINGS
    ]
    return F.coalesce(*cases)


def candidates(text: Column) -> Column:
    """Long tokens: start, end, group (encoding and length class), bin of the p-value, p, evidence in bits."""

    def tested(s: Column) -> Column:
        def of(e: Column) -> Column:
            p = F.when(e.isNotNull(), _p_value(s["value"], e["alphabet"])).otherwise(0.0)
            group = F.concat(F.coalesce(e["name"], F.lit("none")), F.lit(":"), F.floor(F.log2(F.length(s["value"]))).cast("string"))
            rank = F.least(F.floor(-F.log2(F.greatest(p, F.lit(2.0**-62))) * BINS_PER_BIT), F.lit(BINS)).cast("int")
            evidence = F.when(e.isNotNull(), _evidence(s["value"], e["alphabet"])).otherwise(0.0)
            return F.struct(
                s["start"].alias("start"), s["end"].alias("end"), group.alias("group"), rank.alias("bin"), p.alias("p"), evidence.alias("evidence")
            )

        return let(_encoding(s["value"]), of)

    return F.transform(spans(text, TOKEN), tested)


def discovery_cuts(docs: DataFrame) -> dict[str, int]:
    """Per group the first bin (of the smallest p-values) of tokens that are not random.

    One pass that counts p-values per group and bin; at most some hundred groups and ``BINS`` bins exist.
    """
    each = docs.select(F.explode(candidates(F.coalesce("text", F.lit("")))).alias("c")).select("c.group", "c.bin")
    counts: dict[str, list[tuple[int, int]]] = {}
    for row in each.groupBy("group", "bin").count().collect():
        counts.setdefault(row["group"], []).append((row["bin"], row["count"]))
    cuts = {}
    for group, found in counts.items():
        total, rejected = sum(n for _, n in found), 0
        for rank, n in sorted(found, reverse=True):
            rejected += n
            if 2.0 ** (-rank / BINS_PER_BIT) <= FALSE_DISCOVERY * rejected / total:
                cuts[group] = rank
    return cuts


def find_secrets(text: Column, cuts: dict[str, int]) -> Column:
    """All spans (start, rank, end, kind), by start, then kind as listed. ``random`` ones lie outside the others."""

    def ranked(found: Column, kind: str) -> Column:
        return F.transform(
            found,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    assign = F.filter(spans(text, ASSIGN), lambda s: F.length(value(s)) >= LEAST_ASSIGN)
    fixed = F.concat(ranked(assign, "assign"), ranked(spans(text, ACCESS), "access"), ranked(spans(text, HEX), "hex"))
    known = F.create_map(F.lit(""), F.lit(0), *[F.lit(v) for pair in sorted(cuts.items()) for v in pair])

    def is_random(c: Column) -> Column:
        limit = F.coalesce(F.element_at(known, c["group"]), F.lit(BINS + 1))
        return (c["evidence"] > 0) & ((c["bin"] < limit) | (c["p"] >= FALSE_NEGATIVE))

    def all_of(base: Column) -> Column:
        outside = lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        added = F.filter(candidates(text), lambda c: is_random(c) & outside(c))
        return F.sort_array(F.concat(base, ranked(added, "random")))

    return let(fixed, all_of)


def scan(docs: DataFrame, keep: list[str | Column]) -> DataFrame:
    """Columns ``keep`` and ``secrets``, the spans of each row's text; two passes over the texts, no shuffle of rows.

    Null and empty texts have no spans, repeated rows each get theirs, an empty table gives no rows.
    """
    return docs.select(*keep, find_secrets(F.coalesce("text", F.lit("")), discovery_cuts(docs)).alias("secrets"))


def redact(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with all their columns; each secret in a text becomes ``[ASSIGN]``, ``[HEX]`` and so on."""
    found = scan(docs, [F.struct("*").alias("row")])
    plain = F.transform("secrets", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    text = replace_spans(F.col("row.text"), plain)
    return found.select(F.col("row").withField("text", text).alias("row")).select("row.*")
