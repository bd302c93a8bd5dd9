"""Personal data: fixed formats, and terms that reveal whom they stand beside.

E-mail and IP addresses, card and phone numbers are the protected entities. For every term of a text that names one, counts
over all distinct texts give the information it has about the entity: PMI(t; e) = log2 of
N both / ((df(t) + 1) df(e)), against the entity's own IC(e) = log2 of N / df(e); both is the number of texts with term and entity, wherever in
them. The one added to df(t) is the text in which the term may yet appear without the entity, so a term that was seen once tells less than one that was seen
ten times. A term that gives away most of that information is generalised to its kind, one that gives away nearly all is removed, at every
place of every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import ascii_lower, blank_spans, let, replace_spans, spans
from weekloom.session import stage

# The formats. Possessive loops and the look-behinds change no match; they keep long runs linear.
FORMATS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Kinds in the order of the results: the formats, then what becomes of a term.
TERM_KINDS = ("word", "number", "removed")
KINDS = (*FORMATS, *TERM_KINDS)
LETTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = LETTER + "+"
GENERALISE, REMOVE = 0.8, 0.95
SMOOTHING = 1
#: Terms, and the terms and mentions of all texts, are broadcast up to this count (some 60 bytes each); beyond it the words or texts are shuffled.
BROADCAST_TERMS = 1_000_000


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def mentions(text: Column) -> Column:
    """(rank, start, end, kind, value) of all fixed-format spans, by kind as listed, then start."""

    def of(kind: str, pattern: str) -> Column:
        found = F.filter(spans(text, pattern), lambda s: _passes(kind, s["value"]))
        rank = KINDS.index(kind)
        return F.transform(
            found,
            lambda s: F.struct(
                F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")
            ),
        )

    return F.concat(*[of(kind, pattern) for kind, pattern in FORMATS.items()])


def _entity(m: Column) -> Column:
    plain = F.when(m["kind"].isin("card", "phone"), _digits(m["value"])).otherwise(F.lower(m["value"]))
    return F.concat(m["kind"], F.lit(":"), plain)


def words(text: Column) -> Column:
    """The distinct terms of a text, A-Z lower-cased."""
    return F.array_distinct(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)))


def read_mentions(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, mentions, terms) per row of ``docs``, staged: the one full scan for formats.

    ``terms`` are those outside the mentions, of texts that have any.
    """
    text = F.coalesce("text", F.lit(""))

    def of(t: Column, m: Column) -> Column:
        terms = F.when(F.size(m) > 0, words(blank_spans(t, m))).otherwise(F.expr("cast(array() as array<string>)"))
        return F.struct(m.alias("mentions"), terms.alias("terms"))

    found = let(text, lambda t: let(mentions(t), lambda m: of(t, m)))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"), found.alias("r"))
    return stage(rows.select("doc_id", "text_key", "r.mentions", "r.terms"), "mentions")


def _small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it has no more rows than the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_TERMS else df


def disclosures(docs: DataFrame, read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((term, share) of the terms that disclose an entity, (text_key, term) of the texts that may have them).

    share is the greatest PMI(t; e) / IC(e). It reaches ``GENERALISE`` only if df(t) + 1 <= df(e) (N / df(e)) ** (1 - GENERALISE), as a term stands
    with an entity in no more texts than that has. So common words, which no entity explains, are neither counted nor paired.
    """
    total = read.select("text_key").distinct().agg(F.count("*").cast("double").alias("n")).scalar()
    named = read.select("text_key", F.explode("mentions").alias("m")).select("text_key", _entity(F.col("m")).alias("entity")).distinct()
    entities = named.groupBy("entity").agg(F.count("*").alias("with_entity")).where(F.col("with_entity") < total)
    reach = F.col("with_entity") * F.pow(total / F.col("with_entity"), F.lit(1 - GENERALISE)) * (1 + 1e-9)
    named = stage(named.join(entities.withColumn("reach", reach), "entity"), "entities")
    reached = named.groupBy("text_key").agg(F.max("reach").alias("reach"))
    near = read.where(F.size("mentions") > 0).select("text_key", F.explode("terms").alias("term")).distinct()
    near = stage(near.join(reached, "text_key"), "near-terms")
    beside = near.groupBy("term").agg(F.count("*").alias("beside"), F.max("reach").alias("reach"))
    candidates = stage(beside.where(F.col("beside") + SMOOTHING <= F.col("reach")).select("term"), "candidates")
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    spoken = texts.select(F.xxhash64("text").alias("text_key"), F.explode(words(F.col("text"))).alias("term"))
    spoken = stage(spoken.join(_small(candidates), "term", "left_semi").distinct(), "spoken")
    with_term = spoken.groupBy("term").agg(F.count("*").alias("with_term"))
    rare = near.join(with_term, "term").where(F.col("with_term") + SMOOTHING <= F.col("reach")).select("text_key", "term", "with_term")
    pairs = rare.join(named, "text_key").where(F.col("with_term") + SMOOTHING <= F.col("reach"))
    pairs = pairs.groupBy("term", "entity").agg(F.count("*").alias("both"), F.max("with_term").alias("with_term"), F.max("with_entity").alias("with_entity"))
    told = F.log2(total * F.col("both") / ((F.col("with_term") + SMOOTHING) * F.col("with_entity")))
    pairs = pairs.withColumn("share", told / F.log2(total / F.col("with_entity")))
    return pairs.groupBy("term").agg(F.max("share").alias("share")).where(F.col("share") >= GENERALISE), spoken


def term_patterns(found: DataFrame, spoken: DataFrame) -> DataFrame:
    """(text_key, word, number, removed): per kind the pattern of a text's disclosing terms of that kind, or null.

    Terms hold no ASCII sign, so they stand in a pattern as they are. Alternatives are grouped by first and second character, so a
    word of the text is held against few of them however many terms the text has.
    """
    kind = F.when(F.col("share") >= REMOVE, "removed").when(F.col("term").rlike("[0-9]"), "number").otherwise("word")
    hits = spoken.join(found.select("term", kind.alias("kind")), "term").repartition("text_key")
    first, second, rest = (F.substring("term", 1, 1), F.substring("term", 2, 1), F.expr("substring(term, 3)"))
    levels = hits.select("text_key", "kind", first.alias("first"), second.alias("second"), rest.alias("rest"))

    def any_of(column: str) -> Column:
        return F.concat(F.lit("(?:"), F.array_join(F.collect_list(column), "|"), F.lit(")"))

    levels = levels.groupBy("text_key", "kind", "first", "second").agg(any_of("rest").alias("rest"))
    levels = levels.withColumn("rest", F.concat("second", "rest")).groupBy("text_key", "kind", "first").agg(any_of("rest").alias("rest"))
    levels = levels.withColumn("rest", F.concat("first", "rest")).groupBy("text_key", "kind").agg(any_of("rest").alias("rest"))
    whole = F.concat(F.lit(f"(?<!{LETTER})"), F.col("rest"), F.lit(f"(?!{LETTER})"))
    return levels.groupBy("text_key").agg(*[F.max(F.when(F.col("kind") == k, whole)).alias(k) for k in TERM_KINDS])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, found) per row of ``docs``; found: (rank, start, end, kind), by kind as listed, then start.

    Null and empty texts have none. Repeated rows each get theirs, but count once in the statistics,
    as all equal texts do. A null doc_id is one more id. Very long texts are read whole; the spans of one text are one array.
    Other columns are ignored; an empty table gives no rows.
    """
    read = read_mentions(docs)
    named = read.where(F.size("mentions") > 0).select("text_key", "mentions").dropDuplicates(["text_key"])
    known = stage(term_patterns(*disclosures(docs, read)).join(named, "text_key", "full"), "known")
    size = [F.coalesce(F.length(k), F.lit(0)) for k in TERM_KINDS] + [60 * F.coalesce(F.size("mentions"), F.lit(0))]
    weight = known.agg(F.sum(sum(size, F.lit(60)))).first()[0] or 0
    known = F.broadcast(known) if weight <= 60 * BROADCAST_TERMS else known
    text = F.coalesce("text", F.lit(""))
    both = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key")).join(known, "text_key", "left")

    def of(lower: Column, kind: str) -> Column:
        rank = F.lit(KINDS.index(kind)).alias("rank")
        return F.transform(spans(lower, F.col(kind)), lambda s: F.struct(rank, s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    none = F.expr("cast(array() as array<struct<rank:int,start:int,end:int,kind:string>>)")
    base = F.coalesce(F.transform("mentions", lambda m: F.struct(m["rank"], m["start"], m["end"], m["kind"])), none)
    blanked = F.when(F.col("mentions").isNotNull(), blank_spans(F.col("text"), F.col("mentions"))).otherwise(F.col("text"))
    terms = let(ascii_lower(blanked), lambda lower: F.concat(*[of(lower, k) for k in TERM_KINDS]))
    terms = F.when(F.coalesce(*TERM_KINDS).isNotNull(), terms).otherwise(none)
    return both.select("doc_id", "text_key", F.sort_array(F.concat(base, terms)).alias("found"))


def sanitise(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with all their columns; formats become ``[EMAIL]`` and so on, disclosing terms ``[WORD]``, ``[NUMBER]`` or nothing."""
    found = find_personal_data(docs).dropDuplicates(["doc_id", "text_key"])
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("k"))
    both = rows.join(found, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("text_key")), "left")
    text = replace_spans(F.col("row.text"), F.col("found"), silent="removed")
    return both.select(F.col("row").withField("text", text).alias("row")).select("row.*")
