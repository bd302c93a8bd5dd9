"""Benchmark decontamination: documents that contain windows of benchmark items.

The hashes of all normalised benchmark windows are one set, broadcast if its counted size is
bounded. Every window of every document is looked up there; the few that hit are verified against
the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.common import ascii_lower
from weekloom.session import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: The hash set is broadcast up to this many windows (16 bytes each, some 100 MB); beyond it the windows are shuffled.
BROADCAST_WINDOWS = 4_000_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _gram(words: Column, start: Column, n: Column) -> Column:
    return F.slice(words, start + 1, n)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, gram, n, items): each distinct window of the items, and which items have it."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
    items = items.where(F.col("item").isNotNull() & (F.size("words") > 0)).withColumn("n", F.least(F.size("words"), F.lit(window)))
    starts = F.explode(F.sequence(F.lit(0), F.size("words") - F.col("n")))
    found = items.withColumn("start", starts).withColumn("gram", _gram(F.col("words"), F.col("start"), F.col("n")))
    per = found.groupBy("gram", "n").agg(F.collect_set("item").alias("items"))
    return per.select(F.xxhash64("gram").alias("key"), F.array_join("gram", " ").alias("gram"), "n", "items")


def window_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, pos, n, items): every occurrence of a benchmark window, at word ``pos``."""
    known = stage(benchmark_windows(benchmark, window), "windows")
    lengths = sorted(r["n"] for r in known.select("n").distinct().collect())
    keys = known.select("key").distinct()
    if keys.count() <= BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("words"))
    at = rows.select("doc_id", "text_key", "words", F.posexplode("words").alias("pos", "word")).drop("word")
    n = F.explode(F.array(*[F.lit(k) for k in lengths])) if len(lengths) > 1 else F.lit((lengths or [window])[0])
    at = at.withColumn("n", n).where(F.col("pos") + F.col("n") <= F.size("words"))
    gram = _gram(F.col("words"), F.col("pos"), F.col("n"))
    seen = at.withColumn("key", F.xxhash64(gram)).join(keys, "key", "left_semi")
    seen = seen.select("doc_id", "text_key", "pos", "n", "key", F.array_join(gram, " ").alias("gram"))
    verified = seen.join(known, ["key", "gram", "n"]).select("doc_id", "text_key", "pos", "n", "items")
    return verified.dropDuplicates(["doc_id", "text_key", "pos", "n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, n_hit, items) of the documents with a hit: words covered, and the sorted item ids as strings."""
    hits = window_hits(docs, benchmark, window)
    earlier = Window.partitionBy("doc_id", "text_key").orderBy("pos", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("pos") + F.col("n")
    fresh = F.greatest(end - F.greatest(F.col("pos"), F.coalesce(F.max(end).over(earlier), F.lit(0))), F.lit(0))
    per = hits.withColumn("fresh", fresh).groupBy("doc_id", "text_key")
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))))
    return per.agg(F.sum("fresh").cast("long").alias("n_hit"), items.alias("items"))


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & left["text_key"].eqNullSafe(right["text_key"])


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, items) per row of ``docs``.

    Null texts have no words. Repeated rows each get their line; a null doc_id is one more id.
    Benchmark rows without an id or without words are no items; an item that appears twice counts
    once. An item of fewer than ``window`` words is one window. Extra columns are ignored; an empty
    table gives no rows.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    found = contamination(docs, benchmark, window)
    out = rows.join(found, _same(rows, found), "left")
    none = F.expr("cast(array() as array<string>)")
    return out.select(rows["doc_id"], "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns."""
    found = contamination(docs, benchmark, window).select("doc_id", "text_key")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_key"))
    return rows.join(found, _same(rows, found), "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows of ``docs``; a contaminated text keeps only its words (normalised) outside the hits."""
    hits = window_hits(docs, benchmark, window).groupBy("doc_id", "text_key")
    found = hits.agg(F.collect_list(F.struct("pos", (F.col("pos") + F.col("n")).alias("end"))).alias("hits"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_key"))
    both = rows.join(found, _same(rows, found), "left")
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["pos"], h["end"] - 1))))
    at = F.sequence(F.lit(0), F.size(words(F.col("row.text"))) - 1)
    left = F.transform(F.array_except(at, covered), lambda i: F.element_at(words(F.col("row.text")), i + 1))
    text = F.when(F.col("hits").isNull(), F.col("row.text")).otherwise(F.array_join(left, " "))
    return both.select(F.col("row").withField("text", text).alias("row")).select("row.*")
