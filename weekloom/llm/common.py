"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.session import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
SPACE = re.compile(rb"[\x20\x09-\x0D]")
SPAN = "array<struct<start:int,end:int,value:string>>"


def ascii_lower(text: Column) -> Column:
    """Lower case of A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, for use inside other expressions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _walk(items: Column, start: Column) -> Column:
    """(pos, out): spans of (gap, value) items one after the other, from ``start``."""

    def step(acc: Column, item: Column) -> Column:
        begin = acc["pos"] + item["gap"]
        end = begin + F.length(item["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), item["value"].alias("value"))
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))

    zero = F.struct(start.cast("int").alias("pos"), F.expr(f"cast(array() as {SPAN})").alias("out"))
    return F.aggregate(items, zero, step)


def spans(text: Column, pattern: str | Column, block: int = 256) -> Column:
    """All leftmost non-overlapping matches as (start, end, value), in code points; none of a null pattern.

    The gaps between matches come from ``split``, the matches from ``regexp_extract_all``, which
    runs only where there is a match. Spans are built block by block, so a text with very many
    matches doesn't copy one long array for each of them.
    """

    def build(gaps: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        n = F.size(gaps) - 1
        items = F.zip_with(
            F.slice(gaps, F.lit(1), n), found, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value"))
        )

        def walk(items: Column) -> Column:
            starts = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")), lambda b: b * block + 1)
            zero = F.expr(f"named_struct('pos', 0, 'out', cast(array() as array<{SPAN}>))")

            def step(acc: Column, first: Column) -> Column:
                return let(
                    _walk(F.slice(items, first, F.lit(block)), acc["pos"]),
                    lambda r: F.struct(r["pos"].alias("pos"), F.concat(acc["out"], F.array(r["out"])).alias("out")),
                )

            return F.flatten(F.aggregate(starts, zero, step)["out"])

        return let(items, walk)

    empty = F.expr(f"cast(array() as {SPAN})")
    return let(F.split(text, pattern, -1), lambda gaps: F.when(F.size(gaps) > 1, build(gaps)).otherwise(empty))


def no_spans() -> Column:
    return F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")


def kinded(found: Column, kind: str) -> Column:
    """Spans with their kind instead of their text."""
    return F.transform(
        found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def span_text(ordered: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def replace_spans(text: Column, found: Column, silent: str = "") -> Column:
    """``text`` with each span (kind, start, end) replaced by ``[KIND]``, or by nothing if its kind is ``silent``.

    Overlapping spans merge; the first names them.
    """

    def step(acc: Column, s: Column) -> Column:
        label = F.when(s["kind"] == silent, "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        gap = F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"])
        grown = F.struct(s["end"].alias("pos"), F.concat(acc["out"], F.array(gap, label)).alias("out"))
        inside = F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["pos"], grown).otherwise(inside)

    zero = F.expr("named_struct('pos', 0, 'out', cast(array() as array<string>))")
    ordered = F.sort_array(F.transform(found, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    rebuilt = let(
        F.aggregate(ordered, zero, step),
        lambda r: F.concat(F.array_join(r["out"], ""), F.substring(text, r["pos"] + 1, F.length(text))),
    )
    return F.when(F.size(found) > 0, rebuilt).otherwise(text)


def blank_spans(text: Column, found: Column) -> Column:
    """``text`` with every character of the spans (start, end) replaced by a blank."""

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], acc["pos"])
        gap = F.substring(text, acc["pos"] + 1, begin - acc["pos"])
        grown = F.struct(s["end"].alias("pos"), F.concat(acc["out"], F.array(gap, F.repeat(F.lit(" "), s["end"] - begin))).alias("out"))
        return F.when(s["end"] > acc["pos"], grown).otherwise(acc)

    zero = F.expr("named_struct('pos', 0, 'out', cast(array() as array<string>))")
    ordered = F.sort_array(F.transform(found, lambda s: F.struct(s["start"], s["end"])))
    rebuilt = let(
        F.aggregate(ordered, zero, step),
        lambda r: F.concat(F.array_join(r["out"], ""), F.substring(text, r["pos"] + 1, F.length(text))),
    )
    return F.when(F.size(found) > 0, rebuilt).otherwise(text)


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words between ASCII white space, in blocks of about ``size`` bytes, so long texts need little memory."""
    start = 0
    while start < len(data):
        end = start + size
        if end < len(data):
            cut = SPACE.search(data, end)
            end = cut.start() if cut else len(data)
        yield data[start:end].split()
        start = end


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it can reach.

    Alternating large-star and small-star rounds: each attaches all neighbours of a node to the
    smallest one. Rounds grow with the logarithm of the longest path; each is two joins whose one
    side has a row per node, so a hub is split like any skewed join. Links are staged in the
    shared folder after each round, which cuts the lineage.
    """

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "links")
    before, now = None, state(edges)
    while now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        small = large.join(low, "u").select(pairs.alias("p")).select("p.u", "p.v").where("u <> v").distinct()
        edges = stage(small, "links")
        before, now = now, state(edges)
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
