"""Chat formatting by perspective rotation: each participant in turn becomes the assistant.

For every speaker of a dialogue the whole dialogue is rendered with that speaker's turns as
``assistant`` and the others' as named ``user``; turns of a context role (``system``) stay as they are. The
mask marks the assistant's text and end marker. A dialogue comes in parts of ``PART`` turns by
number, so that one with very many turns is never gathered in one task; a part that still holds more, as turn
numbers are null or repeat, is split after every ``PART`` turns. The parts, one after the
other, are the whole text, and offsets run through it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.session import stage

PART = 64
#: Parts whose offsets are summed by one task; sums of these blocks are summed in turn.
BLOCK = 4096
#: The part of turns without a number; below all others.
UNNUMBERED = -(2**60)
CONTEXT_ROLES = ("system",)
START, END = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    """Text in which no marker can be mistaken for ours."""
    return F.replace(text, F.lit("<|im_"), F.lit("<| im_"))


def turns_in_parts(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, sub, turns): up to ``PART`` turns (turn, speaker, text) each, in order of part and sub."""
    speaker = F.replace(_plain(F.coalesce("role", F.lit("unknown"))), F.lit("\n"), F.lit(" "))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), speaker.alias("speaker"), _plain(F.coalesce("text", F.lit(""))).alias("text"))
    part = F.coalesce(F.floor(F.col("turn") / PART), F.lit(UNNUMBERED))
    rows = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", part.alias("part"), turn.alias("t"))
    gathered = F.sort_array(F.collect_list("t")).alias("turns")
    crowded = stage(rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")).where(F.col("n") > PART).drop("n"), "crowded-parts")
    if crowded.isEmpty():
        return rows.groupBy("conv_id", "part").agg(gathered).withColumn("sub", F.lit(0).cast("long"))
    parts = rows.join(crowded, ["conv_id", "part"], "left_anti").withColumn("sub", F.lit(0).cast("long"))
    parts = parts.unionByName(_numbered(rows.join(crowded, ["conv_id", "part"], "left_semi")))
    return parts.groupBy("conv_id", "part", "sub").agg(gathered)


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, part, t) with ``sub``, the number of its run of ``PART`` turns in the part.

    Rows are sorted over all tasks by range, equal ones dealt by a salt; a row's number is its place in its range, plus the rows of the part in earlier ranges.
    """
    ranges = rows.withColumn("salt", F.rand(7)).repartitionByRange("conv_id", "part", "t", "salt").withColumn("range", F.spark_partition_id())
    ranges = stage(ranges, "crowded-turns")
    earlier = Window.partitionBy("conv_id", "part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("conv_id", "part", "range").agg(F.count("*").alias("n"))
    sizes = sizes.select("conv_id", "part", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "part", "range").orderBy("t", "salt")) - 1
    placed = ranges.withColumn("inside", inside).join(sizes, ["conv_id", "part", "range"])
    return placed.select("conv_id", "part", "t", F.floor((F.col("before") + F.col("inside")) / PART).alias("sub"))


def _offsets(lengths: DataFrame) -> DataFrame:
    """(conv_id, perspective, part, sub, start, number) of ``lengths`` (conv_id, perspective, part, sub, length).

    Sums run level by level, over blocks of parts, parts, blocks of runs and runs, so no task sums all of a long dialogue.
    """
    rows = lengths.withColumns({"far": F.floor(F.col("part") / BLOCK), "near": F.floor(F.col("sub") / BLOCK), "one": F.lit(1).cast("long")})
    keys, placed, start, number = ["conv_id", "perspective"], rows, F.lit(0), F.lit(0)
    for level in ("far", "part", "near", "sub"):
        before = Window.partitionBy(*keys).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        totals = rows.groupBy(*keys, level).agg(F.sum("length").alias("l"), F.sum("one").alias("k"))
        sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_{level}") for c in ("l", "k")]
        totals = totals.select(*keys, level, *sums)
        keys = [*keys, level]
        placed = placed.join(totals, keys)
        start, number = start + F.col(f"l_{level}"), number + F.col(f"k_{level}")
    return placed.select("conv_id", "perspective", "part", "sub", start.alias("start"), number.alias("number"))


def rotate(conversations: DataFrame, context_roles: tuple[str, ...] = CONTEXT_ROLES) -> DataFrame:
    """One row per dialogue, perspective and part: conv_id, perspective, part (from 0), start, text, n_turns, masks.

    ``start`` is the number of code points before the part, ``masks`` the trained spans (start, end) in
    the whole text. Turns are ordered by number, nulls first, then speaker and text; repeated rows are
    repeated turns. A null text is empty, a null role is the speaker ``unknown``. Rows without a
    conv_id belong to no dialogue; a dialogue of context turns only has no perspective. Other columns
    are ignored; an empty table gives no rows.
    """
    parts = turns_in_parts(conversations)
    people = parts.select("conv_id", F.explode("turns.speaker").alias("perspective")).distinct()
    people = people.where(~F.col("perspective").isin(*context_roles))

    def head(t: Column) -> Column:
        own = t["speaker"] == F.col("perspective")
        named = F.concat(F.lit("user name="), t["speaker"])
        return F.concat(F.lit(START), F.when(own, "assistant").when(t["speaker"].isin(*context_roles), t["speaker"]).otherwise(named), F.lit("\n"))

    def render(t: Column) -> Column:
        return F.struct(
            F.length(head(t)).alias("lead"),
            F.concat(head(t), t["text"], F.lit(END + "\n")).alias("text"),
            (t["speaker"] == F.col("perspective")).alias("own"),
        )

    def add(acc: Column, s: Column) -> Column:
        end = acc["pos"] + F.length(s["text"])
        span = F.struct((acc["pos"] + s["lead"]).alias("start"), (end - 1).alias("end"))
        return F.struct(end.alias("pos"), F.when(s["own"], F.concat(acc["masks"], F.array(span))).otherwise(acc["masks"]).alias("masks"))

    zero = F.expr("named_struct('pos', 0, 'masks', cast(array() as array<struct<start:int,end:int>>))")
    rendered = parts.join(people, "conv_id").select(
        "conv_id", "perspective", "part", "sub", F.size("turns").cast("long").alias("n_turns"), F.transform("turns", render).alias("s")
    )
    flat = rendered.select(
        "conv_id", "perspective", "part", "sub", "n_turns", F.array_join("s.text", "").alias("text"), F.aggregate("s", zero, add)["masks"].alias("masks")
    )
    length = F.aggregate("s", F.lit(0).cast("long"), lambda n, x: n + F.length(x["text"]))
    lengths = stage(rendered.select("conv_id", "perspective", "part", "sub", length.alias("length")), "part-lengths")
    offsets = _offsets(lengths)
    placed = flat.join(offsets, ["conv_id", "perspective", "part", "sub"]).drop("part").withColumnRenamed("number", "part")
    masks = F.transform("masks", lambda m: F.struct((m["start"] + F.col("start")).alias("start"), (m["end"] + F.col("start")).alias("end")))
    return placed.select("conv_id", "perspective", "part", "start", "text", "n_turns", masks.alias("masks"))
