"""Exact grouped statistics whose memory per task stays bounded on hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekloom.functions.columns import present
from weekloom.session import stage


def add_bin(df: DataFrame) -> DataFrame:
    """Add a whole number that grows with ``value``: bins about 0.1 % wide, finer around zero."""
    return df.withColumn("bin", F.floor(F.asinh("value") * 1000))


def binned_values(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Long form (keys, measure, value, bin) of the columns; NULL and NaN values keep a NULL bin."""
    long = df.select(*keys, *[present(F.col(c).cast("double")).alias(c) for c in cols]).unpivot(keys, cols, "measure", "value")
    return add_bin(long)


def bin_counts(binned: DataFrame, keys: list[str]) -> DataFrame:
    return binned.groupBy(*keys, "measure", "bin").agg(F.count("*").alias("n"))


_LOW, _HIGH = "(total - 1) div 2", "total div 2"


def middle_bins(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The one or two bins per group that hold its middle ranks, with the rows before them."""
    by = W.partitionBy(*keys, "measure")
    running = F.sum("n").over(by.orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
    ranked = counts.where(F.col("bin").isNotNull()).withColumns(
        {"total": F.sum("n").over(by), "before": running - F.col("n")}
    )
    hit = (F.col("before") <= F.expr(_HIGH)) & (F.col("before") + F.col("n") > F.expr(_LOW))
    return ranked.where(hit).select(*keys, "measure", "bin", "before", "total")


#: Parts into which a middle bin is split before its values are ordered.
PARTS = 4096


def medians_within(counted: DataFrame, middle: DataFrame, keys: list[str]) -> DataFrame:
    """``median`` per group from the counted values (keys, measure, bin, value, n) of its middle bins.

    A continuous column may have very many values in one bin. So the bin is counted again in
    ``PARTS`` parts, and only the one or two parts with the middle ranks are ordered: a task never
    sorts more than the parts of a bin or the values of a part. Both steps read the counted values, so
    these should be a written table.
    """
    by = [*keys, "measure"]
    part = F.floor((F.asinh("value") * 1000 - F.col("bin")) * PARTS)
    placed = counted.withColumn("part", part).join(middle, [*by, "bin"])
    parts = placed.groupBy(*by, "bin", "part", "total").agg(F.sum("n").alias("n"), F.min("before").alias("before"))
    in_bin = W.partitionBy(*by, "bin").orderBy("part").rowsBetween(W.unboundedPreceding, 0)
    start = F.col("before") + F.sum("n").over(in_bin) - F.col("n")
    hit = (F.col("start") <= F.expr(_HIGH)) & (F.col("start") + F.col("n") > F.expr(_LOW))
    chosen = parts.withColumn("start", start).where(hit).select(*by, "bin", "part", F.col("start").alias("before"))
    in_part = W.partitionBy(*by, "bin", "part").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    ranked = placed.drop("before").join(chosen, [*by, "bin", "part"]).withColumn(
        "start", F.col("before") + F.sum("n").over(in_part) - F.col("n")
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (F.col("start") + F.col("n") > rank), F.col("value")))

    middle_value = (value_at(F.expr(_LOW)) + value_at(F.expr(_HIGH))) / 2
    return ranked.groupBy(*by).agg(middle_value.alias("median"))


def count_values(binned: DataFrame, middle: DataFrame, keys: list[str]) -> DataFrame:
    """How often each value of the middle bins occurs."""
    on = [*keys, "measure", "bin"]
    return binned.join(middle.select(*on), on, "left_semi").groupBy(*on, "value").agg(F.count("*").alias("n"))


def measures_to_columns(medians: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    return medians.groupBy(*keys).agg(*[F.max(F.when(F.col("measure") == c, F.col("median"))).alias(c) for c in cols])


def exact_medians(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Exact median of every column per group (one row when ``keys`` is empty).

    ``percentile`` would hold all distinct values of a group in one task. Here a first pass
    counts rows per bin of close values, which the map side combines to almost nothing; the
    bin totals tell where the middle ranks lie; a second pass counts and orders only the
    values of those bins. NULL values are ignored, and so are groups with a NULL key.
    """
    kept = df
    for k in keys:
        kept = kept.where(F.col(k).isNotNull())
    binned = binned_values(kept, keys, cols)
    middle = middle_bins(stage(bin_counts(binned, keys), "bin-counts"), keys)
    counted = stage(count_values(binned, middle, keys), "middle-values")
    return measures_to_columns(medians_within(counted, middle, keys), keys, cols)


def _bracket(counts: DataFrame, missing: DataFrame | None, ends: DataFrame | None) -> DataFrame:
    """(measure, first, last): bins between which the overall middle ranks lie.

    With ``missing`` (keys, measure, n) as many values join each group somewhere between its ``ends`` (keys, measure, low, high).
    All at the low ends, or all at the high ones, are the two extremes: ranks in between lie in between.
    """
    known = counts.groupBy("measure", "bin").agg(F.sum("n").alias("n"))
    found = []
    for end in ("low", "high"):
        shifted = known
        if missing is not None:
            added = missing.join(ends, [c for c in missing.columns if c != "n"]).select("measure", F.col(end).alias("bin"), "n")
            shifted = known.unionByName(added).groupBy("measure", "bin").agg(F.sum("n").alias("n"))
        found.append(middle_bins(shifted, []).select("measure", "bin"))
        if missing is None:
            break
    both = found[0].unionByName(found[-1])
    return both.groupBy("measure").agg(F.min("bin").alias("first"), F.max("bin").alias("last"))


def group_and_overall_medians(df: DataFrame, key: str, cols: list[str], filled: bool = False) -> tuple[DataFrame, DataFrame]:
    """(medians per group, one row of overall medians), exact, from two passes over ``df``.

    The first pass counts bins; from these alone it follows in which bins the middle ranks of every group lie, and between which
    bins those of the whole column, so the second pass counts the values of both. With ``filled`` the overall median is that of the column
    after each group's missing values have become its median. A NULL key is no group.
    """
    binned = binned_values(df, [key], cols)
    counts = stage(bin_counts(binned, [key]), "bin-counts")
    known = counts.where(F.col(key).isNotNull())
    middle = middle_bins(known, [key])
    missing = known.where(F.col("bin").isNull()).select(key, "measure", "n") if filled else None
    ends = middle.groupBy(key, "measure").agg(F.min("bin").alias("low"), F.max("bin").alias("high")) if filled else None
    # one row per column, so its size is known
    span = F.broadcast(_bracket(counts, missing, ends))
    mine = middle.select(key, "measure", "bin", F.lit(True).alias("mine"))
    near = binned.join(span, "measure").join(mine, [key, "measure", "bin"], "left")
    near = near.where(F.col("mine") | F.col("bin").between(F.col("first"), F.col("last")))
    values = stage(near.groupBy(key, "measure", "bin", "value").agg(F.count("*").alias("n")), "middle-values")
    by_group = stage(medians_within(values.where(F.col(key).isNotNull()), middle, [key]), "group-medians")
    all_counts = counts.select("measure", "bin", "n")
    all_values = values.select("measure", "bin", "value", "n")
    if filled:
        added = add_bin(missing.join(by_group, [key, "measure"]).select("measure", F.col("median").alias("value"), "n"))
        all_counts = all_counts.unionByName(added.drop("value"))
        all_values = all_values.unionByName(added)
    overall = middle_bins(all_counts.groupBy("measure", "bin").agg(F.sum("n").alias("n")), [])
    all_values = all_values.groupBy("measure", "bin", "value").agg(F.sum("n").alias("n"))
    medians = medians_within(all_values, overall, [])
    return measures_to_columns(by_group, [key], cols), measures_to_columns(medians, [], cols)


def modes(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Most frequent value of each text column per group; ties go to the smallest value.

    Groups without any value of a column get NULL. Two combinable aggregates, no window.
    """
    kept = df
    for k in keys:
        kept = kept.where(F.col(k).isNotNull())
    long = kept.select(*keys, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        keys, cols, "_measure", "_value"
    )
    by = [*keys, "_measure"]
    counted = long.groupBy(*by, "_value").agg(F.count("*").alias("_n"))
    first = F.min(F.when(F.col("_value").isNotNull(), F.struct((-F.col("_n")).alias("rank"), "_value")))
    best = counted.groupBy(*by).agg(first.getField("_value").alias("_mode"))
    return best.groupBy(*keys).agg(*[F.max(F.when(F.col("_measure") == c, F.col("_mode"))).alias(c) for c in cols])


def one_row(df: DataFrame, *cols: Column | str) -> Column:
    """The single row of ``df`` as a struct column usable in any other query."""
    return df.select(F.struct(*(cols or df.columns)).alias("row")).scalar()


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def ranked_within(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """First ``k`` rows of each group; Spark trims each partition before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")
