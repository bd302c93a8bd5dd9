"""Weekly series per category and the features built on them.

Facts are aggregated to (week, category) with map-side combine before any window runs, so the
largest window partition is one category's number of weeks, however hot the category is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekloom.functions.columns import guarded, money_avg, money_sum, period_start, present, season

CATEGORY = "category"
WEEK = "order_week"
LAGS = (1, 2, 4, 8, 12, 52)
LAGGED = ("units", "revenue", "avg_price", "rev_count", "rev_score_avg")
ROLLED = ("units", "revenue")


def series_window(category: str = CATEGORY, week: str = WEEK) -> WindowSpec:
    return W.partitionBy(category).orderBy(week)


def weekly_aggregate(
    fact: DataFrame, date: str = "order_date", category: str = CATEGORY, grain: str = "week", price: str = "row_mean"
) -> DataFrame:
    """Units, revenue, mean price and review columns per period and category.

    An order's reviews count once for each of its lines. ``price="unit_weighted"`` divides
    revenue by units instead of averaging rows, for tables with real quantities.
    """
    keyed = fact.where(F.col(date).isNotNull()).select(
        period_start(date, grain).alias(WEEK),
        F.coalesce(F.col(category), F.lit("unknown")).alias(CATEGORY),
        "units",
        "revenue_item",
        F.coalesce("review_count", F.lit(0)).alias("review_count"),
        present("review_score_avg").alias("review_score_avg"),
    )
    weekly = keyed.groupBy(WEEK, CATEGORY).agg(
        F.sum("units").cast("double").alias("units"),
        money_sum("revenue_item").alias("revenue"),
        money_avg("revenue_item").alias("avg_price"),
        F.sum("review_count").cast("double").alias("rev_count"),
        F.avg("review_score_avg").alias("rev_score_avg"),
    )
    if price == "unit_weighted":
        weekly = weekly.withColumn("avg_price", guarded("revenue", "units"))
    return weekly


def densify(weekly: DataFrame) -> DataFrame:
    """Add the missing weeks between a category's first and last week, with zero units.

    Lags then are calendar lags. The calendar of one category is built from its own range.
    """
    span = weekly.groupBy(CATEGORY).agg(F.min(WEEK).alias("first"), F.max(WEEK).alias("last"))
    grid = span.select(CATEGORY, F.explode(F.expr("sequence(first, last, interval 7 days)")).alias(WEEK))
    columns = weekly.columns
    full = grid.join(weekly, [CATEGORY, WEEK], "left")
    return full.fillna(0.0, subset=[c for c in ("units", "revenue", "rev_count") if c in columns]).select(*columns)


def fill_rolling_mean(df: DataFrame, col: str, n: int = 8) -> DataFrame:
    frame = series_window().rowsBetween(-(n - 1), 0)
    return df.withColumn(col, F.coalesce(F.col(col), F.avg(col).over(frame)))


def calendar_features(df: DataFrame, week: str = WEEK) -> DataFrame:
    return df.withColumns(season(week))


def holiday_flag(df: DataFrame, holidays: DataFrame, any_day: bool = False) -> DataFrame:
    """1 when the Monday is a holiday; with ``any_day``, when any day of its week is one."""
    day = F.date_sub("date", F.weekday("date")) if any_day else F.col("date")
    marked = holidays.select(day.alias(WEEK)).where(F.col(WEEK).isNotNull()).distinct()
    marked = marked.withColumn("is_holiday_week", F.lit(1))
    return df.join(marked, WEEK, "left").withColumn("is_holiday_week", F.coalesce("is_holiday_week", F.lit(0)))


def add_lags(df: DataFrame, cols: Sequence[str] = LAGGED, lags: Sequence[int] = LAGS) -> DataFrame:
    """Row lags per category: one window definition, hence one sort for all columns."""
    w = series_window()
    return df.withColumns({f"{c}_lag{n}": F.lag(c, n).over(w) for c in cols for n in lags})


def rolling_means(
    df: DataFrame, cols: Sequence[str] = ROLLED, n: int = 4, include_current: bool = False
) -> DataFrame:
    """Mean of the last ``n`` rows; by default the current row is left out (no leakage)."""
    first, last = (-(n - 1), 0) if include_current else (-n, -1)
    frame = series_window().rowsBetween(first, last)
    return df.withColumns({f"{c}_roll{n}": F.avg(c).over(frame) for c in cols})


def week_index(df: DataFrame) -> DataFrame:
    return df.withColumn("week_idx", F.row_number().over(series_window()) - 1)


def longest_usable_lag(n: Column, lags: Sequence[int]) -> Column:
    return F.greatest(F.lit(0), *[F.when(n > lag, lag).otherwise(0) for lag in lags])


def warmup_trim(df: DataFrame, lags: Sequence[int] = LAGS, mode: str = "adaptive") -> DataFrame:
    """Drop the rows at the start of each series that lack lagged values.

    strict: every column ``*_lagN`` must be present. adaptive: drop as many rows as the
    longest lag that is shorter than the series, so every category keeps at least one row.
    """
    if mode == "strict":
        suffixes = tuple(f"_lag{n}" for n in lags)
        return df.dropna(subset=[c for c in df.columns if c.endswith(suffixes)])
    if mode != "adaptive":
        raise ValueError(f"unknown warm-up mode: {mode}")
    position = F.row_number().over(series_window())
    size = F.count("*").over(W.partitionBy(CATEGORY))
    marked = df.withColumns({"_position": position, "_size": size})
    return marked.where(F.col("_position") > longest_usable_lag(F.col("_size"), lags)).drop("_position", "_size")


def time_split(df: DataFrame, mode: str = "ratio", valid_weeks: int = 12, share: float = 0.2) -> DataFrame:
    """Mark the last rows of each category "valid", the others "train".

    fixed: the last ``valid_weeks`` rows, all rows of shorter series. ratio: the rounded share,
    between 1 and ``valid_weeks``; a single-row series is all "train".
    """
    size = F.count("*").over(W.partitionBy(CATEGORY))
    from_end = F.row_number().over(W.partitionBy(CATEGORY).orderBy(F.desc(WEEK)))
    marked = df.withColumns({"_size": size, "_from_end": from_end})
    if mode == "fixed":
        length = F.lit(valid_weeks)
    elif mode == "ratio":
        rounded = F.greatest(F.lit(1), F.least(F.lit(valid_weeks), F.bround(F.col("_size") * share).cast("int")))
        length = F.when(F.col("_size") <= 1, 0).otherwise(rounded)
    else:
        raise ValueError(f"unknown split mode: {mode}")
    split = F.when(F.col("_from_end") <= length, "valid").otherwise("train")
    return marked.withColumn("split", split).drop("_size", "_from_end")


def ensure_valid_rows(df: DataFrame) -> DataFrame:
    """If no row at all is "valid", make each category's last row so."""
    any_valid = df.agg(F.coalesce(F.bool_or(F.col("split") == "valid"), F.lit(False))).scalar()
    newest = F.row_number().over(W.partitionBy(CATEGORY).orderBy(F.desc(WEEK))) == 1
    marked = df.withColumns({"_any": any_valid, "_newest": newest})
    split = F.when(~F.col("_any") & F.col("_newest"), "valid").otherwise(F.col("split"))
    return marked.withColumn("split", split).drop("_any", "_newest")


def trim_tail(
    df: DataFrame, col: str = "units", lookback: int = 8, share: float = 0.25, max_drop: int = 2
) -> DataFrame:
    """Drop up to ``max_drop`` incomplete weeks at the end of each series.

    A week is incomplete when it has ``lookback`` weeks before it and lies under ``share`` of
    their median. Trimming stops at the first week from the end that is not incomplete: a row
    goes only if every row from it to the end is incomplete.
    """
    forward = series_window()
    median = F.percentile(col, F.lit(0.5)).over(forward.rowsBetween(-lookback, -1))
    low = (F.row_number().over(forward) > lookback) & (F.col(col) < share * median)
    backward = W.partitionBy(CATEGORY).orderBy(F.desc(WEEK))
    marked = df.withColumn("_low", F.coalesce(low, F.lit(False))).withColumns(
        {
            "_from_end": F.row_number().over(backward),
            "_all_low": F.min("_low").over(backward.rowsBetween(W.unboundedPreceding, 0)),
        }
    )
    return marked.where(~(F.col("_all_low") & (F.col("_from_end") <= max_drop))).drop("_low", "_from_end", "_all_low")


def weekly_features(weekly: DataFrame, holidays: DataFrame | None = None, include_current: bool = False) -> DataFrame:
    """Full feature table of the weekly series."""
    out = calendar_features(fill_rolling_mean(weekly, "rev_score_avg"))
    out = holiday_flag(out, holidays) if holidays is not None else out.withColumn("is_holiday_week", F.lit(0))
    return rolling_means(add_lags(week_index(out)), include_current=include_current)
