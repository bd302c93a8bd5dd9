"""Tables behind the charts and briefs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekloom.functions.columns import same_number
from weekloom.functions.grouped import ranked_within, top_k
from weekloom.functions.moments import line
from weekloom.operators.features import CATEGORY, WEEK


def _top_categories(df: DataFrame, measure: str, k: int) -> DataFrame:
    totals = df.groupBy(CATEGORY).agg(F.sum(measure).alias("_total"))
    return top_k(totals, [F.desc_nulls_last("_total"), F.asc(CATEGORY)], k).select(CATEGORY)


def history_and_forecast(history: DataFrame, forecast: DataFrame, k: int = 6) -> DataFrame:
    """Weekly units, known and predicted, of the categories with most revenue so far."""
    points = history.select(WEEK, CATEGORY, "units", F.lit("history").alias("kind")).unionByName(
        forecast.select(WEEK, CATEGORY, "units", F.lit("forecast").alias("kind"))
    )
    points = points.where(F.col(WEEK).isNotNull() & F.col("units").isNotNull())
    return points.join(_top_categories(history, "revenue", k), CATEGORY, "left_semi")


def validation_overlay(pred: DataFrame, history: DataFrame, k: int = 12, lookback: int = 26) -> DataFrame:
    """Actual and predicted weeks of the top categories after their last weeks before them."""
    top = pred.groupBy(CATEGORY).agg(F.sum("y").alias("_total"), F.min(WEEK).alias("_start"))
    top = top_k(top, [F.desc_nulls_last("_total"), F.asc(CATEGORY)], k).drop("_total")
    before = history.join(top, CATEGORY).where(F.col(WEEK) < F.col("_start"))
    context = ranked_within(before, [CATEGORY], [F.desc(WEEK)], lookback).select(
        CATEGORY, WEEK, F.col("units").alias("y"), F.lit(None).cast("double").alias("yhat"), F.lit("context").alias("kind")
    )
    shown = pred.join(top, CATEGORY, "left_semi").select(CATEGORY, WEEK, "y", "yhat", F.lit("validation").alias("kind"))
    return context.unionByName(shown)


def calibrated_vs_base(calibrated: DataFrame, actions: DataFrame, k: int = 6) -> DataFrame:
    top = top_k(actions.select(CATEGORY, "PriorityScore"), [F.desc_nulls_last("PriorityScore"), F.asc(CATEGORY)], k)
    return calibrated.join(top, CATEGORY, "left_semi").select(WEEK, CATEGORY, "units", "units_cal")


def scatter_fit(unified: DataFrame, params: DataFrame | None = None, min_points: int = 3) -> DataFrame:
    """Line through (units_base, units_cal) and the axis end, per category with enough points.

    ``params`` (category, a, b) replace the fitted line where they are known.
    """
    points = unified.dropna(subset=["units_base", "units_cal"])
    fit = line("units_cal", "units_base")
    per = points.groupBy(CATEGORY).agg(
        F.count("*").alias("n"),
        fit.intercept.alias("a"),
        fit.slope.alias("b"),
        F.min("units_base").alias("x_min"),
        F.max("units_base").alias("x_max"),
        (F.greatest(F.max("units_base"), F.max("units_cal")) * 1.05).alias("axis_max"),
    )
    per = per.where(F.col("n") >= min_points)
    if params is None:
        return per
    known = params.select(CATEGORY, F.col("a").alias("_a"), F.col("b").alias("_b"))
    per = per.join(known, CATEGORY, "left")
    return per.withColumns({"a": F.coalesce("_a", "a"), "b": F.coalesce("_b", "b")}).drop("_a", "_b")


def scenario_bars(deltas: DataFrame, measure: str, k: int = 15) -> DataFrame:
    """Categories moved most, either way, within each scenario."""
    top = ranked_within(deltas, ["scenario"], [F.desc_nulls_last(F.abs(measure)), F.asc(CATEGORY)], k)
    return top.select("scenario", CATEGORY, measure)


def top_bars(df: DataFrame, measure: str, k: int = 15, ascending: bool = False) -> DataFrame:
    order = F.asc_nulls_last(measure) if ascending else F.desc_nulls_last(measure)
    return top_k(df.select(CATEGORY, measure), [order, F.asc(CATEGORY)], k)


def risk_bars(profit: DataFrame, k: int = 15) -> DataFrame:
    """Largest profit drops, as positive numbers."""
    drop = F.abs(F.least(F.col("profit_lift"), F.lit(0.0)))
    drops = profit.withColumn("profit_drop_abs", F.when(F.col("profit_lift").isNotNull(), drop))
    return top_bars(drops, "profit_drop_abs", k)


def _proposed(safe: DataFrame, scenarios: DataFrame, k: int) -> DataFrame:
    """Top safe moves with the scenario to show: the same change, else the nearest one run.

    Categories without a baseline run are left out.
    """
    top = top_k(safe, [F.desc_nulls_last("profit_lift"), F.asc(CATEGORY)], k)
    wanted = top.select(
        CATEGORY, F.coalesce(F.col("scenario").cast("double"), F.lit(0.0)).alias("wanted"), "profit0", "profit_best", "profit_lift"
    )
    has_baseline = F.max((F.col("scenario") == 0.0).cast("int")).over(W.partitionBy(CATEGORY)) == 1
    runs = scenarios.select(CATEGORY, "scenario").distinct().withColumn("_baseline", has_baseline)
    near = wanted.join(runs.where("_baseline").drop("_baseline"), CATEGORY).withColumn("_exact", same_number("scenario", "wanted"))
    order = [F.desc("_exact"), F.abs(F.col("scenario") - F.col("wanted")), F.asc("scenario")]
    return ranked_within(near, [CATEGORY], order).withColumnRenamed("scenario", "s_used").drop("_exact")


def category_brief(safe: DataFrame, scenarios: DataFrame, k: int = 20) -> DataFrame:
    """Baseline and proposed price, units, revenue and profit of the top safe moves."""
    chosen = _proposed(safe, scenarios, k)
    runs = scenarios.join(chosen, CATEGORY)
    baseline, proposed = F.col("scenario") == 0.0, F.col("scenario") == F.col("s_used")
    per = runs.groupBy(CATEGORY, "s_used", "profit0", "profit_best", "profit_lift").agg(
        *[
            f(F.when(rows, F.col(c))).alias(f"{name}{i}")
            for i, rows in ((0, baseline), (1, proposed))
            for name, f, c in (("price", F.avg, "avg_price"), ("units", F.sum, "units_cal"), ("rev", F.sum, "revenue_cal"))
        ]
    )
    return per.select(
        CATEGORY, "s_used", "price0", "price1",
        F.try_divide(F.col("price1") - F.col("price0"), F.col("price0")).alias("price_change_pct"),
        "units0", "units1", (F.col("units1") - F.col("units0")).alias("delta_units"),
        "rev0", "rev1", (F.col("rev1") - F.col("rev0")).alias("delta_revenue"),
        "profit0", "profit_best", "profit_lift",
    )


def category_brief_series(
    safe: DataFrame, scenarios: DataFrame, history: DataFrame, k: int = 20, last_weeks: int = 16
) -> DataFrame:
    """The three lines of a brief: recent history, baseline forecast, proposed forecast."""
    chosen = _proposed(safe, scenarios, k).select(CATEGORY, "s_used")
    recent = ranked_within(history.join(chosen, CATEGORY, "left_semi"), [CATEGORY], [F.desc(WEEK)], last_weeks)
    runs = scenarios.join(chosen, CATEGORY)
    lines = [
        recent.select(CATEGORY, WEEK, F.lit("history").alias("kind"), "units"),
        runs.where(F.col("scenario") == 0.0).select(CATEGORY, WEEK, F.lit("baseline").alias("kind"), F.col("units_cal").alias("units")),
        runs.where(F.col("scenario") == F.col("s_used")).select(
            CATEGORY, WEEK, F.lit("proposed").alias("kind"), F.col("units_cal").alias("units")
        ),
    ]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])
