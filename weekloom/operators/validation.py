"""Prediction quality, calibration and the actions drawn from them.

Prediction tables have columns order_week, category, y (actual) and yhat (predicted).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.grouped import one_row, top_k
from weekloom.functions.moments import line, squares
from weekloom.operators.features import CATEGORY, WEEK
from weekloom.sources.schemas import FORECAST_ALIASES
from weekloom.sources.tables import require, standardize_columns

TINY = 1e-9
FLOOR = 1e-6
BIAS_LIMIT = 5.0
# The lines of advice.
ADVICE_UNDER = "Underpredict by %.1f u; try scale x%.2f or add %.1f"
ADVICE_OVER = "Overpredict by %.1f u; try scale x%.2f or add %.1f"
ADVICE_KEEP = "OK; keep global calibration (x%.2f, +%.1f)"


def _error() -> Column:
    return F.col("yhat") - F.col("y")


def overall_metrics(pred: DataFrame) -> DataFrame:
    err = F.abs(_error())
    return pred.agg(
        F.avg(err).alias("MAE"),
        (F.sum(err) / F.greatest(F.lit(TINY), F.sum(F.abs("y")))).alias("wMAPE"),
        F.avg(_error()).alias("Bias"),
        line("y", "yhat").r2.alias("R2"),
    )


def training_metrics(pred: DataFrame, split_sizes: DataFrame | None = None, r2: str = "sse") -> DataFrame:
    """MAE, MAPE with both sides floored, and R2 as 1-SSE/SST or as squared correlation.

    ``split_sizes`` (columns split) adds the number of train and valid rows.
    """
    y, yhat = F.greatest(F.col("y"), F.lit(FLOOR)), F.greatest(F.col("yhat"), F.lit(FLOOR))
    if r2 == "sse":
        fit = 1 - F.try_divide(squares(_error()), line("y", "y").syy)
    elif r2 == "corr":
        fit = line("y", "yhat").r2
    else:
        raise ValueError(f"unknown r2: {r2}")
    metrics = pred.agg(
        F.avg(F.abs(_error())).alias("MAE"), F.avg(F.abs(y - yhat) / y).alias("MAPE"), fit.alias("R2")
    )
    if split_sizes is None:
        return metrics
    sizes = one_row(
        split_sizes.agg(
            F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "valid").alias("valid")
        )
    )
    return metrics.withColumn("_s", sizes).select(
        "MAE", "MAPE", "R2", F.col("_s.train").alias("train_rows"), F.col("_s.valid").alias("valid_rows")
    )


def metrics_by_category(pred: DataFrame) -> DataFrame:
    """Per category errors, worst wMAPE first; MAPE and R2 are the figures shown on charts."""
    err = F.abs(_error())
    per = pred.groupBy(CATEGORY).agg(
        F.count("*").alias("n"),
        F.sum(err).alias("sum_abs_err"),
        F.sum(F.abs("y")).alias("sum_abs_y"),
        F.avg(err).alias("MAE"),
        F.avg(_error()).alias("Bias"),
        F.sum("y").alias("Actual_sum"),
        F.avg(F.abs((F.col("y") - F.col("yhat")) / F.greatest(F.col("y"), F.lit(FLOOR)))).alias("MAPE"),
        line("y", "yhat").r2.alias("R2"),
    )
    per = per.withColumn("wMAPE", F.col("sum_abs_err") / F.greatest(F.col("sum_abs_y"), F.lit(TINY)))
    return per.orderBy(F.desc_nulls_last("wMAPE"), CATEGORY)


def validation_leaderboard(per: DataFrame) -> DataFrame:
    return per.withColumn("wMAPE_pct", F.col("wMAPE") * 100).orderBy(
        F.asc_nulls_last("wMAPE"), F.desc_nulls_last("Actual_sum"), CATEGORY
    )


def worst_categories(per: DataFrame, view: str, k: int = 15) -> DataFrame:
    """view: wmape (only categories that sold something), over or under (by bias)."""
    orders = {
        "wmape": F.desc_nulls_last("wMAPE"),
        "over": F.desc_nulls_last("Bias"),
        "under": F.asc_nulls_last("Bias"),
    }
    rows = per.where(F.col("Actual_sum") > 0) if view == "wmape" else per
    return top_k(rows, [orders[view], F.asc(CATEGORY)], k)


def calibration_global(pred: DataFrame) -> DataFrame:
    fit = line("y", "yhat")
    return pred.agg(fit.intercept.alias("intercept"), fit.slope.alias("slope"))


def calibration_by_category(pred: DataFrame) -> DataFrame:
    """y = offset_a + scale_b * yhat per category; identity where no line can be fitted."""
    fit = line("y", "yhat")
    return pred.groupBy(CATEGORY).agg(
        F.coalesce(fit.slope, F.lit(1.0)).alias("scale_b"),
        F.coalesce(fit.intercept, F.lit(0.0)).alias("offset_a"),
        F.avg(_error()).alias("Bias_units"),
    )


def calibration_params(calibration: DataFrame) -> DataFrame:
    """category, a, b as scenario runs and reconcile_base_cal read them."""
    return calibration.select(CATEGORY, F.col("offset_a").alias("a"), F.col("scale_b").alias("b"))


def validation_actions(per: DataFrame, pred: DataFrame, history: DataFrame) -> DataFrame:
    """Ranked list of categories to fix, with their calibration and a line of advice."""
    limits = one_row(pred.agg(F.min(WEEK).alias("first"), F.max(WEEK).alias("last")))
    prices = (
        history.withColumn("_v", limits)
        .where(F.col(WEEK).between(F.col("_v.first"), F.col("_v.last")))
        .groupBy(CATEGORY)
        .agg(F.avg("avg_price").alias("avg_price_val"))
    )
    advice = (
        F.when(F.col("Bias") < -BIAS_LIMIT, F.format_string(ADVICE_UNDER, -F.col("Bias"), "scale_b", "offset_a"))
        .when(F.col("Bias") > BIAS_LIMIT, F.format_string(ADVICE_OVER, "Bias", "scale_b", "offset_a"))
        .otherwise(F.format_string(ADVICE_KEEP, "scale_b", "offset_a"))
    )
    return (
        per.join(calibration_by_category(pred), CATEGORY, "left")
        .join(prices, CATEGORY, "left")
        .withColumns(
            {
                "wMAPE_pct": F.col("wMAPE") * 100,
                "Revenue_at_Risk": F.col("sum_abs_err") * F.coalesce("avg_price_val", F.lit(0.0)),
                "PriorityScore": F.col("wMAPE") * F.abs("Actual_sum"),
                "Recommendation": advice,
            }
        )
        # Names and order of the output columns.
        .select(
            CATEGORY, "n", "MAE", "wMAPE_pct", "Bias", "Actual_sum", "avg_price_val", "sum_abs_err",
            "Revenue_at_Risk", "PriorityScore", "scale_b", "offset_a", "Recommendation",
        )
        .orderBy(F.desc_nulls_last("PriorityScore"), F.desc_nulls_last("Revenue_at_Risk"), CATEGORY)
    )


def apply_calibration(forecast: DataFrame, calibration: DataFrame) -> DataFrame:
    cal = calibration.select(CATEGORY, "scale_b", "offset_a")
    out = forecast.join(cal, CATEGORY, "left").withColumns(
        {"scale_b": F.coalesce("scale_b", F.lit(1.0)), "offset_a": F.coalesce("offset_a", F.lit(0.0))}
    )
    units = F.greatest(F.lit(0.0), F.col("offset_a") + F.col("scale_b") * F.col("units"))
    out = out.withColumn("units_cal", F.when(F.col("units").isNotNull(), units))
    return out.withColumn("revenue_cal", F.col("avg_price") * F.col("units_cal"))


def calibration_impact(calibrated: DataFrame) -> DataFrame:
    return (
        calibrated.groupBy(CATEGORY)
        .agg(
            F.sum("units").alias("base_units"),
            F.sum("units_cal").alias("cal_units"),
            F.sum("revenue").alias("base_rev"),
            F.sum("revenue_cal").alias("cal_rev"),
        )
        .withColumns(
            {
                "delta_units": F.col("cal_units") - F.col("base_units"),
                "delta_revenue": F.col("cal_rev") - F.col("base_rev"),
            }
        )
        .orderBy(F.desc_nulls_last("delta_revenue"), CATEGORY)
    )


def reconcile_base_cal(
    unified: DataFrame | None = None,
    base: DataFrame | None = None,
    cal: DataFrame | None = None,
    params: DataFrame | None = None,
) -> DataFrame:
    """One table with units_base and units_cal from whatever is at hand.

    In turn: a unified table as it is; base and calibrated forecasts joined; one of the two
    completed with the calibration line (category, a, b), inverted or applied.
    """
    both = {"units_base", "units_cal"}
    table = None if unified is None else standardize_columns(unified, FORECAST_ALIASES)
    if (table is None or not both <= set(table.columns)) and base is not None and cal is not None:
        left, right = standardize_columns(cal, FORECAST_ALIASES), standardize_columns(base, FORECAST_ALIASES)
        if "units_base" not in right.columns:
            right = right.withColumnRenamed("units", "units_base")
        keys = [k for k in (WEEK, CATEGORY) if k in left.columns and k in right.columns]
        if not keys:
            raise ValueError("base and calibrated forecasts share no key")
        table = left.drop("units_base").join(right.select(*keys, "units_base"), keys, "left")
    if table is None:
        single = cal if cal is not None else base
        if single is None:
            raise ValueError("no forecast given")
        table = standardize_columns(single, FORECAST_ALIASES)
        if single is base and "units_base" not in table.columns:
            table = table.withColumnRenamed("units", "units_base")
    if both <= set(table.columns):
        return table
    if not both & set(table.columns):
        raise ValueError("neither units_base nor units_cal is present")
    if params is None:
        raise ValueError("calibration params are needed to complete the forecast")
    lines = require(standardize_columns(params, FORECAST_ALIASES), [CATEGORY, "a", "b"], "calibration params")
    table = table.join(lines.select(CATEGORY, "a", "b"), CATEGORY, "left")
    if "units_base" in table.columns:
        return table.withColumn("units_cal", F.col("a") + F.col("b") * F.col("units_base"))
    has_line = F.raise_error(F.concat(F.lit("no calibration params for category "), F.col(CATEGORY)))
    inverted = F.try_divide(F.col("units_cal") - F.col("a"), F.col("b"))
    return table.withColumn("units_base", F.when(F.col("b").isNull(), has_line.cast("double")).otherwise(inverted))


