"""Prediction quality and calibration over the held-out weeks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import CTES, query, r, rounded, rs
from checks.series import model_table
from weekloom.operators import forecast, model, validation
from weekloom.session import stage
from weekloom.sources.tables import clean_predictions

CTES["sparse_rows"] = CTES["model_rows"].replace("FROM weekly ", "FROM sparse ")
CTES["sparse_lines"] = CTES["roll_lines"].replace("model_rows", "sparse_rows")
CTES["sparse_pred"] = """
  SELECT order_week, category, units AS y, coalesce(a, 0) + coalesce(b, 1) * units_roll4 AS yhat
  FROM sparse_rows LEFT JOIN sparse_lines USING (category) WHERE split = 'valid' AND units_roll4 IS NOT NULL"""


def predictions(t, weekly=None):
    """Validation predictions of the per-category line over the rolling mean."""
    scored = model.fit_score_linear(model_table(t, weekly), "units", "units_roll4")
    return clean_predictions(model.valid_predictions(scored))


_PER = ["sum_abs_err", "sum_abs_y", "MAE", "Bias", "Actual_sum", "MAPE", "R2", "wMAPE"]
_PER_SQL = f"SELECT category, n, {', '.join(r(f'\"{c}\"', 5) for c in _PER)} FROM per_category"


@query(
    "e1_overall_metrics",
    f"""SELECT {r('avg(abs(y - yhat))', 5, '"MAE"')}, {r('sum(abs(y - yhat)) / greatest(1e-9, sum(abs(y)))', 6, '"wMAPE"')},
      {r('avg(yhat - y)', 5, '"Bias"')}, {r('corr(y, yhat) ** 2', 6, '"R2"')} FROM pred""",
)
def _(t):
    return rounded(rounded(validation.overall_metrics(predictions(t)), 5, "MAE", "Bias"), 6, "wMAPE", "R2")


_TRAINING = f"""SELECT {r('avg(abs(y - yhat))', 5, '"MAE"')},
  {r('avg(abs(greatest(y, 1e-6) - greatest(yhat, 1e-6)) / greatest(y, 1e-6))', 6, '"MAPE"')}"""


@query(
    "e2_training_metrics",
    f"""{_TRAINING}, {r('1 - sum((y - yhat) ** 2) / (count(*) * var_pop(y))', 6, '"R2"')},
      (SELECT count(*) FROM model_rows WHERE split = 'train') AS train_rows,
      (SELECT count(*) FROM model_rows WHERE split = 'valid') AS valid_rows FROM pred""",
)
def _(t):
    table = model.fit_score_linear(model_table(t, t.series), "units", "units_roll4")
    pred = clean_predictions(model.valid_predictions(table))
    metrics = validation.training_metrics(pred, split_sizes=model_table(t, t.series).select("split"))
    return rounded(rounded(metrics, 5, "MAE"), 6, "MAPE", "R2")


@query("e2_training_metrics_no_leak", f"{_TRAINING}, {r('corr(y, yhat) ** 2', 6, '"R2"')} FROM pred")
def _(t):
    return rounded(rounded(validation.training_metrics(predictions(t), r2="corr"), 5, "MAE"), 6, "MAPE", "R2")


@query("e3_metrics_by_category", _PER_SQL)
def _(t):
    return rounded(validation.metrics_by_category(predictions(t)), 5, *_PER)


@query("e4_validation_leaderboard", _PER_SQL.replace("FROM per", f", {r('\"wMAPE\" * 100', 4, '\"wMAPE_pct\"')} FROM per"))
def _(t):
    board = validation.validation_leaderboard(validation.metrics_by_category(predictions(t)))
    return rounded(rounded(board, 5, *_PER), 4, "wMAPE_pct")


def _worst(view: str, order: str, where: str = ""):
    sql = f'SELECT category, n, {r("\"wMAPE\"", 5)}, {r("\"Bias\"", 5)} FROM (SELECT * FROM per_category {where} ORDER BY {order}, category LIMIT 15)'

    @query(f"e5_worst_{view}", sql)
    def _(t):
        worst = validation.worst_categories(validation.metrics_by_category(predictions(t)), view)
        return rounded(worst.select("category", "n", "wMAPE", "Bias"), 5, "wMAPE", "Bias")


_worst("wmape", '"wMAPE" DESC', 'WHERE "Actual_sum" > 0')
_worst("over", '"Bias" DESC')
_worst("under", '"Bias"')


@query(
    "e6_calibration_global",
    f"SELECT {r('regr_intercept(y, yhat)', 5, 'intercept')}, {r('regr_slope(y, yhat)', 6, 'slope')} FROM pred",
)
def _(t):
    return rounded(rounded(validation.calibration_global(predictions(t)), 5, "intercept"), 6, "slope")


_CAL = f'SELECT category, {r("scale_b", 6)}, {r("offset_a", 4)}, {r("\"Bias_units\"", 5)} FROM calibration'


@query("e7_calibration_by_category", _CAL)
def _(t):
    cal = validation.calibration_by_category(predictions(t))
    return rounded(rounded(rounded(cal, 6, "scale_b"), 4, "offset_a"), 5, "Bias_units")


CTES["sparse_calibration"] = CTES["calibration"].replace("FROM pred", "FROM sparse_pred")


@query("e7_calibration_short_series", _CAL.replace("FROM calibration", "FROM sparse_calibration"))
def _(t):
    cal = validation.calibration_by_category(predictions(t, t.sparse(t.weekly)))
    return rounded(rounded(rounded(cal, 6, "scale_b"), 4, "offset_a"), 5, "Bias_units")


def fix_list(t):
    pred = stage(predictions(t, t.series), "predictions")
    return validation.validation_actions(validation.metrics_by_category(pred), pred, t.series), pred


_FIX = {
    "MAE": 5, "wMAPE_pct": 4, "Bias": 5, "Actual_sum": 4, "avg_price_val": 4, "sum_abs_err": 4,
    "Revenue_at_Risk": 2, "PriorityScore": 4, "scale_b": 6, "offset_a": 4,
}


@query(
    "e8_validation_actions",
    'SELECT category, n, "Recommendation", ' + ", ".join(r(f'"{c}"', d) for c, d in _FIX.items()) + " FROM fix_list",
)
def _(t):
    actions, _ = fix_list(t)
    return actions.withColumns({c: F.round(c, d) for c, d in _FIX.items()})


# The forecast to calibrate: recent price, units from the rolling-mean line, 8 weeks ahead.
def flat_forecast(t):
    lines = model.fit_linear_by_group(model_table(t, t.series).where("split = 'train'"), "units", "units_roll4")
    predictor = model.LinearPredictor(stage(lines, "lines"), "units_roll4")
    return forecast.recursive_forecast(t.series, forecast.price_plan(t.series), predictor, holidays=t.holidays)


def calibrated_forecast(t):
    pred = predictions(t, t.series)
    return validation.apply_calibration(flat_forecast(t), validation.calibration_by_category(pred))


# One row per category and step: the last four known weeks move along the recursion.
CTES["flat_steps"] = """
  SELECT category, 0 AS step, max(CASE WHEN k = 4 THEN units END) AS u4, max(CASE WHEN k = 3 THEN units END) AS u3,
    max(CASE WHEN k = 2 THEN units END) AS u2, max(CASE WHEN k = 1 THEN units END) AS u1
  FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY order_week DESC) AS k FROM weekly) WHERE k <= 4
  GROUP BY category
  UNION ALL SELECT s.category, step + 1, u3, u2, u1,
    coalesce(a, 0) + coalesce(b, 1) * ((coalesce(u4, 0) + coalesce(u3, 0) + coalesce(u2, 0) + coalesce(u1, 0))
      / ((u4 IS NOT NULL)::INT + (u3 IS NOT NULL)::INT + (u2 IS NOT NULL)::INT + (u1 IS NOT NULL)::INT))
  FROM flat_steps s LEFT JOIN roll_lines l ON l.category = s.category WHERE step < 8"""
CTES["flat_forecast"] = """
  SELECT order_week, s.category, avg_price_recent AS avg_price, u1 AS units, avg_price_recent * u1 AS revenue
  FROM flat_steps s JOIN future_weeks USING (step) JOIN recent c ON c.category = s.category"""
CTES["calibrated"] = """
  SELECT f.*, coalesce(scale_b, 1) AS scale_b, coalesce(offset_a, 0) AS offset_a,
    greatest(0, coalesce(offset_a, 0) + coalesce(scale_b, 1) * units) AS units_cal,
    avg_price * greatest(0, coalesce(offset_a, 0) + coalesce(scale_b, 1) * units) AS revenue_cal
  FROM flat_forecast f LEFT JOIN calibration c ON c.category = f.category"""
CTES["cal_impact"] = """
  SELECT category, sum(units) AS base_units, sum(units_cal) AS cal_units, sum(revenue) AS base_rev,
    sum(revenue_cal) AS cal_rev, sum(units_cal) - sum(units) AS delta_units,
    sum(revenue_cal) - sum(revenue) AS delta_revenue FROM calibrated GROUP BY category"""


@query(
    "e9_apply_calibration",
    f"""SELECT order_week, category, {rs(6, 'scale_b')}, {rs(4, 'avg_price', 'units', 'offset_a', 'units_cal')},
      {rs(1, 'revenue', 'revenue_cal')} FROM calibrated""",
)
def _(t):
    out = rounded(calibrated_forecast(t), 4, "avg_price", "units", "offset_a", "units_cal")
    return rounded(rounded(out, 6, "scale_b"), 1, "revenue", "revenue_cal")


@query(
    "e10_calibration_impact",
    f"""SELECT category, {rs(3, 'base_units', 'cal_units', 'delta_units')},
      {rs(1, 'base_rev', 'cal_rev', 'delta_revenue')} FROM cal_impact""",
)
def _(t):
    impact = rounded(validation.calibration_impact(calibrated_forecast(t)), 3, "base_units", "cal_units", "delta_units")
    return rounded(impact, 1, "base_rev", "cal_rev", "delta_revenue")


_BOTH = f"SELECT order_week, category, {rs(3, 'units_base', 'units_cal')} FROM "
_FORWARD = """(SELECT order_week, f.category, units AS units_base, offset_a + scale_b * units AS units_cal
  FROM flat_forecast f JOIN calibration c ON c.category = f.category)"""


def _both(df):
    return rounded(df.select("order_week", "category", "units_base", "units_cal"), 3, "units_base", "units_cal")


@query("e11_reconcile_unified", _BOTH + "(SELECT *, units AS units_base FROM calibrated)")
def _(t):
    unified = calibrated_forecast(t).select(
        F.col("order_week").alias("Week"), "category", F.col("units").alias("base_units"), F.col("units_cal").alias("calibrated_units")
    )
    return _both(validation.reconcile_base_cal(unified=unified))


@query("e11_reconcile_join", _BOTH + "(SELECT *, units AS units_base FROM calibrated)")
def _(t):
    both = stage(calibrated_forecast(t), "calibrated")
    return _both(
        validation.reconcile_base_cal(
            base=both.select("order_week", "category", "units"), cal=both.select("order_week", "category", "units_cal")
        )
    )


def _params(t):
    return validation.calibration_params(validation.calibration_by_category(predictions(t, t.series)))


@query("e11_reconcile_forward", _BOTH + _FORWARD)
def _(t):
    return _both(validation.reconcile_base_cal(base=flat_forecast(t), params=_params(t)))


@query("e11_reconcile_inverted", _BOTH + _FORWARD)
def _(t):
    params = stage(_params(t), "calibration")
    cal = flat_forecast(t).join(params, "category").select(
        "order_week", "category", (F.col("a") + F.col("b") * F.col("units")).alias("units_cal")
    )
    return _both(validation.reconcile_base_cal(cal=cal, params=params))
