"""Price plans, forecasts, rollups and their quality checks."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.registry import CTES, query, r, rounded, rs
from checks.series import ensemble, model_table
from checks.validation import calibrated_forecast, flat_forecast
from weekloom.operators import features, forecast, model
from weekloom.session import stage

CTES["brands"] = "SELECT DISTINCT p_brand, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS b FROM part"


def brands(t):
    return t.table("part").select("p_brand", F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("b")).distinct()


@query("f1_recent_mean", f"SELECT category, {rs(4, 'avg_price_recent', 'rev_count_recent', 'rev_score_avg_recent')} FROM recent")
def _(t):
    return rounded(forecast.recent_mean(t.weekly), 4, "avg_price_recent", "rev_count_recent", "rev_score_avg_recent")


@query("f2_future_grid", "SELECT order_week, category FROM future_weeks, (SELECT DISTINCT category FROM weekly)")
def _(t):
    return forecast.future_grid(t.series)


# Actions typed by hand: padded upper-case names, whole percents, none for brands above 20.
CTES["actions"] = "SELECT '  ' || upper(p_brand) AS category, CAST((b % 7 - 3) * 5 AS DOUBLE) AS recommended_pct FROM brands WHERE b <= 20"
CTES["plan"] = """
  SELECT w.order_week, c.category, lower(trim(c.category)) AS cat_key, avg_price_recent AS base_price,
    coalesce(recommended_pct / 100.0, 0.0) AS applied_pct,
    avg_price_recent * (1 + coalesce(recommended_pct / 100.0, 0.0)) AS planned_price
  FROM recent c LEFT JOIN actions a ON lower(trim(a.category)) = lower(trim(c.category)), future_weeks w"""


def actions(t):
    return brands(t).where("b <= 20").select(
        F.concat(F.lit("  "), F.upper("p_brand")).alias("category"), ((F.col("b") % 7 - 3) * 5).cast("double").alias("recommended_pct")
    )


_PLAN = f"SELECT order_week, category, cat_key, {rs(7, 'base_price', 'applied_pct', 'planned_price')} FROM plan"


def _plan(df):
    return rounded(df, 7, "base_price", "applied_pct", "planned_price")


@query("f3_price_plan", _PLAN)
def _(t):
    return _plan(forecast.price_plan(t.series, actions(t)))


@query("f3_price_plan_fractions", _PLAN)
def _(t):
    as_fraction = actions(t).select(
        F.col("category").alias("product_category_name_english"), (F.col("recommended_pct") / 100).alias("percent_price_change")
    )
    return _plan(forecast.price_plan(t.series, as_fraction))


@query(
    "f4_price_plan_diagnostics",
    f"""SELECT category, {rs(7, 'base_price', 'applied_pct', 'planned_price')},
      CASE WHEN abs(applied_pct) > 1e-9 THEN 'yes' ELSE 'no' END AS changed
    FROM (SELECT DISTINCT category, base_price, applied_pct, planned_price FROM plan)""",
)
def _(t):
    return _plan(forecast.price_plan_diagnostics(forecast.price_plan(t.series, actions(t))))


def _forecast(df):
    """Prices at seven digits: a percentage on a mean of four prices can lie exactly between two of four."""
    return rounded(rounded(rounded(df, 7, "avg_price"), 4, "units"), 1, "revenue")


@query(
    "f5_recursive_forecast",
    f"SELECT order_week, category, {rs(7, 'avg_price')}, {rs(4, 'units')}, {rs(1, 'revenue')} FROM flat_forecast",
)
def _(t):
    return _forecast(flat_forecast(t))


# Rolling mean over short and long series, with the frame of a model that saw the current row.
CTES["mean_steps"] = """
  SELECT category, 0 AS step, max(CASE WHEN k = 3 THEN units END) AS u3, max(CASE WHEN k = 2 THEN units END) AS u2,
    max(CASE WHEN k = 1 THEN units END) AS u1
  FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY order_week DESC) AS k FROM sparse) WHERE k <= 3
  GROUP BY category
  UNION ALL SELECT category, step + 1, u2, u1, (coalesce(u3, 0) + coalesce(u2, 0) + coalesce(u1, 0))
      / ((u3 IS NOT NULL)::INT + (u2 IS NOT NULL)::INT + (u1 IS NOT NULL)::INT)
  FROM mean_steps WHERE step < 8"""
CTES["sparse_recent"] = CTES["recent"].replace("FROM weekly", "FROM sparse")


@query(
    "f5_recursive_forecast_rolling_mean",
    f"""SELECT order_week, m.category, {r('avg_price_recent', 7, 'avg_price')}, {r('u1', 4, 'units')},
      {r('avg_price_recent * u1', 1, 'revenue')}
    FROM mean_steps m JOIN future_weeks USING (step) JOIN sparse_recent s ON s.category = m.category""",
)
def _(t):
    history = stage(t.sparse(t.series), "sparse")
    out = forecast.recursive_forecast(
        history, forecast.price_plan(history), model.RollingMeanPredictor(), forecast.FeaturePolicy(include_current=True)
    )
    return _forecast(out)


# The plan lacks one brand and every second week; those weeks take the recent price.
_PARTIAL = "(SELECT * FROM plan WHERE category <> 'Brand#7' AND week(order_week) % 2 = 1)"


@query(
    "f5_recursive_forecast_partial_plan",
    f"""SELECT future_weeks.order_week, s.category, {r('coalesce(planned_price, avg_price_recent)', 7, 'avg_price')}, {r('u1', 4, 'units')},
      {r('coalesce(planned_price, avg_price_recent) * u1', 1, 'revenue')}
    FROM flat_steps s JOIN future_weeks USING (step) JOIN recent c ON c.category = s.category
    LEFT JOIN {_PARTIAL} p ON p.order_week = future_weeks.order_week AND p.category = s.category""",
)
def _(t):
    plan = forecast.price_plan(t.series, actions(t)).where((F.col("category") != "Brand#7") & (F.weekofyear("order_week") % 2 == 1))
    lines = model.fit_linear_by_group(model_table(t, t.series).where("split = 'train'"), "units", "units_roll4")
    out = forecast.recursive_forecast(t.series, plan, model.LinearPredictor(stage(lines, "lines"), "units_roll4"))
    return _forecast(out)


def filled(t):
    """The series with the review scores filled as in training."""
    return stage(features.fill_rolling_mean(t.series, "rev_score_avg"), "filled")


def consequences(df, *keys):
    """What SQL can know of a tree forecast: keys, prices, and that units are there and make the revenue."""
    follows = F.abs(F.col("revenue") - F.col("avg_price") * F.col("units")) <= 1e-6 * (1 + F.abs("revenue"))
    known = F.col("units").isNotNull() & ~F.isnan("units")
    return df.select(*keys, F.round("avg_price", 7).alias("avg_price"), known.alias("predicted"), follows.alias("follows"))


@query(
    "f5_recursive_forecast_model",
    f"SELECT order_week, category, {r('avg_price_recent', 7, 'avg_price')}, true AS predicted, true AS follows FROM recent, future_weeks",
)
def _(t):
    _, trees = ensemble(t)
    out = forecast.recursive_forecast(filled(t), None, trees, holidays=t.holidays)
    return consequences(out, "order_week", "category")


@query(
    "f5_recursive_forecast_model_with_plan",
    f"SELECT order_week, category, {r('planned_price', 7, 'avg_price')}, true AS predicted, true AS follows FROM plan",
)
def _(t):
    _, trees = ensemble(t, with_revenue=True)
    policy = forecast.FeaturePolicy(include_current=True, revenue_proxy=True)
    plan = forecast.price_plan(t.series, actions(t))
    out = forecast.recursive_forecast(filled(t), plan, trees, policy, holidays=t.holidays)
    return consequences(out, "order_week", "category")


# -- plan impact: units from the per-category line over price ---------------------------------


def price_predictor(t):
    lines = model.fit_linear_by_group(model_table(t, t.series).where("split = 'train'"), "units", "avg_price")
    return model.LinearPredictor(stage(lines, "price-lines"), "avg_price")


def margins(t):
    return brands(t).where("b % 3 = 0").select(F.col("p_brand").alias("category"), (F.col("b") / 100).alias("margin_rate"))


def plan_impact(t):
    predictor = price_predictor(t)
    planned = forecast.recursive_forecast(t.series, forecast.price_plan(t.series, actions(t)), predictor)
    valid = model_table(t, t.series).where("split = 'valid'").select("category", "avg_price")
    return forecast.plan_impact(stage(planned, "planned"), model.score(predictor, valid), margins(t))


CTES["margins"] = "SELECT p_brand AS category, b / 100 AS margin_rate FROM brands WHERE b % 3 = 0"
CTES["plan_effect"] = """
  SELECT p.*, base_units, base_revenue, coalesce(margin_rate, 0.3) AS margin_rate, plan_units - base_units AS delta_units,
    plan_revenue - base_revenue AS delta_revenue,
    (plan_revenue - base_revenue) * coalesce(margin_rate, 0.3) AS delta_margin
  FROM (SELECT p.category, sum(a + b * planned_price) AS plan_units, sum(planned_price * (a + b * planned_price)) AS plan_revenue
        FROM plan p JOIN price_lines l ON l.category = p.category GROUP BY p.category) p
  LEFT JOIN (SELECT m.category, 8 * avg(a + b * avg_price) AS base_units, 8 * avg(avg_price * (a + b * avg_price)) AS base_revenue
        FROM model_rows m JOIN price_lines l ON l.category = m.category WHERE split = 'valid' GROUP BY m.category) v
    ON v.category = p.category
  LEFT JOIN margins m ON m.category = p.category"""


@query(
    "f6_plan_impact",
    f"""SELECT category, margin_rate, {rs(3, 'plan_units', 'base_units', 'delta_units')},
      {rs(1, 'plan_revenue', 'base_revenue', 'delta_revenue', 'delta_margin')} FROM plan_effect""",
)
def _(t):
    impact = rounded(plan_impact(t), 3, "plan_units", "base_units", "delta_units")
    return rounded(impact, 1, "plan_revenue", "base_revenue", "delta_revenue", "delta_margin")


@query(
    "f6_plan_impact_totals",
    f"""SELECT {r('sum(delta_units)', 2, 'delta_units')}, {r('sum(delta_revenue)', 0, 'delta_revenue')},
      {r('sum(delta_margin)', 0, 'delta_margin')} FROM plan_effect""",
)
def _(t):
    totals = forecast.impact_totals(plan_impact(t))
    return rounded(rounded(totals, 2, "delta_units"), 0, "delta_revenue", "delta_margin")


# -- unified forecast: no calibrated rows for one brand, no plan for another -------------------

CTES["unified"] = """
  SELECT order_week, category, avg_price, planned_price, coalesce(planned_price, avg_price) AS price_for_revenue,
    units_base, units_cal, coalesce(planned_price, avg_price) * units_base AS revenue_base_price,
    coalesce(planned_price, avg_price) * units_cal AS revenue_cal_price
  FROM (SELECT order_week, category, avg_price, units AS units_base FROM flat_forecast WHERE category <> 'Brand#5')
  FULL JOIN (SELECT order_week, category, units_cal FROM calibrated WHERE category <> 'Brand#3') USING (order_week, category)
  LEFT JOIN (SELECT order_week, category, planned_price FROM plan WHERE category <> 'Brand#7') USING (order_week, category)"""
CTES["unified_full"] = re.sub(r" WHERE category <> 'Brand#\d'", "", CTES["unified"])
_UNITS, _MONEY = ["units_base", "units_cal"], ["revenue_base_price", "revenue_cal_price"]
_PRICES = ["avg_price", "planned_price", "price_for_revenue"]
_UNIFIED = f"SELECT order_week, category, {rs(7, *_PRICES)}, {rs(3, *_UNITS)}, {rs(1, *_MONEY)} FROM unified"


def unified(t, partial: bool = False):
    cal = stage(calibrated_forecast(t), "calibrated")
    plan = forecast.price_plan(t.series, actions(t))
    base, calibrated = cal.select("order_week", "category", "avg_price", "units"), cal.select("order_week", "category", "units_cal")
    if partial:
        base, calibrated = base.where("category <> 'Brand#5'"), calibrated.where("category <> 'Brand#3'")
        plan = plan.where("category <> 'Brand#7'")
    return stage(forecast.unify_forecasts(base, calibrated, plan), "unified")


@query("f7_unify_forecasts", _UNIFIED)
def _(t):
    return rounded(rounded(rounded(unified(t, partial=True), 7, *_PRICES), 3, *_UNITS), 1, *_MONEY)


_SUMS = """coalesce(sum(units_base), 0) AS units_base, coalesce(sum(units_cal), 0) AS units_cal,
  coalesce(sum(revenue_base_price), 0) AS revenue_base, coalesce(sum(revenue_cal_price), 0) AS revenue_cal"""
_TOTALS_ROUNDED = f"{rs(2, 'units_base', 'units_cal')}, {rs(0, 'revenue_base', 'revenue_cal')}"


def _totals(df):
    return rounded(rounded(df, 2, "units_base", "units_cal"), 0, "revenue_base", "revenue_cal")


@query(
    "f8_forecast_rollups",
    f"""SELECT grain, order_week, category, {_TOTALS_ROUNDED} FROM
      (SELECT 'week_category' AS grain, order_week, category, {_SUMS} FROM unified_full GROUP BY order_week, category
       UNION ALL BY NAME SELECT 'week' AS grain, order_week, NULL AS category, {_SUMS} FROM unified_full GROUP BY order_week
       UNION ALL BY NAME SELECT 'total' AS grain, NULL AS order_week, NULL AS category, {_SUMS} FROM unified_full)""",
)
def _(t):
    return _totals(forecast.forecast_rollups(unified(t)))


@query(
    "f8_forecast_summary",
    f"""WITH s AS (SELECT {_SUMS} FROM unified_full)
    SELECT metric, {r('value', 0)}, {r('delta_vs_base', 0)} FROM (
      SELECT 'units_base' AS metric, units_base AS value, CAST(NULL AS DOUBLE) AS delta_vs_base FROM s
      UNION ALL SELECT 'units_cal', units_cal, units_cal - units_base FROM s
      UNION ALL SELECT 'revenue_base', revenue_base, NULL FROM s
      UNION ALL SELECT 'revenue_cal', revenue_cal, revenue_cal - revenue_base FROM s)""",
)
def _(t):
    rollups = forecast.forecast_rollups(unified(t))
    return rounded(forecast.rollup_grain(rollups, "total"), 0, "value", "delta_vs_base")


_NUMERIC = ["price_for_revenue", "units_base", "units_cal", "revenue_base_price", "revenue_cal_price"]


# The rollups are those of the sound table; then one brand's rows come twice and another loses its calibrated units.
CTES["unified_damaged"] = """
  SELECT * REPLACE (CASE WHEN category <> 'Brand#4' THEN units_cal END AS units_cal) FROM unified_full
  UNION ALL (SELECT * FROM unified_full WHERE category = 'Brand#9')"""


def _rollup_gap(grain: str, column: str, by: str) -> str:
    sums = f"SELECT {by}, sum({column}) AS v FROM {{}} GROUP BY ALL"
    return f"""SELECT 'rollup_{grain}' AS "check", CAST(sum(abs(coalesce(a.v, 0) - coalesce(b.v, 0))) >= 1e-6 AS BIGINT) AS violations
      FROM ({sums.format('unified_full')}) a FULL JOIN ({sums.format('unified_damaged')}) b USING ({by})"""


@query(
    "f9_qa_checks",
    "SELECT 'duplicate_keys' AS \"check\", count(*) - count(DISTINCT (order_week, category)) AS violations FROM unified_damaged"
    " UNION ALL SELECT 'missing_columns', 0 UNION ALL "
    + " UNION ALL ".join(
        _rollup_gap(f"{grain}_{name}", column, by)
        for grain, by in (("week_category", "order_week, category"), ("week", "order_week"))
        for name, column in (("units", "units_cal"), ("revenue", "revenue_cal_price"))
    )
    + "".join(f" UNION ALL SELECT 'nulls_{c}', count(*) - count({c}) FROM unified_damaged" for c in _NUMERIC),
)
def _(t):
    sound = unified(t)
    lost = sound.withColumn("units_cal", F.when(F.col("category") != "Brand#4", F.col("units_cal")))
    damaged = stage(lost.unionByName(sound.where("category = 'Brand#9'")), "damaged")
    return forecast.qa_checks(damaged, forecast.forecast_rollups(sound))


_KPI = "SELECT category, sum(revenue_cal_price) AS rev_8w, sum(units_cal) AS units_8w FROM unified_full GROUP BY category"


@query("f10_kpi_by_category", f"SELECT category, {rs(1, 'rev_8w')}, {rs(3, 'units_8w')} FROM ({_KPI})")
def _(t):
    return rounded(rounded(forecast.kpi_by_category(unified(t)), 1, "rev_8w"), 3, "units_8w")


@query(
    "f10_kpi_top_categories",
    f"SELECT category, {rs(1, 'rev_8w')}, {rs(3, 'units_8w')} FROM ({_KPI} ORDER BY rev_8w DESC, category LIMIT 10)",
)
def _(t):
    return rounded(rounded(forecast.kpi_top_categories(unified(t)), 1, "rev_8w"), 3, "units_8w")


@query(
    "f10_kpi_totals",
    f"SELECT {r('sum(units_cal)', 2, 'total_units_8w')}, {r('sum(revenue_cal_price)', 0, 'total_revenue_8w')} FROM unified_full",
)
def _(t):
    return rounded(rounded(forecast.kpi_totals(unified(t)), 2, "total_units_8w"), 0, "total_revenue_8w")
