"""What-ifs, scenario runs, elasticities, recommendations, and the chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.forecasting import consequences, filled, margins, price_predictor
from checks.registry import CTES, query, r, rounded, rs
from checks.series import ensemble, loaded, model_table
from checks.validation import calibrated_forecast, fix_list, flat_forecast, predictions
from weekloom.operators import model, pricing, validation, views
from weekloom.session import stage


def valid_rows(t):
    return model_table(t, t.series).where("split = 'valid'").select(
        "order_week", "category", "units", "revenue", "avg_price", "avg_price_lag1"
    )


# -- what-if and actions -----------------------------------------------------------------------

CTES["grid"] = "SELECT CAST(v AS DOUBLE) AS pct FROM (VALUES (-0.20), (-0.15), (-0.10), (-0.05), (0.0), (0.05), (0.10)) g(v)"
CTES["change_effect"] = """
  SELECT category, pct, delta_units, delta_revenue, delta_revenue * coalesce(margin_rate, 0.3) AS delta_margin FROM
    (SELECT m.category, pct, sum((a + b * avg_price * (1 + pct)) - (a + b * avg_price)) AS delta_units,
       sum(avg_price * (1 + pct) * (a + b * avg_price * (1 + pct)) - avg_price * (a + b * avg_price)) AS delta_revenue
     FROM model_rows m JOIN price_lines l ON l.category = m.category, grid WHERE split = 'valid' GROUP BY m.category, pct)
    LEFT JOIN margins USING (category)"""


@query(
    "g1_what_if_summary",
    f"""SELECT pct AS percent_price_change, {r('sum(delta_units)', 2, 'delta_units')},
      {r('sum(delta_revenue)', 0, 'delta_revenue')}, {r('sum(delta_margin)', 0, 'delta_margin')}
    FROM change_effect WHERE pct = -0.1 GROUP BY pct""",
)
def _(t):
    effect = pricing.score_price_changes(valid_rows(t), price_predictor(t), [-0.1], margins=margins(t))
    return rounded(rounded(pricing.what_if_summary(effect), 2, "delta_units"), 0, "delta_revenue", "delta_margin")


@query(
    "g1_what_if_by_category",
    f"""SELECT category, {r("CASE WHEN category IN ('Brand#1', 'Brand#2') THEN delta_units ELSE 0 END", 3, 'delta_units')},
      {r("CASE WHEN category IN ('Brand#1', 'Brand#2') THEN delta_revenue ELSE 0 END", 1, 'delta_revenue')}
    FROM change_effect WHERE pct = -0.1""",
)
def _(t):
    effect = pricing.score_price_changes(valid_rows(t), price_predictor(t), [-0.1], categories=["Brand#1", "Brand#2"])
    return rounded(rounded(pricing.what_if_by_category(effect), 3, "delta_units"), 1, "delta_revenue")


@query(
    "g1_what_if_model",
    "SELECT DISTINCT category, -0.1::DOUBLE AS percent_price_change, true AS predicted, true AS follows FROM model_rows WHERE split = 'valid'",
)
def _(t):
    table, fitted = loaded(t)
    effect = pricing.score_price_changes(table.where("split = 'valid'"), fitted, [-0.1])
    follows = F.abs(F.col("delta_margin") - F.col("delta_revenue") * F.col("margin_rate")) <= 1e-6
    return effect.select("category", "percent_price_change", F.col("delta_units").isNotNull().alias("predicted"), follows.alias("follows"))


CTES["best_actions"] = """
  SELECT category, pct AS recommended_pct, delta_margin AS best_delta_margin FROM
    (SELECT *, row_number() OVER (PARTITION BY category ORDER BY delta_margin DESC, pct) AS k FROM change_effect) WHERE k = 1"""


def best_actions(t):
    return pricing.recommend_actions(valid_rows(t), price_predictor(t), margins=margins(t))


@query("g2_recommend_actions", f"SELECT category, recommended_pct, {rs(1, 'best_delta_margin')} FROM best_actions")
def _(t):
    return rounded(best_actions(t), 1, "best_delta_margin")


def _budget_sql(most: int) -> str:
    return f"""WITH RECURSIVE costed AS (SELECT *, row_number() OVER (ORDER BY best_delta_margin DESC, category) AS k FROM
      (SELECT a.category, recommended_pct, best_delta_margin, coalesce(abs(recommended_pct) * base_revenue, 0) AS cost
       FROM best_actions a LEFT JOIN (SELECT category, sum(revenue) AS base_revenue FROM model_rows WHERE split = 'valid'
         GROUP BY category) v ON v.category = a.category)),
    walk AS (
      SELECT CAST(0 AS BIGINT) AS k, CAST(0 AS DOUBLE) AS spent, 0 AS picked, false AS taken
      UNION ALL SELECT w.k + 1,
        CASE WHEN picked < {most} AND spent + cost <= total * 0.3 THEN spent + cost ELSE spent END,
        CASE WHEN picked < {most} AND spent + cost <= total * 0.3 THEN picked + 1 ELSE picked END,
        picked < {most} AND spent + cost <= total * 0.3
      FROM walk w JOIN costed c ON c.k = w.k + 1, (SELECT sum(cost) AS total FROM costed) s)
    SELECT category, recommended_pct, {rs(1, 'best_delta_margin')}, {rs(2, 'cost')}
    FROM costed c JOIN walk w ON w.k = c.k WHERE taken"""


def _selected(t, **options):
    revenue = valid_rows(t).groupBy("category").agg(F.sum("revenue").alias("base_revenue"))
    chosen = pricing.select_within_budget(best_actions(t), revenue, **options)
    return rounded(rounded(chosen, 1, "best_delta_margin"), 2, "cost")


@query("g3_select_within_budget", _budget_sql(10))
def _(t):
    return _selected(t)


@query("g3_select_within_budget_three", _budget_sql(3))
def _(t):
    return _selected(t, max_actions=3)


# -- scenarios ---------------------------------------------------------------------------------

CTES["scenarios"] = "SELECT CAST(v AS DOUBLE) AS scenario FROM (VALUES (-0.15), (-0.10), (-0.05), (0.0), (0.05), (0.10), (0.15)) s(v)"
CTES["scen"] = """
  SELECT order_week, category, scenario, avg_price, units_base, avg_price * units_base AS revenue_base, units_cal,
    avg_price * units_cal AS revenue_cal
  FROM (SELECT w.order_week, c.category, scenario, avg_price_recent * (1 + scenario) AS avg_price,
      a + b * (avg_price_recent * (1 + scenario)) AS units_base,
      offset_a + scale_b * (a + b * (avg_price_recent * (1 + scenario))) AS units_cal
    FROM recent c JOIN price_lines l ON l.category = c.category JOIN calibration k ON k.category = c.category,
      scenarios, future_weeks w)"""
CTES["scen_totals"] = """
  SELECT *, max(CASE WHEN scenario = 0 THEN units_s END) OVER (PARTITION BY category) AS units0,
    max(CASE WHEN scenario = 0 THEN revenue_s END) OVER (PARTITION BY category) AS revenue0,
    max(CASE WHEN scenario = 0 THEN price_s END) OVER (PARTITION BY category) AS price0
  FROM (SELECT category, scenario, sum(units_cal) AS units_s, sum(revenue_cal) AS revenue_s, avg(avg_price) AS price_s
        FROM scen GROUP BY category, scenario)"""
CTES["deltas"] = """
  SELECT *, pct_dq / pct_dp AS elasticity FROM
    (SELECT *, units_s - units0 AS delta_units, revenue_s - revenue0 AS delta_revenue,
       CASE WHEN units0 > 0 THEN (units_s - units0) / units0 END AS pct_dq,
       CASE WHEN price0 > 0 THEN (price_s - price0) / price0 END AS pct_dp FROM scen_totals WHERE scenario <> 0)"""


def scenario_runs(t):
    params = validation.calibration_params(validation.calibration_by_category(predictions(t, t.series)))
    runs = pricing.run_scenarios(t.series, price_predictor(t), calibration=params)
    return stage(runs, "scenarios")


@query(
    "g4_run_scenarios",
    f"""SELECT order_week, category, scenario, {rs(6, 'avg_price')}, {rs(4, 'units_base', 'units_cal')},
      {rs(1, 'revenue_base', 'revenue_cal')} FROM scen""",
)
def _(t):
    out = rounded(rounded(scenario_runs(t), 6, "avg_price"), 4, "units_base", "units_cal")
    return rounded(out, 1, "revenue_base", "revenue_cal")


@query(
    "g4_run_scenarios_model",
    f"""SELECT order_week, category, scenario, {r('avg_price_recent * (1 + scenario)', 7, 'avg_price')}, true AS predicted, true AS follows
    FROM recent, future_weeks, scenarios""",
)
def _(t):
    _, trees = ensemble(t)
    runs = pricing.run_scenarios(filled(t), trees, holidays=t.holidays)
    named = runs.withColumnsRenamed({"units_base": "units", "revenue_base": "revenue"})
    return consequences(named, "order_week", "category", "scenario")


_DELTAS = {
    "units_s": 3, "units0": 3, "revenue_s": 1, "revenue0": 1, "price_s": 6, "price0": 6, "delta_units": 3,
    "delta_revenue": 1, "pct_dQ": 6, "pct_dP": 6, "elasticity": 4,
}


def _round_all(df, digits):
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _sql_all(digits) -> str:
    return ", ".join(r(f'"{c}"', d) for c, d in digits.items())


@query("g5_scenario_deltas", f"SELECT category, scenario, {_sql_all(_DELTAS)} FROM deltas")
def _(t):
    return _round_all(pricing.scenario_deltas(scenario_runs(t)), _DELTAS)


@query(
    "g6_elasticity_leaderboard",
    f"""SELECT category, {rs(4, 'mean_abs_elasticity')} FROM (SELECT category, avg(abs(elasticity)) AS mean_abs_elasticity
      FROM deltas GROUP BY category ORDER BY mean_abs_elasticity DESC NULLS LAST, category LIMIT 20)""",
)
def _(t):
    board = pricing.elasticity_leaderboard(pricing.scenario_deltas(scenario_runs(t)))
    return rounded(board, 4, "mean_abs_elasticity")


def _best(view: str, where: str, order: str) -> None:
    sql = f"""SELECT category, scenario, {r('delta_revenue', 1, 'rev_lift')}, {r('abs(delta_revenue)', 1, 'rev_lift_abs')},
      {r('delta_units', 3, 'units_lift')}, {r('abs(delta_units)', 3, 'units_lift_abs')} FROM
      (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {order}, scenario) AS k FROM deltas WHERE {where})
      WHERE k = 1"""

    @query(f"g7_best_scenarios_{view}", sql)
    def _(t):
        best = pricing.best_scenarios(pricing.scenario_deltas(scenario_runs(t)), view)
        best = best.select("category", "scenario", "rev_lift", "rev_lift_abs", "units_lift", "units_lift_abs")
        return rounded(rounded(best, 1, "rev_lift", "rev_lift_abs"), 3, "units_lift", "units_lift_abs")


_best("abs", "delta_revenue IS NOT NULL", "abs(delta_revenue) DESC")
_best("gain", "delta_revenue > 0", "delta_revenue DESC")
_best("loss", "delta_revenue < 0", "delta_revenue")

CTES["recs"] = """
  SELECT b.category, CASE WHEN ok THEN scenario ELSE 0 END AS scenario, CASE WHEN ok THEN delta_revenue ELSE 0 END AS rev_lift,
    CASE WHEN ok THEN delta_units ELSE 0 END AS units_lift, revenue0, CASE WHEN ok THEN revenue_s END AS revenue, units0,
    CASE WHEN ok THEN units_s END AS units, price0, CASE WHEN ok THEN price_s END AS price,
    CASE WHEN ok THEN elasticity END AS elasticity, true AS within_10pct, true AS positive_lift, true AS recommended
  FROM (SELECT *, abs(scenario) <= 0.1 AND delta_revenue > 0 AS ok FROM
    (SELECT *, row_number() OVER (PARTITION BY category ORDER BY delta_revenue DESC NULLS LAST, scenario) AS k FROM deltas)
    WHERE k = 1) b"""
_RECS = {
    "rev_lift": 1, "units_lift": 3, "revenue0": 1, "revenue": 1, "units0": 3, "units": 3, "price0": 6, "price": 6,
    "elasticity": 4,
}


@query(
    "g8_recommend_prices",
    f"SELECT category, scenario, within_10pct, positive_lift, recommended, {_sql_all(_RECS)} FROM recs",
)
def _(t):
    return _round_all(pricing.recommend_prices(scenario_runs(t)), _RECS)


# Unit costs are known for all but every fifth brand.
CTES["costs"] = """
  SELECT category, avg(avg_price) AS approx_price, 0.65 * avg(avg_price) AS unit_cost FROM weekly
  WHERE CAST(regexp_extract(category, '([0-9]+)', 1) AS INTEGER) % 5 <> 0 GROUP BY category"""
CTES["costs_full"] = "SELECT category, avg(avg_price) AS approx_price, 0.65 * avg(avg_price) AS unit_cost FROM weekly GROUP BY category"
CTES["profits"] = """
  SELECT *, profit_best - profit0 AS profit_lift FROM
    (SELECT category, scenario, rev_lift, price0, units0, price_best, units_best, unit_cost,
       (price0 - unit_cost) * units0 AS profit0, (price_best - unit_cost) * units_best AS profit_best
     FROM (SELECT *, CASE WHEN scenario = 0 THEN price0 ELSE price END AS price_best,
             CASE WHEN scenario = 0 THEN units0 ELSE units END AS units_best FROM recs) JOIN costs USING (category))"""
CTES["profit_all"] = """
  SELECT *, (price_best - price0) / price0 AS price_change_pct,
    CASE WHEN units0 > 0 THEN (units_best - units0) / units0 END AS units_change_pct,
    CASE WHEN profit0 <> 0 THEN profit_lift / profit0 END AS profit_change_pct,
    CASE WHEN units0 > 0 THEN profit0 / units0 END AS margin0,
    CASE WHEN units_best > 0 THEN profit_best / units_best END AS margin_best FROM profits"""
CTES["profit_safe"] = """
  SELECT * FROM profit_all WHERE profit_lift > 0 AND units_change_pct >= -0.1 AND margin_best >= margin0"""


def approximate_prices(t):
    return t.series.groupBy("category").agg(F.avg("avg_price").alias("approx_price"))


def costs(t):
    """Costs are unknown for every fifth brand, so that profits meet missing ones."""
    known = approximate_prices(t).where(F.regexp_extract("category", r"(\d+)", 1).cast("int") % 5 != 0)
    return pricing.proxy_costs(known)


def profits(t, runs):
    return pricing.profit_recommendations(pricing.recommend_prices(runs), costs(t), pricing.scenario_deltas(runs))


_PROFIT = {
    "rev_lift": 1, "price0": 6, "units0": 3, "price_best": 6, "units_best": 3, "unit_cost": 8, "profit0": 1,
    "profit_best": 1, "profit_lift": 1,
}


@query("g9_profit_recommendations", f"SELECT category, scenario, {_sql_all(_PROFIT)} FROM profits")
def _(t):
    return _round_all(profits(t, scenario_runs(t)).select("category", "scenario", *_PROFIT), _PROFIT)


_METRICS = {
    "profit_lift": 1, "price_change_pct": 6, "units_change_pct": 6, "profit_change_pct": 6, "margin0": 4, "margin_best": 4,
}


def _guardrails(name: str, table: str, source: str) -> None:
    @query(f"g10_profit_guardrails_{name}", f"SELECT category, scenario, {_sql_all(_METRICS)} FROM {source}")
    def _(t):
        out = pricing.profit_guardrails(profits(t, scenario_runs(t)))[table]
        return _round_all(out.select("category", "scenario", *_METRICS), _METRICS)


_guardrails("all", "all_recommendations", "profit_all")
_guardrails("safe", "safe_top", "profit_safe")
_guardrails("risks", "biggest_risks", "(SELECT * FROM profit_all ORDER BY profit_lift, category LIMIT 20)")


@query("g11_margins_template", "SELECT DISTINCT category, 0.3::DOUBLE AS margin_rate FROM weekly")
def _(t):
    return pricing.margins_template(t.weekly)


@query("g12_proxy_costs", f"SELECT category, {rs(8, 'approx_price', 'unit_cost')} FROM costs_full")
def _(t):
    return rounded(pricing.proxy_costs(approximate_prices(t)), 8, "approx_price", "unit_cost")


# -- chart tables ------------------------------------------------------------------------------


@query(
    "h1_history_and_forecast",
    f"""SELECT order_week, category, kind, {rs(4, 'units')} FROM
      (SELECT order_week, category, units, 'history' AS kind FROM weekly
       UNION ALL BY NAME SELECT order_week, category, units, 'forecast' AS kind FROM flat_forecast)
    WHERE category IN (SELECT category FROM weekly GROUP BY category ORDER BY sum(revenue) DESC, category LIMIT 6)""",
)
def _(t):
    return rounded(views.history_and_forecast(t.series, flat_forecast(t)), 4, "units")


@query(
    "h2_validation_overlay",
    f"""WITH top AS (SELECT category, min(order_week) AS start FROM pred GROUP BY category ORDER BY sum(y) DESC, category LIMIT 12)
    SELECT category, order_week, kind, y, {rs(4, 'yhat')} FROM
      (SELECT category, order_week, 'context' AS kind, units AS y, CAST(NULL AS DOUBLE) AS yhat FROM
         (SELECT w.*, row_number() OVER (PARTITION BY w.category ORDER BY w.order_week DESC) AS k
          FROM weekly w JOIN top ON top.category = w.category WHERE w.order_week < start) WHERE k <= 26
       UNION ALL BY NAME SELECT category, order_week, 'validation' AS kind, y, yhat FROM pred SEMI JOIN top USING (category))""",
)
def _(t):
    pred = stage(predictions(t, t.series), "predictions")
    return rounded(views.validation_overlay(pred, t.series), 4, "yhat")


@query(
    "h3_calibrated_vs_base",
    f"""SELECT order_week, category, {rs(4, 'units', 'units_cal')} FROM calibrated
    WHERE category IN (SELECT category FROM fix_list ORDER BY "PriorityScore" DESC, category LIMIT 6)""",
)
def _(t):
    todo, pred = fix_list(t)
    cal = validation.apply_calibration(flat_forecast(t), validation.calibration_by_category(pred))
    return rounded(views.calibrated_vs_base(cal, todo), 4, "units", "units_cal")


_FIT = {"a": 2, "b": 5, "x_min": 3, "x_max": 3, "axis_max": 3}


@query(
    "h4_scatter_fit",
    f"""SELECT category, n, {_sql_all(_FIT)} FROM (SELECT category, count(*) AS n, regr_intercept(units_cal, units) AS a,
        regr_slope(units_cal, units) AS b, min(units) AS x_min, max(units) AS x_max,
        greatest(max(units), max(units_cal)) * 1.05 AS axis_max
      FROM calibrated GROUP BY category HAVING count(*) >= 3)""",
)
def _(t):
    points = calibrated_forecast(t).withColumnRenamed("units", "units_base")
    return _round_all(views.scatter_fit(points), _FIT)


@query(
    "h4_scatter_fit_params",
    f"""SELECT category, n, {_sql_all(_FIT)} FROM (SELECT f.category, count(*) AS n, max(offset_a) AS a, max(scale_b) AS b,
        min(units) AS x_min, max(units) AS x_max, greatest(max(units), max(units_cal)) * 1.05 AS axis_max
      FROM calibrated f GROUP BY f.category HAVING count(*) >= 3)""",
)
def _(t):
    cal = stage(validation.calibration_by_category(predictions(t, t.series)), "calibration")
    points = validation.apply_calibration(flat_forecast(t), cal).withColumnRenamed("units", "units_base")
    return _round_all(views.scatter_fit(points, validation.calibration_params(cal)), _FIT)


def _bars(measure: str, digits: int) -> None:
    sql = f"""SELECT scenario, category, {rs(digits, measure)} FROM
      (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY abs({measure}) DESC NULLS LAST, category) AS k FROM deltas)
      WHERE k <= 15"""

    @query(f"h5_scenario_bars_{measure}", sql)
    def _(t):
        return rounded(views.scenario_bars(pricing.scenario_deltas(scenario_runs(t)), measure), digits, measure)


_bars("delta_units", 3)
_bars("delta_revenue", 1)


def _top(measure: str, source: str, order: str = "DESC") -> str:
    return f'SELECT category, {r(f"{measure}", 1)} FROM (SELECT * FROM {source} ORDER BY {measure} {order} NULLS LAST, category LIMIT 15)'


@query("h6_top_rev_lifts", _top("rev_lift", "recs"))
def _(t):
    return rounded(views.top_bars(pricing.recommend_prices(scenario_runs(t)), "rev_lift"), 1, "rev_lift")


@query(
    "h6_biggest_risks",
    _top("profit_drop_abs", "(SELECT category, abs(least(profit_lift, 0)) AS profit_drop_abs FROM profits)"),
)
def _(t):
    return rounded(views.risk_bars(profits(t, scenario_runs(t))), 1, "profit_drop_abs")


@query("h6_safe_top", _top("profit_lift", "profit_safe"))
def _(t):
    safe = pricing.profit_guardrails(profits(t, scenario_runs(t)))["safe_top"]
    return rounded(views.top_bars(safe, "profit_lift"), 1, "profit_lift")


@query("h6_revenue_at_risk", _top('"Revenue_at_Risk"', "fix_list"))
def _(t):
    return rounded(views.top_bars(fix_list(t)[0], "Revenue_at_Risk"), 1, "Revenue_at_Risk")


@query("h6_priority", _top('"PriorityScore"', "fix_list"))
def _(t):
    return rounded(views.top_bars(fix_list(t)[0], "PriorityScore"), 1, "PriorityScore")


# Briefs: the wanted change is the recommended one, except every fourth brand asks for a
# change that was never run (+7 %), so that the nearest run is shown.
CTES["wanted"] = """
  SELECT category, profit0, profit_best, profit_lift, CASE WHEN b % 4 = 0 THEN 0.07 ELSE scenario END AS wanted FROM
    (SELECT *, CAST(regexp_extract(category, '([0-9]+)', 1) AS INTEGER) AS b FROM profits
     ORDER BY profit_lift DESC NULLS LAST, category LIMIT 20)"""
CTES["used"] = """
  SELECT category, scenario AS s_used, profit0, profit_best, profit_lift FROM
    (SELECT w.*, scenario, row_number() OVER (PARTITION BY w.category
       ORDER BY abs(scenario - wanted) <= 1e-8 + 1e-5 * abs(wanted) DESC, abs(scenario - wanted), scenario) AS k
     FROM wanted w, scenarios) WHERE k = 1"""
_BRIEF = {
    "price0": 6, "price1": 6, "price_change_pct": 6, "units0": 3, "units1": 3, "delta_units": 3, "rev0": 1, "rev1": 1,
    "delta_revenue": 1, "profit0": 1, "profit_best": 1, "profit_lift": 1,
}


def _briefed(t):
    runs = scenario_runs(t)
    number = F.regexp_extract("category", r"(\d+)", 1).cast("int")
    moves = profits(t, runs).withColumn("scenario", F.when(number % 4 == 0, 0.07).otherwise(F.col("scenario")))
    return stage(moves, "moves"), runs


@query(
    "h7_category_brief",
    f"""SELECT category, s_used, {_sql_all(_BRIEF)} FROM
      (SELECT u.*, z.price_s AS price0, p.price_s AS price1, (p.price_s - z.price_s) / z.price_s AS price_change_pct,
         z.units_s AS units0, p.units_s AS units1, p.units_s - z.units_s AS delta_units, z.revenue_s AS rev0,
         p.revenue_s AS rev1, p.revenue_s - z.revenue_s AS delta_revenue
       FROM used u JOIN scen_totals z ON z.category = u.category AND z.scenario = 0
       JOIN scen_totals p ON p.category = u.category AND p.scenario = s_used)""",
)
def _(t):
    return _round_all(views.category_brief(*_briefed(t)), _BRIEF)


@query(
    "h7_category_brief_series",
    f"""SELECT category, order_week, kind, {rs(4, 'units')} FROM (
      SELECT category, order_week, 'history' AS kind, units FROM
        (SELECT *, row_number() OVER (PARTITION BY category ORDER BY order_week DESC) AS k FROM weekly SEMI JOIN used USING (category))
        WHERE k <= 16
      UNION ALL BY NAME SELECT category, order_week, 'baseline' AS kind, units_cal AS units FROM scen SEMI JOIN used USING (category)
        WHERE scenario = 0
      UNION ALL BY NAME SELECT s.category, order_week, 'proposed' AS kind, units_cal AS units
        FROM scen s JOIN used u ON u.category = s.category AND s.scenario = u.s_used)""",
)
def _(t):
    moves, runs = _briefed(t)
    return rounded(views.category_brief_series(moves, runs, t.series), 4, "units")
