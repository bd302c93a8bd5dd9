"""Validation, rollups, pricing: rules, invariants and published number pairs."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from weekloom.operators import forecast, model, pricing, validation, views

MONDAY = date(2018, 9, 10)


def pred_frame(spark, data):
    rows = [(MONDAY + timedelta(days=7 * i), c, float(y), float(p)) for c, pairs in data.items() for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "order_week date, category string, y double, yhat double")


def test_metrics_and_degenerate_calibration(spark):
    pred = pred_frame(spark, {"a": [(10, 8), (20, 22), (30, 27)], "one": [(4, 6)], "flat": [(1, 5), (3, 5)], "zero": [(0, 1)]})
    row = validation.overall_metrics(pred).head()
    errors = [2, 2, 3, 2, 4, 2, 1]
    assert row.MAE == pytest.approx(sum(errors) / 7) and row.wMAPE == pytest.approx(16 / 68)
    assert row.Bias == pytest.approx((-2 + 2 - 3 + 2 + 4 + 2 + 1) / 7)
    cal = {r.category: (r.scale_b, r.offset_a) for r in validation.calibration_by_category(pred).collect()}
    assert cal["one"] == cal["flat"] == cal["zero"] == (1.0, 0.0)
    per = validation.metrics_by_category(pred)
    assert per.head().category == "zero"  # 1 / 1e-9
    assert [r.category for r in validation.worst_categories(per, "wmape", 2).collect()] == ["flat", "one"]
    assert validation.worst_categories(per, "under", 1).head().category == "a"
    with pytest.raises(ValueError):
        validation.training_metrics(pred, r2="other")


def test_calibration_is_floored_and_keeps_missing(spark):
    fc = spark.createDataFrame(
        [(MONDAY, "a", 2.0, 1.0, 2.0), (MONDAY, "b", 2.0, 3.0, 6.0), (MONDAY, "c", 2.0, None, None)],
        "order_week date, category string, avg_price double, units double, revenue double",
    )
    cal = spark.createDataFrame([("a", 1.0, -5.0), ("c", 1.0, 1.0)], "category string, scale_b double, offset_a double")
    got = {r.category: (r.units_cal, r.revenue_cal) for r in validation.apply_calibration(fc, cal).collect()}
    assert got == {"a": (0.0, 0.0), "b": (3.0, 6.0), "c": (None, None)}


def test_reconcile_errors(spark):
    base = spark.createDataFrame([("a", 1.0)], "category string, units double")
    cal = spark.createDataFrame([("a", 3.0), ("b", 4.0)], "category string, units_cal double")
    params = spark.createDataFrame([("a", 1.0, 2.0)], "Category string, A double, B double")
    assert validation.reconcile_base_cal(base=base, params=params).head().units_cal == 3.0
    got = validation.reconcile_base_cal(cal=cal.where("category = 'a'"), params=params).head()
    assert got.units_base == 1.0
    for bad in (dict(), dict(base=base), dict(cal=cal, params=params.drop("B")), dict(base=base.drop("category"), cal=cal)):
        with pytest.raises(ValueError):
            validation.reconcile_base_cal(**bad)
    with pytest.raises(Exception, match="no calibration params"):
        validation.reconcile_base_cal(cal=cal, params=params).collect()


def small_unified(spark):
    def fc(values, name):
        return spark.createDataFrame([(MONDAY + timedelta(days=7 * w), c, 2.0, u) for w, c, u in values], f"order_week date, category string, avg_price double, {name} double")

    base = fc([(0, "a", 1.0), (1, "a", 2.0), (0, "b", 3.0)], "units")
    cal = fc([(0, "a", 1.5), (1, "a", 2.5), (0, "c", 4.0)], "units_cal")
    plan = fc([(0, "a", 3.0)], "plan_price").drop("avg_price")
    return forecast.unify_forecasts(base, cal, plan)


def test_unify_rollups_and_checks(spark):
    unified = small_unified(spark)
    got = {(r.order_week, r.category): r for r in unified.collect()}
    assert got[MONDAY, "a"].revenue_cal_price == 4.5 and got[MONDAY, "b"].units_cal is None
    assert got[MONDAY, "c"].price_for_revenue is None
    rollups = forecast.forecast_rollups(unified)
    total = {r.metric: (r.value, r.delta_vs_base) for r in forecast.rollup_grain(rollups, "total").collect()}
    assert total["units_base"] == (6.0, None) and total["units_cal"] == (8.0, 2.0)
    by_week = forecast.rollup_grain(rollups, "week").agg(F.sum("revenue_cal")).head()[0]
    assert by_week == total["revenue_cal"][0]
    checks = {r.check: r.violations for r in forecast.qa_checks(unified, rollups).collect()}
    assert checks["duplicate_keys"] == 0 and checks["nulls_units_cal"] == 1 and checks["rollup_week_units"] == 0
    with pytest.raises(AssertionError, match="nulls_units_cal=1"):
        forecast.require_quality(forecast.qa_checks(unified, rollups))
    twice = unified.unionAll(unified.where("category = 'a'"))
    checks = {r.check: r.violations for r in forecast.qa_checks(twice, rollups).collect()}
    assert checks["duplicate_keys"] == 2 and checks["rollup_week_category_units"] == 1 and checks["rollup_week_revenue"] == 1
    complete = unified.dropna(subset=["units_base", "units_cal"])
    forecast.require_quality(forecast.qa_checks(complete, forecast.forecast_rollups(complete)))
    with pytest.raises(ValueError):
        forecast.qa_checks(unified.drop("category"), rollups)
    bare = forecast.unify_forecasts(spark.createDataFrame([(MONDAY, "a", 1.0)], "order_week date, category string, units double"))
    assert bare.head().price_for_revenue is None and bare.head().units_base == 1.0


def brute_budget(items, share, most):
    budget = share * sum(c for *_, c in items)
    spent, picked = 0.0, []
    for name, pct, margin, cost in sorted(items, key=lambda i: (-i[2], i[0])):
        if len(picked) < most and spent + cost <= budget:
            picked.append(name)
            spent += cost
    return picked


@pytest.mark.parametrize("seed,most", [(1, 4), (2, 10), (3, 12)])
def test_budget_choice_against_brute_force(spark, seed, most):
    rng = random.Random(seed)
    items = []
    for i in range(40):
        pct = rng.choice([-0.2, -0.1, 0.0, 0.05, 0.1])
        items.append((f"c{i:02d}", pct, float(rng.choice([0, 5, 10, rng.randint(0, 50)])), abs(pct) * (100.0 + i)))
    acts = spark.createDataFrame([(n, p, m) for n, p, m, _ in items], "category string, recommended_pct double, best_delta_margin double")
    revenue = spark.createDataFrame([(n, 100.0 + i) for i, (n, *_) in enumerate(items)], "category string, base_revenue double")
    got = pricing.select_within_budget(acts, revenue, max_actions=most)
    assert [r.category for r in got.collect()] == brute_budget(items, 0.3, most)
    paid = [r.category for r in pricing.select_within_budget(acts, revenue, max_actions=most, skip_free=True).collect()]
    budget_items = [i for i in items if i[3] > 0]
    assert paid == brute_budget(budget_items, 0.3, most)
    region = (F.substring("category", 3, 1).cast("int") % 3).alias("region")
    by = pricing.select_within_budget(
        acts.select("*", region), revenue.select("*", region), max_actions=3, by=["region"]
    )
    picked = {}
    for r in by.collect():
        picked.setdefault(r.region, []).append(r.category)
    assert picked == {g: brute_budget([i for i in items if int(i[0][2]) % 3 == g], 0.3, 3) for g in range(3)}


def test_actions_prefer_the_smallest_change_on_ties(spark):
    valid = spark.createDataFrame([("a", 10.0, 10.0), ("b", 0.0, 0.0)], "category string, avg_price double, avg_price_lag1 double")
    lines = spark.createDataFrame([("a", 30.0, -1.0), ("b", 5.0, 0.0)], "category string, a double, b double")
    predictor = model.LinearPredictor(lines, "avg_price")
    best = {r.category: r for r in pricing.recommend_actions(valid, predictor).collect()}
    # a: revenue p * (30 - p) grows up to p = 15; b: no price, every change gains nothing
    assert best["a"].recommended_pct == 0.10 and best["b"].recommended_pct == -0.20
    assert best["a"].best_delta_margin == pytest.approx(0.3 * (11 * 19 - 10 * 20))
    none = pricing.score_price_changes(valid, predictor, [-0.1], categories=["b"])
    assert pricing.what_if_summary(none).head().delta_revenue == 0.0


def scenario_frame(spark, effect):
    rows = []
    for c, by in effect.items():
        for s, (units, price) in by.items():
            rows += [(MONDAY + timedelta(days=7 * w), c, s, price, units, units * price) for w in range(2)]
    return spark.createDataFrame(
        rows, "order_week date, category string, scenario double, avg_price double, units_cal double, revenue_cal double"
    )


def test_price_recommendations_and_profit(spark):
    scen = scenario_frame(
        spark,
        {
            "up": {0.0: (10.0, 10.0), 0.1: (10.0, 11.0), -0.1: (10.0, 9.0)},
            "far": {0.0: (10.0, 10.0), 0.15: (10.0, 11.5), 0.1: (10.0, 11.0)},
            "down": {0.0: (10.0, 10.0), 0.1: (8.0, 11.0)},
            "tie": {0.0: (10.0, 10.0), -0.05: (12.0, 9.5), 0.05: (114 / 10.5, 10.5)},
            "lost": {0.1: (10.0, 11.0)},
            "still": {0.0: (5.0, 4.0)},
        },
    )
    deltas = pricing.scenario_deltas(scen)
    assert deltas.where("category = 'lost'").head().delta_units is None
    up = deltas.where("category = 'up' AND scenario = 0.1").head()
    assert up.elasticity == 0.0 and up.pct_dP == pytest.approx(0.1) and up.delta_revenue == pytest.approx(20.0)
    recs = {r.category: r for r in pricing.recommend_prices(scen).collect()}
    assert {c: r.scenario for c, r in recs.items()} == {"up": 0.1, "far": 0.0, "down": 0.0, "tie": recs["tie"].scenario, "still": 0.0}
    assert recs["down"].price is None and recs["down"].rev_lift == 0.0 and all(r.recommended for r in recs.values())
    costs = pricing.proxy_costs(spark.createDataFrame([("up", 10.0), ("far", 10.0), ("down", None)], "category string, approx_price double"))
    profit = {r.category: r for r in pricing.profit_recommendations(pricing.recommend_prices(scen), costs, deltas).collect()}
    assert set(profit) == {"up", "far"}
    assert profit["far"].profit_lift == 0.0 and profit["up"].profit_lift == pytest.approx(20.0)
    tables = pricing.profit_guardrails(pricing.profit_recommendations(pricing.recommend_prices(scen), costs, deltas))
    assert [r.category for r in tables["safe_top"].collect()] == ["up"]
    assert [r.category for r in tables["biggest_risks"].collect()] == ["far", "up"]
    board = pricing.elasticity_leaderboard(deltas)
    assert board.head().mean_abs_elasticity >= board.collect()[1].mean_abs_elasticity
    with pytest.raises(ValueError):
        pricing.profit_recommendations(pricing.recommend_prices(scen), costs)
    with pytest.raises(ValueError):
        pricing.profit_recommendations(pricing.recommend_prices(scen), costs.drop("unit_cost"), deltas)


def test_brief_uses_the_nearest_run(spark):
    scen = scenario_frame(spark, {"a": {0.0: (10.0, 10.0), 0.1: (9.0, 11.0), 0.05: (9.5, 10.5)}, "b": {0.1: (1.0, 1.0)}})
    safe = spark.createDataFrame(
        [("a", 0.08, 1.0, 2.0, 1.0), ("b", 0.1, 1.0, 2.0, 9.0)],
        "category string, scenario double, profit0 double, profit_best double, profit_lift double",
    )
    brief = views.category_brief(safe, scen).collect()
    assert [(r.category, r.s_used, r.units0, r.units1) for r in brief] == [("a", 0.1, 20.0, 18.0)]
    history = spark.createDataFrame([(MONDAY - timedelta(days=7 * i), "a", 1.0) for i in range(30)], "order_week date, category string, units double")
    series = views.category_brief_series(safe, scen, history)
    assert {r.kind: r["count"] for r in series.groupBy("kind").count().collect()} == {"history": 16, "baseline": 2, "proposed": 2}


# Fixed values below: rows of published result tables that belong together.


def test_published_validation_actions(spark):
    per = spark.createDataFrame(
        [("bed_bath_table", 7, 214.20799, 1053.0, 30.60114143, -15.20871857, 1053.0, 0.203426391),
         ("health_beauty", 8, 195.33339, 1433.0, 24.41667375, -10.86273625, 1433.0, 0.136310809),
         ("computers", 5, 6.4534162, 16.0, 1.29068324, 0.40944172, 16.0, 0.403338512)],
        "category string, n long, sum_abs_err double, sum_abs_y double, MAE double, Bias double, Actual_sum double, wMAPE double",
    )
    prices = {"bed_bath_table": 92.55654177, "health_beauty": 131.202935, "computers": 975.6783757}
    lines = {"bed_bath_table": (1.648621278, -72.49775519), "health_beauty": (1.482051688, -70.24837208), "computers": (1.010791723, -0.448393813)}
    # two points on each category's published line
    pred = pred_frame(spark, {c: [(a + b * x, x) for x in (100.0, 200.0)] for c, (b, a) in lines.items()})
    history = spark.createDataFrame([(MONDAY, c, p) for c, p in prices.items()], "order_week date, category string, avg_price double")
    got = validation.validation_actions(per, pred, history).collect()
    assert [r.category for r in got] == ["bed_bath_table", "health_beauty", "computers"]
    by = {r.category: r for r in got}
    assert by["bed_bath_table"].Revenue_at_Risk == pytest.approx(19826.35077)
    assert by["health_beauty"].Revenue_at_Risk == pytest.approx(25628.31407)
    assert by["computers"].PriorityScore == pytest.approx(6.453416192)
    assert by["bed_bath_table"].Recommendation == "Underpredict by 15.2 u; try scale x1.65 or add -72.5"
    assert by["computers"].Recommendation == "OK; keep global calibration (x1.01, +-0.4)"


def test_published_calibration_impact(spark):
    published = {  # base units, scale, offset, calibrated units
        "bed_bath_table": (578.497788, 1.648621278, -72.49775519, 373.741721052733),
        "health_beauty": (612.627063, 1.482051688, -70.24837208, 345.9579961936324),
        "computers": (27.8996783, 1.010791723, -0.448393813, 24.613613396002712),
    }
    fc = spark.createDataFrame(
        [(MONDAY + timedelta(days=7 * w), c, 1.0, v[0] / 8, v[0] / 8) for c, v in published.items() for w in range(8)],
        "order_week date, category string, avg_price double, units double, revenue double",
    )
    cal = spark.createDataFrame([(c, v[1], v[2]) for c, v in published.items()], "category string, scale_b double, offset_a double")
    impact = validation.calibration_impact(validation.apply_calibration(fc, cal))
    for r in impact.collect():
        assert r.cal_units == pytest.approx(published[r.category][3], rel=1e-6)


def test_published_profit(spark):
    published = {  # units0, units_s, price0, price_s, approx_price, profit0, profit_best, profit_lift
        "construction_tools_construction": (281.449947, 285.20483, 140.1240136, 154.1364149, 91.08060884 / 0.65, 13803.26367, 17983.82045, 4180.556777),
        "home_appliances_2": (42.2515415, 42.601116, 530.6721667, 583.7393833, 344.9369084 / 0.65, 7847.600976, 10173.25194, 2325.65096),
        "home_confort": (60.3042572, 58.248848, 123.2236875, 135.5460563, 80.09539688 / 0.65, 2600.81953, 3229.937032, 629.1175019),
    }
    recs = spark.createDataFrame([(c, 0.1, v[0], v[2]) for c, v in published.items()], "product_category_name_english string, scenario double, units0 double, price0 double")
    deltas = spark.createDataFrame([(c, 0.1, v[3], v[1]) for c, v in published.items()], "category string, scenario double, price_s double, units_s double")
    costs = pricing.proxy_costs(spark.createDataFrame([(c, v[4]) for c, v in published.items()], "product_category_name_english string, approx_price double"))
    for r in pricing.profit_recommendations(recs, costs, deltas).collect():
        want = published[r.category]
        assert (r.profit0, r.profit_best, r.profit_lift) == pytest.approx(want[5:], rel=1e-6)


def test_published_rollup_summary(spark):
    units = [1343.2202369, 1277.03907368, 1034.78712212, 1092.15670469, 1029.61724759, 923.77601706, 935.00820172, 919.46042272]
    revenue = [155319.44594903453, 146649.40752312765, 120229.06728245287, 128254.8212928955, 120731.3986677306, 110082.10832039423, 111643.8433602011, 110931.41333785478]
    unified = spark.createDataFrame(
        [(MONDAY + timedelta(days=7 * i), "all", u, u, m, m) for i, (u, m) in enumerate(zip(units, revenue))],
        "order_week date, category string, units_base double, units_cal double, revenue_base_price double, revenue_cal_price double",
    )
    total = {r.metric: r.value for r in forecast.rollup_grain(forecast.forecast_rollups(unified), "total").collect()}
    assert total["units_base"] == pytest.approx(8555.065026479999) and total["revenue_base"] == pytest.approx(1003841.5057336914)
