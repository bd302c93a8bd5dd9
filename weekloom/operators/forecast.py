"""Price plans, multi-step forecasts, their rollups and checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekloom.functions.columns import mean_of, name_key, number, season
from weekloom.functions.grouped import one_row, ranked_within, top_k
from weekloom.operators.features import CATEGORY, LAGGED, LAGS, ROLLED, WEEK, holiday_flag
from weekloom.operators.model import ExpressionPredictor, Predictor
from weekloom.session import stage
from weekloom.sources.schemas import PRICE_CHANGE_COLUMNS
from weekloom.sources.tables import standardize_columns

HORIZON = 8
RECENT = 4
MARGIN_RATE = 0.30


def recent_mean(df: DataFrame, cols: Sequence[str] = ("avg_price", "rev_count", "rev_score_avg"), n: int = RECENT) -> DataFrame:
    """Mean of the last ``n`` rows of each category."""
    last = ranked_within(df.select(CATEGORY, WEEK, *cols), [CATEGORY], [F.desc(WEEK)], n)
    return last.groupBy(CATEGORY).agg(*[F.avg(c).alias(f"{c}_recent") for c in cols])


def future_weeks(history: DataFrame, horizon: int = HORIZON) -> Column:
    """Array of the ``horizon`` Mondays after the last week of the whole history."""
    last = history.agg(F.max(WEEK)).scalar()
    return F.sequence(F.date_add(last, 7), F.date_add(last, 7 * horizon), F.expr("interval 7 days"))


def future_grid(history: DataFrame, horizon: int = HORIZON) -> DataFrame:
    return history.select(CATEGORY).distinct().select(
        F.explode(future_weeks(history, horizon)).alias(WEEK), CATEGORY
    )


def _price_actions(actions: DataFrame) -> DataFrame:
    """cat_key and applied_pct; if any value exceeds 1 in size, all are percentages."""
    std = standardize_columns(actions, {CATEGORY: ["category", "product_category_name_english"]})
    pct_col = next((c for c in PRICE_CHANGE_COLUMNS if c in std.columns), None)
    pct = F.lit(0.0) if pct_col is None else F.col(pct_col).cast("double")
    keyed = std.select(name_key(CATEGORY).alias("cat_key"), pct.alias("pct"))
    in_percent = keyed.agg(F.coalesce(F.max(F.abs("pct")) > 1.0, F.lit(False))).scalar()
    return keyed.select("cat_key", (F.col("pct") / F.when(in_percent, 100.0).otherwise(1.0)).alias("applied_pct"))


def price_plan(history: DataFrame, actions: DataFrame | None = None, horizon: int = HORIZON) -> DataFrame:
    """Planned price of each category and future week: recent mean price, changed as chosen."""
    prices = recent_mean(history, ["avg_price"]).select(
        CATEGORY, name_key(CATEGORY).alias("cat_key"), F.col("avg_price_recent").alias("base_price")
    )
    if actions is None:
        planned = prices.withColumn("applied_pct", F.lit(0.0))
    else:
        planned = prices.join(_price_actions(actions), "cat_key", "left").withColumn(
            "applied_pct", F.coalesce("applied_pct", F.lit(0.0))
        )
    return planned.select(
        F.explode(future_weeks(history, horizon)).alias(WEEK),
        CATEGORY,
        "cat_key",
        "base_price",
        "applied_pct",
        (F.col("base_price") * (1 + F.col("applied_pct"))).alias("planned_price"),
    )


def price_plan_diagnostics(plan: DataFrame) -> DataFrame:
    per = plan.groupBy(CATEGORY).agg(*[F.max(c).alias(c) for c in ("base_price", "applied_pct", "planned_price")])
    return per.withColumn("changed", F.when(F.abs("applied_pct") > 1e-9, "yes").otherwise("no"))


@dataclass
class FeaturePolicy:
    """How the features of a future week are made.

    include_current: the rolling means were trained with the current row, which is unknown in
    a future week, so one known row less goes in. revenue_proxy: the model wants current
    revenue; it is price times units of the week before (else the rolling mean, else zero).
    """

    include_current: bool = False
    revenue_proxy: bool = False
    lags: tuple[int, ...] = LAGS
    roll: int = 4


def series_state(history: DataFrame, keep: int) -> DataFrame:
    """One row per category: the last ``keep`` weeks of each column as arrays, oldest first.

    Bounded by the longest lag, whatever the length of the history.
    """
    cols = [WEEK, *LAGGED]
    indexed = history if "week_idx" in history.columns else history.withColumn(
        "week_idx", F.row_number().over(W.partitionBy(CATEGORY).orderBy(WEEK)) - 1
    )
    last = ranked_within(indexed.select(CATEGORY, "week_idx", *cols), [CATEGORY], [F.desc(WEEK)], keep)
    rows = last.groupBy(CATEGORY).agg(
        F.sort_array(F.collect_list(F.struct(*cols))).alias("rows"), F.max("week_idx").alias("last_idx")
    )
    out = rows.select(
        CATEGORY, "last_idx", *[F.col("rows").getField(c).cast("array<double>").alias(f"h_{c}") for c in LAGGED]
    )
    recents = {
        f"{c}_recent": mean_of([F.try_element_at(f"h_{c}", F.lit(-i)) for i in range(1, RECENT + 1)])
        for c in ("rev_count", "rev_score_avg")
    }
    return out.withColumns(recents)


def _step_features(
    now: Column, history: Callable[[str], Column], step: Column, policy: FeaturePolicy
) -> dict[str, Column]:
    """Features of the planned week ``now``, given the arrays of known and predicted values."""
    known = policy.roll - 1 if policy.include_current else policy.roll
    features: dict[str, Column] = {
        WEEK: now.getField("week"),
        "avg_price": now.getField("price"),
        "is_holiday_week": now.getField("holiday"),
        "rev_count": F.col("rev_count_recent"),
        "rev_score_avg": F.col("rev_score_avg_recent"),
        "week_idx": F.col("last_idx") + step,
        **season(now.getField("week")),
    }
    for c in LAGGED:
        for lag in policy.lags:
            features[f"{c}_lag{lag}"] = F.try_element_at(history(c), F.lit(-lag))
    for c in ROLLED:
        last = [F.try_element_at(history(c), F.lit(-i)) for i in range(1, known + 1)]
        features[f"{c}_roll{policy.roll}"] = mean_of(last)
    if policy.revenue_proxy:
        units = F.coalesce(features["units_lag1"], features[f"units_roll{policy.roll}"], F.lit(0.0))
        features["revenue"] = features["avg_price"] * units
    return features


_DONE = "array<struct<week:date,price:double,units:double>>"


def _advance(features: dict[str, Column], units: Column, history: Callable[[str], Column], done: Column) -> dict[str, Column]:
    """The arrays after a step: the planned week joins the history with its predicted units."""
    price = features["avg_price"]
    latest = {**{c: features[c] for c in LAGGED if c not in ROLLED}, "units": units, "revenue": price * units}
    row = F.struct(features[WEEK].alias("week"), price.alias("price"), units.alias("units"))
    arrays = {f"h_{c}": F.array_append(history(c), latest[c].cast("double")) for c in LAGGED}
    return {**arrays, "done": F.array_append(done, row)}


def _fold(state: DataFrame, predictor: ExpressionPredictor, policy: FeaturePolicy) -> DataFrame:
    """All steps inside one expression per series: a fold over the planned weeks."""
    start = F.struct(*[F.col(f"h_{c}") for c in LAGGED], F.array().cast(_DONE).alias("done"))

    def step(acc: Column, now: Column) -> Column:
        def history(c: str) -> Column:
            return acc.getField(f"h_{c}")

        features = _step_features(now, history, F.size(acc.getField("done")) + 1, policy)
        units = predictor.expression(features).cast("double")

        def after(units: Column) -> Column:
            return F.struct(*[value.alias(name) for name, value in _advance(features, units, history, acc.getField("done")).items()])

        # the prediction is bound once; the state holds it in several places
        return F.element_at(F.transform(F.array(units), after), 1)

    return state.withColumn("done", F.aggregate("plan", start, step, lambda acc: acc.getField("done")))


def _iterate(state: DataFrame, predictor: Predictor, policy: FeaturePolicy, horizon: int) -> DataFrame:
    """One job per step over one row per series; each state is written, so plans stay short."""
    carried = [c for c in state.columns if not c.startswith("h_")]

    def history(c: str) -> Column:
        return F.col(f"h_{c}")

    state = state.withColumn("done", F.array().cast(_DONE))
    # The step number comes from the state, so all steps share one compiled plan.
    now, step = F.get("plan", F.size("done")), F.size("done") + 1
    features = _step_features(now, history, step, policy)
    for _ in range(horizon):
        scored = predictor.predict(state.withColumns(features))
        after = _advance({c: F.col(c) for c in features}, F.col("prediction"), history, F.col("done"))
        state = stage(scored.select(*carried, *[value.alias(name) for name, value in after.items()]), "forecast-state")
    return state


def recursive_forecast(
    history: DataFrame,
    plan: DataFrame | None,
    predictor: Predictor,
    policy: FeaturePolicy | None = None,
    horizon: int = HORIZON,
    price_col: str = "planned_price",
    by: Sequence[str] = (),
    holidays: DataFrame | None = None,
    any_day: bool = False,
) -> DataFrame:
    """Predict ``horizon`` weeks, each step feeding its prediction to the next one's lags.

    Every series of the history gets exactly the ``horizon`` weeks after the last one of the whole
    history. A week's price is the planned one, else the mean of the category's last weeks; so the
    plan may lack weeks or categories, or be None. With ``by``, each category has the series that
    its plan rows name. Plan weeks outside the horizon play no part. ``any_day`` as in holiday_flag.

    The state is one row per series (category and ``by`` columns of the plan): after one
    shuffle by category the steps move no data, and all scenarios advance together.
    Predictors that are a column expression (lines, means, trees as a node table) run all steps in one pass and write
    nothing; fitted pipelines run one small job per step. Returns order_week, category, ``by``, avg_price, units, revenue.
    """
    policy = policy or FeaturePolicy()
    keys = [CATEGORY, *by]
    series = plan.select(*keys).distinct() if by else history.select(CATEGORY).distinct()
    weeks = series.select(*keys, F.explode(future_weeks(history, horizon)).alias(WEEK))
    usual = recent_mean(history, ["avg_price"]).withColumnRenamed("avg_price_recent", "price_recent")
    weeks = weeks.join(usual, CATEGORY, "left")
    if plan is None:
        weeks = weeks.withColumn("price", F.col("price_recent"))
    else:
        planned = plan.groupBy(WEEK, *keys).agg(F.max(price_col).alias("price_planned"))
        weeks = weeks.join(planned, [WEEK, *keys], "left").withColumn("price", F.coalesce("price_planned", "price_recent"))
    if holidays is None:
        weeks = weeks.withColumn("holiday", F.lit(0))
    else:
        weeks = holiday_flag(weeks, holidays, any_day).withColumnRenamed("is_holiday_week", "holiday")
    in_order = F.sort_array(F.collect_list(F.struct(F.col(WEEK).alias("week"), "price", "holiday")))
    plans = weeks.groupBy(*keys).agg(in_order.alias("plan"))
    state = predictor.attach(series_state(history, max(policy.lags)).join(plans, CATEGORY))
    if isinstance(predictor, ExpressionPredictor):
        state = _fold(state, predictor, policy)
    else:
        state = _iterate(state, predictor, policy, horizon)
    return state.select(*keys, F.inline("done")).select(
        F.col("week").alias(WEEK),
        *keys,
        F.col("price").alias("avg_price"),
        "units",
        (F.col("price") * F.col("units")).alias("revenue"),
    )


def plan_impact(plan_forecast: DataFrame, valid_scored: DataFrame, margins: DataFrame | None = None) -> DataFrame:
    """Planned horizon against as many average validation weeks, per category.

    ``valid_scored`` has category, avg_price and prediction.
    """
    plan = plan_forecast.groupBy(CATEGORY).agg(
        F.sum("units").alias("plan_units"), F.sum("revenue").alias("plan_revenue")
    )
    weeks = plan_forecast.agg(F.countDistinct(WEEK)).scalar()
    base = valid_scored.groupBy(CATEGORY).agg(
        F.avg("prediction").alias("units_week"), F.avg(F.col("avg_price") * F.col("prediction")).alias("revenue_week")
    )
    base = base.select(
        CATEGORY,
        (F.col("units_week") * weeks).alias("base_units"),
        (F.col("revenue_week") * weeks).alias("base_revenue"),
    )
    impact = with_margin(plan.join(base, CATEGORY, "left"), margins)
    return impact.withColumns(
        {
            "delta_units": F.col("plan_units") - F.col("base_units"),
            "delta_revenue": F.col("plan_revenue") - F.col("base_revenue"),
            "delta_margin": (F.col("plan_revenue") - F.col("base_revenue")) * F.col("margin_rate"),
        }
    ).orderBy(F.desc_nulls_last("delta_margin"), CATEGORY)


def with_margin(df: DataFrame, margins: DataFrame | None, default: float = MARGIN_RATE) -> DataFrame:
    """Add margin_rate: the category's own, else the default."""
    if margins is None:
        return df.withColumn("margin_rate", F.lit(default))
    rates = margins.select(CATEGORY, F.col("margin_rate").cast("double").alias("margin_rate"))
    return df.join(rates, CATEGORY, "left").withColumn("margin_rate", F.coalesce("margin_rate", F.lit(default)))


def impact_totals(impact: DataFrame) -> DataFrame:
    return impact.agg(*[F.sum(c).alias(c) for c in ("delta_units", "delta_revenue", "delta_margin")])


def unify_forecasts(base: DataFrame, cal: DataFrame | None = None, plan: DataFrame | None = None) -> DataFrame:
    """Base, calibrated and planned values of each week and category in one row.

    Revenue is at the planned price, or the forecast's own price where nothing is planned.
    """
    keys = [WEEK, CATEGORY]
    price = number("avg_price") if "avg_price" in base.columns else F.lit(None).cast("double")
    out = base.select(*keys, price.alias("avg_price"), number("units").alias("units_base"))
    if cal is None:
        out = out.withColumn("units_cal", F.lit(None).cast("double"))
    else:
        out = out.join(cal.select(*keys, number("units_cal").alias("units_cal")), keys, "outer")
    if plan is None:
        out = out.withColumn("planned_price", F.lit(None).cast("double"))
    else:
        planned = standardize_columns(plan, {"planned_price": ["planned_price", "plan_price"]})
        out = out.join(planned.select(*keys, number("planned_price").alias("planned_price")), keys, "left")
    out = out.withColumn("price_for_revenue", F.coalesce("planned_price", "avg_price"))
    return out.select(
        *keys, "avg_price", "planned_price", "price_for_revenue", "units_base", "units_cal",
        (F.col("price_for_revenue") * F.col("units_base")).alias("revenue_base_price"),
        (F.col("price_for_revenue") * F.col("units_cal")).alias("revenue_cal_price"),
    )


_TOTALS = {
    "units_base": "units_base",
    "units_cal": "units_cal",
    "revenue_base": "revenue_base_price",
    "revenue_cal": "revenue_cal_price",
}


def forecast_rollups(unified: DataFrame) -> DataFrame:
    """Totals by week and category, by week, and overall, told apart by column ``grain``."""
    totals = unified.groupingSets(
        [[F.col(WEEK), F.col(CATEGORY)], [F.col(WEEK)], []], F.col(WEEK), F.col(CATEGORY)
    ).agg(
        F.grouping_id().alias("_g"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(name) for name, c in _TOTALS.items()],
    )
    grain = F.when(F.col("_g") == 0, "week_category").when(F.col("_g") == 1, "week").otherwise("total")
    return totals.select(grain.alias("grain"), WEEK, CATEGORY, *_TOTALS)


def rollup_grain(rollups: DataFrame, grain: str) -> DataFrame:
    """One of the three tables of forecast_rollups; "total" in long form with delta_vs_base."""
    rows = rollups.where(F.col("grain") == grain)
    if grain == "week_category":
        return rows.drop("grain")
    if grain == "week":
        return rows.drop("grain", CATEGORY)
    if grain != "total":
        raise ValueError(f"unknown grain: {grain}")
    bases = {"units_cal": "units_base", "revenue_cal": "revenue_base"}
    lines = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(m).alias("value"),
            (F.col(m) - F.col(bases[m]) if m in bases else F.lit(None).cast("double")).alias("delta_vs_base"),
        )
        for m in _TOTALS
    ]
    return rows.select(F.inline(F.array(*lines)))


def qa_checks(unified: DataFrame, rollups: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Table (check, violations): duplicate keys, missing columns, nulls, rollups that differ."""
    spark = unified.sparkSession
    keys = [WEEK, CATEGORY]
    absent = [c for c in keys if c not in unified.columns]
    if absent:
        raise ValueError(f"unified forecast lacks key columns {absent}")
    numeric = [
        c
        for c in ("price_for_revenue", "units_base", "units_cal", "revenue_base_price", "revenue_cal_price")
        if c in unified.columns
    ]
    nulls = one_row(unified.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in numeric]))
    duplicates = unified.groupBy(*keys).agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    checks = {"duplicate_keys": duplicates, "missing_columns": F.lit(0)}
    checks |= {f"nulls_{c}": nulls.getField(c) for c in numeric}
    for grain, by in (("week_category", keys), ("week", [WEEK])):
        saved = rollup_grain(rollups, grain).select(*by, F.col("units_cal").alias("u1"), F.col("revenue_cal").alias("r1"))
        again = unified.groupBy(*by).agg(F.sum("units_cal").alias("u2"), F.sum("revenue_cal_price").alias("r2"))
        zero = F.lit(0.0)
        gaps = [
            F.sum(F.abs(F.coalesce(a, zero) - F.coalesce(b, zero))) >= tolerance for a, b in (("u1", "u2"), ("r1", "r2"))
        ]
        gap = saved.join(again, by, "outer").agg(
            *[F.coalesce(g.cast("bigint"), F.lit(0)).alias(n) for g, n in zip(gaps, ("u", "r"))]
        )
        differs = one_row(gap)
        checks[f"rollup_{grain}_units"] = differs.getField("u")
        checks[f"rollup_{grain}_revenue"] = differs.getField("r")
    lines = [
        F.struct(F.lit(name).alias("check"), value.cast("bigint").alias("violations")) for name, value in checks.items()
    ]
    return spark.range(1).select(F.inline(F.array(*lines)))


def require_quality(checks: DataFrame) -> None:
    """Raise if any check found violations (at most a dozen rows come to the driver)."""
    failed = [f"{r.check}={r.violations}" for r in checks.where("violations > 0").collect()]
    if failed:
        raise AssertionError("forecast quality checks failed: " + ", ".join(failed))


def kpi_by_category(unified: DataFrame) -> DataFrame:
    per = unified.groupBy(CATEGORY).agg(
        F.sum("revenue_cal_price").alias("rev_8w"), F.sum("units_cal").alias("units_8w")
    )
    return per.orderBy(F.desc_nulls_last("rev_8w"), CATEGORY)


def kpi_totals(unified: DataFrame) -> DataFrame:
    return unified.agg(
        F.coalesce(F.sum("units_cal"), F.lit(0.0)).alias("total_units_8w"),
        F.coalesce(F.sum("revenue_cal_price"), F.lit(0.0)).alias("total_revenue_8w"),
    )


def kpi_top_categories(unified: DataFrame, k: int = 10) -> DataFrame:
    return top_k(kpi_by_category(unified), [F.desc_nulls_last("rev_8w"), F.asc(CATEGORY)], k)
