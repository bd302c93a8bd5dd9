"""Price what-ifs, scenario runs, elasticities and price recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekloom.functions.columns import guarded, money_sum, scenario_key
from weekloom.functions.grouped import ranked_within, top_k
from weekloom.operators.features import CATEGORY, WEEK
from weekloom.operators.forecast import (
    HORIZON,
    MARGIN_RATE,
    FeaturePolicy,
    future_weeks,
    recent_mean,
    recursive_forecast,
    with_margin,
)
from weekloom.operators.model import Predictor
from weekloom.session import stage
from weekloom.sources.schemas import RECOMMENDATION_ALIASES
from weekloom.sources.tables import require, standardize_columns

# Price changes tried for actions and for scenario runs.
ACTION_GRID = (-0.20, -0.15, -0.10, -0.05, 0.0, 0.05, 0.10)
SCENARIOS = (-0.15, -0.10, -0.05, 0.0, 0.05, 0.10, 0.15)
MAX_MOVE = 0.10
COST_RATIO = 0.65


def _literals(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def score_price_changes(
    valid: DataFrame,
    model: Predictor,
    changes: Sequence[float],
    categories: Sequence[str] | None = None,
    margins: DataFrame | None = None,
) -> DataFrame:
    """Effect of each price change per category over the validation rows.

    A one-step what-if: the current and the previous week's price are scaled, other history
    stays. Each row is scored once as it is and once per change, then one aggregate follows.
    """
    base = model.predict(model.attach(valid)).withColumnRenamed("prediction", "base_units")
    base = base.withColumn("base_revenue", F.col("avg_price") * F.col("base_units"))
    changed = base.withColumn("percent_price_change", F.explode(_literals(changes)))
    factor = 1 + F.col("percent_price_change")
    if categories is not None:
        factor = F.when(F.col(CATEGORY).isin(*categories), factor).otherwise(1.0)
    scaled = {c: F.col(c) * factor for c in ("avg_price", "avg_price_lag1") if c in valid.columns}
    scored = model.predict(changed.withColumns(scaled))
    effect = scored.groupBy(CATEGORY, "percent_price_change").agg(
        F.sum(F.col("prediction") - F.col("base_units")).alias("delta_units"),
        F.sum(F.col("avg_price") * F.col("prediction") - F.col("base_revenue")).alias("delta_revenue"),
    )
    return with_margin(effect, margins).withColumn("delta_margin", F.col("delta_revenue") * F.col("margin_rate"))


def what_if_by_category(effect: DataFrame) -> DataFrame:
    return effect.select(CATEGORY, "delta_units", "delta_revenue").orderBy(F.desc_nulls_last("delta_revenue"), CATEGORY)


def what_if_summary(effect: DataFrame) -> DataFrame:
    return effect.groupBy("percent_price_change").agg(
        *[F.sum(c).alias(c) for c in ("delta_units", "delta_revenue", "delta_margin")]
    )


def recommend_actions(
    valid: DataFrame, model: Predictor, changes: Sequence[float] = ACTION_GRID, margins: DataFrame | None = None
) -> DataFrame:
    """Best price change per category by margin gained; ties go to the smallest change."""
    effect = score_price_changes(valid, model, changes, margins=margins)
    best = ranked_within(effect, [CATEGORY], [F.desc_nulls_last("delta_margin"), F.asc("percent_price_change")])
    return best.select(
        CATEGORY,
        F.col("delta_margin").alias("best_delta_margin"),
        F.col("percent_price_change").alias("recommended_pct"),
    )


def select_within_budget(
    actions: DataFrame,
    base_revenue: DataFrame,
    share: float = 0.3,
    max_actions: int = 10,
    by: Sequence[str] = (),
    skip_free: bool = False,
) -> DataFrame:
    """Greedy choice by margin: take each action that still fits, up to ``max_actions``.

    Cost is the size of the change times the category's revenue; the budget is ``share`` of
    all costs, per ``by`` group if given. Spending only grows, so an action that does not fit
    now never will. A round therefore takes the ``max_actions`` best affordable actions after
    the last one seen, walks through them in order, and is repeated only while actions may be
    left; each round picks at least one. No more than ``max_actions`` rows of a group are ever
    brought together, and the state, one row per group, is written between rounds.
    """
    by = list(by)
    costed = actions.join(base_revenue.select(CATEGORY, *by, "base_revenue"), [CATEGORY, *by], "left").select(
        *by,
        CATEGORY,
        "recommended_pct",
        "best_delta_margin",
        F.coalesce(F.abs("recommended_pct") * F.col("base_revenue"), F.lit(0.0)).alias("cost"),
    )
    costed = stage(costed, "costed-actions")
    group = by or ["_all"]
    items = costed if by else costed.withColumn("_all", F.lit(0))
    item = F.struct(
        F.col("best_delta_margin").isNull().alias("no_margin"),
        (-F.col("best_delta_margin")).alias("loss"),
        F.col(CATEGORY).alias("category"),
        F.col("recommended_pct").alias("pct"),
        "cost",
    )
    kind = "struct<no_margin:boolean,loss:double,category:string,pct:double,cost:double>"
    state = items.groupBy(*group).agg((money_sum("cost") * share).alias("budget")).select(
        *group,
        "budget",
        F.lit(0.0).alias("spent"),
        F.array().cast(f"array<{kind}>").alias("picks"),
        F.lit(None).cast(kind).alias("last"),
        F.lit(True).alias("open"),
    )
    if skip_free:
        items = items.where(F.col("cost") > 0)
    items = items.select(*group, item.alias("item"))

    def take(acc: Column, candidate: Column) -> Column:
        spent = acc.getField("spent") + candidate.getField("cost")
        fits = (F.size(acc.getField("picks")) < max_actions) & (spent <= F.col("budget"))
        taken = F.struct(spent.alias("spent"), F.array_append(acc.getField("picks"), candidate).alias("picks"))
        return F.when(fits, taken).otherwise(acc)

    for _ in range(max_actions):
        state = stage(state, "budget-state")
        if not state.where("open").head(1):
            break
        affordable = items.join(state.where("open").select(*group, "budget", "spent", "last"), group).where(
            (F.col("spent") + F.col("item.cost") <= F.col("budget"))
            & (F.col("last").isNull() | (F.col("item") > F.col("last")))
        )
        best = ranked_within(affordable, group, [F.asc("item")], max_actions)
        best = best.groupBy(*group).agg(F.sort_array(F.collect_list("item")).alias("best"))
        walked = state.join(best, group, "left").withColumn("best", F.coalesce("best", F.array().cast(f"array<{kind}>")))
        walked = walked.withColumn("after", F.aggregate("best", F.struct("spent", "picks"), take))
        state = walked.select(
            *group,
            "budget",
            F.col("after.spent").alias("spent"),
            F.col("after.picks").alias("picks"),
            F.coalesce(F.try_element_at("best", F.lit(-1)), F.col("last")).alias("last"),
            ((F.size("after.picks") < max_actions) & (F.size("best") == max_actions)).alias("open"),
        )
    chosen = state.select(*by, F.inline("picks"))
    return chosen.select(
        *by,
        F.col("category").alias(CATEGORY),
        F.col("pct").alias("recommended_pct"),
        (-F.col("loss")).alias("best_delta_margin"),
        "cost",
    ).orderBy(*by, F.desc_nulls_last("best_delta_margin"), CATEGORY)


def run_scenarios(
    history: DataFrame,
    predictor: Predictor,
    multipliers: Sequence[float] = SCENARIOS,
    calibration: DataFrame | None = None,
    horizon: int = HORIZON,
    policy: FeaturePolicy | None = None,
    holidays: DataFrame | None = None,
) -> DataFrame:
    """Forecast under each flat price change; base units feed the recursion.

    ``calibration`` (category, a, b) adds calibrated units; categories without a line keep
    their base units.
    """
    plan = recent_mean(history, ["avg_price"]).select(
        CATEGORY,
        F.explode(_literals(multipliers)).alias("scenario"),
        (F.col("avg_price_recent") * (1 + F.col("scenario"))).alias("planned_price"),
    )
    plan = plan.select("*", F.explode(future_weeks(history, horizon)).alias(WEEK))
    runs = recursive_forecast(history, plan, predictor, policy, horizon, by=["scenario"], holidays=holidays)
    if calibration is None:
        cal = F.col("units")
    else:
        runs = runs.join(calibration.select(CATEGORY, "a", "b"), CATEGORY, "left")
        cal = F.coalesce("a", F.lit(0.0)) + F.coalesce("b", F.lit(1.0)) * F.col("units")
    return runs.select(
        WEEK, CATEGORY, "scenario", "avg_price",
        F.col("units").alias("units_base"),
        F.col("revenue").alias("revenue_base"),
        cal.alias("units_cal"),
        (F.col("avg_price") * cal).alias("revenue_cal"),
    )


def scenario_totals(scenarios: DataFrame) -> DataFrame:
    """Units, revenue and mean price per category and scenario beside those of scenario 0."""
    totals = scenarios.groupBy(CATEGORY, "scenario").agg(
        F.sum("units_cal").alias("units_s"),
        F.sum("revenue_cal").alias("revenue_s"),
        F.avg("avg_price").alias("price_s"),
    )
    w = W.partitionBy(CATEGORY)
    baseline = F.col("scenario") == 0.0
    return totals.withColumns(
        {f"{c}0": F.max(F.when(baseline, F.col(f"{c}_s"))).over(w) for c in ("units", "revenue", "price")}
    )


def scenario_deltas(scenarios: DataFrame) -> DataFrame:
    """Changes against scenario 0 and the implied elasticity, for every other scenario."""
    moved = scenario_totals(scenarios).where(F.col("scenario") != 0.0)
    return _with_elasticity(
        moved.withColumns(
            {
                "delta_units": F.col("units_s") - F.col("units0"),
                "delta_revenue": F.col("revenue_s") - F.col("revenue0"),
            }
        )
    )


def _with_elasticity(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "pct_dQ": guarded(F.col("units_s") - F.col("units0"), "units0"),
            "pct_dP": guarded(F.col("price_s") - F.col("price0"), "price0"),
        }
    ).withColumn("elasticity", F.try_divide("pct_dQ", "pct_dP"))


def elasticity_leaderboard(deltas: DataFrame, k: int = 20) -> DataFrame:
    per = deltas.groupBy(CATEGORY).agg(F.avg(F.abs("elasticity")).alias("mean_abs_elasticity"))
    return top_k(per, [F.desc_nulls_last("mean_abs_elasticity"), F.asc(CATEGORY)], k)


def best_scenarios(deltas: DataFrame, view: str) -> DataFrame:
    """One scenario per category. view: abs (largest effect), gain or loss."""
    lifts = deltas.withColumns(
        {
            "rev_lift": F.col("delta_revenue"),
            "rev_lift_abs": F.abs("delta_revenue"),
            "units_lift": F.col("delta_units"),
            "units_lift_abs": F.abs("delta_units"),
        }
    )
    rows, order = {
        "abs": (lifts.where(F.col("rev_lift_abs").isNotNull()), F.desc("rev_lift_abs")),
        "gain": (lifts.where(F.col("rev_lift") > 0), F.desc("rev_lift")),
        "loss": (lifts.where(F.col("rev_lift") < 0), F.asc("rev_lift")),
    }[view]
    return ranked_within(rows, [CATEGORY], [order, F.asc("scenario")]).orderBy(order, CATEGORY)


def recommend_prices(scenarios: DataFrame, max_move: float = MAX_MOVE) -> DataFrame:
    """Best price move per category if it passes the guardrails, else no change.

    The best move is the non-zero scenario with the largest revenue lift. It is recommended
    when it is at most ``max_move`` and the lift is positive. Otherwise the category gets
    scenario 0 with zero lift and no new price, units or revenue of its own.
    """
    moves = _with_elasticity(scenario_totals(scenarios)).withColumns(
        {
            "rev_lift": F.col("revenue_s") - F.col("revenue0"),
            "units_lift": F.col("units_s") - F.col("units0"),
        }
    )
    own = ["scenario", "rev_lift", "units_lift", "revenue_s", "units_s", "price_s", "elasticity"]
    order = [F.col("rev_lift").isNull().alias("no_lift"), (-F.col("rev_lift")).alias("loss"), F.col("scenario").alias("tie")]
    candidate = F.struct(*order, *own)
    per = moves.groupBy(CATEGORY).agg(
        F.min(F.when(F.col("scenario") != 0.0, candidate)).alias("best"),
        F.bool_or(F.col("scenario") == 0.0).alias("has_baseline"),
        *[F.max(c).alias(c) for c in ("revenue0", "units0", "price0")],
    )
    accept = (F.abs("best.scenario") <= max_move) & (F.col("best.rev_lift") > 0)
    per = per.withColumn("_accept", F.coalesce(accept, F.lit(False))).where(F.col("_accept") | F.col("has_baseline"))

    def chosen(field: str, otherwise: float | None) -> Column:
        return F.when(F.col("_accept"), F.col(f"best.{field}")).otherwise(F.lit(otherwise).cast("double"))

    # Names and order of the output columns.
    return per.select(
        CATEGORY,
        chosen("scenario", 0.0).alias("scenario"),
        chosen("rev_lift", 0.0).alias("rev_lift"),
        chosen("units_lift", 0.0).alias("units_lift"),
        "revenue0",
        chosen("revenue_s", None).alias("revenue"),
        "units0",
        chosen("units_s", None).alias("units"),
        "price0",
        chosen("price_s", None).alias("price"),
        chosen("elasticity", None).alias("elasticity"),
        F.lit(True).alias("within_10pct"),
        F.lit(True).alias("positive_lift"),
        F.lit(True).alias("recommended"),
    ).orderBy(F.desc_nulls_last("rev_lift"), CATEGORY)


def profit_recommendations(recs: DataFrame, costs: DataFrame, deltas: DataFrame | None = None) -> DataFrame:
    """Profit now and after the recommended move; categories without a unit cost are dropped.

    Price and units of the move come from ``recs`` or, by scenario, from ``deltas``; a move of
    0 % keeps the baseline, so its lift is zero.
    """
    rec = standardize_columns(recs, RECOMMENDATION_ALIASES)
    if not {"price0", "units0"} <= set(rec.columns):
        if deltas is None:
            raise ValueError("recommendations carry no baseline and no deltas are given")
        base = deltas.groupBy(CATEGORY).agg(F.max("price0").alias("price0"), F.max("units0").alias("units0"))
        rec = rec.drop("price0", "units0").join(base, CATEGORY, "left")
    if not {"price_best", "units_best"} <= set(rec.columns):
        require(rec, ["scenario"], "recommendations")
        if deltas is None:
            raise ValueError("recommendations carry no new price and no deltas are given")
        picked = deltas.select(
            CATEGORY,
            scenario_key("scenario").alias("_key"),
            F.col("price_s").alias("price_best"),
            F.col("units_s").alias("units_best"),
        )
        rec = rec.drop("price_best", "units_best").withColumn("_key", scenario_key(F.col("scenario").cast("double")))
        rec = rec.join(picked, [CATEGORY, "_key"], "left")
        still = F.col("_key") == 0
        rec = rec.withColumns(
            {
                "price_best": F.when(still, F.col("price0")).otherwise(F.col("price_best")),
                "units_best": F.when(still, F.col("units0")).otherwise(F.col("units_best")),
            }
        ).drop("_key")
    cost = standardize_columns(costs, {CATEGORY: RECOMMENDATION_ALIASES["category"]})
    require(cost, [CATEGORY, "unit_cost"], "unit costs")
    out = rec.drop("unit_cost").join(cost.select(CATEGORY, "unit_cost"), CATEGORY, "left").dropna(subset=["unit_cost"])
    out = out.withColumns(
        {
            "profit0": (F.col("price0") - F.col("unit_cost")) * F.col("units0"),
            "profit_best": (F.col("price_best") - F.col("unit_cost")) * F.col("units_best"),
        }
    )
    return out.withColumn("profit_lift", F.col("profit_best") - F.col("profit0")).orderBy(
        F.desc_nulls_last("profit_lift"), CATEGORY
    )


def profit_metrics(recs: DataFrame) -> DataFrame:
    """Relative changes and unit margins; price_best and units_best are rebuilt if absent."""
    rec = standardize_columns(recs, RECOMMENDATION_ALIASES)
    for new, old, change in (("price_best", "price0", "price_change_pct"), ("units_best", "units0", "units_change_pct")):
        if new not in rec.columns and {old, change} <= set(rec.columns):
            rec = rec.withColumn(new, F.col(old) * (1 + F.col(change)))
    require(rec, ["price0", "price_best", "units0", "units_best", "profit0", "profit_best"], "recommendations")
    if "profit_lift" not in rec.columns:
        rec = rec.withColumn("profit_lift", F.col("profit_best") - F.col("profit0"))
    return rec.withColumns(
        {
            "price_change_pct": F.try_divide(F.col("price_best") - F.col("price0"), F.col("price0")),
            "units_change_pct": guarded(F.col("units_best") - F.col("units0"), "units0"),
            "profit_change_pct": F.try_divide("profit_lift", "profit0"),
            "margin0": guarded("profit0", "units0"),
            "margin_best": guarded("profit_best", "units_best"),
        }
    )


def safe_moves(metrics: DataFrame, max_units_loss: float = 0.10) -> DataFrame:
    """Moves that gain profit, lose at most 10 % of units and keep the unit margin."""
    safe = metrics.where(
        (F.col("profit_lift") > 0)
        & (F.col("units_change_pct") >= -max_units_loss)
        & (F.col("margin_best") >= F.col("margin0"))
    )
    return safe.orderBy(F.desc_nulls_last("profit_lift"), CATEGORY)


def biggest_risks(metrics: DataFrame, k: int = 20) -> DataFrame:
    known = metrics.where(F.col("profit_lift").isNotNull())
    return top_k(known, [F.asc("profit_lift"), F.asc(CATEGORY)], k)


def profit_guardrails(recs: DataFrame) -> dict[str, DataFrame]:
    """The three tables handed to the business: all moves, safe moves, biggest risks."""
    metrics = profit_metrics(recs)
    return {
        "all_recommendations": metrics.orderBy(F.desc_nulls_last("profit_lift"), CATEGORY),
        "safe_top": safe_moves(metrics),
        "biggest_risks": biggest_risks(metrics),
    }


def margins_template(weekly: DataFrame, rate: float = MARGIN_RATE) -> DataFrame:
    return weekly.select(CATEGORY).distinct().withColumn("margin_rate", F.lit(rate)).orderBy(CATEGORY)


def proxy_costs(prices: DataFrame, ratio: float = COST_RATIO) -> DataFrame:
    """Unit cost as a fixed share of the approximate price, until real costs are known."""
    return prices.withColumn("unit_cost", F.col("approx_price") * ratio)
