"""The whole retail job: raw tables in a folder to every output table in another, published as one set.

Clean, aggregate by week, train, validate, calibrate, forecast, run scenarios, recommend. Each output is
written once and read again by the steps after it, so an executor may be lost at any point and no
step repeats another's scans.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.operators import audit, cleaning, features, forecast, model, pricing, validation
from weekloom.operators.ensemble import TreeEnsemble, load_ensemble
from weekloom.operators.model import NO_LEAK_PARAMS, TreeParams
from weekloom.session import staging_scope
from weekloom.sources.schemas import AUDITED_COLUMNS
from weekloom.sources.runs import Run
from weekloom.sources.tables import first_file, read_parquet

# The raw tables, and the endings under which a file may lie in the folder.
RAW = ("orders", "order_items", "products", "category_translation", "payments", "reviews", "customers", "sellers", "geolocation")
OPTIONAL = ("holidays", "margins", "unit_costs")
DIMENSIONS = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def read_raw(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """The nine raw tables and those optional ones that are there, as CSV or Parquet; and the ledger of values that didn't parse."""
    ledger: list[DataFrame] = []

    def read(name: str, optional: bool) -> DataFrame | None:
        return first_file(spark, [f"{folder}/{name}.csv", f"{folder}/{name}.parquet"], name, optional, ledger)

    found = {name: read(name, False) for name in RAW} | {name: read(name, True) for name in OPTIONAL}
    return {name: df for name, df in found.items() if df is not None}, ledger


def clean(job: Run, raw: Mapping[str, DataFrame]) -> DataFrame:
    """Audit and clean; returns the fact."""
    named = raw["products"].join(raw["category_translation"], "product_category_name", "left")
    audited = {n: named if n == "products" else raw[n] for n in AUDITED_COLUMNS}
    job.put("missingness_summary", audit.missingness_summary(audited, AUDITED_COLUMNS))
    job.put("order_status_counts", audit.status_counts(raw["orders"], "order_status"))
    job.put("dataset_overview", audit.dataset_overview({n: raw[n] for n in AUDITED_COLUMNS}))
    translated = cleaning.translate_category(raw["products"], raw["category_translation"])
    log = audit.CleaningLog()
    products = cleaning.impute_by_group_median(translated, DIMENSIONS, "category")
    products = job.put("products_clean", log.watch("products_missing_english_category_now", products))
    geo = job.put("geo_reference", cleaning.geo_reference(raw["geolocation"]))
    places = {}
    for who in ("customer", "seller"):
        filled = cleaning.fill_from_reference(raw[f"{who}s"], geo, f"{who}_zip_code_prefix", f"{who}_city", f"{who}_state")
        places[who] = job.put(f"{who}s_clean", log.watch(f"{who}s_missing_state_after_fill", filled))
    orders = cleaning.flag_valid_sales(cleaning.delivery_duration(raw["orders"]))
    payments = job.put("payments_by_order", cleaning.payments_by_order(raw["payments"]))
    reviews = job.put("reviews_by_order", cleaning.reviews_by_order(raw["reviews"]))
    items, _ = cleaning.clean_items(raw["order_items"], places["seller"], log)
    fact = cleaning.build_fact(items, orders, products, places["seller"], places["customer"], payments, reviews)
    fact = job.put("fact_orders_clean", log.watch("remaining_fact_rows", fact))
    job.put("cleaning_log", log.table(job.spark))
    return fact


def train(job: Run, fact: DataFrame, holidays: DataFrame | None, params: TreeParams) -> tuple[DataFrame, TreeEnsemble]:
    """Weekly series, features, model and predictions; returns the series forecasts start from, and the model's trees."""
    weekly = job.put("weekly_by_category", features.trim_tail(features.weekly_aggregate(fact)))
    table = features.ensure_valid_rows(features.time_split(features.warmup_trim(features.weekly_features(weekly, holidays))))
    table = job.put("weekly_features", table)
    model.train_demand_model(table, params=params).save(job.path("demand_model"))
    fitted = load_ensemble(job.path("demand_model"))
    job.put("demand_model_nodes", fitted.nodes)
    job.put("valid_predictions", model.valid_predictions(model.score(fitted, table)))
    return job.put("weekly_filled", features.fill_rolling_mean(weekly, "rev_score_avg")), fitted


def validate(job: Run, history: DataFrame) -> DataFrame:
    """Errors, leaderboard and calibration of the predictions; returns the calibration."""
    names = {"actual_units": "y", "pred_units": "yhat"}
    pred = read_parquet(job.spark, job.path("valid_predictions")).withColumnsRenamed(names)
    job.put("validation_overall_metrics", validation.overall_metrics(pred))
    job.put("calibration_global", validation.calibration_global(pred))
    per = job.put("validation_by_category", validation.metrics_by_category(pred))
    job.put("validation_leaderboard", validation.validation_leaderboard(per))
    job.put("validation_actions", validation.validation_actions(per, pred, history))
    return job.put("calibration_by_category", validation.calibration_by_category(pred))


def predict(job: Run, history: DataFrame, fitted: TreeEnsemble, calibration: DataFrame, raw: Mapping[str, DataFrame]) -> None:
    """Price plan, forecasts, their rollups and checks; raises if a key comes twice or a rollup differs."""
    table = read_parquet(job.spark, job.path("weekly_features")).where("split = 'valid'")
    actions = job.put("price_actions", pricing.recommend_actions(table, fitted, margins=raw.get("margins")))
    chosen = history.groupBy("category").agg(F.sum("revenue").alias("base_revenue"))
    job.put("selected_actions", pricing.select_within_budget(actions, chosen))
    plan = job.put("price_plan", forecast.price_plan(history, actions))
    base = job.put("forecast", forecast.recursive_forecast(history, plan, fitted, holidays=raw.get("holidays")))
    job.put("plan_impact", forecast.plan_impact(base, model.score(fitted, table), raw.get("margins")))
    calibrated = job.put("forecast_calibrated", validation.apply_calibration(base, calibration))
    job.put("calibration_impact", validation.calibration_impact(calibrated))
    unified = job.put("forecast_unified", forecast.unify_forecasts(base, calibrated, plan))
    rollups = job.put("forecast_rollups", forecast.forecast_rollups(unified))
    checks = job.put("forecast_checks", forecast.qa_checks(unified, rollups))
    forecast.require_quality(checks)
    job.put("kpi_by_category", forecast.kpi_by_category(unified))


def recommend(job: Run, history: DataFrame, fitted: TreeEnsemble, calibration: DataFrame, raw: Mapping[str, DataFrame]) -> None:
    """Scenarios, elasticities, and price moves by revenue and by profit."""
    params = validation.calibration_params(calibration)
    runs = job.put("scenarios_detailed", pricing.run_scenarios(history, fitted, calibration=params, holidays=raw.get("holidays")))
    deltas = job.put("elasticity_deltas", pricing.scenario_deltas(runs))
    job.put("elasticity_leaderboard", pricing.elasticity_leaderboard(deltas))
    recs = job.put("recommendations", pricing.recommend_prices(runs))
    if "unit_costs" in raw:
        costs = raw["unit_costs"]
    else:
        costs = pricing.proxy_costs(history.groupBy("category").agg(F.avg("avg_price").alias("approx_price")))
    profit = job.put("recommendations_profit", pricing.profit_recommendations(recs, costs, deltas))
    for name, df in pricing.profit_guardrails(profit).items():
        job.put(name, df)


def run(spark: SparkSession, raw_folder: str, out_folder: str, params: TreeParams = NO_LEAK_PARAMS) -> list[str]:
    """Write every output table of the job; returns their names.

    All appear together (see runs.published): a job that fails leaves readers with the tables of the run before.
    """
    with staging_scope(spark):
        raw, ledger = read_raw(spark, raw_folder)
        job = Run(spark, out_folder)
        try:
            if ledger:
                job.put("rejected_values", reduce(DataFrame.unionByName, ledger))
            fact = clean(job, raw)
            history, fitted = train(job, fact, raw.get("holidays"), params)
            calibration = validate(job, history)
            predict(job, history, fitted, calibration, raw)
            recommend(job, history, fitted, calibration, raw)
            job.publish()
        except BaseException:
            job.discard()
            raise
    return job.names
