"""Weekly series, their features, and the demand model."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.registry import CTES, query, r, rounded, rs, weekly_sql
from weekloom.operators import features, model
from weekloom.operators.ensemble import load_ensemble
from weekloom.operators.features import LAGGED, LAGS
from weekloom.session import stage, staging_root

_KEYS = "order_week, category"
_BASE = "order_week, category, units, revenue, avg_price, rev_count"
_W = "(PARTITION BY category ORDER BY order_week)"


def _columns(table: str) -> str:
    return f"SELECT {_BASE}, {rs(6, 'rev_score_avg')} FROM {table}"


def _score(df):
    return rounded(df, 6, "rev_score_avg")


@query("c1_weekly_aggregate", _columns("weekly"))
def _(t):
    return _score(t.weekly)


_DAILY = """CAST(ts AS DATE) AS order_week, event_type AS category, CAST(count(*) AS DOUBLE) AS units,
  CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS revenue,
  CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS avg_price,
  CAST(0 AS DOUBLE) AS rev_count, CAST(NULL AS DOUBLE) AS rev_score_avg FROM events GROUP BY 1, 2"""


@query("c1_weekly_aggregate_daily_events", f"SELECT {_DAILY}")
def _(t):
    facts = t.table("events").select(
        F.to_date("ts").alias("order_date"),
        F.col("event_type").alias("category"),
        F.lit(1).alias("units"),
        F.col("value").alias("revenue_item"),
        F.lit(0).alias("review_count"),
        F.lit(None).cast("double").alias("review_score_avg"),
    )
    return features.weekly_aggregate(facts, grain="day")


@query(
    "c1_weekly_aggregate_unit_weighted",
    f"SELECT order_week, category, units, revenue, {r('revenue / units', 6, 'avg_price')} FROM weekly_type",
)
def _(t):
    weekly = features.weekly_aggregate(t.sales("p_type"), price="unit_weighted")
    return rounded(weekly.select("order_week", "category", "units", "revenue", "avg_price"), 6, "avg_price")


CTES["weekly_type"] = weekly_sql("p_type")
# A series with gaps: every third week of odd brands has no rows.
CTES["gappy"] = """
  SELECT * FROM weekly WHERE NOT (CAST(regexp_extract(category, '([0-9]+)', 1) AS INTEGER) % 2 = 1
    AND week(order_week) % 3 = 0)"""


def _gappy(t):
    odd = F.regexp_extract("category", r"(\d+)", 1).cast("int") % 2 == 1
    return t.weekly.where(~(odd & (F.weekofyear("order_week") % 3 == 0)))


@query(
    "c1_densify",
    """SELECT g.order_week, g.category, coalesce(units, 0.0) AS units, coalesce(revenue, 0.0) AS revenue, avg_price,
      coalesce(rev_count, 0.0) AS rev_count FROM
      (SELECT category, CAST(unnest(range(min(order_week), max(order_week) + INTERVAL 1 DAY, INTERVAL 7 DAY)) AS DATE)
         AS order_week FROM gappy GROUP BY category) g
      LEFT JOIN gappy USING (order_week, category)""",
)
def _(t):
    return features.densify(_gappy(t).drop("rev_score_avg"))


# Scores of every other week are removed, so there is something to fill.
@query(
    "c2_fill_rolling_mean",
    f"""SELECT order_week, category, {r(f'coalesce(s, avg(s) OVER (PARTITION BY category ORDER BY order_week ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))', 6, 'rev_score_avg')}
    FROM (SELECT *, CASE WHEN week(order_week) % 2 = 0 THEN rev_score_avg END AS s FROM weekly)""",
)
def _(t):
    holed = t.weekly.withColumn("rev_score_avg", F.expr("CASE WHEN weekofyear(order_week) % 2 = 0 THEN rev_score_avg END"))
    return _score(features.fill_rolling_mean(holed, "rev_score_avg").select("order_week", "category", "rev_score_avg"))


@query(
    "c3_calendar_features",
    f"""SELECT order_week, category, CAST(week(order_week) AS INTEGER) AS weekofyear,
      CAST(year(order_week) AS INTEGER) AS year, {r('sin(2 * pi() * week(order_week) / 52.0)', 9, 'sin_woy')},
      {r('cos(2 * pi() * week(order_week) / 52.0)', 9, 'cos_woy')} FROM weekly""",
)
def _(t):
    return rounded(features.calendar_features(t.weekly.select("order_week", "category")), 9, "sin_woy", "cos_woy")


@query(
    "c4_holiday_flag",
    "SELECT order_week, category, CAST(order_week IN (SELECT date FROM holidays) AS INTEGER) AS is_holiday_week FROM weekly",
)
def _(t):
    return features.holiday_flag(t.weekly.select("order_week", "category"), t.holidays)


@query(
    "c4_holiday_flag_any_day",
    """SELECT order_week, category, CAST(order_week IN (SELECT CAST(date_trunc('week', date) AS DATE) FROM holidays)
      AS INTEGER) AS is_holiday_week FROM weekly""",
)
def _(t):
    return features.holiday_flag(t.weekly.select("order_week", "category"), t.holidays, any_day=True)


@query(
    "c5_add_lags",
    f"SELECT {_BASE}, {rs(6, 'rev_score_avg')}, "
    + ", ".join(
        r(f"lag({c}, {n}) OVER {_W}", 6, f"{c}_lag{n}") if c == "rev_score_avg" else f"lag({c}, {n}) OVER {_W} AS {c}_lag{n}"
        for c in LAGGED
        for n in LAGS
    )
    + " FROM weekly",
)
def _(t):
    scores = [f"rev_score_avg_lag{n}" for n in LAGS]
    return rounded(features.add_lags(t.weekly), 6, "rev_score_avg", *scores)


def _rolling_sql(frame: str) -> str:
    over = f"OVER (PARTITION BY category ORDER BY order_week ROWS BETWEEN {frame})"
    return f"SELECT {_KEYS}, {r(f'avg(units) {over}', 4, 'units_roll4')}, {r(f'avg(revenue) {over}', 4, 'revenue_roll4')} FROM weekly"


@query("c6_rolling_means", _rolling_sql("3 PRECEDING AND CURRENT ROW"))
def _(t):
    rolled = features.rolling_means(t.weekly, include_current=True)
    return rounded(rolled.select("order_week", "category", "units_roll4", "revenue_roll4"), 4, "units_roll4", "revenue_roll4")


@query("c6_rolling_means_no_leak", _rolling_sql("4 PRECEDING AND 1 PRECEDING"))
def _(t):
    rolled = features.rolling_means(t.weekly)
    return rounded(rolled.select("order_week", "category", "units_roll4", "revenue_roll4"), 4, "units_roll4", "revenue_roll4")


CTES["sparse_ranked"] = """
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY order_week) AS k,
    count(*) OVER (PARTITION BY category) AS n FROM sparse"""
CTES["sparse_model"] = """
  SELECT order_week, category, units FROM sparse_ranked
  WHERE k > CASE WHEN n > 52 THEN 52 WHEN n > 12 THEN 12 WHEN n > 8 THEN 8 WHEN n > 4 THEN 4
                 WHEN n > 2 THEN 2 WHEN n > 1 THEN 1 ELSE 0 END"""


@query("c7_warmup_trim_strict", "SELECT order_week, category, units FROM sparse_ranked WHERE k > 52")
def _(t):
    trimmed = features.warmup_trim(features.add_lags(t.sparse(t.weekly), ["units", "revenue"]), mode="strict")
    return trimmed.select("order_week", "category", "units")


@query("c7_warmup_trim_adaptive", "SELECT order_week, category, units FROM sparse_model")
def _(t):
    return features.warmup_trim(t.sparse(t.weekly)).select("order_week", "category", "units")


_FROM_END = "row_number() OVER (PARTITION BY category ORDER BY order_week DESC)"


@query(
    "c8_time_split_fixed",
    f"SELECT order_week, category, CASE WHEN {_FROM_END} <= 12 THEN 'valid' ELSE 'train' END AS split FROM sparse",
)
def _(t):
    return features.time_split(t.sparse(t.weekly), "fixed").select("order_week", "category", "split")


@query(
    "c8_time_split_ratio",
    f"""SELECT order_week, category, CASE WHEN k <= CASE WHEN n <= 1 THEN 0
        ELSE greatest(1, least(12, round_even(0.2 * n, 0))) END THEN 'valid' ELSE 'train' END AS split
    FROM (SELECT *, {_FROM_END} AS k, count(*) OVER (PARTITION BY category) AS n FROM sparse_model)""",
)
def _(t):
    table = features.warmup_trim(t.sparse(t.weekly))
    return features.time_split(table).select("order_week", "category", "split")


@query(
    "c8_ensure_valid_rows",
    f"SELECT order_week, category, CASE WHEN {_FROM_END} = 1 THEN 'valid' ELSE 'train' END AS split FROM weekly",
)
def _(t):
    unsplit = t.series.withColumn("split", F.lit("train"))
    return features.ensure_valid_rows(unsplit).select("order_week", "category", "split")


@query(
    "c9_week_index",
    f"SELECT {_KEYS}, CAST(row_number() OVER {_W} - 1 AS INTEGER) AS week_idx FROM weekly",
)
def _(t):
    return features.week_index(t.weekly).select("order_week", "category", "week_idx")


# Ends of series are cut down: the last week of all brands, the last two of every third brand.
CTES["cut_tail"] = """
  SELECT order_week, category, CASE WHEN k = 1 OR (k <= 3 AND b % 3 = 0) THEN units * 0.1 ELSE units END AS units FROM
    (SELECT *, row_number() OVER (PARTITION BY category ORDER BY order_week DESC) AS k,
       CAST(regexp_extract(category, '([0-9]+)', 1) AS INTEGER) AS b FROM sparse)"""
CTES["cut_flags"] = """
  SELECT *, coalesce(i > 8 AND units < 0.25 * m, false) AS low FROM
    (SELECT *, row_number() OVER (PARTITION BY category ORDER BY order_week DESC) AS k,
       row_number() OVER (PARTITION BY category ORDER BY order_week) AS i,
       quantile_cont(units, 0.5) OVER (PARTITION BY category ORDER BY order_week ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS m
     FROM cut_tail)"""


@query(
    "c10_trim_tail",
    f"""SELECT order_week, category, {r('units', 6)} FROM
      (SELECT *, lag(low) OVER (PARTITION BY category ORDER BY k) AS newer_low FROM cut_flags)
    WHERE NOT (low AND (k = 1 OR (k = 2 AND newer_low)))""",
)
def _(t):
    sparse = t.sparse(t.weekly).select("order_week", "category", "units")
    from_end = features.W.partitionBy("category").orderBy(F.desc("order_week"))
    brand = F.regexp_extract("category", r"(\d+)", 1).cast("int")
    k = F.row_number().over(from_end)
    cut = sparse.withColumns({"k": k, "b": brand})
    low = (F.col("k") == 1) | ((F.col("k") <= 3) & (F.col("b") % 3 == 0))
    cut = cut.withColumn("units", F.when(low, F.col("units") * 0.1).otherwise(F.col("units"))).drop("k", "b")
    return rounded(features.trim_tail(cut), 6, "units")


# -- model -----------------------------------------------------------------------------------


def model_table(t, weekly=None):
    """Feature table with warm-up trimmed and split marked."""
    full = features.weekly_features(t.weekly if weekly is None else weekly, t.holidays)
    return features.time_split(features.warmup_trim(full))


_TRAINED: dict[tuple[str, str, bool], tuple] = {}


def trained(t, with_revenue: bool = False):
    """(feature table, model, path it is saved at), at the operator's own settings.

    Both settings are trained once per application and folder; every query that needs one loads it.
    """
    key = (t.spark.sparkContext.applicationId, t.folder, with_revenue)
    if key not in _TRAINED:
        full = features.weekly_features(t.series, t.holidays, include_current=with_revenue)
        table = stage(features.time_split(features.warmup_trim(full)), "model-table")
        params = model.TreeParams() if with_revenue else model.NO_LEAK_PARAMS
        fitted = model.train_demand_model(table, drop_current_revenue=not with_revenue, params=params)
        path = f"{staging_root(t.spark)}/demand-model-{uuid.uuid4().hex}"
        fitted.save(path)
        _TRAINED[key] = table, fitted, path
    return _TRAINED[key]


def loaded(t, with_revenue: bool = False):
    """(feature table, model read back from where it was saved)."""
    table, _, path = trained(t, with_revenue)
    return table, model.DemandModel.load(path)


def ensemble(t, with_revenue: bool = False):
    """(feature table, the saved model's trees as a node table)."""
    table, fitted, path = trained(t, with_revenue)
    return table, load_ensemble(path, fitted)


# Trees have no value in SQL; it holds their keys, sizes and prices, and that what must follow does follow.
@query("d1_train_demand_model", "SELECT split, count(*) AS rows, true AS predicted, true AS fits FROM model_rows GROUP BY split")
def _(t):
    table, fitted = loaded(t)
    mean = lambda c: F.avg(F.abs(F.col("units") - F.col(c)))
    return fitted.predict(table).groupBy("split").agg(
        F.count("*").alias("rows"),
        F.bool_and(F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("predicted"),
        ((F.col("split") == "valid") | (mean("prediction") < mean("units_roll4"))).alias("fits"),
    )


@query("d1_train_demand_model_with_revenue", "SELECT split, count(*) AS rows, true AS fits FROM model_rows GROUP BY split")
def _(t):
    table, fitted = loaded(t, with_revenue=True)
    mean = lambda c: F.avg(F.abs(F.col("units") - F.col(c)))
    return fitted.predict(table).groupBy("split").agg(
        F.count("*").alias("rows"), (mean("prediction") < mean("units_roll4")).alias("fits")
    )


@query("d2_score", "SELECT order_week, category, split, units, true AS predicted, true AS same FROM model_rows")
def _(t):
    """MLlib's prediction, and whether the walk through the node table gives the same."""
    table, _, path = trained(t)
    fitted = model.DemandModel.load(path)
    trees = load_ensemble(path, fitted)
    scored = model.score(fitted, table).withColumnRenamed("prediction", "by_mllib")
    # the walk costs far more than its rows weigh, so the number of tasks is given, not chosen from their size
    both = model.score(trees, scored.repartition(t.spark.sparkContext.defaultParallelism, "order_week", "category"))
    finite = F.col("by_mllib").isNotNull() & ~F.isnan("by_mllib") & (F.abs("by_mllib") < float("inf"))
    near = F.abs(F.col("prediction") - F.col("by_mllib")) <= 1e-9 * (1 + F.abs("by_mllib"))
    same = finite & F.coalesce(near & ~F.isnan("prediction"), F.lit(False))
    return both.select("order_week", "category", "split", "units", finite.alias("predicted"), same.alias("same"))


@query("d4_save_load_model", "SELECT order_week, category, units AS actual_units, true AS same FROM model_rows WHERE split = 'valid'")
def _(t):
    table, fitted, path = trained(t)
    saved = model.valid_predictions(model.DemandModel.load(path).predict(table))
    kept = model.valid_predictions(fitted.predict(table)).select("order_week", "category", F.col("pred_units").alias("kept"))
    same = (F.col("pred_units") == F.col("kept")).alias("same")
    return saved.join(kept, ["order_week", "category"], "left").select("order_week", "category", "actual_units", same)


@query(
    "d3_fit_linear_by_group",
    f"SELECT category, {rs(4, 'a')}, {rs(6, 'b')} FROM roll_lines",
)
def _(t):
    lines = model.fit_linear_by_group(model_table(t).where("split = 'train'"), "units", "units_roll4")
    return rounded(rounded(lines, 4, "a"), 6, "b")


@query(
    "d3_score_linear",
    f"""SELECT order_week, category, split, units, {r('a + b * units_roll4', 4, 'prediction')}
    FROM model_rows JOIN roll_lines USING (category)""",
)
def _(t):
    scored = model.fit_score_linear(model_table(t), "units", "units_roll4")
    return rounded(scored.select("order_week", "category", "split", "units", "prediction"), 4, "prediction")


@query(
    "d5_valid_predictions",
    f"SELECT order_week, category, y AS actual_units, {r('yhat', 4, 'pred_units')} FROM pred",
)
def _(t):
    scored = model.fit_score_linear(model_table(t), "units", "units_roll4")
    return rounded(model.valid_predictions(scored), 4, "pred_units")
