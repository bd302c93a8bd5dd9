from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from weekloom.operators import features, forecast, model

MONDAY = date(2018, 1, 1)
SCHEMA = "category string, order_week date, units double, revenue double, avg_price double, rev_count double, rev_score_avg double"


def week(i):
    return MONDAY + timedelta(days=7 * i)


def make_series(spark, series):
    """series: {category: [units or None, ...]} -> weekly table."""
    data = []
    for c, values in series.items():
        for i, u in enumerate(values):
            price = 10.0 + i % 3
            data.append((c, week(i), u, None if u is None else u * price, price, float(i % 5), 3.0 + i % 2))
    return spark.createDataFrame(data, SCHEMA)


def test_weekly_aggregate_nulls(spark, rows):
    fact = spark.createDataFrame(
        [(date(2018, 1, 7), None, 1, 5.0, None, None), (date(2018, 1, 1), None, 2, 7.0, 2, 4.0), (None, "x", 1, 1.0, 1, 1.0)],
        "order_date date, category string, units int, revenue_item double, review_count int, review_score_avg double",
    )
    assert rows(features.weekly_aggregate(fact)) == [
        {"order_week": MONDAY, "category": "unknown", "units": 3.0, "revenue": 12.0, "avg_price": 6.0,
         "rev_count": 2.0, "rev_score_avg": 4.0}
    ]
    weighted = features.weekly_aggregate(fact, price="unit_weighted").head()
    assert weighted.avg_price == 4.0
    monthly = features.weekly_aggregate(fact, grain="month").head()
    assert monthly.order_week == date(2018, 1, 1)
    with pytest.raises(ValueError):
        features.weekly_aggregate(fact, grain="hour")


def test_large_product_tables_give_the_same_weeks(spark):
    from weekloom.sources.star import StarTables

    def weeks():
        scored = StarTables(spark, "/root/testdata/sf0.001").weekly.withColumn("rev_score_avg", F.round("rev_score_avg", 9))
        return sorted(map(tuple, scored.collect()))

    expected = weeks()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert weeks() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def brute_trim(values, lookback=8, share=0.25, max_drop=2):
    values, dropped = list(values), 0
    while len(values) >= lookback + 1 and dropped < max_drop:
        before = sorted(values[-lookback - 1 : -1])
        median = (before[(lookback - 1) // 2] + before[lookback // 2]) / 2
        if values[-1] >= share * median:
            break
        values, dropped = values[:-1], dropped + 1
    return len(values)


def test_trim_tail_against_brute_force(spark):
    series = {
        "none": [10.0] * 12,
        "one": [10.0] * 11 + [1.0],
        "two": [10.0] * 10 + [1.0, 1.0],
        "three": [10.0] * 9 + [1.0, 1.0, 1.0],
        "gap": [10.0] * 9 + [1.0, 9.0, 1.0],
        "short": [10.0] * 7 + [1.0],
        "nine": [10.0] * 8 + [1.0],
        "all_low": [8.0] * 8 + [0.0] * 4,
    }
    got = {r.category: r.n for r in features.trim_tail(make_series(spark, series)).groupBy("category").agg(F.count("*").alias("n")).collect()}
    assert got == {c: brute_trim(v) for c, v in series.items()}


def test_warmup_and_split_sizes(spark):
    series = {f"n{n:02d}": [1.0] * n for n in (1, 2, 3, 5, 9, 13, 53, 70)}
    full = features.add_lags(make_series(spark, series))
    kept = features.warmup_trim(full)
    counts = {r.category: r["count"] for r in kept.groupBy("category").count().collect()}
    assert counts == {"n01": 1, "n02": 1, "n03": 1, "n05": 1, "n09": 1, "n13": 1, "n53": 1, "n70": 18}
    strict = {r.category: r["count"] for r in features.warmup_trim(full, mode="strict").groupBy("category").count().collect()}
    assert strict == {"n53": 1, "n70": 18}
    split = features.time_split(full)
    valid = {r.category: r.v for r in split.groupBy("category").agg(F.count_if(F.col("split") == "valid").alias("v")).collect()}
    assert valid == {"n01": 0, "n02": 1, "n03": 1, "n05": 1, "n09": 2, "n13": 3, "n53": 11, "n70": 12}
    fixed = features.time_split(full, "fixed").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in fixed} == {"train": 41 + 58 + 1, "valid": 1 + 2 + 3 + 5 + 9 + 12 * 3}
    assert split.count() == full.count()
    single = features.ensure_valid_rows(features.time_split(make_series(spark, {"a": [1.0], "b": [2.0]})))
    assert [r.split for r in single.collect()] == ["valid", "valid"]


def test_lags_are_row_offsets_and_densify_makes_them_calendar_offsets(spark):
    weekly = make_series(spark, {"a": [1.0, 2.0, 3.0, 4.0]}).where(F.col("order_week") != F.lit(week(1)))
    lagged = features.add_lags(weekly, ["units"], [1]).orderBy("order_week").collect()
    assert [r.units_lag1 for r in lagged] == [None, 1.0, 3.0]
    dense = features.add_lags(features.densify(weekly), ["units"], [1]).orderBy("order_week").collect()
    assert [(r.units, r.units_lag1) for r in dense] == [(1.0, None), (0.0, 1.0), (3.0, 0.0), (4.0, 3.0)]


def test_rolling_means_and_fill(spark):
    s = make_series(spark, {"a": [2.0, 4.0, None, 8.0, 10.0]})
    now = features.rolling_means(s, ["units"], include_current=True).orderBy("order_week").collect()
    assert [r.units_roll4 for r in now] == [2.0, 3.0, 3.0, 14 / 3, 22 / 3]
    past = features.rolling_means(s, ["units"]).orderBy("order_week").collect()
    assert [r.units_roll4 for r in past] == [None, 2.0, 3.0, 3.0, 14 / 3]
    filled = features.fill_rolling_mean(s, "units").orderBy("order_week").collect()
    assert [r.units for r in filled] == [2.0, 4.0, 3.0, 8.0, 10.0]


def test_holidays(spark):
    s = make_series(spark, {"a": [1.0, 1.0]})
    days = spark.createDataFrame([(date(2018, 1, 3),), (date(2018, 1, 8),), (date(2018, 1, 8),)], "date date")
    assert [r.is_holiday_week for r in features.holiday_flag(s, days).orderBy("order_week").collect()] == [0, 1]
    assert [r.is_holiday_week for r in features.holiday_flag(s, days, any_day=True).orderBy("order_week").collect()] == [1, 1]


# -- recursion ---------------------------------------------------------------------------------


class Formula(model.ExpressionPredictor):
    """Uses lags, rolling mean, price, trend and the revenue stand-in."""

    def expression(self, f):
        return (
            0.4 * F.coalesce(f["units_lag1"], F.lit(0.0)) + 0.2 * F.coalesce(f["units_lag4"], F.lit(1.0))
            + 0.3 * F.coalesce(f["units_roll4"], F.lit(0.0)) - 0.1 * f["avg_price"] + 0.01 * f["week_idx"]
            + 0.001 * f["revenue"] + 0.5 * f["is_holiday_week"] + 0.01 * f["rev_count"]
        )


class Stepwise:
    """The same formula as a predictor that only transforms frames."""

    def attach(self, df):
        return df

    def predict(self, df):
        return Formula().predict(df)


def brute_forecast(values, price, horizon, holidays, include_current):
    units, n = list(values), len(values)
    recent_rev = sum(i % 5 for i in range(max(0, n - 4), n)) / len(range(max(0, n - 4), n))
    out = []
    for step in range(1, horizon + 1):
        known = units[-3:] if include_current else units[-4:]
        known = [u for u in known if u is not None]
        roll = sum(known) / len(known) if known else None
        lag1 = units[-1]
        lag4 = units[-4] if len(units) >= 4 else None
        revenue = price * (lag1 if lag1 is not None else roll if roll is not None else 0.0)
        u = (
            0.4 * (lag1 or 0.0) + 0.2 * (1.0 if lag4 is None else lag4) + 0.3 * (roll or 0.0) - 0.1 * price
            + 0.01 * (n - 1 + step) + 0.001 * revenue + 0.5 * (step in holidays) + 0.01 * recent_rev
        )
        units.append(u)
        out.append(u)
    return out


@pytest.mark.parametrize("include_current", [False, True])
@pytest.mark.parametrize("predictor", [Formula(), Stepwise()])
def test_recursive_forecast_against_brute_force(spark, include_current, predictor):
    series = {"a": [float(5 + i % 7) for i in range(60)], "b": [3.0, 1.0], "c": [4.0] * 58 + [None, 2.0]}
    history = make_series(spark, series)
    plan = forecast.price_plan(history, horizon=3)
    days = spark.createDataFrame([(week(61),)], "date date")
    policy = forecast.FeaturePolicy(include_current=include_current, revenue_proxy=True)
    out = forecast.recursive_forecast(history, plan, predictor, policy, horizon=3, holidays=days)
    got = {}
    for r in out.orderBy("category", "order_week").collect():
        got.setdefault(r.category, []).append(r)
    for c, values in series.items():
        n = len(values)
        price = sum(10.0 + i % 3 for i in range(max(0, n - 4), n)) / min(4, n)
        assert [r.order_week for r in got[c]] == [week(60), week(61), week(62)]
        assert [r.units for r in got[c]] == pytest.approx(brute_forecast(values, price, 3, {2}, include_current))
        assert all(r.revenue == pytest.approx(r.avg_price * r.units) for r in got[c])


def test_linear_predictor_defaults_and_fit(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 5.0, "train"), ("a", 2.0, 7.0, "train"), ("a", 3.0, 100.0, "valid"), ("b", 2.0, 9.0, "train"), ("c", 4.0, 1.0, "valid")],
        "category string, x double, y double, split string",
    )
    lines = model.fit_linear_by_group(df.where("split = 'train'"), "y", "x")
    assert {r.category: (r.a, r.b) for r in lines.collect()} == {"a": (3.0, 2.0), "b": (0.0, 1.0)}
    joined = model.score(model.LinearPredictor(lines, "x"), df)
    one_pass = model.fit_score_linear(df, "y", "x")
    expected = {("a", 1.0): 5.0, ("a", 2.0): 7.0, ("a", 3.0): 9.0, ("b", 2.0): 2.0, ("c", 4.0): 4.0}
    for scored in (joined, one_pass):
        assert {(r.category, r.x): r.prediction for r in scored.collect()} == pytest.approx(expected)


def test_tree_model_beats_the_rolling_mean_and_survives_saving(spark, tmp_path):
    # level, price effect and a yearly pattern the rolling mean cannot follow
    data = []
    for c, base in (("a", 40.0), ("b", 80.0)):
        for i in range(120):
            price = 10.0 + (i * 7 + len(c)) % 5
            units = base + 15.0 * ((i % 4) - 1.5) - 3.0 * (price - 12.0)
            data.append((c, week(i), units, units * price, price, 1.0, 4.0))
    full = features.weekly_features(spark.createDataFrame(data, SCHEMA))
    table = features.time_split(features.warmup_trim(full)).cache()
    params = model.TreeParams(max_iter=12, max_depth=4)
    fitted = model.train_demand_model(table, params=params)
    assert "revenue" not in fitted.features and "revenue_lag1" in fitted.features
    scored = model.score(fitted, table)
    assert set(scored.columns) == set(table.columns) | {"prediction"}
    valid = scored.where("split = 'valid'")
    mae, naive = valid.agg(
        F.avg(F.abs(F.col("units") - F.col("prediction"))), F.avg(F.abs(F.col("units") - F.col("units_roll4")))
    ).head()
    assert mae < naive
    fitted.save(str(tmp_path / "m"))
    loaded = model.DemandModel.load(str(tmp_path / "m"))
    assert loaded.features == fitted.features
    assert loaded.predict(table).agg(F.sum("prediction")).head() == scored.agg(F.sum("prediction")).head()
    unseen = table.limit(1).withColumn("category", F.lit("new"))
    assert fitted.predict(unseen).head().prediction is not None
    with pytest.raises(ValueError):
        model.train_demand_model(table.where("split = 'train'"), params=params)
