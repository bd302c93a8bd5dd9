"""The whole job over raw CSV files made from the driver's tables, and the missing-value rules."""

import os

import pytest
from pyspark.sql import functions as F

from weekloom import pipeline
from weekloom.functions.columns import money_avg, money_sum, number
from weekloom.operators import cleaning, features, forecast, model
from weekloom.session import stage, staging_root, staging_scope, unstage
from weekloom.sources import runs
from weekloom.sources.schemas import schema
from weekloom.sources.star import StarTables
from weekloom.sources.tables import first_file, read_csv, write_table

NAN = float("nan")


def raw_files(spark, folder):
    """The star roles under the declared schemas, as CSV with the declared column names."""
    star = StarTables(spark, "/root/testdata/sf0.001")
    products = star.products_raw.withColumn("product_category_name", F.element_at(F.split("product_category_name", " "), 1))
    roles = {
        "orders": star.orders_raw, "order_items": star.items_raw, "products": products, "category_translation": star.translation,
        "payments": star.payments_raw, "reviews": star.reviews_raw, "customers": star.customers_raw, "sellers": star.sellers_raw,
        "geolocation": star.geolocation_raw,
    }
    for name, df in roles.items():
        known = [f.name for f in schema(name).fields if f.name in df.columns]
        write_table(df.select(*known), f"{folder}/{name}.csv", "csv")
    write_table(star.holidays, f"{folder}/holidays.parquet")
    return roles


def test_the_whole_job(spark, tmp_path):
    roles = raw_files(spark, tmp_path / "raw")
    other = stage(spark.range(5), "other")
    before = set(os.listdir(staging_root(spark)))
    names = pipeline.run(spark, str(tmp_path / "raw"), str(tmp_path / "out"), model.TreeParams(max_iter=5, max_depth=3))
    out = runs.published(spark, str(tmp_path / "out"))
    assert set(out) == set(names) and runs.incomplete(spark, str(tmp_path / "out")) == []
    assert out["rejected_values"].count() == 0 and out["cleaning_log"].count() == 1
    assert len(names) == len(set(names)) and all(df.columns for df in out.values())
    assert set(os.listdir(staging_root(spark))) == before and other.count() == 5
    series = {r.category for r in out["weekly_by_category"].select("category").distinct().collect()}
    keys = out["forecast"].groupBy("category").agg(F.countDistinct("order_week").alias("n")).collect()
    assert {(r.category, r.n) for r in keys} == {(c, forecast.HORIZON) for c in series}
    assert out["scenarios_detailed"].count() == len(series) * forecast.HORIZON * 7
    assert out["forecast_checks"].where("violations > 0").count() == 0
    sold = roles["orders"].where("order_status IN ('delivered', 'shipped')").select("order_id")
    priced = roles["order_items"].where("price > 0 AND NOT isnan(price) AND order_id IS NOT NULL AND seller_id IS NOT NULL")
    assert out["fact_orders_clean"].count() == priced.join(sold, "order_id", "left_semi").count()
    units = out["weekly_by_category"].agg(F.sum("units")).head()[0]
    assert 0 < units <= out["fact_orders_clean"].count()


def test_nan_is_missing(spark, tmp_path):
    df = spark.createDataFrame([("a", NAN), ("a", 3.0), ("a", None), ("b", 2.0), ("b", 2.0)], "g string, v double")
    filled = sorted((r.g, r.v) for r in cleaning.impute_by_group_median(df, ["v"], "g").collect())
    assert filled == [("a", 3.0), ("a", 3.0), ("a", 3.0), ("b", 2.0), ("b", 2.0)]
    assert df.agg(money_sum("v").alias("s"), money_avg("v").alias("m")).head() == (7.0, 7.0 / 3)
    texts = spark.createDataFrame([("NaN",), ("1.5",), ("x",)], "v string")
    assert [r.n for r in texts.select(number("v").alias("n")).collect()] == [None, 1.5, None]
    (tmp_path / "margins.csv").write_text("margin_rate,category\nNaN,a\n0.2,b\n")
    read = read_csv(spark, str(tmp_path / "margins.csv"), "margins")
    assert {r.category: r.margin_rate for r in read.collect()} == {"a": None, "b": 0.2}
    items = spark.createDataFrame([("1", "p", "s", NAN, 1.0), ("1", "p", "s", 2.0, NAN)], "order_id string, product_id string, seller_id string, price double, freight_value double")
    assert cleaning.dropped_items(items).head()[0] == 1


def test_first_file_that_exists(spark, tmp_path):
    write_table(spark.createDataFrame([("a", 0.5)], "category string, margin_rate double"), str(tmp_path / "m.parquet"))
    paths = [str(tmp_path / "none.csv"), str(tmp_path / "m.parquet")]
    assert first_file(spark, paths, "margins").head().margin_rate == 0.5
    assert first_file(spark, paths[:1], "margins", optional=True) is None
    with pytest.raises(LookupError):
        first_file(spark, paths[:1], "margins")


def test_forecasts_lose_no_series_and_no_week(spark):
    star = StarTables(spark, "/root/testdata/sf0.001")
    weekly, predictor = star.series, model.RollingMeanPredictor()
    plan = forecast.price_plan(weekly)
    first = plan.agg(F.min("order_week")).head()[0]
    some = plan.where((F.col("category") != "Brand#7") & (F.col("order_week") != first)).withColumn("planned_price", F.lit(1.0))
    n = weekly.select("category").distinct().count()
    for given in (plan, some, None):
        out = forecast.recursive_forecast(weekly, given, predictor)
        assert out.count() == n * forecast.HORIZON and out.where("avg_price IS NULL OR units IS NULL").count() == 0
    prices = {(r.category, r.order_week): r.avg_price for r in forecast.recursive_forecast(weekly, some, predictor).collect()}
    assert {p for (c, w), p in prices.items() if c != "Brand#7" and w != first} == {1.0}
    assert all(p != 1.0 for (c, w), p in prices.items() if c == "Brand#7" or w == first)
    assert features.weekly_features(weekly, star.holidays).count() == weekly.count()


def test_staged_tables_have_an_owner(spark):
    folders = lambda: set(os.listdir(staging_root(spark)))
    other = stage(spark.range(3), "other")
    before = folders()
    with pytest.raises(ValueError), staging_scope(spark):
        stage(spark.range(1), "inner")
        raise ValueError
    assert folders() == before
    with staging_scope(spark):
        inner = stage(spark.range(4), "inner")
        with staging_scope(spark):
            kept = stage(inner, "kept", keep=True)
            stage(inner, "innermost")
        assert inner.count() == 4
    assert len(folders()) == len(before) + 1 and kept.count() == 4 and other.count() == 3
    unstage(kept)
    unstage(spark.range(2))
    assert folders() == before and other.count() == 3
