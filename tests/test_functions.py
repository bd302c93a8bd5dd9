import statistics
from collections import Counter
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weekloom.functions.columns import mean_of, parse_date, scenario_key, week_start
from weekloom.functions.grouped import exact_medians, modes
from weekloom.sources import tables
from weekloom.sources.schemas import FORECAST_ALIASES, names, schema


def test_exact_medians_on_a_hot_group(spark, rows):
    data = [("hot", float(i * i % 977) - 300.5) for i in range(4000)] + [("small", 3.0), ("small", None), ("two", 1.0), ("two", 4.0)]
    data += [("none", None), (None, 5.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r["v"] for r in rows(exact_medians(df, ["g"], ["v"]))}
    expected = {
        g: statistics.median([v for k, v in data if k == g and v is not None]) for g in ("hot", "small", "two")
    }
    assert got == expected
    overall = exact_medians(df, [], ["v"]).head().v
    assert overall == statistics.median([v for _, v in data if v is not None])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-1e9, 1e9) | st.sampled_from([0.0, 1.0, -1.0])), min_size=1, max_size=60))
def test_exact_medians_any_values(spark, data):
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.v for r in exact_medians(df, ["g"], ["v"]).collect()}
    for g in {g for g, _ in data}:
        assert got[g] == pytest.approx(statistics.median([v for k, v in data if k == g]), rel=1e-12, abs=1e-12)


def test_modes_take_the_smallest_on_ties(spark):
    data = [("z", "b", None), ("z", "a", None), ("z", "b", "q"), ("z", "a", "p"), ("y", None, None)]
    df = spark.createDataFrame(data, "k string, c string, s string")
    got = {r.k: (r.c, r.s) for r in modes(df, ["k"], ["c", "s"]).collect()}
    assert got == {"z": ("a", "p"), "y": (None, None)}
    best = Counter(c for _, c, _ in data if c).most_common()[0][1]
    assert best == 2


def test_dates(spark):
    df = spark.createDataFrame(
        [("05-02-2018 13:45",), ("05/02/2018",), ("2018-02-05",), ("2018-02-05 01:02:03",), ("bad",), (None,)], "d string"
    )
    monday = date(2018, 2, 5)
    assert [r.d for r in df.select(parse_date("d").alias("d")).collect()] == [monday] * 4 + [None] * 2
    days = spark.createDataFrame([(date(2018, 2, 5),), (date(2018, 2, 11),), (date(2017, 1, 1),)], "d date")
    assert [r.w for r in days.select(week_start("d").alias("w")).collect()] == [monday, monday, date(2016, 12, 26)]


def test_small_expressions(spark):
    row = spark.range(1).select(
        mean_of([F.lit(2.0), F.lit(None).cast("double"), F.lit(4.0)]).alias("m"),
        mean_of([F.lit(None).cast("double")]).alias("n"),
        scenario_key(F.lit(-0.15)).alias("k"),
    ).head()
    assert (row.m, row.n, row.k) == (3.0, None, -1500)


def test_standardize_columns(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "` Week ` int, Cat string, UNITS_PRED double")
    assert tables.standardize_columns(df, FORECAST_ALIASES).columns == ["order_week", "category", "units_base"]
    both = spark.createDataFrame([("x", "y")], "category string, cat string")
    assert tables.standardize_columns(both, FORECAST_ALIASES).columns == ["category", "cat"]


def test_csv_round_trip(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text("﻿order_id,price,product_id,seller_id,freight_value\no1,12.5,p1,s1,abc\no2,,p2,s2,3\n", encoding="utf-8")
    df = tables.read_csv(spark, str(path), "order_items")
    assert df.schema.fieldNames() == schema("order_items").fieldNames()
    got = {r.order_id: (r.price, r.freight_value, r.order_item_id) for r in df.collect()}
    assert got == {"o1": (12.5, None, None), "o2": (None, 3.0, None)}
    for fmt in ("parquet", "csv"):
        tables.write_table(df.select("order_id", "price"), str(tmp_path / fmt), fmt)
    assert tables.read_parquet(spark, str(tmp_path / "parquet")).count() == 2
    assert tables.read_csv(spark, str(tmp_path / "csv"), "order_items").where("price = 12.5").count() == 1
    with pytest.raises(ValueError):
        tables.write_table(df, str(tmp_path / "x"), "xlsx")


def test_first_table_and_empty_table(spark):
    spark.range(3).createOrReplaceTempView("present_table")
    assert tables.first_table(spark, ["absent_table", "present_table"]).count() == 3
    assert tables.first_table(spark, ["absent_table"], optional=True) is None
    with pytest.raises(LookupError):
        tables.first_table(spark, ["absent_table"])
    empty = tables.table_or_empty(spark, ["absent_table"], "reviews_by_order")
    assert empty.count() == 0 and empty.schema == schema("reviews_by_order")
    assert {"orders", "order_items", "geolocation"} <= set(names())


def test_clean_predictions(spark, rows):
    df = spark.createDataFrame(
        [("05-02-2018", "a", "3", 2.5), ("2018-02-12", "a", "x", 1.0), ("bad", "a", "1", 1.0), ("2018-02-19", "a", "1", float("nan"))],
        "order_week string, product_category_name_english string, actual_units string, pred_units double",
    )
    got = rows(tables.clean_predictions(df))
    assert got == [{"order_week": date(2018, 2, 5), "category": "a", "y": 3.0, "yhat": 2.5}]
    with pytest.raises(ValueError):
        tables.clean_predictions(df.drop("pred_units"))


def test_medians_of_many_values_in_one_bin(spark):
    # all values lie within a thousandth, so in one or two bins; the ordered part stays small
    from weekloom.functions.grouped import bin_counts, binned_values, count_values, exact_medians, middle_bins

    df = spark.range(40_001).select((F.col("id") % 2).alias("g"), (F.lit(1000.0) + F.col("id") * 1e-5).alias("v"))
    got = {r.g: r.v for r in exact_medians(df, ["g"], ["v"]).collect()}
    assert got[0] == pytest.approx(1000.2, abs=1e-9) and got[1] == pytest.approx(1000.2, abs=1e-9)
    binned = binned_values(df, ["g"], ["v"])
    counted = count_values(binned, middle_bins(bin_counts(binned, ["g"]), ["g"]), ["g"])
    part = F.floor((F.asinh("value") * 1000 - F.col("bin")) * 4096)
    largest = counted.groupBy("g", "bin", part).count().agg(F.max("count")).head()[0]
    assert counted.groupBy("g", "bin").count().agg(F.max("count")).head()[0] > 4000 and largest < 20
    alone = exact_medians(df, [], ["v"]).head()
    assert alone.v == pytest.approx(1000.2, abs=1e-9)


@pytest.mark.parametrize("filled", [False, True])
def test_group_and_overall_medians_equal_sorted_values(spark, filled):
    import random
    from statistics import median

    from weekloom.functions.grouped import group_and_overall_medians

    rng = random.Random(6)
    for _ in range(4):
        spread = rng.choice([1e-6, 1.0, 1e6])
        data = [(rng.choice(["a", "b", "c", None]), None if rng.random() < 0.4 else round(rng.gauss(0, spread), rng.choice([0, 9]))) for _ in range(rng.choice([3, 60, 301]))]
        data += [("hot", 5.0)] * rng.choice([0, 400]) + [("empty", None)] * 3
        of = {g: [v for k, v in data if k == g and v is not None] for g, _ in data if g is not None}
        groups = {g: median(v) for g, v in of.items() if v}
        known = [v for _, v in data if v is not None]
        if filled:
            known += [groups[g] for g, v in data if v is None and g in groups]
        by_group, overall = group_and_overall_medians(spark.createDataFrame(data, "g string, v double"), "g", ["v"], filled)
        assert {r.g: r.v for r in by_group.collect()} == pytest.approx(groups, rel=1e-12, abs=1e-300)
        assert overall.head().v == pytest.approx(median(known), rel=1e-12, abs=1e-300)


def test_medians_read_the_data_twice(spark):
    from weekloom.functions.grouped import group_and_overall_medians

    reads = spark.sparkContext.accumulator(0)
    seen = spark.range(200, numPartitions=2).rdd.map(lambda r: reads.add(1) or (str(r[0] % 3), float(r[0])))
    by_group, overall = group_and_overall_medians(spark.createDataFrame(seen, "g string, v double"), "g", ["v"], True)
    assert by_group.count() == 3 and overall.head().v == 99.5 and reads.value == 400
