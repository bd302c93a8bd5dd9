from datetime import datetime

import pytest

from weekloom.operators import audit, cleaning


def test_missingness_counts_null_and_nan(spark, rows):
    df = spark.createDataFrame([(None, float("nan")), ("a", 1.0), ("b", None)], "s string, v double")
    got = rows(audit.missingness_report(df, ["s", "v"], "t"), "column")
    assert [(r["column"], r["n_missing"], r["n_rows"]) for r in got] == [("s", 1, 3), ("v", 2, 3)]
    empty = rows(audit.missingness_report(df.limit(0), ["s"], "t"))
    assert empty[0]["pct_missing"] is None and empty[0]["n_rows"] == 0


def test_overview_without_orders(spark):
    orders = spark.createDataFrame([], "order_id string, order_purchase_timestamp timestamp_ntz")
    reviews = spark.createDataFrame([("o",)], "order_id string")
    items = spark.createDataFrame([("o", 2)], "order_id string, Quantity int")
    row = audit.dataset_overview({"orders": orders, "reviews": reviews, "order_items": items}).head()
    assert row.orders_total == 0 and row.orders_with_reviews_pct == 1.0
    assert row.order_items_rows == 1 and row.qty_column_present_in_items


def test_delivery_days_round_down(spark):
    t = datetime(2018, 1, 10, 12)
    data = [
        ("delivered", t, datetime(2018, 1, 12, 11)),
        ("delivered", t, datetime(2018, 1, 10, 11)),
        ("delivered", t, None),
        ("shipped", t, datetime(2018, 1, 12, 13)),
    ]
    df = spark.createDataFrame(
        data, "order_status string, order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz"
    )
    days = [r.purchase_to_delivery_days for r in cleaning.delivery_duration(df).collect()]
    assert days == [1, -1, None, None]


def test_imputation_order_of_steps(spark):
    data = [("a", 10.0), ("a", 20.0), ("a", -5.0), ("a", None), ("b", 0.0), (None, None), ("c", 70.0)]
    df = spark.createDataFrame(data, "g string, v double")
    out = cleaning.impute_by_group_median(df, ["v"], "g").collect()
    by = {}
    for r in out:
        by.setdefault(r.g, []).append(r.v)
    assert sorted(by["a"]) == [10.0, 15.0, 15.0, 20.0]
    assert by["b"] == [20.0] and by[None] == [20.0]  # median of 10, 20, 70
    zero = cleaning.impute_by_group_median(df, ["v"], "g", allow_zero=True, fallback="filled").collect()
    # after filling: a = 10, 15, 15, 20; b = 0; c = 70
    assert [r.v for r in zero if r.g is None] == [15.0]
    with pytest.raises(ValueError):
        cleaning.impute_by_group_median(df, ["v"], "g", fallback="other")


def test_fill_from_reference(spark, rows):
    ref = spark.createDataFrame([("1", "city1", "S1")], "zip string, geo_city string, geo_state string")
    df = spark.createDataFrame(
        [(1, 1, None, None), (2, 9, None, None), (3, 9, "c", "S2"), (4, 1, None, None)],
        "id int, z int, city string, state string",
    )
    got = rows(cleaning.fill_from_reference(df, ref, "z", "city", "state"), "id")
    assert [(r["city"], r["state"]) for r in got] == [
        ("city1", "S1"), ("unknown_city", "S1"), ("c", "S2"), ("city1", "S1"),
    ]


def test_clean_items(spark):
    sellers = spark.createDataFrame([("s1", "c", "X")], "seller_id string, seller_city string, seller_state string")
    items = spark.createDataFrame(
        [("o1", "p", "s1", "10", "1"), ("o2", "p", "s1", "-1", "2"), ("o3", "p", "s1", "x", "3"),
         (None, "p", "s1", "5", "1"), ("o4", "p", "s9", "7", "-2")],
        "order_id string, product_id string, seller_id string, price string, freight_value string",
    )
    clean, dropped = cleaning.clean_items(items, sellers)
    got = {r.order_id: (r.price, r.freight_value, r.units) for r in clean.collect()}
    assert got == {"o1": (10.0, 1.0, 1), "o4": (7.0, 2.0, 1)}
    assert dropped.head().n_dropped == 2


def test_payments_and_reviews(spark):
    pay = spark.createDataFrame(
        [("o", None, None, None), ("o", "CREDIT_card", 3, 5.5), ("p", "voucher", 1, 2.0)],
        "order_id string, payment_type string, payment_installments int, payment_value double",
    )
    got = {r.order_id: tuple(r)[1:] for r in cleaning.payments_by_order(pay).collect()}
    assert got == {"o": (5.5, 2, 3, 1), "p": (2.0, 1, 1, 0)}
    rev = spark.createDataFrame(
        [("r1", "o", "5", None), ("r2", "o", "x", "t"), (None, "o", "2", None)],
        "review_id string, order_id string, review_score string, review_comment_title string",
    )
    assert [r.review_comment_title for r in cleaning.tidy_reviews(rev).collect()] == ["", ""]
    row = cleaning.reviews_by_order(rev).head()
    assert (row.review_count, row.review_score_avg) == (1, 3.5)


def test_fact_keeps_one_row_per_item(spark):
    from weekloom.sources.star import StarTables

    t = StarTables(spark, "/root/testdata/sf0.001")
    valid = t.orders.where("is_valid_for_sales").select("order_id")
    items, _ = cleaning.clean_items(t.items_raw, t.sellers)
    assert t.fact_clean.count() == items.join(valid, "order_id", "left_semi").count()
