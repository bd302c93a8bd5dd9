"""Audit reports and cleaning steps over the raw roles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, rounded, rs
from weekloom.operators import audit, cleaning
from weekloom.sources.schemas import AUDITED_COLUMNS


def _missing_sql(name: str, cte: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", count(*) - count({c}) AS n_missing,"
        f" (count(*) - count({c})) / count(*) AS pct_missing, count(*) AS n_rows FROM {cte}"
        for c in columns
    )


_CTE_OF = {
    "orders": "orders_raw",
    "order_items": "items_raw",
    "products": "products_english",
    "payments": "payments_raw",
    "reviews": "reviews_raw",
    "customers": "customers_raw",
    "sellers": "sellers_raw",
    "geolocation": "geolocation_raw",
}


def _with_english(t):
    return t.products_raw.join(t.translation, "product_category_name", "left")


_ENGLISH = """WITH products_english AS (SELECT p.*, english AS product_category_name_english
  FROM products_raw p LEFT JOIN translation USING (product_category_name)) """


@query("a1_missingness_report", _missing_sql("order_items", "items_raw", AUDITED_COLUMNS["order_items"]))
def _(t):
    return audit.missingness_report(t.items_raw, AUDITED_COLUMNS["order_items"], "order_items")


@query(
    "a2_missingness_summary",
    _ENGLISH + " UNION ALL ".join(_missing_sql(n, cte, AUDITED_COLUMNS[n]) for n, cte in _CTE_OF.items()),
)
def _(t):
    tables = {
        "orders": t.orders_raw,
        "order_items": t.items_raw,
        "products": _with_english(t),
        "payments": t.payments_raw,
        "reviews": t.reviews_raw,
        "customers": t.customers_raw,
        "sellers": t.sellers_raw,
        "geolocation": t.geolocation_raw,
    }
    return audit.missingness_summary(tables, AUDITED_COLUMNS)


@query(
    "a3_status_counts",
    "SELECT order_status, count(*) AS \"count\" FROM orders_raw WHERE order_status IS NOT NULL GROUP BY 1",
)
def _(t):
    return audit.status_counts(t.orders_raw, "order_status")


@query(
    "a4_dataset_overview",
    """SELECT CAST(o.a AS VARCHAR) AS orders_date_min, CAST(o.b AS VARCHAR) AS orders_date_max, o.n AS orders_total,
      (SELECT count(*) FROM items_raw) AS order_items_rows, (SELECT count(*) FROM products_raw) AS products_rows,
      (SELECT count(*) FROM payments_raw) AS payments_rows, (SELECT count(*) FROM customers_raw) AS customers_rows,
      (SELECT count(*) FROM sellers_raw) AS sellers_rows, (SELECT count(*) FROM geolocation_raw) AS geolocation_rows,
      v.k AS reviews_rows, v.n / greatest(1, o.n) AS orders_with_reviews_pct, false AS qty_column_present_in_items
    FROM (SELECT min(order_purchase_timestamp) AS a, max(order_purchase_timestamp) AS b,
            count(DISTINCT order_id) AS n FROM orders_raw) o,
         (SELECT count(DISTINCT order_id) AS n, count(*) AS k FROM reviews_raw) v""",
)
def _(t):
    overview = audit.dataset_overview(
        {
            "orders": t.orders_raw,
            "order_items": t.items_raw,
            "products": t.products_raw,
            "payments": t.payments_raw,
            "reviews": t.reviews_raw,
            "customers": t.customers_raw,
            "sellers": t.sellers_raw,
            "geolocation": t.geolocation_raw,
        }
    )
    return overview.withColumns({c: F.col(c).cast("string") for c in ("orders_date_min", "orders_date_max")})


@query("b1_translate_category", "SELECT product_id, product_category_name, category FROM products_named")
def _(t):
    named = cleaning.translate_category(t.products_raw, t.translation)
    return named.select("product_id", "product_category_name", "category")


_DIMS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


@query(
    "b2_impute_by_group_median",
    f"SELECT product_id, product_category_name, category, {rs(6, *_DIMS)} FROM products_clean",
)
def _(t):
    return rounded(t.clean_products(), 6, *_DIMS)


@query("b3_geo_reference", f"SELECT zip, geo_city, geo_state, {rs(6, 'geo_lat', 'geo_lng')} FROM geo_ref")
def _(t):
    return rounded(cleaning.geo_reference(t.geolocation_raw), 6, "geo_lat", "geo_lng")


@query("b4_fill_from_reference", "SELECT * FROM customers_clean")
def _(t):
    return t.clean_customers()


@query("b4_fill_from_reference_sellers", "SELECT * FROM sellers_clean")
def _(t):
    return t.clean_sellers()


@query(
    "b5_delivery_duration",
    "SELECT order_id, order_status, purchase_to_delivery_days FROM orders_clean",
)
def _(t):
    return cleaning.delivery_duration(t.orders_raw).select("order_id", "order_status", "purchase_to_delivery_days")


@query("b6_flag_valid_sales", "SELECT order_id, order_status, is_valid_for_sales FROM orders_clean")
def _(t):
    return cleaning.flag_valid_sales(t.orders_raw).select("order_id", "order_status", "is_valid_for_sales")


@query(
    "b7_clean_items",
    f"""SELECT order_id, product_id, seller_id, seller_state, units, price, {rs(6, 'freight_value')}
    FROM items_checked WHERE price IS NOT NULL""",
)
def _(t):
    items, _ = cleaning.clean_items(t.items_raw, t.sellers)
    columns = ["order_id", "product_id", "seller_id", "seller_state", "units", "price", "freight_value"]
    return rounded(items.select(*columns), 6, "freight_value")


@query("b7_clean_items_dropped", "SELECT count(*) AS n_dropped FROM items_checked WHERE price IS NULL")
def _(t):
    return cleaning.dropped_items(t.items_raw)


@query("b8_payments_by_order", "SELECT * FROM payment_totals")
def _(t):
    return t.payments


@query("b9_reviews_by_order", f"SELECT order_id, review_count, {rs(6, 'review_score_avg')} FROM review_totals")
def _(t):
    return rounded(t.reviews, 6, "review_score_avg")


@query(
    "b10_build_fact",
    f"""SELECT * EXCLUDE (order_purchase_timestamp, freight_value, freight, product_weight_g, product_length_cm,
      product_height_cm, product_width_cm, review_score_avg),
      {rs(6, 'freight_value', 'freight', *_DIMS, 'review_score_avg')} FROM fact_clean""",
)
def _(t):
    fact = t.fact_clean.drop("order_purchase_timestamp")
    return rounded(fact, 6, "freight_value", "freight", *_DIMS, "review_score_avg")


@query(
    "b11_cleaning_log",
    """SELECT (SELECT count(*) FROM items_checked WHERE price IS NULL) AS dropped_items_price_na,
      (SELECT count(*) FROM fact_clean) AS remaining_fact_rows,
      (SELECT count(*) FROM products_clean WHERE category = 'unknown') AS products_missing_english_category_now,
      (SELECT count(*) FROM customers_clean WHERE customer_state IS NULL) AS customers_missing_state_after_fill,
      (SELECT count(*) FROM sellers_clean WHERE seller_state IS NULL) AS sellers_missing_state_after_fill""",
)
def _(t):
    return t.cleaning_log()
