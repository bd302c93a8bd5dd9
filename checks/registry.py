"""Registry of queries and their SQL, and the shared SQL building blocks."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.sources.star import HOLIDAY_DAYS, TRANSLATION, StarTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
CTES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of StarTables under ``name``."""

    def register(build: Callable[[StarTables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(StarTables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def r(expr: str, digits: int, name: str | None = None) -> str:
    """SQL for a rounded value; a negative zero becomes zero as in Spark."""
    value = f"round({expr}, {digits})"
    return f"CASE WHEN {value} = 0 THEN 0.0::DOUBLE ELSE {value} END AS {name or expr}"


def rs(digits: int, *cols: str) -> str:
    return ", ".join(r(c, digits) for c in cols)


def line(part: str, y: str, x: str) -> str:
    """Slope or intercept in SQL; identity where the fit is degenerate (NULL or NaN)."""
    default = "1.0" if part == "slope" else "0.0"
    return f"coalesce(nullif(regr_{part}({y}, {x}), 'nan'::DOUBLE), {default})"


def _mentioned(text: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{name}\b", text)]


def full_sql(body: str) -> str:
    """``body`` preceded by the building blocks it uses, in order of dependence."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in _mentioned(CTES[name]):
            if other != name:
                visit(other)
        order.append(name)

    for name in _mentioned(body):
        visit(name)
    if not order:
        return body
    recursive = "RECURSIVE " if "UNION ALL SELECT" in " ".join(CTES[n] for n in order) + body else ""
    blocks = ",\n".join(f"{name} AS ({CTES[name]})" for name in order)
    inner = body.strip()
    if inner.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {blocks},\n{inner[len('WITH RECURSIVE '):]}"
    if inner.upper().startswith("WITH "):
        return f"WITH {recursive}{blocks},\n{inner[len('WITH '):]}"
    return f"WITH {recursive}{blocks}\n{inner}"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


CTES["translation"] = f"SELECT * FROM (VALUES {_values(TRANSLATION)}) v(product_category_name, english)"
CTES["holidays"] = """SELECT CAST(y || '-' || d AS DATE) AS date FROM (VALUES {}) v(d),
  (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 2)) AS y FROM orders)""".format(
    _values([(d,) for d in HOLIDAY_DAYS])
)
CTES["orders_raw"] = """
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'delivered'
         WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
    o_orderdate AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate + to_hours(CAST(o_orderkey * 7 % 700 - 30 AS BIGINT)) END
      AS order_delivered_customer_date,
    o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date
  FROM orders"""
CTES["items_raw"] = """
  SELECT CASE WHEN l_orderkey % 101 <> 0 THEN l_orderkey END AS order_id, l_partkey AS product_id,
    CASE WHEN l_suppkey % 23 <> 0 THEN l_suppkey END AS seller_id,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN -l_extendedprice
         ELSE l_extendedprice END AS price,
    CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 17 = 0 THEN -1.0
         ELSE l_extendedprice * l_tax END AS freight_value,
    l_quantity AS units
  FROM lineitem"""
CTES["products_raw"] = """
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 13 <> 0 THEN p_type END AS product_category_name,
    CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN -1.0
         ELSE CAST(p_size * 10 AS DOUBLE) END AS product_weight_g,
    CASE WHEN p_partkey % 6 = 0 THEN 0.0 ELSE CAST(p_size + p_partkey % 10 AS DOUBLE) END AS product_length_cm,
    CASE WHEN p_partkey % 9 <> 0 THEN p_retailprice END AS product_height_cm,
    CAST(p_size AS DOUBLE) AS product_width_cm
  FROM part"""
CTES["payments_raw"] = """
  SELECT l_orderkey AS order_id,
    CASE l_returnflag WHEN 'R' THEN 'Credit_Card' WHEN 'A' THEN 'boleto' END AS payment_type,
    CASE WHEN l_linenumber <> 3 THEN l_linenumber END AS payment_installments,
    CASE WHEN l_orderkey % 9 <> 0 THEN l_extendedprice * (1 - l_discount) END AS payment_value
  FROM lineitem"""
CTES["reviews_raw"] = """
  SELECT o_orderkey AS review_id, o_orderkey AS order_id,
    CASE WHEN o_orderkey % 5 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) END AS review_score,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS review_comment_title,
    CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS review_comment_message
  FROM orders
  UNION ALL
  SELECT o_orderkey + 1000000000, o_orderkey, CAST(o_custkey % 5 + 1 AS DOUBLE), NULL, NULL
  FROM orders WHERE o_orderkey % 4 = 0"""
CTES["customers_raw"] = """
  SELECT c_custkey AS customer_id, CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
    CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS customer_city,
    CASE WHEN c_custkey % 3 <> 0 THEN n_name END AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""
CTES["sellers_raw"] = """
  SELECT s_suppkey AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
    CASE WHEN s_suppkey % 5 <> 0 THEN n_name END AS seller_city,
    CASE WHEN s_suppkey % 4 <> 0 THEN n_name END AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
CTES["geolocation_raw"] = """
  SELECT CASE WHEN c_nationkey % 6 = 0 THEN 'N' ELSE '' END || c_nationkey AS geolocation_zip_code_prefix, c_acctbal AS geolocation_lat,
    CAST(c_custkey % 360 - 180 AS DOUBLE) AS geolocation_lng, c_mktsegment AS geolocation_city,
    'R' || (c_custkey % 4) AS geolocation_state
  FROM customer"""

CTES["products_named"] = """
  SELECT p.*, coalesce(english, 'unknown') AS category
  FROM products_raw p LEFT JOIN translation USING (product_category_name)"""
_DIMS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
CTES["products_valid"] = "SELECT product_id, product_category_name, category, " + ", ".join(
    f"CASE WHEN {c} > 0 THEN {c} END AS {c}" for c in _DIMS
) + " FROM products_named"
CTES["products_clean"] = (
    "SELECT product_id, product_category_name, v.category, "
    + ", ".join(f"coalesce(v.{c}, m.{c}, g.{c}) AS {c}" for c in _DIMS)
    + " FROM products_valid v LEFT JOIN (SELECT category, "
    + ", ".join(f"median({c}) AS {c}" for c in _DIMS)
    + " FROM products_valid GROUP BY category) m ON v.category = m.category, (SELECT "
    + ", ".join(f"median({c}) AS {c}" for c in _DIMS)
    + " FROM products_valid) g"
)
CTES["geo_ref"] = """
  SELECT p.zip, geo_city, geo_state, geo_lat, geo_lng FROM
    (SELECT geolocation_zip_code_prefix AS zip, avg(geolocation_lat) AS geo_lat, avg(geolocation_lng) AS geo_lng
     FROM geolocation_raw GROUP BY 1) p
    JOIN (SELECT zip, geo_city FROM
      (SELECT geolocation_zip_code_prefix AS zip, geolocation_city AS geo_city,
         row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY count(*) DESC, geolocation_city) AS k
       FROM geolocation_raw GROUP BY 1, 2) WHERE k = 1) c ON c.zip = p.zip
    JOIN (SELECT zip, geo_state FROM
      (SELECT geolocation_zip_code_prefix AS zip, geolocation_state AS geo_state,
         row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY count(*) DESC, geolocation_state) AS k
       FROM geolocation_raw GROUP BY 1, 2) WHERE k = 1) s ON s.zip = p.zip"""


def _filled(raw: str, who: str, key: str) -> str:
    return f"""
  SELECT {key}, {who}_zip_code_prefix, {who}_city, coalesce({who}_state, common.state) AS {who}_state FROM
    (SELECT {key}, {who}_zip_code_prefix, coalesce({who}_city, geo_city, 'unknown_city') AS {who}_city,
       coalesce({who}_state, geo_state) AS {who}_state
     FROM {raw} LEFT JOIN geo_ref ON zip = {who}_zip_code_prefix) f,
    (SELECT state FROM (SELECT coalesce({who}_state, geo_state) AS state
       FROM {raw} LEFT JOIN geo_ref ON zip = {who}_zip_code_prefix)
     WHERE state IS NOT NULL GROUP BY state ORDER BY count(*) DESC, state LIMIT 1) common"""


CTES["customers_clean"] = _filled("customers_raw", "customer", "customer_id")
CTES["sellers_clean"] = _filled("sellers_raw", "seller", "seller_id")
CTES["orders_clean"] = """
  SELECT *, CASE WHEN order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL THEN
      CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000) AS BIGINT)
    END AS purchase_to_delivery_days,
    coalesce(order_status IN ('delivered', 'shipped', 'invoiced'), false) AS is_valid_for_sales
  FROM orders_raw"""
CTES["items_valid"] = """
  SELECT i.order_id, i.product_id, i.seller_id, CASE WHEN price > 0 THEN price END AS price,
    CASE WHEN freight_value >= 0 THEN freight_value END AS freight_value, units, seller_state
  FROM items_raw i LEFT JOIN sellers_clean s ON s.seller_id = i.seller_id
  WHERE i.order_id IS NOT NULL AND i.product_id IS NOT NULL AND i.seller_id IS NOT NULL"""
CTES["items_filled"] = """
  SELECT order_id, product_id, seller_id, price, coalesce(freight_value, m) AS freight_value, units, v.seller_state
  FROM items_valid v LEFT JOIN (SELECT seller_state, median(freight_value) AS m FROM items_valid
    WHERE seller_state IS NOT NULL GROUP BY 1) s ON s.seller_state = v.seller_state"""
CTES["items_checked"] = """
  SELECT order_id, product_id, seller_id, price, coalesce(freight_value, m) AS freight_value, units, seller_state
  FROM items_filled, (SELECT median(freight_value) AS m FROM items_filled) g"""
CTES["payment_totals"] = """
  SELECT order_id, CAST(sum(CAST(coalesce(payment_value, 0) AS DECIMAL(18,4))) AS DOUBLE) AS payment_total,
    count(*) AS n_payments, CAST(max(coalesce(payment_installments, 1)) AS INTEGER) AS installments_max,
    CAST(max(CASE WHEN lower(coalesce(payment_type, 'unknown')) LIKE '%credit%' THEN 1 ELSE 0 END) AS INTEGER) AS has_cc
  FROM payments_raw GROUP BY order_id"""
CTES["review_totals"] = """
  SELECT order_id, count(review_id) AS review_count, avg(review_score) AS review_score_avg
  FROM reviews_raw WHERE review_score IS NOT NULL GROUP BY order_id"""
CTES["fact_clean"] = """
  SELECT i.order_id, i.product_id, i.seller_id, o.customer_id, price, freight_value, i.units, order_status,
    order_purchase_timestamp, is_valid_for_sales, category, product_weight_g, product_length_cm,
    product_height_cm, product_width_cm, seller_city, s.seller_state, customer_city, customer_state,
    payment_total, n_payments, installments_max, has_cc, review_count, review_score_avg,
    CAST(order_purchase_timestamp AS DATE) AS order_date, price AS revenue_item, freight_value AS freight
  FROM items_checked i
  LEFT JOIN orders_clean o ON o.order_id = i.order_id
  LEFT JOIN products_clean p ON p.product_id = i.product_id
  LEFT JOIN sellers_clean s ON s.seller_id = i.seller_id
  LEFT JOIN customers_clean c ON c.customer_id = o.customer_id
  LEFT JOIN payment_totals y ON y.order_id = i.order_id
  LEFT JOIN review_totals v ON v.order_id = i.order_id
  WHERE price IS NOT NULL AND coalesce(is_valid_for_sales, false)"""


def weekly_sql(category: str = "p_brand", period: str = "date_trunc('week', o_orderdate)") -> str:
    return f"""
  SELECT CAST({period} AS DATE) AS order_week, {category} AS category, CAST(sum(l_quantity) AS DOUBLE) AS units,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS revenue,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS avg_price,
    CAST(sum(coalesce(review_count, 0)) AS DOUBLE) AS rev_count, avg(review_score_avg) AS rev_score_avg
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  LEFT JOIN review_totals t ON t.order_id = o_orderkey
  WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2"""


CTES["weekly"] = weekly_sql()
CTES["sparse"] = """
  SELECT order_week, category, units, revenue, avg_price, rev_count, rev_score_avg FROM weekly
  UNION ALL (SELECT order_week, 'Short#' || b AS category, units, revenue, avg_price, rev_count, rev_score_avg FROM
    (SELECT *, row_number() OVER (PARTITION BY category ORDER BY order_week) AS k,
       CAST(regexp_extract(category, '([0-9]+)', 1) AS INTEGER) AS b FROM weekly)
  WHERE b <= 12 AND k <= b)"""
# Series features used by the model stand-in: rolling mean of the last four known weeks and
# the previous price; then the adaptive warm-up trim and the ratio split.
CTES["model_rows"] = """
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY category ORDER BY order_week DESC) <= val_len
      THEN 'valid' ELSE 'train' END AS split FROM
    (SELECT *, CASE WHEN count(*) OVER (PARTITION BY category) <= 1 THEN 0
        ELSE greatest(1, least(12, CAST(round(0.2 * count(*) OVER (PARTITION BY category)) AS INTEGER))) END AS val_len
     FROM (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY category) AS n,
        lag(avg_price, 1) OVER w AS avg_price_lag1,
        avg(units) OVER (PARTITION BY category ORDER BY order_week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS units_roll4
      FROM weekly WINDOW w AS (PARTITION BY category ORDER BY order_week))
     WHERE k > CASE WHEN n > 52 THEN 52 WHEN n > 12 THEN 12 WHEN n > 8 THEN 8 WHEN n > 4 THEN 4
                    WHEN n > 2 THEN 2 WHEN n > 1 THEN 1 ELSE 0 END)"""
CTES["roll_lines"] = f"""
  SELECT category, {line('intercept', 'units', 'units_roll4')} AS a, {line('slope', 'units', 'units_roll4')} AS b
  FROM model_rows WHERE split = 'train' GROUP BY category"""
CTES["price_lines"] = f"""
  SELECT category, {line('intercept', 'units', 'avg_price')} AS a, {line('slope', 'units', 'avg_price')} AS b
  FROM model_rows WHERE split = 'train' GROUP BY category"""
CTES["pred"] = """
  SELECT order_week, category, units AS y, a + b * units_roll4 AS yhat
  FROM model_rows JOIN roll_lines USING (category) WHERE split = 'valid'"""
CTES["per_category"] = """
  SELECT category, count(*) AS n, sum(abs(y - yhat)) AS sum_abs_err, sum(abs(y)) AS sum_abs_y,
    avg(abs(y - yhat)) AS "MAE", avg(yhat - y) AS "Bias", sum(y) AS "Actual_sum",
    avg(abs((y - yhat) / greatest(y, 1e-6))) AS "MAPE", corr(y, yhat) ** 2 AS "R2",
    sum(abs(y - yhat)) / greatest(sum(abs(y)), 1e-9) AS "wMAPE"
  FROM pred GROUP BY category"""
CTES["calibration"] = f"""
  SELECT category, {line('slope', 'y', 'yhat')} AS scale_b, {line('intercept', 'y', 'yhat')} AS offset_a,
    avg(yhat - y) AS "Bias_units" FROM pred GROUP BY category"""
CTES["val_prices"] = """
  SELECT category, avg(avg_price) AS avg_price_val FROM weekly
  WHERE order_week BETWEEN (SELECT min(order_week) FROM pred) AND (SELECT max(order_week) FROM pred) GROUP BY category"""
CTES["fix_list"] = """
  SELECT category, n, "MAE", "wMAPE" * 100 AS "wMAPE_pct", "Bias", "Actual_sum", avg_price_val, sum_abs_err,
    sum_abs_err * coalesce(avg_price_val, 0) AS "Revenue_at_Risk", "wMAPE" * abs("Actual_sum") AS "PriorityScore",
    scale_b, offset_a,
    CASE WHEN "Bias" < -5 THEN printf('Underpredict by %.1f u; try scale x%.2f or add %.1f', -"Bias", scale_b, offset_a)
         WHEN "Bias" > 5 THEN printf('Overpredict by %.1f u; try scale x%.2f or add %.1f', "Bias", scale_b, offset_a)
         ELSE printf('OK; keep global calibration (x%.2f, +%.1f)', scale_b, offset_a) END AS "Recommendation"
  FROM per_category LEFT JOIN calibration USING (category) LEFT JOIN val_prices USING (category)"""
CTES["recent"] = """
  SELECT category, avg(avg_price) AS avg_price_recent, avg(rev_count) AS rev_count_recent,
    avg(rev_score_avg) AS rev_score_avg_recent FROM
    (SELECT *, row_number() OVER (PARTITION BY category ORDER BY order_week DESC) AS k FROM weekly)
  WHERE k <= 4 GROUP BY category"""
CTES["future_weeks"] = """
  SELECT CAST(last + 7 * CAST(i AS INTEGER) AS DATE) AS order_week, CAST(i AS INTEGER) AS step
  FROM (SELECT max(order_week) AS last FROM weekly), range(1, 9) t(i)"""
