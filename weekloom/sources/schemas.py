"""Declared schemas of the raw retail tables and of the tables handed between steps."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Names and types of the columns of each table.
_DDL = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp,"
    " order_approved_at timestamp, order_delivered_carrier_date timestamp,"
    " order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string,"
    " shipping_limit_date timestamp, price double, freight_value double",
    "products": "product_id string, product_category_name string, product_name_lenght double,"
    " product_description_lenght double, product_photos_qty double, product_weight_g double,"
    " product_length_cm double, product_height_cm double, product_width_cm double",
    "category_translation": "product_category_name string, product_category_name_english string",
    "payments": "order_id string, payment_sequential int, payment_type string, payment_installments int,"
    " payment_value double",
    "reviews": "review_id string, order_id string, review_score double, review_comment_title string,"
    " review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string,"
    " customer_city string, customer_state string",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "geolocation": "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double,"
    " geolocation_city string, geolocation_state string",
    "unit_costs": "product_category_name_english string, approx_price double, unit_cost double",
    "margins": "category string, margin_rate double",
    "holidays": "date date",
    "predictions": "order_week date, category string, y double, yhat double",
    "forecast": "order_week date, category string, avg_price double, units double, revenue double",
    "price_actions": "category string, recommended_pct double, best_delta_margin double",
    "reviews_by_order": "order_id string, review_count bigint, review_score_avg double",
}

# The columns reported as missing or present, per raw table.
AUDITED_COLUMNS = {
    "orders": [
        "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
        "order_estimated_delivery_date", "customer_id",
    ],
    "order_items": ["order_id", "product_id", "seller_id", "price", "freight_value"],
    "products": [
        "product_category_name", "product_category_name_english", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "payments": ["order_id", "payment_type", "payment_installments", "payment_value"],
    "reviews": ["order_id", "review_score", "review_comment_title", "review_comment_message"],
    "customers": ["customer_id", "customer_city", "customer_state", "customer_zip_code_prefix"],
    "sellers": ["seller_id", "seller_city", "seller_state", "seller_zip_code_prefix"],
    "geolocation": [
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        "geolocation_city", "geolocation_state",
    ],
}

# Names under which the same column arrives from different producers.
FORECAST_ALIASES = {
    "category": ["category", "product_category_name_english", "cat", "product_category"],
    "order_week": ["order_week", "week", "orderweek", "week_start"],
    "units_base": ["units_base", "base_units", "units_pred", "units_model", "units0"],
    "units_cal": ["units_cal", "calibrated_units", "units_calibrated"],
}
PREDICTION_ALIASES = {
    "category": ["category", "product_category_name_english"],
    "y": ["y", "actual_units"],
    "yhat": ["yhat", "pred_units"],
}
RECOMMENDATION_ALIASES = {
    "category": ["category", "product_category_name_english"],
    "price0": ["price0", "base_price", "baseline_price"],
    "units0": ["units0", "base_units", "units_base"],
    "scenario": [
        "scenario_best", "best_scenario", "rec_scenario", "scenario", "rec_pct", "pct_price_change",
        "pct_change", "s_best",
    ],
    "price_best": ["price_best", "price_rec", "price_recommended", "price_s", "price_new"],
    "units_best": ["units_best", "units_rec", "units_recommended", "units_s"],
}
# Names of the column that holds a price change.
PRICE_CHANGE_COLUMNS = ["recommended_pct", "recommended_price_change", "percent_price_change"]


def schema(name: str) -> StructType:
    return StructType.fromDDL(_DDL[name])


def names() -> list[str]:
    return list(_DDL)
