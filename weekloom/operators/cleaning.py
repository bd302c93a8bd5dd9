"""Cleaning of the raw tables and the order-line fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.functions.columns import number, present
from weekloom.functions.grouped import group_and_overall_medians, modes, one_row
from weekloom.operators.audit import CleaningLog

UNKNOWN = "unknown"
UNKNOWN_CITY = "unknown_city"
SALES_STATUSES = ("delivered", "shipped", "invoiced")


def translate_category(products: DataFrame, translation: DataFrame, key: str = "product_category_name") -> DataFrame:
    """Add ``category``: the translated name, or "unknown" where there is none."""
    english = translation.select(key, F.col("product_category_name_english").alias("category"))
    return products.join(english, key, "left").withColumn("category", F.coalesce("category", F.lit(UNKNOWN)))


def impute_by_group_median(
    df: DataFrame, cols: Sequence[str], group: str, allow_zero: bool = False, fallback: str = "observed"
) -> DataFrame:
    """Replace invalid values by the group's median, else by the global median.

    NaN and values that are not positive (with ``allow_zero``: negative) count as missing, before
    any median is taken. The global median is over observed values, or, with
    ``fallback="filled"``, over the column after the group medians were put in. Both take two reads
    of ``df``, which is never moved for them (see group_and_overall_medians).
    """
    if fallback not in ("observed", "filled"):
        raise ValueError(f"unknown fallback: {fallback}")
    cols = list(cols)
    values = {c: present(F.col(c).cast("double")) for c in cols}
    valid = df.withColumns({c: F.when(v >= 0 if allow_zero else v > 0, v) for c, v in values.items()})
    medians, overall = group_and_overall_medians(valid, group, cols, filled=fallback == "filled")
    overall = one_row(overall)
    medians = medians.select(group, *[F.col(c).alias(f"_median_{c}") for c in cols])
    columns = [c for c in df.columns if c not in cols]
    return valid.join(medians, group, "left").select(
        *columns, *[F.coalesce(F.col(c), F.col(f"_median_{c}"), overall.getField(c)).alias(c) for c in cols]
    )


def geo_reference(geo: DataFrame) -> DataFrame:
    """One row per zip prefix: most frequent city and state, mean position."""
    zipped = geo.withColumn("zip", F.col("geolocation_zip_code_prefix").cast("string")).where("zip IS NOT NULL")
    places = modes(
        zipped.select("zip", F.col("geolocation_city").alias("geo_city"), F.col("geolocation_state").alias("geo_state")),
        ["zip"],
        ["geo_city", "geo_state"],
    )
    position = zipped.groupBy("zip").agg(
        F.avg("geolocation_lat").alias("geo_lat"), F.avg("geolocation_lng").alias("geo_lng")
    )
    return places.join(position, "zip")


def fill_from_reference(df: DataFrame, reference: DataFrame, zip_col: str, city_col: str, state_col: str) -> DataFrame:
    """Fill city and state by zip prefix, then the commonest state and a fixed city name."""
    known = reference.select(F.col("zip").alias(zip_col), "geo_city", "geo_state")
    filled = (
        df.withColumn(zip_col, F.col(zip_col).cast("string"))
        .join(known, zip_col, "left")
        .withColumns(
            {
                city_col: F.coalesce(city_col, "geo_city", F.lit(UNKNOWN_CITY)),
                state_col: F.coalesce(state_col, "geo_state"),
            }
        )
        .select(*df.columns)
    )
    commonest = one_row(modes(filled, [], [state_col])).getField(state_col)
    return filled.select(
        *[F.coalesce(F.col(c), commonest).alias(c) if c == state_col else F.col(c) for c in df.columns]
    )


def delivery_duration(orders: DataFrame) -> DataFrame:
    """Whole days from purchase to delivery (rounded down) of delivered orders, else NULL."""
    micros = F.timestamp_diff(
        "MICROSECOND", F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    )
    days = F.floor(micros / F.lit(86_400_000_000))
    delivered = (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
    return orders.withColumn("purchase_to_delivery_days", F.when(delivered, days))


def flag_valid_sales(orders: DataFrame, statuses: Sequence[str] = SALES_STATUSES) -> DataFrame:
    flag = F.coalesce(F.col("order_status").isin(*statuses), F.lit(False))
    return orders.withColumn("is_valid_for_sales", flag)


def typed_items(items: DataFrame) -> DataFrame:
    """Items with all ids; prices and freight as numbers, prices that are not positive NULL."""
    typed = items.dropna(subset=["order_id", "product_id", "seller_id"]).withColumns(
        {"price": number("price"), "freight_value": number("freight_value")}
    )
    return typed.withColumn("price", F.when(F.col("price") > 0, F.col("price")))


def dropped_items(items: DataFrame) -> DataFrame:
    """One-row count of the items that go for want of a price; one scan, no medians."""
    return typed_items(items).agg(F.count_if(F.col("price").isNull()).alias("n_dropped"))


def check_items(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Typed items with missing freight imputed by seller state.

    The seller's city and state stay on the items, so the fact need not look them up again.
    """
    typed = typed_items(items)
    places = sellers.select("seller_id", "seller_city", "seller_state")
    placed = typed.drop("seller_city", "seller_state").join(places, "seller_id", "left")
    return impute_by_group_median(placed, ["freight_value"], "seller_state", allow_zero=True, fallback="filled")


def clean_items(items: DataFrame, sellers: DataFrame, log: CleaningLog | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean items, one-row count of the items dropped for want of a price).

    Each row is one unit unless the table has a ``units`` column of its own. With ``log`` the dropped items are also counted by whatever
    job writes what is made of the clean ones.
    """
    checked = check_items(items, sellers)
    if log:
        checked = log.watch("dropped_items_price_na", checked)
    clean = checked.where(F.col("price").isNotNull())
    if "units" not in clean.columns:
        clean = clean.withColumn("units", F.lit(1))
    return clean, dropped_items(items)


def payments_by_order(payments: DataFrame) -> DataFrame:
    credit = F.lower(F.coalesce("payment_type", F.lit(UNKNOWN))).contains("credit")
    value = F.coalesce(number("payment_value"), F.lit(0.0))
    return (
        payments.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.sum(value.cast("decimal(18,4)")).cast("double").alias("payment_total"),
            F.count("*").alias("n_payments"),
            F.max(F.coalesce(F.col("payment_installments"), F.lit(1)).cast("int")).alias("installments_max"),
            F.max(credit.cast("int")).alias("has_cc"),
        )
    )


def tidy_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with a numeric score; missing texts become empty."""
    scored = reviews.withColumn("review_score", number("review_score")).dropna(subset=["review_score"])
    texts = [c for c in ("review_comment_title", "review_comment_message") if c in reviews.columns]
    return scored.fillna("", subset=texts) if texts else scored


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    return (
        tidy_reviews(reviews)
        .where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.count("review_id").alias("review_count"), F.avg("review_score").alias("review_score_avg"))
    )


def build_fact(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    product_columns: Sequence[str] = (
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ),
) -> DataFrame:
    """Order lines of valid sales with product, seller, customer, payment and review columns.

    The three order-grained inputs join on the same key, so one partitioning of the items
    serves them all; the sales filter is declared on the result and Catalyst moves it down.
    """
    order_columns = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "is_valid_for_sales"]
    seller_columns = ["seller_id", "seller_city", "seller_state"]
    if not set(seller_columns) <= set(items.columns):
        items = items.drop("seller_city", "seller_state").join(sellers.select(*seller_columns), "seller_id", "left")
    joined = (
        items.join(orders.select(*order_columns), "order_id", "left")
        .join(payments, "order_id", "left")
        .join(reviews, "order_id", "left")
        .join(products.select("product_id", "category", *product_columns), "product_id", "left")
        .join(customers.select("customer_id", "customer_city", "customer_state"), "customer_id", "left")
    )
    return joined.where(F.coalesce("is_valid_for_sales", F.lit(False))).withColumns(
        {
            "order_date": F.to_date("order_purchase_timestamp"),
            "revenue_item": F.col("price").cast("double"),
            "freight": F.col("freight_value").cast("double"),
        }
    )
