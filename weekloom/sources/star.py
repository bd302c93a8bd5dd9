"""Retail role tables derived from the order/lineitem/part star schema.

The raw roles are made imperfect by fixed rules on the keys (missing or negative prices,
unknown sellers, unscored reviews, ...), because the source tables hold no bad values and the
cleaning operators need some.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.operators import audit, cleaning, features
from weekloom.session import stage

# Translated product types; one type is left out on purpose.
TRANSLATION = [
    ("ECONOMY", "economy_goods"),
    ("LARGE", "large_goods"),
    ("MEDIUM", "medium_goods"),
    ("PROMO", "promotions"),
    ("STANDARD", "standard_goods"),
]
# The days of a year that are holidays.
HOLIDAY_DAYS = ["01-01", "04-21", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25"]

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END"


def literal_table(spark: SparkSession, rows: list[tuple[str, ...]], *names: str) -> DataFrame:
    """A small table written into the plan: its size is known, so it is broadcast."""
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS v({', '.join(names)})")


class StarTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- raw roles -------------------------------------------------------------------------

    @cached_property
    def orders_raw(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            f"CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE {STATUS} END AS order_status",
            "o_orderdate AS order_purchase_timestamp",
            "CASE WHEN o_orderkey % 10 <> 0 THEN"
            " o_orderdate + make_dt_interval(0, cast(o_orderkey * 7 % 700 - 30 AS int)) END"
            " AS order_delivered_customer_date",
            "o_orderdate + INTERVAL '20' DAY AS order_estimated_delivery_date",
        )

    @cached_property
    def items_raw(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "CASE WHEN l_orderkey % 101 <> 0 THEN l_orderkey END AS order_id",
            "l_partkey AS product_id",
            "CASE WHEN l_suppkey % 23 <> 0 THEN l_suppkey END AS seller_id",
            "CASE WHEN l_orderkey % 14 = 0 THEN double('NaN') WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN -l_extendedprice"
            " ELSE l_extendedprice END AS price",
            "CASE WHEN l_orderkey % 26 = 0 THEN double('NaN') WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 17 = 0 THEN -1.0D"
            " ELSE l_extendedprice * l_tax END AS freight_value",
            "l_quantity AS units",
        )

    @cached_property
    def products_raw(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS product_id",
            "CASE WHEN p_partkey % 13 <> 0 THEN p_type END AS product_category_name",
            "CASE WHEN p_partkey % 10 = 0 THEN double('NaN') WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN -1.0D"
            " ELSE cast(p_size * 10 AS double) END AS product_weight_g",
            "CASE WHEN p_partkey % 6 = 0 THEN 0.0D ELSE cast(p_size + p_partkey % 10 AS double) END AS product_length_cm",
            "CASE WHEN p_partkey % 9 <> 0 THEN p_retailprice END AS product_height_cm",
            "cast(p_size AS double) AS product_width_cm",
        )

    @cached_property
    def translation(self) -> DataFrame:
        return literal_table(self.spark, TRANSLATION, "product_category_name", "product_category_name_english")

    @cached_property
    def holidays(self) -> DataFrame:
        """The holidays of every year with orders and of the year after, into which forecasts reach."""
        first, last = F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate")) + 1
        years = self.table("orders").agg(F.sequence(first, last).alias("years")).select(F.explode("years").alias("year"))
        day = F.explode(F.array(*[F.lit(d) for d in HOLIDAY_DAYS]))
        return years.select("year", day.alias("day")).select(F.concat_ws("-", "year", "day").cast("date").alias("date"))

    @cached_property
    def payments_raw(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "CASE l_returnflag WHEN 'R' THEN 'Credit_Card' WHEN 'A' THEN 'boleto' END AS payment_type",
            "CASE WHEN l_linenumber <> 3 THEN l_linenumber END AS payment_installments",
            "CASE WHEN l_orderkey % 18 = 0 THEN double('NaN')"
            " WHEN l_orderkey % 9 <> 0 THEN l_extendedprice * (1 - l_discount) END AS payment_value",
        )

    @cached_property
    def reviews_raw(self) -> DataFrame:
        first = self.table("orders").selectExpr(
            "o_orderkey AS review_id",
            "o_orderkey AS order_id",
            "CASE WHEN o_orderkey % 5 <> 0 THEN cast(substr(o_orderpriority, 1, 1) AS double) END AS review_score",
            "CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS review_comment_title",
            "CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS review_comment_message",
        )
        second = self.table("orders").where("o_orderkey % 4 = 0").selectExpr(
            "o_orderkey + 1000000000 AS review_id",
            "o_orderkey AS order_id",
            "cast(o_custkey % 5 + 1 AS double) AS review_score",
            "cast(NULL AS string) AS review_comment_title",
            "cast(NULL AS string) AS review_comment_message",
        )
        return first.unionByName(second)

    @cached_property
    def customers_raw(self) -> DataFrame:
        named = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return named.selectExpr(
            "c_custkey AS customer_id",
            "cast(c_nationkey AS string) AS customer_zip_code_prefix",
            "CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS customer_city",
            "CASE WHEN c_custkey % 3 <> 0 THEN n_name END AS customer_state",
        )

    @cached_property
    def sellers_raw(self) -> DataFrame:
        named = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return named.selectExpr(
            "s_suppkey AS seller_id",
            "cast(s_nationkey AS string) AS seller_zip_code_prefix",
            "CASE WHEN s_suppkey % 5 <> 0 THEN n_name END AS seller_city",
            "CASE WHEN s_suppkey % 4 <> 0 THEN n_name END AS seller_state",
        )

    @cached_property
    def geolocation_raw(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "concat(if(c_nationkey % 6 = 0, 'N', ''), c_nationkey) AS geolocation_zip_code_prefix",
            "c_acctbal AS geolocation_lat",
            "cast(c_custkey % 360 - 180 AS double) AS geolocation_lng",
            "c_mktsegment AS geolocation_city",
            "concat('R', c_custkey % 4) AS geolocation_state",
        )

    # -- cleaned roles ---------------------------------------------------------------------

    def clean_products(self) -> DataFrame:
        named = cleaning.translate_category(self.products_raw, self.translation)
        dims = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
        return cleaning.impute_by_group_median(named, dims, "category")

    @cached_property
    def geo(self) -> DataFrame:
        return stage(cleaning.geo_reference(self.geolocation_raw), "geo")

    def clean_customers(self) -> DataFrame:
        return cleaning.fill_from_reference(
            self.customers_raw, self.geo, "customer_zip_code_prefix", "customer_city", "customer_state"
        )

    def clean_sellers(self) -> DataFrame:
        return cleaning.fill_from_reference(
            self.sellers_raw, self.geo, "seller_zip_code_prefix", "seller_city", "seller_state"
        )

    # The cleaned dimensions are tables of their own, written once for all their readers.

    @cached_property
    def products(self) -> DataFrame:
        return stage(self.clean_products(), "products")

    @cached_property
    def customers(self) -> DataFrame:
        return stage(self.clean_customers(), "customers")

    @cached_property
    def sellers(self) -> DataFrame:
        return stage(self.clean_sellers(), "sellers")

    @cached_property
    def orders(self) -> DataFrame:
        return cleaning.flag_valid_sales(cleaning.delivery_duration(self.orders_raw))

    @cached_property
    def reviews(self) -> DataFrame:
        return cleaning.reviews_by_order(self.reviews_raw)

    @cached_property
    def payments(self) -> DataFrame:
        return cleaning.payments_by_order(self.payments_raw)

    def cleaning_log(self) -> DataFrame:
        """The quality counters of one run of the cleaning: its tables are written as ever, the fact to nowhere."""
        log = audit.CleaningLog()
        products = stage(log.watch("products_missing_english_category_now", self.clean_products()), "products")
        customers = stage(log.watch("customers_missing_state_after_fill", self.clean_customers()), "customers")
        sellers = stage(log.watch("sellers_missing_state_after_fill", self.clean_sellers()), "sellers")
        items, _ = cleaning.clean_items(self.items_raw, sellers, log)
        fact = cleaning.build_fact(items, self.orders, products, sellers, customers, self.payments, self.reviews)
        log.watch("remaining_fact_rows", fact).write.format("noop").mode("overwrite").save()
        return log.table(self.spark)

    @cached_property
    def fact_clean(self) -> DataFrame:
        items, _ = cleaning.clean_items(self.items_raw, self.sellers)
        return cleaning.build_fact(
            items, self.orders, self.products, self.sellers, self.customers, self.payments, self.reviews
        )

    # -- series ----------------------------------------------------------------------------

    def lines(self) -> DataFrame:
        """Order lines of delivered and shipped orders, with their order's reviews.

        Both joins are on the order key, so large tables are partitioned once for both.
        """
        orders = self.table("orders").where("o_orderstatus IN ('F', 'O')").select("o_orderkey", "o_orderdate")
        return (
            self.table("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.reviews, F.col("l_orderkey") == F.col("order_id"), "left")
            .select(
                F.to_date("o_orderdate").alias("order_date"),
                F.col("l_partkey").alias("product_id"),
                F.col("l_quantity").alias("units"),
                F.col("l_extendedprice").alias("revenue_item"),
                "review_count",
                "review_score_avg",
            )
        )

    def categories(self, column: str = "p_brand") -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("product_id"), F.col(column).alias("category"))

    def sales(self, column: str = "p_brand") -> DataFrame:
        """Lines with their category; a small product table is broadcast, skewed products of a large one are split."""
        return self.lines().join(self.categories(column), "product_id", "left")

    @cached_property
    def weekly(self) -> DataFrame:
        return features.weekly_aggregate(self.sales())

    @cached_property
    def series(self) -> DataFrame:
        """The weekly series written once, for plans that read it several times."""
        return stage(self.weekly, "weekly")

    def sparse(self, weekly: DataFrame) -> DataFrame:
        """All series, and for brands k <= 12 one more of their first k weeks, so short series occur."""
        number = F.regexp_extract("category", r"(\d+)", 1).cast("int")
        first = features.week_index(weekly).where((number <= 12) & (F.col("week_idx") < number)).drop("week_idx")
        return weekly.unionByName(first.withColumn("category", F.concat(F.lit("Short#"), number)))
