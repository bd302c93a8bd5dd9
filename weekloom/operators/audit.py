"""Data-quality reports over raw tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from weekloom.functions.grouped import one_row


def _missing(df: DataFrame, c: str) -> Column:
    absent = F.col(c).isNull()
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        absent = absent | F.isnan(c)
    return absent


def missingness_report(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Missing count and share of each column, from one pass over the table."""
    counts = df.agg(F.count("*").alias("n_rows"), *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(cols)])
    per_column = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n")) for i, c in enumerate(cols)])
    return counts.select("n_rows", F.inline(per_column)).select(
        F.lit(name).alias("table"),
        "column",
        F.col("n").alias("n_missing"),
        F.try_divide("n", "n_rows").alias("pct_missing"),
        "n_rows",
    )


def missingness_summary(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    reports = [missingness_report(df, columns[name], name) for name, df in tables.items()]
    summary = reports[0]
    for report in reports[1:]:
        summary = summary.unionByName(report)
    return summary


def status_counts(df: DataFrame, col: str) -> DataFrame:
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(col))


def dataset_overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: order date range, row counts, and the share of orders that have a review.

    ``tables`` needs orders (order_id, order_purchase_timestamp) and reviews (order_id); each
    further entry adds its row count. Every table is scanned once and contributes one row.
    """
    spark = tables["orders"].sparkSession
    orders = one_row(
        tables["orders"].agg(
            F.min("order_purchase_timestamp").alias("first"),
            F.max("order_purchase_timestamp").alias("last"),
            F.countDistinct("order_id").alias("orders"),
        )
    )
    reviews = one_row(
        tables["reviews"].agg(F.countDistinct("order_id").alias("orders"), F.count("*").alias("rows"))
    )
    row_counts = {
        name: tables[name].agg(F.count("*")).scalar()
        for name in tables
        if name not in ("orders", "reviews")
    }
    base = spark.range(1).select(
        orders.alias("o"), reviews.alias("r"), *[c.alias(f"{name}_rows") for name, c in row_counts.items()]
    )
    has_quantity = "quantity" in [c.lower() for c in tables["order_items"].columns]
    return base.select(
        F.col("o.first").alias("orders_date_min"),
        F.col("o.last").alias("orders_date_max"),
        F.col("o.orders").alias("orders_total"),
        *[F.col(f"{name}_rows") for name in row_counts],
        F.col("r.rows").alias("reviews_rows"),
        (F.col("r.orders") / F.greatest(F.lit(1), F.col("o.orders"))).alias("orders_with_reviews_pct"),
        F.lit(has_quantity).alias("qty_column_present_in_items"),
    )


class CleaningLog:
    """Quality counters taken by the jobs that write the cleaned tables, without a scan of their own.

    ``watch`` gives a frame that counts as it is written; once all are, ``table`` is the log. A watched frame is to be
    written once: a counter has the numbers of the first job that ran it to the end.
    """

    COUNTERS = {
        "dropped_items_price_na": lambda: F.count_if(F.col("price").isNull()),
        "remaining_fact_rows": lambda: F.count(F.lit(1)),
        "products_missing_english_category_now": lambda: F.count_if(F.col("category") == "unknown"),
        "customers_missing_state_after_fill": lambda: F.count_if(F.col("customer_state").isNull()),
        "sellers_missing_state_after_fill": lambda: F.count_if(F.col("seller_state").isNull()),
    }

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def watch(self, counter: str, df: DataFrame) -> DataFrame:
        self.seen[counter] = Observation(f"{counter}-{uuid.uuid4().hex}")
        return df.observe(self.seen[counter], self.COUNTERS[counter]().alias("n"))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row; raises if a counter was never watched, and waits for one whose job hasn't ended."""
        missing = [c for c in self.COUNTERS if c not in self.seen]
        if missing:
            raise ValueError(f"nothing counts {missing}")
        return spark.range(1).select(*[F.lit(self.seen[c].get["n"]).cast("long").alias(c) for c in self.COUNTERS])
