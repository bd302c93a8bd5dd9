"""Counters taken on the way of writing."""

import pytest
from pyspark.sql import functions as F

from weekloom.operators.audit import CleaningLog


def test_counters_come_from_the_writes(spark, tmp_path):
    log = CleaningLog()
    n = spark.range(100).withColumn("k", F.col("id") % 10)
    frames = {
        "dropped_items_price_na": n.withColumn("price", F.when(F.col("k") > 2, F.lit(1.0))),
        "remaining_fact_rows": n.where("k < 5"),
        "products_missing_english_category_now": n.withColumn("category", F.when(F.col("k") == 0, "unknown").otherwise("x")),
        "customers_missing_state_after_fill": n.withColumn("customer_state", F.when(F.col("k") > 0, "s")),
        "sellers_missing_state_after_fill": n.withColumn("seller_state", F.lit("s")),
    }
    with pytest.raises(ValueError, match="nothing counts"):
        log.table(spark)
    jobs = spark.sparkContext.statusTracker()
    for counter, df in frames.items():
        log.watch(counter, df).write.parquet(str(tmp_path / counter))
    before = len(jobs.getJobIdsForGroup(None))
    assert log.table(spark).head() == (30, 50, 10, 10, 0)
    assert len(jobs.getJobIdsForGroup(None)) - before <= 1


def test_a_filter_behind_the_counter_changes_nothing(spark):
    log = CleaningLog()
    prices = spark.range(50).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("price"))
    log.watch("dropped_items_price_na", prices).where("price is not null and price > 40").write.format("noop").mode("overwrite").save()
    assert log.seen["dropped_items_price_na"].get["n"] == 10
