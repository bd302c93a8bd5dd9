import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekloom.functions.moments import line, squares


def fit(df, over=None):
    f = line("y", "x", over)
    return [f.slope.alias("slope"), f.intercept.alias("intercept"), f.r2.alias("r2"), f.syy.alias("syy"), squares(F.col("y")).alias("squares")][: 4 if over else 5]


@pytest.mark.parametrize("mean,spread", [(0.0, 1.0), (75_000.0, 30.0), (9e7, 2.5), (-3.0, 0.01)])
def test_a_line_has_the_same_bits_at_any_partitioning(spark, mean, spread):
    rnd = random.Random(7)
    x = [mean + spread * rnd.gauss(0, 1) for _ in range(400)]
    y = [3.25 * (v - mean) + rnd.gauss(0, spread) + 11 for v in x]
    df = spark.createDataFrame(list(zip(x, y)), "x double, y double")
    found = {tuple(df.repartition(n).agg(*fit(df)).head()) for n in (1, 7, 200)}
    assert len(found) == 1
    slope, intercept, r2, syy, total = found.pop()
    cx, cy = np.array(x) - np.mean(x), np.array(y) - np.mean(y)
    assert slope == pytest.approx((cx @ cy) / (cx @ cx), rel=1e-6) and r2 == pytest.approx((cx @ cy) ** 2 / (cx @ cx) / (cy @ cy), rel=1e-6)
    assert intercept == pytest.approx(np.mean(y) - slope * np.mean(x), rel=1e-6, abs=1e-6)
    assert syy == pytest.approx(cy @ cy, rel=1e-6) and total == pytest.approx(np.dot(y, y), rel=1e-6)
    assert df.agg(F.round(F.regr_slope("y", "x"), 6)).head()[0] == pytest.approx(slope, abs=1e-5)


@pytest.mark.parametrize("size", [3e9, 4e11])
def test_beyond_the_range_doubles_count(spark, size):
    """Once the sums of products leave the range, once the values do; no row goes lost."""
    x = [size * (1 + i / 1000) for i in range(200)]
    df = spark.createDataFrame([(v, 2.0 * v + 5) for v in x], "x double, y double")
    slope, intercept, r2, _, total = df.agg(*fit(df)).head()
    assert slope == pytest.approx(2, rel=1e-9) and r2 == pytest.approx(1, rel=1e-9) and abs(intercept) < size * 1e-6
    assert total == pytest.approx(sum((2 * v + 5) ** 2 for v in x), rel=1e-9)


def test_lines_that_do_not_exist(spark):
    nan = float("nan")
    rows = [("one", 1.1, 2.0), ("same", 0.1, 1.0), ("same", 0.1, 2.0), ("same", 0.1, 4.0), ("flat", 1.0, 0.3), ("flat", 2.0, 0.3)]
    rows += [("two", 1.0, 1.5), ("two", 3.0, 2.5), ("two", None, 9.0), ("two", nan, 9.0), ("two", 5.0, None), ("none", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {r.g: (r.slope, r.intercept, r.r2, r.syy) for r in df.groupBy("g").agg(*fit(df)).collect()}
    assert got["one"] == (None, None, None, 0.0) and got["same"][:3] == (None, None, None)
    assert got["flat"][0] == 0.0 and got["flat"][1:] == (0.3, None, 0.0)
    assert got["two"][:2] == (0.5, 1.0) and got["none"][:3] == (None, None, None)
    each = df.select("g", *fit(df, W.partitionBy("g"))).distinct().collect()
    assert {r.g: (r.slope, r.intercept, r.r2, r.syy) for r in each} == got
