"""Lines and correlations of two columns from decimal sums, which do not depend on the order of the rows.

Count, sums and sums of products are exact in DECIMAL and merge in any order, so a slope has the same bits whatever the
partitions. Values count at twelve decimals. The sums are centred on whole-number pivots next to the means while still decimal, so
a large mean costs no digits. Where a value reaches 1e10 or a sum of products 1e20, the figures of that group are Spark's own in
doubles, which are right to some twelve digits but may differ in the last ones with the order of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from weekloom.functions.columns import present

VALUE, TOTAL, PRODUCT, PIVOT = "decimal(22,12)", "decimal(25,12)", "decimal(37,17)", "decimal(12,0)"


@dataclass(frozen=True)
class Line:
    """Aggregates of the pairs in which both values are known; NULL where undefined."""

    slope: Column
    intercept: Column
    #: Squared correlation, NULL where either side is constant.
    r2: Column
    #: Sum of squares of y around its mean.
    syy: Column


def _plain(c: str | Column) -> Column:
    return present(F.col(c) if isinstance(c, str) else c).cast("double")


def squares(c: str | Column) -> Column:
    """Sum of squares as a double, the same in any order within the range."""
    plain = _plain(c)
    value = plain.try_cast(VALUE)
    exact = F.when(F.count(value) == F.count(plain), F.try_sum(value * value).cast("double"))
    return F.coalesce(exact, F.sum(plain * plain))


def line(y: str | Column, x: str | Column, over: WindowSpec | None = None) -> Line:
    """Least-squares line y = intercept + slope * x, as aggregates or, with ``over``, as window functions."""
    over_all = (lambda c: c.over(over)) if over is not None else (lambda c: c)
    both = _plain(y).isNotNull() & _plain(x).isNotNull()
    plain = {"x": F.when(both, _plain(x)), "y": F.when(both, _plain(y))}
    value = {k: v.try_cast(VALUE) for k, v in plain.items()}
    n = over_all(F.count(plain["x"]))
    total = {k: over_all(F.try_sum(v)).try_cast(TOTAL) for k, v in value.items()}
    pivot = {k: F.round(F.try_divide(t, n)).try_cast(PIVOT) for k, t in total.items()}
    count = n.try_cast(PIVOT)
    rest = {k: (total[k] - count * pivot[k]).cast("double") for k in total}
    mean = {k: pivot[k].cast("double") + F.try_divide(rest[k], n) for k in total}
    constant = {k: over_all(F.min(v)) == over_all(F.max(v)) for k, v in plain.items()}
    fits = (over_all(F.count(value["x"])) == n) & (over_all(F.count(value["y"])) == n)

    def around(a: str, b: str) -> Column:
        """Sum of products around the means; NULL out of range."""
        at = (over_all(F.try_sum(value[a] * value[b])).try_cast(PRODUCT) - (pivot[a] * total[b]).try_cast(PRODUCT)).try_cast(PRODUCT)
        at = (at - (pivot[b] * total[a]).try_cast(PRODUCT)).try_cast(PRODUCT) + (count * (pivot[a] * pivot[b])).try_cast(PRODUCT)
        return F.when(fits, at.cast("double") - F.try_divide(rest[a] * rest[b], n))

    def settled(a: str, b: str, doubles: Column) -> Column:
        return F.when(constant[a] | constant[b], F.lit(0.0)).otherwise(F.coalesce(around(a, b), over_all(doubles)))

    sxx = settled("x", "x", F.regr_sxx(plain["y"], plain["x"]))
    sxy = settled("x", "y", F.regr_sxy(plain["y"], plain["x"]))
    syy = settled("y", "y", F.regr_syy(plain["y"], plain["x"]))
    at = {k: F.coalesce(F.when(fits, mean[k]), over_all(F.avg(plain[k]))) for k in plain}
    slope = F.try_divide(sxy, sxx)
    return Line(slope, at["y"] - slope * at["x"], F.try_divide(sxy * sxy, sxx * syy), syy)
