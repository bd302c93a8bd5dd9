"""Column expressions: money, guarded arithmetic, dates, text."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
WEEKS_PER_YEAR = 52.0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: str | Column) -> Column:
    """The number, or NULL where it is NaN: a missing value however it is written."""
    return F.when(~F.isnan(_col(c)), _col(c))


def money_sum(c: str | Column) -> Column:
    """Sum in DECIMAL, so the result does not depend on the order of the rows."""
    return F.sum(present(c).cast(MONEY)).cast("double")


def money_avg(c: str | Column) -> Column:
    return F.try_divide(money_sum(c), F.count(present(c)))


def guarded(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator where the denominator is positive, else NULL."""
    return F.when(_col(denominator) > 0, _col(numerator) / _col(denominator))


def number(c: str | Column) -> Column:
    """Text or numeric to double; NaN and what does not parse become NULL."""
    return present(_col(f"`{c}`" if isinstance(c, str) else c).try_cast("double"))


def name_key(c: str | Column) -> Column:
    """Join key for names typed by hand: trimmed, lower case."""
    return F.lower(F.trim(_col(c).cast("string")))


def parse_date(c: str | Column) -> Column:
    """Day-first dates with or without a time, or ISO dates; anything else is NULL."""
    text = _col(c).cast("string")
    day_first = F.regexp_replace(text, "/", "-")
    return F.coalesce(
        F.try_to_timestamp(day_first, F.lit("d-M-yyyy HH:mm")),
        F.try_to_timestamp(day_first, F.lit("d-M-yyyy")),
        F.try_to_timestamp(text),
    ).cast("date")


def week_start(c: str | Column) -> Column:
    """Monday of the week, computed on DATE so no time zone is involved."""
    day = _col(c).cast("date")
    return F.date_sub(day, F.weekday(day))


def period_start(c: str | Column, grain: str) -> Column:
    day = _col(c).cast("date")
    if grain == "day":
        return day
    if grain == "week":
        return week_start(day)
    if grain in ("month", "quarter", "year"):
        return F.trunc(day, grain)
    raise ValueError(f"unknown grain: {grain}")


def season(week: str | Column) -> dict[str, Column]:
    """ISO week number, calendar year of the Monday, and the yearly sine and cosine."""
    woy = F.weekofyear(_col(week))
    angle = F.lit(2 * math.pi) * woy / F.lit(WEEKS_PER_YEAR)
    return {
        "weekofyear": woy,
        "year": F.year(_col(week)),
        "sin_woy": F.sin(angle),
        "cos_woy": F.cos(angle),
    }


def mean_of(values: list[Column]) -> Column:
    """Mean of the non-null ones among a fixed list of columns."""
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])
    count = reduce(lambda a, b: a + b, [F.when(v.isNull(), 0).otherwise(1) for v in values])
    return F.try_divide(total, count)


def same_number(a: str | Column, b: str | Column) -> Column:
    """Equal within 1e-8 absolute plus 1e-5 relative to ``b``."""
    return F.abs(_col(a) - _col(b)) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(_col(b))


def scenario_key(c: str | Column) -> Column:
    """Integer key for a fractional price change; doubles are no safe join key."""
    return F.round(_col(c) * 10000).cast("int")
