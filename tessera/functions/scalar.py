"""Scalar expressions: ages, period keys, ratios, classes and label maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def completed_years(birth: Column, as_of: Column) -> Column:
    """Whole years between two dates; a 29 February birthday counts from 1 March."""
    def day_of_year(c: Column) -> Column:
        return F.month(c) * 100 + F.dayofmonth(c)

    not_yet = (day_of_year(as_of) < day_of_year(birth)).cast("int")
    return F.year(as_of) - F.year(birth) - not_yet


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null instead of an error when the denominator is 0."""
    return F.try_divide(numerator, denominator)


def parsed_date(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Null for text that does not fit the pattern."""
    return F.try_to_date(text, pattern)


def period_key(year: Column, month: Column) -> Column:
    """``YYYYMM`` as text, so that it sorts in time order."""
    return F.concat(year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def right_closed_class(value: Column, low: float, high: float, classes: int) -> Column:
    """1-based class of ``(low, high]`` cut into equal widths; null outside it."""
    width = (high - low) / classes
    number = F.ceil((value - F.lit(float(low))) / F.lit(width))
    inside = (value > F.lit(float(low))) & (value <= F.lit(float(high)))
    return F.when(inside, F.least(number, F.lit(classes))).cast("int")


def label_number(value: Column, mapping: Mapping[str, int]) -> Column:
    """Fixed text -> number map; values outside the map become null."""
    out = F.lit(None).cast("int")
    for label, number in mapping.items():
        out = F.when(value == F.lit(label), F.lit(number)).otherwise(out)
    return out


def event_probability(event: Column) -> Column:
    """Aggregate: the share of rows where the event holds."""
    return F.avg(event.cast("double"))


def money(value: Column) -> Column:
    """Exact type for amounts, so that sums do not depend on row order."""
    return value.cast("decimal(18,2)")
