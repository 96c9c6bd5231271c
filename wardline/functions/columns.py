"""Column building blocks: ordered rules, bands, weeks, exact money, guarded ratios."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.config import Bounds


def first_match(rules: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """Label of the first rule that is true; a NULL condition counts as not true."""
    chain = None
    for condition, label in rules:
        value = label if isinstance(label, Column) else F.lit(label)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    last = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return last if chain is None else chain.otherwise(last)


def upto(value: Column, bands: Iterable[tuple[float, str]], above: str) -> Column:
    """Band by inclusive upper limit. NULL falls through to ``above``."""
    return first_match([(value <= F.lit(limit), label) for limit, label in bands], above)


def from_(value: Column, bands: Iterable[tuple[float, object]], below: object) -> Column:
    """Band by inclusive lower limit, highest first. NULL falls through to ``below``."""
    return first_match([(value >= F.lit(limit), label) for limit, label in bands], below)


def within(lat: Column, lon: Column, b: Bounds) -> Column:
    return lat.between(b.lat_min, b.lat_max) & lon.between(b.lon_min, b.lon_max)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def dated(stamp: Column, start: date, end: date) -> Column:
    """``start <= date(stamp) <= end`` written on the raw column.

    Comparing the column itself, rather than a cast of it, keeps the condition a
    pushed filter of the parquet scan.
    """
    return (stamp >= F.lit(start)) & (stamp < F.lit(end + timedelta(days=1)))


def sunday_week(day: Column) -> Column:
    return F.date_sub(day, F.dayofweek(day) - F.lit(1))


def monday_week(day: Column) -> Column:
    return F.trunc(day, "week")


def week_of_year_sunday(day: Column) -> Column:
    """0..53; days before the first Sunday of the year are week 0."""
    return F.floor((F.dayofyear(day) - F.dayofweek(day) + F.lit(7)) / F.lit(7)).cast("int")


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, whatever the float noise below 1e-12."""
    return F.round(value.cast("decimal(38,12)"), digits).cast("double")


def uncut(value: Column) -> Column:
    """Any quantity as a decimal of twelve places, so that sums do not depend on row order."""
    return value.cast("decimal(38,12)")


def uncut_mean(value: Column) -> Column:
    """Mean of a quantity that is not money, such as forecasts, scores and miles."""
    return F.try_divide(F.sum(uncut(value)).cast("double"), F.count(value))


def hundredths(value: Column) -> Column:
    """Money as whole hundredths, so that sums do not depend on row order. Not for other quantities: it cuts."""
    return F.round(value * F.lit(100.0)).cast("long")


def exact_sum(value: Column) -> Column:
    return F.sum(hundredths(value)) / F.lit(100.0)


def exact_mean(value: Column) -> Column:
    return F.try_divide(F.sum(hundredths(value)), F.count(value)) / F.lit(100.0)


def mean_2dp(value: Column) -> Column:
    """Mean to two decimals, half away from zero, computed on whole hundredths."""
    return F.round(F.try_divide(F.sum(hundredths(value)), F.count(value))) / F.lit(100.0)


def tally(condition: Column) -> Column:
    """Number of rows a condition is true for; 0 on no rows."""
    return F.count(F.when(condition, F.lit(1)))


def ratio(top: Column, bottom: Column, scale: float = 1.0) -> Column:
    """NULL instead of a division by zero."""
    return F.try_divide(top, bottom) * F.lit(scale)


def percent(top: Column, bottom: Column, digits: int = 2) -> Column:
    return half_up(ratio(top, bottom) * F.lit(100.0), digits)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Min-max normalisation: 0 on a flat column, NULL for a NULL value."""
    return F.when(high == low, F.lit(0.0)).otherwise(F.try_divide(value - low, high - low))


def present(df_columns: Iterable[str], wanted: Iterable[str]) -> list[str]:
    have = set(df_columns)
    return [c for c in wanted if c in have]
