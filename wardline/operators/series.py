"""Window functions over long time series, split by calendar interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous_value(
    df: DataFrame, keys: list[str], order: str, value: str, name: str, interval: str = "year"
) -> DataFrame:
    """Value of the previous row of the same key.

    Rows are ordered inside (key, interval) only. The first row of an interval
    takes the last value of the interval before it, which comes from an aggregate
    with one row per key and interval. A key that holds most of the data is thus
    spread over as many tasks as it has intervals.
    """
    span = F.date_trunc(interval, F.col(order)).alias("_span")
    rows = df.withColumn("_span", F.date_trunc(interval, F.col(order)))
    tails = df.groupBy(*keys, span).agg(F.max_by(value, order).alias("_tail"))
    along = Window.partitionBy(*keys).orderBy("_span")
    carried = tails.select(*keys, "_span", F.lag("_tail").over(along).alias("_carry"))
    inside = Window.partitionBy(*keys, "_span").orderBy(order)
    at_start = F.row_number().over(inside) == 1
    return (
        rows.withColumn("_start", at_start)
        .withColumn(name, F.lag(value).over(inside))
        .join(carried, [*keys, "_span"], "left")
        .withColumn(name, F.when(F.col("_start"), F.col("_carry")).otherwise(F.col(name)))
        .drop("_span", "_start", "_carry")
    )


def running_total(per_period: DataFrame, period: str, value: str, name: str) -> DataFrame:
    """Cumulative sum over calendar periods.

    The input has to be aggregated to one row per period, so the ordered set grows
    with the calendar and not with the data.
    """
    w = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_period.withColumn(name, F.sum(value).over(w))


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], limit: int, rank: str = "_rank"
) -> DataFrame:
    """First ``limit`` rows of each group.

    The rank limit is applied before the shuffle as well as after it, so a group
    never sends more than ``limit`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= limit)
