"""Exact order statistics per group without collecting a group.

A mergeable sketch picks two values just below and above the wanted rank, rows are
counted per (group, side) with map-side combine, and only the side that holds the
rank, as a rule the narrow middle, is ordered. The sketch decides where the work
happens; the counts decide the answer, so the result is exact whatever the sketch
error is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_median(df: DataFrame, keys: list[str], value: str, name: str, spread: float = 0.005) -> DataFrame:
    """Median with linear interpolation of ``value`` over the rows of each group.

    ``spread`` is the share of rows the middle reaches to either side of the median.
    """
    rows = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    cuts = f"array({0.5 - spread!r}D, {0.5 + spread!r}D)"
    per_group = rows.groupBy(*keys).agg(
        F.expr(f"percentile_approx({value}, {cuts}, 10000)").alias("_cuts"), F.sum("_n").alias("_total")
    )
    above = lambda i: (F.col(value) > F.get("_cuts", F.lit(i))).cast("int")
    placed = rows.join(per_group, keys).select(*keys, value, "_n", "_total", (above(0) + above(1)).alias("_part"))
    # At most three rows per group from here to the choice of side.
    counted = placed.groupBy(*keys, "_total", "_part").agg(F.sum("_n").alias("_in"))
    along = Window.partitionBy(*keys).orderBy("_part")
    low, high = F.floor((F.col("_total") - 1) / 2), F.ceil((F.col("_total") - 1) / 2)
    wanted = counted.withColumn("_before", F.sum("_in").over(along) - F.col("_in")).filter(
        (low < F.col("_before") + F.col("_in")) & (high >= F.col("_before"))
    )
    inner = Window.partitionBy(*keys, "_part").orderBy(value)
    ranked = placed.join(wanted.select(*keys, "_part", "_before"), [*keys, "_part"]).withColumn(
        "_last", F.col("_before") + F.sum("_n").over(inner)
    )
    first = F.col("_last") - F.col("_n")
    at = lambda rank: F.max(F.when((first <= rank) & (rank < F.col("_last")), F.col(value)))
    return (
        ranked.groupBy(*keys)
        .agg(at(low).alias("_lo"), at(high).alias("_hi"))
        .select(*keys, ((F.col("_lo") + F.col("_hi")) / 2).alias(name))
    )
