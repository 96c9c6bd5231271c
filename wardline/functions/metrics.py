"""Error metrics of predictions as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mape(actual: Column, predicted: Column, mode: str = "plain") -> Column:
    """Mean absolute percentage error.

    ``plain`` divides by the actual value and is infinite when one is 0;
    ``positive`` leaves out actual values of 0 or less, and is 0 when none is left;
    ``floored`` divides by the actual value or 1, whichever is larger.
    """
    gap = F.abs(actual - predicted)
    if mode == "plain":
        term = F.when(
            actual == 0, F.when(gap == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
        ).otherwise(gap / F.abs(F.nullif(actual, F.lit(0.0))))
        return F.avg(term) * 100
    if mode == "positive":
        return F.coalesce(F.avg(F.when(actual > 0, F.try_divide(gap, actual))) * 100, F.lit(0.0))
    if mode == "floored":
        return F.avg(gap / F.greatest(actual, F.lit(1.0))) * 100
    raise ValueError(f"unknown mode {mode!r}")


def error_metrics(actual: str, predicted: str, mape_mode: str = "plain") -> dict[str, Column]:
    """MAE, RMSE, MAPE and R squared in one pass.

    R squared is 1 for a perfect fit of a constant series and 0 for any other fit
    of one.
    """
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    squared = F.sum((a - p) * (a - p))
    spread = F.var_pop(a) * F.count(a)
    return {
        "mae": F.avg(F.abs(a - p)),
        "rmse": F.sqrt(F.avg((a - p) * (a - p))),
        "mape": mape(a, p, mape_mode),
        "r_squared": F.when(spread == 0, F.when(squared == 0, 1.0).otherwise(0.0)).otherwise(
            1 - squared / F.nullif(spread, F.lit(0.0))
        ),
    }
