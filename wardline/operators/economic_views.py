"""Loan, permit and fee views of the economic dashboard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import (
    exact_mean,
    exact_sum,
    first_match,
    from_,
    half_up,
    hundredths,
    month_of,
    tally,
    uncut,
)
from wardline.operators.gold import UNKNOWN
from wardline.operators.series import running_total

# Priority bands, project sizes, the permit type and the years counted.
PRIORITY = [(0.8, "High Priority"), (0.5, "Medium Priority"), (0.3, "Low Priority")]
PRIORITY_BELOW = "Not Eligible"
SIZES = [(1_000_000, "Large ($1M+)"), (500_000, "Medium ($500K-$1M)"), (100_000, "Small ($100K-$500K)")]
SIZE_MINIMAL, SIZE_UNKNOWN = "Minimal (<$100K)", "Unknown"
NEW_CONSTRUCTION_TYPE = "PERMIT - NEW CONSTRUCTION"
FEE_YEARS = (2025, 2024, 2023, 2022, 2021, 2020)


def economic_dashboard(loans: DataFrame) -> DataFrame:
    need = (F.col("inverted_income_index") + F.col("inverted_new_construction_index")) / 2
    return (
        loans.filter((F.col("zip_code") != UNKNOWN) & (F.col("population") > 0))
        .withColumn("priority_category", from_(F.col("eligibility_index"), PRIORITY, PRIORITY_BELOW))
        .withColumn("investment_need_score", half_up(need, 3))
    )


def project_size(cost: Column) -> Column:
    return first_match(
        [*[(cost >= low, label) for low, label in SIZES], (cost > 0, SIZE_MINIMAL)], SIZE_UNKNOWN
    )


def permits_timeline(permits: DataFrame, cfg: Settings) -> DataFrame:
    """New-construction permits with calendar periods, fee share and size band."""
    day, cost, fee = F.col("issue_date"), F.col("reported_cost"), F.col("total_fee")
    return permits.filter(
        (F.col("permit_type") == NEW_CONSTRUCTION_TYPE) & (day >= F.lit(cfg.min_date))
    ).select(
        F.col("id").alias("permit_id"),
        "issue_date",
        "permit_year",
        "permit_month",
        month_of(day).alias("month_start"),
        F.trunc(day, "quarter").alias("quarter_start"),
        F.date_format(day, "yyyy-'Q'q").alias("year_quarter"),
        "zip_code",
        "community_area",
        "neighborhood",
        "permit_type",
        "permit_status",
        "work_type",
        "total_fee",
        "reported_cost",
        "processing_time",
        F.when(cost > 0, half_up(fee / cost * 100, 2)).alias("fee_pct_of_cost"),
        project_size(cost).alias("project_size"),
    )


def permits_by_area(permits: DataFrame, loans: DataFrame) -> DataFrame:
    """New-construction totals per ZIP beside its loan measures; either side may be missing."""
    per_zip = (
        permits.filter(
            (F.col("permit_type") == NEW_CONSTRUCTION_TYPE)
            & F.col("issue_date").isNotNull()
            & (F.col("zip_code") != UNKNOWN)
        )
        .groupBy("zip_code")
        .agg(
            F.count(F.lit(1)).alias("permit_count"),
            exact_sum(F.col("reported_cost")).alias("total_cost"),
            exact_mean(F.col("reported_cost")).alias("avg_cost"),
            exact_sum(F.col("total_fee")).alias("total_fees"),
            exact_mean(F.col("total_fee")).alias("avg_fee"),
            F.min("issue_date").alias("first_permit_date"),
            F.max("issue_date").alias("last_permit_date"),
            F.avg("processing_time").alias("avg_processing_days"),
        )
    )
    social = loans.filter(F.col("zip_code") != UNKNOWN).select(
        "zip_code",
        "population",
        "per_capita_income",
        "eligibility_index",
        "is_loan_eligible",
        "inverted_income_index",
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    people, income = F.col("population"), F.col("per_capita_income")
    over = lambda top, bottom, scale, name: F.when(
        bottom > 0, half_up(top / bottom * scale, 2)
    ).otherwise(F.lit(0.0)).alias(name)
    return per_zip.join(social, "zip_code", "full").select(
        "zip_code",
        *map(zero, ["permit_count", "total_cost", "avg_cost", "total_fees", "avg_fee", "avg_processing_days"]),
        "first_permit_date",
        "last_permit_date",
        *map(zero, ["population", "per_capita_income", "eligibility_index"]),
        F.coalesce("is_loan_eligible", F.lit(False)).alias("is_loan_eligible"),
        zero("inverted_income_index"),
        over(F.col("permit_count"), people, 1000, "permits_per_1000_residents"),
        over(F.col("avg_cost"), income, 1, "cost_to_income_ratio"),
    )


def monthly_permit_summary(timeline: DataFrame) -> DataFrame:
    cost = F.col("reported_cost")
    sized = lambda low, high: tally((cost >= low) & (cost < high))
    return timeline.groupBy("month_start", "permit_year", "permit_month", "year_quarter").agg(
        F.count(F.lit(1)).alias("permit_count"),
        F.count_distinct("zip_code").alias("active_zips"),
        exact_sum(cost).alias("total_reported_cost"),
        exact_mean(cost).alias("avg_reported_cost"),
        exact_sum(F.col("total_fee")).alias("total_fees"),
        exact_mean(F.col("total_fee")).alias("avg_fee"),
        F.avg("processing_time").alias("avg_processing_days"),
        tally(cost >= 1_000_000).alias("large_projects"),
        sized(500_000, 1_000_000).alias("medium_projects"),
        sized(100_000, 500_000).alias("small_projects"),
        tally((cost > 0) & (cost < 100_000)).alias("minimal_projects"),
    )


def fee_analysis(timeline: DataFrame, years: tuple[int, ...] = FEE_YEARS) -> DataFrame:
    fee, cost = F.col("total_fee"), F.col("reported_cost")
    fee_sum, cost_sum = F.sum(hundredths(fee)), F.sum(hundredths(cost))
    return (
        timeline.filter(F.col("zip_code") != UNKNOWN)
        .groupBy("zip_code")
        .agg(
            F.count(F.lit(1)).alias("permit_count"),
            exact_sum(fee).alias("total_fees_collected"),
            exact_mean(fee).alias("avg_fee"),
            F.min(fee).alias("min_fee"),
            F.max(fee).alias("max_fee"),
            exact_sum(cost).alias("total_project_value"),
            exact_mean(cost).alias("avg_project_value"),
            F.when(cost_sum > 0, half_up(fee_sum / cost_sum * 100, 2))
            .otherwise(F.lit(0.0))
            .alias("effective_fee_rate_pct"),
            F.avg("processing_time").alias("avg_processing_days"),
            *[tally(F.col("permit_year") == y).alias(f"permits_{y}") for y in years],
        )
    )


def kpis(dashboard: DataFrame, timeline: DataFrame, monthly: DataFrame) -> DataFrame:
    """Five headline figures as (metric, value) rows.

    Each source is aggregated once to one row and turned into rows after that.
    """
    months = lambda c: F.year(c) * 12 + F.month(c)
    span = months(F.max("month_start")) - months(F.min("month_start"))
    zips = F.count_distinct("zip_code")
    eligible = F.count_distinct(F.when(F.col("is_loan_eligible"), F.col("zip_code")))
    figures = [
        (dashboard, {"Total ZIPs with data": zips, "Loan eligible ZIPs": eligible}),
        (timeline, {"Total NEW CONSTRUCTION permits": F.count(F.lit(1))}),
        (
            monthly,
            {
                "Date range (months)": span,
                "Average permits per month": F.round(F.avg("permit_count")),
            },
        ),
    ]
    parts = [_long(df.agg(*[v.cast("long").alias(n) for n, v in cols.items()])) for df, cols in figures]
    return reduce(DataFrame.unionByName, parts)


def _long(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "metric", "value")


def cumulative_permits(monthly: DataFrame) -> DataFrame:
    """Monthly permits with a running total."""
    per_month = monthly.groupBy("month_start").agg(F.sum("permit_count").alias("permit_count"))
    return running_total(per_month, "month_start", "permit_count", "cumulative_permits")


def uncertainty_percent(forecasts: DataFrame) -> DataFrame:
    """Mean uncertainty range over mean prediction per ZIP, in percent (a ratio of means)."""
    total = lambda c: F.sum(uncut(c)).cast("double")
    width = total(F.col("yhat_upper") - F.col("yhat_lower"))
    return forecasts.groupBy("zip_code").agg(
        half_up(F.try_divide(width, total(F.col("yhat"))) * 100, 2).alias("uncertainty_percent")
    )
