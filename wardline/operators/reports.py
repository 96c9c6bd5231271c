"""Table profiles and the short reports published beside each layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.columns import exact_mean, first_match, half_up, percent, sunday_week, tally


def profile(df: DataFrame, spec: dict[str, Column], label: tuple[str, str] | None = None) -> DataFrame:
    """One row of named aggregates, with an optional constant label in front."""
    head = [F.lit(label[1]).alias(label[0])] if label else []
    return df.agg(*head, *[c.alias(n) for n, c in spec.items()])


def rows() -> Column:
    return F.count(F.lit(1))


def hourly_or_daily_profile(gold: DataFrame) -> DataFrame:
    return profile(
        gold,
        {
            "total_records": rows(),
            "unique_pickup_zips": F.count_distinct("pickup_zip"),
            "unique_dropoff_zips": F.count_distinct("dropoff_zip"),
            "unique_dates": F.count_distinct("trip_date"),
            "earliest_date": F.min("trip_date"),
            "latest_date": F.max("trip_date"),
            "total_trips": F.sum("trip_count"),
            "overall_avg_miles": half_up(exact_mean(F.col("avg_miles")), 2),
            "overall_avg_fare": half_up(exact_mean(F.col("avg_fare")), 2),
        },
    )


def routes_profile(routes: DataFrame) -> DataFrame:
    return profile(
        routes,
        {
            "total_routes": rows(),
            "total_trips": F.sum("trip_count"),
            "overall_avg_fare": half_up(exact_mean(F.col("avg_fare")), 2),
            "overall_avg_miles": half_up(exact_mean(F.col("avg_miles")), 2),
            "combined_revenue": half_up(F.sum("total_revenue"), 2),
            "min_rank": F.min("rank"),
            "max_rank": F.max("rank"),
        },
    )


def roi_profile(roi: DataFrame) -> DataFrame:
    return profile(
        roi,
        {
            "total_zip_codes": rows(),
            "overall_permits": F.sum("total_permits"),
            "overall_permit_value": half_up(F.sum("total_permit_value"), 2),
            "avg_of_avg_permit_value": half_up(exact_mean(F.col("avg_permit_value")), 2),
            "min_permits_per_zip": F.min("total_permits"),
            "max_permits_per_zip": F.max("total_permits"),
        },
    )


def hotspots_profile(hotspots: DataFrame) -> DataFrame:
    mean = lambda c: half_up(exact_mean(F.col(c)), 2)
    band = F.col("risk_category")
    return profile(
        hotspots,
        {
            "total_records": rows(),
            "unique_zips": F.count_distinct("zip_code"),
            "unique_weeks": F.count_distinct("week_start"),
            "earliest_week": F.min("week_start"),
            "latest_week": F.max("week_start"),
            "avg_mobility_risk": mean("mobility_risk_rate"),
            "avg_epi_risk": mean("epi_risk"),
            "avg_adjusted_risk": mean("adjusted_risk_score"),
            **{f"{b.lower()}_risk_weeks": tally(band == b) for b in ("High", "Medium", "Low")},
        },
    )


def loans_profile(loans: DataFrame) -> DataFrame:
    """Profile of the eligible ZIPs."""
    return profile(
        loans.filter("is_loan_eligible"),
        {
            "total_zip_codes": rows(),
            "eligible_zip_codes": tally(F.col("is_loan_eligible")),
            "avg_per_capita_income": half_up(F.avg("per_capita_income"), 0),
            "avg_eligibility_index": half_up(exact_mean(F.col("eligibility_index")), 2),
            "min_income": F.min("per_capita_income"),
            "max_income": F.max("per_capita_income"),
            "avg_new_construction_permits": half_up(F.avg("total_permits_new_construction"), 0),
        },
    )


def forecasts_profile(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("model_name").agg(
        rows().alias("total_forecasts"),
        F.count_distinct("zip_code").alias("unique_zips"),
        F.count_distinct("forecast_date").alias("unique_dates"),
        F.min("forecast_date").alias("earliest_forecast"),
        F.max("forecast_date").alias("latest_forecast"),
        half_up(exact_mean(F.col("predicted_trip_count")), 2).alias("avg_predicted_trips"),
    )


# Checks of the economic views.


def check_economic_dashboard(view: DataFrame) -> DataFrame:
    return profile(
        view,
        {
            "total_zips": rows(),
            "priority_levels": F.count_distinct("priority_category"),
            "eligible_zips": tally(F.col("is_loan_eligible")),
            "avg_income": half_up(F.avg("per_capita_income"), 0),
            "total_new_construction": F.sum("total_permits_new_construction"),
        },
        ("view_name", "v_economic_dashboard"),
    )


def check_permits_timeline(view: DataFrame) -> DataFrame:
    return profile(
        view,
        {
            "total_permits": rows(),
            "first_date": F.min("issue_date"),
            "last_date": F.max("issue_date"),
            "zip_count": F.count_distinct("zip_code"),
            "quarters": F.count_distinct("year_quarter"),
            "total_reported_cost": half_up(F.sum("reported_cost"), 0),
            "total_fees": half_up(F.sum("total_fee"), 0),
        },
        ("view_name", "v_permits_timeline"),
    )


def check_permits_by_area(view: DataFrame) -> DataFrame:
    return profile(
        view.filter(F.col("permit_count") > 0),
        {
            "total_zips": rows(),
            "total_permits": F.sum("permit_count"),
            "avg_income": half_up(F.avg("per_capita_income"), 0),
            "eligible_zips": tally(F.col("is_loan_eligible")),
            "total_project_cost": half_up(F.sum("total_cost"), 0),
            "avg_permits_per_1k": half_up(exact_mean(F.col("permits_per_1000_residents")), 2),
        },
        ("view_name", "v_permits_by_area"),
    )


def check_monthly_summary(view: DataFrame) -> DataFrame:
    return profile(
        view,
        {
            "total_months": rows(),
            "total_permits": F.sum("permit_count"),
            "first_month": F.min("month_start"),
            "last_month": F.max("month_start"),
            "avg_permits_per_month": half_up(F.avg("permit_count"), 1),
            "peak_month_permits": F.max("permit_count"),
        },
        ("view_name", "v_monthly_permit_summary"),
    )


def check_fee_analysis(view: DataFrame) -> DataFrame:
    return profile(
        view,
        {
            "total_zips": rows(),
            "total_permits": F.sum("permit_count"),
            "total_fees": half_up(F.sum("total_fees_collected"), 0),
            "overall_avg_fee": half_up(F.avg("avg_fee"), 0),
            "avg_fee_rate_pct": half_up(exact_mean(F.col("effective_fee_rate_pct")), 2),
        },
        ("view_name", "v_fee_analysis"),
    )


def layer_statistics(bronze: DataFrame, silver: DataFrame, roi: DataFrame, loans: DataFrame) -> DataFrame:
    """Statistics of the permit layers as (layer, metric, value) rows(), values as text."""
    text = lambda c: c.cast("string")
    dates = {"oldest_permit": F.min("issue_date"), "newest_permit": F.max("issue_date")}
    parts = {
        "BRONZE": (bronze, {"total_records": rows(), "unique_ids": F.count_distinct("id"), **dates}),
        "SILVER": (
            silver,
            {
                "total_records": rows(),
                "unique_ids": F.count_distinct("id"),
                "unique_zips": F.count_distinct("zip_code"),
                "missing_zip": tally(F.col("zip_code").isNull()),
                **dates,
            },
        ),
        "GOLD - Permits ROI": (
            roi,
            {
                "total_zip_codes": rows(),
                "total_permits": F.sum("total_permits"),
                "total_value": half_up(F.sum("total_permit_value"), 2).cast("decimal(38,2)"),
            },
        ),
        "GOLD - Loan Targets": (
            loans,
            {
                "total_zip_codes": rows(),
                "eligible_zips": tally(F.col("is_loan_eligible")),
                "avg_eligibility": half_up(exact_mean(F.col("eligibility_index")), 2).cast("decimal(38,2)"),
            },
        ),
    }
    long = [
        df.agg(*[text(c).alias(n) for n, c in spec.items()])
        .unpivot([], list(spec), "metric", "value")
        .select(F.lit(layer).alias("layer"), "metric", "value")
        for layer, (df, spec) in parts.items()
    ]
    return reduce(DataFrame.unionByName, long)


# Short reports over the silver and gold tables.


def airport_share(trips: DataFrame) -> DataFrame:
    hits = tally(F.col("is_airport_trip"))
    return trips.groupBy("source_dataset").agg(
        rows().alias("total_trips"), hits.alias("airport_trips"), percent(hits, rows()).alias("airport_pct")
    )


def enrichment_rate(trips: DataFrame) -> DataFrame:
    found = lambda end: tally(F.col(f"{end}_zip").isNotNull())
    return trips.groupBy("source_dataset").agg(
        rows().alias("total"),
        *[
            c
            for end in ("pickup", "dropoff")
            for c in (
                found(end).alias(f"{end}_zip_enriched"),
                percent(found(end), rows()).alias(f"{end}_zip_pct"),
            )
        ],
    )


def permits_by_neighborhood(permits: DataFrame, year: int, limit: int = 10) -> DataFrame:
    return (
        permits.filter(F.col("permit_year") == year)
        .groupBy("neighborhood")
        .agg(
            rows().alias("permit_count"),
            half_up(exact_mean(F.col("total_fee")), 2).alias("avg_fee"),
            half_up(F.avg("processing_time"), 0).alias("avg_processing_days"),
        )
        .orderBy(F.desc("permit_count"), "neighborhood")
        .limit(limit)
    )


def risk_distribution(latest: DataFrame) -> DataFrame:
    return latest.groupBy("risk_category").agg(
        rows().alias("zip_count"),
        half_up(exact_mean(F.col("case_rate_weekly")), 2).alias("avg_case_rate"),
        F.sum("population").alias("total_population"),
    )


def high_risk_by_type(ccvi: DataFrame) -> DataFrame:
    return ccvi.groupBy("geography_type").agg(
        rows().alias("high_risk_count"), half_up(F.avg("ccvi_score"), 3).alias("avg_score")
    )


def top_hotspots(hotspots: DataFrame, limit: int = 20) -> DataFrame:
    return (
        hotspots.filter(F.col("risk_category") == "High")
        .select(
            "zip_code", "week_start", "risk_category", "adjusted_risk_score", "mobility_risk_rate", "epi_risk"
        )
        .orderBy(F.desc("adjusted_risk_score"), "zip_code", "week_start")
        .limit(limit)
    )


_LOAN = ["zip_code", "per_capita_income", "total_permits_new_construction", "eligibility_index", "is_loan_eligible"]


def eligible_zips(loans: DataFrame) -> DataFrame:
    return loans.filter("is_loan_eligible").select(*_LOAN)


def top_eligible_zips(loans: DataFrame, income_limit: float, limit: int = 10) -> DataFrame:
    return (
        loans.filter(F.col("is_loan_eligible") & (F.col("per_capita_income") < income_limit))
        .select(*_LOAN)
        .orderBy(F.desc("eligibility_index"), "zip_code")
        .limit(limit)
    )


def hours_by_zip(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("pickup_zip", "trip_hour").agg(
        F.sum("trip_count").alias("total_trips"), half_up(exact_mean(F.col("avg_fare")), 2).alias("avg_fare")
    )


def cases_by_area(apportioned: DataFrame) -> DataFrame:
    """Weekly estimated cases per community area, over primary ZIP relations only."""
    return (
        apportioned.filter("is_primary_zip")
        .groupBy("week_start", "community_area_name")
        .agg(F.sum("estimated_cases_in_community_area").alias("total_cases"))
    )


def areas_of_zip(community_zip: DataFrame, zip_code: str) -> DataFrame:
    return community_zip.filter(F.col("zip_code") == zip_code).select(
        "zip_code", "community_area_name", "pct_of_zip", "pct_of_community_area", "is_primary_zip"
    )


def zips_of_neighborhood(zip_hood: DataFrame, name: str) -> DataFrame:
    return zip_hood.filter(F.col("neighborhood_name") == name).select(
        "neighborhood_name", "zip_code", "pct_of_neighborhood", "is_primary_neighborhood"
    )


def distribute(per_zip: DataFrame, community_zip: DataFrame, metric: str, name: str = "distributed_metric") -> DataFrame:
    """A ZIP-level metric spread over community areas by area share; summed per ZIP before it is spread."""
    total = per_zip.groupBy("zip_code").agg(F.sum(metric).alias("_total"))
    part = F.col("_total") * F.round(F.col("pct_of_zip") * 100).cast("long")
    return (
        total.join(community_zip, "zip_code")
        .groupBy("community_area_number", "community_area_name")
        .agg((F.sum(part) / 10000.0).alias(name))
    )


def trips_from_high_risk(trips: DataFrame, ccvi: DataFrame, kind: str = "CA") -> DataFrame:
    """Weekly trips that start in a high-risk area. Counted per week and area before the areas are checked."""
    per_area = trips.groupBy(sunday_week(F.col("trip_date")).alias("week"), "pickup_community_area").agg(
        rows().alias("n"),
        F.sum(F.round(F.col("fare") * 100).cast("long")).alias("cents"),
        F.count("fare").alias("fares"),
    )
    risky = ccvi.filter(F.col("geography_type") == kind).select(
        F.col("geography_id").cast("long").alias("pickup_community_area")
    )
    return (
        per_area.join(risky, "pickup_community_area", "left_semi")
        .groupBy("week")
        .agg(
            F.sum("n").alias("trips_from_high_ccvi"),
            (F.try_divide(F.sum("cents"), F.sum("fares")) / 100.0).alias("avg_fare"),
        )
    )


def investment_areas(health: DataFrame, permits: DataFrame, limit: int = 5) -> DataFrame:
    """Areas by unemployment and poverty, with their permits. Permits are counted before they join."""
    per_area = permits.groupBy("community_area").agg(
        F.count("id").alias("total_permits"),
        F.sum(F.round(F.col("total_fee") * 100).cast("long")).alias("cents"),
    )
    return (
        health.filter(F.col("unemployment").isNotNull())
        .join(per_area, "community_area", "left")
        .select(
            "community_area_name",
            "unemployment",
            F.col("below_poverty_level").alias("poverty_rate"),
            "per_capita_income",
            F.coalesce("total_permits", F.lit(0)).alias("total_permits"),
            (F.col("cents") / 100.0).alias("total_fees_charged"),
        )
        .orderBy(F.desc("unemployment"), F.desc("poverty_rate"), "community_area_name")
        .limit(limit)
    )
