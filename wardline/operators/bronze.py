"""Quality filters and projections from raw records to the bronze tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import all_of, dated, within


def area_number(text: Column) -> Column:
    """Community area as a number; blank or non-numeric text becomes NULL."""
    return F.nullif(text.cast("string"), F.lit("")).try_cast("long")


def trip_in_bounds(cfg: Settings) -> Column:
    """Both ends of a trip inside the window. NULL coordinates never pass."""
    return all_of(
        within(
            F.col(f"{end}_centroid_latitude"), F.col(f"{end}_centroid_longitude"), cfg.bounds
        )
        for end in ("pickup", "dropoff")
    )


def trips(raw: DataFrame, cfg: Settings, kind: str) -> DataFrame:
    """Bronze trips of one kind, ``taxi`` or ``tnp``.

    Taxi records carry no sharing information, so both columns are constants there.
    """
    lim = cfg.trips
    shared, pooled = (
        (F.lit(None).cast("boolean"), F.lit(0).cast("long"))
        if kind == "taxi"
        else (F.col("shared_trip_authorized"), F.col("trips_pooled").cast("long"))
    )
    return raw.filter(
        all_of(
            [
                dated(F.col("trip_start_timestamp"), cfg.min_date, cfg.as_of),
                trip_in_bounds(cfg),
                F.col("trip_miles").between(0, lim.max_miles),
                (F.col("trip_seconds") > 0) & (F.col("trip_seconds") <= lim.max_seconds),
                F.col("fare").between(0, lim.max_fare),
            ]
        )
    ).select(
        "trip_id",
        "trip_start_timestamp",
        "trip_end_timestamp",
        "trip_seconds",
        F.round("trip_miles", 2).alias("trip_miles"),
        area_number(F.col("pickup_community_area")).alias("pickup_community_area"),
        area_number(F.col("dropoff_community_area")).alias("dropoff_community_area"),
        F.round("fare", 2).alias("fare"),
        shared.alias("shared_trip_authorized"),
        pooled.alias("trips_pooled"),
        *[
            F.round(f"{end}_centroid_{axis}", 6).alias(f"{end}_centroid_{axis}")
            for end in ("pickup", "dropoff")
            for axis in ("latitude", "longitude")
        ],
    )


def refilter_trips(bronze: DataFrame, cfg: Settings) -> DataFrame:
    """Narrow an existing bronze table to the coordinate window."""
    return bronze.filter(trip_in_bounds(cfg))


def covid_cases(raw: DataFrame, cfg: Settings) -> DataFrame:
    keys = ("zip_code", "week_start", "week_end", "row_id")
    return raw.filter(
        all_of(F.col(k).isNotNull() for k in keys)
        & dated(F.col("week_start"), cfg.min_date, cfg.as_of)
    ).select(
        "zip_code",
        "week_number",
        F.to_date("week_start").alias("week_start"),
        F.to_date("week_end").alias("week_end"),
        "cases_weekly",
        "tests_weekly",
        "deaths_weekly",
        "population",
        F.round("case_rate_weekly", 2).alias("case_rate_weekly"),
        "row_id",
    )


# Output columns in their order.
PERMIT_COLUMNS = (
    "id",
    "permit_",
    "permit_status",
    "permit_type",
    "application_start_date",
    "issue_date",
    "processing_time",
    "street_number",
    "street_direction",
    "street_name",
    "work_type",
    "work_description",
    "permit_condition",
    "total_fee",
    "reported_cost",
    "pin_list",
    "community_area",
    "latitude",
    "longitude",
)


def building_permits(raw: DataFrame, cfg: Settings) -> DataFrame:
    shaped = {
        "application_start_date": F.to_date("application_start_date"),
        "issue_date": F.to_date("issue_date"),
        "total_fee": F.round("total_fee", 2),
        "reported_cost": F.round("reported_cost", 2),
        "latitude": F.round("latitude", 6),
        "longitude": F.round("longitude", 6),
    }
    kept = raw.filter(
        dated(F.col("issue_date"), cfg.min_date, cfg.as_of)
        & within(F.col("latitude"), F.col("longitude"), cfg.bounds)
    )
    return kept.select(*[shaped.get(c, F.col(c)).alias(c) for c in PERMIT_COLUMNS])


def ccvi(raw: DataFrame) -> DataFrame:
    """Vulnerability index rows with a type, a place and a score."""
    return raw.dropna(subset=["geography_type", "community_area_or_zip", "ccvi_score"]).select(
        "geography_type",
        F.col("community_area_or_zip").cast("string").alias("community_area_or_zip"),
        F.round("ccvi_score", 3).alias("ccvi_score"),
        "ccvi_category",
        "location",
    )


def public_health(raw: DataFrame) -> DataFrame:
    return raw.dropna(subset=["per_capita_income", "community_area"]).select(
        "community_area", "community_area_name", "per_capita_income"
    )
