"""Flagged and derived views over the raw records."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import (
    all_of,
    dated,
    first_match,
    half_up,
    present,
    ratio,
    upto,
    week_of_year_sunday,
    within,
)

# Labels and limits that stored data and dashboards match on.
FEE_BANDS = [(100, "$1-100"), (500, "$101-500"), (1000, "$501-1000"), (5000, "$1001-5000"), (10000, "$5001-10000")]
FEE_ZERO, FEE_ABOVE = "No Fee", "$10000+"
PERMIT_KINDS = [
    ("New Construction", ["new construction"]),
    ("Renovation/Alteration", ["renovation", "alteration"]),
    ("Demolition", ["wrecking", "demol"]),
    ("Sign", ["sign"]),
    ("Electrical", ["electrical"]),
    ("Plumbing", ["plumb"]),
]
DAY_PARTS = [
    (6, 9, "Morning Rush (6-9am)"),
    (10, 15, "Midday (10am-3pm)"),
    (16, 19, "Evening Rush (4-7pm)"),
    (20, 23, "Evening (8-11pm)"),
]
DAY_PART_ELSE = "Late Night (12-5am)"
DISTANCE_BANDS = [(1, "0-1 miles"), (3, "1-3 miles"), (5, "3-5 miles"), (10, "5-10 miles"), (20, "10-20 miles")]
DISTANCE_ABOVE = "20+ miles"
FARE_BANDS = [(10, "$0-10"), (20, "$10-20"), (30, "$20-30"), (50, "$30-50")]
FARE_ABOVE = "$50+"
VALID = "valid"

# Output columns in their order.
_PERMIT_OUTPUT = (
    "permit_",
    "id",
    "row_id",
    "issue_date",
    "issue_date_only",
    "issue_year",
    "issue_month",
    "issue_quarter",
    "issue_day_of_week",
    "issue_month_name",
    "application_start_date",
    "processing_days",
    "permit_type",
    "permit_type_category",
    "review_type",
    "permit_status",
    "permit_milestone",
    "work_type",
    "work_description",
    "permit_condition",
    "street_number",
    "street_direction",
    "street_name",
    "latitude",
    "longitude",
    "community_area",
    "census_tract",
    "ward",
    "xcoordinate",
    "ycoordinate",
    "zip_code",
    "total_fee",
    "fee_category",
    "building_fee_paid",
    "building_fee_unpaid",
    "building_fee_waived",
    "building_fee_subtotal",
    "zoning_fee_paid",
    "zoning_fee_unpaid",
    "zoning_fee_waived",
    "zoning_fee_subtotal",
    "other_fee_paid",
    "other_fee_unpaid",
    "other_fee_waived",
    "other_fee_subtotal",
    "subtotal_paid",
    "subtotal_unpaid",
    "subtotal_waived",
    "reported_cost",
    "pin_list",
    "contact_1_type",
    "contact_1_name",
    "contact_1_city",
    "contact_1_state",
    "contact_1_zipcode",
    "contact_2_type",
    "contact_2_name",
    "contact_2_city",
    "contact_2_state",
    "contact_2_zipcode",
    "data_quality_flag",
)
# Output columns in their order.
_COVID_OUTPUT = (
    "row_id",
    "zip_code",
    "community_area",
    "week_start",
    "week_end",
    "week_start_date",
    "week_end_date",
    "year",
    "month",
    "week_number",
    "week_number_in_year",
    "cases_weekly",
    "deaths_weekly",
    "tests_weekly",
    "cases_cumulative",
    "deaths_cumulative",
    "tests_cumulative",
    "case_rate_weekly",
    "case_rate_cumulative",
    "death_rate_weekly",
    "death_rate_cumulative",
    "test_rate_weekly",
    "test_rate_cumulative",
    "cases_per_100k",
    "deaths_per_100k",
    "tests_per_100k",
    "percent_tested_positive_weekly",
    "percent_tested_positive_cumulative",
    "test_positivity_rate_calculated",
    "case_fatality_rate_pct",
    "population",
    "data_quality_flag",
    "privacy_flag",
)
# Output columns in their order.
_TAXI_OUTPUT = (
    "trip_id",
    "taxi_id",
    "trip_start_timestamp",
    "trip_end_timestamp",
    "trip_date",
    "trip_year",
    "trip_month",
    "trip_day",
    "trip_hour",
    "trip_day_of_week",
    "trip_day_name",
    "time_category",
    "is_weekend",
    "trip_seconds",
    "trip_miles",
    "avg_speed_mph",
    "distance_category",
    "pickup_census_tract",
    "dropoff_census_tract",
    "pickup_community_area",
    "dropoff_community_area",
    "pickup_centroid_latitude",
    "pickup_centroid_longitude",
    "dropoff_centroid_latitude",
    "dropoff_centroid_longitude",
    "fare",
    "tips",
    "tolls",
    "extras",
    "trip_total",
    "fare_per_mile",
    "fare_category",
    "payment_type",
    "company",
    "data_quality_flag",
)


def _outside(c: str, low: float, high: float) -> Column:
    return (F.col(c) < low) | (F.col(c) > high)


def _null_or(c: str, good: Column) -> Column:
    return F.col(c).isNull() | good


def fee_category(fee: Column) -> Column:
    """A NULL fee falls through to the highest band, as in the published view."""
    return first_match([(fee == 0, FEE_ZERO)], upto(fee, FEE_BANDS, FEE_ABOVE))


def permit_kind(text: Column) -> Column:
    """First kind one of whose words occurs in the type; order matters ("design" holds "sign")."""
    lowered = F.lower(text)
    hit = lambda words: _any(lowered.contains(w) for w in words)
    return first_match([(hit(words), kind) for kind, words in PERMIT_KINDS], "Other")


def _any(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out | c
    return out


def permit_flag(cfg: Settings) -> Column:
    c, b = F.col, cfg.bounds
    return first_match(
        [
            (c("permit_").isNull(), "missing_permit_number"),
            (c("issue_date").isNull(), "missing_issue_date"),
            (c("issue_date") > F.lit(cfg.as_of), "future_issue_date"),
            (c("issue_date") < F.lit(cfg.permit_valid_from), "invalid_issue_date"),
            (c("latitude").isNull() | c("longitude").isNull(), "missing_coordinates"),
            (_outside("latitude", b.lat_min, b.lat_max), "invalid_latitude"),
            (_outside("longitude", b.lon_min, b.lon_max), "invalid_longitude"),
            (c("total_fee") < 0, "negative_fee"),
            (c("total_fee") > cfg.max_fee, "extreme_high_fee"),
            (_outside("community_area", 1, cfg.community_areas), "invalid_community_area"),
        ],
        VALID,
    )


def flagged_permits(raw: DataFrame, cfg: Settings) -> DataFrame:
    """All permits with their flag, before any row is dropped."""
    return raw.withColumn("data_quality_flag", permit_flag(cfg))


def permits(raw: DataFrame, cfg: Settings) -> DataFrame:
    """Cleaned permits: keys required, other fields NULL or valid."""
    c = F.col
    kept = flagged_permits(raw, cfg).filter(
        all_of(
            [
                c("permit_").isNotNull(),
                dated(c("issue_date"), cfg.min_date, cfg.as_of),
                _null_or("latitude", within(c("latitude"), c("longitude"), cfg.bounds)),
                _null_or("total_fee", c("total_fee").between(0, cfg.max_fee)),
                _null_or("community_area", c("community_area").between(1, cfg.community_areas)),
            ]
        )
    )
    day = F.to_date("issue_date")
    out = kept.withColumns(
        {
            "issue_date_only": day,
            "issue_year": F.year(day),
            "issue_month": F.month(day),
            "issue_quarter": F.quarter(day),
            "issue_day_of_week": F.dayofweek(day),
            "issue_month_name": F.date_format(day, "MMMM"),
            "fee_category": fee_category(c("total_fee")),
            "permit_type_category": permit_kind(c("permit_type")),
            "processing_days": F.datediff(day, F.to_date("application_start_date")),
        }
    )
    return out.select(*present(out.columns, _PERMIT_OUTPUT))


def covid_flag(cfg: Settings) -> Column:
    c = F.col
    return first_match(
        [
            (c("zip_code").isNull(), "missing_zip_code"),
            (c("week_start").isNull(), "missing_week_start"),
            (c("week_start") > F.lit(cfg.as_of), "future_week_start"),
            (c("week_start") < F.lit(cfg.min_date), "invalid_week_start"),
            (c("population").isNull() | (c("population") == 0), "missing_population"),
            *[(c(f"{m}_weekly") < 0, f"negative_{m}") for m in ("cases", "deaths", "tests")],
        ],
        VALID,
    )


def covid(raw: DataFrame, cfg: Settings) -> DataFrame:
    c = F.col
    cases, deaths, tests, people = (
        c(n) for n in ("cases_weekly", "deaths_weekly", "tests_weekly", "population")
    )
    rate = lambda part, whole, scale: F.when(whole > 0, half_up(part / whole * scale, 2))
    flagged = raw.withColumns(
        {
            "data_quality_flag": covid_flag(cfg),
            "privacy_flag": first_match(
                [(cases.isNull() & (c("week_start") >= F.lit(cfg.covid_min_date)), "suppressed_low_count")],
                "not_suppressed",
            ),
        }
    )
    kept = flagged.filter(
        c("zip_code").isNotNull()
        & dated(c("week_start"), cfg.covid_min_date, cfg.as_of)
        & all_of(_null_or(m, c(m) >= 0) for m in ("cases_weekly", "deaths_weekly", "tests_weekly"))
    )
    start = F.to_date("week_start")
    out = kept.withColumns(
        {
            "week_start_date": start,
            "week_end_date": F.to_date("week_end"),
            "year": F.year(start),
            "month": F.month(start),
            "week_number_in_year": week_of_year_sunday(start),
            "cases_per_100k": rate(cases, people, 100000),
            "deaths_per_100k": rate(deaths, people, 100000),
            "tests_per_100k": rate(tests, people, 100000),
            "case_fatality_rate_pct": rate(deaths, cases, 100),
            "test_positivity_rate_calculated": F.when(
                (tests > 0) & cases.isNotNull(), half_up(cases / tests * 100, 2)
            ).otherwise(c("percent_tested_positive_weekly")),
        }
    )
    return out.select(*present(out.columns, _COVID_OUTPUT))


def taxi_flag(cfg: Settings) -> Column:
    c, b, lim = F.col, cfg.bounds, cfg.trips
    lat, lon = "pickup_centroid_latitude", "pickup_centroid_longitude"
    return first_match(
        [
            (c("trip_id").isNull(), "missing_trip_id"),
            (c("trip_start_timestamp").isNull(), "missing_start_timestamp"),
            (c("trip_end_timestamp").isNull(), "missing_end_timestamp"),
            (c("trip_end_timestamp") <= c("trip_start_timestamp"), "invalid_timestamps"),
            (c("trip_seconds") < lim.clean_min_seconds, "too_short"),
            (c("trip_seconds") > lim.clean_max_seconds, "too_long"),
            (c("trip_miles") < 0, "negative_miles"),
            (c("trip_miles") > lim.max_miles, "extreme_miles"),
            (c("trip_total") < 0, "negative_fare"),
            (c("trip_total") > lim.max_fare, "extreme_fare"),
            (c("fare") < 0, "negative_base_fare"),
            (c(lat).isNull() | c(lon).isNull(), "missing_pickup_coords"),
            (_outside(lat, b.lat_min, b.lat_max), "invalid_pickup_lat"),
            (_outside(lon, b.lon_min, b.lon_max), "invalid_pickup_lon"),
            (_outside("dropoff_centroid_latitude", b.lat_min, b.lat_max), "invalid_dropoff_lat"),
            (_outside("dropoff_centroid_longitude", b.lon_min, b.lon_max), "invalid_dropoff_lon"),
        ],
        VALID,
    )


def day_part(hour: Column) -> Column:
    return first_match([(hour.between(a, b), label) for a, b, label in DAY_PARTS], DAY_PART_ELSE)


def taxi(raw: DataFrame, cfg: Settings) -> DataFrame:
    """Cleaned taxi trips with time parts, speed, price per mile and bands."""
    c, lim = F.col, cfg.trips
    kept = raw.withColumn("data_quality_flag", taxi_flag(cfg)).filter(
        all_of(
            [
                c("trip_id").isNotNull(),
                c("trip_end_timestamp") > c("trip_start_timestamp"),
                dated(c("trip_start_timestamp"), cfg.min_date, cfg.as_of),
                c("trip_seconds").between(lim.clean_min_seconds, lim.clean_max_seconds),
                c("trip_miles").between(0, lim.max_miles),
                c("trip_total").between(0, lim.max_fare),
                c("fare") >= 0,
                _null_or(
                    "pickup_centroid_latitude",
                    within(c("pickup_centroid_latitude"), c("pickup_centroid_longitude"), cfg.bounds),
                ),
            ]
        )
    )
    start, day = c("trip_start_timestamp"), F.to_date("trip_start_timestamp")
    miles, seconds, total = c("trip_miles"), c("trip_seconds"), c("trip_total")
    out = kept.withColumns(
        {
            "trip_date": day,
            "trip_year": F.year(day),
            "trip_month": F.month(day),
            "trip_day": F.dayofmonth(day),
            "trip_hour": F.hour(start),
            "trip_day_of_week": F.dayofweek(day),
            "trip_day_name": F.date_format(day, "EEEE"),
            "time_category": day_part(F.hour(start)),
            "is_weekend": F.dayofweek(day).isin(1, 7),
            "avg_speed_mph": F.when((seconds > 0) & (miles > 0), half_up(miles * 3600.0 / seconds, 2)),
            "fare_per_mile": F.when(miles > 0, half_up(ratio(total, miles), 2)),
            "distance_category": upto(miles, DISTANCE_BANDS, DISTANCE_ABOVE),
            "fare_category": upto(total, FARE_BANDS, FARE_ABOVE),
        }
    )
    return out.select(*present(out.columns, _TAXI_OUTPUT))


def recent(view: DataFrame, day: str, cfg: Settings, days: int = 30) -> DataFrame:
    """The part of a view not older than ``days`` before ``as_of``."""
    return view.filter(F.col(day) >= F.lit(cfg.as_of - timedelta(days=days)))
