"""Airport and rush-hour views."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import exact_mean, first_match, half_up, monday_week, month_of

# Airport areas and ZIPs of the airport view. The enriched trip
# table flags airports by another pair of ZIPs.
OHARE_AREA, MIDWAY_AREA = 76, 56
OHARE_ZIP, MIDWAY_ZIP = "60666", "60638"

# The eight windows, as (first hour, hour after the last, label).
# The seventh wraps past midnight; hours between windows belong to none.
WINDOWS = [
    (5, 7, "1. 5 AM - 7 AM", "Early Morning"),
    (7, 9, "2. 7 AM - 9 AM", "Morning Rush"),
    (11, 13, "3. 11 AM - 1 PM", "Midday"),
    (14, 16, "4. 2 PM - 4 PM", "Afternoon"),
    (16, 18, "5. 4 PM - 6 PM", "Evening Rush"),
    (19, 21, "6. 7 PM - 9 PM", "Evening"),
    (22, 25, "7. 10 PM - 12 AM", "Late Night"),
    (2, 4, "8. 2 AM - 4 AM", "Overnight"),
]


def airport_trips(trips: DataFrame) -> DataFrame:
    """Trips that end at an airport, by community area or by ZIP."""
    area, zip_ = F.col("dropoff_community_area"), F.col("dropoff_zip")
    return trips.filter(
        area.isin(OHARE_AREA, MIDWAY_AREA) | zip_.isin(OHARE_ZIP, MIDWAY_ZIP)
    ).select(
        "trip_id",
        "trip_date",
        "trip_hour",
        "trip_start_timestamp",
        "trip_end_timestamp",
        "trip_miles",
        "fare",
        "pickup_community_area",
        "pickup_zip",
        "pickup_neighborhood",
        "dropoff_community_area",
        "dropoff_zip",
        "dropoff_neighborhood",
        "shared_trip_authorized",
        "trips_pooled",
        first_match(
            [
                ((area == OHARE_AREA) | (zip_ == OHARE_ZIP), "O'Hare"),
                ((area == MIDWAY_AREA) & (zip_ == MIDWAY_ZIP), "Midway"),
            ],
            "Other",
        ).alias("airport_destination"),
        F.lit(True).alias("is_airport_trip"),
        monday_week(F.col("trip_date")).alias("week_start"),
        month_of(F.col("trip_date")).alias("month_start"),
    )



def airport_covid_overlay(airport: DataFrame, hotspots: DataFrame, covid_week=None) -> DataFrame:
    """Weekly airport trips beside the city's weekly cases.

    Trips use Monday weeks and the risk table keeps the weeks of its source. When
    the source weeks start on Sunday the two never meet and the COVID columns are
    all 0, as in the published view; ``covid_week`` maps the source week to
    another day to line them up.
    """
    week = F.col("week_start") if covid_week is None else covid_week(F.col("week_start"))
    covid = hotspots.groupBy(week.alias("week_start")).agg(
        F.sum("cases_weekly").alias("cases"), exact_mean(F.col("adjusted_risk_score")).alias("risk")
    )
    trips = airport.groupBy("week_start", "airport_destination").agg(
        F.count(F.lit(1)).alias("airport_trips"),
        exact_mean(F.col("fare")).alias("avg_fare"),
        exact_mean(F.col("trip_miles")).alias("avg_miles"),
    )
    return trips.join(covid, "week_start", "left").select(
        "week_start",
        "airport_destination",
        "airport_trips",
        "avg_fare",
        "avg_miles",
        F.coalesce("cases", F.lit(0)).alias("total_covid_cases"),
        F.coalesce("risk", F.lit(0.0)).alias("avg_risk_score"),
    )


def airport_hourly(airport: DataFrame, cfg: Settings, days: int = 90) -> DataFrame:
    return (
        airport.filter(F.col("trip_date") >= F.lit(cfg.as_of - timedelta(days=days)))
        .groupBy("trip_hour", "airport_destination")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            exact_mean(F.col("fare")).alias("avg_fare"),
            exact_mean(F.col("trip_miles")).alias("avg_miles"),
        )
    )


def airport_counts(airport: DataFrame) -> DataFrame:
    return airport.groupBy("airport_destination").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.min("trip_date").alias("first_trip"),
        F.max("trip_date").alias("last_trip"),
    )


# ---------------------------------------------------------------- rush hour


def rush_hour_base(hourly: DataFrame) -> DataFrame:
    """Trips per pickup ZIP, date, hour and kind of day, from the hourly gold table."""
    weekend = F.dayofweek("trip_date").isin(1, 7)
    return hourly.groupBy(
        F.col("pickup_zip").alias("zip_code"),
        "trip_date",
        "trip_hour",
        F.when(weekend, "Weekend").otherwise("Weekday").alias("day_type"),
    ).agg(F.sum("trip_count").alias("trip_count"))


def time_window(hour: Column, with_name: bool = False) -> Column:
    label = lambda text, name: f"{text} ({name})" if with_name else text
    # Hour 0 is read as 24, which only the window that wraps can contain.
    shifted = F.when(hour == 0, F.lit(24)).otherwise(hour)
    return first_match([((shifted >= a) & (shifted < b), label(t, n)) for a, b, t, n in WINDOWS], "Other")


def window_totals(base: DataFrame, cfg: Settings, with_name: bool = False, days: int = 30) -> DataFrame:
    return (
        base.filter(F.col("trip_date") >= F.lit(cfg.as_of - timedelta(days=days)))
        .withColumn("time_window", time_window(F.col("trip_hour"), with_name))
        .filter(F.col("time_window") != "Other")
        .groupBy("zip_code", "trip_hour", "day_type", "time_window")
        .agg(F.sum("trip_count").alias("total_trips"))
    )


def _quartiles(by: list[str], totals: DataFrame) -> DataFrame:
    """Counts, range and quartiles per group. The quantile sketch has a fixed size."""
    q = F.percentile_approx("total_trips", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10000))
    return (
        totals.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("data_points"),
            F.min("total_trips").alias("absolute_min"),
            F.max("total_trips").alias("absolute_max"),
            F.sum("total_trips").alias("_sum"),
            q.alias("_q"),
        )
        .withColumns({"Q1": F.get("_q", 0), "median": F.get("_q", 1), "Q3": F.get("_q", 2)})
        .withColumn("IQR", F.col("Q3") - F.col("Q1"))
    )


def _fences(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "min_limit": F.greatest(F.lit(0.0), F.col("Q1") - 1.5 * F.col("IQR")),
            "max_limit": F.col("Q3") + 1.5 * F.col("IQR"),
        }
    )


def rush_hour_limits(base: DataFrame, cfg: Settings) -> DataFrame:
    """Quartiles and outlier fences of trips per time window."""
    f = _fences(_quartiles(["time_window"], window_totals(base, cfg, with_name=True)))
    return f.select(
        "time_window",
        "data_points",
        "absolute_min",
        "absolute_max",
        "Q1",
        "median",
        "Q3",
        "IQR",
        F.col("min_limit").alias("min_limit_calculated"),
        F.col("min_limit").alias("min_limit_final"),
        F.col("max_limit").alias("max_limit_final"),
        half_up(F.try_divide(F.col("max_limit"), F.col("absolute_max")) * 100, 1).alias("pct_coverage"),
    )


def rush_hour_scale(base: DataFrame, cfg: Settings) -> DataFrame:
    """One row: colour-scale limits over all windows, and the quietest and busiest window.

    Equal maxima are decided by the window's number.
    """
    f = _fences(_quartiles(["time_window"], window_totals(base, cfg)))
    low, high = half_up(F.min("min_limit"), 0), half_up(F.max("max_limit"), 0)
    number = F.element_at(F.split("time_window", r"\."), 1).cast("int")
    whole = lambda c: c.cast("long").cast("string")
    return f.agg(
        F.lit("=== RECOMMENDED COLOR SCALE LIMITS ===").alias("summary"),
        low.alias("recommended_min"),
        high.alias("recommended_max"),
        F.min_by("time_window", F.struct("absolute_max", number)).alias("quietest_period"),
        F.max_by("time_window", F.struct("absolute_max", -number)).alias("busiest_period"),
        F.concat_ws(" to ", whole(low), whole(high)).alias("color_scale_range"),
    )


def rush_hour_by_day_type(base: DataFrame, cfg: Settings) -> DataFrame:
    q = _quartiles(["time_window", "day_type"], window_totals(base, cfg))
    return q.select(
        "time_window",
        "day_type",
        "data_points",
        F.col("absolute_min").alias("min_trips"),
        F.col("absolute_max").alias("max_trips"),
        F.round(F.col("_sum") / F.col("data_points")).alias("avg_trips"),
        "Q1",
        "Q3",
        "IQR",
    )
