"""Silver tables: spatial enrichment, latest and historical COVID weeks, apportioning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import dated, from_, half_up, tally, within
from wardline.operators import spatial

# Airport ZIPs of the enriched trip table.
AIRPORT_ZIPS = ("60666", "60018")


@dataclass(frozen=True)
class Geography:
    """Prepared polygon layers, shared by every lookup of a run."""

    zips: spatial.Layer
    hoods: spatial.Layer
    areas: spatial.Layer | None = None

    @staticmethod
    def prepare(cfg: Settings, zips: DataFrame, hoods: DataFrame, areas: DataFrame | None = None):
        zip_text = zips.withColumn("zip", F.col("zip").cast("string"))
        parts = [(zip_text, ["zip"]), (hoods, ["pri_neigh", "sec_neigh"])]
        if areas is not None:
            parts.append((areas, ["area_numbe", "community"]))
        return Geography(*spatial.layers(parts, cfg.cell_degrees, cfg.broadcast_bytes))


def combine_trips(taxi: DataFrame, tnp: DataFrame, cfg: Settings) -> DataFrame:
    """Taxi and rideshare trips in one table; a taxi trip is unshared and counts as one rider group."""
    as_taxi = taxi.withColumns(
        {
            "shared_trip_authorized": F.lit(False),
            "trips_pooled": F.lit(1).cast("long"),
            "source_dataset": F.lit("taxi"),
        }
    )
    both = as_taxi.unionByName(tnp.withColumn("source_dataset", F.lit("tnp")))
    return both.filter(dated(F.col("trip_start_timestamp"), cfg.min_date, cfg.as_of))


def trips_with_places(trips: DataFrame, geo: Geography) -> DataFrame:
    """ZIP and neighborhood of both ends, and the airport flag.

    The four lookups run in one pass over the trips; the two ends reuse one
    exchange per layer.
    """
    out = trips
    for end in ("pickup", "dropoff"):
        lon, lat = f"{end}_centroid_longitude", f"{end}_centroid_latitude"
        out = spatial.locate(out, lon, lat, geo.zips, {"zip": f"{end}_zip"})
        out = spatial.locate(out, lon, lat, geo.hoods, {"pri_neigh": f"{end}_neighborhood"})
    airport = F.coalesce(F.col("pickup_zip").isin(*AIRPORT_ZIPS), F.lit(False)) | F.coalesce(
        F.col("dropoff_zip").isin(*AIRPORT_ZIPS), F.lit(False)
    )
    return out.select(
        "trip_id",
        F.to_date("trip_start_timestamp").alias("trip_date"),
        F.hour("trip_start_timestamp").alias("trip_hour"),
        "trip_start_timestamp",
        "trip_end_timestamp",
        "trip_seconds",
        "trip_miles",
        "pickup_community_area",
        "dropoff_community_area",
        "pickup_centroid_latitude",
        "pickup_centroid_longitude",
        "dropoff_centroid_latitude",
        "dropoff_centroid_longitude",
        "pickup_zip",
        "dropoff_zip",
        "pickup_neighborhood",
        "dropoff_neighborhood",
        "fare",
        "shared_trip_authorized",
        "trips_pooled",
        airport.alias("is_airport_trip"),
        "source_dataset",
    )


def silver_trips(taxi: DataFrame, tnp: DataFrame, geo: Geography, cfg: Settings) -> DataFrame:
    return trips_with_places(combine_trips(taxi, tnp, cfg), geo)


def silver_permits(bronze: DataFrame, geo: Geography, cfg: Settings) -> DataFrame:
    kept = bronze.filter(dated(F.col("issue_date"), cfg.min_date, cfg.as_of))
    placed = spatial.located_points(
        kept,
        "longitude",
        "latitude",
        [(geo.zips, {"zip": "zip_code"}), (geo.hoods, {"pri_neigh": "neighborhood"})],
    )
    return placed.select(
        "id",
        "permit_",
        "permit_status",
        "permit_type",
        "application_start_date",
        "issue_date",
        "processing_time",
        "work_type",
        "total_fee",
        "reported_cost",
        "community_area",
        "latitude",
        "longitude",
        "zip_code",
        "neighborhood",
        F.year("issue_date").alias("permit_year"),
        F.month("issue_date").alias("permit_month"),
    )


def case_rate_band(rate: Column, cfg: Settings) -> Column:
    """High, Medium or Low; an unknown rate counts as Low."""
    return from_(rate, [(cfg.rate_high, "High"), (cfg.rate_medium, "Medium")], "Low")


def covid_latest(bronze: DataFrame, cfg: Settings) -> DataFrame:
    """Rows of each ZIP's latest week, ties kept.

    The latest week per ZIP is a partial aggregate joined back, not a window, so a
    ZIP with very many rows is never sorted in one task.
    """
    latest = bronze.groupBy("zip_code").agg(F.max("week_end").alias("latest_week_end"))
    return (
        bronze.withColumnRenamed("week_end", "latest_week_end")
        .join(latest, ["zip_code", "latest_week_end"])
        .select(
            "zip_code",
            "latest_week_end",
            "cases_weekly",
            "case_rate_weekly",
            "tests_weekly",
            "deaths_weekly",
            "population",
            case_rate_band(F.col("case_rate_weekly"), cfg).alias("risk_category"),
        )
    )


def covid_history(bronze: DataFrame, cfg: Settings) -> DataFrame:
    share = lambda part, whole: F.when(F.col(whole) > 0, half_up(F.col(part) / F.col(whole) * 100, 2))
    return bronze.filter(
        F.col("zip_code").isNotNull() & dated(F.col("week_start"), cfg.min_date, cfg.as_of)
    ).select(
        "zip_code",
        "week_start",
        "week_end",
        "week_number",
        "cases_weekly",
        "case_rate_weekly",
        "tests_weekly",
        "deaths_weekly",
        "population",
        case_rate_band(F.col("case_rate_weekly"), cfg).alias("risk_category"),
        F.year("week_start").alias("year"),
        F.month("week_start").alias("month"),
        share("cases_weekly", "tests_weekly").alias("test_positivity_pct"),
        share("deaths_weekly", "cases_weekly").alias("case_fatality_pct"),
    )


def ccvi_high_risk(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("ccvi_category") == "HIGH").select(
        "geography_type",
        F.col("community_area_or_zip").alias("geography_id"),
        "ccvi_score",
        "ccvi_category",
    )


# ---------------------------------------------------------------- enriched raw data sets


def wards_and_tracts(
    wards: DataFrame, tracts: DataFrame, cfg: Settings
) -> list[tuple[spatial.Layer, dict[str, str]]]:
    """Ward and census tract layers with the columns they add to a point."""
    parts = [(wards, ["ward", "alderman"]), (tracts, ["tractce10"])]
    ward, tract = spatial.layers(parts, cfg.cell_degrees, cfg.broadcast_bytes)
    return [(ward, {"ward": "ward_number", "alderman": "alderman_name"}), (tract, {"tractce10": "census_tract"})]


def permits_verified(
    raw: DataFrame,
    geo: Geography,
    cfg: Settings,
    more: list[tuple[spatial.Layer, dict[str, str]]] | None = None,
) -> DataFrame:
    """Raw permits with the places their coordinates fall in, and whether the reported area agrees.

    ``more`` takes further layers with the columns to add, such as those of ``wards_and_tracts``.
    """
    kept = raw.filter(within(F.col("latitude"), F.col("longitude"), cfg.bounds))
    layers = [
        (geo.areas, {"area_numbe": "verified_community_area", "community": "community_area_name_verified"}),
        (geo.zips, {"zip": "zip_code_verified"}),
        (geo.hoods, {"pri_neigh": "neighborhood_name", "sec_neigh": "secondary_neighborhood"}),
        *(more or []),
    ]
    placed = spatial.located_points(kept, "longitude", "latitude", layers)
    same = F.col("community_area").cast("string") == F.col("verified_community_area").cast("string")
    return placed.withColumn("community_area_matches", F.coalesce(same, F.lit(False)))


def covid_apportioned(raw: DataFrame, community_zip: DataFrame, zip_hood: DataFrame) -> DataFrame:
    """Weekly counts of a ZIP spread over its community areas by area share."""
    area = community_zip.select(
        "zip_code", "community_area_number", "community_area_name", "pct_of_zip", "is_primary_zip"
    )
    hood = zip_hood.filter("is_primary_neighborhood").select(
        "zip_code", "neighborhood_name", "pct_of_neighborhood"
    )
    part = lambda c: F.when(F.col("pct_of_zip") > 0, half_up(F.col(c) * F.col("pct_of_zip") / 100, 0))
    return (
        raw.join(area, "zip_code", "left")
        .join(hood, "zip_code", "left")
        .withColumn("estimated_cases_in_community_area", part("cases_weekly"))
        .withColumn("estimated_deaths_in_community_area", part("deaths_weekly"))
    )


def trips_with_geography(raw: DataFrame, geo: Geography, cfg: Settings) -> DataFrame:
    """Community area, neighborhood and ZIP of both ends, and the straight-line metres between them."""
    kept = raw.filter(
        within(F.col("pickup_centroid_latitude"), F.col("pickup_centroid_longitude"), cfg.bounds)
    ).drop("pickup_community_area", "dropoff_community_area")
    for end in ("pickup", "dropoff"):
        kept = spatial.located_points(
            kept,
            f"{end}_centroid_longitude",
            f"{end}_centroid_latitude",
            [
                (geo.areas, {"community": f"{end}_community_area"}),
                (geo.hoods, {"pri_neigh": f"{end}_neighborhood"}),
                (geo.zips, {"zip": f"{end}_zip_code"}),
            ],
        )
    out = spatial.straight_line_m(kept, "pickup", "dropoff", "straight_line_distance_meters")
    return out.select(
        "trip_id",
        "trip_start_timestamp",
        "trip_end_timestamp",
        "trip_miles",
        "trip_total",
        *[f"{end}_{c}" for end in ("pickup", "dropoff") for c in ("community_area", "neighborhood", "zip_code")],
        "straight_line_distance_meters",
    )


def permits_by_place(raw: DataFrame, verified: DataFrame, cfg: Settings) -> DataFrame:
    """Permit counts and fees by month, reported area, verified ZIP and neighborhood.

    Both sides are counted per permit number before they meet, so a number that
    many records share multiplies counts and not rows.
    """
    kind = F.col("permit_type")
    fee = F.col("total_fee")
    left = (
        raw.filter(F.col("issue_date") >= F.lit(cfg.min_date))
        .groupBy(
            "permit_",
            F.year("issue_date").alias("year"),
            F.month("issue_date").alias("month"),
            "community_area",
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.round(fee * 100).cast("long")).alias("fee"),
            F.count("total_fee").alias("fees"),
            tally(kind == "PERMIT - NEW CONSTRUCTION").alias("new"),
            tally(kind == "PERMIT - RENOVATION/ALTERATION").alias("renovated"),
        )
    )
    right = (
        verified.filter(F.col("permit_").isNotNull())
        .groupBy("permit_", "zip_code_verified", "neighborhood_name")
        .agg(F.count(F.lit(1)).alias("m"))
    )
    m = F.coalesce(F.col("m"), F.lit(1))
    weighted = lambda c: F.sum(F.col(c) * m)
    return (
        left.join(right, "permit_", "left")
        .groupBy("year", "month", "community_area", "zip_code_verified", "neighborhood_name")
        .agg(
            weighted("n").alias("permit_count"),
            (weighted("fee") / 100.0).alias("total_fees"),
            (F.try_divide(weighted("fee"), weighted("fees")) / 100.0).alias("avg_fee"),
            weighted("new").alias("new_construction_count"),
            weighted("renovated").alias("renovation_count"),
        )
    )


def match_rate(verified: DataFrame, cfg: Settings) -> DataFrame:
    """Number of verified permits and the share whose reported area agrees."""
    seen = verified.filter(F.col("issue_date") >= F.lit(cfg.min_date))
    return seen.agg(
        F.count(F.lit(1)).alias("record_count"),
        half_up(F.try_divide(tally(F.col("community_area_matches")), F.count(F.lit(1))) * 100, 2).alias(
            "match_percentage"
        ),
    )


def top_estimated_cases(apportioned: DataFrame, cfg: Settings, limit: int = 10) -> DataFrame:
    places = ["zip_code", "community_area_name", "neighborhood_name"]
    return (
        apportioned.filter(F.col("week_start") >= F.lit(cfg.covid_min_date))
        .groupBy(*places)
        .agg(F.sum("estimated_cases_in_community_area").alias("total_estimated_cases"))
        .orderBy(F.desc_nulls_last("total_estimated_cases"), *places)
        .limit(limit)
    )
