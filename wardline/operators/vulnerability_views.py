"""Views over the high-risk vulnerability areas.

Trips are counted per community area, or per pair of areas, before the high-risk
areas join them: the join then sees area counts instead of trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.columns import first_match, from_, half_up, hundredths, month_of, ratio, sunday_week, tally

# Score bands of the map and of the burden view.
MAP_LEVELS = [(60, "Very High"), (55, "High"), (50, "Moderate-High")]
MAP_LEVEL_BELOW = "High (Threshold)"
MAP_SCORES = [(60, 4), (55, 3), (50, 2)]
BURDEN = [(55.0, 50.0, "Critical"), (50.0, 40.0, "Severe"), (47.9, 30.0, "High")]


def _areas(ccvi: DataFrame) -> DataFrame:
    return ccvi.filter(F.col("geography_type") == "CA").select(
        F.col("geography_id").cast("long").alias("community_area"), "ccvi_score"
    )


def _zips(ccvi: DataFrame) -> DataFrame:
    return ccvi.filter(F.col("geography_type") == "ZIP").select(
        F.col("geography_id").alias("zip_code"), "ccvi_score"
    )


def _named(areas: DataFrame) -> DataFrame:
    return areas.select(
        F.col("area_numbe").cast("long").alias("community_area"), F.col("community").alias("area_name")
    )


def ccvi_map(ccvi: DataFrame, areas: DataFrame, zips: DataFrame) -> DataFrame:
    """High-risk places with name, centroid and band. ``areas`` and ``zips`` carry centroids.

    Both kinds of place go into one lookup on (type, id).
    """
    place = lambda df, kind, key, name: df.select(
        F.lit(kind).alias("geography_type"),
        F.col(key).cast("long").alias("_id"),
        name.alias("area_name"),
        "latitude",
        "longitude",
    )
    places = place(areas, "CA", "area_numbe", F.col("community")).unionByName(
        place(zips, "ZIP", "zip", F.col("zip").cast("string"))
    )
    score = F.col("ccvi_score")
    return (
        ccvi.withColumn("_id", F.col("geography_id").cast("long"))
        .join(places.filter("latitude IS NOT NULL"), ["geography_type", "_id"])
        .select(
            "geography_type",
            "geography_id",
            F.when(F.col("geography_type") == "ZIP", F.col("geography_id"))
            .otherwise(F.col("area_name"))
            .alias("area_name"),
            "ccvi_score",
            "ccvi_category",
            "latitude",
            "longitude",
            from_(score, MAP_LEVELS, MAP_LEVEL_BELOW).alias("vulnerability_level"),
            from_(score, MAP_SCORES, 1).alias("vulnerability_score"),
        )
    )


def _ends(trips: DataFrame, *carry: Column) -> DataFrame:
    """One row per end of a trip: community area, and whether it is the pickup end."""
    ends = F.array(
        F.struct(F.col("pickup_community_area").alias("community_area"), F.lit(True).alias("out")),
        F.struct(F.col("dropoff_community_area").alias("community_area"), F.lit(False).alias("out")),
    )
    return trips.select(*carry, F.inline(ends)).filter(F.col("community_area").isNotNull())


def ccvi_trip_activity(trips: DataFrame, ccvi: DataFrame, areas: DataFrame) -> DataFrame:
    """Trips from and to each high-risk area. Both directions come from one aggregation."""
    pooled = F.col("trips_pooled") > 1
    money = {"fare": "fare", "miles": "trip_miles"}
    ends = _ends(trips, pooled.alias("pooled"), *[hundredths(F.col(c)).alias(n) for n, c in money.items()])
    out, into = F.col("out"), ~F.col("out")
    sides = {"from": out, "to": into}
    per_area = ends.groupBy("community_area").agg(
        *[tally(s).alias(f"trips_{d}") for d, s in sides.items()],
        *[tally(s & F.col("pooled")).alias(f"pooled_{d}") for d, s in sides.items()],
        *[F.sum(F.when(s, F.col(m))).alias(f"sum_{m}_{d}") for d, s in sides.items() for m in money],
        *[F.count(F.when(s, F.col(m))).alias(f"n_{m}_{d}") for d, s in sides.items() for m in money],
    )
    joined = (
        per_area.join(_areas(ccvi), "community_area")
        .groupBy("community_area", "ccvi_score")
        .agg(*[F.sum(c).alias(c) for c in per_area.columns[1:]])
    )
    mean = lambda m, d: F.round(F.try_divide(F.col(f"sum_{m}_{d}"), F.col(f"n_{m}_{d}"))) / 100.0
    total, shared = F.col("trips_from") + F.col("trips_to"), F.col("pooled_from") + F.col("pooled_to")
    return joined.join(_named(areas), "community_area", "left").select(
        "community_area",
        "area_name",
        "ccvi_score",
        F.col("trips_from").alias("trips_from_area"),
        F.col("trips_to").alias("trips_to_area"),
        total.alias("total_trips"),
        F.col("pooled_from").alias("pooled_trips_from"),
        F.col("pooled_to").alias("pooled_trips_to"),
        shared.alias("total_pooled_trips"),
        mean("fare", "from").alias("avg_fare_from"),
        mean("fare", "to").alias("avg_fare_to"),
        mean("miles", "from").alias("avg_miles_from"),
        mean("miles", "to").alias("avg_miles_to"),
        ratio(shared, total, 100.0).alias("pooled_pct"),
    )


def ccvi_double_burden(ccvi: DataFrame, hotspots: DataFrame) -> DataFrame:
    """High-risk ZIPs with their COVID summary and a combined burden score."""
    high = F.col("risk_category") == "High"
    mean = lambda c: F.try_divide(F.sum(hundredths(F.col(c))), F.count(c)) / 100.0
    summary = hotspots.groupBy("zip_code", "population").agg(
        mean("case_rate_weekly").alias("avg_case_rate"),
        F.sum("cases_weekly").alias("total_cases"),
        F.sum("deaths_weekly").alias("total_deaths"),
        mean("adjusted_risk_score").alias("avg_risk_score"),
        tally(high).alias("weeks_high_risk"),
        F.sum("total_trips_from_zip").alias("total_trips_from"),
        F.sum("total_trips_to_zip").alias("total_trips_to"),
    )
    score, risk = F.col("ccvi_score"), F.col("avg_risk_score")
    category = first_match(
        [((score >= low_score) & (risk >= low_risk), label) for low_score, low_risk, label in BURDEN], "Elevated"
    )
    return (
        _zips(ccvi)
        .join(summary, "zip_code")
        .select(
            "zip_code",
            "ccvi_score",
            "avg_case_rate",
            "total_cases",
            "total_deaths",
            "avg_risk_score",
            "weeks_high_risk",
            "total_trips_from",
            "total_trips_to",
            "population",
            (score / 100.0 * (risk / 100.0) * 100).alias("double_burden_score"),
            category.alias("burden_category"),
        )
    )


def _area_flags(pairs: DataFrame, ccvi: DataFrame) -> DataFrame:
    """Adds how often each end matches a high-risk area (0 for no match, and NULL-safe)."""
    marks = _areas(ccvi).groupBy("community_area").agg(F.count(F.lit(1)).alias("m"))
    out = pairs
    for end in ("pickup", "dropoff"):
        side = marks.select(F.col("community_area").alias(f"{end}_community_area"), F.col("m").alias(f"{end}_m"))
        out = out.join(side, f"{end}_community_area", "left").withColumn(
            f"{end}_m", F.coalesce(F.col(f"{end}_m"), F.lit(0))
        )
    return out


def ccvi_trip_trends(trips: DataFrame, ccvi: DataFrame) -> DataFrame:
    """Weekly trips that touch high-risk areas, and their share of all trips."""
    day = F.col("trip_date")
    pairs = trips.groupBy(
        sunday_week(day).alias("week_start"),
        month_of(day).alias("month_start"),
        "pickup_community_area",
        "dropoff_community_area",
    ).agg(F.count(F.lit(1)).alias("n"), tally(F.col("trips_pooled") > 1).alias("n_pooled"))
    a, b = F.col("pickup_m"), F.col("dropoff_m")
    # A place listed twice repeats the trip, as a left join on the list would.
    times = F.greatest(a, F.lit(1)) * F.greatest(b, F.lit(1))
    either = (a > 0) | (b > 0)
    total = lambda c, keep: F.sum(F.when(keep, c * times).otherwise(0))
    return (
        _area_flags(pairs, ccvi)
        .groupBy("week_start", "month_start")
        .agg(
            total(F.col("n"), a > 0).alias("trips_from_high_ccvi"),
            total(F.col("n"), b > 0).alias("trips_to_high_ccvi"),
            total(F.col("n"), either).alias("trips_involving_high_ccvi"),
            total(F.col("n_pooled"), either).alias("pooled_trips_high_ccvi"),
            total(F.col("n"), F.lit(True)).alias("total_trips"),
        )
        .withColumn("pct_trips_high_ccvi", ratio(F.col("trips_involving_high_ccvi"), F.col("total_trips"), 100.0))
        .withColumn("year", F.year("month_start"))
        .withColumn("month", F.month("month_start"))
    )


def ccvi_pooled_rides(trips: DataFrame, ccvi: DataFrame, areas: DataFrame) -> DataFrame:
    """Sharing behaviour of trips that start or end in each high-risk area.

    A trip is listed once per distinct area it touches, which turns the "either
    end" condition into an equality join.
    """
    touched = F.array_distinct(F.array("pickup_community_area", "dropoff_community_area"))
    pooled = F.col("trips_pooled") > 1
    solo = (F.col("trips_pooled") == 1) | F.col("trips_pooled").isNull()
    fare, miles = hundredths(F.col("fare")), hundredths(F.col("trip_miles"))
    per_area = (
        trips.withColumn("community_area", F.explode(touched))
        .filter(F.col("community_area").isNotNull())
        .groupBy("community_area")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            tally(pooled).alias("pooled_trips"),
            tally(solo).alias("solo_trips"),
            tally(F.col("source_dataset") == "taxi").alias("taxi_trips"),
            tally(F.col("source_dataset") == "tnp").alias("tnp_trips"),
            tally(F.col("shared_trip_authorized")).alias("shared_authorized"),
            F.sum(fare).alias("s_fare"),
            F.count(fare).alias("n_fare"),
            F.sum(F.when(pooled, fare)).alias("s_pooled"),
            F.count(F.when(pooled, fare)).alias("n_pooled"),
            F.sum(F.when(solo, fare)).alias("s_solo"),
            F.count(F.when(solo, fare)).alias("n_solo"),
            F.sum(miles).alias("s_miles"),
            F.count(miles).alias("n_miles"),
        )
    )
    keys = ["community_area", "area_name", "ccvi_score"]
    joined = (
        per_area.join(_areas(ccvi), "community_area")
        .join(_named(areas), "community_area", "left")
        .groupBy(*keys)
        .agg(*[F.sum(c).alias(c) for c in per_area.columns[1:]])
    )
    mean = lambda m: F.round(F.try_divide(F.col(f"s_{m}"), F.col(f"n_{m}"))) / 100.0
    of_all = lambda c: ratio(F.col(c), F.col("total_trips"), 100.0)
    return joined.select(
        *keys,
        "total_trips",
        "pooled_trips",
        "solo_trips",
        of_all("pooled_trips").alias("pooled_pct"),
        "taxi_trips",
        "tnp_trips",
        "shared_authorized",
        of_all("shared_authorized").alias("shared_auth_pct"),
        mean("fare").alias("avg_fare"),
        mean("pooled").alias("avg_fare_pooled"),
        mean("solo").alias("avg_fare_solo"),
        mean("miles").alias("avg_miles"),
    )


def ccvi_summary(ccvi: DataFrame, trips: DataFrame, hotspots: DataFrame) -> DataFrame:
    """One row of totals over high-risk places, the trips that touch them and their COVID weeks."""
    kind = F.col("geography_type")
    places = ccvi.agg(
        F.count(F.lit(1)).alias("total_high_risk_areas"),
        tally(kind == "CA").alias("high_risk_cas"),
        tally(kind == "ZIP").alias("high_risk_zips"),
        F.min("ccvi_score").alias("min_ccvi_score"),
        F.max("ccvi_score").alias("max_ccvi_score"),
        half_up(F.avg("ccvi_score"), 1).alias("avg_ccvi_score"),
    )
    pairs = trips.groupBy("pickup_community_area", "dropoff_community_area").agg(F.count(F.lit(1)).alias("n"))
    touching = _area_flags(pairs, ccvi).agg(
        F.coalesce(
            F.sum(F.when((F.col("pickup_m") > 0) | (F.col("dropoff_m") > 0), F.col("n"))), F.lit(0)
        ).alias("total_trips_high_ccvi_areas")
    )
    covid = hotspots.join(_zips(ccvi), "zip_code", "left_semi").agg(
        F.count_distinct("zip_code").alias("zips_with_covid_data"),
        F.sum("cases_weekly").alias("total_covid_cases"),
        F.sum("deaths_weekly").alias("total_covid_deaths"),
    )
    # Three global aggregates: one row each.
    return places.crossJoin(F.broadcast(touching)).crossJoin(F.broadcast(covid))
