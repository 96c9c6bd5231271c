"""Queries over files: each writes landing files or tables from the lake's data first, then reads or changes them.

Files go to a folder of their own in the shared folder and are removed when the session's engine stops.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators import enrich, gold, incremental, lineage
from wardline.plans import jobs
from wardline.plans.lake import HISTORY, PERMITS, Lake
from wardline.session import shared_dir
from wardline.sources import boundaries, landing, tables


def folder(lake: Lake) -> str:
    """A new folder that lasts as long as the engine."""
    path = f"{shared_dir(lake.spark)}/stored-{uuid.uuid4().hex}"
    fs, p = tables._fs(lake.spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def _tnp_lines(lake: Lake, by_day: bool = False) -> str:
    """Rideshare trips as landing lines; those of 97, 194, .. seconds are cut short."""
    path = folder(lake)
    rows = lake.raw("tnp")
    line = F.to_json(F.struct(*rows.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    cut = F.when(F.col("trip_seconds") % 97 == 0, F.substring(line, 1, 40)).otherwise(line)
    lines = rows.select(cut.alias("value"), F.to_date("trip_start_timestamp").alias("day"))
    if by_day:
        lines.repartition("day").write.mode("overwrite").partitionBy("day").text(path)
    else:
        lines.select("value").write.mode("overwrite").text(path)
    return path


def landing_lines(lake: Lake) -> DataFrame:
    found = landing.read(lake.spark, _tnp_lines(lake), landing.TNP)
    start = F.col("trip_start_timestamp").cast("timestamp_ntz").alias("trip_start_timestamp")
    return found.select(
        "trip_id", start, "trip_seconds", "trips_pooled", "trip_miles", "fare", "trip_total", "shared_trip_authorized",
        "pickup_community_area", "dropoff_community_area", "pickup_centroid_latitude", "dropoff_centroid_longitude",
    )


def landing_quarantine(lake: Lake) -> DataFrame:
    """Malformed lines by data set and reason."""
    bad = landing.malformed(lake.spark, _tnp_lines(lake), landing.TNP)
    counts = landing.quarantine_counts(bad).groupBy("dataset", "reason")
    return counts.agg(F.sum("records").alias("records"))


def landing_manifest(lake: Lake) -> DataFrame:
    """A manifest row for each landed file, one a day; a file with a malformed line is quarantined."""
    rows = landing.raw(lake.spark.read, f"{_tnp_lines(lake, by_day=True)}/day=*", landing.TNP)
    kept = landing.typed(rows, landing.TNP, keep=(*landing.FILE, landing.MALFORMED))
    files = lineage.manifest(kept, "tnp", "trip_start_timestamp", {"malformed_line": landing.is_malformed()})
    return files.select(
        "dataset", "partition_date", "row_count", "validation_checks_failed", "validation_status", "processing_stage",
        "quarantined", "quarantine_reason",
    )


def geojson_boundaries(lake: Lake) -> DataFrame:
    """Boundary boxes through a file with a feature on each line."""
    path = folder(lake)
    boxes = lake.derived("zip_boxes")
    corner = lambda x, y: f"array({x}, {y})"
    ring = ", ".join(corner(*c) for c in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")))
    feature = (
        "to_json(named_struct('type', 'Feature', 'properties', map(':zip', string(zip)), "
        f"'geometry', named_struct('type', 'Polygon', 'coordinates', array(array({ring})))))"
    )
    boxes.selectExpr(f"{feature} AS value").write.mode("overwrite").text(path)
    found = boundaries.read(lake.spark, path, {"zip": "int"})
    points = F.flatten(F.flatten("rings"))
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return found.select(
        "zip",
        F.size("rings").alias("polygons"),
        F.size(points).alias("points"),
        *(F.round(f(v), 6).alias(n) for n, f, v in (("west", F.array_min, x), ("east", F.array_max, x), ("south", F.array_min, y), ("north", F.array_max, y))),
    )


def spaced_headers(lake: Lake) -> DataFrame:
    path = folder(lake)
    table = lake.derived("raw_ccvi")
    named = {n: h for h, n in landing.CCVI_HEADERS.items() if n in table.columns}
    table.select(*[F.col(n).alias(h) for n, h in named.items()]).write.mode("overwrite").option("header", True).csv(path)
    found = landing.read_csv(lake.spark, path, landing.CCVI_HEADERS, ("ccvi_score",))
    return found.select("geography_type", "community_area_or_zip", F.round("ccvi_score", 6).alias("ccvi_score"), "ccvi_category")


def table_modes(lake: Lake) -> DataFrame:
    """Create or replace, create if missing, and a view: rows by data set after each."""
    path, trips = folder(lake), lake.raw_trips.select("trip_id", "source_dataset")
    only = lambda kind: trips.filter(F.col("source_dataset") == kind)
    for kind in ("taxi", "tnp"):
        tables.write(only(kind), f"{path}/replaced")
        tables.write(only(kind), f"{path}/if_missing", mode="ignore")
    name = f"trips_{uuid.uuid4().hex}"
    tables.create_view(trips, name)
    found = {"replaced": lake.spark.read.parquet(f"{path}/replaced"), "if missing": lake.spark.read.parquet(f"{path}/if_missing"), "view": lake.spark.table(name)}
    parts = [df.select(F.lit(mode).alias("mode"), "source_dataset") for mode, df in found.items()]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.groupBy("mode", "source_dataset").agg(F.count("*").alias("rows"))


def quarter_archive(lake: Lake) -> DataFrame:
    """Trips by day after their first quarter was archived and dropped: rows by place and day."""
    path, archive = folder(lake), folder(lake)
    days = lake.raw_trips.select("trip_id", "fare", F.to_date("trip_start_timestamp").alias("day"))
    # Every fifth trip of the table lies a quarter later.
    later = F.expr("IF(CAST(substring(trip_id, 2) AS BIGINT) % 5 = 0, add_months(day, 3), day)")
    tables.write(days.withColumn("day", later), path, "day")
    tables.archive_quarter(lake.spark, path, "day", 2024, 1, archive, delete=True)
    kept = lake.spark.read.parquet(path).select(F.lit("table").alias("place"), "day")
    moved = lake.spark.read.parquet(f"{archive}/2024-Q1").select(F.lit("archive").alias("place"), "day")
    return kept.unionByName(moved).groupBy("place", "day").agg(F.count("*").alias("rows"))


def silver_upsert(lake: Lake) -> DataFrame:
    """Silver permits up to 30 days ago, then the increment, which alone is enriched again."""
    before = lake.silver_permits.filter(F.col("issue_date") < F.lit(PERMITS.as_of - timedelta(days=PERMITS.increment_days)))
    fresh = incremental.increment(lake.bronze_permits, before, "issue_date", PERMITS)
    return incremental.upsert(before, enrich.silver_permits(fresh, lake.places, PERMITS).select(*before.columns), ["id"])


def gold_refresh(lake: Lake) -> DataFrame:
    """The permits table of the gold layer, built from the older permits and then replaced as a whole."""
    path = f"{folder(lake)}/permits_roi"
    older = lake.silver_permits.filter(F.col("issue_date") < F.lit(PERMITS.as_of - timedelta(days=PERMITS.increment_days)))
    for silver in (older, silver_upsert(lake)):
        tables.write(gold.permits_roi(silver), path)
    return lake.spark.read.parquet(path)


def first_and_next_increment(lake: Lake) -> DataFrame:
    """Rows of an increment by month of issue, with an empty target and with one that has rows."""
    source = lake.bronze_permits
    parts = [
        incremental.increment(source, target, "issue_date", PERMITS).select(F.lit(name).alias("target"), F.trunc("issue_date", "month").alias("month"))
        for name, target in (("empty", source.filter("false")), ("filled", source))
    ]
    return parts[0].unionByName(parts[1]).groupBy("target", "month").agg(F.count("*").alias("rows"))


def forecast_sinks(lake: Lake) -> DataFrame:
    """What the traffic forecast job stored for each ZIP: forecasts, their dates, and what its metrics row says it learned from."""
    root = folder(lake)
    daily = lake.derived("daily_history").withColumnRenamed("zip_code", "pickup_zip")
    jobs.run_traffic_forecast(lake.spark, daily, root, HISTORY)
    made = lake.spark.read.parquet(f"{root}/traffic_forecasts").groupBy("zip_code").agg(
        F.count("*").alias("forecasts"), F.min("forecast_date").alias("first_date"), F.max("forecast_date").alias("last_date"),
    )
    told = lake.spark.read.parquet(f"{root}/forecast_metrics")
    return made.join(told, "zip_code").select(
        "zip_code", "forecasts", "first_date", "last_date", "model_name", "training_records", "train_start_date", "train_end_date", "trained_date",
    )


ENTRIES = {
    "landing_lines_read": landing_lines,
    "landing_malformed_lines": landing_quarantine,
    "lineage_manifest_of_files": landing_manifest,
    "boundary_geojson_read": geojson_boundaries,
    "landing_spaced_headers": spaced_headers,
    "tables_write_modes": table_modes,
    "tables_quarter_archive": quarter_archive,
    "permits_silver_upsert": silver_upsert,
    "permits_gold_refresh": gold_refresh,
    "permits_increment_window": first_and_next_increment,
    "forecast_job_sinks": forecast_sinks,
}
