"""The batch jobs end to end on the smallest data."""

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from wardline.operators import forecasting
from wardline.plans import jobs
from wardline.plans.lake import HISTORY, PERMITS, TRIPS, Lake


@pytest.fixture(scope="module")
def lake(spark, small):
    return Lake(spark, small)


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))


def test_permits_job_is_repeatable_and_incremental(spark, lake, tmp_path):
    root = str(tmp_path)
    earlier = replace(PERMITS, as_of=date(2001, 4, 1))
    run = lambda raw, cfg: jobs.run_permits(
        spark, raw, lake.places, lake.covid_history, lake.community_zip, lake.health, root, cfg
    )
    run(lake.raw_permits, earlier)
    first = rows(spark.read.parquet(f"{root}/silver_permits"))
    run(lake.raw_permits, earlier)
    assert rows(spark.read.parquet(f"{root}/silver_permits")) == first
    # A month later, with a changed fee inside the window and one far outside of it.
    changed = lake.raw_permits.withColumn(
        "total_fee", F.when(F.col("issue_date").isin(date(2001, 4, 20), date(1997, 3, 3)), 77.0).otherwise(F.col("total_fee"))
    )
    stats = {(r["layer"], r["metric"]): r["value"] for r in run(changed, PERMITS).collect()}
    silver = spark.read.parquet(f"{root}/silver_permits")
    assert stats["SILVER", "total_records"] == str(silver.count())
    assert rows(silver.select("id")) == rows(lake.silver_permits.select("id"))
    # The window is on the issue date: the old permit's change is not picked up.
    assert silver.filter("issue_date = '1997-03-03' AND total_fee = 77").count() == 0
    assert silver.filter("issue_date = '2001-04-20' AND total_fee <> 77").count() == 0


def test_range_replacement_equals_a_rebuild(spark, lake, tmp_path):
    full, part = str(tmp_path / "full"), str(tmp_path / "part")
    taxi, tnp = lake.raw("taxi"), lake.raw("tnp")
    jobs.run_trips(spark, taxi, tnp, lake.places, full, TRIPS)
    days = (date(2024, 1, 10), date(2024, 1, 15))
    stale = taxi.withColumn(
        "fare", F.when(F.to_date("trip_start_timestamp").between(*map(F.lit, days)), F.lit(1.0)).otherwise(F.col("fare"))
    )
    jobs.run_trips(spark, stale, tnp, lake.places, part, TRIPS)
    read = lambda root, t: rows(spark.read.parquet(f"{root}/{t}"))
    assert read(full, "silver_trips") != read(part, "silver_trips")
    jobs.replace_trip_range(spark, taxi, lake.places, part, *days, TRIPS)
    for t in ("bronze_taxi", "silver_trips", "hourly", "daily"):
        assert read(full, t) == read(part, t), t
    assert rows(spark.read.parquet(f"{full}/silver_trips")) == rows(lake.silver_trips)
    jobs.replace_trip_range(spark, taxi, lake.places, part, *days, TRIPS, taxi_only_gold=True)
    assert read(full, "silver_trips") == read(part, "silver_trips")
    assert read(full, "daily") != read(part, "daily")


def test_stored_trips_are_pruned_by_day(spark, lake, tmp_path):
    root = str(tmp_path)
    jobs.run_trips(spark, lake.raw("taxi"), lake.raw("tnp"), lake.places, root, TRIPS)
    stored = spark.read.parquet(f"{root}/silver_trips")
    plan = stored.filter(F.col("trip_date") == F.lit(date(2024, 1, 5))).select("fare")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trip_date" in plan and "ReadSchema: struct<fare:double>" in plan


def test_forecast_jobs_share_the_metrics_table(spark, lake, tmp_path):
    root = str(tmp_path)
    daily = lake.derived("daily_history").withColumnRenamed("zip_code", "pickup_zip").withColumn(
        "pickup_zip", F.when(F.col("pickup_zip") < "60610", "60601").otherwise("60602")
    )
    weekly = lake.derived("weekly_history").filter("zip_code IN ('60601', '60602')")
    covid = lambda: jobs.run_covid_forecast(spark, weekly, root, HISTORY, HISTORY.min_date, HISTORY.as_of, forecasting.COVID_SIMPLE)
    jobs.run_traffic_forecast(spark, daily, root, HISTORY)
    covid()
    jobs.run_traffic_forecast(spark, daily, root, HISTORY)
    covid()
    names = sorted(r["model_name"] for r in spark.read.parquet(f"{root}/forecast_metrics").collect())
    assert names == [
        "covid_risk_forecast_zip_60601", "covid_risk_forecast_zip_60602", "traffic_forecast_zip_60601", "traffic_forecast_zip_60602",
    ]
    assert spark.read.parquet(f"{root}/traffic_forecasts").count() == 180


def test_health_tables_and_stored_risk(spark, lake, tmp_path):
    root = str(tmp_path)
    jobs.run_trips(spark, lake.raw("taxi"), lake.raw("tnp"), lake.places, root, TRIPS)
    jobs.run_health(spark, lake.raw_covid, lake.derived("raw_ccvi"), lake.derived("raw_health"), root, TRIPS)
    read = lambda t: spark.read.parquet(f"{root}/{t}")
    assert rows(read("covid_hotspots")) == rows(lake.hotspots)
    assert rows(read("covid_latest")) == rows(lake.covid_latest)
    assert rows(read("ccvi_high_risk")) == rows(lake.ccvi)
    narrow = replace(TRIPS, bounds=replace(TRIPS.bounds, lat_max=41.8))
    before = read("bronze_tnp").count()
    jobs.refilter_trips(spark, root, "tnp", narrow)
    after = read("bronze_tnp")
    assert 0 < after.count() < before and after.agg(F.max("pickup_centroid_latitude")).first()[0] <= 41.8


def test_crosswalk_and_boundary_tables(spark, lake, tmp_path):
    root = str(tmp_path)
    jobs.build_crosswalks(lake.areas, lake.zips, lake.hoods, root, TRIPS)
    assert spark.read.parquet(f"{root}/crosswalk_community_zip").count() == lake.community_zip.count()
    assert spark.read.parquet(f"{root}/crosswalk_complete").filter("intersection_area <= 1000").count() == 0
    geo = '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"zip":"60601"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}]}'
    (tmp_path / "z.geojson").write_text(geo)
    for _ in range(2):
        jobs.load_boundaries(spark, {"zip_code_boundaries": (str(tmp_path / "z.geojson"), {"zip": "int"})}, root)
    assert [r["zip"] for r in spark.read.parquet(f"{root}/zip_code_boundaries").collect()] == [60601]


def test_clean_views_are_stored(spark, lake, tmp_path):
    root = str(tmp_path)
    cfg = replace(TRIPS, as_of=date(2024, 1, 20), min_date=date(1996, 1, 1))
    jobs.materialise_clean_views(lake.raw_permits, lake.raw_covid, lake.raw("taxi"), root, cfg)
    taxi = spark.read.parquet(f"{root}/taxi_clean_recent_month")
    assert taxi.count() > 0 and taxi.agg(F.min("trip_date")).first()[0] >= date(2023, 12, 21)
    kept = spark.read.parquet(f"{root}/permits_clean_materialized").count()
    # Permits are only created when missing.
    jobs.materialise_clean_views(lake.raw_permits.limit(3), lake.raw_covid, lake.raw("taxi"), root, cfg)
    assert spark.read.parquet(f"{root}/permits_clean_materialized").count() == kept > 3


def test_dashboard_views_answer_sql(spark, lake):
    from wardline.plans import views

    made = views.dashboard_views(
        trips=lake.silver_trips, hourly=lake.hourly, hotspots=lake.hotspots, ccvi=lake.ccvi, permits=lake.silver_permits,
        loans=lake.loans(1), areas=lake.areas, zips=lake.zips, cfg=PERMITS,
    )
    names = views.register(made)
    assert len(names) == 15
    for name in names:
        assert spark.sql(f"SELECT * FROM {name} LIMIT 1").columns == made[name].columns
    got = spark.sql("SELECT airport_destination, count(*) AS n FROM v_airport_trips GROUP BY 1")
    assert sum(r["n"] for r in got.collect()) == lake.airport.count()


def test_neighborhood_forecasts_start_from_trips(spark, lake, tmp_path):
    root = str(tmp_path)
    trips = lake.derived("daily_history").filter("zip_code = '60601'").selectExpr(
        "'LOOP' AS pickup_neighborhood", "trip_date", "explode(sequence(1L, trip_count)) AS n"
    )
    jobs.run_neighborhood_forecast(spark, trips, root, HISTORY)
    rows = spark.read.parquet(f"{root}/traffic_forecasts_by_neighborhood").collect()
    assert len(rows) == 90 and {r["neighborhood"] for r in rows} == {"LOOP"}
    daily = spark.read.parquet(f"{root}/gold_taxi_daily_by_neighborhood")
    assert daily.agg({"trip_count": "sum"}).first()[0] == trips.count()


def test_gates_are_measured_by_the_write(spark, lake, tmp_path):
    from wardline.operators import quality

    raw = lake.raw_permits
    loaded = []
    verdicts = quality.load_gated(raw, PERMITS, lambda df: loaded.append(df.count()))
    assert rows(verdicts) == rows(quality.gates(raw, PERMITS)) and loaded == [raw.count()]
    plan = raw.observe("o", F.count("*").alias("n"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    nameless = raw.withColumn("permit_", F.lit(None).cast("string"))
    with pytest.raises(quality.GateFailed, match="permit_number_not_null"):
        quality.load_gated(nameless, PERMITS, lambda df: loaded.append("never"))
    assert loaded == [raw.count()]


def test_checks_are_measured_by_the_write(spark, lake, tmp_path):
    from wardline.operators import quality

    path, raw = str(tmp_path / "t"), lake.raw_permits
    checks = quality.permit_checks(PERMITS.bounds, PERMITS.max_fee)
    made = quality.write_checked(
        raw, lambda df: df.write.parquet(path), lambda: spark.read.parquet(path), checks, "permits", PERMITS.as_of
    )
    assert rows(made) == rows(quality.check_table(raw, checks, "permits", PERMITS.as_of)) and made.count() == len(checks)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<permit_:string>" in plan  # only the unique key is read again


def test_gated_permits_change_nothing_when_a_gate_fails(spark, lake, tmp_path):
    from wardline.operators import quality

    root = str(tmp_path)
    bad = lake.raw_permits.withColumn("permit_", F.lit(""))
    run = lambda raw: jobs.run_permits(
        spark, raw, lake.places, lake.covid_history, lake.community_zip, lake.health, root, PERMITS, gated=True
    )
    with pytest.raises(quality.GateFailed):
        run(bad)
    assert not (tmp_path / "bronze_permits").exists()
    run(lake.raw_permits)
    assert rows(spark.read.parquet(f"{root}/silver_permits").select("id")) == rows(lake.silver_permits.select("id"))
