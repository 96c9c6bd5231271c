"""Hand-made rows for the rules a plain reading gets wrong."""

from datetime import date, datetime
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions import columns as C
from wardline.operators import bronze, clean, enrich, gold, mobility_views, quality, reports, vulnerability_views
from wardline.operators import covid_queries, economic_views, traffic_queries

CFG = Settings(as_of=date(2024, 2, 1))

PERMIT = (
    "id string, permit_ string, permit_status string, permit_type string, application_start_date date, issue_date date, "
    "processing_time long, street_number long, street_direction string, street_name string, work_type string, "
    "work_description string, permit_condition string, total_fee double, reported_cost double, pin_list string, "
    "community_area long, latitude double, longitude double"
)


def permit(spark, *overrides):
    base = dict(
        id="p", permit_="N", permit_type="PERMIT - SIGNS", issue_date=date(2023, 5, 1),
        application_start_date=date(2023, 4, 1), total_fee=50.0, reported_cost=10.0, community_area=5,
        latitude=41.8, longitude=-87.7,
    )
    names = [f.split()[0] for f in PERMIT.split(", ")]
    rows = [{**base, **o} for o in overrides]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], PERMIT)


def column(df, name, order="id"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_bounds_are_inclusive_and_nulls_fail(spark):
    df = permit(
        spark,
        {"id": "a", "latitude": 41.6, "longitude": -87.95},
        {"id": "b", "latitude": 42.1, "longitude": -87.5},
        {"id": "c", "latitude": 42.1000001},
        {"id": "d", "latitude": None},
        {"id": "e", "issue_date": date(2024, 2, 1)},
        {"id": "f", "issue_date": date(2024, 2, 2)},
        {"id": "g", "issue_date": date(2020, 1, 1)},
        {"id": "h", "issue_date": date(2019, 12, 31)},
    )
    assert column(bronze.building_permits(df, CFG), "id") == ["a", "b", "e", "g"]


def test_permit_flags_take_the_first_rule(spark):
    df = permit(
        spark,
        {"id": "a", "permit_": None, "issue_date": None},
        {"id": "b", "issue_date": date(2025, 1, 1), "latitude": None},
        {"id": "c", "longitude": None},
        {"id": "d", "total_fee": -1.0, "community_area": 99},
        {"id": "e", "community_area": 78},
        {"id": "f", "total_fee": None, "community_area": None},
        {"id": "g", "issue_date": date(1999, 1, 1)},
    )
    assert column(clean.flagged_permits(df, CFG), "data_quality_flag") == [
        "missing_permit_number", "future_issue_date", "missing_coordinates", "negative_fee",
        "invalid_community_area", "valid", "invalid_issue_date",
    ]


def test_permits_clean_soft_filters_and_bands(spark):
    df = permit(
        spark,
        {"id": "a", "total_fee": None, "permit_type": "Design review"},
        {"id": "b", "latitude": None, "total_fee": 0.0, "permit_type": None},
        {"id": "c", "latitude": 10.0},
        {"id": "d", "total_fee": 100.0, "permit_type": "Permit - ELECTRICAL Wiring"},
        {"id": "e", "community_area": None, "total_fee": 100.01, "application_start_date": None},
    )
    out = clean.permits(df, CFG)
    assert column(out, "id") == ["a", "b", "d", "e"]
    assert column(out, "fee_category") == ["$10000+", "No Fee", "$1-100", "$101-500"]
    assert column(out, "permit_type_category") == ["Sign", "Other", "Electrical", "Sign"]
    assert column(out, "processing_days") == [30, 30, 30, None]


def test_covid_suppression_and_rates(spark):
    df = spark.createDataFrame(
        [
            ("a", date(2021, 1, 3), None, 0, 10, 1000, 4.5),
            ("b", date(2021, 1, 3), 0, 0, 0, 1000, 4.5),
            ("c", date(2021, 1, 3), 5, 1, 20, 0, None),
            ("d", date(2020, 2, 29), 5, 1, 20, 100, None),
            ("e", date(2021, 1, 3), -1, 1, 20, 100, None),
        ],
        "zip_code string, week_start date, cases_weekly long, deaths_weekly long, tests_weekly long, population long, "
        "percent_tested_positive_weekly double",
    ).withColumn("week_end", F.date_add("week_start", 6))
    out = clean.covid(df, CFG)
    assert column(out, "zip_code", "zip_code") == ["a", "b", "c"]
    assert column(out, "privacy_flag", "zip_code") == ["suppressed_low_count", "not_suppressed", "not_suppressed"]
    assert column(out, "test_positivity_rate_calculated", "zip_code") == [4.5, 4.5, 25.0]
    assert column(out, "case_fatality_rate_pct", "zip_code") == [None, None, 20.0]
    assert column(out, "cases_per_100k", "zip_code") == [None, 0.0, None]
    assert column(out, "data_quality_flag", "zip_code") == ["valid", "valid", "missing_population"]
    assert column(out, "week_number_in_year", "zip_code") == [1, 1, 1]


@pytest.mark.parametrize(
    "day,week,sunday,monday",
    [
        ("2021-01-01", 0, "2020-12-27", "2020-12-28"),
        ("2021-01-03", 1, "2021-01-03", "2020-12-28"),
        ("2023-12-31", 53, "2023-12-31", "2023-12-25"),
        ("2024-01-06", 0, "2023-12-31", "2024-01-01"),
    ],
)
def test_weeks(spark, day, week, sunday, monday):
    d = F.lit(day).cast("date")
    row = spark.range(1).select(C.week_of_year_sunday(d), C.sunday_week(d), C.monday_week(d)).first()
    assert row[0] == week and str(row[1]) == sunday and str(row[2]) == monday


def test_rounding_is_half_away_from_zero(spark):
    row = spark.range(1).select(*[C.half_up(F.lit(v), 2) for v in (1.005, -1.005, 2.675, 0.345)]).first()
    assert tuple(row) == (1.01, -1.01, 2.68, 0.35)


def test_means_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 4.63, 4.64] * 40
    a = spark.createDataFrame([(v,) for v in values], "v double").agg(C.exact_mean(F.col("v")), C.exact_sum(F.col("v"))).first()
    b = spark.createDataFrame([(v,) for v in values[::-1]], "v double").repartition(7).agg(C.exact_mean(F.col("v")), C.exact_sum(F.col("v"))).first()
    assert a == b and a[1] == 394.8


def test_latest_week_keeps_ties_and_null_rate_is_low(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 6), 1, None), ("a", date(2024, 1, 6), 2, 500.0), ("a", date(2023, 1, 7), 3, 1.0), ("b", date(2022, 1, 1), 4, 200.0)],
        "zip_code string, week_end date, cases_weekly long, case_rate_weekly double",
    ).withColumns({c: F.lit(1) for c in ("tests_weekly", "deaths_weekly", "population")})
    got = sorted((r["cases_weekly"], r["risk_category"]) for r in enrich.covid_latest(df, CFG).collect())
    assert got == [(1, "Low"), (2, "High"), (4, "Medium")]


def trips(spark, rows):
    """(pickup_zip, dropoff_zip, date, pooled, pickup_area, dropoff_area, fare, source)"""
    return spark.createDataFrame(
        rows,
        "pickup_zip string, dropoff_zip string, trip_date date, trips_pooled long, pickup_community_area long, "
        "dropoff_community_area long, fare double, source_dataset string",
    ).withColumns({"trip_miles": F.lit(1.0), "shared_trip_authorized": F.lit(None).cast("boolean"), "trip_hour": F.lit(3)})


D = date(2024, 1, 10)


def test_rank_keeps_ties(spark):
    rows = []
    for i in range(12):
        rows += [(f"z{i:02}", "x", D, 1, 1, 2, 5.0, "tnp")] * (5 if i < 2 else 3 if i < 9 else 2)
    out = gold.route_pairs(trips(spark, rows))
    assert sorted(r["rank"] for r in out.collect()) == [1, 1] + [3] * 7 + [10] * 3


def test_mobility_counts_both_ends_and_pooled_rule(spark):
    t = trips(spark, [("a", "b", D, 1, 1, 2, 5.0, "taxi"), ("a", "a", D, 0, 1, 1, 5.0, "tnp"), (None, "a", D, 3, 1, 1, 5.0, "tnp")])
    got = {r["zip_code"]: tuple(r)[2:] for r in gold.weekly_mobility(t).collect()}
    assert got == {"a": (2, 1, 0), "b": (0, 1, 1)}


def test_flat_normalisation_and_nulls(spark):
    history = spark.createDataFrame(
        [("a", date(2024, 1, 7), 10.0, 5), ("b", date(2024, 1, 7), None, 5)],
        "zip_code string, week_start date, case_rate_weekly double, tests_weekly long",
    ).withColumns({c: F.lit(1) for c in ("cases_weekly", "deaths_weekly", "population")}).withColumn("risk_category", F.lit("Low"))
    ccvi = spark.createDataFrame([("ZIP", "a", 63.7, "HIGH")], "geography_type string, geography_id string, ccvi_score double, ccvi_category string")
    out = {r["zip_code"]: r for r in gold.covid_hotspots(history, trips(spark, []), ccvi, CFG).collect()}
    assert out["a"]["ccvi_adjustment"] == 1.5 and out["b"]["ccvi_adjustment"] == 1.0
    assert out["a"]["adjusted_risk_score"] == 0.0 and out["a"]["mobility_risk_rate"] == 0.0
    # A flat column scores 0 for every row, before a missing value is looked at.
    assert out["b"]["epi_risk"] == 0.0


def loan_inputs(spark):
    history = spark.createDataFrame(
        [("a", date(2024, 1, 7), 100), ("a", date(2024, 1, 14), None), ("c", date(2024, 1, 7), 70)],
        "zip_code string, week_start date, population long",
    )
    cz = spark.createDataFrame([(1, "a", 50.0), (2, "a", 25.0), (2, "b", 10.0)], "community_area_number long, zip_code string, pct_of_zip double")
    health = spark.createDataFrame([(1, 20000.0), (2, 50000.0), (3, None)], "community_area long, per_capita_income double")
    permits = spark.createDataFrame(
        [("a", 100.0, "PERMIT - NEW CONSTRUCTION", None)] * 3
        + [("a", 300.0, "X", "new construction"), ("a", 500.0, "X", "y"), ("b", 100.0, "X", None), ("b", 0.0, "X", None), (None, 9.0, "X", None)],
        "zip_code string, reported_cost double, permit_type string, work_type string",
    )
    return history, cz, health, permits


def test_loan_measures(spark):
    out = {r["zip_code"]: r for r in gold.loan_targets(*loan_inputs(spark), CFG, 1).collect()}
    a, b, c = out["a"], out["b"], out["c"]
    assert a["population"] == 0  # the latest week has none
    assert a["per_capita_income"] == 30000.0 and not a["is_loan_eligible"]
    # Three permits share one cost; the median is over the costs 100, 300 and 500.
    assert (a["total_permits_construction"], a["total_permits_new_construction"], a["median_permit_value"]) == (3, 3, 300.0)
    assert b["total_permits_construction"] == 1 and b["median_permit_value"] == 100.0
    # Unknown income counts as 0: eligible, with an income index of 0.
    assert c["per_capita_income"] == 0 and c["is_loan_eligible"] and c["inverted_income_index"] == 0.0


def test_loan_version_two_income_index_passes_one(spark):
    out = {r["zip_code"]: r for r in gold.loan_targets(*loan_inputs(spark), CFG, 2).collect()}
    assert out["c"]["inverted_income_index"] == 2.5
    assert out["b"]["inverted_income_index"] == 0.0 and not out["b"]["is_loan_eligible"]


def test_either_end_counts_a_trip_once(spark):
    ccvi = spark.createDataFrame([("CA", "7", 50.0, "HIGH"), ("ZIP", "60601", 60.0, "HIGH")], "geography_type string, geography_id string, ccvi_score double, ccvi_category string")
    areas = spark.createDataFrame([(7, "SEVEN")], "area_numbe int, community string")
    t = trips(spark, [("a", "b", D, 2, 7, 7, 5.0, "tnp"), ("a", "b", D, None, 7, 8, 7.0, "taxi"), ("a", "b", D, 1, None, 7, 9.0, "tnp"), ("a", "b", D, 1, 3, 4, 9.0, "tnp")])
    row = vulnerability_views.ccvi_pooled_rides(t, ccvi, areas).collect()
    assert len(row) == 1 and (row[0]["total_trips"], row[0]["pooled_trips"], row[0]["solo_trips"]) == (3, 1, 2)
    act = vulnerability_views.ccvi_trip_activity(t, ccvi, areas).first()
    assert (act["trips_from_area"], act["trips_to_area"], act["area_name"]) == (2, 2, "SEVEN")
    trend = vulnerability_views.ccvi_trip_trends(t, ccvi).first()
    assert (trend["trips_from_high_ccvi"], trend["trips_involving_high_ccvi"], trend["total_trips"]) == (2, 3, 4)


def test_overlay_weeks_only_meet_when_aligned(spark):
    airport = spark.createDataFrame([(date(2024, 1, 8), "Other", 5.0, 1.0)], "week_start date, airport_destination string, fare double, trip_miles double")
    hot = spark.createDataFrame([(date(2024, 1, 7), 4, 1.25)], "week_start date, cases_weekly long, adjusted_risk_score double")
    assert mobility_views.airport_covid_overlay(airport, hot).first()["total_covid_cases"] == 0
    aligned = mobility_views.airport_covid_overlay(airport, hot, lambda w: F.date_add(w, 1)).first()
    assert (aligned["total_covid_cases"], aligned["avg_risk_score"]) == (4, 1.25)


def test_time_windows_wrap_and_have_gaps(spark):
    hours = [r[0] for r in spark.range(24).select(mobility_views.time_window(F.col("id"))).collect()]
    assert {h[:1] for i, h in enumerate(hours) if i in (22, 23, 0)} == {"7"}
    assert [i for i, h in enumerate(hours) if h == "Other"] == [1, 4, 9, 10, 13, 18, 21]


def test_hour_windows_of_day(spark):
    parts = [r[0] for r in spark.range(24).select(clean.day_part(F.col("id"))).collect()]
    assert parts[5] == "Late Night (12-5am)" and parts[9] == "Morning Rush (6-9am)" and parts[20] == "Evening (8-11pm)"


def test_month_over_month_skips_gaps(spark):
    f = spark.createDataFrame([("a", date(2024, 1, 5), 10.0), ("a", date(2024, 3, 5), 20.0), ("a", date(2024, 4, 5), 30.0)], "zip_code string, forecast_date date, yhat double")
    rows = traffic_queries.month_over_month(f).collect()
    assert [(str(r["forecast_month"]), r["mom_growth_pct"]) for r in rows] == [("2024-04-01", 50.0)]


def test_long_date_pads_the_day(spark):
    d = spark.range(1).select(covid_queries.long_date(F.lit("2024-01-01").cast("date")), covid_queries.long_date(F.lit("2024-12-25").cast("date"))).first()
    assert tuple(d) == ("Monday, January  1, 2024", "Wednesday, December 25, 2024")


def test_gates_and_enforcement(spark):
    good = permit(spark, {"id": "a"}, {"id": "b"})
    quality.enforce(quality.gates(good, CFG))
    bad = permit(spark, {"id": "a", "permit_": ""}, {"id": "b"})
    with pytest.raises(quality.GateFailed, match="permit_number_not_null"):
        quality.enforce(quality.gates(bad, CFG))
    with pytest.raises(quality.GateFailed, match="non_zero_record_count"):
        quality.enforce(quality.gates(good.limit(0), CFG))


def test_expectations_find_repeats(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2000.0), ("b", None), (None, 3.0)], "trip_id string, fare double")
    rules = [quality.Expectation("u", "unique", "trip_id"), quality.Expectation("n", "not_null", "trip_id"), quality.Expectation("f", "between", "fare", 0, 1000), quality.Expectation("c", "row_count", low=5, high=9)]
    got = {r["expectation"]: (r["unexpected_count"], r["success"]) for r in quality.expectations(df, rules).collect()}
    assert got == {"u": (2, False), "n": (1, False), "f": (1, False), "c": (1, False)}


def test_check_table_counts(spark):
    df = permit(spark, {"id": "a"}, {"id": "b"}, {"id": "c", "latitude": 1.0}, {"id": "d", "permit_": "other"})
    got = {r["check_name"]: r for r in quality.check_table(df, quality.permit_checks(CFG.bounds, CFG.max_fee), "t", D).collect()}
    assert got["coordinates_valid_range"]["failed_row_count"] == 1 and not got["coordinates_valid_range"]["passed"]
    assert got["permit_number_unique"]["failed_row_count"] == 2
    assert got["total_fee_reasonable"]["passed"]


def test_permits_by_place_multiplies_shared_numbers(spark):
    raw = permit(spark, {"id": "a", "total_fee": 1.0}, {"id": "b", "total_fee": 2.0}, {"id": "c", "permit_": None, "total_fee": 4.0})
    verified = raw.withColumns({"zip_code_verified": F.lit("z"), "neighborhood_name": F.lit("h")})
    rows = {r["zip_code_verified"]: r for r in enrich.permits_by_place(raw, verified, CFG).collect()}
    # Two records share a number: each meets both, as a join of the rows would have it.
    assert (rows["z"]["permit_count"], rows["z"]["total_fees"], rows["z"]["avg_fee"]) == (4, 6.0, 1.5)
    assert (rows[None]["permit_count"], rows[None]["total_fees"]) == (1, 4.0)


def test_full_outer_area_view(spark):
    loans = spark.createDataFrame([("x", 1000, 20000.0, 0.5, True, 0.2)], "zip_code string, population long, per_capita_income double, eligibility_index double, is_loan_eligible boolean, inverted_income_index double")
    permits = permit(spark, {"permit_type": "PERMIT - NEW CONSTRUCTION"}).withColumn("zip_code", F.lit("y"))
    got = {r["zip_code"]: r for r in economic_views.permits_by_area(permits, loans).collect()}
    assert got["x"]["permit_count"] == 0 and got["x"]["permits_per_1000_residents"] is None
    assert got["y"]["population"] == 0 and got["y"]["permits_per_1000_residents"] == 0.0 and got["y"]["is_loan_eligible"] is False


def test_baseline_needs_a_week_and_is_repeatable(spark):
    rows = [("60601", "b", date(2024, 1, d), 1, 1, 1, 1.0, "tnp") for d in range(1, 8) for _ in range(4)]
    rows += [("60602", "b", date(2024, 1, 3), 1, 1, 1, 1.0, "tnp")]
    out = gold.baseline_forecast(trips(spark, rows), horizon=3, jitter=lambda z, d: F.lit(10))
    assert [(r["zip_code"], str(r["forecast_date"]), r["predicted_trip_count"], r["upper_bound"]) for r in out.orderBy("forecast_date").collect()] == [
        ("60601", f"2024-01-{d:02}", 4.0, 4.8) for d in (8, 9, 10)
    ]
    swing = [r[0] for r in spark.range(4000).select(gold.default_jitter((F.col("id") + 60000).cast("string"), F.lit("2024-01-01").cast("date"))).collect()]
    assert min(swing) == -20 and max(swing) == 20


def test_investment_areas_keep_areas_without_permits(spark):
    health = spark.createDataFrame([(1, "ONE", 9.0, 5.0, 1.0), (2, "TWO", 8.0, 5.0, 1.0), (3, "NO", None, 5.0, 1.0)], "community_area long, community_area_name string, unemployment double, below_poverty_level double, per_capita_income double")
    out = reports.investment_areas(health, permit(spark, {"community_area": 2, "total_fee": 7.5})).collect()
    assert [(r["community_area_name"], r["total_permits"], r["total_fees_charged"]) for r in out] == [("ONE", 0, None), ("TWO", 1, 7.5)]


def test_forecast_sums_keep_all_digits(spark):
    from datetime import date, timedelta

    from wardline.operators import traffic_queries

    rows = [("60601", date(2024, 4, 1) + timedelta(days=i), 100.0, 90.1234, 120.1488, 10.0) for i in range(30)]
    frame = spark.createDataFrame(rows, "zip_code string, forecast_date date, yhat double, yhat_lower double, yhat_upper double, trend double")
    row = traffic_queries.monthly(frame).first()
    assert row["monthly_upper_bound"] == 3604.0 and row["monthly_lower_bound"] == 2704.0
