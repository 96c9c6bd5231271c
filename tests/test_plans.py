"""Physical plans that have to hold at any size."""

import re

from wardline.operators import bronze
from wardline.plans.lake import TRIPS, Lake


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_date_and_bound_filters_reach_the_scan(spark, small, tmp_path):
    path = str(tmp_path / "raw")
    Lake(spark, small).raw_trips.write.parquet(path)
    text = formatted(bronze.trips(spark.read.parquet(path), TRIPS, "tnp"))
    pushed = re.search(r"PushedFilters: \[(.*)\]\n", text).group(1)
    for column in ("trip_start_timestamp", "pickup_centroid_latitude", "trip_miles", "fare"):
        assert f"GreaterThanOrEqual({column}" in pushed
    assert "GreaterThan(trip_seconds,0)" in pushed
    assert "taxi_id" not in re.search(r"ReadSchema: (.*)\n", text).group(1)


def test_daily_counts_read_only_what_they_need(spark, small, tmp_path):
    from wardline.operators import gold

    path = str(tmp_path / "silver")
    Lake(spark, small).silver_trips.write.parquet(path)
    text = plan(gold.trips_by_zip(spark.read.parquet(path), "day"))
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert sorted(f.split(":")[0] for f in schema[len("struct<") :].split(",")) == ["dropoff_zip", "fare", "pickup_zip", "trip_date", "trip_miles"]
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_enrichment_adds_no_shuffle(spark, small):
    text = plan(Lake(spark, small).silver_trips)
    assert "Exchange hashpartitioning" not in text and text.count("BroadcastHashJoin") == 4


def test_upsert_moves_only_keys_of_the_increment(spark, small):
    lake = Lake(spark, small)
    from wardline.operators import incremental

    text = plan(incremental.upsert(lake.bronze_permits, lake.bronze_permits.limit(5), ["id"]))
    assert "LeftAnti" in text


def test_checkpoints_go_where_the_session_says():
    from types import SimpleNamespace

    from wardline.session import shared_dir

    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "hdfs:///shared"}[key]))
    assert shared_dir(named) == "hdfs:///shared"


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    import pytest
    from wardline.session import shared_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=context))
