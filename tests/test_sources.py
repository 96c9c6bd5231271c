"""Landing files, boundaries and partitioned tables on disk."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardline.operators import incremental, lineage, spatial
from wardline.sources import boundaries, landing, tables
from wardline.streaming import landing_stream


def dump(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in rows))


TRIP = {
    "trip_id": "t1", "trip_start_timestamp": "2024-01-05T10:15:00.000", "trip_end_timestamp": "2024-01-05T10:45:00",
    "trip_seconds": "1800", "trip_miles": "0", "fare": "12.5", "pickup_community_area": "8.0",
    "dropoff_community_area": 0, "pickup_centroid_latitude": "41.8", "pickup_centroid_longitude": "-87.6",
}


def test_numbers_arrive_as_text(spark, tmp_path):
    dump(tmp_path / "a.json", [TRIP, {**TRIP, "trip_id": "t2", "trip_seconds": "n/a", "pickup_community_area": 32}])
    rows = {r["trip_id"]: r for r in landing.read(spark, str(tmp_path), landing.TAXI).collect()}
    assert rows["t1"]["trip_seconds"] == 1800 and rows["t2"]["trip_seconds"] is None
    assert (rows["t1"]["pickup_community_area"], rows["t1"]["dropoff_community_area"]) == ("8", "")
    assert rows["t2"]["pickup_community_area"] == "32" and rows["t1"]["trip_miles"] == 0.0
    assert rows["t1"]["trip_start_timestamp"].hour == 10 and rows["t1"]["dropoff_centroid_latitude"] is None


def test_zero_as_missing_is_an_option(spark, tmp_path):
    dump(tmp_path / "a.json", [TRIP])
    row = landing.read(spark, str(tmp_path), landing.TAXI, zero_is_null=True).first()
    assert row["trip_miles"] is None and row["fare"] == 12.5
    assert row["dropoff_centroid_latitude"] == 0.0


@pytest.mark.parametrize("name", sorted(landing.DATASETS))
def test_every_dataset_reads(spark, tmp_path, name):
    d = landing.DATASETS[name]
    dump(tmp_path / "x.json", [{k: "1" for k in d.types}])
    df = landing.read(spark, str(tmp_path), d)
    assert df.count() == 1 and set(d.key) <= set(df.columns)


BAD_LINES = ['{"trip_id": "t3", "trip_seconds": ', "no json at all", '[{"trip_id": "t4"}]', "7"]


def test_malformed_lines_are_set_apart(spark, tmp_path):
    lines = [json.dumps(TRIP), BAD_LINES[0], "", json.dumps({**TRIP, "trip_id": "t2"}), BAD_LINES[1]]
    (tmp_path / "a.json").write_text("\n".join(lines))
    dump(tmp_path / "b.json", [{**TRIP, "trip_id": "t5"}])
    rows = landing.read(spark, str(tmp_path), landing.TAXI)
    assert sorted(r["trip_id"] for r in rows.collect()) == ["t1", "t2", "t5"] and rows.count() == 3
    assert rows.filter("trip_id IS NULL").count() == 0 and landing.MALFORMED not in rows.columns
    bad = landing.malformed(spark, str(tmp_path), landing.TAXI)
    assert bad.columns == list(landing.QUARANTINE)
    got = [(r["dataset"], r["file_uri"].rsplit("/", 1)[1], r["reason"], r["record"]) for r in bad.collect()]
    assert sorted(got) == sorted(("taxi", "a.json", "malformed line", x) for x in BAD_LINES[:2])
    counts = landing.quarantine_counts(bad).collect()
    assert [(r["dataset"], r["reason"], r["records"]) for r in counts] == [("taxi", "malformed line", 2)]


def test_the_stream_sets_bad_records_apart_once(spark, tmp_path, monkeypatch):
    folder, path = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    nobody = {k: v for k, v in TRIP.items() if k != "trip_id"}
    (folder / "a.json").write_text("\n".join([json.dumps(TRIP), *BAD_LINES, json.dumps(nobody)]))
    run = lambda: landing_stream.load_new(spark, str(folder), landing.TAXI, path, str(tmp_path / "check"))

    def lost(*_, **__):
        raise RuntimeError("lost")

    # The first run stops after it has written the quarantine; its batch comes again.
    monkeypatch.setattr(landing_stream, "insert_new", lost)
    with pytest.raises(Exception, match="lost"):
        run().awaitTermination()
    monkeypatch.undo()
    run().awaitTermination()
    dump(folder / "b.json", [TRIP, {**TRIP, "trip_id": "t9"}])
    (folder / "c.json").write_text("broken")
    run().awaitTermination()
    assert sorted(r["trip_id"] for r in spark.read.parquet(path).collect()) == ["t1", "t9"]
    bad = spark.read.parquet(f"{path}_quarantine").collect()
    want = [("malformed line", x) for x in [*BAD_LINES, "broken"]]
    assert sorted((r["reason"], r["record"]) for r in bad if r["reason"] != "missing key") == sorted(want)
    (lacking,) = [json.loads(r["record"]) for r in bad if r["reason"] == "missing key"]
    assert lacking["fare"] == 12.5 and "trip_id" not in lacking
    assert {r["file_uri"].rsplit("/", 1)[1] for r in bad} == {"a.json", "c.json"}


def test_an_updating_stream_keeps_rows_without_a_key(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "table")
    nobody = {k: v for k, v in TRIP.items() if k != "trip_id"}
    dump(folder / "a.json", [TRIP, nobody, nobody])
    landing_stream.load_new(spark, str(folder), landing.TAXI, path, str(tmp_path / "check"), update=True).awaitTermination()
    assert [r["trip_id"] for r in spark.read.parquet(path).orderBy("trip_id").collect()] == [None, None, "t1"]
    assert spark.read.parquet(f"{path}_quarantine").count() == 0


def test_new_rows_keep_one_per_key(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 2), ("b", 5), (None, 3)], "k string, v int")
    assert [tuple(r) for r in landing.new_rows(old, new, ("k",)).collect()] == [("b", 5)]


def test_spaced_headers(spark, tmp_path):
    (tmp_path / "c.csv").write_text('Geography Type,Community Area or ZIP Code,CCVI Score,CCVI Category,Location\nZIP,60601,47.1239,HIGH,POINT (1 2)\n')
    row = landing.read_csv(spark, str(tmp_path / "c.csv"), landing.CCVI_HEADERS, ("ccvi_score",)).first()
    assert row["community_area_or_zip"] == "60601" and row["ccvi_score"] == 47.1239


SQUARE = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]


def feature(name, geometry, **more):
    out = {"type": "Feature", "properties": {":id": "r1", "name": name, "zip": "60601"}, **more}
    if geometry != "absent":
        out["geometry"] = geometry
    return out


def test_geojson_reads_and_locates(spark, tmp_path):
    multi = {"type": "MultiPolygon", "coordinates": [[[[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]], SQUARE]}
    doc = {"type": "FeatureCollection", "features": [feature("both", multi)]}
    (tmp_path / "b.geojson").write_text(json.dumps(doc, indent=1))
    df = boundaries.read(spark, str(tmp_path / "b.geojson"), {"name": "string", "zip": "int", "id": "string"})
    row = df.first()
    assert (row["zip"], row["id"], len(row["rings"])) == (60601, "r1", 2)
    pts = spark.createDataFrame([(1.0, 1.0), (5.5, 5.5), (3.0, 3.0)], "lon double, lat double")
    found = spatial.locate(pts, "lon", "lat", spatial.layer(df, ["name"], 0.5, 1 << 20), {"name": "n"})
    assert [r["n"] for r in found.orderBy("lon").collect()] == ["both", None, "both"]


def test_lines_of_features_are_split_over_tasks(spark, tmp_path):
    rows = [feature(f"n{i}", {"type": "Polygon", "coordinates": SQUARE}) for i in range(400)]
    dump(tmp_path / "lines.json", rows)
    (tmp_path / "commas.json").write_text('\n'.join(json.dumps(r) + " , " for r in rows))
    (tmp_path / "whole.json").write_text(json.dumps({"type": "FeatureCollection", "features": rows}, indent=1))
    (tmp_path / "line.json").write_text(json.dumps({"type": "FeatureCollection", "features": rows}))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in keep:
            spark.conf.set(k, "4096")
        found = {n: boundaries.read(spark, str(tmp_path / f"{n}.json"), {"name": "string", "zip": "int"}) for n in ("lines", "commas", "whole", "line")}
        tasks = {n: df.rdd.getNumPartitions() for n, df in found.items()}
        got = {n: sorted((r["name"], r["zip"], len(r["rings"][0][0])) for r in df.collect()) for n, df in found.items()}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert all(n > 1 for n in tasks.values()) and tasks["lines"] > 8
    assert all(g == sorted((f"n{i}", 60601, 5) for i in range(400)) for g in got.values())
    assert boundaries.layout_of(spark, str(tmp_path / "commas.json")) == "lines"
    assert boundaries.layout_of(spark, str(tmp_path / "line.json")) == "collection"


def test_geometry_verdicts(spark, tmp_path):
    cases = {
        "ok": {"type": "Polygon", "coordinates": SQUARE},
        "missing": "absent",
        "null": None,
        "no type": {"coordinates": SQUARE},
        "no coordinates": {"type": "Polygon"},
        "null coordinates": {"type": "Polygon", "coordinates": None},
        "text": {"type": "Polygon", "coordinates": "x"},
        "empty": {"type": "Polygon", "coordinates": []},
        "flat": {"type": "MultiPolygon", "coordinates": [[]]},
        "short": {"type": "Polygon", "coordinates": [[[0, 0], [1, 1]]]},
        "point": {"type": "Point", "coordinates": [1, 2]},
    }
    dump(tmp_path / "f.json", [feature(k, v) for k, v in cases.items()])
    verdicts = boundaries.validate(boundaries.features(spark, str(tmp_path / "f.json")), "name")
    got = {r["name"]: r["reason"] for r in verdicts.collect()}
    assert got == {
        "ok": "Valid", "missing": "Missing geometry field", "null": "Geometry is null", "no type": "Missing geometry type",
        "no coordinates": "Missing coordinates", "null coordinates": "Coordinates are null", "text": "Coordinates are not a list", "empty": "Coordinates array is empty",
        "flat": "Malformed MultiPolygon structure", "short": "First ring has only 2 points (minimum 3 required)", "point": "Valid",
    }
    assert {r["name"]: r["points"] for r in verdicts.collect()}["ok"] == 5
    assert sum(r["features"] for r in boundaries.validation_summary(verdicts).collect()) == len(cases)


# ---------------------------------------------------------------- tables


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, day date, v int")


def content(spark, path):
    return sorted((r["id"], r["day"], r["v"]) for r in spark.read.schema("id string, v int, day date").parquet(path).collect())


D1, D2, D3, D4 = (date(2024, 1, d) for d in (1, 2, 3, 4))


def test_upsert_moves_rows_between_days_and_repeats_safely(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.apply_upsert(table(spark, [("a", D1, 1), ("b", D2, 1), ("c", D3, 1)]), path, ["id"], "day")
    change = table(spark, [("a", D3, 2), ("d", D4, 2)])
    done = incremental.apply_upsert(change, path, ["id"], "day")
    want = [("a", D3, 2), ("b", D2, 1), ("c", D3, 1), ("d", D4, 2)]
    assert content(spark, path) == want
    # The day of the untouched row is not rewritten; the day that lost its only row is gone.
    assert done.written == [D3, D4] and done.emptied == [D1]
    incremental.apply_upsert(change, path, ["id"], "day")
    assert content(spark, path) == want


def test_upsert_takes_the_latest_of_repeated_keys(spark):
    target = table(spark, [("a", D1, 1), ("b", D1, 1)])
    source = table(spark, [("a", D2, 5), ("a", D3, 4), ("a", D1, 9)])
    out = incremental.upsert(target, source, ["id"], version="day")
    assert sorted((r["id"], r["v"]) for r in out.collect()) == [("a", 4), ("b", 1)]


def test_increment_window_and_empty_target(spark):
    from wardline.config import Settings

    cfg = Settings(as_of=date(2024, 3, 1))
    source = table(spark, [("a", date(2024, 1, 30), 1), ("b", date(2024, 1, 31), 1), ("c", D1, 1)])
    assert incremental.increment(source, source.limit(0), "day", cfg).count() == 3
    assert sorted(r["id"] for r in incremental.increment(source, source, "day", cfg).collect()) == ["b"]


def test_range_replacement_on_disk(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write(table(spark, [("a", D1, 1), ("b", D2, 1), ("c", D3, 1), ("d", D4, 1)]), path, "day", ("id",))
    tables.replace_range(spark, table(spark, [("x", D2, 7), ("y", D4, 7)]), path, "day", D2, D3)
    assert content(spark, path) == [("a", D1, 1), ("d", D4, 1), ("x", D2, 7)]


def test_quarter_archive(spark, tmp_path):
    assert tables.quarter_range(2024, 1) == (date(2024, 1, 1), date(2024, 3, 31))
    assert tables.quarter_range(2023, 4) == (date(2023, 10, 1), date(2023, 12, 31))
    path, archive = str(tmp_path / "t"), str(tmp_path / "archive")
    tables.write(table(spark, [("a", date(2023, 12, 31), 1), ("b", D1, 1), ("c", date(2024, 4, 1), 1)]), path, "day")
    assert tables.archive_quarter(spark, path, "day", 2024, 1, archive, delete=True) == 1
    assert [r[0] for r in content(spark, path)] == ["a", "c"]
    assert [r["id"] for r in spark.read.parquet(f"{archive}/2024-Q1").collect()] == ["b"]
    assert list((tmp_path / "archive" / "2024-Q1").glob("*.snappy.parquet"))


def test_create_if_missing_and_views(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write(table(spark, [("a", D1, 1)]), path, mode="ignore")
    tables.write(table(spark, [("b", D1, 1)]), path, mode="ignore")
    tables.create_view(spark.read.parquet(path), "kept_rows")
    assert [r["id"] for r in spark.sql("SELECT id FROM kept_rows").collect()] == ["a"]


def test_manifest_and_quarantine(spark, tmp_path):
    dump(tmp_path / "d" / "good.json", [TRIP])
    dump(tmp_path / "d" / "bad.json", [{**TRIP, "trip_id": None}, TRIP])
    raw = spark.read.schema(landing.TAXI.read_schema).json(str(tmp_path / "d"))
    files = lineage.manifest(raw, "taxi", "trip_start_timestamp", F.col("trip_id").isNull())
    got = {r["file_uri"].rsplit("/", 1)[1]: r for r in files.collect()}
    assert got["bad.json"]["quarantined"] and got["bad.json"]["row_count"] == 2
    assert got["good.json"]["partition_date"] == date(2024, 1, 5) and got["good.json"]["size_bytes"] > 0
    good, bad = lineage.split_quarantine(raw, files)
    assert (good.count(), bad.count()) == (1, 2)


@pytest.mark.parametrize("update", [False, True])
def test_stream_loads_each_file_once(spark, tmp_path, update):
    folder, path, seen = (str(tmp_path / n) for n in ("in", "out", "seen"))

    def load():
        landing_stream.load_new(spark, folder, landing.TAXI, path, seen, update).awaitTermination()
        return sorted((r["trip_id"], r["fare"]) for r in spark.read.parquet(path).collect())

    dump(tmp_path / "in" / "2024-01-05" / "a.json", [TRIP, TRIP])
    assert load() == [("t1", 12.5)]
    assert load() == [("t1", 12.5)]
    dump(tmp_path / "in" / "2024-01-06" / "b.json", [{**TRIP, "fare": "20"}, {**TRIP, "trip_id": "t2", "trip_start_timestamp": "2024-01-06T01:00:00"}])
    assert load() == [("t1", 20.0 if update else 12.5), ("t2", 12.5)]


def test_undated_rows_are_merged_like_a_day_of_their_own(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.apply_upsert(table(spark, [("a", D1, 1), ("b", None, 1), ("c", None, 1)]), path, ["id"], "day")
    assert content_of(spark, path) == {"a": (D1, 1), "b": (None, 1), "c": (None, 1)}
    # A new undated row, one that gets a day and one that loses it.
    done = incremental.apply_upsert(table(spark, [("d", None, 2), ("b", D2, 2), ("a", None, 2)]), path, ["id"], "day")
    assert content_of(spark, path) == {"a": (None, 2), "b": (D2, 2), "c": (None, 1), "d": (None, 2)}
    assert done.written == [D2, None] and done.emptied == [D1]
    done = incremental.apply_upsert(table(spark, [(k, D3, 3) for k in "abcd"]), path, ["id"], "day")
    assert content_of(spark, path) == {k: (D3, 3) for k in "abcd"} and done.emptied == [D2, None]


def content_of(spark, path):
    """Rows by key; each key once."""
    rows = spark.read.schema("id string, v int, day date").parquet(path).collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return {r["id"]: (r["day"], r["v"]) for r in rows}


@pytest.mark.parametrize("update", [False, True])
def test_stream_keeps_undated_rows(spark, tmp_path, update):
    folder, path, seen = (str(tmp_path / n) for n in ("in", "out", "seen"))
    dump(tmp_path / "in" / "a.json", [TRIP, {**TRIP, "trip_id": "t2", "trip_start_timestamp": "not a date"}])
    landing_stream.load_new(spark, folder, landing.TAXI, path, seen, update).awaitTermination()
    rows = spark.read.parquet(path).collect()
    assert sorted((r["trip_id"], r["load_day"] is None) for r in rows) == [("t1", False), ("t2", True)]


def test_manifest_feeds_the_reports_about_it(spark, tmp_path):
    import hashlib

    dump(tmp_path / "d" / "good.json", [TRIP])
    dump(tmp_path / "d" / "bad.json", [{**TRIP, "trip_id": None, "fare": None}, TRIP])
    raw = spark.read.schema(landing.TAXI.read_schema).json(str(tmp_path / "d"))
    uris = {r[0].rsplit("/", 1)[1]: r[0] for r in raw.select("_metadata.file_path").distinct().collect()}
    loads = spark.createDataFrame([(uris["good.json"], "raw_taxi", 1)], "file_uri string, bronze_table string, bronze_rows_loaded long")
    sums = lineage.checksums(spark.read.format("binaryFile").load(str(tmp_path / "d")))
    rules = {"id_missing": F.col("trip_id").isNull(), "fare_missing": F.col("fare").isNull(), "day_missing": F.col("trip_start_timestamp").isNull()}
    files = lineage.manifest(raw, "taxi", "trip_start_timestamp", rules, datetime(2024, 2, 1), "v1", checks=sums, loads=loads)
    assert files.columns == list(lineage.MANIFEST)
    got = {r["file_uri"].rsplit("/", 1)[1]: r for r in files.collect()}
    good, bad = got["good.json"], got["bad.json"]
    assert good["loaded_to_bronze"] and good["processing_stage"] == "bronze" and good["validation_checks_passed"] == 3
    assert bad["quarantine_reason"] == "id_missing: 1 rows, fare_missing: 1 rows" and not bad["loaded_to_bronze"]
    assert {n: r["sha256_checksum"] for n, r in got.items()} == {n: hashlib.sha256((tmp_path / "d" / n).read_bytes()).hexdigest() for n in got}
    assert lineage.freshness(files, datetime(2030, 1, 1)).first()["total_files"] == 1
    missing = lineage.missing_dates(files, "taxi", date(2024, 1, 4), date(2024, 1, 6))
    assert sorted(r[0] for r in missing.collect()) == [date(2024, 1, 4), date(2024, 1, 6)]


def test_rows_without_a_key_are_kept_apart_and_repeat_safely(spark, tmp_path):
    """No row is lost, repeated or invented: NULL equals nothing, and a second run adds nothing."""
    source = table(spark, [(None, D1, 1), (None, D1, 1), (None, D2, 5), ("a", D1, 1), ("a", D1, 2), (None, None, 7)])
    want = sorted([(None, D1, 1), (None, D1, 1), (None, D2, 5), ("a", D1, 2), (None, None, 7)], key=str)
    path = str(tmp_path / "t")
    for _ in range(3):
        incremental.apply_upsert(source, path, ["id"], "day", version="v")
        stored = spark.read.schema("id string, v int, day date").parquet(path)
        assert sorted(((r["id"], r["day"], r["v"]) for r in stored.collect()), key=str) == want
    # One more of the same, and a new one: as often as the source has them.
    more = table(spark, [(None, D1, 1), (None, D1, 1), (None, D1, 1), (None, D4, 1)])
    incremental.apply_upsert(more, path, ["id"], "day")
    assert spark.read.parquet(path).count() == len(want) + 2
    again = spark.read.schema("id string, v int, day date").parquet(path).select("id", "day", "v")
    lazy = incremental.upsert(again, more, ["id"]).collect()
    assert sum(r["id"] is None and r["day"] == D1 for r in lazy) == 3


class Lost(BaseException):
    """The driver is gone."""


@pytest.mark.parametrize("step", ["overwrite_days", "drop_days"])
def test_a_change_cut_short_is_finished_by_the_next_run(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    incremental.apply_upsert(table(spark, [("a", D1, 1), ("b", D2, 1), ("c", D2, 1)]), path, ["id"], "day")

    def lost(*_):
        raise Lost

    monkeypatch.setattr(tables, step, lost)
    with pytest.raises(Lost):
        incremental.apply_upsert(table(spark, [("a", D3, 2)]), path, ["id"], "day")
    monkeypatch.undo()
    if step == "drop_days":  # the moved row is there twice until the change is finished
        assert [r[0] for r in content(spark, path)].count("a") == 2
    incremental.apply_upsert(table(spark, [("d", D4, 3)]), path, ["id"], "day")
    assert content(spark, path) == [("a", D3, 2), ("b", D2, 1), ("c", D2, 1), ("d", D4, 3)]
    assert not tables.recover(spark, path) and not list((tmp_path / "t").glob("_change*"))
    monkeypatch.setattr(tables, step, lost)
    with pytest.raises(Lost):
        tables.replace_range(spark, table(spark, [("e", D2, 4)]), path, "day", D1, D3)
    monkeypatch.undo()
    assert tables.recover(spark, path)
    assert content(spark, path) == [("d", D4, 3), ("e", D2, 4)]


def rows_scanned(df):
    """Rows that the scans of a query gave, by what it measured itself."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves, out = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        leaf = leaf.plan() if "QueryStage" in leaf.nodeName() else leaf
        inner = leaf.collectLeaves()
        for k in range(inner.size()):
            if "Scan parquet" in inner.apply(k).nodeName():
                out += inner.apply(k).metrics().apply("numOutputRows").value()
    return out


def test_few_keys_are_looked_up_where_files_may_hold_them(spark, tmp_path):
    """Ten keys over 200 files of mixed keys: the files' own filters rule nearly all of them out."""
    path = str(tmp_path / "t")
    stored = spark.range(200_000).selectExpr("sha2(string(id), 256) AS id", "date_add(DATE'2024-01-01', int(id % 50)) AS day", "int(id) AS v")
    tables.write(stored.repartition(4), path, "day", keys=("id",))
    target = spark.read.parquet(path)
    asked = spark.range(0, 200_000, 20_000).selectExpr("sha2(string(id), 256) AS id")
    found = tables.probe(target.select("id", "day"), asked, ["id"])
    assert found.count() == 10 and rows_scanned(found) <= 60_000 and rows_scanned(target.select("id")) == 200_000
    many = spark.range(5000).selectExpr("sha2(string(id), 256) AS id")
    assert tables.probe(target, many, ["id"]).count() == 200_000
    assert tables.probe(target, asked.limit(0), ["id"]).count() == 0
    change = asked.selectExpr("id", "DATE'2024-03-01' AS day", "-1 AS v")
    done = incremental.apply_upsert(change, path, ["id"], "day")
    after = spark.read.parquet(path)
    assert after.count() == 200_000 and after.filter("v = -1").count() == 10 and date(2024, 3, 1) in done.written


def test_an_altered_archive_keeps_the_table(spark, tmp_path, monkeypatch):
    path, archive = str(tmp_path / "t"), str(tmp_path / "a")
    rows = [("a", D1, 1), ("b", D2, 2), ("b", D2, 2), ("c", D3, None), (None, D3, 3)]
    tables.write(table(spark, rows), path, "day")
    own, calls = tables.content, []

    def altered(df, partition):
        calls.append(1)
        return own(df if len(calls) == 1 else df.withColumn("v", F.when(F.col("id") == "a", 9).otherwise(F.col("v"))), partition)

    monkeypatch.setattr(tables, "content", altered)
    with pytest.raises(RuntimeError, match="2024-01-01"):
        tables.archive_quarter(spark, path, "day", 2024, 1, archive, delete=True)
    monkeypatch.undo()
    assert spark.read.parquet(path).count() == 5
    swapped = table(spark, [("c", D3, 3), (None, D3, None)])
    assert own(swapped, "day") != own(table(spark, rows[3:]), "day")
    assert own(table(spark, rows[:3]), "day") != own(table(spark, rows[:2]), "day")
    assert own(table(spark, rows).repartition(3), "day") == own(table(spark, rows[::-1]), "day")
    assert tables.archive_quarter(spark, path, "day", 2024, 1, archive, delete=True) == 5
    assert not tables.exists(spark, path) and spark.read.parquet(f"{archive}/2024-Q1").count() == 5


def test_either_end_prunes_row_groups(spark, tmp_path):
    """Rows sorted by interleaved bits: a filter on the second column skips row groups as well as one on the first."""
    ends = spark.range(160_000).selectExpr("string(id % 80) AS a", "string(id div 80 % 80) AS b", "sha2(string(id), 256) AS v")
    path = {n: str(tmp_path / n) for n in ("plain", "mixed")}
    small = lambda df, p: df.coalesce(1).sortWithinPartitions(*p[0]).write.option("parquet.block.size", 200_000).option("parquet.block.size.row.check.max", 1).parquet(p[1])
    small(ends, (("a", "b"), path["plain"]))
    small(ends, ((tables.interleaved(F.col("a"), F.col("b")),), path["mixed"]))
    read = lambda n, c: rows_scanned(spark.read.parquet(path[n]).filter(f"{c} = '33'").select("v"))
    assert read("mixed", "b") < 60_000 and read("mixed", "a") < 60_000
    assert read("plain", "b") > 2 * read("mixed", "b")
    key = spark.sql("SELECT '5' AS a, 3 AS b").select(tables.interleaved(F.col("a"), F.col("b"), bits=3).alias("k")).first()["k"]
    assert key == 0b100111
    odd = spark.createDataFrame([(None, -4, "x"), ("999", 7, "1")], "a string, b int, c string")
    assert [r[0] for r in odd.select(tables.interleaved(F.col("a"), F.col("b"), F.col("c"), bits=2)).collect()] == [0, 0b110111]


def test_the_manifest_is_kept_by_the_stream(spark, tmp_path, monkeypatch):
    folder, path, files = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "manifest")
    dump(folder / "a.json", [TRIP, {**TRIP, "trip_id": "t2"}])
    run = lambda: landing_stream.load_new(spark, str(folder), landing.TAXI, path, str(tmp_path / "check"), manifest=files)
    real = landing_stream.apply_upsert

    def lost(*args, **more):
        real(*args, **more)
        raise RuntimeError("lost")

    # The batch is noted, then its driver is lost before the batch counts as done: it runs again.
    monkeypatch.setattr(landing_stream, "apply_upsert", lost)
    with pytest.raises(Exception, match="lost"):
        run().awaitTermination()
    monkeypatch.undo()
    run().awaitTermination()
    (folder / "b.json").write_text(json.dumps({**TRIP, "trip_id": "t7"}) + "\nbroken\n")
    run().awaitTermination()
    got = {r["file_uri"].rsplit("/", 1)[1]: r for r in spark.read.parquet(files).collect()}
    assert list(lineage.MANIFEST) == [c for c in spark.read.parquet(files).select(*lineage.MANIFEST).columns]
    a, b = got["a.json"], got["b.json"]
    assert len(got) == 2 and (a["row_count"], b["row_count"]) == (2, 2)
    assert (a["bronze_load_job_id"], b["bronze_load_job_id"]) == ("taxi-0", "taxi-1")
    assert (a["bronze_rows_loaded"], b["bronze_rows_loaded"]) == (2, 1) and a["partition_date"] == date(2024, 1, 5)
    assert not a["quarantined"] and b["quarantine_reason"] == "malformed_line: 1 rows" and a["size_bytes"] > 0
    assert spark.read.parquet(path).count() == 3
