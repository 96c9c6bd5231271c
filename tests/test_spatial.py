"""Lookup and overlap on shapes that are not rectangles, against direct computation."""

import math
import random
import re

import pytest
from pyspark.sql import Row

from wardline.functions import geometry as G
from wardline.operators import spatial
from wardline.sources import boundaries

SCHEMA = "id string, rings array<array<array<struct<x:double,y:double>>>>"


def shape(*polygons):
    """Each polygon is a list of rings, each ring a list of (x, y)."""
    return [[[Row(x=float(x), y=float(y)) for x, y in ring] for ring in poly] for poly in polygons]


TRIANGLE = [[(0.0, 0.0), (1.0, 0.0), (0.5, 0.9)]]
RING = [[(2, 0), (3, 0), (3, 1), (2, 1)], [(2.3, 0.3), (2.7, 0.3), (2.7, 0.7), (2.3, 0.7)]]
TWO_A, TWO_B = [[(0.2, 0.1), (0.9, 0.1), (0.9, 0.4), (0.2, 0.4)]], [[(2.5, 0.5), (3.5, 0.5), (3.0, 1.4)]]
CONCAVE = [[(0, 2), (2, 2), (2, 3), (1, 2.2), (0, 3)]]


def star(n, cx, cy, r):
    """A jagged outline with many small edges."""
    rnd = random.Random(5)
    reach = [(2 * math.pi * k / n, r * rnd.uniform(0.4, 1)) for k in range(n)]
    return [(cx + d * math.cos(a), cy + d * math.sin(a)) for a, d in reach]


SHAPES = {
    "triangle": shape(TRIANGLE),
    "ring": shape(RING),
    "two": shape(TWO_A, TWO_B),
    "concave": shape(CONCAVE),
    "star": shape([star(60, 2.4, 2.2, 0.7)]),
}


def holds(rings, x, y):
    odd = False
    for poly in rings:
        for ring in poly:
            for p, q in zip(ring, ring[1:] + ring[:1]):
                if (p.y > y) != (q.y > y) and x < (q.x - p.x) * (y - p.y) / (q.y - p.y) + p.x:
                    odd = not odd
    return odd


@pytest.fixture(scope="module")
def layer_df(spark):
    return spark.createDataFrame([(k, v) for k, v in SHAPES.items()], SCHEMA)


@pytest.fixture(scope="module")
def points(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.uniform(-0.5, 4), rnd.uniform(-0.5, 3.5)) for i in range(3000)]
    rows += [(9000, None, 1.0), (9001, 0.5, None)]
    return spark.createDataFrame(rows, "n long, lon double, lat double")


@pytest.mark.parametrize("cell,limit", [(0.25, 1 << 20), (0.07, 1 << 20), (10.0, 1 << 20), (0.25, 0)])
def test_lookup_is_the_ray_cast(spark, layer_df, points, cell, limit):
    prepared = spatial.layer(layer_df, ["id"], cell, limit)
    assert prepared.small == (limit > 0)
    found = spatial.locate(points, "lon", "lat", prepared, {"id": "place"})
    got = sorted((r["n"], r["place"] or "") for r in found.collect())
    want = []
    for p in points.collect():
        hits = (
            [k for k, v in SHAPES.items() if holds(v, p["lon"], p["lat"])]
            if p["lon"] is not None and p["lat"] is not None
            else []
        )
        want += [(p["n"], h) for h in (hits or [""])]
    assert got == sorted(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert ("SortMergeJoin" in plan) == (limit == 0)
    # No expression of the lookup keeps the join out of generated code.
    assert limit == 0 or re.search(r"\*\(\d+\) BroadcastHashJoin", codegen(found))


def codegen(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_points_on_borders_have_one_owner(spark):
    """Two boxes that share a border split its points between them."""
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 1.0, 1.0), ("b", 1.0, 0.0, 2.0, 1.0)], "id string, x0 double, y0 double, x1 double, y1 double")
    prepared = spatial.layer(boundaries.from_boxes(boxes), ["id"], 0.5, 1 << 20)
    pts = spark.createDataFrame([(1.0, 0.5), (0.0, 0.0), (1.0, 0.0), (2.0, 0.5), (0.5, 1.0)], "lon double, lat double")
    got = {(r["lon"], r["lat"]): r["id"] for r in spatial.locate(pts, "lon", "lat", prepared, {"id": "id"}).collect()}
    assert got == {(1.0, 0.5): "b", (0.0, 0.0): "a", (1.0, 0.0): "b", (2.0, 0.5): None, (0.5, 1.0): None}


def grid_star(rnd):
    """A simple outline around a grid point, all its corners on the grid."""
    steps = {(dx, dy) for dx in range(-3, 4) for dy in range(-3, 4) if math.gcd(dx, dy) == 1}
    around = sorted(rnd.sample(sorted(steps), rnd.randrange(5, 20)), key=lambda d: math.atan2(d[1], d[0]))
    reach = [rnd.randrange(1, 4) for _ in around]
    return [(d[0] * r * 0.25, d[1] * r * 0.25) for d, r in zip(around, reach)]


def test_corners_and_edges_on_the_grid(spark):
    rnd = random.Random(11)
    shapes = [(f"s{i}", shape([grid_star(rnd)])) for i in range(40)]
    shapes += [(f"t{i}", shape([[(rnd.randrange(-8, 9) / 4, rnd.randrange(-8, 9) / 4) for _ in range(3)]])) for i in range(40)]
    stairs = [(x / 4, y / 4) for i in range(8) for y in [rnd.randrange(1, 9)] for x in (i, i + 1)]
    shapes += [("stairs", shape([[(0.0, 0.0), *stairs, (2.0, 0.0)]])), ("twice", shape(TRIANGLE)), ("twice", shape(TRIANGLE))]
    df = spark.createDataFrame(shapes, SCHEMA)
    pts = [(rnd.uniform(-2.6, 2.6), rnd.uniform(-2.6, 2.6)) for _ in range(400)]
    pts += [(rnd.randrange(-9, 10) / 4 + 1e-6, rnd.randrange(-9, 10) / 4 + 1e-6) for _ in range(200)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "n long, lon double, lat double")
    want = sorted((i, k) for i, p in enumerate(pts) for k, v in shapes if holds(v, *p))
    for cell in (0.25, 0.4, 3.0):
        found = spatial.locate(points, "lon", "lat", spatial.layer(df, ["id"], cell, 1 << 30), {"id": "place"})
        assert sorted((r["n"], r["place"]) for r in found.collect() if r["place"]) == want


def test_work_grows_with_edges_and_cells(spark):
    """A border of 100,000 edges over 10,000 cells: rows per edge and cell, not their product, over many tasks."""
    n = 100_000
    turn = [2 * math.pi * k / n for k in range(n)]
    wave = [(1 + 0.1 * math.sin(50 * a)) * 0.45 for a in turn]
    outline = [(0.5 + r * math.cos(a), 0.5 + r * math.sin(a)) for a, r in zip(turn, wave)]
    df = spark.createDataFrame([("wave", shape([outline]))], SCHEMA)
    prepared = spatial.layer(df, ["id"], 0.01, 1 << 30)
    pieces = prepared.pieces
    assert pieces.count() < 4 * n and pieces.select("cell_i", "cell_j").distinct().count() > 5000
    rnd = random.Random(3)
    pts = [(rnd.random(), rnd.random()) for _ in range(5000)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "n long, lon double, lat double")
    got = {r["n"] for r in spatial.locate(points, "lon", "lat", prepared, {"id": "id"}).collect() if r["id"]}
    far = [(i, math.hypot(x - 0.5, y - 0.5), math.atan2(y - 0.5, x - 0.5)) for i, (x, y) in enumerate(pts)]
    assert got == {i for i, d, a in far if d < (1 + 0.1 * math.sin(50 * a)) * 0.45}
    plan = spatial._pieces(df, ("id",), 0.01, "rings")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_id" in plan and plan.count("REPARTITION_BY_COL") == 1


def test_size_counts_attributes(spark):
    boxes = spark.createDataFrame([("x" * 5000, 0.0, 0.0, 1.0, 1.0)], "id string, x0 double, y0 double, x1 double, y1 double")
    df = boundaries.from_boxes(boxes)
    assert not spatial.layer(df, ["id"], 0.25, 30_000).small and spatial.layer(df, ["id"], 0.25, 1 << 20).small


def test_degenerate_polygons_hold_nothing(spark):
    df = spark.createDataFrame([("empty", []), ("none", None), ("line", shape([[(0, 0), (1, 1)]]))], SCHEMA)
    prepared = spatial.layer(df, ["id"], 0.5, 1 << 20)
    pts = spark.createDataFrame([(0.5, 0.4)], "lon double, lat double")
    assert [r["id"] for r in spatial.locate(pts, "lon", "lat", prepared, {"id": "id"}).collect()] == [None]


def _m2(area_deg, lat):
    rad = math.pi / 180
    return area_deg * rad * rad * math.cos(lat * rad) * G.EARTH_RADIUS_M**2


def test_area_of_shapes(spark, layer_df):
    got = {r["id"]: r["a"] for r in layer_df.selectExpr("id", f"{G.area_m2('rings')} AS a").collect()}
    assert got["ring"] == pytest.approx(_m2(1 - 0.16, 0.5), rel=1e-3)
    assert got["triangle"] == pytest.approx(_m2(0.45, 0.3), rel=1e-3)
    assert got["two"] == pytest.approx(_m2(0.21, 0.25) + _m2(0.45, 0.8), rel=1e-3)


def test_overlap_of_shapes(spark, layer_df):
    """Triangle with a box, and a polygon with a hole with a box that covers the hole."""
    boxes = spark.createDataFrame(
        [("low", -1.0, 0.0, 2.0, 0.45), ("hole", 2.2, 0.2, 2.8, 0.8), ("far", 8.0, 8.0, 9.0, 9.0)],
        "box string, x0 double, y0 double, x1 double, y1 double",
    )
    a = spatial.cover(layer_df, ["id"], 0.1)
    b = spatial.cover(boundaries.from_boxes(boxes), ["box"], 0.1)
    got = {(r["id"], r["box"]): r["intersection_area"] for r in spatial.overlap_area([(a, ["id"]), (b, ["box"])], 0.1).collect()}
    # The lower half of the triangle holds three quarters of it.
    assert got["triangle", "low"] == pytest.approx(_m2(0.45 * 0.75, 0.2), rel=2e-3)
    assert got["ring", "hole"] == pytest.approx(_m2(0.36 - 0.16, 0.5), rel=2e-3)
    assert not [k for k in got if k[1] == "far"]


NODES = [(0.0, 0.5688888888888889), *((s * x, w) for s in (1, -1) for x, w in ((0.538469310105683, 0.478628670499366), (0.906179845938664, 0.236926885056189)))]


def sphere_m2(ring):
    """Area of a ring whose edges are straight in longitude and latitude, by quadrature along its edges."""
    total, east = 0.0, ring[0][0]
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        at = [((1 + n) / 2, w / 2) for n, w in NODES]
        total += math.radians(y2 - y1) * sum(w * math.radians(x1 + (x2 - x1) * t - east) * math.cos(math.radians(y1 + (y2 - y1) * t)) for t, w in at)
    return abs(total) * G.EARTH_RADIUS_M**2


def clipped(ring, by):
    """The part of a ring inside a convex, counter-clockwise one."""
    for (x1, y1), (x2, y2) in zip(by, by[1:] + by[:1]):
        side = lambda p: (x2 - x1) * (p[1] - y1) - (y2 - y1) * (p[0] - x1)
        out = []
        for p, q in zip(ring, ring[1:] + ring[:1]):
            if side(p) >= 0:
                out.append(p)
            if side(p) * side(q) < 0:
                t = side(p) / (side(p) - side(q))
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        ring = out
    return ring


def test_overlap_is_exact_for_slanted_borders(spark):
    rnd = random.Random(21)

    def triangle():
        p = [(rnd.uniform(-88, -87), rnd.uniform(41, 42)) for _ in range(3)]
        turn = (p[1][0] - p[0][0]) * (p[2][1] - p[0][1]) - (p[1][1] - p[0][1]) * (p[2][0] - p[0][0])
        return p if turn > 0 else p[::-1]

    sets = [[(f"{n}{i}", triangle()) for i in range(12)] for n in "abc"]
    frames = [spark.createDataFrame([(k, shape([r])) for k, r in part], f"{n} string, rings array<array<array<struct<x:double,y:double>>>>") for n, part in zip("abc", sets)]
    want, three = {}, {}
    for k, r in sets[0]:
        for m, q in sets[1]:
            common = clipped(r, q)
            if len(common) > 2:
                want[k, m] = sphere_m2(common)
                three |= {(k, m, o): sphere_m2(c) for o, w in sets[2] if len(c := clipped(common, w)) > 2}
    for size in (0.05, 0.7):
        a, b, c = ((spatial.cover(df, [n], size), [n]) for n, df in zip("abc", frames))
        got = {(r["a"], r["b"]): r["intersection_area"] for r in spatial.overlap_area([a, b], size).collect()}
        assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-3) for k in want)
        got = {(r["a"], r["b"], r["c"]): r["intersection_area"] for r in spatial.overlap_area([a, b, c], size).collect()}
        assert set(got) == set(three) and all(got[k] == pytest.approx(three[k], rel=1e-9, abs=1e-3) for k in three)
    own = {r["a"]: r["m2"] for r in frames[0].selectExpr("a", f"{G.area_m2('rings')} AS m2").collect()}
    assert all(own[k] == pytest.approx(sphere_m2(r), rel=1e-6) for k, r in sets[0])


def test_neighbours_only_touch(spark):
    """Two parts of a square along a slanted border, against themselves: no row for the border."""
    halves = spark.createDataFrame([("low", shape([[(0.0, 0.0), (1.0, 0.0), (1.0, 0.7)]])), ("up", shape([[(0.0, 0.0), (1.0, 0.7), (0.3, 1.0)]]))], SCHEMA)
    a = spatial.cover(halves, ["id"], 0.1)
    got = spatial.overlap_area([(a, ["id"]), (a.withColumnRenamed("id", "other"), ["other"])], 0.1)
    assert sorted((r["id"], r["other"]) for r in got.collect()) == [("low", "low"), ("up", "up")]


def test_shares_never_pass_the_whole(spark, small):
    from wardline.plans.lake import Lake

    lake = Lake(spark, small)
    per_area = lake.community_zip.groupBy("community_area_number").sum("pct_of_community_area").collect()
    assert per_area and all(r[1] <= 100.1 for r in per_area)


def test_centroid_and_distance(spark, layer_df):
    got = {r["id"]: (r["longitude"], r["latitude"]) for r in spatial.centroids(layer_df).collect()}
    assert got["triangle"] == pytest.approx((0.5, 0.3))
    d = spark.sql(f"SELECT {G.haversine_m('0D', '0D', '1D', '0D')} AS d").first()["d"]
    assert d == pytest.approx(math.pi / 180 * G.EARTH_RADIUS_M)
