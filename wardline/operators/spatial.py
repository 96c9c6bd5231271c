"""Point-in-polygon lookup and polygon overlap as joins.

Lookup. Each polygon is laid over a fixed grid once. A cell that no edge touches
is wholly inside or wholly outside. A cell on the border is cut into pieces
between two heights and two lines, so that being inside is four comparisons.
Points join the pieces on the cell number: one pass over the rows, in generated
code, and without a shuffle while the layer is small.

Overlap. The same pieces of different layers meet in their cell. No pair of polygons
is formed that does not share one, and the common area of two pieces is summed over
the parts between the heights at which their lines cross, in closed form.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions import geometry as G
from wardline.functions.columns import half_up
from wardline.session import computed_once

# Slack around a cell, so that float noise in the cell number never hides an edge.
_SLACK = 1e-9


@dataclass(frozen=True)
class Layer:
    """A polygon layer prepared for lookups.

    ``pieces`` has one row per (grid cell, polygon, piece) with the attributes of
    the polygon; ``small`` says whether its measured size allows a broadcast.
    """

    pieces: DataFrame
    attributes: tuple[str, ...]
    cell_degrees: float
    small: bool


# A line x(y) = x + s * (y - y0), and the two lines no point is left or right of.
_FAR = "1e300D"
_LINE = "named_struct('at', {at}, 'x', {x}, 'y', {y}, 's', {s})"
_WEST_END = _LINE.format(at="-" + _FAR, x="-" + _FAR, y="0D", s="0D")
_EAST_END = _LINE.format(at=_FAR, x=_FAR, y="0D", s="0D")


def _clipped(x1: str, y1: str, x2: str, y2: str) -> str:
    """West and east ends ``w`` and ``e`` of an edge within the grid row from ``low`` to ``high``.

    An end of the edge that lies in the row is taken as it is, so that edges that share a corner both reach it.
    """

    def at(y: str) -> str:
        return f"{x1} + ({x2} - {x1}) / ({y2} - {y1}) * ({y} - {y1})"

    down = f"IF({y1} >= low OR {y1} = {y2}, {x1}, {at('low')})"
    up = f"IF({y2} <= high OR {y1} = {y2}, {x2}, {at('high')})"
    return f"named_struct('w', least({down}, {up}), 'e', greatest({down}, {up}))"


def _upwards(rings: str) -> str:
    """Edges run upwards, so that two polygons sharing one compute the same line.

    Each knows the far ends of its neighbours in the ring: (lx, ly) below, (hx, hy) above.
    """
    point = "ring[(i + {k} + size(ring)) % size(ring)]"
    p, q, before, after = (point.format(k=k) for k in (0, 1, -1, 2))

    def fields(low, high, under, over):
        named = (("1", low), ("2", high), ("l", under), ("h", over))
        # Adding zero turns -0.0 into 0.0, which compare as different in arrays.
        parts = [f"'{axis}{n}', {v}.{axis} + 0D" if n.isdigit() else f"'{n}{axis}', {v}.{axis} + 0D" for n, v in named for axis in "xy"]
        return f"named_struct({', '.join(parts)})"

    edge = f"IF({p}.y <= {q}.y, {fields(p, q, before, after)}, {fields(q, p, after, before)})"
    return f"flatten(transform(flatten({rings}), ring -> transform(ring, (p, i) -> {edge})))"


def _pieces(boundaries: DataFrame, attributes: tuple[str, ...], size: float, rings: str) -> DataFrame:
    """Cells of every polygon, cut into pieces. Borders must not cross themselves.

    Every edge goes to the cells it crosses, row by row of the grid, so the work grows with edges and cells; rows of
    the grid are dealt to the tasks, those of one polygon too. In a row, an edge holds the cells from its west end to
    its east end and lies east of the cells before them.

    Only heights at which an edge that touches the cell begins or ends can change what is inside, so a touched cell
    is cut there into slabs. Whether the far side of it is inside follows from the edges east of it. How many of them
    cross the foot of the row is a running count over the row's touched cells. Above the foot the count can turn only
    where an edge of the cell meets an edge east of it: all other corners join two edges that both count or do not.
    Untouched cells between touched ones are wholly inside or outside, as the running count says.
    """
    size_, slack = f"{size!r}D", f"{_SLACK!r}D"
    cell = lambda x, sign: f"floor(({x} {sign} {slack}) / {size_})"
    copies = Window.partitionBy("_id").orderBy("_id")
    # Equal rows are different polygons, which nothing but their number tells apart.
    polygons = (
        boundaries.selectExpr(f"named_struct({', '.join(f'{a!r}, {a}' for a in attributes)}) AS _of", f"{rings} AS _rings")
        .selectExpr("_of", "_rings", "xxhash64(_of, _rings) AS _id")
        .withColumn("_copy", F.row_number().over(copies))
    )
    own = ["_id", "_copy", "j"]
    rows = (
        polygons.selectExpr("_id", "_copy", "_of", f"inline({_upwards('_rings')})")
        .selectExpr("*", f"explode(sequence({cell('y1', '-')}, {cell('y2', '+')})) AS j")
        .selectExpr("*", f"j * {size_} - {slack} AS low", f"(j + 1) * {size_} + {slack} AS high")
    )
    # The first cell of the neighbour at each end, where that end lies in the row; it is drawn upwards as well.
    upward = lambda v, o: [f"IF({v[1]} <= {o[1]}, {a}, {b})" for a, b in (*zip(v, o), *zip(o, v))]
    met = lambda v, o: f"IF({v[1]} > low AND {v[1]} < high, {cell(_clipped(*upward(v, o)) + '.w', '-')}, NULL)"
    edges = (
        rows.selectExpr(
            *own, "_of", "low", "high", "x1", "y1", "x2", "y2",
            f"{_clipped('x1', 'y1', 'x2', 'y2')} AS reach",
            f"{met(('x1', 'y1'), ('lx', 'ly'))} AS n1",
            f"{met(('x2', 'y2'), ('hx', 'hy'))} AS n2",
        )
        .selectExpr("*", f"{cell('reach.w', '-')} AS first", f"{cell('reach.e', '+')} AS last")
        .selectExpr("*", "explode(sequence(first, last)) AS i")
        .repartition(*own)
    )
    along = Window.partitionBy(*own).orderBy(F.desc("i"))
    cells = (
        edges.groupBy(*own, "i")
        .agg(
            F.first("_of").alias("_of"),
            F.first("low").alias("low"),
            F.first("high").alias("high"),
            F.expr("collect_list(named_struct('x1', x1, 'y1', y1, 'x2', x2, 'y2', y2, 'n1', n1, 'n2', n2))").alias("touching"),
            F.expr("sum(IF(first = i AND y1 <= low AND y2 > low, 1, 0))").alias("foot"),
        )
        .withColumn("foot", F.coalesce(F.sum("foot").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2)
        .withColumn("next", F.lag("i").over(along))
    )
    ends = "flatten(transform(touching, e -> array(e.y1, e.y2)))"
    turns = "flatten(transform(touching, e -> array(IF(e.n1 > i, e.y1, NULL), IF(e.n2 > i, e.y2, NULL))))"
    slabs = "sequence(0, size(h) - 2)"
    mid = "(h[k] + h[k + 1]) / 2"
    at = lambda v: f"int(array_position(h, {v}) - 1)"
    slope = "(e.x2 - e.x1) / (e.y2 - e.y1)"
    line = _LINE.format(at=f"e.x1 + {slope} * ({mid} - e.y1)", x="e.x1", y="e.y1", s=slope)
    none = "CAST(NULL AS STRUCT<at: DOUBLE, x: DOUBLE, y: DOUBLE, s: DOUBLE>)"
    # The outermost pieces have no limit: the cell number has settled it.
    marks = (
        f"transform({slabs}, k -> named_struct('c', i, 'k', k, 'y0', IF(k = 0, -{_FAR}, h[k]), 'y1', IF(k = size(h) - 2, {_FAR}, h[k + 1]), "
        f"'east', int((foot + size(filter(turns, v -> v <= {mid}))) % 2), 'line', {none}))"
    )
    # An edge goes to the slabs it spans and to no other.
    spanned = (
        "flatten(transform(spans, s -> transform(sequence(s.f, s.t - 1), k -> named_struct('c', i, 'k', k, 'y0', CAST(NULL AS DOUBLE), "
        f"'y1', CAST(NULL AS DOUBLE), 'east', CAST(NULL AS INT), 'line', {line.replace('e.', 's.e.')}))))"
    )
    between = (
        f"IF(foot = 1 AND next > i + 1, transform(sequence(i + 1, next - 1), c -> named_struct('c', c, 'k', 0, 'y0', -{_FAR}, "
        f"'y1', {_FAR}, 'east', 1, 'line', {none})), array())"
    )
    closed = (
        f"concat(IF((size(lines) + east) % 2 = 1, array({_WEST_END}), array()), lines, "
        f"IF(east = 1, array({_EAST_END}), array()))"
    )
    cut = (
        cells.selectExpr("*", f"concat(array(low), array_sort(array_distinct(filter({ends}, v -> v > low AND v < high))), array(high)) AS h")
        .selectExpr(
            "*",
            f"filter({turns}, v -> v IS NOT NULL) AS turns",
            f"filter(transform(touching, e -> named_struct('e', e, 'f', {at('greatest(e.y1, low)')}, "
            f"'t', {at('least(e.y2, high)')})), s -> s.t > s.f) AS spans",
        )
        .selectExpr(*own, "_of", f"inline(concat({marks}, {spanned}, {between}))")
        .groupBy(*own, "c", "k")
        .agg(
            F.first("_of").alias("_of"),
            *(F.max(c).alias(c) for c in ("y0", "y1", "east")),
            F.sort_array(F.collect_list("line")).alias("lines"),
        )
        .selectExpr("_of", "c", "j", "y0", "y1", f"{closed} AS b")
        .filter("size(b) > 1")
    )
    pairs = "transform(sequence(0, CAST(size(b) / 2 AS INT) - 1), k -> named_struct('l', b[2 * k], 'r', b[2 * k + 1]))"
    return (
        cut.selectExpr("_of", "c AS cell_i", "j AS cell_j", "y0", "y1", f"inline({pairs})")
        .selectExpr("_of.*", "cell_i", "cell_j", "y0", "y1", *[f"{e}.{c} AS {e}{c}" for e in "lr" for c in "xys"])
    )


def layers(
    parts: list[tuple[DataFrame, list[str]]], cell_degrees: float, broadcast_bytes: int, rings: str = "rings"
) -> list[Layer]:
    """Prepare several layers, each given with the attributes to keep, and measure them.

    The pieces of all layers are written in one job, for all lookups, and counted in
    another. A layer above the limit is never broadcast: its lookups become shuffle
    joins on the cell, where adaptive execution splits cells that hold too many
    points.
    """
    cut = [
        _pieces(df, tuple(attributes), cell_degrees, rings).withColumn("layer", F.lit(i))
        for i, (df, attributes) in enumerate(parts)
    ]
    written = computed_once(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cut))
    # One row per layer: what its pieces take, twelve numbers and the attributes as text each.
    names = dict.fromkeys(a for _, attributes in parts for a in attributes)
    text = " + ".join(["96L", *(f"coalesce(octet_length(CAST(`{a}` AS STRING)), 0) + 8" for a in names)])
    taken = {r["layer"]: r["bytes"] for r in written.groupBy("layer").agg(F.expr(f"sum({text})").alias("bytes")).collect()}
    return [
        Layer(
            written.filter(F.col("layer") == i),
            tuple(attributes),
            cell_degrees,
            taken.get(i, 0) <= broadcast_bytes,
        )
        for i, (_, attributes) in enumerate(parts)
    ]


def layer(
    boundaries: DataFrame, attributes: list[str], cell_degrees: float, broadcast_bytes: int, rings: str = "rings"
) -> Layer:
    return layers([(boundaries, attributes)], cell_degrees, broadcast_bytes, rings)[0]


def locate(
    points: DataFrame,
    lon: str,
    lat: str,
    where: Layer,
    names: dict[str, str],
) -> DataFrame:
    """Left join each point to every polygon that contains it.

    ``names`` maps layer attributes to output columns. A point in no polygon keeps
    one row with NULLs; a point in several polygons gets one row per polygon.
    """
    limits = ["y0", "y1", *[f"{e}{c}" for e in "lr" for c in "xys"]]
    pieces = where.pieces.selectExpr(
        "cell_i AS _i",
        "cell_j AS _j",
        *[f"{c} AS _{c}" for c in limits],
        *[f"{a} AS {out}" for a, out in names.items()],
    )
    pieces = F.broadcast(pieces) if where.small else pieces.hint("merge")
    size = f"{where.cell_degrees!r}D"
    hit = (
        f"_i = floor({lon} / {size}) AND _j = floor({lat} / {size}) AND {lat} >= _y0 AND {lat} < _y1 "
        f"AND {lon} >= _lx + _ls * ({lat} - _ly) AND {lon} < _rx + _rs * ({lat} - _ry)"
    )
    return points.join(pieces, F.expr(hit), "left").drop("_i", "_j", *[f"_{c}" for c in limits])


def located_points(points: DataFrame, lon: str, lat: str, layers: list[tuple[Layer, dict]]) -> DataFrame:
    """Several layers in turn; each contained layer adds its columns."""
    return reduce(lambda df, l: locate(df, lon, lat, l[0], l[1]), layers, points)


# ---------------------------------------------------------------- overlap


#: Overlaps below this many square metres are rounding, where borders only touch.
_TOUCHING_M2 = 1e-6


def cover(boundaries: DataFrame, keys: list[str], size: float, rings: str = "rings") -> DataFrame:
    """The pieces of each polygon inside the cells of the grid: (keys, cell_i, cell_j, y0, y1, west, east).

    ``west`` and ``east`` are the lines a piece lies between, without those that no point is beyond.
    """
    line = lambda e: f"IF(abs({e}x) >= {_FAR}, array(), array(named_struct('x', {e}x, 'y', {e}y, 's', {e}s)))"
    return (
        _pieces(boundaries, tuple(keys), size, rings)
        .selectExpr(
            *keys,
            "cell_i",
            "cell_j",
            f"greatest(y0, cell_j * {size!r}D) AS y0",
            f"least(y1, (cell_j + 1) * {size!r}D) AS y1",
            f"{line('l')} AS west",
            f"{line('r')} AS east",
        )
        .filter("y1 > y0")
    )


def _piece_area(size: float) -> tuple[str, ...]:
    """Steps to the area on the sphere, in square metres, between all lines of a piece and the sides of its cell.

    Lines are taken by their places ``p`` and ``q`` at the ends of the piece, with ``t`` running from 0 to 1 between
    them. Where two lines cross, the piece is cut; in each part the width changes linearly with the height, and the
    integral of width times the cosine of the latitude has a closed form. Nothing is sampled.
    """
    ends = "transform({lines}, l -> named_struct('p', l.x + l.s * (y0 - l.y), 'q', l.x + l.s * (y1 - l.y)))"
    side = "array(named_struct('p', {x}, 'q', {x}))"
    lines = lambda of, cell: f"concat({ends.format(lines=of)}, {side.format(x=f'{cell} * {size!r}D')}) AS {of}"
    places = "array_{f}(transform({lines}, l -> l.p + (l.q - l.p) * t))"
    crossing = "(a.p - b.p) / ((a.p - b.p) - (a.q - b.q))"
    crossings = (
        "flatten(transform(both, (a, i) -> transform(filter(slice(both, i + 2, size(both)), "
        f"b -> (a.p - b.p) * (a.q - b.q) < 0), b -> {crossing})))"
    )
    high, mid = "radians((ts[k + 1] - ts[k]) * (y1 - y0))", "radians(y0 + (ts[k] + ts[k + 1]) / 2 * (y1 - y0))"
    strip = (
        f"radians(w[k] + w[k + 1]) * cos({mid}) * sin({high} / 2) - "
        f"radians(w[k + 1] - w[k]) / {high} * sin({mid}) * (2 * sin({high} / 2) - {high} * cos({high} / 2))"
    )
    return (
        lines("west", "cell_i"),
        lines("east", "(cell_i + 1)"),
        "concat(west, east) AS both",
        f"array_sort(array_distinct(concat(array(0D, 1D), {crossings}))) AS ts",
        f"transform(ts, t -> greatest({places.format(f='min', lines='east')} - {places.format(f='max', lines='west')}, 0D)) AS w",
        f"{G.EARTH_RADIUS_M**2!r}D * aggregate(sequence(0, size(ts) - 2), 0D, (s, k) -> s + {strip}) AS area",
    )


def overlap_area(layers: list[tuple[DataFrame, list[str]]], size: float) -> DataFrame:
    """Common area of every combination of covered polygons, one from each layer, that overlap.

    Pieces meet in their cell, where their heights overlap; only neighbours are compared.
    """
    joined, keys = layers[0][0], list(layers[0][1])
    at = ["cell_i", "cell_j"]
    for pieces, more in layers[1:]:
        other = pieces.withColumnsRenamed({c: f"_{c}" for c in (*at, "y0", "y1", "west", "east")})
        meet = F.expr("cell_i = _cell_i AND cell_j = _cell_j AND y0 < _y1 AND _y0 < y1")
        both = ["greatest(y0, _y0) AS y0", "least(y1, _y1) AS y1", "concat(west, _west) AS west", "concat(east, _east) AS east"]
        joined = joined.join(other, meet).selectExpr(*keys, *more, *at, *both)
        keys += more
    west, east, *steps, area = _piece_area(size)
    parts = joined.selectExpr(*keys, "y0", "y1", west, east)
    for step in steps:
        parts = parts.selectExpr("*", step)
    summed = parts.selectExpr(*keys, area).groupBy(*keys).agg(F.sum("area").alias("intersection_area"))
    return summed.filter(F.col("intersection_area") > _TOUCHING_M2)


def _sized(boundaries: DataFrame, name: str) -> DataFrame:
    """Adds each polygon's own area, which then travels with its spans as part of the key."""
    return boundaries.selectExpr("*", f"{G.area_m2('rings')} AS {name}")


def _pct(whole: str) -> Column:
    return half_up(F.col("intersection_area") / F.col(whole) * 100, 2)


def pairwise_crosswalk(
    left: DataFrame,
    right: DataFrame,
    left_keys: list[str],
    right_keys: list[str],
    size: float,
    left_pct: str,
    right_pct: str,
    primary: str,
    primary_of: str = "left",
) -> DataFrame:
    """Overlap weights between two layers.

    ``primary`` is set when the overlap is more than half of the polygon on the
    ``primary_of`` side; the published tables do not all use the same side.
    """
    a, b = [*left_keys, "_left"], [*right_keys, "_right"]
    both = overlap_area(
        [(cover(_sized(left, "_left"), a, size), a), (cover(_sized(right, "_right"), b, size), b)], size
    )
    return both.select(
        *left_keys,
        *right_keys,
        "intersection_area",
        _pct("_left").alias(left_pct),
        _pct("_right").alias(right_pct),
        (F.col("intersection_area") / F.col(f"_{primary_of}") > 0.5).alias(primary),
    )


def community_zip_crosswalk(areas: DataFrame, zips: DataFrame, size: float) -> DataFrame:
    return pairwise_crosswalk(
        _areas(areas), _zips(zips), _AREA, _ZIP, size, "pct_of_community_area", "pct_of_zip", "is_primary_zip"
    )


def community_neighborhood_crosswalk(areas: DataFrame, hoods: DataFrame, size: float) -> DataFrame:
    return pairwise_crosswalk(
        _areas(areas),
        _hoods(hoods),
        _AREA,
        _HOOD,
        size,
        "pct_of_community_area",
        "pct_of_neighborhood",
        "is_primary_community_area",
        primary_of="right",
    )


def zip_neighborhood_crosswalk(zips: DataFrame, hoods: DataFrame, size: float) -> DataFrame:
    return pairwise_crosswalk(
        _zips(zips), _hoods(hoods), _ZIP, _HOOD, size, "pct_of_zip", "pct_of_neighborhood", "is_primary_neighborhood"
    )


_AREA = ["community_area_number", "community_area_name"]
_ZIP = ["zip_code"]
_HOOD = ["neighborhood_name"]


def _areas(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("area_numbe").cast("long").alias(_AREA[0]), F.col("community").alias(_AREA[1]), "rings"
    )


def _zips(df: DataFrame) -> DataFrame:
    return df.select(F.col("zip").cast("string").alias("zip_code"), "rings")


def _hoods(df: DataFrame) -> DataFrame:
    return df.select(F.col("pri_neigh").alias("neighborhood_name"), "rings")


def three_way_crosswalk(
    areas: DataFrame, zips: DataFrame, hoods: DataFrame, size: float, sliver_m2: float = 1000.0
) -> DataFrame:
    """Overlap of all three layers at once, without slivers of ``sliver_m2`` or less."""
    parts = [(_areas(areas), _AREA, "_area"), (_zips(zips), _ZIP, "_zip"), (_hoods(hoods), _HOOD, "_hood")]
    cut = [(cover(_sized(df, own), [*keys, own], size), [*keys, own]) for df, keys, own in parts]
    out = overlap_area(cut, size).filter(F.col("intersection_area") > sliver_m2)
    return out.select(
        *_AREA,
        *_ZIP,
        *_HOOD,
        "intersection_area",
        _pct("_area").alias("pct_of_community_area"),
        _pct("_zip").alias("pct_of_zip"),
        _pct("_hood").alias("pct_of_neighborhood"),
    )


def crosswalk_summary(community_zip: DataFrame) -> DataFrame:
    """Relationship counts, and how many units on either side have more than one partner."""
    per_area = community_zip.groupBy("community_area_number").agg(
        F.count_distinct("zip_code").alias("partners"), F.count(F.lit(1)).alias("rows")
    )
    per_zip = community_zip.groupBy("zip_code").agg(
        F.count_distinct("community_area_number").alias("partners")
    )
    by_area = per_area.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_relationships"),
        F.count(F.lit(1)).alias("unique_community_areas"),
        F.count_if(F.col("partners") > 1).alias("community_areas_with_multiple_zips"),
    )
    by_zip = per_zip.agg(
        F.count(F.lit(1)).alias("unique_zips"),
        F.count_if(F.col("partners") > 1).alias("zips_spanning_multiple_areas"),
    )
    # Both sides are global aggregates: exactly one row each.
    return by_area.crossJoin(F.broadcast(by_zip))


# ---------------------------------------------------------------- attributes


def centroids(boundaries: DataFrame) -> DataFrame:
    """Adds ``longitude`` and ``latitude`` of each polygon's centroid."""
    return (
        boundaries.selectExpr("*", f"{G.edges('rings')} AS edges")
        .selectExpr("*", f"{G.centroid_x('edges')} AS longitude", f"{G.centroid_y('edges')} AS latitude")
        .drop("edges")
    )


def boundary_attributes(boundaries: DataFrame, key: str = "zip", name: str = "zip_code") -> DataFrame:
    """Key renamed, rough area (111 km per degree) and centroid."""
    km_per_degree = 111
    return boundaries.selectExpr(
        f"CAST({key} AS STRING) AS {name}", "rings", f"{G.edges('rings')} AS edges"
    ).selectExpr(
        name,
        "rings",
        f"abs({G.signed_area('edges')}) * {km_per_degree} * {km_per_degree} AS area_sq_km",
        f"{G.centroid_y('edges')} AS centroid_lat",
        f"{G.centroid_x('edges')} AS centroid_lon",
    )


def straight_line_m(df: DataFrame, frm: str, to: str, name: str) -> DataFrame:
    ends = [f"{e}_centroid_{axis}" for e in (frm, to) for axis in ("longitude", "latitude")]
    return df.selectExpr("*", f"{G.haversine_m(*ends)} AS {name}")
