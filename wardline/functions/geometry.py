"""Planar ring arithmetic and great-circle distance as built-in SQL expressions.

A polygon column is ``ARRAY<ARRAY<ARRAY<STRUCT<x,y>>>>``: polygons, rings, points.
Inside/outside is the even-odd rule over all ring edges, so holes and
multi-polygons need no special case. Edges are half open: a point on a lower or
left border is inside, one on an upper or right border is not.

The functions take and return expression text, which may be nested.
"""

from __future__ import annotations

# Mean sphere radius in metres.
EARTH_RADIUS_M = 6371009.0


def point(lon: str, lat: str) -> str:
    return f"named_struct('x', CAST({lon} AS DOUBLE), 'y', CAST({lat} AS DOUBLE))"


def box_rings(x0: str, y0: str, x1: str, y1: str) -> str:
    corners = [point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1)]
    return f"array(array(array({', '.join(corners)})))"


def _ring_edges(ring: str) -> str:
    after = f"{ring}[(i + 1) % size({ring})]"
    return f"transform({ring}, (p, i) -> named_struct('x1', p.x, 'y1', p.y, 'x2', {after}.x, 'y2', {after}.y))"


def edges(rings: str) -> str:
    """All edges of all rings. A closing point that repeats the first adds a zero-length edge."""
    return f"flatten(transform(flatten({rings}), ring -> {_ring_edges('ring')}))"


def signed_area(edge_list: str) -> str:
    return f"aggregate({edge_list}, 0D, (s, e) -> s + (e.x1 * e.y2 - e.x2 * e.y1) / 2)"


def _swept(edge_list: str) -> str:
    """Sphere area swept by a closed ring, without sign, on the unit sphere.

    Integrates longitude over the sine of latitude along each edge, in closed form;
    edges are straight in longitude and latitude. A level edge adds nothing.
    """
    return (
        f"abs(aggregate({edge_list}, 0D, (s, e) -> s + CASE WHEN e.y1 = e.y2 THEN 0D ELSE "
        "radians(e.x2) * sin(radians(e.y2)) - radians(e.x1) * sin(radians(e.y1)) + "
        "(e.x2 - e.x1) / (e.y2 - e.y1) * (cos(radians(e.y2)) - cos(radians(e.y1))) END))"
    )


def area_m2(rings: str) -> str:
    """Area in square metres: outlines less holes, whichever way they are wound."""
    sign = "CASE WHEN k = 0 THEN 1D ELSE -1D END"
    parts = f"flatten(transform({rings}, poly -> transform(poly, (ring, k) -> {sign} * {_swept(_ring_edges('ring'))})))"
    return f"(aggregate({parts}, 0D, (t, a) -> t + a) * {EARTH_RADIUS_M**2!r}D)"


def _moment(edge_list: str, axis: str) -> str:
    return (
        f"aggregate({edge_list}, 0D, (s, e) -> s + (e.{axis}1 + e.{axis}2) * (e.x1 * e.y2 - e.x2 * e.y1) / 6)"
    )


def centroid_x(edge_list: str) -> str:
    return f"try_divide({_moment(edge_list, 'x')}, {signed_area(edge_list)})"


def centroid_y(edge_list: str) -> str:
    return f"try_divide({_moment(edge_list, 'y')}, {signed_area(edge_list)})"


def haversine_m(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    half = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"{2 * EARTH_RADIUS_M!r}D * asin(sqrt(least({half}, 1D)))"
