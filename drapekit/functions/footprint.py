"""Footprints (P5, J1): GeoJSON polygons as edges, and their exact overlap with search boxes.

A footprint is the array of its edges ``struct(x0, y0, x1, y1)`` in degrees: all rings of a Polygon
(holes included) or a MultiPolygon.  A ring that crosses the antimeridian is unwrapped, so its
longitudes may pass 180; boxes are then tried one turn to either side as well.  Everything is
column functions, so tests run inside joins and scans.

Overlap of closed sets: touching counts.  A box meets a footprint if some edge meets the box, or if a
corner of the box is inside (an odd number of edges lies west of it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RINGS = "array<array<array<double>>>"
EDGE = "struct<x0:double,y0:double,x1:double,y1:double>"
EMPTY = f"array<{EDGE}>"


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), then)[0]


def rings(geometry: Column | str) -> Column:
    """The rings of a GeoJSON geometry text: array of rings of [x, y] points; null for other
    geometries and for text that is none."""
    one = F.from_json(geometry, f"type string, coordinates {_RINGS}")
    many = F.from_json(geometry, f"type string, coordinates array<{_RINGS}>")
    kind = F.get_json_object(geometry, "$.type")
    return F.when(kind == "Polygon", one["coordinates"]).when(kind == "MultiPolygon", F.flatten(many["coordinates"]))


def _ring_edges(ring: Column) -> Column:
    """Edges of a ring; the closing one is added, which in a closed ring is a point.  Longitudes of a
    ring over half a turn wide go on past 180."""

    def edges(wide: Column) -> Column:
        def lon(p: Column) -> Column:
            return F.when(wide & (p[0] < 0), p[0] + 360.0).otherwise(p[0])

        n = F.size(ring)

        def edge(i: Column) -> Column:
            a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
            return F.struct(lon(a).alias("x0"), a[1].alias("y0"), lon(b).alias("x1"), b[1].alias("y1"))

        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), edge)).otherwise(F.array().cast(EMPTY))

    lons = F.transform(ring, lambda p: p[0])
    return let(F.coalesce(F.array_max(lons) - F.array_min(lons) > 180.0, F.lit(False)), edges)


def footprint(geometry: Column | str) -> Column:
    """The edges of a GeoJSON geometry text, or null."""
    return F.flatten(F.transform(rings(geometry), _ring_edges))


def _extent(edges: Column) -> Column:
    xs, ys = F.transform(edges, lambda e: e["x0"]), F.transform(edges, lambda e: e["y0"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def box_of(edges: Column) -> Column:
    """``struct(min_lon, min_lat, max_lon, max_lat)`` around a footprint.  One that crosses the
    antimeridian has ``min_lon > max_lon``, as search boxes do."""

    def box(x: Column) -> Column:
        around = x["x1"] - x["x0"] >= 360.0
        west = F.when(around, -180.0).otherwise(x["x0"])
        east = F.when(around, 180.0).when(x["x1"] > 180.0, x["x1"] - 360.0).otherwise(x["x1"])
        return F.struct(west.alias("min_lon"), x["y0"].alias("min_lat"), east.alias("max_lon"), x["y1"].alias("max_lat"))

    return let(_extent(edges), box)


def _edge_meets(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Separating axes of a segment and a box: the box's sides and the segment's line."""

    def side(x: Column, y: Column) -> Column:
        return (e["x1"] - e["x0"]) * (y - e["y0"]) - (e["y1"] - e["y0"]) * (x - e["x0"])

    corners = [side(x, y) for x in (x0, x1) for y in (y0, y1)]
    return (
        (F.least(e["x0"], e["x1"]) <= x1)
        & (F.greatest(e["x0"], e["x1"]) >= x0)
        & (F.least(e["y0"], e["y1"]) <= y1)
        & (F.greatest(e["y0"], e["y1"]) >= y0)
        & (F.least(*corners) <= 0)
        & (F.greatest(*corners) >= 0)
    )


def _west_of(e: Column, x: Column, y: Column) -> Column:
    """Whether the edge crosses the parallel of a point west of it."""
    rise = (x - e["x0"]) * (e["y1"] - e["y0"])
    run = (e["x1"] - e["x0"]) * (y - e["y0"])
    return ((e["y0"] > y) != (e["y1"] > y)) & F.when(e["y1"] > e["y0"], rise > run).otherwise(rise < run)


def meets_box(edges: Column, min_lon: Column, min_lat: Column, max_lon: Column, max_lat: Column) -> Column:
    """Whether a footprint meets a box that does not cross the antimeridian; false for null."""

    def one_turn(turn: Column) -> Column:
        x0, x1 = min_lon + turn, max_lon + turn
        inside = F.size(F.filter(edges, lambda e: _west_of(e, x0, min_lat))) % 2 == 1
        return F.exists(edges, lambda e: _edge_meets(e, x0, min_lat, x1, max_lat)) | inside

    turns = F.array(*[F.lit(t) for t in (0.0, 360.0, -360.0)])
    return F.coalesce(F.exists(turns, one_turn), F.lit(False))


def with_footprint(items: DataFrame, geometry: str = "geometry", name: str = "footprint") -> DataFrame:
    """``items`` with the footprint of a GeoJSON column, and the four box columns set around it;
    rows without a readable polygon go."""
    # one list per row, made where it is unnested: a filter on a projected column is pushed below it
    # and would parse once more for every test and turn
    one = F.filter(F.array(footprint(F.col(geometry))), lambda edges: F.size(edges) > 0)
    found = items.select(*[F.col(f"`{c}`") for c in items.columns if c != name], F.explode(one).alias(name))
    found = found.withColumn("_box", box_of(F.col(name)))
    return found.withColumns({c: F.col(f"_box.{c}") for c in ("min_lon", "min_lat", "max_lon", "max_lat")}).drop("_box")


def footprint_predicate(items: DataFrame, bbox: tuple[float, float, float, float], name: str = "footprint") -> DataFrame:
    """P5's geometry: rows whose footprint meets the box.  A box with ``min_lon > max_lon`` crosses
    the antimeridian."""
    x0, y0, x1, y1 = bbox
    parts = [(x0, x1)] if x0 <= x1 else [(x0, 180.0), (-180.0, x1)]
    hit = F.lit(False)
    for west, east in parts:
        hit = hit | meets_box(F.col(name), *[F.lit(float(v)) for v in (west, y0, east, y1)])
    return items.where(hit)
