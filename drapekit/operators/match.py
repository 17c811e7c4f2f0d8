"""Request x item footprint matching (J1): for many search boxes at once, the newest item
whose footprint intersects each box.

* Only the newest item of a footprint can win, so items are first reduced to (footprint, newest),
  map-side before the shuffle, and requests to their distinct boxes.  Catalogues repeat their
  tiles, and requests their places, so this removes most rows and keeps a crowded place from
  holding more than its distinct boxes.
* A box with ``min_lon > max_lon`` crosses the antimeridian; it is split into two boxes.
* Cells have levels: a side of 360 degrees, 180, and so on.  A box lives on the finest level whose
  cells are at least as large as it is, so it covers at most four cells there and on every coarser
  level.  Of two boxes the larger one stays on its level, and the smaller one visits that level;
  only levels that the other side lives on are visited.  So a box is a bounded number of rows,
  whatever the mix of sizes.
* The exact overlap test runs in the join.  A pair sharing several cells is kept only in the cell
  holding the lower-left corner of the overlap, so no distinct is needed.  With ``footprint``, the
  boxes only bring pairs together, and the polygons decide.
* Per box only (recency, id) is aggregated, map-side; the winners' rows are fetched by id at
  the end.  Hot cells are split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drapekit.functions.footprint import meets_box
from drapekit.operators.catalog import recency_key
from drapekit.operators.small import settled

BOX = ("min_lon", "min_lat", "max_lon", "max_lat")
# fixed value: cell sides in degrees, level by level
SIDES = tuple(360.0 / 2**k for k in range(17))


def _cell(v: Column, side: Column) -> Column:
    return F.floor(v / side).cast("long")


def _level(prefix: str, sides: tuple[float, ...]) -> Column:
    """The finest level whose cells are at least as large as the box."""
    c = lambda n: F.col(prefix + n)
    size = F.greatest(c("max_lon") - c("min_lon"), c("max_lat") - c("min_lat"))
    return F.greatest(F.size(F.filter(F.array(*[F.lit(s) for s in sides]), lambda s: s >= size)) - 1, F.lit(0))


def split_antimeridian(df: DataFrame) -> DataFrame:
    """Boxes whose west edge lies east of their east edge become two."""
    side = lambda a, b: F.struct(a.alias("min_lon"), b.alias("max_lon"))
    west, east = F.col("min_lon"), F.col("max_lon")
    parts = F.when(west > east, F.array(side(west, F.lit(180.0)), side(F.lit(-180.0), east))).otherwise(F.array(side(west, east)))
    others = [c for c in df.columns if c not in ("min_lon", "max_lon")]
    return df.select(*others, F.explode(parts).alias("_lon")).select(*others, "_lon.*")


def _levels(df: DataFrame) -> Column:
    """The levels that boxes live on; at most one for each side."""
    found = sorted(r.level for r in df.select("level").distinct().collect())
    return F.array(*[F.lit(v) for v in found]).cast("array<int>")


def _cells(df: DataFrame, visits: Column, prefix: str, sides: tuple[float, ...]) -> DataFrame:
    """One row per cell ``(turn, on, cx, cy)`` that a box covers on each level it visits; turn is 0
    where requests are at home and 1 where items are."""
    c = lambda n: F.col(prefix + n)
    out = df.withColumn("_v", F.explode(visits)).select(*df.columns, "_v.turn", "_v.on")
    out = out.withColumn("side", F.element_at(F.array(*[F.lit(s) for s in sides]), F.col("on") + 1))
    out = out.withColumn("cx", F.explode(F.sequence(_cell(c("min_lon"), F.col("side")), _cell(c("max_lon"), F.col("side")))))
    return out.withColumn("cy", F.explode(F.sequence(_cell(c("min_lat"), F.col("side")), _cell(c("max_lat"), F.col("side")))))


def _visit(turn: int, on: Column) -> Column:
    return F.struct(F.lit(turn).alias("turn"), on.cast("int").alias("on"))


def cell_rows(requests: DataFrame, items: DataFrame, sides: tuple[float, ...] = SIDES) -> tuple[DataFrame, DataFrame]:
    """Both sides' cells, to be joined on (turn, on, cx, cy).  Requests have their box as ``q_*``.
    Each pair of overlapping boxes meets on one level: the coarser one's."""
    r, i = requests.withColumn("level", _level("q_", sides)), items.withColumn("level", _level("", sides))
    own = F.col("level")
    at_home, away = F.array(_visit(0, own)), F.array(_visit(1, own))
    to_items = F.transform(F.filter(_levels(i), lambda v: v < own), lambda v: _visit(1, v))
    to_requests = F.transform(F.filter(_levels(r), lambda v: v <= own), lambda v: _visit(0, v))
    return _cells(r, F.concat(at_home, to_items), "q_", sides).drop("level"), _cells(i, F.concat(to_requests, away), "", sides).drop("level", "side")


def match_scenes(requests: DataFrame, items: DataFrame, size: float | None = None, footprint: str | None = None) -> DataFrame:
    """``(req_id, <item columns>)``: the newest intersecting item per request; requests
    without a match are absent.  ``requests`` has ``req_id, min_lon, min_lat, max_lon,
    max_lat`` (valid boxes only); ``items`` the flat catalogue columns.  ``size`` fixes one
    cell side in degrees.  ``footprint`` names a column of edges (``functions.footprint``) that
    the items' boxes lie around."""
    asked = settled(requests.select("req_id", *BOX), "requests")
    shape = [footprint] if footprint else []
    newest = items.groupBy(*BOX, *shape).agg(F.min(recency_key()).alias("_k"))
    i = settled(split_antimeridian(newest), "footprints")
    whole = [F.col(n).alias(f"b_{n}") for n in BOX]  # the box as asked, before it is split
    r = split_antimeridian(asked.select(*BOX).distinct().select(*BOX, *whole))
    r = settled(r.select(*[f"b_{n}" for n in BOX], *[F.col(n).alias(f"q_{n}") for n in BOX]), "boxes")
    left, right = cell_rows(r, i, SIDES if size is None else (size,))
    pairs = left.join(right, ["turn", "on", "cx", "cy"])
    overlap = (
        (F.col("min_lon") <= F.col("q_max_lon"))
        & (F.col("max_lon") >= F.col("q_min_lon"))
        & (F.col("min_lat") <= F.col("q_max_lat"))
        & (F.col("max_lat") >= F.col("q_min_lat"))
    )
    home = (F.col("cx") == _cell(F.greatest("min_lon", "q_min_lon"), F.col("side"))) & (
        F.col("cy") == _cell(F.greatest("min_lat", "q_min_lat"), F.col("side"))
    )
    pairs = pairs.filter(overlap & home)
    if footprint:
        pairs = pairs.filter(meets_box(F.col(footprint), *[F.col(f"q_{n}") for n in BOX]))
    best = pairs.groupBy(*[f"b_{n}" for n in BOX]).agg(F.min("_k").alias("_k"))
    best = settled(best.select(*[F.col(f"b_{n}").alias(n) for n in BOX], F.col("_k.id").alias("_id"), F.col("_k.t").alias("_t")), "best")
    # the winners' rows; of rows that repeat id and time, one
    wanted = best.select(F.col("_id").alias("id"), "_t").distinct()
    cols = [c for c in items.columns if c != "id"]
    keyed = items.withColumn("_t", recency_key()["t"])
    rows = keyed.join(wanted, ["id", "_t"], "left_semi").groupBy("id", "_t").agg(F.first(F.struct(*cols)).alias("_it"))
    out = asked.join(best, [*BOX]).select("req_id", "_id", F.col("_t").alias("_at")).join(rows, (F.col("_id") == F.col("id")) & (F.col("_at") == F.col("_t")))
    return out.select("req_id", *[F.col("id") if c == "id" else F.col(f"_it.{c}").alias(c) for c in items.columns])
