"""Resample the elevation grid onto the image (J3), mesh grid (J4) and drape.

Plan shape (per scene, W x H image):

* the two target axes are ``linspace`` over the image bounds (W and H rows),
* each is snapped to the grid's labels by ``nearest_label`` (separable: W + H look-ups,
  never W x H),
* the elevation of every pixel comes from joining the grid cells to the two snapped axes
  on their labels.  Both axes are small (W + H rows per scene) and written first: their range
  goes to the scan of the cells, and where they fit the session's broadcast threshold the
  cell table is streamed once, with no shuffle.  A label used by several image columns (an image
  finer than the grid) fans out to each of them, which is the mesh grid without a
  cartesian product,
* pixels and elevations meet in one equi-join on ``(scene_id, pid)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drapekit.functions.grid import linspace, point_id
from drapekit.operators.nearest import nearest_label
from drapekit.operators.small import settled
from drapekit.sources.dem import TiledDem, clean_cells, dem_axes, tiles_within

def target_axes(meta: DataFrame, centers: bool = False) -> tuple[DataFrame, DataFrame]:
    """Requested sample positions: x over the image columns (left..right), y over the image
    rows (bottom..top, so row 0 is the south edge).  By default spread over the outer edges
    of the bounds, as the reference does; ``centers=True`` samples pixel centres instead
    (half a pixel in from each edge)."""
    m = meta
    if centers:
        hx = (F.col("rgt") - F.col("lft")) / (2.0 * F.col("width"))
        hy = (F.col("tp") - F.col("btm")) / (2.0 * F.col("height"))
        m = meta.select(
            "scene_id",
            (F.col("lft") + hx).alias("lft"),
            (F.col("rgt") - hx).alias("rgt"),
            (F.col("btm") + hy).alias("btm"),
            (F.col("tp") - hy).alias("tp"),
            "width",
            "height",
        )
    xt = linspace(m, "lft", "rgt", "width", "col_idx", "tx")
    yt = linspace(m, "btm", "tp", "height", "row_idx", "ty")
    return xt, yt


def snapped_axes(
    meta: DataFrame, cells: DataFrame, axes: tuple[DataFrame, DataFrame] | None = None, centers: bool = False
):
    """``(scene_id, col_idx, x)`` and ``(scene_id, row_idx, y)``: grid labels nearest to the
    target positions.  The snapped labels are the grid's own values, so joining them back to
    the cells is an exact equality."""
    xl, yl = axes if axes is not None else dem_axes(cells)
    xt, yt = target_axes(meta, centers)
    xs = nearest_label(xt, xl, value="tx", label="x")
    ys = nearest_label(yt, yl, value="ty", label="y")
    return xs.select("scene_id", "col_idx", "x"), ys.select("scene_id", "row_idx", "y")


def resample_grid(
    meta: DataFrame,
    cells: DataFrame | TiledDem,
    axes: tuple[DataFrame, DataFrame] | None = None,
    small_meta: DataFrame | None = None,
    centers: bool = False,
) -> DataFrame:
    """Elevation per image position: ``(scene_id, pid, row_idx, col_idx, x, y, z)``.

    The snapped axes (W + H rows per scene) are settled first, so the planner knows their
    size and their range: the range is pushed into the scan of the cells, and the axes are
    broadcast where they are small enough for the session's threshold.

    One range over all scenes says little when scenes lie far apart.  Of a tiled grid only the tiles
    that meet a scene's own ranges are read: their names and spans are joined to the cells, whose folders
    are the spans, so Spark prunes the scan while the job runs."""
    tiled = cells if isinstance(cells, TiledDem) else None
    if tiled is not None:
        cells, axes = tiled.cells, (tiled.x, tiled.y) if axes is None else axes
    small_meta = settled(meta.select("scene_id", "lft", "btm", "rgt", "tp", "width", "height"), "meta") if small_meta is None else small_meta
    xs, ys = snapped_axes(small_meta, clean_cells(cells), axes, centers)
    # with the width: else the planner takes the axis for larger than the cells, and streams it in one task
    xs, ys = settled(xs.join(small_meta.select("scene_id", "width"), "scene_id"), "axis"), settled(ys, "axis")
    for a, c in ((xs, "x"), (ys, "y")):
        low, high = a.agg(F.min(c), F.max(c)).first()
        if low is not None:
            cells = cells.where(F.col(c).between(low, high))
    if tiled is not None:
        own = [a.groupBy("scene_id").agg(F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high")) for a, c in ((xs, "x"), (ys, "y"))]
        needed = settled(tiles_within(tiled.tiles, own[0].join(own[1], "scene_id")), "tiles")
        place = [c for c in ("scene_id", "span", "tile") if c in cells.columns]
        cells = cells.join(needed.where("n > 0").select(*place), place).drop("span", "tile")
    elev = clean_cells(cells).join(xs, ["scene_id", "x"]).join(ys, ["scene_id", "y"])
    return elev.select(
        "scene_id",
        point_id(F.col("row_idx"), F.col("col_idx"), F.col("width")),
        "row_idx",
        "col_idx",
        "x",
        "y",
        F.col("dem").alias("z"),
    )


def mesh_grid(xs: DataFrame, ys: DataFrame, meta: DataFrame) -> DataFrame:
    """All (x, y) positions of the two axes per scene (J4), keyed by ``pid``.

    Each image row, with its scene's size, meets its scene's columns, which are settled first and few:
    the planner broadcasts them, so no pixel is shuffled.  Rows are dealt to all tasks beforehand; their
    bytes do not tell how many pixels they become, so a fixed count keeps them from being merged."""
    xs, ys = settled(xs, "axis"), settled(ys, "axis")
    size = settled(meta.select("scene_id", F.col("width").alias("_w"), F.col("height").alias("_h")), "meta")
    tasks = int(ys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = ys.join(size, "scene_id").where(F.col("row_idx").between(0, F.col("_h") - 1)).repartition(tasks, "scene_id", "row_idx")
    both = rows.join(xs, "scene_id").where(F.col("col_idx").between(0, F.col("_w") - 1))
    return both.select("scene_id", point_id(F.col("row_idx"), F.col("col_idx"), F.col("_w")), "row_idx", "col_idx", "x", "y")


def drape(image_pts: DataFrame, elevation: DataFrame, missing: str = "raise") -> DataFrame:
    """Zip colours and elevations by position (J5): equi-join on ``(scene_id, pid)``.

    A position that one side lacks fails the job (the reference fails on unequal lengths).
    With ``missing="null"`` it is kept, with NULL coordinates or colours; nothing is dropped.
    Both inputs are image-sized; Spark shuffles each once on the key (or not at all when both
    are stored bucketed by it)."""
    if missing not in ("raise", "null"):
        raise ValueError("missing is 'raise' or 'null'")
    i = image_pts.select("scene_id", "pid", F.struct("red", "green", "blue").alias("_i"))
    e = elevation.select("scene_id", "pid", F.struct("x", "y", "z").alias("_e"))
    both = i.join(e, ["scene_id", "pid"], "full_outer")
    if missing == "raise":
        both = both.select("scene_id", "pid", *[present(c, what) for c, what in (("_i", "pixel"), ("_e", "elevation"))])
    return both.select("scene_id", "pid", "_e.x", "_e.y", "_e.z", "_i.red", "_i.green", "_i.blue")


def present(struct: str, what: str) -> Column:
    """The struct column, or a job failure that names the position where it is absent."""
    where = F.concat(F.lit(f"drape: no {what} at scene "), F.coalesce(F.col("scene_id").cast("string"), F.lit("null")), F.lit(", pid "), F.coalesce(F.col("pid").cast("string"), F.lit("null")))
    return F.coalesce(F.col(struct), F.raise_error(where)).alias(struct)
