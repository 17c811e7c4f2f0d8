"""Elevation grids stored as cells.

``dem_cells(scene_id, x DOUBLE, y DOUBLE, dem DOUBLE)`` in Parquet, ideally sorted or
partitioned by tile so that a range filter on x/y skips row groups.  The grid's axes are the
distinct x and y labels per scene; when the grid ships its coordinate vectors separately
(``dem_axes``) they are read instead of scanning the cells.

``write_tiles`` lays a grid out in square tiles.  A tile's name is its place on a Z-order curve, so
neighbouring tiles stand near each other in the sort that writes them, and the leading bits of the name
are a larger tile, a span.  There is one folder for each scene and span, sorted by tile; spans hold about
``target`` cells, so small tiles do not make a file each.  The tiles' extents and the grid's axes are
written beside the cells.  A job that needs a few scenes joins the extents with the ranges it needs, and
only the folders of those tiles are opened.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor, log2, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_dem(
    spark: SparkSession,
    path: str,
    bounds: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Open the cells lazily; with ``bounds=(x0, y0, x1, y1)`` a range filter goes to the scan
    (row-group pruning).  The range must include the labels nearest to the image edges."""
    cells = spark.read.parquet(path)
    if bounds is not None:
        x0, y0, x1, y1 = bounds
        cells = cells.filter(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))
    return clean_cells(cells)


def clean_cells(cells: DataFrame) -> DataFrame:
    """NaN elevations become NULL so aggregates skip them instead of propagating NaN."""
    return cells.withColumn("dem", F.when(F.isnan("dem"), F.lit(None)).otherwise(F.col("dem")))


def dem_axes(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct x and y labels per scene, ``(scene_id, x)`` and ``(scene_id, y)``.

    A partial (map-side) distinct, then one shuffle of the per-task distinct labels; the output
    is the grid's axis length per scene."""
    return (
        cells.select("scene_id", "x").distinct(),
        cells.select("scene_id", "y").distinct(),
    )


#: cells that a tile holds on average, where no side is given
TILE_CELLS = 1 << 20
# fixed values: shifts and masks that spread the low 31 bits of a number to every other bit
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))
_MIDDLE = 1 << 30  # tiles west and south of zero come first


def z_order(tx: Column, ty: Column) -> Column:
    """The place of a tile on the Z-order curve: the bits of both numbers in turn."""
    steps = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(m).cast("long").alias("m")) for n, m in SPREAD])

    def spread(t: Column) -> Column:
        return F.aggregate(steps, (t + _MIDDLE).cast("long"), lambda acc, s: acc.bitwiseOR(F.call_function("shiftleft", acc, s["n"])).bitwiseAND(s["m"]))

    return spread(tx).bitwiseOR(F.shiftleft(spread(ty), 1))


def tile_key(x: Column, y: Column, side: float) -> Column:
    return z_order(F.floor(x / side), F.floor(y / side))


@dataclass(frozen=True)
class TiledDem:
    """``cells`` (scene_id, span, tile, x, y, dem), ``tiles`` (scene_id, span, tile, x0, y0, x1, y1, n),
    and the labels ``x`` and ``y`` per scene."""

    cells: DataFrame
    tiles: DataFrame
    x: DataFrame
    y: DataFrame


def tile_side(cells: DataFrame, target: int = TILE_CELLS) -> float:
    """A side such that a tile of the average density holds ``target`` cells."""
    per = cells.groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"), *[(F.max(c) - F.min(c)).alias(f"w{c}") for c in "xy"])
    n, area = per.agg(F.sum("n"), F.sum(F.col("wx") * F.col("wy"))).first()
    return sqrt(target * area / n) if n and area else 1.0


def write_tiles(cells: DataFrame, path: str, side: float | None = None, target: int = TILE_CELLS) -> TiledDem:
    """Write (scene_id, x, y, dem) in tiles under ``path`` and read them back.  Cells are dealt by
    range of (scene, tile, y, x), so a tile of any size is written by as many tasks as it needs."""
    whole = tile_side(cells, target)
    side = whole if side is None else side
    bits = 2 * min(30, max(0, floor(log2(whole / side))))
    own = cells.select("scene_id", "x", "y", "dem").withColumn("tile", tile_key(F.col("x"), F.col("y"), side))
    own = own.withColumn("span", F.shiftright("tile", bits))
    sorted_ = own.repartitionByRange("scene_id", "tile", "y", "x").sortWithinPartitions("scene_id", "span", "tile", "y", "x")
    sorted_.write.mode("overwrite").partitionBy("scene_id", "span").parquet(f"{path}/cells")
    written = _tiled_cells(cells.sparkSession, path, cells.schema["scene_id"].dataType)
    extent = [f(c).alias(f"{c}{k}") for c in "xy" for k, f in ((0, F.min), (1, F.max))]
    written.groupBy("scene_id", "span", "tile").agg(*extent, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/tiles")
    for name, axis in zip(("axis_x", "axis_y"), dem_axes(written)):
        axis.write.mode("overwrite").parquet(f"{path}/{name}")
    return read_tiles(cells.sparkSession, path)


def _tiled_cells(spark: SparkSession, path: str, scene_type: T.DataType) -> DataFrame:
    kinds = [*[T.StructField(c, T.DoubleType()) for c in ("x", "y", "dem")], T.StructField("tile", T.LongType())]
    # the partition columns' types are given, not guessed from folder names
    schema = T.StructType([*kinds, T.StructField("scene_id", scene_type), T.StructField("span", T.LongType())])
    return spark.read.schema(schema).parquet(f"{path}/cells")


def read_tiles(spark: SparkSession, path: str) -> TiledDem:
    tiles = spark.read.parquet(f"{path}/tiles")
    cells = _tiled_cells(spark, path, tiles.schema["scene_id"].dataType)
    return TiledDem(cells, tiles, spark.read.parquet(f"{path}/axis_x"), spark.read.parquet(f"{path}/axis_y"))


def tiles_within(tiles: DataFrame, ranges: DataFrame) -> DataFrame:
    """(scene_id, span, tile, n) of the tiles that meet a scene's ``ranges`` (scene_id, x_low, x_high, y_low,
    y_high)."""
    met = [(F.col(f"{c}0") <= F.col(f"{c}_high")) & (F.col(f"{c}1") >= F.col(f"{c}_low")) for c in "xy"]
    return tiles.join(ranges, "scene_id").where(met[0] & met[1]).select("scene_id", "span", "tile", "n")
