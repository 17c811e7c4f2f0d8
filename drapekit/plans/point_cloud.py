"""Q2 / Q3: image + elevation grid -> sampled, coloured point cloud.

Chain: raster rows -> interleave bands -> flip + pid ; grid cells -> linspace axes ->
nearest labels -> elevation per pid ; then the sample.

Sampling is pushed in front of the drape: the draws need only N = width * height, so the
drawn pids are joined to the pixels and to the elevations directly.  The three inputs are
joined on the same key ``(scene_id, pid)``, so each is shuffled once and the join output is
only the sample.  The result equals drape-then-sample because draws address positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drapekit.operators.drape import drape, present, resample_grid
from drapekit.operators.sampling import draws_with_replacement
from drapekit.operators.small import settled
from drapekit.sources.dem import TiledDem
from drapekit.sources.raster import image_points, interleave_bands


def draped_cloud(
    meta: DataFrame,
    rows: DataFrame,
    cells: DataFrame | TiledDem,
    fraction: float | None = 0.2,
    seed: int = 42,
    axes=None,
    missing: str = "raise",
    centers: bool = False,
) -> DataFrame:
    """``(scene_id, k, pid, x, y, z, red, green, blue)``; ``k`` is the draw number (``pid``
    again when ``fraction`` is None, i.e. the whole cloud).  ``centers=True`` samples the
    grid at pixel centres instead of spreading over the outer edges.

    A position without a pixel or without an elevation fails the job; ``missing="null"``
    keeps it with NULLs."""
    small = settled(meta.select("scene_id", "lft", "btm", "rgt", "tp", "width", "height"), "meta")
    img = image_points(interleave_bands(rows, missing), meta, small_meta=small)
    elev = resample_grid(meta, cells, axes=axes, small_meta=small, centers=centers)
    names = ["scene_id", "k", "pid", "x", "y", "z", "red", "green", "blue"]
    if fraction is None:
        return drape(img, elev, missing).withColumn("k", F.col("pid")).select(*names)
    sizes = small.select("scene_id", (F.col("width").cast("long") * F.col("height")).alias("n_total"))
    cloud = draws_with_replacement(sizes, fraction, seed, group=("scene_id",))
    for side, c, what in ((img, ("red", "green", "blue"), "pixel"), (elev, ("x", "y", "z"), "elevation")):
        own = f"_{what}"
        cloud = cloud.join(side.select("scene_id", "pid", F.struct(*c).alias(own)), ["scene_id", "pid"], "left")
        if missing == "raise":
            cloud = cloud.withColumn(own, present(own, what))
    return cloud.select("scene_id", "k", "pid", "_elevation.*", "_pixel.*").select(*names)
