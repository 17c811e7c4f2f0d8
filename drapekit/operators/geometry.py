"""Cloud geometry: box crop (P20), concatenation (U1), normalisation (G1) and grid
triangulation (G3).  Normal estimation (G2) lives in ``drapekit.operators.normals``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drapekit.functions.colors import _positional, clip_color, resolve_color_columns
from drapekit.operators.aggregates import center_scale, expanded_bbox
from drapekit.operators.small import settled


def bbox_crop(df: DataFrame, box: DataFrame) -> DataFrame:
    """P20: points with ``x_min <= x <= x_max`` and ``y_min <= y <= y_max`` (bounds included;
    NaN never matches).  ``box`` is a one-row frame (A2's output) used as a scalar subquery,
    so it is evaluated once and the filter stays a plain predicate in the scan stage."""
    if box is None:
        raise ValueError("bounding box is not set")
    lim = box.select(F.struct("x_min", "x_max", "y_min", "y_max")).scalar()
    x, y = F.col("x"), F.col("y")
    return df.filter(
        (x >= lim.getField("x_min")) & (x <= lim.getField("x_max"))
        & (y >= lim.getField("y_min")) & (y <= lim.getField("y_max"))
    )


def bbox_crop_literal(df: DataFrame, x_min: float, x_max: float, y_min: float, y_max: float) -> DataFrame:
    """P20 with a box known on the driver: the predicate reaches the Parquet scan."""
    return df.filter(F.col("x").between(x_min, x_max) & F.col("y").between(y_min, y_max))


def concat_clouds(frames: list[DataFrame]) -> DataFrame:
    """Stack clouds, keeping duplicates; columns missing in a frame are NULL; column
    order is the order first seen."""
    if not frames:
        raise ValueError("no frames to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def crop_and_merge(df: DataFrame, target: DataFrame, others: list[DataFrame] | None = None, margin: float = 2.0) -> DataFrame:
    """Q4: crop ``df`` to the target's box widened by ``margin`` (A2 -> P20), then stack the
    result with ``others`` (U1)."""
    cropped = bbox_crop(df, expanded_bbox(target, margin))
    return concat_clouds([cropped, *(others or [])])


def normalize_cloud(df: DataFrame, group: tuple[str, ...] = ("scene_id",)) -> DataFrame:
    """G1: centre each cloud on its centroid and divide by one uniform scale (largest absolute
    deviation over x, y, z), so coordinates land in [-1, 1]; colours become 0..1 (P14).

    The per-cloud statistics are one aggregate row per group, settled first, or a scalar
    subquery without groups.  A zero
    scale (one point, or all equal) gives 0.0 coordinates instead of a division by zero."""
    g = [c for c in group if c in df.columns]
    stats = center_scale(df, g)
    pdf, colors, _ = resolve_color_columns(df)
    _, pos = _positional(df)
    if g:
        keyed = settled(stats.select(*[F.col(c).alias(f"_g_{c}") for c in g], "cx", "cy", "cz", "scale"), "center")
        j = pdf.join(keyed, [F.col(pos[c]).eqNullSafe(F.col(f"_g_{c}")) for c in g])
        cx, cy, cz, sc = (F.col(c) for c in ("cx", "cy", "cz", "scale"))
    else:
        j = pdf
        st = stats.select(F.struct("cx", "cy", "cz", "scale")).scalar()
        cx, cy, cz, sc = (st.getField(c) for c in ("cx", "cy", "cz", "scale"))
    safe = F.when(sc != 0, sc)
    out = [F.col(pos[c]).alias(c) for c in g]
    if "pid" in df.columns:
        out.append(F.col(pos["pid"]).alias("pid"))
    for name, c in (("x", cx), ("y", cy), ("z", cz)):
        out.append(F.coalesce((F.col(pos[name]).cast("double") - c) / safe, F.lit(0.0)).alias(name))
    if colors is not None:
        out += [clip_color(c).alias(chan) for chan, c in zip(("red", "green", "blue"), colors)]
    return j.select(*out)


def triangulate_grid(cloud: DataFrame, meta: DataFrame, block: int = 1) -> DataFrame:
    """G3 (re-aimed surface): two triangles per grid square, ``(p, p+1, p+W)`` and
    ``(p+1, p+W+1, p+W)`` for every grid square, kept when all three corners exist.

    With ``block`` > 1 the grid is that many pixels coarser: of the points in a block of
    ``block`` x ``block`` pixels the one with the smallest ``pid`` is the vertex.  A sample of
    a share f of the points leaves few full squares at pixel size; with a block of about
    2 / sqrt(f) nearly every block holds a point, so the surface stays whole.  Corners are the
    vertices' pids.

    Each present vertex announces the triangles it is a corner of (at most 6), with its pid; a
    triangle is kept when all three corners are set.  One shuffle keyed by triangle, partially
    aggregated per task, groups of at most 3 distinct corners: no skew, no pair generation."""
    block = int(block)
    w = F.col("width").cast("long")
    m = meta.select("scene_id", w.alias("w0"), F.ceil(w / block).alias("w"), F.ceil(F.col("height").cast("long") / block).alias("h"))
    v = cloud.select("scene_id", "pid").join(m, "scene_id")
    v = v.groupBy("scene_id", "w", "h", F.floor(F.floor(F.col("pid") / F.col("w0")) / block).alias("r"), F.floor(F.col("pid") % F.col("w0") / block).alias("c")).agg(F.min("pid").alias("pid"))
    # anchor = the square's corner with the lowest pid (row ar, col ac).  Triangle kind 0 is
    # (a, a+1, a+W), kind 1 is (a+1, a+W+1, a+W).  A vertex present twice (a sample with
    # repeats) was one block already.
    role = lambda dr, dc, kind, corner: F.struct(
        F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), F.lit(kind).alias("kind"), F.lit(corner).alias("corner")
    )
    roles = F.array(
        role(0, 0, 0, "a"), role(0, 1, 0, "b"), role(1, 0, 0, "c"),
        role(0, 1, 1, "a"), role(1, 1, 1, "b"), role(1, 0, 1, "c"),
    )
    t = v.select("scene_id", "w", "h", "r", "c", "pid", F.explode(roles).alias("role"))
    t = t.select("scene_id", "w", "h", "pid", (F.col("r") - F.col("role.dr")).alias("ar"), (F.col("c") - F.col("role.dc")).alias("ac"), "role.kind", "role.corner")
    t = t.filter((F.col("ar") >= 0) & (F.col("ac") >= 0) & (F.col("ar") < F.col("h") - 1) & (F.col("ac") < F.col("w") - 1))
    corners = [F.max(F.when(F.col("corner") == x, F.col("pid"))).alias(x) for x in "abc"]
    tri = t.groupBy("scene_id", "ar", "ac", "kind").agg(*corners)
    return tri.where("a is not null and b is not null and c is not null").select("scene_id", "a", "b", "c")


def require_faces(faces: DataFrame) -> DataFrame:
    """Raise when the surface is empty (the reference's "surface reconstruction failed")."""
    if faces.isEmpty():
        raise RuntimeError("surface reconstruction failed: no faces")
    return faces
