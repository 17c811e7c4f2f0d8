"""Image rasters stored as tables (S4) and band interleaving (P10).

Storage form: ``raster_rows(scene_id, band, row_idx, samples ARRAY<INT>)`` - one row per
band of one image row, as a raster reader emits strips.  Work form:
``raster_px(scene_id, row_idx, col_idx, red, green, blue)``.

Interleaving from rows groups the three band rows of an image row together (one shuffle of
``3 x height`` row arrays per scene) and explodes the zipped arrays.  Pixels are never
shuffled one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drapekit.functions.grid import flipped_row, point_id

# fixed values: band order of a true-colour image
BANDS = ("red", "green", "blue")


def read_raster_rows(spark: SparkSession, path: str) -> DataFrame:
    """Scan stored image rows (Parquet).  Filters on ``scene_id``/``row_idx`` push down."""
    return spark.read.parquet(path)


def interleave_bands(rows: DataFrame, missing: str = "raise") -> DataFrame:
    """(bands, H, W) -> (H, W, bands): one pixel row per (scene, image row, column).

    An image row that lacks a band, or whose bands differ in length, fails the job; with
    ``missing="null"`` its pixels are emitted with NULL in the channels it lacks."""
    if missing not in ("raise", "null"):
        raise ValueError("missing is 'raise' or 'null'")
    grouped = rows.groupBy("scene_id", "row_idx").agg(
        *[F.first(F.when(F.col("band") == k, F.col("samples")), ignorenulls=True).alias(name) for k, name in enumerate(BANDS)]
    )
    zipped = F.arrays_zip(*[F.coalesce(name, F.array().cast(rows.schema["samples"].dataType)).alias(name) for name in BANDS])
    if missing == "raise":
        sizes = [F.size(name) for name in BANDS]  # null for a missing band
        whole = F.coalesce((sizes[0] == sizes[1]) & (sizes[1] == sizes[2]) & (sizes[0] >= 0), F.lit(False))
        where = F.concat(F.lit("image row without all bands in one length: scene "), F.coalesce(F.col("scene_id").cast("string"), F.lit("null")), F.lit(", row "), F.coalesce(F.col("row_idx").cast("string"), F.lit("null")))
        zipped = F.when(whole, zipped).otherwise(F.raise_error(where).cast(grouped.select(zipped.alias("z")).schema["z"].dataType))
    exploded = grouped.select("scene_id", "row_idx", F.posexplode(zipped).alias("col_idx", "px"))
    return exploded.select(
        "scene_id",
        "row_idx",
        F.col("col_idx").cast("int").alias("col_idx"),
        *[F.col(f"px.{name}").cast("int").alias(name) for name in BANDS],
    )


def interleave_bands_long(long: DataFrame) -> DataFrame:
    """Same result from one value per (scene, band, row, col): a pivot by band, with NULL in
    channels that a pixel lacks.  Shuffles every pixel; use ``interleave_bands`` when rows are
    available."""
    return (
        long.groupBy("scene_id", "row_idx", "col_idx")
        .agg(
            *[F.max(F.when(F.col("band") == k, F.col("val"))).alias(name) for k, name in enumerate(BANDS)],
        )
    )


def image_points(px: DataFrame, meta: DataFrame, small_meta: DataFrame | None = None) -> DataFrame:
    """Pixels flipped vertically (row 0 = south edge) and keyed by row-major ``pid``.

    ``meta`` has one row per scene and is joined by ``scene_id`` as a broadcast after a size
    check (``settled``); pass ``small_meta`` when that was done already."""
    from drapekit.operators.small import settled

    m = small_meta if small_meta is not None else settled(meta.select("scene_id", "width", "height"), "meta")
    j = px.join(m.select("scene_id", "width", "height"), "scene_id")
    frow = flipped_row(F.col("row_idx"), F.col("height"))
    return j.select(
        "scene_id",
        point_id(frow, F.col("col_idx"), F.col("width")),
        *BANDS,
    )
