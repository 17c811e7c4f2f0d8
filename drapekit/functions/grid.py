"""Grid positions: evenly spaced axes (P11), vertical flip (P9), row-major point ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def linspace_value(i: Column, start: Column, stop: Column, n: Column) -> Column:
    """Value ``i`` of ``n`` evenly spaced numbers from ``start`` to ``stop``, both ends included.

    Same arithmetic as the usual linspace: ``i * ((stop - start) / (n - 1)) + start``, the last
    value forced to ``stop``, and ``n = 1`` giving ``start``.
    """
    step = (stop - start) / (n - 1).cast("double")
    return (
        F.when(n == 1, start)
        .when(i == n - 1, stop)
        .otherwise(i.cast("double") * step + start)
    )


def linspace(
    frame: DataFrame,
    start: str,
    stop: str,
    n: str,
    index_name: str,
    value_name: str,
    keys: tuple[str, ...] = ("scene_id",),
) -> DataFrame:
    """One row per axis position for each row of ``frame`` (one row per scene).

    The axis length is bounded by the image header (width or height), so exploding it inside
    one row is bounded work; ``n = 0`` gives no rows.
    """
    idx = F.explode(
        F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    )
    exploded = frame.select(*keys, F.col(start).alias("_s"), F.col(stop).alias("_e"), F.col(n).alias("_n"), idx.alias(index_name))
    return exploded.select(
        *keys,
        F.col(index_name),
        linspace_value(F.col(index_name), F.col("_s"), F.col("_e"), F.col("_n")).alias(value_name),
    )


def flipped_row(row_idx: Column, height: Column) -> Column:
    """Mirror rows so row 0 becomes the last one."""
    return (height - 1 - row_idx).cast("int")


def point_id(row_idx: Column, col_idx: Column, width: Column) -> Column:
    """Row-major position of a pixel."""
    return (row_idx.cast("long") * width.cast("long") + col_idx.cast("long")).alias("pid")
