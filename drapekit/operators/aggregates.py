"""Cloud aggregates: statistics (A1), expanded bounding box (A2), centre and scale (A3),
colour range (A4), counts (A5) and the fetch report (A6).

All are one-pass grouped aggregates (partial aggregation per task, then one small shuffle),
grouped by ``scene_id`` when the frame has it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _groups(df: DataFrame, group: Sequence[str]) -> list[str]:
    return [g for g in group if g in df.columns]


def _agg(df: DataFrame, group: list[str], *exprs):
    return df.groupBy(*group).agg(*exprs) if group else df.agg(*exprs)


def cloud_stats(df: DataFrame, group: Sequence[str] = ("scene_id",)) -> DataFrame:
    """A1: point count, column list, min/max of x, y, z.  An empty cloud gives no row (the
    reference's "No point cloud data")."""
    g = _groups(df, group)
    exprs = [F.count(F.lit(1)).alias("num_points")]
    for c in ("x", "y", "z"):
        if c in df.columns:
            exprs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    out = _agg(df, g, *exprs).filter(F.col("num_points") > 0)
    return out.withColumn("columns", F.lit(",".join(df.columns)))


def expanded_bbox(target: DataFrame, margin: float = 2.0, group: Sequence[str] = ()) -> DataFrame:
    """A2: the target's x/y extent widened by ``margin`` times the extent on each side."""
    g = _groups(target, group)
    b = _agg(
        target, g, F.min("x").alias("_x0"), F.max("x").alias("_x1"), F.min("y").alias("_y0"), F.max("y").alias("_y1")
    )
    m = F.lit(float(margin))
    return b.select(
        *g,
        (F.col("_x0") - m * (F.col("_x1") - F.col("_x0"))).alias("x_min"),
        (F.col("_x1") + m * (F.col("_x1") - F.col("_x0"))).alias("x_max"),
        (F.col("_y0") - m * (F.col("_y1") - F.col("_y0"))).alias("y_min"),
        (F.col("_y1") + m * (F.col("_y1") - F.col("_y0"))).alias("y_max"),
    )


def center_scale(df: DataFrame, group: Sequence[str] = ("scene_id",)) -> DataFrame:
    """A3: centroid per axis and one uniform scale = the largest absolute deviation from the
    centroid over the three axes - in one pass (avg, min, max), not two."""
    g = _groups(df, group)
    exprs = []
    for c in ("x", "y", "z"):
        exprs += [F.avg(c).alias(f"c{c}"), F.min(c).alias(f"_{c}0"), F.max(c).alias(f"_{c}1")]
    s = _agg(df, g, *exprs)
    dev = [
        F.greatest(F.col(f"_{c}1") - F.col(f"c{c}"), F.col(f"c{c}") - F.col(f"_{c}0")) for c in ("x", "y", "z")
    ]
    return s.select(*g, "cx", "cy", "cz", F.greatest(*dev).alias("scale"))


def color_range(df: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """A4: smallest and largest value over all three colour channels."""
    g = _groups(df, group)
    return _agg(
        df,
        g,
        F.least(F.min("red"), F.min("green"), F.min("blue")).alias("color_min"),
        F.greatest(F.max("red"), F.max("green"), F.max("blue")).alias("color_max"),
    )


def count_points(df: DataFrame, group: Sequence[str] = ("scene_id",), name: str = "num_points") -> DataFrame:
    """A5: number of points per group."""
    g = _groups(df, group)
    return _agg(df, g, F.count(F.lit(1)).alias(name))


def observed_count(df: DataFrame, name: str):
    """A5 riding along another action: returns ``(df_observed, observation)``; after the
    action ``observation.get[name]`` holds the count without a second job."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs


def batch_report(fetched: DataFrame) -> DataFrame:
    """Files fetched, bytes, failures."""
    return fetched.agg(
        F.count(F.lit(1)).alias("n_objects"),
        F.count_if(F.col("error").isNull()).alias("n_ok"),
        F.count_if(F.col("error").isNotNull()).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("error").isNull(), F.col("bytes"))), F.lit(0)).cast("long").alias("total_bytes"),
    )
