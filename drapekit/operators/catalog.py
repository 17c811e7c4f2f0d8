"""Catalogue search operators: predicate (P5), nodata filter (P6), sort (T1), cap (T2),
newest per key (W1), newest overall (T3) and look-up by id (J6).

Ordering everywhere is ``datetime`` descending, then ``id`` ascending so ties are decided.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drapekit.functions.text import strip_last_segment

# fixed values: search defaults
COLLECTION = "sentinel-2-l2a"
MAX_CLOUD_COVER = 20.0
WINDOW_DAYS = 360
MAX_ITEMS = 1000
MAX_NODATA = 5.0
MISSING_NODATA = 100.0

BOX = ("min_lon", "min_lat", "max_lon", "max_lat")


def recency_order() -> list[Column]:
    return [F.col("datetime").desc_nulls_last(), F.col("id").asc_nulls_last()]


def recency_key() -> Column:
    """A sortable key where smaller means newer (then smaller id): for ``min_by``."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(datetime as timestamp_ntz))")
    return F.struct(F.coalesce(-micros, F.lit(2**62)).alias("t"), F.col("id").alias("id"))


def window_bounds(as_of: _dt.date | str, window_days: int) -> tuple[str, str]:
    """Closed day-granular window ending on ``as_of`` (end day included)."""
    end = _dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    start = end - _dt.timedelta(days=window_days)
    return f"{start.isoformat()} 00:00:00", f"{end.isoformat()} 23:59:59"


def bbox_overlaps(q: tuple[float, float, float, float], prefix: str = "") -> Column:
    """Item box (columns ``min_lon..max_lat``) intersects box ``q`` (closed intervals)."""
    x0, y0, x1, y1 = q
    c = lambda n: F.col(prefix + n)
    return (c("min_lon") <= x1) & (c("max_lon") >= x0) & (c("min_lat") <= y1) & (c("max_lat") >= y0)


def catalog_predicate(
    items: DataFrame,
    bbox: tuple[float, float, float, float] | None = None,
    as_of: _dt.date | str | None = None,
    window_days: int | None = WINDOW_DAYS,
    max_cloud_cover: float = MAX_CLOUD_COVER,
    collection: str = COLLECTION,
) -> DataFrame:
    """P5: collection, datetime window, footprint overlap, cloud cover strictly below the
    limit (missing cloud cover never passes).  Plain column predicates, so they reach the
    Parquet scan as pushed filters."""
    cond = (F.col("collection") == collection) & (F.col("cloud_cover") < max_cloud_cover)
    if as_of is not None and window_days is not None:
        lo, hi = window_bounds(as_of, window_days)
        ts = F.col("datetime").cast("timestamp_ntz")
        cond = cond & ts.between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"))
    if bbox is not None:
        cond = cond & bbox_overlaps(bbox)
    return items.filter(cond)


def nodata_filter(items: DataFrame, max_nodata: float = MAX_NODATA) -> DataFrame:
    """Keep items whose nodata share is below the limit; missing counts as 100."""
    return items.filter(F.coalesce(F.col("nodata"), F.lit(MISSING_NODATA)) < max_nodata)


def with_id_key(items: DataFrame) -> DataFrame:
    """P1 as a column: ``id_key`` = id without its last ``_`` segment."""
    return items.withColumn("id_key", strip_last_segment(F.col("id")))


def sort_recent(items: DataFrame) -> DataFrame:
    """Newest first."""
    return items.orderBy(*recency_order())


def cap_items(items: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """The ``max_items`` newest (a top-k: each task keeps its own top k, one task merges
    them).  Applied before the nodata filter, as the search service does."""
    return items.orderBy(*recency_order()).limit(max_items)


def latest_per_key(items: DataFrame, key: str = "id_key") -> DataFrame:
    """The newest row per key (ties: smallest id; of rows that repeat the id, any).

    An aggregate rather than a window: only (recency, id) is aggregated, map-side first, so a
    key that holds a third of all rows is reduced before the shuffle.  The rows of the winners
    are then fetched by id."""
    best = items.groupBy(key).agg(F.min(recency_key()).alias("_k"))
    best = best.select(F.col(key).alias("_key"), F.col("_k.id").alias("_id"))
    hit = items.join(best, F.col(key).eqNullSafe(F.col("_key")) & F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    cols = [c for c in items.columns if c not in (key, "id")]
    rows = hit.groupBy(key, "id").agg(F.min_by(F.struct(*cols), recency_key()).alias("_best"))
    return rows.select(key, "id", *[F.col(f"_best.{c}").alias(c) for c in cols]).select(*items.columns)


def most_recent(items: DataFrame) -> DataFrame:
    """The single newest item; an empty frame when nothing matched."""
    return items.orderBy(*recency_order()).limit(1)


def lookup_by_id(candidates: DataFrame, winner: DataFrame) -> DataFrame:
    """The first candidate (in recency order) whose id is the winner's id."""
    hit = candidates.join(winner.select("id"), "id", "left_semi")
    return hit.orderBy(*recency_order()).limit(1)
