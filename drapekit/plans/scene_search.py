"""Q1: newest clear scene for a search box.

items -> P5 (collection, window, box, cloud) -> optionally T1/T2 (newest n) -> P6 (nodata) -> P1 (id
key) -> W1 (newest per key) -> T3 (newest overall, carrying its row: J6) -> P8/P2 (asset key).

For many boxes at once use ``J1`` (``drapekit.operators.match.match_scenes``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drapekit.functions.text import object_key, url_bucket
from drapekit.operators import catalog as C


def scene_candidates(
    items: DataFrame,
    bbox=None,
    as_of: _dt.date | str | None = None,
    window_days: int | None = C.WINDOW_DAYS,
    max_cloud_cover: float = C.MAX_CLOUD_COVER,
    max_items: int | None = None,
    max_nodata: float = C.MAX_NODATA,
    collection: str = C.COLLECTION,
) -> DataFrame:
    """Everything up to the nodata filter.  ``max_items`` caps what the search returns before the
    filter, as a search service's page limit does (T2); by default nothing is capped."""
    found = C.catalog_predicate(items, bbox, as_of, window_days, max_cloud_cover, collection)
    if max_items is not None:
        found = C.cap_items(found, max_items)
    return C.nodata_filter(found, max_nodata)


def scene_search(items: DataFrame, href_col: str = "tci_20m_href", **search) -> DataFrame:
    """One row ``(id, id_key, datetime, href, bucket, object_key)``, or no row when nothing
    matches."""
    cands = C.with_id_key(scene_candidates(items, **search))
    # W1 keeps the whole row, so the look-up by id (J6) needs no second search
    item = C.most_recent(C.latest_per_key(cands))
    return item.select(
        "id",
        "id_key",
        "datetime",
        F.col(href_col).alias("href"),
        url_bucket(F.col(href_col)).alias("bucket"),
        object_key(F.col(href_col)).alias("object_key"),
    )
