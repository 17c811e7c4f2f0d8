"""Catalogue items (S1): STAC item JSON landed on storage -> one flat row per item.

The live search service is not called; items are read from files (JSON lines, or GeoJSON
FeatureCollections) or from a column of JSON text, with an explicit schema so no inference
pass runs and only the needed nested fields are materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the true-colour 20 m asset the pipeline drapes
DEFAULT_ASSET = "TCI_20m"

ITEM_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField("datetime", T.StringType()),
                    T.StructField("eo:cloud_cover", T.DoubleType()),
                    T.StructField("statistics", T.StructType([T.StructField("nodata", T.DoubleType())])),
                ]
            ),
        ),
        T.StructField("assets", T.MapType(T.StringType(), T.StructType([T.StructField("href", T.StringType())]))),
    ]
)


def item_datetime(s: Column) -> Column:
    """RFC 3339 text -> UTC wall-clock ``timestamp_ntz`` (independent of the session time
    zone); unparseable text gives NULL."""
    instant = F.try_to_timestamp(s)
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def asset_href(assets: Column, name: str = DEFAULT_ASSET) -> Column:
    """Href of one named asset; NULL when the item lacks it."""
    return F.try_element_at(assets, F.lit(name)).getField("href")


def href_column(name: str = DEFAULT_ASSET) -> str:
    return f"{name.lower()}_href"


def flatten_items(items: DataFrame, asset: str = DEFAULT_ASSET) -> DataFrame:
    """Nested items -> ``id, collection, datetime, cloud_cover, nodata, min_lon, min_lat,
    max_lon, max_lat, <asset>_href``."""
    p = F.col("properties")
    return items.select(
        "id",
        "collection",
        item_datetime(p.getField("datetime")).alias("datetime"),
        p.getField("eo:cloud_cover").alias("cloud_cover"),
        p.getField("statistics").getField("nodata").alias("nodata"),
        *[F.try_element_at("bbox", F.lit(i + 1)).alias(n) for i, n in enumerate(("min_lon", "min_lat", "max_lon", "max_lat"))],
        asset_href(F.col("assets"), asset).alias(href_column(asset)),
    )


def parse_items(text: DataFrame, col: str = "value", asset: str = DEFAULT_ASSET) -> DataFrame:
    """Items from a column of JSON text (one item per row)."""
    parsed = text.select(F.from_json(F.col(col), ITEM_SCHEMA).alias("it")).select("it.*")
    return flatten_items(parsed, asset)


def read_catalog(
    spark: SparkSession, path: str, feature_collection: bool = False, asset: str = DEFAULT_ASSET
) -> DataFrame:
    """Scan landed item files.  JSON lines by default; with ``feature_collection=True`` the
    features of FeatureCollection files (one file or a folder), each file read in byte ranges by
    several tasks."""
    if feature_collection:
        from drapekit.sources.features import read_features

        return parse_items(read_features(spark, path), asset=asset)
    return flatten_items(spark.read.schema(ITEM_SCHEMA).json(path), asset)
