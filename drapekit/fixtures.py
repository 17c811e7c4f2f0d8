"""Input tables derived from the driver's parquet tables.

The pipeline's natural inputs (catalogue items, image rows, elevation cells, point clouds,
object references, bbox strings) are built here from the TPC-H-like tables, so every query's
work grows with the scale factor.  ``drapekit.fixtures_sql`` holds the same views as DuckDB
text for the oracle.  Both follow one written definition; changing one means changing both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: fixed value: scenes that the orders are dealt to
SCENES = 24


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their scene ``s``, their place ``i`` in it and its size ``n``."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(k.alias("k"), (k % SCENES).cast("int").alias("s"), F.floor(k / SCENES).alias("i"), "o_totalprice", "o_custkey")
    return o.join(o.groupBy("s").agg(F.count(F.lit(1)).alias("n")), "s")


def stac_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat catalogue items: one per event row."""
    ev = table(spark, sf_dir, "events")
    uid, etype, eid = F.col("user_id"), F.col("event_type"), F.col("event_id")
    return ev.select(
        F.concat(F.lit("S2_"), uid.cast("string"), F.lit("_"), etype, F.lit("_"), eid.cast("string")).alias("id"),
        F.when(etype.isin("view", "click", "purchase"), F.lit("sentinel-2-l2a"))
        .otherwise(F.lit("sentinel-2-l1c"))
        .alias("collection"),
        F.col("ts").alias("datetime"),
        (F.col("value") % 100).alias("cloud_cover"),
        F.when(eid % 7 == 0, F.lit(None).cast("double"))
        .otherwise(F.get_json_object("props", "$.k").cast("double") / 10)
        .alias("nodata"),
        ((uid * 37) % 340 - 170).cast("double").alias("min_lon"),
        ((uid * 13) % 160 - 80).cast("double").alias("min_lat"),
        ((uid * 37) % 340 - 160).cast("double").alias("max_lon"),
        ((uid * 13) % 160 - 70).cast("double").alias("max_lat"),
        F.concat(F.lit("s3://eodata/"), etype, F.lit("/"), eid.cast("string"), F.lit("_TCI_20m.jp2")).alias(
            "tci_20m_href"
        ),
    )


def stac_item_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same items as nested STAC JSON text (one ``value`` string per item), as a catalogue
    export would land them.  Datetimes are RFC 3339 UTC strings."""
    flat = stac_items(spark, sf_dir)
    nested = F.struct(
        F.lit("Feature").alias("type"),
        F.col("id"),
        F.col("collection"),
        F.array("min_lon", "min_lat", "max_lon", "max_lat").alias("bbox"),
        F.struct(
            F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("datetime"),
            F.col("cloud_cover").alias("eo:cloud_cover"),
            F.when(F.col("nodata").isNotNull(), F.struct(F.col("nodata").alias("nodata"))).alias("statistics"),
        ).alias("properties"),
        F.create_map(F.lit("TCI_20m"), F.struct(F.col("tci_20m_href").alias("href"))).alias("assets"),
    )
    return flat.select(F.to_json(nested).alias("value"))


def raster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image storage rows ``(scene_id, band, row_idx, samples ARRAY<INT>)``: each order is one band
    of one image row of its scene; scene s is 10 + s pixels wide.  A last image row without
    all three bands is left out."""
    o = _orders(spark, sf_dir).where("i < 3 * floor(n / 3)")
    value = lambda j: ((F.col("k") * 31 + F.col("o_custkey") * 7 + j * 17) % 256).cast("int")
    return o.select(
        F.col("s").alias("scene_id"),
        (F.col("i") % 3).cast("int").alias("band"),
        F.floor(F.col("i") / 3).cast("int").alias("row_idx"),
        F.transform(F.sequence(F.lit(0), F.col("s") + 9), value).alias("samples"),
    )


def dem_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation grid ``(scene_id, x, y, dem)``: one cell per order; scene s has 8 + s cells to a
    row.  A last row that is not full is left out."""
    wide = F.col("s") + 8
    o = _orders(spark, sf_dir).where(F.col("i") < wide * F.floor(F.col("n") / wide))
    return o.select(
        F.col("s").alias("scene_id"),
        (F.col("s") * 1000 + (F.col("i") % wide) * 10).cast("double").alias("x"),
        (F.col("s") * 100 + F.floor(F.col("i") / wide) * 5).cast("double").alias("y"),
        (F.col("o_totalprice") * 0.01).alias("dem"),
    )


def dem_axes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The grid's coordinate vectors ``(scene_id, x)`` and ``(scene_id, y)``."""
    from drapekit.sources.dem import dem_axes as axes_of

    return axes_of(dem_cells(spark, sf_dir))


def raster_meta(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """One row per scene ``(scene_id, lft, btm, rgt, tp, width, height)``: the image covers the
    grid's extent."""
    rows = raster_rows(spark, sf_dir) if rows is None else rows
    extent = dem_cells(spark, sf_dir).groupBy("scene_id").agg(F.min("x").alias("lft"), F.max("x").alias("rgt"), F.min("y").alias("btm"), F.max("y").alias("tp"))
    size = rows.groupBy("scene_id").agg(F.max(F.size("samples")).cast("int").alias("width"), (F.max("row_idx") + 1).cast("int").alias("height"))
    return extent.join(size, "scene_id").select("scene_id", "lft", "btm", "rgt", "tp", "width", "height")


def landed(df: DataFrame, name: str) -> str:
    """The folder of ``df`` written as Parquet: what the source readers get."""
    from drapekit.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point cloud with a dense point id: one point per order."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("pid"),
        F.col("o_totalprice").alias("x"),
        F.col("o_custkey").cast("double").alias("y"),
        (F.col("o_totalprice") * 0.001 + F.col("o_custkey")).alias("z"),
        (k % 256).cast("int").alias("red"),
        ((k * 7) % 256).cast("int").alias("green"),
        ((k * 13) % 256).cast("int").alias("blue"),
    )


def points_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point cloud without a point id: one point per line item."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_extendedprice").alias("x"),
        F.col("l_partkey").cast("double").alias("y"),
        (F.col("l_quantity") + F.col("l_discount")).alias("z"),
        (F.col("l_linenumber") * 30).cast("int").alias("red"),
        (F.col("l_suppkey") % 256).cast("int").alias("green"),
        (F.col("l_partkey") % 256).cast("int").alias("blue"),
    )


def object_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object references: s3 URLs with queries and fragments, and bare keys with or without an
    explicit bucket."""
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    return p.select(
        pid,
        F.when(pid % 3 == 0, F.regexp_replace("url", r"^[a-z]+://[^/]*", ""))
        .otherwise(F.regexp_replace("url", r"^[a-z]+://", "s3://"))
        .alias("ref"),
        F.when(pid % 5 == 0, F.lit("eodata")).otherwise(F.lit(None).cast("string")).alias("bucket"),
    )


def bbox_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search requests as bbox strings, valid and invalid ones."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    m = k % 170
    generic = F.concat(
        m.cast("string"), F.lit(",0,"), (m + 5).cast("string"), F.lit(","), (k % 80 + 1).cast("string")
    )
    case = k % 8
    bbox = (
        F.when(case == 0, F.lit("3.2833,45.3833,11.2,50.1833"))
        .when(case == 1, F.lit("-20.383301, 64.222311, -17.329102, 64.92044"))
        .when(case == 2, F.lit("1,2,3"))
        .when(case == 3, F.lit("a,b,c,d"))
        .when(case == 4, F.lit("-181,0,10,10"))
        .when(case == 5, F.lit("0,-91,10,10"))
        .when(case == 6, F.lit("10,0,10,10"))
        .otherwise(generic)
    )
    return c.select(k.alias("req_id"), bbox.alias("bbox"))
