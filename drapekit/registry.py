"""Registered queries: one per operator of the inventory, plus the composed jobs.

Each query is ``(spark, sf_dir) -> DataFrame`` over the fixture views of the driver tables
(whole tables, no row caps).  Most have a DuckDB oracle in ``ORACLE``; the few that cannot be
written in SQL (object copies, file round trips, eigenvectors, approximate sampling) have
none and are covered by pytest instead.

Column names and types match between a query and its oracle; computed doubles that depend on
summation order are rounded in both.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drapekit import fixtures as fx
from drapekit.fixtures_sql import with_views
from drapekit.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


# ---------------------------------------------------------------------------------------
# shared oracle fragments (DuckDB)


def _cte_query(ctes: str, select: str, *views: str) -> str:
    body = ctes.strip()
    if body.startswith(","):
        body = body[1:]
    return with_views(", " + body + "\n" + select, *views)



SQL_TARGET_AXES = """
, xt as (
  select scene_id, col_idx,
    case when width = 1 then lft when col_idx = width - 1 then rgt
         else cast(col_idx as double) * ((rgt - lft) / cast(width - 1 as double)) + lft end as tx
  from (select *, cast(unnest(range(width)) as integer) as col_idx from raster_meta))
, yt as (
  select scene_id, row_idx,
    case when height = 1 then btm when row_idx = height - 1 then tp
         else cast(row_idx as double) * ((tp - btm) / cast(height - 1 as double)) + btm end as ty
  from (select *, cast(unnest(range(height)) as integer) as row_idx from raster_meta))
"""

SQL_SNAPPED_AXES = (
    SQL_TARGET_AXES
    + """
, xl as (select distinct scene_id, x from dem_cells)
, yl as (select distinct scene_id, y from dem_cells)
, xlo as (select t.*, l.x as lo from xt t asof left join xl l on t.scene_id = l.scene_id and t.tx >= l.x)
, xhi as (select t.*, h.x as hi from xlo t asof left join xl h on t.scene_id = h.scene_id and t.tx <= h.x)
, xs as (select scene_id, col_idx, tx,
    case when lo is null then hi when hi is null then lo when tx - lo < hi - tx then lo else hi end as x from xhi)
, ylo as (select t.*, l.y as lo from yt t asof left join yl l on t.scene_id = l.scene_id and t.ty >= l.y)
, yhi as (select t.*, h.y as hi from ylo t asof left join yl h on t.scene_id = h.scene_id and t.ty <= h.y)
, ys as (select scene_id, row_idx, ty,
    case when lo is null then hi when hi is null then lo when ty - lo < hi - ty then lo else hi end as y from yhi)
"""
)

SQL_ELEVATION = (
    SQL_SNAPPED_AXES
    + """
, elev as (
  select c.scene_id, cast(ys.row_idx as bigint) * m.width + xs.col_idx as pid, ys.row_idx, xs.col_idx,
    c.x, c.y, c.dem as z
  from dem_cells c
  join xs on c.scene_id = xs.scene_id and c.x = xs.x
  join ys on c.scene_id = ys.scene_id and c.y = ys.y
  join raster_meta m on m.scene_id = c.scene_id)
"""
)

SQL_IMAGE_POINTS = """
, img as (
  select p.scene_id, cast(m.height - 1 - p.row_idx as bigint) * m.width + p.col_idx as pid, p.red, p.green, p.blue
  from raster_px p join raster_meta m on p.scene_id = m.scene_id)
"""

SQL_DRAPE = (
    SQL_ELEVATION
    + SQL_IMAGE_POINTS
    + """
, drape as (
  select img.scene_id, img.pid, elev.x, elev.y, elev.z, img.red, img.green, img.blue
  from img join elev on img.scene_id = elev.scene_id and img.pid = elev.pid)
"""
)


def sql_draws(sizes_cte: str, fraction: float, seed: int, group: str | None = "scene_id") -> str:
    """DuckDB draws ``(group, k, pid)`` matching ``draws_with_replacement``."""
    g_sel = f"{group}, " if group else ""
    g_key = f"cast({group} as varchar), ':', " if group else ""
    return f"""
, draws as (
  select {g_sel}k, cast(('0x' || substr(md5(concat('{seed}:', {g_key}cast(k as varchar))), 1, 15)) as bigint) % n_total as pid
  from (select {g_sel}n_total, unnest(range(cast(round_even({float(fraction)!r} * n_total, 0) as bigint))) as k from {sizes_cte}))
"""


# ---------------------------------------------------------------------------------------
# image


@register("s4_read_raster", with_views("select scene_id, row_idx, col_idx, red, green, blue from raster_px", "raster_px"))
def q_s4(spark, sf):
    from drapekit.sources.raster import interleave_bands, read_raster_rows

    return interleave_bands(read_raster_rows(spark, fx.landed(fx.raster_rows(spark, sf), "raster")))


@register(
    "s4_raster_missing_band",
    with_views(
        "select scene_id, row_idx, col_idx, coalesce(red, -1) as red, coalesce(green, -1) as green, coalesce(blue, -1) as blue from ("
        "select scene_id, row_idx, col_idx, max(case when band = 0 then val end) as red, max(case when band = 1 then val end) as green, "
        "max(case when band = 2 then val end) as blue from raster_long where not (band = 1 and row_idx % 10 = 3) group by all)",
        "raster_long",
    ),
)
def q_s4_holes(spark, sf):
    """Image rows without their green band: kept, with the channel absent (-1 here)."""
    from drapekit.sources.raster import interleave_bands

    rows = fx.raster_rows(spark, sf).where("not (band = 1 and row_idx % 10 = 3)")
    return interleave_bands(rows, missing="null").fillna(-1, ["red", "green", "blue"])


@register(
    "p10_interleave_bands_long",
    with_views("select scene_id, row_idx, col_idx, red, green, blue from raster_px", "raster_px"),
)
def q_p10(spark, sf):
    from drapekit.sources.raster import interleave_bands_long

    rows = fx.raster_rows(spark, sf)
    long = rows.select("scene_id", "band", "row_idx", F.posexplode("samples").alias("col_idx", "val"))
    return interleave_bands_long(long.withColumn("col_idx", F.col("col_idx").cast("int")))


@register(
    "p9_p12_image_points",
    _cte_query(SQL_IMAGE_POINTS, "select scene_id, pid, red, green, blue from img", "raster_px", "raster_meta"),
)
def q_p9(spark, sf):
    from drapekit.sources.raster import image_points, interleave_bands

    rows = fx.raster_rows(spark, sf)
    return image_points(interleave_bands(rows), fx.raster_meta(spark, sf, rows=rows))


# ---------------------------------------------------------------------------------------
# S5 / P11 / J2 / J3 / J4 / J5 / A1


@register("s5_read_dem", with_views("select scene_id, x, y, dem from dem_cells", "dem_cells"))
def q_s5(spark, sf):
    from drapekit.sources.dem import read_dem

    return read_dem(spark, fx.landed(fx.dem_cells(spark, sf), "dem"))


@register(
    "p11_linspace",
    _cte_query(
        SQL_TARGET_AXES,
        "select scene_id, 'x' as axis, col_idx as idx, tx as v from xt union all select scene_id, 'y' as axis, row_idx as idx, ty as v from yt",
        "raster_meta",
    ),
)
def q_p11(spark, sf):
    from drapekit.operators.drape import target_axes

    xt, yt = target_axes(fx.raster_meta(spark, sf))
    return xt.select("scene_id", F.lit("x").alias("axis"), F.col("col_idx").alias("idx"), F.col("tx").alias("v")).unionByName(
        yt.select("scene_id", F.lit("y").alias("axis"), F.col("row_idx").alias("idx"), F.col("ty").alias("v"))
    )


@register(
    "j2_nearest_label",
    _cte_query(
        SQL_SNAPPED_AXES,
        "select scene_id, 'x' as axis, col_idx as idx, tx as v, x as label from xs "
        "union all select scene_id, 'y' as axis, row_idx as idx, ty as v, y as label from ys",
        "raster_meta",
        "dem_cells",
    ),
)
def q_j2(spark, sf):
    from drapekit.operators.nearest import nearest_label

    return _snapped(spark, sf, nearest_label)


@register(
    "j2_nearest_label_split",
    _cte_query(
        SQL_SNAPPED_AXES,
        "select scene_id, 'x' as axis, col_idx as idx, tx as v, x as label from xs "
        "union all select scene_id, 'y' as axis, row_idx as idx, ty as v, y as label from ys",
        "raster_meta",
        "dem_cells",
    ),
)
def q_j2_split(spark, sf):
    """The same with every axis cut into ranges."""
    from drapekit.operators.nearest import nearest_label_split

    return _snapped(spark, sf, nearest_label_split)


def _snapped(spark, sf, nearest):
    from drapekit.operators.drape import target_axes

    xt, yt = target_axes(fx.raster_meta(spark, sf))
    xl, yl = fx.dem_axes(spark, sf)
    xs = nearest(xt, xl, value="tx", label="x")
    ys = nearest(yt, yl, value="ty", label="y")
    return xs.select(
        "scene_id", F.lit("x").alias("axis"), F.col("col_idx").alias("idx"), F.col("tx").alias("v"), F.col("x").alias("label")
    ).unionByName(
        ys.select(
            "scene_id", F.lit("y").alias("axis"), F.col("row_idx").alias("idx"), F.col("ty").alias("v"), F.col("y").alias("label")
        )
    )


@register(
    "j3_resample_grid",
    _cte_query(SQL_ELEVATION, "select scene_id, pid, row_idx, col_idx, x, y, z from elev", "raster_meta", "dem_cells"),
)
def q_j3(spark, sf):
    from drapekit.operators.drape import resample_grid

    cells = fx.dem_cells(spark, sf)
    return resample_grid(fx.raster_meta(spark, sf), cells, axes=fx.dem_axes(spark, sf))


@register(
    "j3_resample_tiled",
    _cte_query(SQL_ELEVATION, "select scene_id, pid, row_idx, col_idx, x, y, z from elev", "raster_meta", "dem_cells"),
)
def q_j3_tiled(spark, sf):
    """The same elevations from a tiled grid, whose tiles are pruned scene by scene."""
    from drapekit.operators.drape import resample_grid

    return resample_grid(fx.raster_meta(spark, sf), _tiled(spark, sf))


def _tiled(spark, sf):
    from drapekit.session import scratch_path
    from drapekit.sources.dem import write_tiles

    return write_tiles(fx.dem_cells(spark, sf), scratch_path(spark, "tiles"), side=TILE_SIDE)


#: fixed value: side of a tile, in units of the grid
TILE_SIDE = 100.0


@register(
    "s5_write_tiles",
    _cte_query(
        f"""
, placed as (select *, floor(x / {TILE_SIDE})::bigint + 1073741824 as tx, floor(y / {TILE_SIDE})::bigint + 1073741824 as ty from dem_cells)
, keyed as (select *, list_sum(list_transform(range(31), lambda b: (((tx >> b) & 1) << (2 * b)) + (((ty >> b) & 1) << (2 * b + 1))))::bigint as tile from placed)
""",
        "select scene_id, tile, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1, count(*) as n from keyed group by scene_id, tile",
        "dem_cells",
    ),
)
def q_s5_tiles(spark, sf):
    """Extents of the tiles that a grid was written in."""
    return _tiled(spark, sf).tiles.drop("span")


@register(
    "j4_mesh_grid",
    _cte_query(
        SQL_SNAPPED_AXES,
        "select xs.scene_id, cast(ys.row_idx as bigint) * m.width + xs.col_idx as pid, ys.row_idx, xs.col_idx, xs.x, ys.y "
        "from xs join ys on xs.scene_id = ys.scene_id join raster_meta m on m.scene_id = xs.scene_id",
        "raster_meta",
        "dem_cells",
    ),
)
def q_j4(spark, sf):
    from drapekit.operators.drape import mesh_grid, snapped_axes
    from drapekit.operators.small import settled

    cells = fx.dem_cells(spark, sf)
    meta = settled(fx.raster_meta(spark, sf), "meta")
    xs, ys = snapped_axes(meta, cells, axes=fx.dem_axes(spark, sf))
    return mesh_grid(xs, ys, meta)


def _cloud(spark, sf, cells=None, **how):
    """Drape of the landed inputs, read by the source readers."""
    from drapekit.plans.point_cloud import draped_cloud
    from drapekit.sources.dem import read_dem
    from drapekit.sources.raster import read_raster_rows

    rows = read_raster_rows(spark, fx.landed(fx.raster_rows(spark, sf), "raster"))
    dem = read_dem(spark, fx.landed(fx.dem_cells(spark, sf) if cells is None else cells, "dem"))
    meta = fx.raster_meta(spark, sf, rows=rows)
    return draped_cloud(meta, rows, dem, axes=fx.dem_axes(spark, sf), **how)


def _drape(spark, sf):
    return _cloud(spark, sf, fraction=None)


@register(
    "j5_drape_holes",
    _cte_query(
        SQL_DRAPE,
        "select scene_id, pid, coalesce(x, -1.0) as x, coalesce(y, -1.0) as y, coalesce(z, -1.0) as z, red, green, blue from ("
        "select img.scene_id, img.pid, elev.x, elev.y, elev.z, img.red, img.green, img.blue from img left join "
        "(select * from elev where floor(z * 100) % 10 <> 3) elev on img.scene_id = elev.scene_id and img.pid = elev.pid)",
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_j5_holes(spark, sf):
    """A grid with a tenth of its cells missing: every pixel stays, without a height there (-1)."""
    cells = fx.dem_cells(spark, sf).where("floor(dem * 100) % 10 <> 3")
    return _cloud(spark, sf, cells=cells, fraction=None, missing="null").drop("k").fillna(-1.0, ["x", "y", "z"])


@register(
    "j5_drape",
    _cte_query(SQL_DRAPE, "select * from drape", "raster_meta", "dem_cells", "raster_px"),
)
def q_j5(spark, sf):
    return _drape(spark, sf).drop("k")


@register(
    "a1_cloud_stats",
    _cte_query(
        SQL_DRAPE,
        "select scene_id, count(*) as num_points, min(x) as x_min, max(x) as x_max, min(y) as y_min, max(y) as y_max, "
        "min(z) as z_min, max(z) as z_max, 'scene_id,pid,x,y,z,red,green,blue' as columns from drape group by scene_id",
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_a1(spark, sf):
    from drapekit.operators.aggregates import cloud_stats

    return cloud_stats(_drape(spark, sf).drop("k"))


# ---------------------------------------------------------------------------------------
# M1 / M2 / M3 / A5 and the flagship Q2

SQL_SAMPLED = (
    SQL_DRAPE
    + ", sizes as (select scene_id, cast(width as bigint) * height as n_total from raster_meta)\n"
    + sql_draws("sizes", 0.2, 42)
    + """
, cloud as (
  select d.scene_id, d.k, d.pid, e.x, e.y, e.z, i.red, i.green, i.blue
  from draws d join img i on d.scene_id = i.scene_id and d.pid = i.pid
  join elev e on d.scene_id = e.scene_id and d.pid = e.pid)
"""
)


def _sql_u8(c: str, m: str = "m") -> str:
    return (
        f"case when {m} <= 1.0 then cast(least(255, greatest(0, floor(cast({c} as double) * 255))) as integer) "
        f"else cast(cast({c} as bigint) & 255 as integer) end as {c}"
    )


def _sampled(spark, sf):
    """The sampled cloud, made once: what comes after (colour maximum, centre, export) reads the
    written sample."""
    from drapekit.operators.small import settled

    return settled(_cloud(spark, sf, fraction=0.2, seed=42), "sample")


@register(
    "q2_point_cloud_raw",
    _cte_query(
        SQL_SAMPLED,
        ", cm as (select scene_id, greatest(max(red), max(green), max(blue)) as m from cloud group by scene_id)\n"
        "select c.scene_id, cast(x as float) as x, cast(y as float) as y, cast(z as float) as z, "
        + ", ".join(_sql_u8(c) for c in ("red", "green", "blue"))
        + " from cloud c join cm on c.scene_id = cm.scene_id",
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_q2(spark, sf):
    from drapekit.functions.coords import export_frame

    return export_frame(_sampled(spark, sf))


@register(
    "q2_cloud_stats",
    _cte_query(
        SQL_SAMPLED,
        "select scene_id, count(*) as num_points, min(x) as x_min, max(x) as x_max, min(y) as y_min, max(y) as y_max, "
        "min(z) as z_min, max(z) as z_max, 'scene_id,k,pid,x,y,z,red,green,blue' as columns from cloud group by scene_id",
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_q2_stats(spark, sf):
    from drapekit.operators.aggregates import cloud_stats

    return cloud_stats(_sampled(spark, sf))


@register(
    "a5_count_points",
    _cte_query(
        SQL_SAMPLED,
        "select a.scene_id, a.n_before, b.n_after from "
        "(select scene_id, count(*) as n_before from drape group by scene_id) a join "
        "(select scene_id, count(*) as n_after from cloud group by scene_id) b on a.scene_id = b.scene_id",
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_a5(spark, sf):
    from drapekit.operators.aggregates import count_points

    before = count_points(_drape(spark, sf), name="n_before")
    after = count_points(_sampled(spark, sf), name="n_after")
    return before.join(after, "scene_id").select("scene_id", "n_before", "n_after")


POINT_COLS = "pid, x, y, z, red, green, blue"


@register(
    "m1_sample_with_replacement",
    _cte_query(
        ", sizes as (select count(*) as n_total from points)\n"
        + sql_draws("sizes", 0.2, 42, group=None),
        "select d.k, p.pid, p.x, p.y, p.z, p.red, p.green, p.blue from draws d join points p on d.pid = p.pid",
        "points",
    ),
)
def q_m1(spark, sf):
    from drapekit.operators.sampling import sample_with_replacement

    return sample_with_replacement(fx.points(spark, sf), 0.2, seed=42).select("k", *POINT_COLS.split(", "))


@register(
    "m1_sample_with_replacement_no_id",
    _cte_query(
        ", li as (select row_number() over (order by x, y, z, red, green, blue) - 1 as pid, * from points_li)"
        ", sizes as (select count(*) as n_total from li)\n" + sql_draws("sizes", 0.2, 42, group=None),
        "select d.k, p.x, p.y, p.z, p.red, p.green, p.blue from draws d join li p on d.pid = p.pid",
        "points_li",
    ),
)
def q_m1_li(spark, sf):
    from drapekit.operators.indexing import dense_index
    from drapekit.operators.sampling import sample_with_replacement

    cols = ["x", "y", "z", "red", "green", "blue"]
    li = dense_index(fx.points_li(spark, sf), cols, name="pid")
    return sample_with_replacement(li, 0.2, seed=42).select("k", *cols)


@register(
    "m1_dense_index",
    "select *, row_number() over (order by l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 as idx from lineitem",
)
def q_m1_index(spark, sf):
    """All of lineitem, every column kept, numbered by price (ties by the keys)."""
    from drapekit.operators.indexing import dense_index

    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return dense_index(fx.table(spark, sf, "lineitem"), order, name="idx")


@register(
    "m2_sample_without_replacement",
    _cte_query(
        ", h as (select *, cast(('0x' || substr(md5(concat('42:', cast(pid as varchar))), 1, 15)) as bigint) as hv from points)"
        ", n as (select cast(round_even(0.2 * count(*), 0) as bigint) as n from points)",
        f"select {POINT_COLS} from (select *, row_number() over (order by hv, pid) as r from h) where r <= (select n from n)",
        "points",
    ),
)
def q_m2(spark, sf):
    from drapekit.operators.sampling import sample_without_replacement

    return sample_without_replacement(fx.points(spark, sf), 0.2, seed=42).select(*POINT_COLS.split(", "))


@register("m3_sample_approx", with_views("select count(*) as n_total, true as near, true as known from points", "points"))
def q_m3(spark, sf):
    """Size within five standard deviations of 0.2 N, and only rows of the cloud."""
    from drapekit.operators.sampling import sample_approx

    pts = fx.points(spark, sf)
    drawn = sample_approx(pts, 0.2, with_replacement=True, seed=42).groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    both = pts.select("pid", F.lit(1).alias("own")).join(drawn, "pid", "full_outer")
    n, got = F.count("own"), F.sum("n")
    return both.agg(n.alias("n_total"), (F.abs(got - 0.2 * n) <= 5 * F.sqrt(0.2 * n)).alias("near"), (F.count_if(F.col("own").isNull()) == 0).alias("known"))


# ---------------------------------------------------------------------------------------
# catalogue: S1 P1 P5 P6 P7 P8 T1 T2 T3 W1 J6 Q1 J1

AS_OF, WINDOW, BOX = "2024-01-30", 14, (-30.0, -30.0, 60.0, 60.0)
SQL_P5 = (
    "collection = 'sentinel-2-l2a' and cloud_cover < 20 "
    "and datetime between TIMESTAMP '2024-01-16 00:00:00' and TIMESTAMP '2024-01-30 23:59:59' "
    "and min_lon <= 60 and max_lon >= -30 and min_lat <= 60 and max_lat >= -30"
)
SQL_ID_KEY = r"regexp_replace(id, '_[^_]*$', '')"
SQL_CANDIDATES = f"""
, cands as (
  select *, {SQL_ID_KEY} as id_key from (
    select * from stac_items where {SQL_P5})
  where coalesce(nodata, 100) < 5)
"""


def _items(spark, sf):
    return fx.stac_items(spark, sf)


def _search():
    return dict(bbox=BOX, as_of=AS_OF, window_days=WINDOW)


@register("s1_read_catalog", with_views("select * from stac_items", "stac_items"))
def q_s1(spark, sf):
    from drapekit.session import scratch_path
    from drapekit.sources.catalog import read_catalog

    path = scratch_path(spark, "catalog")
    fx.stac_item_json(spark, sf).write.text(path)
    return read_catalog(spark, path)


#: fixed values: items to a collection, and bytes to a range, so that collections have many ranges
COLLECTION_ITEMS, SMALL_RANGE = 2000, 50_000


@register("s1_read_feature_collection", with_views("select * from stac_items", "stac_items"))
def q_s1_collection(spark, sf):
    """Items landed as FeatureCollection files of one object each, read in byte ranges."""
    from drapekit.session import scratch_path
    from drapekit.sources.catalog import parse_items
    from drapekit.sources.features import read_features

    path = scratch_path(spark, "collections")
    items = fx.stac_item_json(spark, sf)
    files = items.count() // COLLECTION_ITEMS + 1
    own = items.groupBy(F.pmod(F.xxhash64("value"), F.lit(files)).alias("k")).agg(F.concat_ws(",", F.collect_list("value")).alias("all"))
    text = F.concat(F.lit('{"type":"FeatureCollection","links":[{"href":"a\\"]}","rel":"self"}],"features":['), "all", F.lit("]}"))
    own.select(text.alias("value"), "k").write.partitionBy("k").text(path)
    return parse_items(read_features(spark, path, range_bytes=SMALL_RANGE))


@register("p7_item_datetime", with_views("select id, datetime from stac_items", "stac_items"))
def q_p7(spark, sf):
    from drapekit.sources.catalog import ITEM_SCHEMA, item_datetime

    j = fx.stac_item_json(spark, sf).select(F.from_json("value", ITEM_SCHEMA).alias("it"))
    return j.select(F.col("it.id").alias("id"), item_datetime(F.col("it.properties.datetime")).alias("datetime"))


@register("p8_asset_href", with_views("select id, tci_20m_href as href from stac_items", "stac_items"))
def q_p8(spark, sf):
    from drapekit.sources.catalog import ITEM_SCHEMA, asset_href

    j = fx.stac_item_json(spark, sf).select(F.from_json("value", ITEM_SCHEMA).alias("it"))
    return j.select(F.col("it.id").alias("id"), asset_href(F.col("it.assets"), "TCI_20m").alias("href"))


@register("p1_strip_last_segment", with_views(f"select id, {SQL_ID_KEY} as id_key from stac_items", "stac_items"))
def q_p1(spark, sf):
    from drapekit.functions.text import strip_last_segment

    return _items(spark, sf).select("id", strip_last_segment(F.col("id")).alias("id_key"))


@register("p5_catalog_predicate", with_views(f"select * from stac_items where {SQL_P5}", "stac_items"))
def q_p5(spark, sf):
    from drapekit.operators.catalog import catalog_predicate

    return catalog_predicate(_items(spark, sf), **_search())


@register("p6_nodata_filter", with_views("select * from stac_items where coalesce(nodata, 100) < 5", "stac_items"))
def q_p6(spark, sf):
    from drapekit.operators.catalog import nodata_filter

    return nodata_filter(_items(spark, sf))


@register("t1_sort_recent", with_views(f"select * from stac_items where {SQL_P5} order by datetime desc, id", "stac_items"))
def q_t1(spark, sf):
    from drapekit.operators.catalog import catalog_predicate, sort_recent

    return sort_recent(catalog_predicate(_items(spark, sf), **_search()))


@register(
    "t2_cap_items",
    with_views(
        "select * from (select * from stac_items where collection = 'sentinel-2-l2a' and cloud_cover < 20 "
        "order by datetime desc, id limit 1000) where coalesce(nodata, 100) < 5",
        "stac_items",
    ),
)
def q_t2(spark, sf):
    from drapekit.plans.scene_search import scene_candidates

    return scene_candidates(_items(spark, sf), bbox=None, as_of=None, window_days=None, max_items=1000)


@register(
    "w1_latest_per_key",
    with_views(
        f"select * exclude (r) from (select *, {SQL_ID_KEY} as id_key, row_number() over "
        f"(partition by {SQL_ID_KEY} order by datetime desc, id) as r from stac_items) where r = 1",
        "stac_items",
    ),
)
def q_w1(spark, sf):
    from drapekit.operators.catalog import latest_per_key, with_id_key

    return latest_per_key(with_id_key(_items(spark, sf)))


@register(
    "t3_most_recent",
    with_views(f"select * from stac_items where {SQL_P5} order by datetime desc, id limit 1", "stac_items"),
)
def q_t3(spark, sf):
    from drapekit.operators.catalog import catalog_predicate, most_recent

    return most_recent(catalog_predicate(_items(spark, sf), **_search()))


@register(
    "j6_lookup_by_id",
    _cte_query(
        SQL_CANDIDATES,
        "select * from cands where id = (select id from cands order by datetime desc, id limit 1) "
        "order by datetime desc, id limit 1",
        "stac_items",
    ),
)
def q_j6(spark, sf):
    from drapekit.operators.catalog import latest_per_key, lookup_by_id, most_recent, with_id_key
    from drapekit.plans.scene_search import scene_candidates

    cands = with_id_key(scene_candidates(_items(spark, sf), **_search()))
    return lookup_by_id(cands, most_recent(latest_per_key(cands)))


@register(
    "q1_scene_search",
    _cte_query(
        SQL_CANDIDATES,
        "select id, id_key, datetime, tci_20m_href as href, regexp_extract(tci_20m_href, '^s3://([^/?#]*)', 1) as bucket, "
        "regexp_extract(tci_20m_href, '^s3://[^/?#]*/*([^?#]*)', 1) as object_key "
        "from cands order by datetime desc, id limit 1",
        "stac_items",
    ),
)
def q_q1(spark, sf):
    from drapekit.plans.scene_search import scene_search

    return scene_search(_items(spark, sf), **_search())


# ---------------------------------------------------------------------------------------
# P2 P3 P4 J1

SQL_BBOX_PARSED = r"""
, bb_parts as (
  select req_id, list_transform(string_split(bbox, ','), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')) as parts
  from bbox_args)
, bb_vals as (
  select req_id, len(parts) as n,
    list_bool_and(list_transform(parts, lambda p: regexp_full_match(p, '(?i)[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)'))) as numeric,
    try_cast(parts[1] as double) as a, try_cast(parts[2] as double) as b,
    try_cast(parts[3] as double) as c, try_cast(parts[4] as double) as d
  from bb_parts)
, bb_err as (
  select *, case when not numeric then 'BAD_NUMBER' when n <> 4 then 'BAD_COUNT'
    when not (a between -180 and 180 and c between -180 and 180) then 'LON_RANGE'
    when not (b between -90 and 90 and d between -90 and 90) then 'LAT_RANGE'
    when a >= c then 'LON_ORDER' when b >= d then 'LAT_ORDER' end as error
  from bb_vals)
, bb as (
  select req_id, case when error is null then a end as min_lon, case when error is null then b end as min_lat,
    case when error is null then c end as max_lon, case when error is null then d end as max_lat, error
  from bb_err)
"""


@register("p4_parse_bbox", _cte_query(SQL_BBOX_PARSED, "select * from bb", "bbox_args"))
def q_p4(spark, sf):
    from drapekit.functions.bbox import parse_bbox_frame

    return parse_bbox_frame(fx.bbox_args(spark, sf))


SQL_OBJECT_KEY = (
    "case when starts_with(ref, 's3://') then regexp_extract(translate(ref, chr(9) || chr(13) || chr(10), ''), "
    "'^s3://[^/?#]*/*([^?#]*)', 1) else ref end"
)


@register("p2_object_key", with_views(f"select page_id, ref, {SQL_OBJECT_KEY} as object_key from object_refs", "object_refs"))
def q_p2(spark, sf):
    from drapekit.functions.text import object_key

    return fx.object_refs(spark, sf).select("page_id", "ref", object_key(F.col("ref")).alias("object_key"))


@register(
    "p3_resolve_object",
    with_views(
        f"""select page_id, ref, rb as bucket, k as key, regexp_extract(k, '[^/]*$') as filename,
  case when rb is null then 'NO_BUCKET' end as error
from (select page_id, ref, {SQL_OBJECT_KEY} as k,
  case when starts_with(ref, 's3://') then coalesce(nullif(bucket, ''),
       nullif(regexp_extract(translate(ref, chr(9) || chr(13) || chr(10), ''), '^s3://([^/?#]*)', 1), ''))
  else nullif(bucket, '') end as rb
  from object_refs)""",
        "object_refs",
    ),
)
def q_p3(spark, sf):
    from drapekit.functions.text import resolve_object

    r = fx.object_refs(spark, sf)
    return r.select("page_id", "ref", resolve_object(F.col("ref"), F.col("bucket")).alias("o")).select(
        "page_id", "ref", "o.bucket", "o.key", "o.filename", "o.error"
    )


@register(
    "j1_match_scenes",
    _cte_query(
        SQL_BBOX_PARSED
        + """
, it as (select * from stac_items where collection = 'sentinel-2-l2a' and cloud_cover < 20
  and datetime between TIMESTAMP '2024-01-16 00:00:00' and TIMESTAMP '2024-01-30 23:59:59' and coalesce(nodata, 100) < 5)
""",
        "select req_id, id, datetime from (select r.req_id, i.id, i.datetime, row_number() over "
        "(partition by r.req_id order by i.datetime desc, i.id) as rn from bb r join it i on "
        "i.min_lon <= r.max_lon and i.max_lon >= r.min_lon and i.min_lat <= r.max_lat and i.max_lat >= r.min_lat "
        "where r.error is null) where rn = 1",
        "bbox_args",
        "stac_items",
    ),
)
def q_j1(spark, sf):
    from drapekit.functions.bbox import parse_bbox_frame
    from drapekit.operators.catalog import catalog_predicate, nodata_filter
    from drapekit.operators.match import match_scenes

    req = parse_bbox_frame(fx.bbox_args(spark, sf)).filter(F.col("error").isNull()).drop("error")
    items = nodata_filter(catalog_predicate(_items(spark, sf), bbox=None, as_of=AS_OF, window_days=WINDOW))
    return match_scenes(req, items).select("req_id", "id", "datetime")


#: fixed values: footprints in tenths of an item's box (rings by kind): a rhombus, an L, a frame
SHAPES = {
    0: [[(5, 0), (10, 5), (5, 10), (0, 5)]],
    1: [[(0, 0), (10, 0), (10, 3), (3, 3), (3, 10), (0, 10)]],
    2: [[(0, 0), (10, 0), (10, 10), (0, 10)], [(2, 2), (2, 8), (8, 8), (8, 2)]],
}
#: fixed value: where footprints lie that cross the antimeridian (every fourth item)
CROSSING_WEST = 174.0


def _shape_edges() -> str:
    """Rows (kind, x0, y0, x1, y1) of the edges of SHAPES."""
    rows = [(k, *a, *b) for k, rings in SHAPES.items() for ring in rings for a, b in zip(ring, ring[1:] + ring[:1])]
    return ", ".join(str(tuple(map(float, r))) for r in rows)


SQL_SHAPES = f"""
, base as (select *, cast(split_part(id, '_', -1) as bigint) as eid from stac_items)
, placed as (select * replace (case when eid % 4 = 0 then {CROSSING_WEST} else min_lon end as min_lon) from base)
, shape(kind, sx0, sy0, sx1, sy1) as (values {_shape_edges()})
, edge as (select p.id, min_lon + sx0 as x0, min_lat + sy0 as y0, min_lon + sx1 as x1, min_lat + sy1 as y1 from placed p join shape s on s.kind = p.eid % 3)
"""


def _sql_meets(pairs: str) -> str:
    """Ids of ``pairs`` (key, id, q_x0, q_y0, q_x1, q_y1) whose footprint meets the box: by a point
    of an edge in the box or a crossing of its sides (cut parameters), or a corner inside."""
    return f"""
, turned as (select key, p.id, q_x0 + t as q_x0, q_y0, q_x1 + t as q_x1, q_y1, x0, y0, x1, y1, t
   from {pairs} p join edge e on e.id = p.id, (values (0.0), (360.0), (-360.0)) turn(t))
, cut as (select *, x1 - x0 as dx, y1 - y0 as dy from turned)
, span as (select *,
    case when dx = 0 then (case when x0 between q_x0 and q_x1 then 0.0 else 2.0 end) else least((q_x0 - x0) / dx, (q_x1 - x0) / dx) end as u0,
    case when dx = 0 then (case when x0 between q_x0 and q_x1 then 1.0 else -2.0 end) else greatest((q_x0 - x0) / dx, (q_x1 - x0) / dx) end as u1,
    case when dy = 0 then (case when y0 between q_y0 and q_y1 then 0.0 else 2.0 end) else least((q_y0 - y0) / dy, (q_y1 - y0) / dy) end as v0,
    case when dy = 0 then (case when y0 between q_y0 and q_y1 then 1.0 else -2.0 end) else greatest((q_y0 - y0) / dy, (q_y1 - y0) / dy) end as v1,
    (y0 > q_y0) <> (y1 > q_y0) and q_x0 > x0 + dx * (q_y0 - y0) / nullif(dy, 0) as west
  from cut)
, met as (select key, id from (
    select key, id, t, bool_or(greatest(u0, v0, 0.0) <= least(u1, v1, 1.0)) as touch, count(*) filter (west) % 2 = 1 as inside from span group by key, id, t)
  group by key, id having bool_or(touch or inside))
"""


def _with_shapes(items):
    """Items with a GeoJSON polygon made from their box; longitudes past 180 go on at -180."""
    from drapekit.functions.footprint import with_footprint

    eid = F.element_at(F.split("id", "_"), -1).cast("bigint")
    west = F.when(eid % 4 == 0, F.lit(CROSSING_WEST)).otherwise(F.col("min_lon"))

    def point(p):
        x, y = west + float(p[0]), F.col("min_lat") + float(p[1])
        return F.array(F.when(x > 180, x - 360).otherwise(x), y)

    text = None
    for kind, rings in SHAPES.items():
        closed = F.array(*[F.array(*[point(p) for p in [*ring, ring[0]]]) for ring in rings])
        geojson = F.to_json(F.struct(F.lit("Polygon").alias("type"), closed.alias("coordinates")))
        text = F.when(eid % 3 == kind, geojson) if text is None else text.when(eid % 3 == kind, geojson)
    return with_footprint(items.withColumn("geometry", text)).drop("geometry")


@register(
    "j1_match_footprints",
    _cte_query(
        SQL_BBOX_PARSED
        + SQL_SHAPES
        + """
, it as (select * from stac_items where collection = 'sentinel-2-l2a' and cloud_cover < 20
  and datetime between TIMESTAMP '2024-01-16 00:00:00' and TIMESTAMP '2024-01-30 23:59:59' and coalesce(nodata, 100) < 5)
, asked as (select r.req_id as key, i.id, r.min_lon as q_x0, r.min_lat as q_y0, r.max_lon as q_x1, r.max_lat as q_y1 from bb r, it i where r.error is null)
"""
        + _sql_meets("asked"),
        "select req_id, id, datetime from (select key as req_id, id, datetime, row_number() over (partition by key order by datetime desc, id) as rn "
        "from met join it using (id)) where rn = 1",
        "bbox_args",
        "stac_items",
    ),
)
def q_j1_footprints(spark, sf):
    """The newest item per request by polygons: convex, concave, with a hole, across the antimeridian."""
    from drapekit.functions.bbox import parse_bbox_frame
    from drapekit.operators.catalog import catalog_predicate, nodata_filter
    from drapekit.operators.match import match_scenes

    req = parse_bbox_frame(fx.bbox_args(spark, sf)).filter(F.col("error").isNull()).drop("error")
    items = nodata_filter(catalog_predicate(_items(spark, sf), bbox=None, as_of=AS_OF, window_days=WINDOW))
    return match_scenes(req, _with_shapes(items), footprint="footprint").select("req_id", "id", "datetime")


#: fixed value: a small search box near the antimeridian, inside some frames' holes
FOOTPRINT_BOX = (177.0, -5.0, 179.5, 4.5)


@register(
    "p5_footprint_predicate",
    _cte_query(
        "asked0 as (select 1)" + SQL_SHAPES
        + ", asked as (select 0 as key, id, {} as q_x0, {} as q_y0, {} as q_x1, {} as q_y1 from stac_items)".format(*FOOTPRINT_BOX)
        + _sql_meets("asked"),
        "select id from met",
        "stac_items",
    ),
)
def q_p5_footprint(spark, sf):
    """Every item whose polygon meets one box."""
    from drapekit.functions.footprint import footprint_predicate

    return footprint_predicate(_with_shapes(_items(spark, sf)), FOOTPRINT_BOX).select("id")


# ---------------------------------------------------------------------------------------
# Crop and merge

TARGET_PTS = "x between 200000 and 210000 and y between 700 and 750"
TARGET_LI = "x between 20000 and 21000 and y between 700 and 750"
PT = ["pid", "x", "y", "z", "red", "green", "blue"]


def _sql_box(src: str, cond: str, name: str) -> str:
    return f"""
, {name}_t as (select min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from {src} where {cond})
, {name} as (select x0 - 2.0 * (x1 - x0) as x_min, x1 + 2.0 * (x1 - x0) as x_max,
                    y0 - 2.0 * (y1 - y0) as y_min, y1 + 2.0 * (y1 - y0) as y_max from {name}_t)
"""


def _crop_sql(src: str, box: str) -> str:
    return f"select p.* from {src} p, {box} b where p.x >= b.x_min and p.x <= b.x_max and p.y >= b.y_min and p.y <= b.y_max"


def _pid_double(df):
    """Merged clouds hold NULL ids; a DOUBLE id compares the same way in both engines' pandas
    frames (a nullable BIGINT does not)."""
    return df.withColumn("pid", F.col("pid").cast("double"))


@register("a2_expanded_bbox", _cte_query(_sql_box("points", TARGET_PTS, "box"), "select * from box", "points"))
def q_a2(spark, sf):
    from drapekit.operators.aggregates import expanded_bbox

    return expanded_bbox(fx.points(spark, sf).filter(TARGET_PTS), margin=2.0)


@register("p20_bbox_crop", _cte_query(_sql_box("points", TARGET_PTS, "box"), _crop_sql("points", "box"), "points"))
def q_p20(spark, sf):
    from drapekit.operators.aggregates import expanded_bbox
    from drapekit.operators.geometry import bbox_crop

    pts = fx.points(spark, sf)
    return bbox_crop(pts, expanded_bbox(pts.filter(TARGET_PTS), margin=2.0))


@register(
    "u1_concat_clouds",
    with_views(
        "select cast(pid as double) as pid, x, y, z, red, green, blue from points union all "
        "select null::double as pid, x, y, z, red, green, blue from points_li",
        "points",
        "points_li",
    ),
)
def q_u1(spark, sf):
    from drapekit.operators.geometry import concat_clouds

    return _pid_double(concat_clouds([fx.points(spark, sf), fx.points_li(spark, sf)]).select(*PT))


@register(
    "q4_crop_and_merge",
    _cte_query(
        _sql_box("points", TARGET_PTS, "box") + _sql_box("points_li", TARGET_LI, "box_li"),
        f"select cast(pid as double) as pid, x, y, z, red, green, blue from ({_crop_sql('points', 'box')}) "
        f"union all select null::double as pid, x, y, z, red, green, blue from ({_crop_sql('points_li', 'box_li')})",
        "points",
        "points_li",
    ),
)
def q_q4(spark, sf):
    from drapekit.operators.aggregates import expanded_bbox
    from drapekit.operators.geometry import bbox_crop, crop_and_merge

    pts, li = fx.points(spark, sf), fx.points_li(spark, sf)
    li_cropped = bbox_crop(li, expanded_bbox(li.filter(TARGET_LI), margin=2.0))
    return _pid_double(crop_and_merge(pts, pts.filter(TARGET_PTS), others=[li_cropped], margin=2.0).select(*PT))


# ---------------------------------------------------------------------------------------
# A3 A4 G1 Q3 P13 P14 P15 P16 P17 P18 P19 P21

SQL_CENTER = """
, cs as (select avg(x) as cx, avg(y) as cy, avg(z) as cz, greatest(max(x) - avg(x), avg(x) - min(x),
    max(y) - avg(y), avg(y) - min(y), max(z) - avg(z), avg(z) - min(z)) as scale from points)
"""


@register(
    "a3_center_scale",
    _cte_query(SQL_CENTER, "select round(cx, 4) as cx, round(cy, 4) as cy, round(cz, 4) as cz, round(scale, 4) as scale from cs", "points"),
)
def q_a3(spark, sf):
    from drapekit.operators.aggregates import center_scale

    s = center_scale(fx.points(spark, sf))
    return s.select(*[F.round(c, 4).alias(c) for c in ("cx", "cy", "cz", "scale")])


def _sql_norm(src: str, extra_key: str = "") -> str:
    on = f" on p.{extra_key} = cs.{extra_key}" if extra_key else ""
    join = f"join cs{on}" if extra_key else ", cs"
    return (
        f"select {'p.' + extra_key + ', ' if extra_key else ''}p.pid, "
        + ", ".join(
            f"round(coalesce((p.{a} - cs.c{a}) / nullif(cs.scale, 0), 0.0), 7) as {a}" for a in ("x", "y", "z")
        )
        + ", "
        + ", ".join(f"greatest(0.0, least(1.0, p.{c} / 255.0)) as {c}" for c in ("red", "green", "blue"))
        + f" from {src} p {join}"
    )


def _round_xyz(df, digits=7):
    return df.select(*[F.round(c, digits).alias(c) if c in ("x", "y", "z") else F.col(c) for c in df.columns])


@register("g1_normalize_cloud", _cte_query(SQL_CENTER, _sql_norm("points"), "points"))
def q_g1(spark, sf):
    from drapekit.operators.geometry import normalize_cloud

    return _round_xyz(normalize_cloud(fx.points(spark, sf)))


@register(
    "q3_point_cloud_normalized",
    _cte_query(
        SQL_SAMPLED
        + """
, cs as (select scene_id, avg(x) as cx, avg(y) as cy, avg(z) as cz, greatest(max(x) - avg(x), avg(x) - min(x),
    max(y) - avg(y), avg(y) - min(y), max(z) - avg(z), avg(z) - min(z)) as scale from cloud group by scene_id)
""",
        _sql_norm("cloud", "scene_id"),
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_q3(spark, sf):
    from drapekit.operators.geometry import normalize_cloud

    return _round_xyz(normalize_cloud(_sampled(spark, sf).drop("k")))


@register(
    "a4_color_range",
    with_views(
        "select least(min(red), min(green), min(blue)) as color_min, greatest(max(red), max(green), max(blue)) as color_max from points",
        "points",
    ),
)
def q_a4(spark, sf):
    from drapekit.operators.aggregates import color_range

    return color_range(fx.points(spark, sf))


@register(
    "p13_normalize_rgb",
    with_views("select pid, red / 255.0 as red, green / 255.0 as green, blue / 255.0 as blue from points", "points"),
)
def q_p13(spark, sf):
    from drapekit.functions.colors import normalize_rgb

    p = fx.points(spark, sf)
    return p.select("pid", *[normalize_rgb(F.col(c)).alias(c) for c in ("red", "green", "blue")])


@register(
    "p14_clip_colors",
    with_views(
        "select pid, greatest(0.0, least(1.0, (red * 2 - 100) / 255.0)) as red, greatest(0.0, least(1.0, (green * 2 - 100) / 255.0)) as green, "
        "greatest(0.0, least(1.0, (blue * 2 - 100) / 255.0)) as blue from points",
        "points",
    ),
)
def q_p14(spark, sf):
    from drapekit.functions.colors import clip_color

    p = fx.points(spark, sf)
    return p.select("pid", *[clip_color(F.col(c) * 2 - 100).alias(c) for c in ("red", "green", "blue")])


SQL_EXPORT_POINTS = (
    "select cast(x as float) as x, cast(y as float) as y, cast(z as float) as z, "
    + ", ".join(_sql_u8(c) for c in ("red", "green", "blue"))
    + " from {src}, (select greatest(max(red), max(green), max(blue)) as m from {src})"
)


@register(
    "p15_quantize_u8",
    _cte_query(
        ", unit as (select pid, x, y, z, red / 255.0 as red, green / 255.0 as green, blue / 255.0 as blue from points)",
        SQL_EXPORT_POINTS.format(src="unit"),
        "points",
    ),
)
def q_p15(spark, sf):
    from drapekit.functions.colors import normalize_rgb
    from drapekit.functions.coords import export_frame

    p = fx.points(spark, sf)
    unit = p.select("pid", "x", "y", "z", *[normalize_rgb(F.col(c)).alias(c) for c in ("red", "green", "blue")])
    return export_frame(unit)


@register("p16_cast_coords", with_views(SQL_EXPORT_POINTS.format(src="points"), "points"))
def q_p16(spark, sf):
    from drapekit.functions.coords import export_frame

    return export_frame(fx.points(spark, sf))


@register("p17_resolve_color_columns", with_views(SQL_EXPORT_POINTS.format(src="points"), "points"))
def q_p17(spark, sf):
    from drapekit.functions.colors import pack_color
    from drapekit.functions.coords import export_frame

    p = fx.points(spark, sf)
    packed = p.select("pid", "x", "y", "z", pack_color(F.col("red"), F.col("green"), F.col("blue")).alias("color"))
    return export_frame(packed)


@register(
    "p18_resolve_normal_columns",
    with_views(
        "select cast(x as float) as x, cast(y as float) as y, cast(z as float) as z, "
        "cast(red / 255.0 as float) as nx, cast(green / 255.0 as float) as ny, cast(blue / 255.0 as float) as nz from points",
        "points",
    ),
)
def q_p18(spark, sf):
    from drapekit.functions.coords import export_frame

    p = fx.points(spark, sf)
    n = p.select(
        "x", "y", "z", *[(F.col(c) / 255.0).alias(f"normal_{a}") for c, a in (("red", "x"), ("green", "y"), ("blue", "z"))]
    )
    return export_frame(n)


@register(
    "p19_require_xyz",
    with_views(
        "select 'good' as frame, 'ok' as code, count(*) as n from points union all select 'no_z', 'missing z', count(*) from points "
        "union all select 'no_xy', 'missing x y', count(*) from points union all select 'empty', 'empty', count(*) from points where x is null",
        "points",
    ),
)
def q_p19(spark, sf):
    """One row per frame: what the check says of it, and its size."""
    from drapekit.functions.coords import CloudError, require_xyz

    p = fx.points(spark, sf)

    def code(df):
        try:
            require_xyz(df)
        except CloudError as e:
            missing = [c for c in "xyz" if f"'{c}'" in str(e)]
            return " ".join(["missing", *missing]) if missing else "empty"
        return "ok"

    frames = {"good": p, "no_z": p.drop("z"), "no_xy": p.drop("x", "y"), "empty": p.where("x is null")}
    out = None
    for name, df in frames.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("frame"), F.lit(code(df)).alias("code"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@register("p21_pack_color", with_views("select pid, red, green, blue from points", "points"))
def q_p21(spark, sf):
    """The elements of the packed array, read from a written frame."""
    from drapekit.functions.colors import pack_color
    from drapekit.operators.small import settled

    packed = settled(fx.points(spark, sf).select("pid", pack_color(F.col("red"), F.col("green"), F.col("blue")).alias("color")), "packed")
    return packed.select("pid", *[F.element_at("color", k).alias(c) for k, c in enumerate(("red", "green", "blue"), 1)])


# ---------------------------------------------------------------------------------------
# Grid surface over the sampled cloud

@register(
    "g3_triangulate_grid",
    _cte_query(
        SQL_SAMPLED
        + """
, v as (select distinct c.scene_id, c.pid, cast(m.width as bigint) as w, cast(m.height as bigint) as h
        from cloud c join raster_meta m on c.scene_id = m.scene_id)
, t as (select distinct scene_id, a, w from (
          select scene_id, w, h, unnest([pid, pid - 1, pid - w, pid - w - 1]) as a from v)
        where a >= 0 and a // w < h - 1 and a % w < w - 1)
, tri as (select scene_id, a, a + 1 as b, a + w as c from t
          union all select scene_id, a + 1 as a, a + w + 1 as b, a + w as c from t)
""",
        "select tri.* from tri where exists (select 1 from v where v.scene_id = tri.scene_id and v.pid = tri.a) "
        "and exists (select 1 from v where v.scene_id = tri.scene_id and v.pid = tri.b) "
        "and exists (select 1 from v where v.scene_id = tri.scene_id and v.pid = tri.c)",
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_g3(spark, sf):
    from drapekit.operators.geometry import triangulate_grid

    rows = fx.raster_rows(spark, sf)
    cells = fx.dem_cells(spark, sf)
    meta = fx.raster_meta(spark, sf, rows=rows)
    return triangulate_grid(_sampled(spark, sf), meta)


# a sample of 0.2 leaves few full pixel squares: blocks of 5 x 5 pixels are full almost always
SAMPLE_BLOCK = 5
SQL_SAMPLE_FACES = """
, v as (select c.scene_id, cast(ceil(m.width / 5.0) as bigint) as w, cast(ceil(m.height / 5.0) as bigint) as h,
          (c.pid // m.width) // 5 as r, (c.pid % m.width) // 5 as q, min(c.pid) as pid
        from cloud c join raster_meta m on c.scene_id = m.scene_id group by all)
, sq as (select p.scene_id, p.pid as p00, a.pid as p01, b.pid as p10, d.pid as p11
         from v p left join v a on a.scene_id = p.scene_id and a.r = p.r and a.q = p.q + 1
         left join v b on b.scene_id = p.scene_id and b.r = p.r + 1 and b.q = p.q
         left join v d on d.scene_id = p.scene_id and d.r = p.r + 1 and d.q = p.q + 1)
, hole as (select a.scene_id, a.pid as p01, b.pid as p10, d.pid as p11
           from v a join v b on b.scene_id = a.scene_id and b.r = a.r + 1 and b.q = a.q - 1
           join v d on d.scene_id = a.scene_id and d.r = a.r + 1 and d.q = a.q)
, faces as (select scene_id, p00 as a, p01 as b, p10 as c from sq where p01 is not null and p10 is not null
            union all select scene_id, p01 as a, p11 as b, p10 as c from hole)
"""


def _sample_faces(spark, sf, cloud):
    from drapekit.operators.geometry import triangulate_grid

    rows = fx.raster_rows(spark, sf)
    return triangulate_grid(cloud, fx.raster_meta(spark, sf, rows=rows), block=SAMPLE_BLOCK)


@register(
    "g3_triangulate_sample",
    _cte_query(SQL_SAMPLED + SQL_SAMPLE_FACES, "select scene_id, a, b, c from faces", "raster_meta", "dem_cells", "raster_px"),
)
def q_g3_sample(spark, sf):
    return _sample_faces(spark, sf, _sampled(spark, sf))


@register("g3_delaunay_faces", None)
def q_g3_delaunay(spark, sf):
    """Delaunay triangles of every sampled pixel."""
    return _delaunay(spark, sf, _sampled(spark, sf))


def _delaunay(spark, sf, cloud):
    from drapekit.operators.delaunay import delaunay_surface
    from drapekit.operators.small import settled

    return delaunay_surface(cloud, settled(fx.raster_meta(spark, sf), "meta"))


# ---------------------------------------------------------------------------------------
# PLY export round trip; S2 S3 A6: objects

#: fixed values: scene ids that a path must not garble; scene 3 has none
ODD_SCENES = {0: "a/b", 1: "0012", 2: "50% +x", 3: None}


def _sql_odd(c: str) -> str:
    cases = " ".join(f"when {k} then {'null' if v is None else repr(v)}" for k, v in ODD_SCENES.items())
    return f"case {c} {cases} else 'scene ' || {c} end"


SQL_EXPORT_CLOUD = (
    ", cm as (select scene_id, greatest(max(red), max(green), max(blue)) as m from cloud group by scene_id)\n"
    f", export as (select {_sql_odd('c.scene_id')} as scene_id, cast(x as float) as x, cast(y as float) as y, cast(z as float) as z, "
    + ", ".join(_sql_u8(c) for c in ("red", "green", "blue"))
    + " from cloud c join cm on c.scene_id = cm.scene_id)"
)


def _odd_scenes(df):
    scene = F.concat(F.lit("scene "), F.col("scene_id").cast("string"))
    for k, v in ODD_SCENES.items():
        scene = F.when(F.col("scene_id") == k, F.lit(v).cast("string")).otherwise(scene)
    return df.withColumn("scene_id", scene)


def _written_cloud(spark, sf, form="ascii"):
    from drapekit.session import scratch_path
    from drapekit.sources.ply import write_ply

    return write_ply(_odd_scenes(_sampled(spark, sf)), scratch_path(spark, "ply"), form=form)


@register(
    "s6_write_ply",
    _cte_query(SQL_SAMPLED + SQL_EXPORT_CLOUD, "select coalesce(scene_id, '-') as scene_id, count(*) as points from export group by all", "raster_meta", "dem_cells", "raster_px"),
)
def q_s6(spark, sf):
    """Points per scene by the shards' headers."""
    from drapekit.sources.ply import NULL_SCENE, verify_output

    rep = verify_output(spark, _written_cloud(spark, sf).path)
    folder = F.regexp_extract("path", r"scene_id=([^/]*)/", 1)
    scene = F.when(folder == NULL_SCENE, "-").otherwise(F.url_decode(F.url_decode(folder)))
    return rep.groupBy(scene.alias("scene_id")).agg(F.sum("header_points").cast("long").alias("points"))


@register("s7_read_ply", _cte_query(SQL_SAMPLED + SQL_EXPORT_CLOUD, "select * replace (coalesce(scene_id, '-') as scene_id) from export", "raster_meta", "dem_cells", "raster_px"))
def q_s7(spark, sf):
    from drapekit.sources.ply import read_ply

    return read_ply(spark, _written_cloud(spark, sf).path).select("scene_id", "x", "y", "z", "red", "green", "blue").fillna("-", ["scene_id"])


@register("s7_read_ply_binary", _cte_query(SQL_SAMPLED + SQL_EXPORT_CLOUD, "select * replace (coalesce(scene_id, '-') as scene_id) from export", "raster_meta", "dem_cells", "raster_px"))
def q_s7_binary(spark, sf):
    """Binary shards, read in byte ranges."""
    from drapekit.sources.ply import read_ply

    got = read_ply(spark, _written_cloud(spark, sf, "binary_little_endian").path, range_bytes=1 << 20)
    return got.select("scene_id", "x", "y", "z", "red", "green", "blue").fillna("-", ["scene_id"])


@register(
    "s7_read_scene",
    _cte_query(SQL_SAMPLED + SQL_EXPORT_CLOUD, "select scene_id, count(*) as points, sum(red)::bigint as red from export where scene_id in ('0012', '50% +x') group by all", "raster_meta", "dem_cells", "raster_px"),
)
def q_s7_scene(spark, sf):
    """Two scenes' files through the data source; all others are left out."""
    import json

    from drapekit.sources.ply import FORMAT_NAME

    wanted = ["0012", "50% +x"]
    read = spark.read.format(FORMAT_NAME).option("scenes", json.dumps(wanted))
    got = read.load(_written_cloud(spark, sf).path).where(F.col("scene_id").isin(wanted))
    return got.groupBy("scene_id").agg(F.count(F.lit(1)).alias("points"), F.sum("red").alias("red"))


@register(
    "s8_verify_output",
    _cte_query(SQL_SAMPLED, "select count(*) as points, true as ok from cloud", "raster_meta", "dem_cells", "raster_px"),
)
def q_s8(spark, sf):
    """The shards against their headers and against the points counted in front of the writer."""
    from drapekit.sources.ply import verify_output, verify_summary

    out = _written_cloud(spark, sf)
    return verify_summary(verify_output(spark, out.path), expected=out.points).select("points", "ok")


@register(
    "q3_normalized_ply",
    _cte_query(
        SQL_SAMPLED
        + """
, cs as (select scene_id, avg(x) as cx, avg(y) as cy, avg(z) as cz, greatest(max(x) - avg(x), avg(x) - min(x),
    max(y) - avg(y), avg(y) - min(y), max(z) - avg(z), avg(z) - min(z)) as scale from cloud group by scene_id)
, unit as (select c.scene_id, (x - cx) / scale as x, (y - cy) / scale as y, (z - cz) / scale as z, red / 255.0 as red, green / 255.0 as green, blue / 255.0 as blue
    from cloud c join cs on c.scene_id = cs.scene_id)
""",
        "select scene_id, count(*) as points, true as ok, round(min(x), 4) as x_min, round(max(x), 4) as x_max, round(min(y), 4) as y_min, round(max(y), 4) as y_max, "
        "round(min(z), 4) as z_min, round(max(z), 4) as z_max, sum(cast(floor(red * 255) as bigint))::bigint as red from unit group by scene_id",
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_q3_ply(spark, sf):
    """Sample -> normalised -> PLY -> read back and checked, per scene."""
    from drapekit.operators.geometry import normalize_cloud
    from drapekit.session import scratch_path
    from drapekit.sources.ply import read_ply, verify_output, verify_summary, write_ply

    out = write_ply(normalize_cloud(_sampled(spark, sf).drop("k")), scratch_path(spark, "ply"))
    whole = verify_summary(verify_output(spark, out.path), expected=out.points).first()["ok"]
    ends = [f(c).alias(f"{c}_{n}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))]
    got = read_ply(spark, out.path).groupBy("scene_id").agg(F.count(F.lit(1)).alias("points"), *ends, F.sum("red").alias("red"))
    return got.withColumns({f"{c}_{n}": F.round(F.col(f"{c}_{n}").cast("double"), 4) for c in "xyz" for n in ("min", "max")}).withColumn("ok", F.lit(whole))


#: the tables' folder at the scale where results are compared
ORACLE_DIR = "/root/testdata/sf0.01"
SQL_FILES = f"(select parse_filename(filename) as name, size as bytes, md5(content) as md5 from read_blob('{ORACLE_DIR}/*.parquet'))"


@register("s2_read_ranges", f"select name, bytes, md5 from {SQL_FILES}")
def q_s2_ranges(spark, sf):
    """The same digests from the objects' blocks, in the order of their place."""
    from drapekit.sources.object_ranges import largest_object, object_digests, read_ranges

    blocks = functools.partial(read_ranges, spark, sf, "*.parquet", 1 << 18, 1 << 20)
    found = object_digests(lambda span: blocks(span=span), largest_object(sf, "*.parquet"))
    return found.select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "bytes", "md5")


@register("s2_read_objects", f"select name, bytes, md5 from {SQL_FILES}")
def q_s2(spark, sf):
    """Every object's content, by its digest: in blocks, so that no task reads a large object as a whole.
    In a store that only Spark's readers reach, an object is one row (2 GB at most)."""
    from drapekit.sources.fs import reads_ranges
    from drapekit.sources.object_ranges import BLOCK_BYTES, object_digests
    from drapekit.sources.objects import read_objects

    objects = functools.partial(read_objects, spark, sf, glob="*.parquet")
    if reads_ranges(sf):
        largest = objects().agg(F.max("length")).first()[0] or 0
        found = object_digests(lambda span: objects(block_bytes=BLOCK_BYTES, span=span).withColumnRenamed("length", "size"), largest)
    else:
        found = objects().select("path", F.col("length").alias("bytes"), F.md5("content").alias("md5"))
    return found.select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "bytes", "md5")


def _fetched(spark, sf):
    """The tables' files, referred to as objects of a bucket, and one reference without one."""
    from drapekit.session import scratch_path
    from drapekit.sources.objects import fetch_objects, object_manifest, read_objects

    names = read_objects(spark, sf, glob="*.parquet").select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"))
    refs = names.select(F.concat(F.lit("s3://tables/"), "name").alias("ref")).unionByName(names.groupBy().agg(F.max("name").alias("ref")))
    manifest = object_manifest(refs, roots={"tables": sf})
    out = scratch_path(spark, "objects")
    return out, fetch_objects(manifest, out, fail_fast=False)


@register("s3_fetch_objects", f"select name, bytes, md5, '' as error from {SQL_FILES} union all select max(name), -1, '', 'NO_BUCKET' from {SQL_FILES}")
def q_s3(spark, sf):
    """The copies' content, by its digest, and what could not be copied.  Copies are read in blocks: a
    row holds 2 GB at most."""
    from drapekit.sources.object_ranges import largest_object, object_digests, read_ranges

    out, done = _fetched(spark, sf)
    copies = object_digests(lambda span: read_ranges(spark, out, "*.parquet", span=span), largest_object(out, "*.parquet")).select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "md5")
    both = done.join(copies, "name", "left")
    md5 = F.when(F.col("error").isNull(), F.col("md5")).otherwise("")
    return both.select("name", F.coalesce("bytes", F.lit(-1).cast("long")).alias("bytes"), md5.alias("md5"), F.coalesce("error", F.lit("")).alias("error"))


@register("a6_batch_report", f"select count(*) + 1 as n_objects, count(*) as n_ok, 1::bigint as n_failed, sum(bytes)::bigint as total_bytes from {SQL_FILES}")
def q_a6(spark, sf):
    from drapekit.operators.aggregates import batch_report

    return batch_report(_fetched(spark, sf)[1])


# ---------------------------------------------------------------------------------------
# Neighbours, normals, surface

SQL_KNN = """
, nn as (
  select q.pid, min_by(p.pid, struct_pack(d := (q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y) + (q.z - p.z) * (q.z - p.z),
                                        i := p.pid), 30) as nbrs
  from points q, points p group by q.pid)
"""


@register(
    "g2_knn",
    _cte_query(
        SQL_KNN,
        "select pid, unnest(nbrs) as nbr, cast(unnest(generate_series(1, len(nbrs))) as integer) as rank from nn",
        "points",
    ),
)
def q_g2_knn(spark, sf):
    from drapekit.operators.normals import knn

    return knn(fx.points(spark, sf), k=30).select("pid", "nbr", "rank")


@register("g2_estimate_normals")
def q_g2(spark, sf):
    from drapekit.operators.normals import estimate_normals

    return estimate_normals(fx.points(spark, sf), k=30).select("pid", "nx", "ny", "nz")


@register(
    "g2_covariance",
    _cte_query(
        SQL_KNN + ", pair as (select n.pid, p.x, p.y, p.z from (select pid, unnest(nbrs) as nbr from nn) n join points p on p.pid = n.nbr)",
        "select pid, " + ", ".join(f"round(covar_pop({a}, {b}) + 0.00137, 2) as c{a}{b}" for a, b in ("xx", "xy", "xz", "yy", "yz", "zz")) + " from pair group by pid",
        "points",
    ),
)
def q_g2_cov(spark, sf):
    """The matrices whose smallest eigenvectors are the normals.  Rounded off the half-way values
    that exact prices give."""
    from drapekit.operators.normals import knn, neighbour_covariance

    cov = neighbour_covariance(knn(fx.points(spark, sf), k=30))
    return cov.select("pid", *[F.round(F.col(c) + 0.00137, 2).alias(c) for c in cov.columns if c != "pid"])


@register(
    "g2_normals_of_sample",
    _cte_query(
        SQL_SAMPLED,
        "select scene_id, pid, count(*) as n, true as unit, true as upward from cloud group by scene_id, pid",
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_g2_sample(spark, sf):
    """Normals of a sample with repeats: as many rows as went in, unit length, not downward."""
    from drapekit.operators.normals import estimate_normals

    out = estimate_normals(_sampled(spark, sf), k=30)
    length = sum((F.col(c).cast("double") * F.col(c).cast("double") for c in ("nx", "ny", "nz")), F.lit(0.0))
    return out.groupBy("scene_id", "pid").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.abs(length - 1) < 1e-5).alias("unit"), F.bool_and(F.col("nz") >= 0).alias("upward")
    )


def _surface(spark, sf):
    """The cloud that a user has: sampled, then normalised, with normals."""
    from drapekit.operators.geometry import normalize_cloud
    from drapekit.operators.normals import estimate_normals

    return estimate_normals(normalize_cloud(_sampled(spark, sf).drop("k")), k=30)


@register(
    "q5_surface_vertices",
    _cte_query(
        SQL_SAMPLED
        + """
, cs as (select scene_id, avg(x) as cx, avg(y) as cy, avg(z) as cz, greatest(max(x) - avg(x), avg(x) - min(x),
    max(y) - avg(y), avg(y) - min(y), max(z) - avg(z), avg(z) - min(z)) as scale from cloud group by scene_id)
""",
        _sql_norm("cloud", "scene_id"),
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_q5v(spark, sf):
    """Vertices of the surface (their normals are checked by the g2 queries)."""
    return _round_xyz(_surface(spark, sf).drop("nx", "ny", "nz"))


@register(
    "q5_surface_faces",
    _cte_query(SQL_SAMPLED + SQL_SAMPLE_FACES, "select scene_id, a, b, c from faces", "raster_meta", "dem_cells", "raster_px"),
)
def q_q5f(spark, sf):
    """One chain: sample, normalise, normals, faces; an empty surface is an error."""
    from drapekit.operators.geometry import require_faces
    from drapekit.operators.small import settled

    return require_faces(settled(_sample_faces(spark, sf, _surface(spark, sf)), "faces"))


#: squared circumradius up to which SQL finds the triangles too (their corners are within 8 pixels)
SMALL_CIRCLE = 15.99
SQL_DELAUNAY = f"""
, p as (select distinct c.scene_id, c.pid, c.pid % m.width as x, c.pid // m.width as y from cloud c join raster_meta m on c.scene_id = m.scene_id)
, ends as (select scene_id, x, y from p qualify y = min(y) over (partition by scene_id, x) or y = max(y) over (partition by scene_id, x))
, hull as (select a.scene_id, a.x as x1, a.y as y1, b.x as x2, b.y as y2 from ends a join ends b on a.scene_id = b.scene_id and (a.x <> b.x or a.y <> b.y)
           where not exists (select 1 from ends c where c.scene_id = a.scene_id and ((b.x - a.x) * (c.y - a.y) < (b.y - a.y) * (c.x - a.x)
             or ((b.x - a.x) * (c.y - a.y) = (b.y - a.y) * (c.x - a.x) and (a.x - c.x) * (b.x - c.x) + (a.y - c.y) * (b.y - c.y) > 0))))
, rim as (select scene_id, count(distinct pid) as h from p join hull using (scene_id) where (x2 - x1) * (y - y1) = (y2 - y1) * (x - x1) group by scene_id)
, area as (select scene_id, sum(x1 * y2 - y1 * x2) as twice_area from hull group by scene_id)
, near as (select a.scene_id, a.pid as a, b.pid as b, b.x - a.x as ux, b.y - a.y as uy from p a join p b on a.scene_id = b.scene_id and a.pid <> b.pid
           where abs(b.x - a.x) <= 8 and abs(b.y - a.y) <= 8)
, side as (select n.scene_id, n.a, n.b, c.b as c, n.ux, n.uy, n.ux * c.uy - n.uy * c.ux as cr, c.ux * (c.ux - n.ux) + c.uy * (c.uy - n.uy) as dot
           from near n join near c on n.scene_id = c.scene_id and n.a = c.a and n.b <> c.b)
, edge as (select scene_id, a, b, ux, uy, min(dot / cr) filter (cr > 0) as t, min(-dot / cr) filter (cr < 0) as o, bool_or(cr = 0 and dot < 0) as blocked
           from side group by scene_id, a, b, ux, uy)
, small as (select s.scene_id, min(s.c) as a, s.a as b, s.b as c from side s join edge e on e.scene_id = s.scene_id and e.a = s.a and e.b = s.b
            where cr > 0 and dot / cr = t and not blocked and (o is null or t + o > 0) and (e.ux * e.ux + e.uy * e.uy) * (1 + t * t) / 4 <= {SMALL_CIRCLE}
            group by s.scene_id, s.a, s.b having min(s.c) < least(s.a, s.b))
, smalls as (select scene_id, count(*) as small_faces, sum(a)::bigint as small_a, sum(b)::bigint as small_b, sum(c)::bigint as small_c from small group by scene_id)
, counts as (select scene_id, count(*) as vertices from p group by scene_id)
"""


@register(
    "q5_delaunay_report",
    _cte_query(
        SQL_SAMPLED + SQL_DELAUNAY,
        "select scene_id, vertices, 2 * vertices - 2 - h as faces, twice_area::bigint as twice_area, small_faces, small_a, small_b, small_c "
        "from counts join rim using (scene_id) join area using (scene_id) join smalls using (scene_id)",
        "raster_meta",
        "dem_cells",
        "raster_px",
    ),
)
def q_q5_delaunay(spark, sf):
    """Sample, normalise, Delaunay faces, then per scene: vertices used, faces, the area they cover
    (twice, in pixels), and number and corners of the faces with a small circle."""
    from drapekit.operators.geometry import normalize_cloud, require_faces
    from drapekit.operators.small import settled

    faces = require_faces(settled(_delaunay(spark, sf, normalize_cloud(_sampled(spark, sf).drop("k"))), "faces"))
    width = settled(fx.raster_meta(spark, sf), "meta").select("scene_id", F.col("width").cast("long").alias("w"))
    f = faces.join(width, "scene_id")
    at = {c: (F.col(c) % F.col("w"), F.floor(F.col(c) / F.col("w"))) for c in "abc"}

    def sides(i, j):
        return at[j][0] - at[i][0], at[j][1] - at[i][1]

    def squared(i, j):
        dx, dy = sides(i, j)
        return dx * dx + dy * dy

    (ux, uy), (vx, vy) = sides("a", "b"), sides("a", "c")
    f = f.withColumn("cr", ux * vy - uy * vx)
    small = (squared("a", "b") * squared("b", "c") * squared("c", "a")).cast("double") <= SMALL_CIRCLE * 4 * F.col("cr") * F.col("cr")
    corners = faces.select("scene_id", F.explode(F.array("a", "b", "c")).alias("pid")).distinct().groupBy("scene_id").agg(F.count(F.lit(1)).alias("vertices"))
    sums = [F.sum(F.when(small, F.col(c))).alias(f"small_{c}") for c in "abc"]
    report = f.groupBy("scene_id").agg(F.count(F.lit(1)).alias("faces"), F.sum("cr").alias("twice_area"), F.count_if(small).alias("small_faces"), *sums)
    return report.join(corners, "scene_id").select("scene_id", "vertices", "faces", "twice_area", "small_faces", *[f"small_{c}" for c in "abc"])


# ---------------------------------------------------------------------------------------
# P9 / P12 on their own (the image-points query above chains both)

@register(
    "p9_flip_vertical",
    with_views(
        "select p.scene_id, cast(m.height - 1 - p.row_idx as integer) as row_idx, p.col_idx, p.red, p.green, p.blue "
        "from raster_px p join raster_meta m on p.scene_id = m.scene_id",
        "raster_px",
        "raster_meta",
    ),
)
def q_p9_flip(spark, sf):
    from drapekit.functions.grid import flipped_row
    from drapekit.operators.small import settled
    from drapekit.sources.raster import interleave_bands

    rows = fx.raster_rows(spark, sf)
    # settled: else the planner may take the pixels for the smaller side and send them to the driver
    meta = settled(fx.raster_meta(spark, sf, rows=rows).select("scene_id", "height"), "meta")
    px = interleave_bands(rows).join(meta, "scene_id")
    return px.select("scene_id", flipped_row(F.col("row_idx"), F.col("height")).alias("row_idx"), "col_idx", "red", "green", "blue")


@register(
    "p12_point_id",
    with_views(
        "select p.scene_id, cast(p.row_idx as bigint) * m.width + p.col_idx as pid, p.row_idx, p.col_idx "
        "from raster_px p join raster_meta m on p.scene_id = m.scene_id",
        "raster_px",
        "raster_meta",
    ),
)
def q_p12(spark, sf):
    from drapekit.functions.grid import point_id
    from drapekit.operators.small import settled
    from drapekit.sources.raster import interleave_bands

    rows = fx.raster_rows(spark, sf)
    # settled: else the planner may take the pixels for the smaller side and send them to the driver
    meta = settled(fx.raster_meta(spark, sf, rows=rows).select("scene_id", "width"), "meta")
    px = interleave_bands(rows).join(meta, "scene_id")
    return px.select("scene_id", point_id(F.col("row_idx"), F.col("col_idx"), F.col("width")), "row_idx", "col_idx")
