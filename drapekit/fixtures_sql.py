"""The fixture views of ``drapekit.fixtures`` as DuckDB text, for the SQL oracle.

The oracle only has the base tables, so each query inlines the views it needs as CTEs
(``with_views``).  Only the views a query names are emitted, in dependency order.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "stac_items": """
select concat('S2_', cast(user_id as varchar), '_', event_type, '_', cast(event_id as varchar)) as id,
  case when event_type in ('view','click','purchase') then 'sentinel-2-l2a' else 'sentinel-2-l1c' end as collection,
  ts as datetime, value % 100 as cloud_cover,
  case when event_id % 7 = 0 then null else cast(json_extract_string(props, '$.k') as double) / 10 end as nodata,
  cast((user_id*37) % 340 - 170 as double) as min_lon, cast((user_id*13) % 160 - 80 as double) as min_lat,
  cast((user_id*37) % 340 - 160 as double) as max_lon, cast((user_id*13) % 160 - 70 as double) as max_lat,
  concat('s3://eodata/', event_type, '/', cast(event_id as varchar), '_TCI_20m.jp2') as tci_20m_href
from events""",
    "scene_orders": """
select o_orderkey as k, cast(o_orderkey % 24 as integer) as s, o_orderkey // 24 as i, o_totalprice, o_custkey,
  count(*) over (partition by o_orderkey % 24) as n
from orders""",
    "raster_rows": """
select s as scene_id, cast(i % 3 as integer) as band, cast(i // 3 as integer) as row_idx,
  list_transform(range(10 + s), lambda j: cast((k * 31 + o_custkey * 7 + j * 17) % 256 as integer)) as samples
from scene_orders where i < 3 * (n // 3)""",
    "raster_long": """
select scene_id, band, row_idx, cast(j - 1 as integer) as col_idx, samples[j] as val
from (select *, unnest(range(1, len(samples) + 1)) as j from raster_rows)""",
    "raster_px": """
select scene_id, row_idx, col_idx,
  max(case when band = 0 then val end) as red, max(case when band = 1 then val end) as green,
  max(case when band = 2 then val end) as blue
from raster_long group by scene_id, row_idx, col_idx having count(distinct band) = 3""",
    "dem_cells": """
select s as scene_id, cast(s * 1000 + (i % (s + 8)) * 10 as double) as x, cast(s * 100 + (i // (s + 8)) * 5 as double) as y,
  o_totalprice * 0.01 as dem
from scene_orders where i < (s + 8) * (n // (s + 8))""",
    "raster_meta": """
select b.scene_id, b.lft, b.btm, b.rgt, b.tp, c.width, c.height
from (select scene_id, min(x) as lft, min(y) as btm, max(x) as rgt, max(y) as tp from dem_cells group by scene_id) b
join (select scene_id, cast(max(len(samples)) as integer) as width, cast(max(row_idx) + 1 as integer) as height
      from raster_rows group by scene_id) c on b.scene_id = c.scene_id""",
    "points": """
select o_orderkey as pid, o_totalprice as x, cast(o_custkey as double) as y, o_totalprice * 0.001 + o_custkey as z,
  cast(o_orderkey % 256 as integer) as red, cast((o_orderkey * 7) % 256 as integer) as green,
  cast((o_orderkey * 13) % 256 as integer) as blue
from orders""",
    "points_li": """
select l_extendedprice as x, cast(l_partkey as double) as y, l_quantity + l_discount as z,
  cast(l_linenumber * 30 as integer) as red, cast(l_suppkey % 256 as integer) as green,
  cast(l_partkey % 256 as integer) as blue
from lineitem""",
    "object_refs": """
select page_id,
  case when page_id % 3 = 0 then regexp_replace(url, '^[a-z]+://[^/]*', '') else regexp_replace(url, '^[a-z]+://', 's3://') end as ref,
  case when page_id % 5 = 0 then 'eodata' else null end as bucket
from pages""",
    "bbox_args": """
select c_custkey as req_id, case c_custkey % 8
  when 0 then '3.2833,45.3833,11.2,50.1833' when 1 then '-20.383301, 64.222311, -17.329102, 64.92044'
  when 2 then '1,2,3' when 3 then 'a,b,c,d' when 4 then '-181,0,10,10' when 5 then '0,-91,10,10'
  when 6 then '10,0,10,10'
  else concat(cast(c_custkey % 170 as varchar), ',0,', cast(c_custkey % 170 + 5 as varchar), ',',
              cast(c_custkey % 80 + 1 as varchar)) end as bbox
from customer""",
}

# view -> views it reads
DEPENDS: dict[str, tuple[str, ...]] = {
    "raster_rows": ("scene_orders",),
    "dem_cells": ("scene_orders",),
    "raster_long": ("raster_rows",),
    "raster_px": ("raster_long",),
    "raster_meta": ("dem_cells", "raster_rows"),
}


def _ordered(names: tuple[str, ...] | list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with CTEs for ``views`` (and what they depend on).  Further CTEs of the
    query itself can follow as ``, name as (...)`` at the start of ``sql``."""
    parts = [f"{name} as ({VIEWS[name].strip()})" for name in _ordered(list(views))]
    body = sql.strip()
    if body.lower().startswith(","):
        return "with " + ",\n".join(parts) + "\n" + body
    return "with " + ",\n".join(parts) + "\n" + body
