"""Work that must be done once for each row, or by many tasks, as plans and task counts show it."""

from __future__ import annotations

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from drapekit import registry


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["p9_flip_vertical", "p12_point_id"])
def test_pixels_meet_settled_headers(spark, name):
    pixels = registry.QUERIES[name](spark, SF001)
    assert any("drapekit-meta-" in f for f in pixels.inputFiles())


def test_footprints_are_parsed_once(spark):
    plan = optimized(registry.QUERIES["p5_footprint_predicate"](spark, SF001))
    assert plan.count("from_json") == 2  # as a polygon and as several


def test_bbox_texts_are_parsed_once(spark):
    from drapekit.functions.bbox import parse_bbox_frame

    df = spark.createDataFrame([(1, "0,0,1,1"), (2, "x"), (3, None)], "req_id int, bbox string")
    valid = parse_bbox_frame(df).where("error is null")
    assert optimized(valid).lower().count("rlike") == 2  # a number, and nan
    assert sorted(map(tuple, valid.collect())) == [(1, 0.0, 0.0, 1.0, 1.0, None), (3, None, None, None, None, None)]
    assert {r.req_id: r.error for r in parse_bbox_frame(df).collect()} == {1: None, 2: "BAD_NUMBER", 3: None}


def test_mesh_of_one_image_is_made_by_many_tasks(spark):
    from drapekit.operators.drape import mesh_grid

    meta = spark.createDataFrame([(1, 3, 500), (2, 2, 2), (2, 1, 2), (3, 0, 4)], "scene_id int, width int, height int")
    xs = spark.createDataFrame([(1, c, c * 1.5) for c in range(3)] + [(2, 0, 9.0), (2, 1, 8.0), (3, 0, 1.0)], "scene_id int, col_idx int, x double")
    ys = spark.createDataFrame([(1, r, -float(r)) for r in range(500)] + [(2, 0, 5.0), (2, 0, 6.0), (2, 1, 7.0), (2, 2, 7.5)], "scene_id int, row_idx int, y double")
    mesh = mesh_grid(xs, ys, meta)
    want = [(1, r * 3 + c, r, c, c * 1.5, -float(r)) for r in range(500) for c in range(3)]
    # two headers of one scene: each gives its own pixels; a repeated row stays repeated
    for w in (2, 1):
        want += [(2, r * w + c, r, c, x, y) for r, y in ((0, 5.0), (0, 6.0), (1, 7.0)) for c, x in ((0, 9.0), (1, 8.0))[:w]]
    assert sorted(map(tuple, mesh.collect())) == sorted(want)
    assert mesh.groupBy(F.spark_partition_id()).count().count() > 4


def test_small_tiles_share_files(spark, tmp_path):
    from drapekit.operators.drape import resample_grid
    from drapekit.sources.dem import read_tiles, write_tiles

    cells = spark.range(4000).select(F.lit(7).alias("scene_id"), (F.col("id") % 8).cast("double").alias("x"), (F.floor(F.col("id") / 8) - 250).cast("double").alias("y"), F.col("id").cast("double").alias("dem"))
    path = str(tmp_path / "t")
    write_tiles(cells, path, side=4.0, target=1000)
    tiled = read_tiles(spark, path)
    assert tiled.tiles.count() == 252 and tiled.tiles.agg(F.sum("n")).first()[0] == 4000
    assert len(list((tmp_path / "t" / "cells").rglob("*.parquet"))) < 60
    meta = spark.createDataFrame([(7, 0.0, -250.0, 7.0, 249.0, 8, 500)], "scene_id int, lft double, btm double, rgt double, tp double, width int, height int")
    found = resample_grid(meta, tiled)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, resample_grid(meta, cells).collect())) and found.count() == 4000


def test_surface_of_an_image_over_32768_pixels_high(spark):
    import numpy as np

    from drapekit.operators.delaunay import delaunay_surface

    w, h = 3, 40_000
    pid = np.flatnonzero(np.random.default_rng(5).random(w * h) < 0.3)
    cloud = spark.createDataFrame([(1, int(p)) for p in pid], "scene_id int, pid long")
    got = delaunay_surface(cloud, spark.createDataFrame([(1, w, h)], "scene_id int, width int, height int")).collect()
    assert len({(t.a, t.b, t.c) for t in got}) == len(got)
    a, b, c = (np.array([t[k] for t in got]) for k in (1, 2, 3))
    cross = (b % w - a % w) * (c // w - a // w) - (b // w - a // w) * (c % w - a % w)
    assert (cross > 0).all() and set(np.r_[a, b, c]) == set(pid)
    # every edge but the hull's is met from both sides, and the number of faces follows from it
    edges = set(zip(np.r_[a, b, c].tolist(), np.r_[b, c, a].tolist()))
    assert len(edges) == 3 * len(got)
    hull = [(p, q) for p, q in edges if (q, p) not in edges]
    assert len(got) == 2 * len(pid) - 2 - len(hull)


def test_circles_are_compared_past_64_bits():
    import numpy as np

    from drapekit.operators.delaunay import triangles

    far = (1 << 19) - 1
    x, y = np.array([0, far, far, 0]), np.array([0, 0, far, far])
    assert triangles(x, y, np.arange(4), 1 << 20).tolist() == [[0, 1, 2], [0, 2, 3]]
    y = np.array([1, 0, far, far])
    assert {tuple(sorted(t)) for t in triangles(x, y, np.arange(4), 1 << 20).tolist()} == {(0, 1, 2), (0, 2, 3)}
    y = np.array([0, 1, far, far])
    assert {tuple(sorted(t)) for t in triangles(x, y, np.arange(4), 1 << 20).tolist()} == {(0, 1, 3), (1, 2, 3)}
