"""Composed jobs, sinks and the driver contract."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from drapekit import fixtures as fx
from drapekit.plans.point_cloud import draped_cloud

from conftest import SF001


def _inputs(spark):
    rows = fx.raster_rows(spark, SF001)
    return fx.raster_meta(spark, SF001, rows=rows), rows, fx.dem_cells(spark, SF001), fx.dem_axes(spark, SF001)


def test_many_scenes_equal_union_of_single_runs(spark):
    meta, rows, cells, axes = _inputs(spark)
    whole = draped_cloud(meta, rows, cells, fraction=None, axes=axes).toPandas()
    sizes = {r["scene_id"]: r["width"] * r["height"] for r in meta.collect()}
    assert len(sizes) == fx.SCENES and whole.groupby("scene_id").size().to_dict() == sizes
    for s in (0, 7, 23):
        own = [d.where(F.col("scene_id") == s) for d in (meta, rows, cells, *axes)]
        one = draped_cloud(*own[:3], fraction=None, axes=own[3:]).toPandas()
        a = whole[whole.scene_id == s].sort_values("pid").reset_index(drop=True)
        b = one.sort_values("pid").reset_index(drop=True)
        assert a.equals(b[a.columns])


def test_sampled_cloud_size(spark):
    meta, rows, cells, axes = _inputs(spark)
    cloud = draped_cloud(meta, rows, cells, fraction=0.2, seed=42, axes=axes)
    assert cloud.count() == sum(round(0.2 * m["width"] * m["height"]) for m in meta.collect())


def test_holes_and_missing_bands_raise_or_stay(spark):
    meta, rows, cells, axes = _inputs(spark)
    holes = cells.where("floor(dem * 100) % 10 <> 3")
    torn = rows.where("not (scene_id = 3 and band = 1 and row_idx = 0)")
    n = sum(m["width"] * m["height"] for m in meta.collect())
    for fraction in (None, 0.5):
        for args, what in (((meta, rows, holes), "no elevation"), ((meta, torn, cells), "without all bands")):
            with pytest.raises(Exception, match=what):
                draped_cloud(*args, fraction=fraction, axes=axes).write.format("noop").mode("overwrite").save()
    kept = draped_cloud(meta, rows, holes, fraction=None, axes=axes, missing="null")
    assert kept.count() == n and 0 < kept.where("z is null").count() < n / 2
    kept = draped_cloud(meta, torn, cells, fraction=None, axes=axes, missing="null")
    assert kept.count() == n and kept.where("green is null").count() == kept.where("scene_id = 3 and green is null").count() == 13
    short = rows.where("not (scene_id = 3 and row_idx = 0)")
    assert draped_cloud(meta, short, cells, fraction=None, axes=axes, missing="null").where("red is null").count() == 13


def test_label_range_reaches_the_scan(spark, tmp_path):
    from drapekit.sources.dem import read_dem

    meta, rows, cells, axes = _inputs(spark)
    cells.write.parquet(str(tmp_path / "dem"))
    own = [d.where("scene_id in (3, 4)") for d in (meta, rows, *axes)]
    cloud = draped_cloud(own[0], own[1], read_dem(spark, str(tmp_path / "dem")), fraction=None, axes=own[2:])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = cloud._jdf.queryExecution().explainString(mode)
    pushed = " ".join(ln for ln in plan.splitlines() if "PushedFilters" in ln)
    for f in ("GreaterThanOrEqual(x,3000.0", "LessThanOrEqual(x,4110.0", "GreaterThanOrEqual(y", "LessThanOrEqual(y"):
        assert f in pushed, pushed


ODD = ["a/b", "0012", "50% +x", None, "", "é", "x=1"]


def _odd_cloud(spark, copies=40):
    rows = [(s, float(k), float(k) / 3, None if k == 5 else 1.5, k % 256, 0, 255) for s in ODD for k in range(copies)]
    return spark.createDataFrame(rows, "scene_id string, x double, y double, z double, red int, green int, blue int").repartition(3)


def test_ply_round_trip_of_odd_scenes(spark, tmp_path):
    from drapekit.functions.coords import export_frame
    from drapekit.sources.ply import read_header, read_ply, verify_output, verify_summary, write_ply

    cloud, path = _odd_cloud(spark), str(tmp_path / "ply")
    for spill in (1 << 20, 100):  # the second takes the temporary-file path and overwrites
        out = write_ply(cloud, path, spill_bytes=spill)
        assert [n for n, _ in out.properties] == ["x", "y", "z", "red", "green", "blue"] and out.points == cloud.count()
        summary = verify_summary(verify_output(spark, path), expected=out.points).collect()[0]
        assert summary["ok"] and summary["points"] == out.points
        key = lambda r: tuple((v is None or v != v, str(v)) for v in r)
        want = sorted(map(key, export_frame(cloud).collect()))
        back = read_ply(spark, path).select("scene_id", "x", "y", "z", "red", "green", "blue")
        assert [t for _, t in back.dtypes[:2]] == ["string", "float"]
        got = sorted(key([None if isinstance(v, float) and v != v else v for v in r]) for r in back.collect())
        assert got == want
        assert not list((tmp_path / "ply").glob("_temporary"))
    shard = next((tmp_path / "ply" / "scene_id=0012").glob("*.ply"))
    assert read_header(str(shard))[1] == out.properties


def test_a_lost_point_is_noticed(spark, tmp_path):
    from drapekit.sources.ply import verify_output, verify_summary, write_ply

    path = str(tmp_path / "ply")
    out = write_ply(_odd_cloud(spark), path)
    shard = next((tmp_path / "ply" / "scene_id=0012").glob("*.ply"))
    lines = shard.read_text().splitlines(keepends=True)
    n = next(k for k, ln in enumerate(lines) if ln.startswith("element vertex"))
    # header and body agree, yet a point is gone
    lines[n] = f"element vertex {int(lines[n].split()[2]) - 1}\n"
    shard.write_text("".join(lines[:-1]))
    for crc in shard.parent.glob(".*.crc"):
        crc.unlink()
    report = verify_output(spark, path)
    assert all(r["ok"] for r in report.collect())
    assert verify_summary(report).collect()[0]["ok"] and not verify_summary(report, expected=out.points).collect()[0]["ok"]


def test_each_shard_is_typed_by_its_header_and_faces_are_passed_over(spark, tmp_path):
    from drapekit.sources.ply import read_ply

    head = "ply\nformat ascii 1.0\nelement vertex {n}\nproperty float x\nproperty float y\n{more}end_header\n"
    (tmp_path / "a.ply").write_text(head.format(n=1, more="property float z\n") + "1 2 3\n")
    (tmp_path / "b.ply").write_text(head.format(n=1, more="property uchar red\n") + "4 5 6\n")
    rows = read_ply(spark, str(tmp_path)).orderBy("x").collect()
    assert [(r["x"], r["z"], r["red"]) for r in rows] == [(1.0, 3.0, None), (4.0, None, 6)]
    (tmp_path / "c.ply").write_text(head.format(n=3, more="element face 1\nproperty list uchar int vertex_indices\n") + "1 2\n3 4\n5 6\n3 0 1 2\n")
    rows = read_ply(spark, str(tmp_path)).orderBy("x", "y").collect()
    assert [(r["x"], r["y"]) for r in rows] == [(1.0, 2.0), (1.0, 2.0), (3.0, 4.0), (4.0, 5.0), (5.0, 6.0)]


def test_write_ply_rejects_bad_input(spark, tmp_path):
    from drapekit.functions.coords import CloudError
    from drapekit.sources.ply import write_ply

    with pytest.raises(CloudError):
        write_ply(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), str(tmp_path / "a"))
    with pytest.raises(CloudError):
        write_ply(spark.createDataFrame([], "x double, y double, z double"), str(tmp_path / "b"))


def test_fetch_objects(spark, tmp_path):
    from drapekit.operators.aggregates import batch_report
    from drapekit.sources.objects import fetch_objects

    src = tmp_path / "src"
    src.mkdir()
    (src / "a.bin").write_bytes(b"x" * 100)
    (src / "b.bin").write_bytes(b"y" * 7)
    (src / "sub").mkdir()
    (src / "sub" / "a.bin").write_bytes(b"z" * 3)
    rows = [
        (str(src / "a.bin"), str(src / "a.bin"), "a.bin", None),
        (str(src / "sub" / "a.bin"), str(src / "sub" / "a.bin"), "a.bin", None),
        (str(src / "b.bin"), str(src / "b.bin"), "b.bin", None),
    ]
    m = spark.createDataFrame(rows, "ref string, src string, name string, error string")
    res = fetch_objects(m, str(tmp_path / "out"))
    got = {r["ref"]: (r["bytes"], r["error"]) for r in res.collect()}
    assert got[str(src / "b.bin")] == (7, None)
    assert got[str(src / "sub" / "a.bin")] == (3, None)  # the larger ref wins the shared name
    assert got[str(src / "a.bin")][1] == "SHADOWED"
    assert (tmp_path / "out" / "a.bin").read_bytes() == b"z" * 3
    rep = batch_report(res).collect()[0]
    assert (rep["n_objects"], rep["n_ok"], rep["total_bytes"]) == (3, 2, 10)
    missing = spark.createDataFrame([("nope", str(src / "nope.bin"), "nope.bin", None)], m.schema)
    with pytest.raises(RuntimeError):
        fetch_objects(missing, str(tmp_path / "out2"))
    assert fetch_objects(missing, str(tmp_path / "out3"), fail_fast=False).collect()[0]["error"] is not None


def test_scene_search_empty_when_nothing_matches(spark):
    from drapekit.plans.scene_search import scene_search

    items = fx.stac_items(spark, SF001)
    none = scene_search(items, bbox=(-30.0, -30.0, 60.0, 60.0), as_of="2020-01-01", window_days=14)
    assert none.count() == 0
    one = scene_search(items, bbox=(-30.0, -30.0, 60.0, 60.0), as_of="2024-01-30", window_days=30)
    assert one.count() == 1


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == fx.SCENES and all(r["num_points"] > 0 for r in rows)
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
    prefixes = {k.split("_")[0] for k in qs}
    for op in ["s1", "s2", "s3", "s4", "s5", "s6", "s7", "s8", "j1", "j2", "j3", "j4", "j5", "j6",
               "a1", "a2", "a3", "a4", "a5", "a6", "w1", "t1", "t2", "t3", "u1", "m1", "m2", "m3",
               "g1", "g2", "g3", "q1", "q2", "q3", "q4", "q5"]:
        assert op in prefixes, op


# queries that write or solve eagerly inside the call; their later plans read written tables
EAGER = {"s3_fetch_objects", "a6_batch_report", "s6_write_ply", "s7_read_ply", "s8_verify_output", "q3_normalized_ply",
         "g2_knn", "g2_estimate_normals", "g2_covariance", "g2_normals_of_sample", "q5_surface_vertices", "q5_surface_faces"}


def test_no_cartesian_plans(spark):
    """Scale guard: no registered query plans a cartesian product or a nested-loop join."""
    from conftest import SF01
    from drapekit.registry import QUERIES

    for name, fn in QUERIES.items():
        if name in EAGER:
            continue
        plan = fn(spark, SF01)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_catalogue_window_reaches_the_scan(spark):
    """The search window is a plain predicate on the item time, so it is pushed into the
    Parquet scan of the landed items."""
    import __spark_entry__ as E

    from conftest import SF01

    df = E.queries()["p5_catalog_predicate"](spark, SF01)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln]
    assert any("GreaterThanOrEqual(ts" in ln and "LessThanOrEqual(ts" in ln for ln in pushed), pushed


def test_read_dem_bounds_reach_the_scan(spark, tmp_path):
    from drapekit.sources.dem import read_dem

    path = str(tmp_path / "dem")
    fx.dem_cells(spark, SF001).write.parquet(path)
    cells = read_dem(spark, path, bounds=(0.0, 100.0, 5000.0, 300.0))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = cells._jdf.queryExecution().explainString(mode)
    pushed = " ".join(ln for ln in plan.splitlines() if "PushedFilters" in ln)
    for f in ("GreaterThanOrEqual(x", "LessThanOrEqual(x", "GreaterThanOrEqual(y", "LessThanOrEqual(y"):
        assert f in pushed, pushed
    r = cells.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).collect()[0]
    assert r[0] >= 0.0 and r[1] <= 5000.0 and r[2] >= 100.0 and r[3] <= 300.0


def test_observed_count_rides_along(spark, tmp_path):
    from drapekit.operators.aggregates import observed_count

    df, obs = observed_count(fx.points(spark, SF001), "n_points")
    df.write.parquet(str(tmp_path / "pts"))
    assert obs.get["n_points"] == 1500


def test_nothing_is_written_under_the_working_directory(spark):
    import os

    from conftest import SF001 as sf
    from drapekit.registry import QUERIES

    before = set(os.listdir("."))
    for name in ("s6_write_ply", "s1_read_catalog", "m1_dense_index", "s3_fetch_objects"):
        QUERIES[name](spark, sf).collect()
    assert set(os.listdir(".")) - before <= {".pytest_cache", "spark-warehouse"}


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    from drapekit import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
    path = session.scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    monkeypatch.setattr(session, "_SCRATCH", [path])
    session.drop_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
