"""Work that must be spread or cut as the input grows (findings of round 3)."""

import hashlib
import json
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from pyspark.sql import functions as F


def _block(ties: bool):
    """A block of 8 x 8 cells of 60 points each, and its halo."""
    rng, side, n = np.random.default_rng(7), 100.0, 60 * 100
    xy = rng.uniform(-side, 9 * side, (n, 2))
    xyz = np.column_stack([xy, np.zeros(n)])
    if ties:
        xyz = np.round(xyz / 10) * 10
    cells, ids = np.floor(xyz / side).astype(np.int64), rng.permutation(n)
    own = ((cells[:, :2] >= 0) & (cells[:, :2] < 8)).all(axis=1)
    q = {"pid": ids[own], **{f"q{a}": xyz[own, j] for j, a in enumerate("xyz")}, "s": np.full(own.sum(), side), **{f"k{a}": cells[own, j] for j, a in enumerate("xyz")}}
    c = {"nbr": ids, **{f"n{a}": xyz[:, j] for j, a in enumerate("xyz")}, **{f"c{a}": cells[:, j] for j, a in enumerate("xyz")}}
    return pa.table(q), pa.table(c)


@pytest.mark.parametrize("ties", [False, True])
def test_block_solver_is_exact_with_few_distances(monkeypatch, ties):
    from drapekit.operators import normals

    seen, real = [], normals._row_topk
    monkeypatch.setattr(normals, "_row_topk", lambda d, kk: seen.append(d.size) or real(d, kk))
    q, c = _block(ties)
    got = normals._block_topk(30, [], False)(q, c)
    assert sorted(got["pid"].to_pylist()) == sorted(q["pid"].to_pylist())
    assert all(got["ok"].to_pylist())
    # 27 cells of full side hold nine times 60 points
    assert sum(seen) < 300 * q.num_rows
    ids = np.argsort(c["nbr"].to_numpy())
    at = np.column_stack([c[f"n{a}"].to_numpy() for a in "xyz"])[ids]
    for pid, nbr, d2 in list(zip(*(got[n].to_pylist() for n in ("pid", "nbr", "d2"))))[::37]:
        d = ((at - at[pid]) ** 2).sum(axis=1)
        best = np.argsort(d, kind="stable")[:30]
        assert nbr == best.tolist()
        assert np.allclose(d2, d[best])


def test_block_solver_without_enough_candidates():
    from drapekit.operators import normals

    q, c = _block(False)
    got = normals._block_topk(30, [], False)(q.slice(0, 5), c.slice(0, 3))
    assert not any(got["ok"].to_pylist())
    assert all(n == len(v) <= 3 for n, v in zip(got["n_found"].to_pylist(), got["nbr"].to_pylist()))


def test_cell_sizes_count_points_at_two_scales_only(spark):
    from drapekit.operators.normals import cell_sizes

    cloud = spark.range(4000).select(F.col("id").alias("pid"), (F.col("id") % 80).cast("double").alias("x"), F.floor(F.col("id") / 80).cast("double").alias("y"), F.lit(0.0).alias("z"))
    sizes = cell_sizes(cloud)
    plan = sizes._jdf.queryExecution().optimizedPlan().toString()
    # what meets the points is an array of two scales, not of nine
    assert "0.25" in plan and "2.8284271247461903" not in plan
    row = sizes.first()
    assert 60 <= 4000 / cloud.select(*[F.floor(F.col(c) / row.s) for c in "xyz"]).distinct().count() <= 240


def test_draws_are_many_tasks(spark):
    from drapekit.operators.sampling import DRAW_CHUNK, draws_with_replacement

    draws = draws_with_replacement(spark.createDataFrame([(0, 6 * DRAW_CHUNK)], "scene_id int, n_total long"), 1.0)
    per = draws.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per) == 6 * DRAW_CHUNK
    assert len(per) > 1


def test_axis_holds_the_width(spark):
    """The planner takes a join for the product of its sides: the settled axis must not be one."""
    from drapekit.operators.drape import resample_grid

    meta = spark.createDataFrame([(0, 0.0, 0.0, 20.0, 10.0, 5, 3)], "scene_id int, lft double, btm double, rgt double, tp double, width int, height int")
    cells = spark.createDataFrame([(0, x * 10.0, y * 5.0, x + y * 0.5) for x in range(3) for y in range(3)], "scene_id int, x double, y double, dem double")
    elev = resample_grid(meta, cells)
    files = elev.inputFiles()
    assert any("axis" in f for f in files) and not any("drapekit-meta" in f for f in files)
    assert elev.count() == 15


def test_small_ranges_share_tasks(spark, tmp_path):
    from drapekit.sources.features import read_features

    items = [{"type": "Feature", "id": f"i{k}", "properties": {"t": 'a\\"]{'}} for k in range(400)]
    for n, own in enumerate((items[:150], items[150:])):
        (tmp_path / f"c{n}.json").write_text(json.dumps({"type": "FeatureCollection", "features": own}))
    (tmp_path / "empty.json").write_text("")
    found = read_features(spark, str(tmp_path), range_bytes=100)
    assert found.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    got = [json.loads(r.value) for r in found.select("value").collect()]
    assert sorted(got, key=lambda f: int(f["id"][1:])) == items


def test_small_shards_share_tasks(spark, tmp_path):
    from drapekit.sources.ply import verify_output, write_ply

    scenes = 2 * spark.sparkContext.defaultParallelism + 20
    cloud = spark.range(3 * scenes).select((F.col("id") % scenes).cast("int").alias("scene_id"), *[F.col("id").cast("double").alias(c) for c in "xyz"])
    out = write_ply(cloud.coalesce(1), str(tmp_path / "ply"))
    report = verify_output(spark, out.path)
    assert report.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert [tuple(r) for r in report.groupBy("ok").agg(F.count(F.lit(1)), F.sum("points")).collect()] == [(True, scenes, 3 * scenes)]


def test_fetched_objects_may_be_larger_than_a_row(spark):
    """Spark refuses objects over a length as one row (2 GB at most); here the length is set low."""
    from drapekit import registry

    name = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(name, "100")
    try:
        got = registry.QUERIES["s3_fetch_objects"](spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.unset(name)
    assert sum(r.error == "" and len(r.md5) == 32 and r.bytes > 100 for r in got) == len(got) - 1


def test_objects_may_be_larger_than_a_row(spark):
    from drapekit import registry

    name = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(name, "100")
    try:
        got = registry.QUERIES["s2_read_objects"](spark, SF001).collect()
    finally:
        spark.conf.unset(name)
    files = {p.name: p.read_bytes() for p in Path(SF001).glob("*.parquet")}
    assert {r.name: (r.bytes, r.md5) for r in got} == {n: (len(c), hashlib.md5(c).hexdigest()) for n, c in files.items()}


def test_objects_in_a_store_that_only_spark_reads(spark):
    from drapekit import registry

    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.growth.link./in", f"file://{SF001}")
    query = registry.QUERIES["s2_read_objects"]
    assert sorted(query(spark, "viewfs://growth/in").collect()) == sorted(query(spark, SF001).collect())


@pytest.mark.parametrize("source", ["objects", "ranges"])
def test_no_task_reads_more_of_an_object_than_a_segment(spark, tmp_path, source):
    """Objects of up to nine segments, and on either side of a segment's end."""
    from drapekit.sources.object_ranges import largest_object, object_digests, read_ranges
    from drapekit.sources.objects import read_objects

    rng, segment = random.Random(5), 6400
    sizes = (1, 63, 64, 6399, 6400, 6401, 12_800, 12_801, 30_000, 50_001, 57_600)
    # Spark's readers list no empty objects
    contents = {f"{n}.bin": rng.randbytes(n) for n in (sizes if source == "objects" else (0, *sizes))}
    for n, c in contents.items():
        (tmp_path / n).write_bytes(c)
    (tmp_path / "_hidden.txt").write_text("not asked for")
    turns = []

    def blocks(span):
        if source == "objects":
            own = read_objects(spark, str(tmp_path), glob="*.bin", block_bytes=1000, span=span).withColumnRenamed("length", "size")
        else:
            own = read_ranges(spark, str(tmp_path), "*.bin", 1000, 2000, span)
        per_task = own.groupBy("path", F.spark_partition_id().alias("task")).agg(F.sum(F.length("content")).alias("n")).collect()
        assert len({r.path for r in per_task}) == len(per_task)  # an object's blocks are in one task
        turns.append(max(r.n for r in per_task))
        return own

    largest = largest_object(str(tmp_path), "*.bin")
    assert largest == 57_600
    want = {n: (len(c), hashlib.md5(c).hexdigest()) for n, c in contents.items()}
    got = object_digests(blocks, largest, segment).collect()
    assert {r.path.rpartition("/")[2]: (r.bytes, r.md5) for r in got} == want and len(got) == len(want)
    assert turns == [segment] * 9
    got = object_digests(blocks, largest).collect()
    assert {r.path.rpartition("/")[2]: (r.bytes, r.md5) for r in got} == want and len(got) == len(want)
    if source == "ranges":
        with pytest.raises(Exception, match="order of their place"):
            object_digests(lambda span: read_ranges(spark, str(tmp_path), "*.bin", 1000, 2000, span).where("place > 0"), largest).collect()


def test_md5_goes_on_from_its_state():
    from drapekit.sources import md5_state

    raw = random.Random(3).randbytes(64 * 40 + 17)
    for engine in (md5_state._Plain, md5_state._OpenSSL)[: 2 if md5_state._library() else 1]:
        for n in (0, 1, 55, 56, 63, 64, 65, 119, 120, 128, len(raw)):
            for cut in range(0, n + 1, 64):
                first = engine(md5_state.START, 0)
                first.update(raw[:cut])
                second = engine(first.state(), cut)
                mid = min(cut + 5, n)
                second.update(raw[cut:mid])
                second.update(raw[mid:n])
                assert second.hexdigest() == hashlib.md5(raw[:n]).hexdigest()
