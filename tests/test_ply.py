"""PLY: binary twins, ranges, elements beside the vertices, filters, manifest commits."""

from __future__ import annotations

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from drapekit.functions.coords import CloudError
from drapekit.sources import ply, ply_format as fmt


def cloud(spark, n=3000, scenes=4):
    rows = spark.range(n).select(
        F.when(F.col("id") % scenes == 3, None).otherwise(F.col("id") % scenes).alias("scene_id"),
        (F.col("id") / 7).alias("x"), (F.lit(1e7) / (F.col("id") + 1)).alias("y"), F.when(F.col("id") % 11 != 0, -F.col("id") / 3).alias("z"),
        (F.col("id") % 256).cast("int").alias("red"), F.lit(0).alias("green"), F.lit(255).alias("blue"),
    )
    return rows.repartition(3)


def rows_of(df):
    order = ["scene_id", "x", "y", "z", "red", "green", "blue"]
    return sorted((tuple("nan" if isinstance(v, float) and v != v else v for v in r) for r in df.select(*[c for c in order if c in df.columns]).collect()), key=str)


@pytest.mark.parametrize("form", ["binary_little_endian", "binary_big_endian"])
def test_binary_equals_its_text_twin_bit_for_bit(spark, tmp_path, form):
    text, binary = str(tmp_path / "t"), str(tmp_path / "b")
    a, b = ply.write_ply(cloud(spark), text), ply.write_ply(cloud(spark), binary, form=form)
    assert a.points == b.points == 3000
    left, right = ply.read_ply(spark, text), ply.read_ply(spark, binary, range_bytes=500)
    assert left.dtypes == right.dtypes and left.dtypes[0] == ("scene_id", "bigint")
    assert rows_of(left) == rows_of(right)
    for path in (text, binary):
        report = ply.verify_output(spark, path)
        assert ply.verify_summary(report, expected=3000).first()["ok"]


@pytest.mark.parametrize("form", sorted(fmt.FORMATS))
@pytest.mark.parametrize("wanted", [1, 37, 1000, 1 << 30])
def test_ranges_hold_every_vertex_once(spark, tmp_path, form, wanted):
    path = str(tmp_path / "one")
    ply.write_ply(cloud(spark, 200, 1).coalesce(1).drop("scene_id"), path, form=form)
    (shard,) = ply.shards_of(path)[1]
    header = shard.parsed()
    got = []
    with open(f"{path}/{shard.rel}", "rb") as f:
        parse = fmt.read_ascii if form == "ascii" else fmt.read_binary
        parts = fmt.ranges("x", header, shard.bytes, wanted)
        for part in parts:
            for columns in parse(f, header, part, 64):
                got += columns[3].to_pylist()
    assert sorted(got) == sorted(k % 256 for k in range(200))
    assert wanted != 1000 or len(parts) > 3


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "one")
    ply.write_ply(cloud(spark, 5000, 1).coalesce(1), path, form="binary_little_endian")
    df = ply.read_ply(spark, path, range_bytes=10_000)
    assert df.count() == 5000 and df.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    (shard,) = ply.shards_of(path)[1]
    assert ply.read_ply(spark, f"{path}/{shard.rel}").count() == 5000


FACES = "element face 2\nproperty list uchar int vertex_indices\n"
EDGES = "element edge 2\nproperty int a\nproperty int b\n"
XY = "element vertex 3\nproperty float x\nproperty uchar red\n"


@pytest.mark.parametrize("form", ["binary_little_endian", "binary_big_endian"])
def test_binary_files_with_other_elements(spark, tmp_path, form):
    mark = fmt.FORMATS[form]
    faces = b"".join(struct.pack(f"{mark}B3i", 3, 0, 1, 2) for _ in range(2))
    edges = b"".join(struct.pack(f"{mark}2i", k, 10) for k in range(2))
    body = b"".join(struct.pack(f"{mark}fB", k + 0.5, k) for k in range(3))
    (tmp_path / "after.ply").write_bytes(f"ply\nformat {form} 1.0\n{XY}{FACES}end_header\n".encode() + body + faces)
    (tmp_path / "between.ply").write_bytes(f"ply\nformat {form} 1.0\ncomment é\n{EDGES}{XY}{FACES}end_header\n".encode() + edges + body + faces)
    for name in ("after", "between"):
        got = sorted(map(tuple, ply.read_ply(spark, str(tmp_path / f"{name}.ply"), range_bytes=5).collect()))
        assert got == [(0.5, 0), (1.5, 1), (2.5, 2)]
    assert ply.verify_summary(ply.verify_output(spark, str(tmp_path))).first()["ok"]
    (tmp_path / "before.ply").write_bytes(f"ply\nformat {form} 1.0\n{FACES}{XY}end_header\n".encode() + faces + body)
    with pytest.raises(Exception, match="varying size"):
        ply.read_ply(spark, str(tmp_path / "before.ply")).collect()


def test_text_files_with_other_elements_and_odd_spaces(spark, tmp_path):
    body, faces = "0.5 0\n  1.5\t1 \r\n\n2.5   2\n", "3 0 1 2\n3 2 1 0\n"
    (tmp_path / "after.ply").write_text(f"ply\nformat ascii 1.0\n{XY}{FACES}end_header\n{body}{faces}".replace("\n\n", "\n"))
    (tmp_path / "before.ply").write_text(f"ply\nformat ascii 1.0\n{FACES}{XY}end_header\n{faces}{body}".replace("\n\n", "\n"))
    (tmp_path / "plain.ply").write_text(f"ply\nformat ascii 1.0\n{XY}end_header\n{body}")
    (tmp_path / "open.ply").write_text(f"ply\nformat ascii 1.0\n{XY}end_header\n0.5 0\n1.5 1\n2.5 2")
    for name in ("after", "before", "plain", "open"):
        for wanted in (3, 1 << 20):
            got = sorted(map(tuple, ply.read_ply(spark, str(tmp_path / f"{name}.ply"), range_bytes=wanted).collect()))
            assert got == [(0.5, 0), (1.5, 1), (2.5, 2)], (name, wanted)


def test_filter_on_scene_opens_only_its_files(spark, tmp_path):
    path = str(tmp_path / "ply")
    ply.write_ply(cloud(spark), path)
    for shard in ply.shards_of(path)[1]:
        if "scene_id=1/" not in shard.rel:
            (tmp_path / "ply" / shard.rel).write_bytes(b"broken")
    got = spark.read.format(ply.FORMAT_NAME).load(path).where("scene_id = 1")
    assert got.count() == 750
    with pytest.raises(Exception):
        spark.read.format(ply.FORMAT_NAME).load(path).where("scene_id = 2").collect()


@pytest.mark.parametrize("pushed", ["true", "false"])
def test_reader_works_with_and_without_filter_pushdown(spark, tmp_path, pushed):
    name = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, pushed)
    try:
        path = str(tmp_path / "ply")
        ply.write_ply(cloud(spark), path)
        assert ply.read_ply(spark, path).count() == 3000
        got = ply.read_ply(spark, path).where("scene_id = 1 or scene_id is null")
        assert got.count() == 1500 and got.select("scene_id").distinct().count() == 2
        assert ply.read_ply(spark, path).where("scene_id is null").count() == 750
    finally:
        spark.conf.set(name, before)
        ply.register_ply(spark)


def test_scenes_option_opens_only_their_files(spark, tmp_path):
    path = str(tmp_path / "ply")
    ply.write_ply(cloud(spark), path)
    for shard in ply.shards_of(path)[1]:
        if "scene_id=1/" not in shard.rel and ply.NULL_SCENE not in shard.rel:
            (tmp_path / "ply" / shard.rel).write_bytes(b"broken")
    got = spark.read.format(ply.FORMAT_NAME).option("scenes", '["1", null]').load(path)
    assert got.count() == 1500 and got.where("scene_id = 1").count() == 750
    assert spark.read.format(ply.FORMAT_NAME).option("scenes", "[]").load(path).count() == 0


def test_reader_equals_read_ply(spark, tmp_path):
    path = str(tmp_path / "ply")
    ply.write_ply(cloud(spark), path)
    assert rows_of(spark.read.format("drapekit_ply").load(path)) == rows_of(ply.read_ply(spark, path))


def files(folder):
    return {p.relative_to(folder).as_posix(): p.read_bytes() for p in folder.rglob("*") if p.is_file()}


def test_a_refused_write_leaves_the_old_output(spark, tmp_path):
    path = tmp_path / "ply"
    ply.write_ply(cloud(spark), str(path))
    before = files(path)
    with pytest.raises(CloudError):
        ply.write_ply(cloud(spark).where("x < 0"), str(path))
    assert files(path) == before and ply.read_ply(spark, str(path)).count() == 3000


def test_a_failed_write_leaves_the_old_output(spark, tmp_path):
    path = tmp_path / "ply"
    ply.write_ply(cloud(spark), str(path))
    listed = (path / ply.MANIFEST).read_bytes()
    broken = cloud(spark).withColumn("x", F.when(F.col("x") > 400, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        ply.write_ply(broken, str(path))
    assert (path / ply.MANIFEST).read_bytes() == listed
    assert ply.read_ply(spark, str(path)).count() == 3000
    assert ply.verify_summary(ply.verify_output(spark, str(path)), expected=3000).first()["ok"]


def test_an_aborted_job_is_not_seen(spark, tmp_path):
    """Shards of a job that never committed lie beside those of the manifest."""
    path = tmp_path / "ply"
    ply.write_ply(cloud(spark, 100), str(path))
    stray = path / "scene_id=1" / "part-00000-stray.ply"
    stray.write_text(fmt.header_text([("x", "float")], 1) + "1\n")
    assert ply.read_ply(spark, str(path)).count() == 100
    assert ply.verify_output(spark, str(path)).count() == len(ply.shards_of(str(path))[1])


def test_an_overwrite_replaces_and_a_lost_file_shows(spark, tmp_path):
    path = tmp_path / "ply"
    ply.write_ply(cloud(spark), str(path))
    old = {s.rel for s in ply.shards_of(str(path))[1]}
    ply.write_ply(cloud(spark, 40), str(path))
    new = {s.rel for s in ply.shards_of(str(path))[1]}
    assert not old & new and {n for n in files(path) if n.endswith(".ply")} == new
    (path / sorted(new)[0]).rename(tmp_path / "gone.ply")
    report = ply.verify_output(spark, str(path)).collect()
    assert sorted(r["ok"] for r in report).count(False) == 1


def test_empty_output_and_null_colours(spark, tmp_path):
    path = str(tmp_path / "ply")
    assert ply.write_ply(cloud(spark).where("x < 0"), path, check_empty=False).points == 0
    assert json.loads((tmp_path / "ply" / ply.MANIFEST).read_text())["files"] == []
    assert ply.verify_summary(ply.verify_output(spark, path), expected=0).first()["ok"]
    dark = cloud(spark).withColumn("red", F.when(F.col("red") > 9, F.col("red")))
    with pytest.raises(Exception, match="null values of red"):
        ply.write_ply(dark, path, form="binary_little_endian")


def test_pack_writes_the_declared_types():
    import pyarrow as pa

    raw = fmt.pack([pa.array([1.5, None], pa.float32()), pa.array([7, 255], pa.int32())], [("x", "float"), ("red", "uchar")], "binary_big_endian").tobytes()
    assert raw == struct.pack(">fB", 1.5, 7) + struct.pack(">f", np.nan) + b"\xff"
