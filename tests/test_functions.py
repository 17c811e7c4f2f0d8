"""Scalar functions: ids, URLs, object references, bbox strings, linspace, colours."""

from __future__ import annotations

import math
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from drapekit.functions import bbox as B
from drapekit.functions.colors import clip_color, quantize_u8, resolve_color_columns
from drapekit.functions.coords import CloudError, export_frame, require_xyz
from drapekit.functions.grid import linspace
from drapekit.functions.text import object_key, resolve_object, strip_last_segment


def _col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_strip_last_segment(spark):
    cases = ["S2A_MSIL2A_20240101_N0510", "abc", "a_", "_a", "", "a_b_c"]
    expected = [c.rsplit("_", 1)[0] for c in cases]
    assert _col(spark, cases, strip_last_segment) == expected


def _key_spec(url: str) -> str:
    """Documented behaviour: non-s3 strings unchanged, else the URL path without leading
    slashes (the standard library parser drops tab/CR/LF and splits query and fragment)."""
    if not url.startswith("s3://"):
        return url
    return urlparse(url).path.lstrip("/")


def test_object_key_matches_url_parsing(spark):
    cases = [
        "s3://eodata/Sentinel-2/a/b.jp2",
        "s3://b//x/y?q=1#frag",
        "s3://b///x",
        "S3://b/k",
        "http://x/y",
        "s3://bucket",
        "s3://b?x=1",
        "s3://b/k\tz\r\n",
        "s3://b/a b/c#",
        "/fr/825?page=2",
        "",
    ]
    assert _col(spark, cases, object_key) == [_key_spec(c) for c in cases]


def test_resolve_object(spark):
    rows = [
        ("s3://eodata/a/b/c.jp2", None),
        ("s3://eodata/a/b/c.jp2", "mine"),
        ("a/b/c.jp2", None),
        ("a/b/c.jp2", "bkt"),
        ("a/b/c.jp2", ""),
        ("s3:///k/x.tif", None),
        ("s3://b/dir/", None),
    ]
    df = spark.createDataFrame(rows, "ref string, bucket string")
    out = df.select(resolve_object(F.col("ref"), F.col("bucket")).alias("o")).select("o.*").collect()
    got = [(r["bucket"], r["key"], r["filename"], r["error"]) for r in out]
    assert got == [
        ("eodata", "a/b/c.jp2", "c.jp2", None),
        ("mine", "a/b/c.jp2", "c.jp2", None),
        (None, "a/b/c.jp2", "c.jp2", "NO_BUCKET"),
        ("bkt", "a/b/c.jp2", "c.jp2", None),
        (None, "a/b/c.jp2", "c.jp2", "NO_BUCKET"),
        (None, "k/x.tif", "x.tif", "NO_BUCKET"),
        ("b", "dir/", "", None),
    ]
    d = df.select(resolve_object(F.col("ref"), F.col("bucket"), default_bucket="eodata").alias("o")).select("o.*")
    # the default applies to URLs only; bare keys still need an explicit bucket
    assert [r["bucket"] for r in d.collect()] == ["eodata", "mine", None, "bkt", None, "eodata", "b"]


def _bbox_spec(s: str):
    """Documented validation order of the bbox argument."""
    try:
        coords = [float(x.strip()) for x in s.split(",")]
    except ValueError:
        return B.BAD_NUMBER
    if len(coords) != 4:
        return B.BAD_COUNT
    a, b, c, d = coords
    if not (-180 <= a <= 180 and -180 <= c <= 180):
        return B.LON_RANGE
    if not (-90 <= b <= 90 and -90 <= d <= 90):
        return B.LAT_RANGE
    if a >= c:
        return B.LON_ORDER
    if b >= d:
        return B.LAT_ORDER
    return None


BBOX_CASES = [
    "3.2833,45.3833,11.2,50.1833",
    "-20.383301, 64.222311, -17.329102, 64.92044",
    "1,2,3",
    "a,b,c,d",
    "-181,0,10,10",
    "0,-91,10,10",
    "10,0,10,10",
    "0,10,10,10",
    "0,20,10,10",
    "nan,0,10,10",
    "0,0,inf,10",
    "-inf,0,10,10",
    " 1 , 2 , 3 , 4 ",
    "\t1,2,3,4\n",
    "1,2,3,4,5",
    "",
    "1,,3,4",
    "+1,-2,.5e1,4.",
    "1e1,2E0,30,40",
    "Infinity,0,1,1",
    "0,0,1,NaN",
]


def test_parse_bbox_matches_spec(spark):
    got = _col(spark, BBOX_CASES, lambda c: B.parse_bbox(c).getField("error"))
    assert got == [_bbox_spec(s) for s in BBOX_CASES]


def test_parse_bbox_values_and_deliberate_differences(spark):
    ok = _col(spark, ["-20.383301, 64.222311, -17.329102, 64.92044"], B.parse_bbox)[0]
    assert (ok["min_lon"], ok["min_lat"], ok["max_lon"], ok["max_lat"], ok["error"]) == (
        -20.383301, 64.222311, -17.329102, 64.92044, None
    )
    # Java-style suffixes are not numbers here; digit separators are rejected on purpose
    errs = _col(spark, ["1.0d,2,3,4", "1_0,2,30,40"], lambda c: B.parse_bbox(c).getField("error"))
    assert errs == [B.BAD_NUMBER, B.BAD_NUMBER]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 64, 5490])
def test_linspace_bitwise_numpy(spark, n):
    start, stop = 699960.0, 809760.0
    meta = spark.createDataFrame([(1, start, stop, n)], "scene_id int, a double, b double, n int")
    rows = linspace(meta, "a", "b", "n", "i", "v").orderBy("i").collect()
    got = np.array([r["v"] for r in rows], dtype=np.float64)
    want = np.linspace(start, stop, n)
    assert len(got) == n
    assert np.array_equal(got, want)


def test_quantize_u8(spark):
    df = spark.createDataFrame([(300,), (-1,), (255,), (0,)], "c int")
    got = [r[0] for r in df.select(quantize_u8(F.col("c"), F.lit(300), True)).collect()]
    assert got == [44, 255, 255, 0]
    unit = spark.createDataFrame([(1.0,), (0.5,), (3 / 255,)], "c double")
    got = [r[0] for r in unit.select(quantize_u8(F.col("c"), F.lit(1.0), False)).collect()]
    assert got == [int(np.uint8(1.0 * 255)), int(np.uint8(0.5 * 255)), int(np.uint8((3 / 255) * 255))]


def test_clip_color(spark):
    df = spark.createDataFrame([(-10,), (0,), (255,), (300,)], "c int")
    assert [r[0] for r in df.select(clip_color(F.col("c"))).collect()] == [0.0, 0.0, 1.0, 1.0]


def test_color_columns_are_case_sensitive(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 10, 20, 30, 7, 8, 9)], "x double, y double, z double, R int, G int, B int, r int, g int, b int")
    with_ci = df  # both r,g,b and R,G,B present: r,g,b comes first in the search order
    _, cols, name = resolve_color_columns(with_ci)
    assert name == "r,g,b"
    out = export_frame(df).collect()[0]
    assert (out["red"], out["green"], out["blue"]) == (7, 8, 9)


def test_color_list_fallback(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, [1, 2, 3])], "x double, y double, z double, rgb array<int>")
    out = export_frame(df).collect()[0]
    assert (out["red"], out["green"], out["blue"]) == (1, 2, 3)
    bad = spark.createDataFrame([(1.0, 2.0, 3.0, [1, 2])], "x double, y double, z double, rgb array<int>")
    assert "red" not in export_frame(bad).columns


def test_require_xyz(spark):
    with pytest.raises(CloudError):
        require_xyz(spark.createDataFrame([(1.0, 2.0)], "x double, y double"))
    with pytest.raises(CloudError):
        require_xyz(spark.createDataFrame([], "x double, y double, z double"))
    require_xyz(spark.createDataFrame([(1.0, 2.0, 3.0)], "x double, y double, z double"))


def test_nan_never_passes_range_checks(spark):
    # NaN sorts above every number in Spark; the bbox and crop checks must still reject it
    got = _col(spark, ["nan,0,1,1"], lambda c: B.parse_bbox(c).getField("error"))
    assert got == [B.LON_RANGE]
    assert math.isnan(float("nan"))


def test_target_axes_centers(spark):
    from drapekit.operators.drape import target_axes

    meta = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 4.0, 5, 2)], "scene_id int, lft double, btm double, rgt double, tp double, width int, height int")
    edges = [r["tx"] for r in target_axes(meta)[0].orderBy("col_idx").collect()]
    centers = [r["tx"] for r in target_axes(meta, centers=True)[0].orderBy("col_idx").collect()]
    assert edges == list(np.linspace(0.0, 10.0, 5))
    assert centers == list(np.linspace(1.0, 9.0, 5))
    ys = [r["ty"] for r in target_axes(meta, centers=True)[1].orderBy("row_idx").collect()]
    assert ys == [1.0, 3.0]
