"""Operators: nearest label, sampling, aggregates, geometry, catalogue, matching, kNN."""

from __future__ import annotations

import json
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from drapekit.operators.aggregates import cloud_stats, expanded_bbox
from drapekit.operators.catalog import latest_per_key, most_recent, with_id_key
from drapekit.operators.geometry import concat_clouds, normalize_cloud, triangulate_grid
from drapekit.operators.indexing import dense_index
from drapekit.operators.match import match_scenes
from drapekit.operators.nearest import nearest_index_regular, nearest_label
from drapekit.operators.sampling import sample_size, sample_with_replacement, sample_without_replacement

AXIS = [0.0, 10.0, 20.0, 30.0]
TARGETS = [-50.0, 5.0, 15.0, 14.9, 25.0, 99.0, 10.0]
EXPECTED = [0.0, 10.0, 20.0, 10.0, 30.0, 30.0, 10.0]


def test_nearest_label_ties_and_clamps(spark):
    labels = spark.createDataFrame([(1, v) for v in AXIS], "scene_id int, x double")
    targets = spark.createDataFrame([(1, i, v) for i, v in enumerate(TARGETS)], "scene_id int, i int, v double")
    got = nearest_label(targets, labels, value="v", label="x").orderBy("i").collect()
    assert [r["x"] for r in got] == EXPECTED


def test_nearest_label_regular_axis(spark):
    df = spark.createDataFrame([(v,) for v in TARGETS], "v double")
    asc = [r[0] for r in df.select(nearest_index_regular(F.col("v"), F.lit(0.0), F.lit(10.0), F.lit(4))).collect()]
    assert [AXIS[i] for i in asc] == EXPECTED
    desc_axis = AXIS[::-1]
    desc = [r[0] for r in df.select(nearest_index_regular(F.col("v"), F.lit(30.0), F.lit(-10.0), F.lit(4))).collect()]
    assert [desc_axis[i] for i in desc] == EXPECTED


@settings(max_examples=5, deadline=None)
@given(
    st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=1, max_size=12, unique=True),
    st.lists(st.floats(-2e3, 2e3, allow_nan=False), min_size=1, max_size=12),
)
def test_nearest_label_rule(spark, labels, targets):
    """Label below / above the target; the nearer wins, equal distance goes to the label
    above, and a target outside the axis takes the edge label."""
    lab = spark.createDataFrame([(1, v) for v in labels], "scene_id int, x double")
    tg = spark.createDataFrame([(1, i, v) for i, v in enumerate(targets)], "scene_id int, i int, v double")
    got = {r["i"]: r["x"] for r in nearest_label(tg, lab, value="v", label="x").collect()}
    for i, v in enumerate(targets):
        lo = max((a for a in labels if a <= v), default=None)
        hi = min((a for a in labels if a >= v), default=None)
        want = hi if lo is None else lo if hi is None else (lo if v - lo < hi - v else hi)
        assert got[i] == want


def test_sample_size_rounds_half_even(spark):
    df = spark.createDataFrame([(1,), (3,), (5,)], "n long")
    assert [r[0] for r in df.select(sample_size(0.5, F.col("n"))).collect()] == [0, 2, 2]


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 400), st.floats(0.0, 2.5))
def test_sample_with_replacement_exact_count(spark, n, frac):
    df = spark.range(n).withColumnRenamed("id", "pid")
    got = sample_with_replacement(df, frac, seed=7).count()
    assert got == round(frac * n)


def test_sample_without_replacement(spark):
    df = spark.range(1001).withColumnRenamed("id", "pid").withColumn("scene_id", F.lit(1))
    s = sample_without_replacement(df, 0.2, seed=42)
    rows = [r["pid"] for r in s.collect()]
    assert len(rows) == round(0.2 * 1001) and len(set(rows)) == len(rows)
    with pytest.raises(ValueError):
        sample_without_replacement(df, 1.5)


def test_dense_index_groups(spark):
    df = spark.range(0, 500).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 500).alias("v"))
    out = dense_index(df, ["v"], name="i", group_by=["g"], num_partitions=7).toPandas()
    for _, part in out.groupby("g"):
        part = part.sort_values("v")
        assert list(part["i"]) == list(range(len(part)))


@pytest.mark.parametrize("parts", [1, 7, 64])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_dense_index_keeps_every_row(spark, parts, adaptive):
    """Payload columns, ties and coalescing must not make counts and ids disagree."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        df = spark.range(0, 30000).select((F.col("id") * 7919 % 1000).alias("v"), F.col("id").alias("payload"), F.lit("x" * 20).alias("text"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
        for count in (None, parts):
            out = dense_index(df, ["v"], name="i", num_partitions=count).toPandas()
            assert sorted(out["i"]) == list(range(30000)) and sorted(out["payload"]) == list(range(30000))
            assert out.sort_values("i")["v"].is_monotonic_increasing
        out = dense_index(df, ["v"], name="i", group_by=["g"]).toPandas()
        assert len(out) == 30000
        for _, part in out.groupby("g", dropna=False):
            assert sorted(part["i"]) == list(range(len(part)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_nearest_label_is_linear(spark):
    """200k labels and 200k targets of one axis."""
    import time

    labels = spark.range(200_000).select(F.lit(1).alias("scene_id"), (F.col("id") * 10.0).alias("x"))
    targets = spark.range(200_000).select(F.lit(1).alias("scene_id"), "id", (F.col("id") * 10.0 + 4.0).alias("v"))
    t0 = time.time()
    assert nearest_label(targets, labels, value="v", label="x").where("x = id * 10").count() == 200_000
    assert time.time() - t0 < 20


def test_match_scenes_across_the_antimeridian(spark):
    items = [("a", 170.0, -10.0, -170.0, 10.0, 1), ("b", -5.0, 0.0, 5.0, 5.0, 2), ("c", 175.0, 0.0, 179.0, 5.0, 0), ("c2", 175.0, 0.0, 179.0, 5.0, 3)]
    it = spark.createDataFrame(items, "id string, min_lon double, min_lat double, max_lon double, max_lat double, d int")
    it = it.select("*", F.timestamp_seconds(F.col("d") * 3600).cast("timestamp_ntz").alias("datetime")).drop("d")
    reqs = [(1, 178.0, 6.0, 179.0, 7.0), (2, -179.0, 0.0, -178.0, 1.0), (3, 176.0, 1.0, -175.0, 2.0), (4, -1.0, 1.0, 1.0, 2.0), (5, 20.0, 20.0, 21.0, 21.0)]
    rq = spark.createDataFrame(reqs, "req_id long, min_lon double, min_lat double, max_lon double, max_lat double")
    for size in (None, 3.0, 40.0):
        out = match_scenes(rq, it, size=size)
        assert out.columns == ["req_id", *it.columns]
        assert {r["req_id"]: r["id"] for r in out.collect()} == {1: "a", 2: "a", 3: "c2", 4: "b"}


def test_cloud_stats_and_empty(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0, 2.0), (1, 3.0, -1.0, 5.0)], "scene_id int, x double, y double, z double")
    r = cloud_stats(df).collect()[0]
    assert (r["num_points"], r["x_min"], r["x_max"], r["y_min"], r["z_max"]) == (2, 0.0, 3.0, -1.0, 5.0)
    assert r["columns"] == "scene_id,x,y,z"
    assert cloud_stats(df.filter("x > 100")).count() == 0


def test_expanded_bbox(spark):
    t = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0)], "x double, y double")
    r = expanded_bbox(t, 2.0).collect()[0]
    assert (r["x_min"], r["x_max"], r["y_min"], r["y_max"]) == (-2.0, 3.0, -4.0, 6.0)


def test_normalize_cloud_unit_range(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(200, 3)) * [100, 10, 1] + [5e5, 5e6, 300]
    df = spark.createDataFrame(
        [(1, i, *map(float, p), 10, 20, 300) for i, p in enumerate(pts)],
        "scene_id int, pid long, x double, y double, z double, red int, green int, blue int",
    )
    out = normalize_cloud(df).toPandas()
    xyz = out[["x", "y", "z"]].to_numpy()
    assert np.abs(xyz).max() == pytest.approx(1.0)
    assert out["blue"].max() == 1.0
    c = pts - pts.mean(axis=0)
    assert np.allclose(xyz, c / np.abs(c).max(), atol=1e-12)
    one = normalize_cloud(df.limit(1)).collect()[0]
    assert (one["x"], one["y"], one["z"]) == (0.0, 0.0, 0.0)


def test_concat_keeps_duplicates_and_fills_missing(spark):
    a = spark.createDataFrame([(1, 1.0)], "pid long, x double")
    b = spark.createDataFrame([(2.0, 9)], "x double, red int")
    u = concat_clouds([a, a, b])
    assert u.columns == ["pid", "x", "red"]
    assert u.count() == 3
    assert u.filter("red is null").count() == 2


def test_triangulate_full_grid(spark):
    w, h = 5, 4
    cloud = spark.range(w * h).select(F.lit(1).alias("scene_id"), F.col("id").alias("pid"))
    meta = spark.createDataFrame([(1, w, h)], "scene_id int, width int, height int")
    faces = triangulate_grid(cloud, meta)
    assert faces.count() == 2 * (w - 1) * (h - 1)
    got = {tuple(r) for r in faces.select("a", "b", "c").collect()}
    assert (0, 1, 5) in got and (1, 6, 5) in got
    holes = triangulate_grid(cloud.filter("pid != 6"), meta)
    assert holes.count() == 2 * (w - 1) * (h - 1) - 6


def test_latest_per_key_and_most_recent(spark):
    rows = [
        ("S2_a_1", "2024-01-02 00:00:00"),
        ("S2_a_2", "2024-01-03 00:00:00"),
        ("S2_b_1", "2024-01-03 00:00:00"),
        ("S2_b_0", "2024-01-03 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "id string, dt string").select("id", F.col("dt").cast("timestamp_ntz").alias("datetime"))
    latest = {r["id_key"]: r["id"] for r in latest_per_key(with_id_key(df)).collect()}
    assert latest == {"S2_a": "S2_a_2", "S2_b": "S2_b_0"}
    assert most_recent(df).collect()[0]["id"] == "S2_a_2"
    assert most_recent(df.filter("id = 'none'")).count() == 0


def test_match_scenes_brute_force(spark):
    rng = np.random.default_rng(5)
    items, reqs = [], []
    for i in range(300):
        x, y = rng.uniform(-180, 170), rng.uniform(-90, 80)
        items.append((f"S2_{i % 40}_{i}", x, y, x + rng.uniform(0.1, 25), y + rng.uniform(0.1, 25), int(rng.integers(0, 50))))
    for r in range(60):
        x, y = rng.uniform(-180, 150), rng.uniform(-90, 60)
        reqs.append((r, x, y, x + rng.uniform(0.01, 40), y + rng.uniform(0.01, 40)))
    it = spark.createDataFrame(items, "id string, min_lon double, min_lat double, max_lon double, max_lat double, d int").select(
        "*", F.timestamp_seconds(F.col("d") * 3600).cast("timestamp_ntz").alias("datetime")
    ).drop("d")
    rq = spark.createDataFrame(reqs, "req_id long, min_lon double, min_lat double, max_lon double, max_lat double")
    got = {r["req_id"]: r["id"] for r in match_scenes(rq, it, size=7.0).collect()}
    want = {}
    for r, a, b, c, d in reqs:
        hits = [i for i in items if i[1] <= c and i[3] >= a and i[2] <= d and i[4] >= b]
        if hits:
            want[r] = sorted(hits, key=lambda i: (-i[5], i[0]))[0][0]
    assert got == want


def test_read_catalog_files(spark, tmp_path):
    from drapekit.sources.catalog import read_catalog

    item = {
        "type": "Feature",
        "id": "S2_x_1",
        "collection": "sentinel-2-l2a",
        "bbox": [1.0, 2.0, 3.0, 4.0],
        "properties": {"datetime": "2024-01-05T10:00:00.5Z", "eo:cloud_cover": 3.5, "statistics": {"nodata": 1.0}},
        "assets": {"TCI_20m": {"href": "s3://eodata/a/b_TCI_20m.jp2"}, "B02": {"href": "s3://x"}},
    }
    (tmp_path / "items.json").write_text(json.dumps(item) + "\n" + json.dumps({**item, "id": "S2_x_2", "assets": {}}) + "\n")
    (tmp_path / "fc").mkdir()
    (tmp_path / "fc" / "fc.json").write_text(json.dumps({"type": "FeatureCollection", "features": [item, item]}))
    lines = read_catalog(spark, str(tmp_path / "items.json")).orderBy("id").collect()
    assert lines[0]["tci_20m_href"] == "s3://eodata/a/b_TCI_20m.jp2" and lines[1]["tci_20m_href"] is None
    assert str(lines[0]["datetime"]) == "2024-01-05 10:00:00.500000"
    assert (lines[0]["min_lon"], lines[0]["max_lat"], lines[0]["nodata"]) == (1.0, 4.0, 1.0)
    assert read_catalog(spark, str(tmp_path / "fc"), feature_collection=True).count() == 2


def test_knn_and_normals_brute_force(spark):
    from drapekit.operators.normals import estimate_normals, knn

    rng = np.random.default_rng(11)
    n = 700
    xy = rng.uniform(0, 100, size=(n, 2))
    z = 0.3 * xy[:, 0] - 0.2 * xy[:, 1] + rng.normal(scale=0.01, size=n)
    pts = np.column_stack([xy, z])
    pts[:5] = pts[5]  # exact duplicates: ties broken by id
    pts[-1] = [5000.0, 5000.0, 0.0]  # a far outlier goes through the residue rounds
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "pid long, x double, y double, z double")
    k = 12
    got = knn(df, k=k).toPandas()
    ids = np.arange(n)
    for q in range(n):
        d = ((pts - pts[q]) ** 2).sum(axis=1)
        want = ids[np.lexsort((ids, d))][:k]
        have = got[got.pid == q].sort_values("rank")["nbr"].to_numpy()
        assert np.array_equal(have, want), q
    normals = estimate_normals(df, k=k).toPandas().set_index("pid")
    q = 100
    d = ((pts - pts[q]) ** 2).sum(axis=1)
    nb = pts[np.lexsort((ids, d))][:k]
    w, v = np.linalg.eigh(np.cov(nb.T, bias=True))
    ref = v[:, 0] * (1 if v[2, 0] >= 0 else -1)
    have = normals.loc[q, ["nx", "ny", "nz"]].to_numpy(dtype=float)
    assert np.allclose(have, ref, atol=1e-5)
    assert (normals["nz"] >= 0).all()


def test_knn_skewed_density_is_exact(spark):
    """A third of the points in one tiny patch: the hot cell is solved on finer cells."""
    from drapekit.operators.normals import knn

    rng = np.random.default_rng(9)
    n = 3000
    xy = rng.uniform(0, 1000, size=(n, 2))
    xy[: n // 3] = 500 + rng.normal(scale=0.05, size=(n // 3, 2))
    pts = np.column_stack([xy, 0.1 * xy[:, 0] + rng.normal(scale=0.01, size=n)])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "pid long, x double, y double, z double")
    got = knn(df, k=10).toPandas()
    ids = np.arange(n)
    for q in list(range(0, n, 37)):
        d = ((pts - pts[q]) ** 2).sum(axis=1)
        assert np.array_equal(got[got.pid == q].sort_values("rank")["nbr"].to_numpy(), ids[np.lexsort((ids, d))][:10]), q


def test_knn_coincident_third_is_exact(spark):
    """A third of the points share one exact coordinate: the copies are solved once through a
    representative, and only the k smallest ids of the location stay candidates."""
    from drapekit.operators.normals import estimate_normals, knn

    rng = np.random.default_rng(13)
    n = 2400
    xy = rng.uniform(0, 1000, size=(n, 2))
    pts = np.column_stack([xy, 0.05 * xy[:, 1] + rng.normal(scale=0.01, size=n)])
    copies = rng.choice(n, n // 3, replace=False)
    pts[copies] = [400.0, 600.0, 30.0]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "pid long, x double, y double, z double")
    k = 8
    got = knn(df, k=k).toPandas()
    assert len(got) == n * k
    ids = np.arange(n)
    check = list(copies[:20]) + list(range(0, n, 97))
    for q in check:
        d = ((pts - pts[q]) ** 2).sum(axis=1)
        assert np.array_equal(got[got.pid == q].sort_values("rank")["nbr"].to_numpy(), ids[np.lexsort((ids, d))][:k]), q
    normals = estimate_normals(df, k=k)
    assert normals.count() == n


def test_normals_of_a_sample_with_repeats(spark):
    """Repeated ids, a null scene and null-free rows: as many rows as went in."""
    from drapekit.operators.normals import estimate_normals

    rng = np.random.default_rng(3)
    n = 400
    xy = rng.uniform(0, 100, size=(n, 2))
    rows = [(s, int(p), float(xy[p, 0]), float(xy[p, 1]), 0.5 * float(xy[p, 0])) for s in (1, None) for p in rng.integers(0, n, 750)]
    df = spark.createDataFrame(rows, "scene_id int, pid long, x double, y double, z double")
    out = estimate_normals(df, k=30).toPandas()
    assert len(out) == len(rows)
    want = np.array([-0.5, 0.0, 1.0]) / np.sqrt(1.25)
    assert np.allclose(out[["nx", "ny", "nz"]].to_numpy(float), want, atol=1e-4)


def test_tight_patch_is_split_until_no_cell_is_hot(spark, tmp_path):
    """A third of the points in a patch of 0.001 x 0.001: no fine cell keeps more than the bound."""
    from drapekit.operators import normals as nm

    rng = np.random.default_rng(4)
    n, k = 30_000, 10
    xy = rng.uniform(0, 1000, size=(n, 2))
    xy[: n // 3] = 500 + rng.uniform(0, 0.001, size=(n // 3, 2))
    pts = np.column_stack([xy, 0.1 * xy[:, 0]])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "pid long, x double, y double, z double")
    _, _, prepared, _ = nm._prepare(df, k, [], None)
    side = F.col("s") / F.pow(F.lit(2.0), F.col("qlvl"))
    fullest = prepared.groupBy("qlvl", *[F.floor(F.col(c) / side).alias(f"f{c}") for c in "xyz"]).count().agg(F.max("count")).first()[0]
    assert fullest <= nm.HOT_FACTOR * nm.CELL_TARGET_PER_K * k
    got = nm.knn(df, k=k).toPandas()
    ids = np.arange(n)
    for q in [0, 5, 77, n // 3 - 1, n // 3, n - 1]:
        d = ((pts - pts[q]) ** 2).sum(axis=1)
        assert np.array_equal(got[got.pid == q].sort_values("rank")["nbr"].to_numpy(), ids[np.lexsort((ids, d))][:k]), q


def test_surface_of_a_sample_stays_whole(spark):
    w, h = 60, 45
    meta = spark.createDataFrame([(1, w, h)], "scene_id int, width int, height int")
    cloud = spark.range(w * h).where(F.pmod(F.xxhash64("id"), F.lit(5)) == 0).select(F.lit(1).alias("scene_id"), F.col("id").alias("pid"))
    faces = triangulate_grid(cloud, meta, block=5)
    assert faces.count() >= 0.95 * 2 * (w // 5 - 1) * (h // 5 - 1)
    # at pixel size, under a hundredth of the triangles are left
    assert triangulate_grid(cloud, meta).count() < 0.01 * 2 * (w - 1) * (h - 1)
    drawn = {r["pid"] for r in cloud.collect()}
    assert all({r["a"], r["b"], r["c"]} <= drawn for r in faces.collect())


def test_one_wide_box_among_small_ones_stays_a_few_rows(spark):
    """20,000 boxes of 0.01 degree and the world: a bounded number of rows a box."""
    from drapekit.operators.match import BOX, SIDES, cell_rows

    small = spark.range(20_000).select((F.col("id") * 0.017 % 340 - 170).alias("min_lon"), (F.col("id") * 0.031 % 160 - 80).alias("min_lat"))
    small = small.withColumns({"max_lon": F.col("min_lon") + 0.01, "max_lat": F.col("min_lat") + 0.01}).select(*BOX)
    world = spark.createDataFrame([(-180.0, -90.0, 180.0, 90.0)], "min_lon double, min_lat double, max_lon double, max_lat double")
    boxes = small.unionByName(world)
    asked = boxes.select(*[F.col(c).alias(f"q_{c}") for c in BOX])
    left, right = cell_rows(asked, boxes)
    assert left.count() < 20_001 * 16 and right.count() < 20_001 * 16
    per_box = left.groupBy(*[f"q_{c}" for c in BOX]).count().agg(F.max("count")).first()[0]
    assert per_box <= 4 * (len(SIDES) + 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_match_scenes_brute_force_on_mixed_sizes(spark, seed):
    rng = random.Random(seed)

    def box():
        w, h = (10 ** rng.uniform(-4, 2.5) for _ in range(2))
        x, y = rng.uniform(-180, 180), rng.uniform(-90, 90)
        if rng.random() < 0.1:
            return (170.0, y, -170.0, min(90.0, y + h))
        if rng.random() < 0.2:
            x, y = round(x / 22.5) * 22.5, round(y / 22.5) * 22.5
            w = h = 22.5
        return (x, y, min(180.0, x + w), min(90.0, y + h))

    rq = [(f"r{k}", *box()) for k in range(150)]
    it = [(f"i{k}", f"2024-01-{rng.randrange(1, 29):02d} 00:00:00", *box()) for k in range(200)]

    def parts(b):
        return [(b[0], b[1], 180.0, b[3]), (-180.0, b[1], b[2], b[3])] if b[0] > b[2] else [b]

    def meet(a, b):
        return any(p[0] <= q[2] and p[2] >= q[0] and p[1] <= q[3] and p[3] >= q[1] for p in parts(a) for q in parts(b))

    want = {}
    for r, *b in rq:
        hits = [(t, i) for i, t, *c in it if meet(b, c)]
        if hits:
            newest = max(t for t, _ in hits)
            want[r] = min(i for t, i in hits if t == newest)
    requests = spark.createDataFrame(rq, "req_id string, min_lon double, min_lat double, max_lon double, max_lat double")
    items = spark.createDataFrame(it, "id string, t string, min_lon double, min_lat double, max_lon double, max_lat double").withColumn("datetime", F.col("t").cast("timestamp"))
    got = {r["req_id"]: r["id"] for r in match_scenes(requests, items).collect()}
    assert got == want


def test_footprints_from_geojson(spark):
    from drapekit.functions.footprint import box_of, footprint, footprint_predicate, with_footprint

    texts = {
        "square": '{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10],[0,0]]]}',
        "open": '{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10]]]}',
        "frame": '{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10],[0,0]],[[2,2],[8,2],[8,8],[2,8],[2,2]]]}',
        "two": '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[20,20],[21,20],[21,21],[20,20]]]]}',
        "cross": '{"type":"Polygon","coordinates":[[[175,0],[-175,0],[-175,10],[175,10],[175,0]]]}',
        "point": '{"type":"Point","coordinates":[1,2]}',
        "broken": "{no json",
        "null": None,
        "empty": '{"type":"Polygon","coordinates":[]}',
    }
    df = spark.createDataFrame(list(texts.items()), "id string, geometry string")
    boxes = {r.id: tuple(r.b) for r in df.select("id", box_of(footprint("geometry")).alias("b")).where("id in ('square', 'two', 'cross')").collect()}
    assert boxes == {"square": (0, 0, 10, 10), "two": (0, 0, 21, 21), "cross": (175, 0, -175, 10)}
    shaped = with_footprint(df)
    assert {r.id for r in shaped.collect()} == {"square", "open", "frame", "two", "cross"}
    cases = {
        (3.0, 3.0, 4.0, 4.0): {"square", "open"},  # in the frame's hole
        (1.0, 1.0, 1.5, 1.5): {"square", "open", "frame", "two"},
        (2.0, 5.0, 3.0, 6.0): {"square", "open", "frame"},  # touches the frame's inner edge
        (10.0, 10.0, 12.0, 12.0): {"square", "open", "frame"},  # a corner
        (-50.0, -50.0, 50.0, 50.0): {"square", "open", "frame", "two"},
        (176.0, 2.0, 177.0, 3.0): {"cross"},
        (-177.0, 2.0, -176.0, 3.0): {"cross"},
        (179.0, 2.0, -179.0, 3.0): {"cross"},
        (20.1, 20.5, 20.2, 20.9): set(),  # in the box of the triangle, not in the triangle
        (20.8, 20.1, 20.9, 20.2): {"two"},
    }
    for box, want in cases.items():
        assert {r.id for r in footprint_predicate(shaped, box).collect()} == want, box


@pytest.mark.parametrize("seed", range(3))
def test_split_axis_equals_brute_force(spark, seed):
    """Many equal values across the cuts, scenes without labels, null keys."""
    from drapekit.operators.nearest import nearest_label_split

    rng = random.Random(seed)
    keys = [0, 1, None, 3]
    labels = [(k, float(rng.randrange(40)) * rng.choice([1, 0.5])) for k in keys[:3] for _ in range(rng.randrange(1, 60))]
    targets = [(rng.choice(keys), n, float(rng.choice([7, rng.randrange(-3, 45)])) + rng.choice([0, 0.25, 0.5])) for n in range(400)]

    def nearest(k, v):
        own = sorted({x for s, x in labels if s == k}, key=lambda x: (abs(x - v), -x))
        return own[0] if own else None

    t = spark.createDataFrame(targets, "scene_id int, n int, v double").repartition(5)
    got = nearest_label_split(t, spark.createDataFrame(labels, "scene_id int, x double"), value="v", label="x", buckets=13)
    assert {(r.n, r.x) for r in got.collect()} == {(n, nearest(k, v)) for k, n, v in targets}


def test_ranges_of_one_long_axis_are_even(spark):
    """One key, a third of all rows at one value: no range holds above twice the median."""
    from drapekit.operators.indexing import range_buckets

    df = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.rand(1) * 100).alias("v"), F.xxhash64("id").alias("tie"))
    sizes = sorted(r["count"] for r in range_buckets(df, ["v", "tie"], buckets=30).groupBy("bucket").count().collect())
    assert len(sizes) >= 25 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_tiles_of_one_scene_are_pruned(spark, tmp_path):
    """One small scene of 24: the plan prunes dynamically and opens under a tenth of the bytes."""
    from pathlib import Path
    from urllib.parse import urlparse

    from drapekit import fixtures as fx
    from drapekit.operators.drape import resample_grid
    from drapekit.sources.dem import write_tiles

    sf = "/root/testdata/sf0.01"
    cells, meta = fx.dem_cells(spark, sf), fx.raster_meta(spark, sf)
    tiled = write_tiles(cells, str(tmp_path / "dem"), side=100.0)
    one = meta.where("scene_id = 2")
    found = resample_grid(one, tiled)
    want = resample_grid(one, cells)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    every = sum(p.stat().st_size for p in (tmp_path / "dem" / "cells").rglob("*.parquet"))
    met = tiled.cells.withColumn("file", F.input_file_name())
    opened = resample_grid(one, type(tiled)(met.select("scene_id", "tile", "x", "y", F.col("dem")), tiled.tiles, tiled.x, tiled.y))
    files = {r.f for r in tiled.cells.where("scene_id = 2").select(F.input_file_name().alias("f")).distinct().collect()}
    assert opened.count() == want.count()
    assert 0 < sum(Path(urlparse(f).path).stat().st_size for f in files) < every / 10
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "dem" in ln]
    assert any("PartitionFilters" in ln and "dynamicpruning" in ln for ln in scans)


def test_tiles_keep_every_cell_and_odd_scenes(spark, tmp_path):
    from drapekit.sources.dem import read_tiles, tile_side, write_tiles

    rows = [(s, float(x), float(y), float("nan") if x == y else float(x * y)) for s in ("0012", "a/b", None) for x in range(-5, 6) for y in range(-3, 4)]
    cells = spark.createDataFrame(rows, "scene_id string, x double, y double, dem double")
    side = tile_side(cells, target=10)
    assert 1 < side < 6
    write_tiles(cells, str(tmp_path / "t"), target=10)
    tiled = read_tiles(spark, str(tmp_path / "t"))
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, tiled.cells.select("scene_id", "x", "y", "dem").collect())) == sorted(map(key, rows))
    assert tiled.tiles.agg(F.sum("n")).first()[0] == len(rows) and tiled.tiles.count() > 12
    order = [r.scene_id for r in tiled.x.select("scene_id").distinct().collect()]
    assert sorted(order, key=str) == sorted(["0012", "a/b", None], key=str)
    assert write_tiles(cells.limit(0), str(tmp_path / "e")).tiles.count() == 0
