"""The Delaunay surface against every triple's circle, and independence of its tiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from drapekit.operators.delaunay import MAX_SIDE, delaunay_surface, triangles


def brute_force(x, y, ids) -> set:
    """Edges whose empty circles leave room on both sides bound the empty polygons; each polygon is
    cut from its smallest id."""
    n, out = len(x), set()
    for a in range(n):
        for b in range(n):
            left, right, blocked = [], [], False
            for c in range(n):
                if len({a, b, c}) < 3:
                    continue
                cross = (x[b] - x[a]) * (y[c] - y[a]) - (y[b] - y[a]) * (x[c] - x[a])
                dot = (x[c] - x[a]) * (x[c] - x[b]) + (y[c] - y[a]) * (y[c] - y[b])
                if cross == 0:
                    blocked |= dot < 0
                else:
                    (left if cross > 0 else right).append((dot / abs(cross), c))
            if blocked or not left or (right and min(left)[0] + min(right)[0] <= 0):
                continue
            apex = min((c for t, c in left if t == min(left)[0]), key=lambda c: ids[c])
            if ids[apex] < min(ids[a], ids[b]):
                out.add((apex, a, b))
    return out


def cyclic(tri, ids) -> set:
    """The same triangles, smallest id first."""
    return {min(((a, b, c), (b, c, a), (c, a, b)), key=lambda t: ids[t[0]]) for a, b, c in tri}


@pytest.mark.parametrize("trial", range(24))
def test_triangles_have_empty_circles(trial):
    rng = np.random.default_rng(trial)
    w, h = rng.integers(1, 13, 2)
    pid = np.flatnonzero(rng.random(w * h) < rng.choice([0.1, 0.3, 0.6, 1.0]))
    ids = rng.permutation(len(pid)) if trial % 3 == 0 else pid
    got = [tuple(map(int, t)) for t in triangles(pid % w, pid // w, ids)]
    assert len(set(got)) == len(got)
    assert cyclic(got, ids) == brute_force((pid % w).tolist(), (pid // w).tolist(), ids.tolist())


def test_far_apart_points_are_compared_exactly():
    # four points of one huge circle, and one a pixel further out
    far = MAX_SIDE - 1
    x, y = np.array([0, far, far, 0]), np.array([0, 0, far, far])
    assert triangles(x, y, np.arange(4)).tolist() == [[0, 1, 2], [0, 2, 3]]
    y[2] -= 1  # now inside the circle of the other three
    assert cyclic(triangles(x, y, np.arange(4)).tolist(), np.arange(4)) == {(0, 1, 2), (0, 2, 3)}
    y = np.array([1, 0, far, far])
    assert cyclic(triangles(x, y, np.arange(4)).tolist(), np.arange(4)) == {(0, 1, 2), (0, 2, 3)}
    with pytest.raises(ValueError):
        triangles(np.array([0, 1, MAX_SIDE]), np.array([0, 1, 0]), np.arange(3))


def test_surface_is_the_same_for_all_tiles(spark):
    rng = np.random.default_rng(7)
    scenes = {1: (150, 130, 0.2, 0), 2: (140, 120, 0.3, 70), 3: (20, 15, 1.0, 0), 4: (90, 90, 0.01, 0), 5: (1, 30, 0.5, 0), 6: (9, 9, 0.02, 0)}
    meta, rows, want = [], [], set()
    for scene, (w, h, share, hole) in scenes.items():
        pid = np.flatnonzero(rng.random(w * h) < share)
        x, y = pid % w, pid // w
        if hole:
            out = (abs(x - w // 2) > hole // 2) | (abs(y - h // 2) > hole // 2)
            pid, x, y = pid[out], x[out], y[out]
        meta.append((scene, w, h))
        rows += [(scene, int(p)) for p in pid]
        want |= {(scene, *map(int, pid[t])) for t in triangles(x, y, pid)}
    size = spark.createDataFrame(meta, "scene_id int, width int, height int")
    # repeats, nulls, a scene without a header, pids outside the image: no part of the surface
    cloud = spark.createDataFrame(rows + rows[:40] + [(None, 3), (1, None), (99, 1), (3, 20 * 15), (3, -1)], "scene_id int, pid long")
    for block, group in ((8, 6), (3, 4)):
        got = [tuple(r) for r in delaunay_surface(cloud, size, block, group).collect()]
        assert len(got) == len(want) and set(got) == want
    used = {(s, p) for s, *tri in want for p in tri}
    assert used >= {(s, p) for s, p in rows if s in (1, 2, 3, 4)}
    assert delaunay_surface(cloud.limit(0), size).count() == delaunay_surface(cloud, size.limit(0)).count() == 0
    with pytest.raises(ValueError):
        delaunay_surface(cloud, size, group=2)


@pytest.mark.parametrize("shape", [(5, 160), (9, 130), (150, 7), (40, 40), (2, 90)])
def test_triangles_outside_the_image_come_from_windows_of_the_rim(spark, monkeypatch, shape):
    """Long images: their rim is nearly all of them, and no group may hold it."""
    from drapekit.operators import delaunay

    w, h = shape
    rng = np.random.default_rng(w * h)
    monkeypatch.setattr(delaunay, "STRIDE", 3)
    seen = []
    monkeypatch.setattr(delaunay, "settled", lambda df, name, own=delaunay.settled: (lambda out: (seen.append(out), out)[1])(own(df, name)))
    rows, want = [], set()
    for scene, share in enumerate((0.05, 0.3, 0.6, 1.0)):
        pid = np.flatnonzero(rng.random(w * h) < share)
        if scene == 2:  # a hole at the edge
            pid = pid[abs(pid // w - h // 2) + abs(pid % w) > 12]
        rows += [(scene, int(p)) for p in pid]
        want |= {(scene, *map(int, pid[t])) for t in triangles(pid % w, pid // w, pid)}
    size = spark.createDataFrame([(scene, w, h) for scene in range(4)], "scene_id int, width int, height int")
    got = [tuple(r) for r in delaunay_surface(spark.createDataFrame(rows, "scene_id int, pid long"), size, 4, 3, span=10).collect()]
    assert len(got) == len(want) and set(got) == want
    turns = [f.where("b < 0").select("scene_id", "a").count() for f in seen if "w" in f.columns and "b" in f.columns]
    assert len(turns) >= (4 if max(w, h) > 90 else 3) and turns[-1] == 0


def test_windows_of_the_rim_hand_on_few_points():
    from drapekit.operators.delaunay import _strip

    w, h = 33, 8192
    pid = np.flatnonzero(np.random.default_rng(3).random(w * h) < 0.2)
    own = pid[(pid // w >= 2048) & (pid // w < 4096)]
    out = _strip(2048, 0)(pd.DataFrame({"scene_id": 1, "pid": own, "w": w, "h": h}))
    assert len(own) > 13_000 and 0 < (out["b"] < 0).sum() < 120
