"""Delaunay surface of every sampled pixel (G3), tile by tile.

A triangle belongs to the place of its circumcentre, and its circle is empty.  So a tile of the
image needs only the points that are nearest to some place in it:

1. **Tiles.**  A level has blocks of ``BLOCK * STEP^level`` pixels, and tiles of ``GROUP`` x
   ``GROUP`` blocks.  Where each block of a tile holds a point, no place of the tile is farther than
   a block's diagonal (the halo) from one, so the points of the tile and its halo give all triangles
   with their centre in the tile, and these are final.  One explode (at most four tiles a point)
   and one shuffle by tile; a tile of the first level holds at most (48 + 2 * 12)^2 points.
2. **Holes.**  A tile with an empty block fails, and its places are left to the next level.  Only
   points in a failed tile or its halo go there: the nearest point of a place in a hole is reached
   without leaving the hole or its rim.  So what goes on is the rims, not the inside.
3. **Outside.**  Centres outside the image belong to the points within a halo of the image's edge (the
   rim).  Those beyond the short sides belong to the points within a halo of these: a group for each
   end of a scene, of the order of the shorter side.  For those beyond the long sides the rim is
   cut into windows of ``span`` pixels along them.  Of the pixels past a window's end, the corners
   (gates) are nearest to any such centre.  So a circle that leaves out the gates leaves out all that
   is not in the window, and is settled there, and only points that share a triangle with a gate may
   have others: they meet those of ``STRIDE`` windows in the next turn, until no gate is left.  There,
   a circle that leaves out the gates of the one window that its corners come from is not counted
   again.

The result is the whole triangulation, hull included, and does not depend on ``block``, ``group`` or
``span``.
Circles are compared in whole numbers.  Of four or more points on one empty circle, all triangles
meet in the one with the smallest pid, in whichever tile they are found.

Repeated points count once.  Null scenes or pids, and points of scenes that ``meta`` lacks, are left
out.  Fewer than three points, or points on one line, have no triangles.  Distances are in pixels.
Images of any shape whose circumcentres fit 64 bits (a million pixels a side if square, millions if
narrow); larger ones raise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drapekit.operators.small import settled
from drapekit.session import ship_package

BLOCK = 8
GROUP = 6
STEP = 8
SPAN = 2048
STRIDE = 64
MAX_SIDE = 1 << 15
#: (edge, candidate) pairs held at once by a task
_PAIRS = 1 << 21


class _Bins:
    """Points in square bins; ``near`` gives those of the 3 x 3 bins around a point."""

    def __init__(self, x: np.ndarray, y: np.ndarray, side: int) -> None:
        self.x, self.y, self.side = x, y, side
        self.cols = int(x.max()) // side + 3
        self.whole = self.cols == 3 and int(y.max()) // side == 0
        key = (y // side + 1) * self.cols + x // side + 1
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]

    def runs(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (self.y[p] // self.side + 1) * self.cols + self.x[p] // self.side + 1
        rows = at[:, None] + np.array([-self.cols, 0, self.cols])
        return np.searchsorted(self.key, rows - 1, "left"), np.searchsorted(self.key, rows + 1, "right")

    def near(self, p: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Per stretch of ``p``: the stretch, then the place in it and the point of each pair."""
        low, high = self.runs(p)
        total = np.cumsum((high - low).sum(axis=1))
        begin = 0
        while begin < len(p):
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + _PAIRS, "right")))
            n = (high - low)[begin:end].ravel()
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[begin:end].ravel(), n)
            yield slice(begin, end), np.repeat(np.arange(len(n)) // 3, n), self.order[place]
            begin = end

    def holds(self, p: np.ndarray, cx: np.ndarray, cy: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Whether the 3 x 3 bins around ``p`` hold all points of a circle."""
        if self.whole:
            return np.ones(len(p), bool)
        s, slack = self.side, 1e-6
        left, top = (self.x[p] // s - 1) * s - 1, (self.y[p] // s - 1) * s - 1
        return (cx - radius > left + slack) & (cy - radius > top + slack) & (cx + radius < left + 3 * s + 1 - slack) & (cy + radius < top + 3 * s + 1 - slack)


def _hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, from the ends of each row."""
    order = np.lexsort((x, y))
    row = y[order]
    ends = np.unique(np.r_[np.flatnonzero(np.r_[True, row[1:] != row[:-1]]), np.flatnonzero(np.r_[row[1:] != row[:-1], True])])
    pts = [(int(x[i]), int(y[i]), int(i)) for i in order[ends]]
    corners: list[int] = []
    for chain in (pts, pts[::-1]):
        kept: list[tuple[int, int, int]] = []
        for q in chain:
            while len(kept) > 1 and (kept[-1][0] - kept[-2][0]) * (q[1] - kept[-2][1]) <= (kept[-1][1] - kept[-2][1]) * (q[0] - kept[-2][0]):
                kept.pop()
            kept.append(q)
        corners += [i for _, _, i in kept]
    return np.unique(corners)


def _best(group: np.ndarray, groups: int, better) -> np.ndarray:
    """Per group the place of its best entry; ``group`` ascends, ``better(i, j)`` compares places."""
    first = np.searchsorted(group, np.arange(groups))
    size = np.searchsorted(group, np.arange(groups), "right") - first
    best = first.copy()
    for k in range(1, int(size.max(initial=0))):
        g = np.flatnonzero(size > k)
        best[g] = np.where(better(first[g] + k, best[g]), first[g] + k, best[g])
    return best


def _apexes(x, y, ids, bins: list[_Bins], hull, a, b, wide: bool) -> np.ndarray:
    """The third corner left of each edge a -> b, or -1 on the hull: the point whose circle with the
    edge is empty, that is the one which sees the edge under the widest angle.  ``wide``: products of
    four sides pass 64 bits."""
    out = np.full(len(a), -1)
    todo = np.arange(len(a))
    for level, grid in enumerate(bins):
        later = []
        for part, edge, c in grid.near(a[todo]):
            mine = todo[part]
            pa, pb = a[mine], b[mine]
            ux, uy = x[pb] - x[pa], y[pb] - y[pa]
            vx, vy = x[c] - x[pa][edge], y[c] - y[pa][edge]
            cross = ux[edge] * vy - uy[edge] * vx
            left = cross > 0
            edge, c, vx, vy, cross = edge[left], c[left], vx[left], vy[left], cross[left]
            dot = vx * (vx - ux[edge]) + vy * (vy - uy[edge])  # cotangent of the angle: dot / cross
            least = np.full(len(mine), np.inf)
            np.minimum.at(least, edge, dot / cross)
            near = dot / cross <= least[edge] + 1e-9 * (1 + np.abs(least[edge]))
            edge, c, vx, vy, cross, dot = edge[near], c[near], vx[near], vy[near], cross[near], dot[near]
            begins = np.diff(edge, prepend=-1) > 0
            some, g = edge[begins], np.cumsum(begins) - 1
            d, k = (dot.astype(object), cross.astype(object)) if wide else (dot, cross)
            at = _best(g, len(some), lambda i, j, d=d, k=k: (d[i] * k[j] < d[j] * k[i]).astype(bool))
            tie = (d * k[at][g] == d[at][g] * k).astype(bool)
            cot = (dot[at] / cross[at]) if len(at) else np.zeros(0)
            g, c, vx, vy = g[tie], c[tie], vx[tie], vy[tie]
            # points on the circle: all triangles meet in the smallest id
            lowest = _best(g, len(some), lambda i, j: ids[c[i]] < ids[c[j]])
            after_b = _best(g, len(some), lambda i, j: vx[i] * vy[j] - vy[i] * vx[j] > 0)
            before_a = _best(g, len(some), lambda i, j: vx[i] * vy[j] - vy[i] * vx[j] < 0)
            ia, ib, ic = ids[pa[some]], ids[pb[some]], ids[c[lowest]]
            apex = c[np.where((ia < ib) & (ia < ic), after_b, np.where((ib < ia) & (ib < ic), before_a, lowest))]
            sx, sy = ux[some], uy[some]
            cx, cy = x[pa[some]] + (sx - sy * cot) / 2, y[pa[some]] + (sy + sx * cot) / 2
            sure = grid.holds(pa[some], cx, cy, np.hypot(sx, sy) / 2 * np.sqrt(1 + cot * cot))
            out[mine[some[sure]]] = apex[sure]
            rest = np.ones(len(mine), bool)
            rest[some[sure]] = False
            later.append(mine[rest])
        todo = np.concatenate(later) if later else todo[:0]
        if level == 0 and len(todo):  # edges of the hull have nothing on their left
            for s in range(0, len(todo), max(1, _PAIRS // len(hull))):
                t = todo[s : s + max(1, _PAIRS // len(hull))]
                ux, uy = (x[b[t]] - x[a[t]])[:, None], (y[b[t]] - y[a[t]])[:, None]
                beyond = ux * (y[hull] - y[a[t]][:, None]) - uy * (x[hull] - x[a[t]][:, None])
                out[t[beyond.max(axis=1) <= 0]] = -2
            todo = todo[out[todo] == -1]
        if not len(todo):
            break
    return np.maximum(out, -1)


def _too_large(w: int, h: int) -> bool:
    """Whether a circumcentre in an image of this size may pass 64 bits."""
    most = max(w, h)
    return 2 * most * (w * w + h * h) + 4 * w * h * most >= 1 << 63


def triangles(x: np.ndarray, y: np.ndarray, ids: np.ndarray, max_side: int = MAX_SIDE) -> np.ndarray:
    """All Delaunay triangles of distinct points in whole numbers, as rows of three places,
    smallest place first, turning from x towards y.  Each point's nearest neighbour gives edges to
    begin with; every edge finds its third corner, whose edges are next."""
    n = len(x)
    none = np.zeros((0, 3), np.int64)
    if n < 3:
        return none
    x, y, ids = (np.asarray(v, np.int64) for v in (x, y, ids))
    x, y = x - x.min(), y - y.min()
    w, h = int(x.max()) + 1, int(y.max()) + 1
    if max(w, h) > max_side:
        raise ValueError(f"images up to {max_side} pixels a side")
    wide = 2 * w * h * (w * w + h * h) >= 1 << 63
    side = max(1, math.ceil(math.sqrt(4 * (int(x.max()) + 1) * (int(y.max()) + 1) / n)))
    bins = [_Bins(x, y, side)]
    while not bins[-1].whole:
        side *= 2
        bins.append(_Bins(x, y, side))
    nearest = np.full(n, -1)
    todo = np.arange(n)
    for grid in bins:
        later = []
        for part, p, c in grid.near(todo):
            mine = todo[part]
            d = (x[c] - x[mine][p]) ** 2 + (y[c] - y[mine][p]) ** 2
            d[c == mine[p]] = np.iinfo(np.int64).max
            least = np.full(len(mine), np.iinfo(np.int64).max)
            np.minimum.at(least, p, d)
            found = np.zeros(len(mine), np.int64)
            hit = (d == least[p]) & (c != mine[p])
            found[p[hit]] = c[hit]
            sure = (least < np.iinfo(np.int64).max) & grid.holds(mine, x[mine], y[mine], np.sqrt(least.astype(float)))
            nearest[mine[sure]] = found[sure]
            later.append(mine[~sure])
        todo = np.concatenate(later)
        if not len(todo):
            break
    hull = _hull(x, y)
    p = np.arange(n)
    front = np.unique(np.r_[p * n + nearest, nearest * n + p])
    done = np.zeros(0, np.int64)
    found = [none]
    while len(front):
        a, b = front // n, front % n
        c = _apexes(x, y, ids, bins, hull, a, b, wide)
        a, b, c = a[c >= 0], b[c >= 0], c[c >= 0]
        least = np.minimum(np.minimum(a, b), c)
        tri = np.where((least == a)[:, None], np.c_[a, b, c], np.where((least == b)[:, None], np.c_[b, c, a], np.c_[c, a, b]))
        tri = tri[np.unique(tri[:, 0] * n + tri[:, 1], return_index=True)[1]]
        found.append(tri)
        a, b, c = tri.T
        done = np.unique(np.r_[done, front, a * n + b, b * n + c, c * n + a])
        front = np.setdiff1d(np.r_[b * n + a, c * n + b, a * n + c], done)
    return np.concatenate(found)


def _centres(x: np.ndarray, y: np.ndarray, tri: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Circumcentres as fractions: numerators of x and y, and their denominator (above 0)."""
    a, b, c = tri.T
    ux, uy, vx, vy = x[b] - x[a], y[b] - y[a], x[c] - x[a], y[c] - y[a]
    u, v = ux * ux + uy * uy, vx * vx + vy * vy
    den = 2 * (ux * vy - uy * vx)
    return vy * u - uy * v + x[a] * den, ux * v - vx * u + y[a] * den, den


def _pixels(rows: pd.DataFrame) -> tuple[np.ndarray, int, int]:
    """A group's pids in order, its image's width and height."""
    w, h = int(rows["w"].iloc[0]), int(rows["h"].iloc[0])
    if _too_large(w, h):
        raise ValueError(f"an image of {w} x {h} pixels is too large")
    return np.sort(rows["pid"].to_numpy(np.int64)), w, h


def _solve(base: int, side: int):
    """A group's triangles with their centre in the group's tile, with the tile of the first level that
    the centre lies in."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        pid, w, h = _pixels(rows)
        x, y = pid % w, pid // w
        tri = triangles(x, y, pid, max(w, h))
        cx, cy, den = _centres(x, y, tri)
        keep = (cx >= 0) & (cy >= 0) & (cx <= (w - 1) * den) & (cy <= (h - 1) * den)
        keep &= (cx // (den * side) == rows["tx"].iloc[0]) & (cy // (den * side) == rows["ty"].iloc[0])
        a, b, c = (pid[k] for k in tri[keep].T)
        return pd.DataFrame({"scene_id": [rows["scene_id"].iloc[0]] * len(a), "a": a, "b": b, "c": c, "tx": (cx // (den * base))[keep], "ty": (cy // (den * base))[keep]})

    return solve


def _end(rows: pd.DataFrame) -> pd.DataFrame:
    """The triangles with their centre beyond one of the short sides."""
    pid, w, h = _pixels(rows)
    x, y = pid % w, pid // w
    tri = triangles(x, y, pid, max(w, h))
    cx, cy, den = _centres(x, y, tri)
    along, across, length, breadth = (cy, cx, h, w) if h >= w else (cx, cy, w, h)
    keep = (across >= 0) & (across <= (breadth - 1) * den)
    keep &= along < 0 if rows["low"].iloc[0] else along > (length - 1) * den
    a, b, c = (pid[k] for k in tri[keep].T)
    return pd.DataFrame({"scene_id": [rows["scene_id"].iloc[0]] * len(a), "a": a, "b": b, "c": c})


def _clear(x, y, tri, cx, cy, den, gates) -> np.ndarray:
    """Whether circles leave out their gates: columns, rows and whether there is such a gate."""
    a = tri[:, 0]
    out = np.ones(len(tri), bool)
    den, ex, ey = (v.astype(object) for v in (den, cx - x[a] * den, cy - y[a] * den))
    for gx, gy, some in gates:
        dx, dy = (gx - x[a]).astype(object), (gy - y[a]).astype(object)
        out &= ~some | (den * (dx * dx + dy * dy) > 2 * (dx * ex + dy * ey)).astype(bool)
    return out


def _strip(span: int, below: int):
    """A window's triangles with their centre beyond one of the long sides, but for those of its parts
    of ``below`` pixels; and the points (no b and c: -1) that may have others."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        pid, w, h = _pixels(rows)
        x, y = pid % w, pid // w
        tall = h >= w
        along, length, breadth = (y, h, w) if tall else (x, w, h)

        def gates(part: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            ends = [(at, side) for at in (part * size - 1, (part + 1) * size) for side in (0, breadth - 1)]
            return [(*((side + 0 * at, at) if tall else (at, side + 0 * at)), (at >= 0) & (at < length)) for at, side in ends]

        n, none = len(pid), np.zeros(0, np.int64)
        tri, later = np.zeros((0, 3), np.int64), none
        if breadth > 1:  # else all points are on one line
            gx, gy = (np.concatenate([g[k][g[2]] for g in gates(along[:1] // span, span)]) for k in (0, 1))
            # the gates have the smallest ids: of points on one circle with a gate, all triangles meet there
            tri = triangles(np.r_[x, gx], np.r_[y, gy], np.r_[pid, -1 - np.arange(len(gx))], max(w, h))
            own = (tri < n).all(axis=1)
            later = np.unique(tri[~own])
            later = pid[later[later < n]]
            tri = tri[own]
        cx, cy, den = _centres(x, y, tri)
        across = cx if tall else cy
        keep = (across < 0) | (across > (breadth - 1) * den)
        if below:
            part = (along // below)[tri]
            same = np.flatnonzero(keep & (part[:, 0] == part[:, 1]) & (part[:, 0] == part[:, 2]))
            keep[same[_clear(x, y, tri[same], cx[same], cy[same], den[same], gates(part[same, 0], below))]] = False
        a, b, c = (np.concatenate([pid[k], v]) for k, v in zip(tri[keep].T, (later, np.full(len(later), -1), np.full(len(later), -1))))
        return pd.DataFrame({"scene_id": [rows["scene_id"].iloc[0]] * len(a), "a": a, "b": b, "c": c, "w": w, "h": h})

    return solve


def _windows(points: DataFrame, side: int, halo: int) -> DataFrame:
    """Each point with every tile of the image that holds it or has it in its halo."""

    def tiles(at: str, size: str) -> Column:
        last = F.floor((F.col(size) - 1) / side)
        return F.sequence(F.greatest(F.floor((F.col(at) - halo) / side), F.lit(0)), F.least(F.floor((F.col(at) + halo) / side), last))

    wide = points.withColumn("tx", F.explode(tiles("x", "w")))
    return wide.withColumn("ty", F.explode(tiles("y", "h")))


def _full_tiles(blocks: DataFrame, size: DataFrame, block: int, group: int) -> DataFrame:
    """Tiles whose blocks all hold a point."""

    def of(size: str, tile: str) -> Column:
        return F.least(F.lit(group), F.ceil(F.col(size) / block) - F.col(tile) * group)

    tile = [F.floor(F.col(c) / group).alias(t) for c, t in (("bx", "tx"), ("by", "ty"))]
    counts = blocks.groupBy("scene_id", *tile).agg(F.count(F.lit(1)).alias("n")).join(size, "scene_id")
    return counts.where(F.col("n") == of("w", "tx") * of("h", "ty")).select("scene_id", "tx", "ty")


def _outside(points: DataFrame, ends: DataFrame, span: int, tasks: int) -> list[DataFrame]:
    """The triangles with their centre outside the image: of the rim ``points`` (scene_id, pid, w, h), and of
    those by the short sides, ``ends`` (and low: by which of them)."""
    kind = f"scene_id {points.schema['scene_id'].dataType.simpleString()}, a long, b long, c long"
    found = [settled(ends.repartition(tasks, "scene_id", "low").groupBy("scene_id", "low").applyInPandas(_end, kind), "triangles")]
    rest, below = points, 0
    while not rest.isEmpty():
        parts = rest.withColumn("part", F.expr(f"if(h >= w, pid div w, pid % w) div {span}"))
        parts = parts.repartition(tasks, "scene_id", "part").groupBy("scene_id", "part").applyInPandas(_strip(span, below), f"{kind}, w long, h long")
        parts = settled(parts, "triangles")
        found.append(parts.where("b >= 0").select("scene_id", "a", "b", "c"))
        rest = parts.where("b < 0").select("scene_id", F.col("a").alias("pid"), "w", "h")
        below, span = span, span * STRIDE
    return found


def delaunay_surface(cloud: DataFrame, meta: DataFrame, block: int = BLOCK, group: int = GROUP, span: int = SPAN) -> DataFrame:
    """``(scene_id, a, b, c)``, the corners' pids, smallest first, turning from columns to rows.
    ``cloud`` has scene_id and pid (row by row, ``width`` to a row), ``meta`` one row per scene."""
    if group < 3:
        raise ValueError("a tile needs at least 3 x 3 blocks")
    ship_package(cloud.sparkSession)
    base, tile = block * group, ["scene_id", "tx", "ty"]
    size = meta.select("scene_id", F.col("width").cast("long").alias("w"), F.col("height").cast("long").alias("h"))
    size = settled(size, "sizes")
    points = cloud.select("scene_id", F.col("pid").cast("long").alias("pid")).distinct().join(size, "scene_id")
    points = points.where((F.col("pid") >= 0) & (F.col("pid") < F.col("w") * F.col("h")))
    rest = settled(points.withColumns({"x": F.col("pid") % F.col("w"), "y": F.floor(F.col("pid") / F.col("w"))}), "pixels")
    blocks = settled(rest.select("scene_id", F.floor(F.col("x") / block).alias("bx"), F.floor(F.col("y") / block).alias("by")).distinct(), "blocks")
    kind = f"scene_id {cloud.schema['scene_id'].dataType.simpleString()}, a long, b long, c long, tx long, ty long"
    # bytes do not tell the work of a tile, so tasks are not merged by size
    tasks = int(cloud.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found, full, rims, ends = [], [], [], []
    grown = 1
    while not rest.isEmpty():
        side, halo = base * grown, math.ceil(block * grown * math.sqrt(2))
        held = blocks.select("scene_id", *[F.floor(F.col(c) / grown).alias(c) for c in ("bx", "by")]).distinct()
        certified = settled(_full_tiles(held, size, block * grown, group), "tiles")
        known = certified.withColumn("sure", F.lit(True))
        windows = settled(_windows(rest, side, halo).join(known, tile, "left"), "windows")
        tri = windows.where("sure").repartition(tasks, *tile).groupBy(*tile).applyInPandas(_solve(base, side), kind)
        for step, earlier in full:  # places that a lower level has settled
            done = earlier.select("scene_id", F.col("tx").alias("dx"), F.col("ty").alias("dy"))
            at = [tri["scene_id"] == done["scene_id"], F.floor(F.col("tx") / step) == F.col("dx"), F.floor(F.col("ty") / step) == F.col("dy")]
            tri = tri.join(done, at, "left_anti")
        found.append(settled(tri.select("scene_id", "a", "b", "c"), "triangles"))
        edge = F.least("x", "y", F.col("w") - 1 - F.col("x"), F.col("h") - 1 - F.col("y")) <= halo
        rim = windows.where(F.col("sure") & edge).withColumn("along", F.when(F.col("h") >= F.col("w"), F.col("y")).otherwise(F.col("x")))
        rims.append(rim.select("scene_id", "pid", "w", "h"))
        for low, near in ((True, F.col("along") <= halo), (False, F.greatest("w", "h") - 1 - F.col("along") <= halo)):
            ends.append(rim.where(near).select("scene_id", "pid", "w", "h", F.lit(low).alias("low")))
        rest = windows.where("sure is null").drop("tx", "ty", "sure").distinct()
        full.append((grown, certified))
        grown *= STEP
    if not rims:
        return cloud.sparkSession.createDataFrame([], kind).select("scene_id", "a", "b", "c")
    rims, ends = (reduce(DataFrame.unionByName, frames).distinct() for frames in (rims, ends))
    found += _outside(settled(rims, "rims"), ends, span, tasks)
    return reduce(DataFrame.unionByName, found)
