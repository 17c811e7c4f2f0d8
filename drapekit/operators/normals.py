"""Per-point normals from the k nearest neighbours (G2): exact kNN on a grid, covariance per
point, smallest eigenvector.

kNN plan
--------
1. **Cell size per cloud** from occupied-cell counts at nine scales in one pass: the smallest
   scale holding about ``2k`` points per occupied cell.  Small aggregates, no driver round
   trip.
2. **Ring 1**: cells are grouped in blocks of ``BLOCK`` cells per axis; every point goes to
   its block and to a neighbouring block when it lies in that block's one-cell halo, so all
   candidates of a query land in the query's block.  Blocks are co-grouped and solved in numpy,
   each query against its cell's 27-cell neighbourhood, in cells of half the side first; pairs
   are never Spark rows.
3. **Certification**: a query is exact when it found k candidates and its k-th distance is
   within its margin to the outside of the 3x3x3 block (any point outside is farther).
4. **Residue rounds** for the rest (sparse regions, outliers): each uncertified query searches
   a ball of radius R (its k-th candidate distance, or a growing radius when it had fewer than
   k) on a coarser grid level so the cube stays within a few cells per axis.  The residue is
   small (AQE broadcasts it where it fits); candidates are streamed, pairs are reduced to a
   per-task top-k (``mapInPandas``) before one shuffle by query, so no query collects an
   unbounded candidate list in one task.  Rounds repeat until every query is certified; the
   finished part is written to the checkpoint folder between rounds to cut lineage.

Normals: population covariance of the k neighbours (the point itself included), then the
eigenvector of the smallest eigenvalue, solved for a whole Arrow batch at once with
``numpy.linalg.eigh``.  Orientation: ``nz >= 0`` (then ``ny``, then ``nx``), since the
reference does not orient them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from drapekit.operators.indexing import dense_index
from drapekit.session import scratch_path, ship_package

# fixed values: neighbour count of the default normal estimation; points per occupied cell
# as a multiple of k (2k certifies nearly every query in ring 1 on terrain-like clouds)
DEFAULT_K = 30
CELL_TARGET_PER_K = 2
# search radius growth per residue round for queries still short of k neighbours
RADIUS_GROWTH = 4.0
# a base cell holding more than HOT_FACTOR x the target occupancy is split into finer cells
# (extreme density skew, not ordinary variation); each level halves the cell side, until no
# fine cell holds more than that
HOT_FACTOR = 16
# points of a solving task
SOLVER_ROWS = 20_000

_OFFSETS = [(dx, dy, dz) for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dz in (-1, 0, 1)]
# cells per block axis for the ring-1 co-group: a point is copied to a neighbouring block only
# when it sits in that block's one-cell halo
BLOCK = 8
# distances that a solving task holds at a time (one query's candidates, if they are more)
DISTANCES = 1 << 18


def _groups(df: DataFrame, group: Sequence[str]) -> list[str]:
    return [g for g in group if g in df.columns]


def cell_sizes(cloud: DataFrame, group: Sequence[str] = ("scene_id",), target: int = CELL_TARGET_PER_K * DEFAULT_K) -> DataFrame:
    """``(group..., s, diag)``: grid cell size per cloud and its bounding-box diagonal.

    Counts occupied cells at nine scales around a surface-like first guess (the two
    largest extents as an area), factor sqrt(2) apart; the smallest scale whose mean
    occupancy reaches ``target`` wins.  Only efficiency depends on this choice: exactness
    comes from the certification and residue rounds."""
    g = _groups(cloud, group)
    ext = cloud.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(c).alias(f"{c}0") for c in "xyz"],
        *[F.max(c).alias(f"{c}1") for c in "xyz"],
    )
    span = [F.col(f"{c}1") - F.col(f"{c}0") for c in "xyz"]
    big, small = F.greatest(*span), F.least(*span)
    mid = span[0] + span[1] + span[2] - big - small
    area = big * F.greatest(mid, big * 1e-6)
    guess = F.sqrt(area * float(target) / F.col("n"))
    ext = ext.select(
        *g,
        "n",
        F.sqrt(span[0] * span[0] + span[1] * span[1] + span[2] * span[2]).alias("diag"),
        F.when(guess > 0, guess).otherwise(F.lit(1.0)).alias("s0"),
    )
    if g:
        pts = cloud.select(*g, "x", "y", "z").join(ext.select(*g, "s0"), g)
    else:
        pts = cloud.select("x", "y", "z").withColumn("s0", ext.select("s0").scalar())
    # a cell of twice the side is made of whole cells: the points are reduced to the two finest
    # scales' cells, and the others are counted from those
    finest = F.array(*[F.struct(F.lit(2.0 ** (j / 2.0)).alias("f"), F.lit(up).alias("up")) for j, up in ((-4, 4), (-3, 3))])
    fine = pts.select(*g, "x", "y", "z", "s0", F.explode(finest).alias("o")).withColumn("sc", F.col("o.f") * F.col("s0"))
    fine = fine.select(*g, "sc", F.col("o.up").alias("up"), *[F.floor(F.col(c) / F.col("sc")).alias(f"k{c}") for c in "xyz"]).distinct()
    wide = fine.select(*g, "sc", *[f"k{c}" for c in "xyz"], F.explode(F.transform(F.sequence(F.lit(0), "up"), lambda u: F.pow(F.lit(2.0), u))).alias("by"))
    cells = wide.select(*g, (F.col("sc") * F.col("by")).alias("sc"), *[F.floor(F.col(f"k{c}") / F.col("by")).alias(f"k{c}") for c in "xyz"]).distinct()
    occ = cells.groupBy(*g, "sc").agg(F.count(F.lit(1)).alias("occ"))
    if g:
        occ = occ.join(ext.select(*g, "n"), g)
    else:
        occ = occ.withColumn("n", ext.select("n").scalar())
    pick = occ.groupBy(*g).agg(
        F.coalesce(F.min(F.when(F.col("n") / F.col("occ") >= float(target), F.col("sc"))), F.max("sc")).alias("s")
    )
    if g:
        return pick.join(ext.select(*g, "diag"), g).select(*g, "s", "diag")
    return pick.withColumn("diag", ext.select("diag").scalar()).select("s", "diag")


def _keyed(cloud: DataFrame, params: DataFrame, g: list[str]) -> DataFrame:
    if g:
        j = cloud.select(*g, "pid", "x", "y", "z").join(params, g)
    else:
        st = params.select(F.struct("s", "diag")).scalar()
        j = cloud.select("pid", "x", "y", "z").withColumn("s", st.getField("s")).withColumn("diag", st.getField("diag"))
    return j.select(
        *g, "pid", "x", "y", "z", "s", "diag", *[F.floor(F.col(c) / F.col("s")).alias(f"c{c}") for c in "xyz"]
    )


def hot_cells(pts: DataFrame, g: list[str], target: int) -> DataFrame:
    """``(group..., cx, cy, cz)`` of base cells holding more than ``HOT_FACTOR * target``
    points."""
    occ = pts.groupBy(*g, "cx", "cy", "cz").agg(F.count(F.lit(1)).alias("n"))
    return occ.filter(F.col("n") > HOT_FACTOR * target).select(*g, "cx", "cy", "cz")


def cell_levels(inhot: DataFrame, g: list[str], target: int, base: str) -> DataFrame:
    """``(group..., cx, cy, cz, lvl)`` of hot base cells: the first level at which none of the
    cell's fine cells holds more than ``HOT_FACTOR * target`` of the points ``inhot``, as far
    as doubles tell places apart.

    Two levels are tried per round, on the cells that are still too full.  How deep it goes
    depends on how tight the points lie, not on a set ceiling."""
    spark = inhot.sparkSession
    keys = [*g, "cx", "cy", "cz"]
    left, lvl, parts = inhot.select(*keys, "x", "y", "z", "s"), 0, []
    while True:
        tried = []
        for step in (lvl + 1, lvl + 2):
            side = F.col("s") / F.lit(2.0**step)
            fine = left.groupBy(*keys, *[F.floor(F.col(c) / side).alias(f"f{c}") for c in "xyz"]).agg(F.count(F.lit(1)).alias("n"))
            finest = F.lit(step >= 40)  # about the last bits of a double
            tried.append(fine.groupBy(*keys).agg(F.max("n").alias("most")).select(*keys, F.lit(step).alias("lvl"), ((F.col("most") <= HOT_FACTOR * target) | finest).alias("fits")))
        both = tried[0].unionByName(tried[1]).groupBy(*keys).agg(F.min(F.when(F.col("fits"), F.col("lvl"))).alias("lvl"))
        path = f"{base}/levels{lvl}"
        both.write.parquet(path)
        both = spark.read.parquet(path)
        parts.append(both.where("lvl is not null"))
        todo = both.where("lvl is null").select(*keys)
        if todo.isEmpty():
            break
        left = left.join(todo, keys, "left_semi")
        lvl += 2
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_levels(pts: DataFrame, hot: DataFrame, g: list[str]) -> DataFrame:
    """Add ``qlvl`` (the level a point is solved at: its base cell's) and ``lvls`` (every level
    it must be a candidate at: 0 plus the levels of hot cells among its 27 base neighbours)."""
    keys = [*g, "cx", "cy", "cz"]
    own = hot.select(*keys, F.col("lvl").alias("qlvl"))
    offs = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(dz).alias("dz")) for dx, dy, dz in _OFFSETS])
    near = hot.select(*g, "cx", "cy", "cz", "lvl", F.explode(offs).alias("o"))
    near = near.select(*g, *[(F.col(f"c{c}") + F.col(f"o.d{c}")).alias(f"c{c}") for c in "xyz"], "lvl")
    near = near.groupBy(*keys).agg(F.collect_set("lvl").alias("near"))
    j = pts.join(own, keys, "left").join(near, keys, "left")
    return j.withColumn("qlvl", F.coalesce(F.col("qlvl"), F.lit(0))).withColumn(
        "lvls", F.array_union(F.array(F.lit(0)), F.coalesce(F.col("near"), F.array().cast("array<int>")))
    ).drop("near")


def _d2(a: str, b: str):
    return sum(((F.col(f"{a}{c}") - F.col(f"{b}{c}")) * (F.col(f"{a}{c}") - F.col(f"{b}{c}")) for c in "xyz"), F.lit(0.0))


def _row_topk(d: np.ndarray, kk: int) -> np.ndarray:
    """Column indices of the ``kk`` smallest values of each row, ordered by (value, column).
    Columns are candidates pre-sorted by id, so column order is the id tie-break.

    ``argpartition`` selects, then only the selected ``kk`` are sorted; rows where a value
    equal to the k-th one was left out (a tie across the cut) are redone with a full stable
    sort, so the tie-break stays exact."""
    if kk >= d.shape[1]:
        return np.argsort(d, axis=1, kind="stable")[:, :kk]
    part = np.argpartition(d, kk - 1, axis=1)[:, :kk]
    vals = np.take_along_axis(d, part, axis=1)
    order = np.lexsort((part, vals), axis=-1)
    idx = np.take_along_axis(part, order, axis=1)
    vk = np.take_along_axis(vals, order[:, -1:], axis=1)
    ties = (d <= vk).sum(axis=1) > kk
    if ties.any():
        idx[ties] = np.argsort(d[ties], axis=1, kind="stable")[:, :kk]
    return idx


def _normals_from_neighbours(nb: np.ndarray) -> np.ndarray:
    """(rows, k, 3) neighbour coordinates -> (rows, 3) unit normals: smallest eigenvector of the
    population covariance, oriented ``nz >= 0`` (then ``ny``, then ``nx``)."""
    c = nb - nb.mean(axis=1, keepdims=True)
    cov = np.einsum("rki,rkj->rij", c, c) / nb.shape[1]
    _, vecs = np.linalg.eigh(np.nan_to_num(cov))
    n = vecs[:, :, 0].copy()
    flip = (n[:, 2] < 0) | ((n[:, 2] == 0) & ((n[:, 1] < 0) | ((n[:, 1] == 0) & (n[:, 0] < 0))))
    n[flip] *= -1.0
    return n


def _cell_codes(cells: np.ndarray, low: np.ndarray, span: np.ndarray) -> np.ndarray:
    """One number per cell; cells that follow each other along z have numbers that do."""
    at = cells - low
    return (at[:, 0] * span[1] + at[:, 1]) * span[2] + at[:, 2]


class _Cells:
    """Candidates by cell: which of them lie in the 27 cells around a query's cell."""

    def __init__(self, qcells: np.ndarray, ccells: np.ndarray):
        low = np.minimum(qcells.min(axis=0), ccells.min(axis=0)) - 1
        span = np.maximum(qcells.max(axis=0), ccells.max(axis=0)) - low + 2
        codes = _cell_codes(ccells, low, span)
        self.order = np.argsort(codes, kind="stable")
        codes = codes[self.order]
        own, self.cell = np.unique(_cell_codes(qcells, low, span), return_inverse=True)
        # three cells along z are one run of the sorted candidates
        runs = own[:, None] + np.array([(dx * span[1] + dy) * span[2] for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
        self.begin = np.searchsorted(codes, runs - 1, side="left")
        self.size = np.searchsorted(codes, runs + 1, side="right") - self.begin
        self.width = self.size.sum(axis=1)

    def table(self, cells: np.ndarray) -> np.ndarray:
        """A row per cell: places of its candidates, ascending, filled up with the number of all
        candidates."""
        begin, size, width = self.begin[cells].ravel(), self.size[cells].ravel(), self.width[cells]
        total = int(width.sum())
        run = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(total)
        out = np.full((len(cells), int(width.max(initial=0))), len(self.order))
        out[np.repeat(np.arange(len(cells)), width), np.arange(total) - np.repeat(np.cumsum(width) - width, width)] = self.order[run]
        out.sort(axis=1)
        return out


def _solve(k: int, cells: _Cells, which: np.ndarray, qxyz: np.ndarray, s: np.ndarray, qcells: np.ndarray, cxyz: np.ndarray):
    """Top-k of the queries ``which`` among the candidates around their cells (candidates stand in the
    order of their id, so column order is the id tie-break).  Yields ``(queries, places, d2, n_found,
    dk2, ok)`` in portions: ``places`` and ``d2`` have k columns, of which ``n_found`` count."""
    filled = np.vstack([cxyz, np.full((1, 3), np.nan)])
    which = which[np.argsort(cells.width[cells.cell[which]], kind="stable")]
    width = cells.width[cells.cell[which]]
    a = int(np.searchsorted(width, 1))  # no candidate at all: nothing to give out
    while a < len(which):
        b = min(len(which), a + max(1, DISTANCES // int(width[a])))
        b = min(b, a + max(1, DISTANCES // int(width[b - 1])))
        rows = which[a:b]
        own, row = np.unique(cells.cell[rows], return_inverse=True)
        table = cells.table(own)
        d = np.zeros((len(rows), table.shape[1]))
        for j in range(3):
            diff = qxyz[rows, j : j + 1] - filled[table, j][row]
            d += diff * diff
        idx = _row_topk(d, min(k, d.shape[1]))
        found = np.minimum(k, width[a:b])
        d2 = np.take_along_axis(d, idx, axis=1)
        dk2 = d2[np.arange(len(rows)), found - 1]
        q, side, cell = qxyz[rows], s[rows, None], qcells[rows].astype(np.float64)
        lo = q - (cell - 1) * side
        hi = (cell + 2) * side - q
        margin = np.minimum(lo, hi).min(axis=1) * (1.0 - 1e-9)
        yield rows, table[row[:, None], idx], d2, found, dk2, (found >= k) & (dk2 <= margin * margin)
        a = b


def _block_topk(k: int, g: list[str], fused_normals: bool):
    """Per block of cells: the queries' top-k among the candidates (block and halo), all queries of a
    block in a few array operations.

    Cells of half the side come first: they hold a fraction of the candidates, and most queries are
    certified there, with the same neighbours.  The others search the 27 cells of full side."""

    def run(q, c):
        import pyarrow as pa
        import pyarrow.compute as pc

        def column(table, name):
            return table[name].combine_chunks()

        def matrix(table, names):
            return np.stack([column(table, n).to_numpy(zero_copy_only=False) for n in names], axis=1)

        parts = []
        # points without a place have no cell and no neighbours
        if q.num_rows and c.num_rows and not any(column(q, n).null_count for n in ("kx", "ky", "kz")):
            c = c.take(pc.sort_indices(c, [("nbr", "ascending")]))
            qxyz, cxyz = matrix(q, ["qx", "qy", "qz"]), matrix(c, ["nx", "ny", "nz"])
            qcells, ccells = matrix(q, ["kx", "ky", "kz"]), matrix(c, ["cx", "cy", "cz"])
            s, left = column(q, "s").to_numpy(), np.arange(q.num_rows)
            if np.isfinite(qxyz).all() and np.isfinite(cxyz).all():
                half = [np.floor(xyz / (s[0] / 2.0)).astype(np.int64) for xyz in (qxyz, cxyz)]
                fine = [(rows[ok], *[v[ok] for v in rest], ok[ok]) for rows, *rest, ok in _solve(k, _Cells(*half), left, qxyz, s / 2.0, half[0], cxyz)]
                parts += fine
                left = np.setdiff1d(left, np.concatenate([p[0] for p in fine] or [left[:0]]))
            if len(left):
                parts += _solve(k, _Cells(qcells, ccells), left, qxyz, s, qcells, cxyz)
        out: dict[str, list] = {}
        for rows, places, d2, found, dk2, ok in parts:
            cols = {"pid": column(q, "pid").cast(pa.int64()).take(pa.array(rows))}
            if fused_normals:
                normals = np.zeros((len(rows), 3))
                if ok.any():
                    normals[ok] = _normals_from_neighbours(cxyz[places[ok]])
                cols |= {f"n{a}": pa.array(normals[:, j], pa.float64()) for j, a in enumerate("xyz")}
            else:
                real = np.arange(places.shape[1]) < found[:, None]
                ends = pa.array(np.concatenate([[0], np.cumsum(found)]), pa.int32())
                flat = places[real]
                cols["nbr"] = pa.ListArray.from_arrays(ends, column(c, "nbr").cast(pa.int64()).take(pa.array(flat)))
                cols["d2"] = pa.ListArray.from_arrays(ends, pa.array(d2[real], pa.float64()))
                cols |= {f"n{a}": pa.ListArray.from_arrays(ends, pa.array(cxyz[flat, j].astype(np.float64))) for j, a in enumerate("xyz")}
            cols |= {"ok": pa.array(ok), "n_found": pa.array(found, pa.int64()), "dk2": pa.array(dk2, pa.float64())}
            cols = {n: column(q, n).take(pa.array(np.zeros(len(rows), np.int64))) for n in g} | cols
            for name, v in cols.items():
                out.setdefault(name, []).append(v)
        if out:
            return pa.table({name: pa.chunked_array(v) for name, v in out.items()})
        kind = pa.float64() if fused_normals else pa.list_(pa.float64())
        kinds = {n: q.schema.field(n).type for n in g} | {"pid": pa.int64()} | ({} if fused_normals else {"nbr": pa.list_(pa.int64()), "d2": kind})
        kinds |= {"nx": kind, "ny": kind, "nz": kind, "ok": pa.bool_(), "n_found": pa.int64(), "dk2": pa.float64()}
        return pa.table({n: pa.array([], t) for n, t in kinds.items()})

    return run


def knn_ring1(pts: DataFrame, g: list[str], k: int, fused_normals: bool = False) -> DataFrame:
    """Top-k candidates from the 27 cells around each point; one row per point with its neighbours
    in arrays (or its normal) and ``ok`` telling whether the query is certified exact.

    Cells are grouped in blocks of ``BLOCK`` cells per axis.  A point goes to its own block,
    and also to a neighbouring block when it lies in that block's one-cell halo (an edge
    cell), so it is copied about (1 + 2/BLOCK) times per axis instead of into all 27
    neighbouring cells.  Queries and candidates are co-grouped by block and each query
    is solved in numpy against its cell's 27-cell neighbourhood.  Pairs exist only inside one task's
    memory, a bounded block at a time.

    With level columns (``qlvl``, ``lvls`` from ``with_levels``) queries in hot base cells are
    solved on finer cells: a point is a candidate at every level of a hot cell next to it, so
    a query's fine 3x3x3 block always holds every point inside it."""
    leveled = "qlvl" in pts.columns
    # fresh aliases: both sides come from ``pts``, and a shared attribute would make the
    # co-group keys ambiguous
    regroup = [F.col(c).alias(c) for c in g]
    lvl_col = F.explode("lvls") if leveled else F.lit(0)
    rep = pts.select(*regroup, "pid", "x", "y", "z", "s", lvl_col.alias("lvl"))
    side = F.col("s") / F.pow(F.lit(2.0), F.col("lvl"))
    rep = rep.select(*g, "lvl", "pid", "x", "y", "z", *[F.floor(F.col(c) / side).alias(f"c{c}") for c in "xyz"])

    def blocks(c: str):
        """The block holding cell ``c`` plus the neighbouring block whose halo it is in."""
        own = F.floor(F.col(c) / BLOCK)
        pos = F.col(c) - own * BLOCK
        return F.array_distinct(
            F.array(own, F.when(pos == 0, own - 1).otherwise(own), F.when(pos == BLOCK - 1, own + 1).otherwise(own))
        )

    cand = (
        rep.withColumn("bx", F.explode(blocks("cx")))
        .withColumn("by", F.explode(blocks("cy")))
        .withColumn("bz", F.explode(blocks("cz")))
        .select(
            *g,
            "lvl",
            "bx",
            "by",
            "bz",
            F.col("pid").alias("nbr"),
            *[F.col(c).alias(f"n{c}") for c in "xyz"],
            "cx",
            "cy",
            "cz",
        )
    )
    qlvl = F.col("qlvl") if leveled else F.lit(0)
    qside = F.col("s") / F.pow(F.lit(2.0), qlvl)
    qpts = pts.filter(F.col("is_query")) if "is_query" in pts.columns else pts
    q = qpts.select(
        *[F.col(c).alias(c) for c in g],
        qlvl.alias("lvl"),
        "pid",
        *[F.col(c).alias(f"q{c}") for c in "xyz"],
        qside.alias("s"),
        *[F.floor(F.col(c) / qside).alias(f"k{c}") for c in "xyz"],
    ).select(*g, "lvl", "pid", "qx", "qy", "qz", "s", "kx", "ky", "kz",
             *[F.floor(F.col(f"k{c}") / BLOCK).alias(f"b{c}") for c in "xyz"])
    keys = g + ["lvl", "bx", "by", "bz"]
    # halo copies landing in blocks without any query point are dropped before the co-group
    cand = cand.join(q.select(*keys).distinct(), keys, "left_semi")
    gschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pts.select(*g).schema.fields)
    body = (
        "pid long, nx double, ny double, nz double, ok boolean, n_found long, dk2 double"
        if fused_normals
        else "pid long, nbr array<long>, d2 array<double>, nx array<double>, ny array<double>, nz array<double>, ok boolean, n_found long, dk2 double"
    )
    schema = (gschema + ", " if gschema else "") + body
    # the per-block solve is CPU work on few bytes: size-based partition coalescing would
    # leave most cores idle, so both sides are hash-partitioned by block to as many tasks as
    # the points need (an explicit count is not coalesced, and the co-group needs no other
    # shuffle)
    n = _solver_partitions(pts)
    q, cand = q.repartition(n, *keys), cand.repartition(n, *keys)
    return q.groupBy(*keys).cogroup(cand.groupBy(*keys)).applyInArrow(_block_topk(k, g, fused_normals), schema)


def _solver_partitions(pts: DataFrame) -> int:
    """Partitions for the Python solving stages: one per ``SOLVER_ROWS`` points, at least two per
    core."""
    return max(2 * pts.sparkSession.sparkContext.defaultParallelism, -(-pts.count() // SOLVER_ROWS))


def _partial_topk(k: int, key_cols: list[str]):
    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            pdf = pdf.sort_values(key_cols + ["d2", "nbr"], kind="stable")
            yield pdf.groupby(key_cols, sort=False).head(k)

    return run


def _prepare(cloud: DataFrame, k: int, g: list[str], params: DataFrame | None):
    """Materialise the keyed points once in the shared checkpoint folder; every later pass
    reads them instead of recomputing the cloud's lineage.

    Returns ``(spark, base, pts, alias)``.  In hot cells coincident points (one exact
    coordinate) are collapsed: every copy has the same neighbour list (ties at distance 0 go
    by id), so one representative per location is solved and only the location's k smallest
    ids stay candidates (a location can never put more than k ids into a top-k).  ``alias``
    maps the other copies to their representative (None when nothing was collapsed)."""
    spark = cloud.sparkSession
    ship_package(spark)
    params = cell_sizes(cloud, g, target=CELL_TARGET_PER_K * k) if params is None else params
    base = scratch_path(spark, "knn")
    _keyed(cloud, params, g).write.mode("overwrite").parquet(f"{base}/pts0")
    pts = spark.read.parquet(f"{base}/pts0")
    # hot cells: split where the density is far above the target (skewed clouds)
    target = CELL_TARGET_PER_K * k
    hot_cells(pts, g, target).write.mode("overwrite").parquet(f"{base}/hot")
    hot = spark.read.parquet(f"{base}/hot")
    if hot.isEmpty():
        return spark, base, pts.withColumn("is_query", F.lit(True)), None
    cell_keys = [*g, "cx", "cy", "cz"]
    inhot = pts.join(hot, cell_keys, "left_semi")
    rest = pts.join(hot, cell_keys, "left_anti").withColumn("is_query", F.lit(True))
    loc = [*g, "x", "y", "z"]
    # at most k per location survive; Spark limits each task's rows per location before the
    # shuffle (partial window group limit), so a location holding a third of the cloud
    # sends only k rows per task
    ranked = inhot.withColumn("_rn", F.row_number().over(Window.partitionBy(*loc).orderBy("pid"))).filter(
        F.col("_rn") <= k
    )
    ranked.write.mode("overwrite").parquet(f"{base}/ranked")
    ranked = spark.read.parquet(f"{base}/ranked")
    reps = ranked.filter(F.col("_rn") == 1).select(*loc, F.col("pid").alias("rep"))
    alias = inhot.join(reps, loc).filter(F.col("pid") != F.col("rep")).select(*g, "pid", "rep")
    alias.write.mode("overwrite").parquet(f"{base}/alias")
    alias = spark.read.parquet(f"{base}/alias")
    cand = ranked.withColumn("is_query", F.col("_rn") == 1).drop("_rn")
    levels = cell_levels(cand, g, target, base)
    with_levels(rest.unionByName(cand), levels, g).write.mode("overwrite").parquet(f"{base}/pts")
    return spark, base, spark.read.parquet(f"{base}/pts"), alias


def _copy_to_aliases(result: DataFrame, alias: DataFrame | None, g: list[str]) -> DataFrame:
    """Rows of each representative repeated for the copies it stands for."""
    if alias is None:
        return result
    copies = alias.join(result.withColumnRenamed("pid", "rep"), [*g, "rep"]).drop("rep")
    return result.unionByName(copies.select(*result.columns))


def _residue_rounds(spark, base: str, pts: DataFrame, residue: DataFrame, g: list[str], k: int) -> DataFrame | None:
    """Exact top-k rows for the queries ring 1 could not certify (``residue`` holds
    ``group..., pid, n_found, dk2``).  None when there is no residue."""
    out_cols = [*g, "pid", "nbr", "rank", "d2", "nx", "ny", "nz"]
    res_path = f"{base}/residue0"
    residue.write.mode("overwrite").parquet(res_path)
    residue = spark.read.parquet(res_path)
    # radius for the next search: the k-th candidate distance when k were found, otherwise a
    # growing multiple of the cell size
    q0 = residue.join(pts.select(*g, "pid", "x", "y", "z", "s", "diag"), g + ["pid"])
    q0 = q0.withColumn("R", F.when(F.col("n_found") >= k, F.sqrt("dk2")).otherwise(F.col("s") * RADIUS_GROWTH))
    current = q0.select(*g, "pid", "x", "y", "z", "s", "diag", "R")
    cur_path = f"{base}/q0"
    current.write.mode("overwrite").parquet(cur_path)
    current = spark.read.parquet(cur_path)
    done_path = f"{base}/residue_done"
    found = False
    rnd = 0
    while True:
        n_left = current.count()
        if n_left == 0:
            break
        rnd += 1  # ends: the radius grows until it covers the cloud's diagonal
        # grid level per query: cell side >= R, so the cube spans at most 3 cells per axis
        lvl = F.greatest(F.lit(0), F.ceil(F.log2(F.col("R") / F.col("s")))).cast("int")
        qx = current.withColumn("lvl", lvl).withColumn("sl", F.col("s") * F.pow(F.lit(2.0), F.col("lvl")))
        rng = lambda c: F.sequence(
            F.floor((F.col(c) - F.col("R")) / F.col("sl")), F.floor((F.col(c) + F.col("R")) / F.col("sl"))
        )
        qx = (
            qx.withColumn("kx", F.explode(rng("x")))
            .withColumn("ky", F.explode(rng("y")))
            .withColumn("kz", F.explode(rng("z")))
            .select(*g, "pid", *[F.col(c).alias(f"q{c}") for c in "xyz"], "R", "lvl", "sl", "kx", "ky", "kz", "diag")
        )
        levels = [r["lvl"] for r in qx.select("lvl").distinct().collect()]
        # one read of the points serves all levels of the round
        side = F.col("s") * F.pow(F.lit(2.0), F.col("lvl"))
        cand = pts.withColumn("lvl", F.explode(F.array(*[F.lit(lv) for lv in levels]))).select(
            *g,
            F.col("pid").alias("nbr"),
            *[F.col(c).alias(f"n{c}") for c in "xyz"],
            "lvl",
            *[F.floor(F.col(c) / side).alias(f"k{c}") for c in "xyz"],
        )
        pairs = cand.join(qx, g + ["lvl", "kx", "ky", "kz"]).withColumn("d2", _d2("q", "n"))
        pairs = pairs.filter(F.col("d2") <= F.col("R") * F.col("R")).select(*g, "pid", "nbr", "d2", "nx", "ny", "nz", "R", "diag")
        local = pairs.mapInPandas(_partial_topk(k, [*g, "pid"]), pairs.schema)
        w = Window.partitionBy(*g, "pid").orderBy("d2", "nbr")
        top = (
            local.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .withColumn("n_found", F.count(F.lit(1)).over(Window.partitionBy(*g, "pid")))
        )
        # exact when k points lie within R, or R already covers the whole cloud
        top = top.withColumn("ok", (F.col("n_found") >= k) | (F.col("R") >= F.col("diag")))
        step_path = f"{base}/round{rnd}"
        top.write.mode("overwrite").parquet(step_path)
        top = spark.read.parquet(step_path)
        top.filter("ok").select(*out_cols).write.mode("append").parquet(done_path)
        found = True
        # queries still short of k neighbours widen their radius; the grid level follows the
        # radius, so a wider search costs no more cells per query
        nxt = current.join(top.filter("ok").select(*g, "pid").distinct(), g + ["pid"], "left_anti").withColumn(
            "R", F.least(F.col("R") * RADIUS_GROWTH, F.col("diag"))
        )
        cur_path = f"{base}/q{rnd}"
        nxt.write.mode("overwrite").parquet(cur_path)
        current = spark.read.parquet(cur_path)
    return spark.read.parquet(done_path) if found else None


def knn(
    cloud: DataFrame,
    k: int = DEFAULT_K,
    group: Sequence[str] = ("scene_id",),
    params: DataFrame | None = None,
) -> DataFrame:
    """Exact k nearest neighbours (the point itself included) of every point:
    ``(group..., pid, nbr, rank, d2, nx, ny, nz)`` with ``rank`` 1..k by (distance, nbr id).
    Clouds with fewer than k points give all their points."""
    g = _groups(cloud, group)
    spark, base, pts, alias = _prepare(cloud, k, g, params)
    ring = knn_ring1(pts, g, k)
    ring_path = f"{base}/ring"
    ring.write.mode("overwrite").parquet(ring_path)
    ring = spark.read.parquet(ring_path)
    # a row per neighbour only here: columns that nobody asks for are not read
    done = ring.filter("ok").select("*", F.posexplode("nbr").alias("_at", "_nbr"))
    done = done.select(*g, "pid", F.col("_nbr").alias("nbr"), (F.col("_at") + 1).cast("int").alias("rank"), *[F.get(F.col(c), F.col("_at")).alias(c) for c in ("d2", "nx", "ny", "nz")])
    residue = ring.filter(~F.col("ok")).groupBy(*g, "pid").agg(F.max("n_found").alias("n_found"), F.max("dk2").alias("dk2"))
    rest = _residue_rounds(spark, base, pts, residue, g, k)
    return _copy_to_aliases(done if rest is None else done.unionByName(rest), alias, g)


def _eig_batches(group_cols: list[str]):
    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            c = np.empty((len(pdf), 3, 3))
            c[:, 0, 0] = pdf["cxx"]
            c[:, 1, 1] = pdf["cyy"]
            c[:, 2, 2] = pdf["czz"]
            c[:, 0, 1] = c[:, 1, 0] = pdf["cxy"]
            c[:, 0, 2] = c[:, 2, 0] = pdf["cxz"]
            c[:, 1, 2] = c[:, 2, 1] = pdf["cyz"]
            c = np.nan_to_num(c)
            _, vecs = np.linalg.eigh(c)
            n = vecs[:, :, 0]
            # orientation: nz >= 0, then ny, then nx
            flip = (n[:, 2] < 0) | ((n[:, 2] == 0) & ((n[:, 1] < 0) | ((n[:, 1] == 0) & (n[:, 0] < 0))))
            n[flip] *= -1.0
            out = pdf[group_cols + ["pid"]].copy()
            out["nx"], out["ny"], out["nz"] = n[:, 0], n[:, 1], n[:, 2]
            yield out

    return run


def neighbour_covariance(nbrs: DataFrame, group: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``(group..., pid, cxx, cxy, cxz, cyy, cyz, czz)``: population covariance of each
    point's neighbours."""
    g = _groups(nbrs, group)
    pairs = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    return nbrs.groupBy(*g, "pid").agg(*[F.covar_pop(f"n{a}", f"n{b}").alias(f"c{a}{b}") for a, b in pairs])


def estimate_normals(cloud: DataFrame, k: int = DEFAULT_K, group: Sequence[str] = ("scene_id",)) -> DataFrame:
    """The cloud with ``nx, ny, nz`` (float) added.

    Rows are told apart by a dense id of their own, in the order of ``pid``, x, y, z: a sample
    with replacement repeats its ``pid``s, and each repeat is a point like any other.  Ring 1
    solves neighbours, covariance and eigenvector in one numpy pass per cell and emits one row
    per point; only points it cannot certify take the general kNN path."""
    g = _groups(cloud, group)
    order = [c for c in ("pid", "x", "y", "z") if c in cloud.columns]
    cloud = dense_index(cloud, [*g, *order], name="_row")
    if g:  # one key per cloud that is never null, so clouds without a scene are solved too
        key = F.concat_ws(":", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in g])
        points = cloud.select(key.alias("_cloud"), F.col("_row").alias("pid"), "x", "y", "z")
        g = ["_cloud"]
    else:
        points = cloud.select(F.col("_row").alias("pid"), "x", "y", "z")
    spark, base, pts, alias = _prepare(points, k, g, None)
    ring = knn_ring1(pts, g, k, fused_normals=True)
    ring_path = f"{base}/ring_normals"
    ring.write.mode("overwrite").parquet(ring_path)
    ring = spark.read.parquet(ring_path)
    normals = ring.filter("ok").select(*g, "pid", "nx", "ny", "nz")
    rest = _residue_rounds(spark, base, pts, ring.filter(~F.col("ok")).select(*g, "pid", "n_found", "dk2"), g, k)
    if rest is not None:
        cov = neighbour_covariance(rest, g)
        schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in pts.select(*g, "pid").schema.fields])
        normals = normals.unionByName(cov.mapInPandas(_eig_batches(g), f"{schema}, nx double, ny double, nz double"))
    normals = _copy_to_aliases(normals, alias, g).select(F.col("pid").alias("_row"), *[F.col(c).cast("float").alias(c) for c in ("nx", "ny", "nz")])
    return cloud.join(normals, "_row").drop("_row")
