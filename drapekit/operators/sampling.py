"""Exact-size sampling of point clouds (M1, M2) and the approximate variant (M3).

Draws are decided by a keyed hash, not by a stateful generator, so they are the same on every
task attempt and every engine that has MD5:

    draw k of group g  ->  position  int(md5("seed:g:k")[:15], 16) mod N

Sampling needs a dense position ``0..N-1`` per group: grids have one (``pid``); other clouds
get one from ``dense_index`` first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drapekit.operators.small import settled

# draws generated per task row; a group with n draws is split into ceil(n / DRAW_CHUNK) rows
# that are spread over tasks before being exploded
DRAW_CHUNK = 1 << 17
# M2 histogram resolution: top bits of the 60-bit hash
HIST_BITS = 20


def _hash60(parts: Sequence[Column]) -> Column:
    """60-bit integer from the first 15 hex digits of MD5 over ``parts`` joined by ':'."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sample_size(fraction: float, n: Column) -> Column:
    """``round(fraction * N)`` with ties to even, like pandas' ``frac`` sampling."""
    return F.bround(F.lit(float(fraction)) * n.cast("double"), 0).cast("long")


def draws_with_replacement(
    sizes: DataFrame,
    fraction: float,
    seed: int = 42,
    group: Sequence[str] = ("scene_id",),
    n_col: str = "n_total",
) -> DataFrame:
    """``(group..., k, pid)``: the draws for each group row of ``sizes`` (which holds the
    population size ``n_col``).  ``k`` is the draw number, ``pid`` the drawn position."""
    if fraction < 0:
        raise ValueError("sample fraction must be >= 0")
    group = list(group)
    # a fixed count: the chunks' few bytes do not tell how many draws they become, and merged they
    # would be one task's work
    tasks = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = sizes.select(*group, F.col(n_col).cast("long").alias("_pop")).withColumn("_n", sample_size(fraction, F.col("_pop")))
    chunks = s.select(
        *group,
        "_pop",
        "_n",
        F.explode(
            F.when(F.col("_n") > 0, F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / DRAW_CHUNK)))
            .otherwise(F.array().cast("array<long>"))
        ).alias("_c"),
    ).repartition(tasks, *group, "_c")
    ks = chunks.select(
        *group,
        "_pop",
        F.explode(
            F.sequence(F.col("_c") * DRAW_CHUNK, F.least(F.col("_n"), (F.col("_c") + 1) * DRAW_CHUNK) - 1)
        ).alias("k"),
    )
    hashed = _hash60([F.lit(seed), *[F.col(g) for g in group], F.col("k")])
    return ks.select(*group, "k", (hashed % F.col("_pop")).alias("pid"))


def sample_with_replacement(
    df: DataFrame,
    fraction: float,
    seed: int = 42,
    group: Sequence[str] = ("scene_id",),
    id_col: str = "pid",
    sizes: DataFrame | None = None,
) -> DataFrame:
    """M1: exactly ``round_half_even(fraction * N)`` rows per group, drawn uniformly with
    replacement (a row can appear several times; ``k`` tells the draws apart).

    ``df[id_col]`` must be dense ``0..N-1`` per group.  ``sizes`` (group -> ``n_total``) may
    be given when N is known without counting (a W x H grid)."""
    group = [g for g in group if g in df.columns]
    if sizes is None:
        sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_total")) if group else df.agg(
            F.count(F.lit(1)).alias("n_total")
        )
    d = draws_with_replacement(sizes, fraction, seed, group)
    return d.join(df, group + [id_col])


def sample_without_replacement(
    df: DataFrame,
    fraction: float,
    seed: int = 42,
    group: Sequence[str] = ("scene_id",),
    id_col: str = "pid",
) -> DataFrame:
    """M2: exactly ``round_half_even(fraction * N)`` distinct rows per group: the rows with the
    smallest ``(md5("seed:g:id"), id)``.

    No global sort: a histogram over the top ``HIST_BITS`` bits of the hash (one partial
    aggregate) gives one row per group: the bucket that holds rank n and how many rows it
    still owes.  Lower buckets are a plain filter against that row; only the boundary bucket
    (about N / 2^HIST_BITS rows) is ranked."""
    if fraction < 0 or fraction > 1:
        raise ValueError("sample fraction without replacement must be within [0, 1]")
    group = [g for g in group if g in df.columns]
    h = df.withColumn("_h", _hash60([F.lit(seed), *[F.col(g) for g in group], F.col(id_col)])).withColumn(
        "_b", F.shiftright(F.col("_h"), 60 - HIST_BITS)
    )
    hist = h.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    wg = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    # at most 2^HIST_BITS rows per group meet in the window, whatever the size of the cloud
    hist = hist.withColumn("_n", sample_size(fraction, F.sum("_cnt").over(wg)))
    hist = hist.withColumn("_cum", F.sum("_cnt").over(wg.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
    edge = hist.where((F.col("_cum") >= F.col("_n")) & (F.col("_cum") - F.col("_cnt") < F.col("_n")))
    edge = settled(edge.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_b").alias("_edge"), (F.col("_n") - F.col("_cum") + F.col("_cnt")).alias("_owed")), "sample-edge")
    if group:
        h = h.join(edge, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group])
    else:
        row = edge.first()  # one row, or none for an empty sample
        h = h.withColumn("_edge", F.lit(row["_edge"] if row else -1)).withColumn("_owed", F.lit(row["_owed"] if row else 0))
    whole = h.where(F.col("_b") < F.col("_edge")).select(*df.columns)
    last = h.where(F.col("_b") == F.col("_edge")).withColumn("_r", F.row_number().over(Window.partitionBy(*group, "_b").orderBy("_h", id_col)))
    return whole.unionByName(last.where(F.col("_r") <= F.col("_owed")).select(*df.columns))


def sample_approx(df: DataFrame, fraction: float, with_replacement: bool = True, seed: int = 42) -> DataFrame:
    """M3: Spark's per-row Bernoulli / Poisson sampling; the size is only expected to be
    ``fraction * N``."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)
