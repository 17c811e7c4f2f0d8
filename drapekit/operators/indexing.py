"""Dense positional ids without a single-partition window.

A frame read from storage has no row order, but several operators need a dense position
``0..N-1`` (per scene): positional sampling (M1) on clouds without a point id, and the
index of an axis label.  ``row_number()`` over an unpartitioned window would pull every row
into one task, so instead:

1. range-partition and sort by the ordering columns (partition ``p`` holds only rows that
   sort before partition ``p+1``), number the rows inside each partition, and write the rows
   with partition and row number to the shared folder,
2. count rows per (partition, group) of the written rows - one small aggregate, at most
   partitions x groups rows,
3. turn the counts into offsets with a window over that small table,
4. id = offset + position inside the partition.

Range bounds are sampled and partitions coalesced per plan, so two plans over the same input
need not agree on them.  That is why partition and row number are written once and both the
counts and the ids read the same files.

Rows that tie on the ordering columns are split by their scan order, so a group of identical
rows (a third of a table, say) spreads over several range partitions instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drapekit.session import scratch_path

_ROW_BITS = (1 << 33) - 1


def dense_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "idx",
    group_by: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = dense 0-based position by ``order_by`` inside each ``group_by`` group."""
    groups = [F.col(g) for g in group_by]
    # rows equal on every ordering column would share one range partition (a range bound
    # cannot split equal keys): a scan-order tie-breaker spreads them.  It is taken before any
    # shuffle, so a re-run task of the scan assigns the same values.
    df = df.withColumn("_dk_tie", F.monotonically_increasing_id())
    keys = groups + [F.col(c) if isinstance(c, str) else c for c in order_by] + [F.col("_dk_tie")]
    if num_partitions is None:
        ranged = df.repartitionByRange(*keys)
    else:
        ranged = df.repartitionByRange(num_partitions, *keys)
    tagged = (
        ranged.sortWithinPartitions(*keys)
        .withColumn("_dk_part", F.spark_partition_id())
        .withColumn("_dk_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    path = scratch_path(df.sparkSession, "index")
    tagged.write.parquet(path)
    tagged = df.sparkSession.read.schema(tagged.schema).parquet(path)
    group_names = list(group_by)
    counts = tagged.groupBy(*group_names, "_dk_part").agg(F.count(F.lit(1)).alias("_dk_n"), F.min("_dk_row").alias("_dk_first"))
    w = Window.partitionBy(*group_names) if group_names else Window.partitionBy(F.lit(0))
    w = w.orderBy("_dk_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_dk_off", F.coalesce(F.sum("_dk_n").over(w), F.lit(0)).cast("long")).drop("_dk_n")
    offsets = offsets.select(*[F.col(c).alias(f"_dk_{c}") if c in group_names else F.col(c) for c in offsets.columns])
    # one row per (partition, group), joined null-safe: null groups count as a group
    same = [F.col(g).eqNullSafe(F.col(f"_dk_{g}")) for g in group_names]
    joined = tagged.alias("t").join(offsets.withColumnRenamed("_dk_part", "_dk_at"), [F.col("_dk_part") == F.col("_dk_at"), *same])
    out = (F.col("_dk_off") + F.col("_dk_row") - F.col("_dk_first")).cast("long")
    return joined.select(*[F.col(c) for c in df.columns if c != "_dk_tie"], out.alias(name))


def range_buckets(df: DataFrame, by: Sequence[str], name: str = "bucket", buckets: int | None = None) -> DataFrame:
    """Add ``name`` = number of a range of ``by``, ascending, with about as many rows in each.  The
    bounds are found by Spark's range partitioning; they are at most ``buckets`` rows (by default four
    for each shuffle partition, so that those which meet in a task even out)."""
    key = F.struct(*by)
    n = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if buckets is None else buckets
    ranged = df.select(*by).repartitionByRange(n, *by)
    least = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("k")).orderBy("p").collect()
    kinds = [df.schema[c].dataType for c in by]
    bounds = F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(r.k, kinds, by)]) for r in least] or [key])
    return df.withColumn(name, F.greatest(F.size(F.filter(bounds, lambda b: b <= key)) - 1, F.lit(0)))
