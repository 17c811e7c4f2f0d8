"""Nearest axis label (J2): a two-sided as-of join.

For each target value: the nearest label of the axis; a target exactly half-way between two
labels takes the **larger** label; a target outside the axis takes the edge label; there is
no tolerance.  The rule looks only at values, so it is the same for ascending and descending
axes.

General form: labels and targets are unioned per (scene); ``last(label)`` over everything up
to the current value gives the label below, and the same over the keys in descending order
gives the label above; both frames only grow, so the work is linear.  The window partitions by scene, so each window holds
one axis (labels + targets, bounded by the axis length), never the points.  A distance
predicate like ``abs(a - b) <= d`` would be planned as a nested-loop join and is avoided.

Split form (``nearest_label_split``): an axis too long for one task is cut into ranges.  Each range
is worked out by itself, and the last label before it and the first one behind it come from a small
table with a row per range.

Regular form: when the labels are ``x0 + i * step`` the index is arithmetic and no join is
needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drapekit.operators.indexing import range_buckets
from drapekit.operators.small import settled


def pick_nearest(v: Column, lo: Column, hi: Column) -> Column:
    """Choose between the label below (``lo``) and above (``hi``); ties go to ``hi``."""
    return (
        F.when(lo.isNull(), hi)
        .when(hi.isNull(), lo)
        .when(v - lo < hi - v, lo)
        .otherwise(hi)
    )


def nearest_label(
    targets: DataFrame,
    labels: DataFrame,
    value: str,
    label: str,
    keys: Sequence[str] = ("scene_id",),
    out: str | None = None,
) -> DataFrame:
    """Add column ``out`` (default ``label``) = nearest label in ``labels[label]`` to
    ``targets[value]``, per ``keys``.  All target columns are kept."""
    out = out or label
    keys = list(keys)
    both = _both(targets, labels, value, label, keys)
    w = Window.partitionBy(*keys)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    lo = F.last("_nl_label", ignorenulls=True).over(w.orderBy(F.asc("_nl_v")).rangeBetween(*so_far))
    hi = F.last("_nl_label", ignorenulls=True).over(w.orderBy(F.desc("_nl_v")).rangeBetween(*so_far))
    marked = both.select(*keys, "_nl_v", "_nl_row", lo.alias("_nl_lo"), hi.alias("_nl_hi"))
    return _picked(marked, targets, keys, out)


def _both(targets: DataFrame, labels: DataFrame, value: str, label: str, keys: list[str]) -> DataFrame:
    """Targets and labels as one table: keys, value, label (labels only), row (targets only)."""
    tcols = [c for c in targets.columns if c not in keys]
    t = targets.select(
        *keys,
        F.col(value).cast("double").alias("_nl_v"),
        F.lit(None).cast("double").alias("_nl_label"),
        F.struct(*[F.col(c) for c in tcols]).alias("_nl_row"),
    )
    lab = labels.select(
        *keys,
        F.col(label).cast("double").alias("_nl_v"),
        F.col(label).cast("double").alias("_nl_label"),
        F.lit(None).cast(t.schema["_nl_row"].dataType).alias("_nl_row"),
    )
    return t.unionByName(lab)


def _picked(marked: DataFrame, targets: DataFrame, keys: list[str], out: str) -> DataFrame:
    return marked.filter(F.col("_nl_row").isNotNull()).select(
        *keys,
        *[F.col(f"_nl_row.{c}").alias(c) for c in targets.columns if c not in keys],
        pick_nearest(F.col("_nl_v"), F.col("_nl_lo"), F.col("_nl_hi")).alias(out),
    )


def nearest_label_split(
    targets: DataFrame,
    labels: DataFrame,
    value: str,
    label: str,
    keys: Sequence[str] = ("scene_id",),
    out: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``nearest_label`` for axes of any length: no task holds more than a few ranges of about equal
    size, however few the keys.

    Rows of one value may lie on both sides of a cut: a label equal to the target is then the
    first one behind the range or the last one before it, so it is found either way."""
    out = out or label
    keys = list(keys)
    # equal rows are dealt to several ranges by their place in the scan
    both = _both(targets, labels, value, label, keys).withColumn("_nl_tie", F.xxhash64(F.monotonically_increasing_id()))
    both = range_buckets(settled(both, "axis"), [*keys, "_nl_v", "_nl_tie"], "_nl_range", buckets)
    w = Window.partitionBy(*keys, "_nl_range")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    lo = F.last("_nl_label", ignorenulls=True).over(w.orderBy(F.asc("_nl_v")).rangeBetween(*so_far))
    hi = F.last("_nl_label", ignorenulls=True).over(w.orderBy(F.desc("_nl_v")).rangeBetween(*so_far))
    marked = both.select(*keys, "_nl_range", "_nl_v", "_nl_row", lo.alias("_nl_lo"), hi.alias("_nl_hi"))
    # a row per key and range
    ends = both.groupBy(*keys, "_nl_range").agg(F.min("_nl_label").alias("least"), F.max("_nl_label").alias("most"))
    ordered = Window.partitionBy(*keys).orderBy("_nl_range")
    before = F.last("most", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    after = F.last("least", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(F.desc("_nl_range")).rowsBetween(Window.unboundedPreceding, -1))
    carry = settled(ends.select(*[F.col(k).alias(f"_nl_k{n}") for n, k in enumerate(keys)], F.col("_nl_range").alias("_nl_at"), before.alias("_nl_before"), after.alias("_nl_after")), "carry")
    same = F.col("_nl_range") == F.col("_nl_at")
    for n, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_nl_k{n}"))
    found = marked.join(carry, same)
    found = found.withColumn("_nl_lo", F.coalesce("_nl_lo", "_nl_before")).withColumn("_nl_hi", F.coalesce("_nl_hi", "_nl_after"))
    return _picked(found, targets, keys, out)


def nearest_index_regular(v: Column, x0: Column, step: Column, n: Column) -> Column:
    """Index of the nearest label on a regular axis ``x0 + i*step`` (``step`` may be negative),
    clamped to ``0..n-1``; half-way ties go to the larger label value."""
    pos = (v - x0) / step
    # the larger label is the higher index on an ascending axis and the lower one on a
    # descending axis
    raw = F.when(step > 0, F.floor(pos + 0.5)).otherwise(F.ceil(pos - 0.5))
    return F.least(F.greatest(raw, F.lit(0)), n - 1).cast("long")
