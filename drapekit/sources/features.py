"""FeatureCollection files of any size, cut into byte ranges.

Where a feature starts in the middle of a JSON file depends on everything before it: whether a
byte is inside a string, and how deep it is nested.  Both can be added up:

1. each range is scanned by itself.  The parity of its quotes says whether it ends in a string given
   how it began, and its brackets are summed for either beginning,
2. running sums over the few rows of a file turn that into the true state where each range begins,
3. each range is read again, now with its state, and gives out the features that *begin* in it; the
   last one is read to its end behind the range.

A feature is an object in an array of the outermost object whose ``type`` is ``Feature``, so links
and other lists beside ``features`` do not count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from drapekit.sources.fs import arrow_fs

RANGE_BYTES = 32 << 20
# a task's share of the files; ranges smaller than that are read by the same task
TASK_BYTES = 32 << 20
_MORE = 1 << 20
#: fixed value: nesting of a feature's members (collection, its array, the feature)
FEATURE_DEPTH = 3


@dataclass
class Marks:
    """The quotes and brackets of some bytes, by place."""

    quotes: np.ndarray
    brackets: np.ndarray
    steps: np.ndarray  # +1 opens, -1 closes
    curly: np.ndarray

    def outside(self, in_string: int) -> np.ndarray:
        """Which brackets stand outside strings, given the state at the first byte."""
        return (np.searchsorted(self.quotes, self.brackets) + in_string) % 2 == 0


def marks(data: np.ndarray, escaped: bool) -> Marks:
    """``escaped``: an odd number of backslashes ends right before the first byte."""
    quotes = np.flatnonzero(data == 0x22)
    # a quote behind an odd number of backslashes belongs to its string
    lost = []
    for k in np.flatnonzero(np.where(quotes > 0, data[np.maximum(quotes - 1, 0)] == 0x5C, escaped)).tolist():
        at = before = int(quotes[k])
        while before > 0 and data[before - 1] == 0x5C:
            before -= 1
        if (at - before + (escaped if before == 0 else 0)) % 2:
            lost.append(k)
    curly_open, curly_close = data == 0x7B, data == 0x7D
    opens, closes = curly_open | (data == 0x5B), curly_close | (data == 0x5D)
    brackets = np.flatnonzero(opens | closes)
    return Marks(np.delete(quotes, lost), brackets, np.where(opens[brackets], 1, -1), (curly_open | curly_close)[brackets])


def ends_escaped(data: np.ndarray, escaped: bool) -> bool:
    """Whether an odd number of backslashes ends with the last byte."""
    other = np.flatnonzero(data[-4096:] != 0x5C)
    if len(other):
        return (min(len(data), 4096) - 1 - int(other[-1])) % 2 == 1
    other = np.flatnonzero(data != 0x5C)
    run = len(data) - 1 - int(other[-1]) if len(other) else len(data) + escaped
    return run % 2 == 1


def _escaped_before(f, start: int) -> bool:
    """Whether an odd number of backslashes ends right before ``start``."""
    run, at = 0, start
    while at > 0:
        size = min(4096, at)
        f.seek(at - size)
        raw = f.read(size)
        own = len(raw) - len(raw.rstrip(b"\\"))
        run += own
        if own < size:
            break
        at -= size
    return run % 2 == 1


def summary(data: np.ndarray, escaped: bool) -> tuple[int, int, int]:
    """(quotes modulo 2, depth gained if the bytes begin outside a string, the same inside)."""
    found = marks(data, escaped)
    return len(found.quotes) % 2, *(int(found.steps[found.outside(s)].sum()) for s in (0, 1))


def features(data: np.ndarray, escaped: bool, in_string: int, depth: int, more) -> list[tuple[int, bytes]]:
    """(place, bytes) of the features that begin in ``data``; ``more()`` gives the bytes behind it,
    block by block, and empty bytes at the end of the file."""
    found = marks(data, escaped)
    own = found.outside(in_string)
    place, step, curly = found.brackets[own], found.steps[own], found.curly[own]
    after = depth + np.cumsum(step)
    starts = place[curly & (step > 0) & (after == FEATURE_DEPTH)]
    ends = place[curly & (step < 0) & (after == FEATURE_DEPTH - 1)] + 1
    ends = ends[np.searchsorted(ends, starts[0], side="right") :] if len(starts) else ends[:0]
    out = [(int(a), data[a:b].tobytes()) for a, b in zip(starts, ends)]
    if len(starts) > len(ends):  # the last one goes on behind the range
        at = int(starts[-1])
        parts, level = [data[at:].tobytes()], int(after[-1])
        in_string, escaped = (in_string + len(found.quotes)) % 2, ends_escaped(data, escaped)
        while raw := more():
            block = np.frombuffer(raw, np.uint8)
            found = marks(block, escaped)
            own = found.outside(in_string)
            levels = level + np.cumsum(found.steps[own])
            closed = np.flatnonzero(levels < FEATURE_DEPTH)
            if len(closed):
                parts.append(raw[: int(found.brackets[own][closed[0]]) + 1])
                out.append((at, b"".join(parts)))
                break
            parts.append(raw)
            level = int(levels[-1]) if len(levels) else level
            in_string, escaped = (in_string + len(found.quotes)) % 2, ends_escaped(block, escaped)
    return out


def _scan(batches):
    import pyarrow as pa

    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            fs, p = arrow_fs(r["path"])
            with fs.open_input_file(p) as f:
                escaped = _escaped_before(f, r["start"])
                f.seek(r["start"])
                quotes, plain, quoted = summary(np.frombuffer(f.read(r["size"]), np.uint8), escaped)
            r |= {"quotes": quotes, "plain": plain, "quoted": quoted}
        yield pa.RecordBatch.from_pylist(rows)


def _extract(batches):
    import pyarrow as pa

    schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("value", pa.string())])
    for batch in batches:
        for r in batch.to_pylist():
            fs, p = arrow_fs(r["path"])
            with fs.open_input_file(p) as f:
                escaped = _escaped_before(f, r["start"])
                f.seek(r["start"])
                data = np.frombuffer(f.read(r["size"]), np.uint8)
                found = features(data, escaped, r["in_string"], r["depth"], lambda f=f: f.read(_MORE))
            for k in range(0, len(found), 1000):
                own = found[k : k + 1000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["path"]] * len(own)), pa.array([r["start"] + a for a, _ in own], pa.int64()), pa.array([raw.decode("utf-8", "replace") for _, raw in own])], schema=schema
                )


def _files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of the files of a folder that Spark would read."""
    import pyarrow.fs as pafs

    fs, root = arrow_fs(path)
    scheme = path.partition("://")[0] + "://" if "://" in path and not path.startswith("file:") else ""
    info = fs.get_file_info(root)
    infos = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(root, recursive=True))
    return sorted((scheme + i.path, i.size) for i in infos if i.is_file and not any(part[:1] in "_." for part in i.path[len(root) :].split("/") if part))


def read_features(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, place, value)``: the text of every feature of the FeatureCollection files under
    ``path``, with the byte it begins at.  Files are read in ranges, dealt to tasks by their bytes."""
    from drapekit.operators.small import settled
    from drapekit.session import ship_package

    ship_package(spark)
    files = _files(path)
    count, held = sum(-(-n // range_bytes) for _, n in files), sum(n for _, n in files)
    # a task costs more than a small range: as many as the bytes need, at least two per core
    tasks = max(1, min(count, 10_000, max(2 * spark.sparkContext.defaultParallelism, -(-held // TASK_BYTES))))
    kinds = "path string, number long, start long, size long"
    cuts = spark.createDataFrame([f for f in files if f[1]], "path string, bytes long")
    cuts = cuts.select("path", "bytes", F.explode(F.expr(f"sequence(0L, (bytes - 1) div {range_bytes})")).alias("number"))
    ranges = cuts.select("path", "number", (F.col("number") * range_bytes).alias("start"), F.least(F.lit(range_bytes).cast("long"), F.col("bytes") - F.col("number") * range_bytes).alias("size"))
    ranges = ranges.repartition(tasks)
    # a row per range
    scanned = settled(ranges.mapInArrow(_scan, f"{kinds}, quotes long, plain long, quoted long"), "ranges")
    before = Window.partitionBy("path").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    begun = scanned.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    gained = F.when(F.col("in_string") == 0, F.col("plain")).otherwise(F.col("quoted"))
    begun = begun.withColumn("gained", gained).withColumn("depth", F.coalesce(F.sum("gained").over(before), F.lit(0)))
    begun = begun.select("path", "start", "size", "in_string", "depth").repartition(tasks)
    found = begun.mapInArrow(_extract, "path string, place long, value string")
    return found.where(F.get_json_object("value", "$.type") == "Feature")
