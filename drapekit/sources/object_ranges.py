"""Objects of any size as byte ranges (S2): a data source with rows (path, place, content).

One row per block, planned from the objects' sizes; a large object is read by many tasks and never
stands in memory as a whole.  The digest of a whole object is md5, which can only be worked out from
front to back: ``object_digests`` does so in turns, each with a segment of every object that is left
and the state that the turn before came to (``md5_state``), so a task reads a segment at most.
``block_digests`` works in parallel: the digest of the blocks' digests, in the order of their place.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from drapekit.sources.fs import arrow_fs

FORMAT_NAME = "drapekit_ranges"
BLOCK_BYTES = 4 << 20
TASK_BYTES = 64 << 20
#: bytes of one object that a task digests in a turn; a multiple of md5's 64
SEGMENT_BYTES = 256 << 20


@dataclass
class _Piece:
    path: str
    start: int
    size: int
    whole: int


class _Part(InputPartition):
    def __init__(self, pieces: list[_Piece]):
        super().__init__(None)
        self.pieces = pieces


class _RangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.glob = options.get("glob", "*")
        self.block = int(options.get("block_bytes", BLOCK_BYTES))
        self.wanted = int(options.get("task_bytes", TASK_BYTES))
        # with a span, what an object has in it is one task's
        self.span = [int(x) for x in options["span"].split(",") if x] if "span" in options else None

    def objects(self) -> list[tuple[str, int]]:
        import pyarrow.fs as pafs

        fs, root = arrow_fs(self.path)
        scheme = self.path.partition("://")[0] + "://" if "://" in self.path else ""
        info = fs.get_file_info(root)
        infos = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        return sorted((scheme + i.path, i.size) for i in infos if i.is_file and fnmatch.fnmatch(i.base_name, self.glob))

    def partitions(self):
        parts, own, held = [], [], 0
        for path, n in self.objects():
            first, last = (*(self.span or [0]), n)[:2]
            last = min(last, n)
            if first and first >= n:
                continue
            # an empty object is one empty block
            for start in range(first, last, self.block) or [0]:
                size = min(self.block, last - start)
                more = size if self.span is None else last - first
                if own and held + more > self.wanted and (self.span is None or start == first):
                    parts.append(_Part(own))
                    own, held = [], 0
                own.append(_Piece(path, start, size, n))
                held += size
        return [*parts, _Part(own)]

    def read(self, partition):
        import pyarrow as pa

        f, opened = None, None
        for piece in partition.pieces:
            if piece.path != opened:
                if f is not None:
                    f.close()
                fs, p = arrow_fs(piece.path)
                f, opened = fs.open_input_file(p), piece.path
            f.seek(piece.start)
            content = f.read(piece.size)
            if len(content) != piece.size:
                raise OSError(f"{piece.path} is shorter than it was listed: {piece.whole} bytes")
            yield pa.RecordBatch.from_arrays([pa.array([piece.path]), pa.array([piece.start]), pa.array([piece.whole]), pa.array([content], pa.binary())], ["path", "place", "size", "content"])


class RangeDataSource(DataSource):
    """``spark.read.format("drapekit_ranges").option("glob", "*.tif").load(folder)``"""

    @classmethod
    def name(cls):
        return FORMAT_NAME

    def schema(self):
        return "path string, place long, size long, content binary"

    def reader(self, schema):
        return _RangeReader(dict(self.options))


def read_ranges(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    block_bytes: int = BLOCK_BYTES,
    task_bytes: int = TASK_BYTES,
    span: tuple[int, int | None] | None = None,
) -> DataFrame:
    """``(path, place, size, content)``: a row per block of each object; size is the object's.  With
    ``span`` only the bytes from its start up to its end, those of an object in one task, from front
    to back."""
    from drapekit.session import ship_package

    ship_package(spark)
    spark.dataSource.register(RangeDataSource)
    reader = spark.read.format(FORMAT_NAME).option("glob", glob).option("block_bytes", str(block_bytes))
    if span is not None:
        reader = reader.option("span", ",".join(str(x) for x in span if x is not None))
    return reader.option("task_bytes", str(task_bytes)).load(path)


def largest_object(path: str, glob: str = "*") -> int:
    return max((n for _, n in _RangeReader({"path": path, "glob": glob}).objects()), default=0)


def _streamed(batches):
    import hashlib

    import pyarrow as pa

    path, digest, n = None, None, 0

    def row():
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([digest.hexdigest()])], ["path", "bytes", "md5"])

    for batch in batches:
        for own, content in zip(batch.column(0).to_pylist(), batch.column(2)):
            if own != path:
                if path is not None:
                    yield row()
                path, digest, n = own, hashlib.md5(), 0
            raw = content.as_buffer()
            digest.update(raw)
            n += raw.size
    if path is not None:
        yield row()


def _turn(start: int, end: int | None):
    """The blocks from start to end ``(path, place, size, content, state)``, an object's in one task and in
    their order -> ``(path, bytes, state, md5)``: md5 where the object ends, else the state it came to."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        from drapekit.sources.md5_state import Md5

        path, digest, n, size = None, None, 0, 0

        def row():
            if n != (size if end is None else min(end, size)):
                raise OSError(f"{path}: {n} bytes came, of {size}")
            state, md5 = (None, digest.hexdigest()) if n == size else (digest.state(), None)
            own = [pa.array([path]), pa.array([n], pa.int64()), pa.array([state], pa.binary()), pa.array([md5], pa.string())]
            return pa.RecordBatch.from_arrays(own, ["path", "bytes", "state", "md5"])

        for batch in batches:
            for own, place, whole, content, state in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3), batch.column(4).to_pylist()):
                if own != path:
                    if path is not None:
                        yield row()
                    path, size, n = own, whole, start
                    if start:
                        digest = Md5(state, start)
                    else:
                        digest = hashlib.md5() if end is None or size <= end else Md5()
                if place != n:
                    raise OSError(f"{path}: blocks are not in the order of their place")
                raw = content.as_buffer()
                digest.update(raw)
                n += raw.size
        if path is not None:
            yield row()

    return run


def object_digests(ranges: DataFrame | Callable[[tuple[int, int | None]], DataFrame], largest: int = 0, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``(path, bytes, md5)`` of whole objects.

    ``ranges`` gives the blocks of a span (``read_ranges`` or ``read_objects`` with ``span``), and
    ``largest`` is the largest object's size.  md5 goes from front to back, so an object over
    ``segment_bytes`` takes several turns, each a job of its own: no task reads more of it than a
    segment.  Blocks that were read before (a frame) meet by object, so each object is one task's."""
    if isinstance(ranges, DataFrame):
        own = ranges.select("path", "place", "content").repartition("path").sortWithinPartitions("path", "place")
        return own.mapInArrow(_streamed, "path string, bytes long, md5 string")
    if segment_bytes % 64:
        raise ValueError("segment_bytes must be a multiple of 64")
    blocks, done = ["path", "place", "size", "content"], "path string, bytes long, state binary, md5 string"
    if largest <= segment_bytes:
        whole = ranges((0, None)).select(*blocks, F.lit(None).cast("binary").alias("state"))
        return whole.mapInArrow(_turn(0, None), done).select("path", "bytes", "md5")
    from drapekit.session import scratch_path

    start, left, states = 0, None, None
    while left is None or left:
        span = (start, start + segment_bytes)
        own = ranges(span).select(*blocks)
        # states are a few bytes for each object that is larger than a segment; the blocks stay where they are read
        own = own.withColumn("state", F.lit(None).cast("binary")) if states is None else own.join(F.broadcast(states), "path")
        spark = own.sparkSession
        root = scratch_path(spark, "digests") if states is None else root
        own.mapInArrow(_turn(*span), done).write.parquet(f"{root}/{start}")
        turn = spark.read.schema(done).parquet(f"{root}/{start}")
        came, ended = turn.agg(F.count("path"), F.count("md5")).first()
        if left is not None and came != left:
            raise OSError(f"{left - came} objects went while they were read")
        start, left, states = span[1], came - ended, turn.where("md5 is null").select("path", "state")
    turns = spark.read.schema(done).option("recursiveFileLookup", "true").parquet(root)
    return turns.where("md5 is not null").select("path", "bytes", "md5")


def block_digests(ranges: DataFrame) -> DataFrame:
    """``(path, bytes, blocks, digest)``: SHA-256 over the blocks' SHA-256 in the order of their place.
    Blocks are digested where they are read; only digests meet."""
    own = ranges.select("path", "place", F.length("content").alias("n"), F.sha2("content", 256).alias("own"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "own")))
    joined = F.array_join(F.transform(ordered, lambda b: b["own"]), "")
    return own.groupBy("path").agg(F.sum("n").alias("bytes"), F.count(F.lit(1)).alias("blocks"), F.sha2(joined, 256).alias("digest"))
