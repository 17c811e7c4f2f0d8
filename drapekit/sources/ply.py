"""PLY point files: sink (S6), reader (S7) and output check (S8), in text and binary.

Sink: a Python data source writer takes Arrow batches, sorted by scene within each task, and writes
one complete, valid PLY shard per scene and task (header with its own vertex count + body).  ASCII
lines are built by Spark (``concat_ws`` of float32 / int casts, JVM side); binary records are packed
from Arrow columns.  The writer holds one scene at a time: the body waits in memory up to
``SPILL_BYTES``, then in a temporary file.  Nothing passes through the driver.

Commit: tasks write shards under their final names, and the driver writes one manifest that lists
them.  A shard is part of the output when the manifest says so: what a failed task, an aborted job
or a job that is still running has written is not seen by readers, and no file is moved.  Replaced
shards are deleted by tasks after the manifest has changed, so the old output stays whole until the
new one is.  A refused (empty) write changes nothing.

Layout: ``<path>/scene_id=<id>/part-<task>-<tag>.ply`` when the frame has ``scene_id``, else
``<path>/part-<task>-<tag>.ply``.  Scene ids are percent-encoded in paths; a NULL scene has the
folder ``scene_id=__HIVE_DEFAULT_PARTITION__``.  The header names the id's type.

Reader: ``spark.read.format("drapekit_ply").load(path)``, or ``read_ply``.  The schema comes from the
manifest, or from the headers of a folder without one.  Files are cut into ranges: records of a fixed
size in binary, line-aligned in text, so a large file is read by many tasks; small files share one.
Each file is typed by its own header.  Other elements are passed over: behind the vertices in any
file, in front of them where their records have a fixed size or a line each.  The option ``scenes``
(JSON array of ids as text, null for none) leaves out whole files in any session.  Filters on
``scene_id`` do so where the session has Spark's filter push-down for Python sources on when the
source is registered; elsewhere Spark tests the rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    WriterCommitMessage,
)

from drapekit.functions.coords import CloudError, export_frame, require_xyz
from drapekit.sources import ply_format as fmt
from drapekit.sources.fs import arrow_fs

FORMAT_NAME = "drapekit_ply"
MANIFEST = "_ply_manifest.json"
# a shard body is kept in task memory up to this size, then spilled to a temporary file
SPILL_BYTES = 64 << 20
# a read task's share of the files, and what it parses at a time
RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
NULL_SCENE = "__HIVE_DEFAULT_PARTITION__"
# fixed values: scene id types that the reader gives out typed; others come as text
SCENE_TYPES = {"string", "tinyint", "smallint", "int", "bigint", "boolean", "double", "float"}


def scene_folder(scene: str | None) -> str:
    return NULL_SCENE if scene is None else quote(scene, safe="")


def _scene_of(rel: str) -> str | None:
    found = re.search(r"(?:^|/)scene_id=([^/]*)/[^/]*$", rel)
    return None if not found or found[1] == NULL_SCENE else unquote(found[1])


# --------------------------------------------------------------------------------------
# manifest


@dataclass
class Shard(WriterCommitMessage):
    """A file of the output: path below the root, points, size, and its parsed header."""

    rel: str
    points: int
    bytes: int
    header: str

    def parsed(self) -> fmt.Header:
        return fmt.parse_header(self.rel, self.header.encode("latin-1"))


@dataclass
class _Written(WriterCommitMessage):
    shards: list[Shard]


def _read_manifest(path: str) -> list[Shard] | None:
    fs, root = arrow_fs(path)
    try:
        with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
            found = json.loads(f.read())
    except (FileNotFoundError, NotADirectoryError):
        return None
    return [Shard(s["path"], s["points"], s["bytes"], found["headers"][s["header"]].replace("{n}", str(s["points"]))) for s in found["files"]]


def _write_manifest(path: str, shards: list[Shard]) -> None:
    """One small object; it is in place as a whole or not at all."""
    fs, root = arrow_fs(path)
    headers: dict[str, int] = {}
    files = []
    for s in shards:
        like = re.sub(r"(?m)^element vertex \d+$", "element vertex {n}", s.header)
        files.append({"path": s.rel, "points": s.points, "bytes": s.bytes, "header": headers.setdefault(like, len(headers))})
    own = f"{root}/{MANIFEST}.{uuid.uuid4().hex[:12]}"
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(own) as f:
        f.write(json.dumps({"version": 1, "headers": list(headers), "files": files}).encode())
    fs.move(own, f"{root}/{MANIFEST}")


def _found(path: str) -> list[Shard]:
    """The PLY files under a folder (or one file), with their headers read, some at a time."""
    from concurrent.futures import ThreadPoolExecutor

    import pyarrow.fs as pafs

    fs, root = arrow_fs(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        infos, root = [info], os.path.dirname(root)
    else:
        infos = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    infos = sorted((i for i in infos if i.is_file and i.path.endswith(".ply")), key=lambda i: i.path)

    def shard(i) -> Shard:
        with fs.open_input_stream(i.path) as f:
            head = b""
            while b"end_header" not in head or b"\n" not in head[head.find(b"end_header") :]:
                chunk = f.read(4096)
                if not chunk or len(head) > fmt.MAX_HEADER:
                    break
                head += chunk
        header = fmt.parse_header(i.path, head)
        return Shard(os.path.relpath(i.path, root), header.vertex.count, i.size, head[: header.size].decode("latin-1"))

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(shard, infos))


def shards_of(path: str) -> tuple[str, list[Shard]]:
    """(folder, files below it) of an output: those of its manifest, else all PLY files there."""
    listed = _read_manifest(path)
    if listed is not None:
        return path.rstrip("/"), listed
    fs, place = arrow_fs(path)
    alone = fs.get_file_info(place).is_file
    return (os.path.dirname(path) if alone else path.rstrip("/")), _found(path)


# --------------------------------------------------------------------------------------
# sink


def _text_bytes(arr):
    """The concatenated text of an Arrow string array, sliced from its data buffer without
    building Python strings (each line already ends in a newline)."""
    import numpy as np
    import pyarrow as pa

    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if len(arr) == 0:
        return b""
    _, off_buf, data = arr.buffers()
    dtype = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    offsets = np.frombuffer(off_buf, dtype=dtype)[arr.offset : arr.offset + len(arr) + 1]
    return data.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))


class _Body:
    """The vertices of one scene in one task: in memory, beyond ``limit`` in a file."""

    def __init__(self, fs, path: str, limit: int):
        self.fs, self.path, self.limit = fs, path, limit
        self.buffers: list = []
        self.held = self.count = self.size = 0
        self.stream = None

    def put(self, data, n: int) -> None:
        self.count += n
        self.size += len(data)
        if self.stream is None and self.held + len(data) <= self.limit:
            self.buffers.append(data)
            self.held += len(data)
            return
        if self.stream is None:
            self.stream = self.fs.open_output_stream(self.path)
            for b in self.buffers:
                self.stream.write(b)
            self.buffers = []
        self.stream.write(data)

    def close(self, shard: str, header: bytes) -> int:
        with self.fs.open_output_stream(shard) as dst:
            dst.write(header)
            for b in self.buffers:
                dst.write(b)
            if self.stream is not None:
                self.stream.close()
                with self.fs.open_input_stream(self.path) as src:
                    while chunk := src.read(8 << 20):
                        dst.write(chunk)
                self.fs.delete_file(self.path)
        return len(header) + self.size


class _PlyArrowWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.overwrite = overwrite
        self.path = options["path"]
        self.properties = [tuple(p) for p in json.loads(options["properties"])]
        self.form = options.get("form", "ascii")
        self.spill_bytes = int(options.get("spill_bytes", SPILL_BYTES))
        self.scene_type = options.get("scene_type") or None
        self.refuse_empty = options.get("refuse_empty", "false") == "true"

    def _bytes(self, part):
        """The vertices of some rows, as they stand in a file."""
        import pyarrow as pa

        if self.form == "ascii":
            return _text_bytes(part.column(part.schema.get_field_index("line")))
        columns = [part.column(part.schema.get_field_index(n)) for n, _ in self.properties]
        return pa.py_buffer(fmt.pack(columns, self.properties, self.form).tobytes())

    def write(self, iterator):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        ctx = TaskContext.get()
        task = ctx.partitionId() if ctx else 0
        fs, root = arrow_fs(self.path)
        tag = uuid.uuid4().hex[:12]
        done: list[Shard] = []
        body, folder = None, None

        def close():
            rel = f"{folder}part-{task:05d}-{tag}.ply"
            fs.create_dir(os.path.dirname(f"{root}/{rel}"), recursive=True)
            header = fmt.header_text(self.properties, body.count, self.scene_type, self.form)
            done.append(Shard(rel, body.count, body.close(f"{root}/{rel}", header.encode()), header))

        for batch in iterator:
            if batch.num_rows == 0:
                continue
            # rows come sorted by scene, nulls first: cut where the scene changes
            if self.scene_type:
                scenes = batch.column(batch.schema.get_field_index("scene"))
                known = scenes.is_valid().to_numpy(zero_copy_only=False)
                codes = pc.dictionary_encode(scenes)
                number = np.where(known, codes.indices.fill_null(0).to_numpy(zero_copy_only=False), -1)
                cuts = np.concatenate([[0], np.flatnonzero(number[1:] != number[:-1]) + 1, [batch.num_rows]])
                parts = [(f"scene_id={scene_folder(scenes[int(a)].as_py())}/", int(a), int(b)) for a, b in zip(cuts, cuts[1:])]
            else:
                parts = [("", 0, batch.num_rows)]
            for own, a, b in parts:
                if body is None or own != folder:
                    if body is not None:
                        close()
                    fs.create_dir(root, recursive=True)
                    body, folder = _Body(fs, f"{root}/_{tag}-{len(done)}.body", self.spill_bytes), own
                put = self._bytes(batch.slice(a, b - a))
                # a kept buffer would hold its whole batch: keep only the part's bytes
                body.put(put if self.form != "ascii" or b - a == batch.num_rows else pa.py_buffer(bytes(put)), b - a)
        if body is not None:
            close()
        return _Written(done)

    def commit(self, messages):
        own = [s for m in messages if m is not None for s in m.shards]
        if self.refuse_empty and not sum(s.points for s in own):
            return  # the output stays what it was
        before = [] if self.overwrite else _read_manifest(self.path) or []
        _write_manifest(self.path, before + own)

    def abort(self, messages):
        fs, root = arrow_fs(self.path)
        for m in messages:
            for s in m.shards if m is not None else []:
                fs.delete_file(f"{root}/{s.rel}")


# --------------------------------------------------------------------------------------
# reader


class _Part(InputPartition):
    """What one task reads: ranges of files below a folder."""

    def __init__(self, root: str, pieces: list[tuple[Shard, fmt.Range]]):
        super().__init__(None)
        self.root, self.pieces = root, pieces


def _widest(a: str, b: str) -> str:
    return a if a == b else "bigint" if {a, b} == {"int", "bigint"} else "double"


def _schema(shards: Iterable[Shard]) -> tuple[dict[str, str], str | None]:
    """(column -> Spark type over all files, type of the scene id or None)."""
    columns: dict[str, str] = {}
    scenes = set()
    for text in {re.sub(r"(?m)^element vertex \d+$", "element vertex 0", s.header) for s in shards}:
        header = fmt.parse_header("header", text.encode())
        scenes.add(header.scene)
        for n, t in header.vertex.properties:
            kind = fmt.SPARK_TYPES[fmt.NUMPY_TYPES[t]]
            columns[n] = _widest(columns.get(n, kind), kind)
    known = scenes - {None}
    return columns, None if not known else known.pop() if len(known) == 1 else "string"


class _PlyReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path = options["path"]
        self.wanted = int(options.get("range_bytes", RANGE_BYTES))
        self.names = schema.names
        self.kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
        self.scene_type = schema["scene_id"].dataType.simpleString() if "scene_id" in schema.names else None
        self.scenes = json.loads(options["scenes"]) if "scenes" in options else None
        self.tests: list = []

    def _typed(self, scene: str | None):
        import pyarrow as pa

        kind = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "float": pa.float32()}
        return pa.array([scene], pa.string()).cast(kind.get(self.scene_type, pa.string()))

    def partitions(self):
        root, shards = shards_of(self.path)
        if self.scenes is not None:
            shards = [s for s in shards if _scene_of(s.rel) in self.scenes]
        if self.tests:
            shards = [s for s in shards if all(t(self._typed(_scene_of(s.rel))[0].as_py()) for t in self.tests)]
        parts, own, held = [], [], 0
        for s in shards:
            for r in fmt.ranges(s.rel, s.parsed(), s.bytes, self.wanted):
                if own and held + r.end - r.start > self.wanted:
                    parts.append(_Part(root, own))
                    own, held = [], 0
                own.append((s, r))
                held += r.end - r.start
        return [*parts, _Part(root, own)]

    def read(self, partition):
        import pyarrow as pa

        types = {n: fmt.ARROW_TYPES.get(t) for n, t in self.kinds.items()}
        for shard, part in partition.pieces:
            fs, p = arrow_fs(f"{partition.root}/{shard.rel}")
            header = shard.parsed()
            scene = self._typed(_scene_of(shard.rel)) if self.scene_type else None
            with fs.open_input_file(p) as f:
                if f.size() != shard.bytes:
                    raise CloudError(f"{shard.rel} has {f.size()} bytes, not the {shard.bytes} it was listed with")
                parse = fmt.read_ascii if header.format == "ascii" else fmt.read_binary
                for columns in parse(f, header, part, BLOCK_BYTES):
                    have = {n: c for (n, _), c in zip(header.vertex.properties, columns)}
                    n = len(columns[0])
                    out = []
                    for name in self.names:
                        if name == "scene_id" and self.scene_type:
                            out.append(pa.nulls(n, scene.type) if scene[0].as_py() is None else pa.repeat(scene[0], n))
                        else:
                            out.append(have[name].cast(types[name]) if name in have else pa.nulls(n, types[name]))
                    yield pa.RecordBatch.from_arrays(out, self.names)


class _FilteredPlyReader(_PlyReader):
    """Takes filters; Spark refuses such a reader where push-down is off."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == ("scene_id",):
                if isinstance(f, EqualTo | EqualNullSafe):
                    self.tests.append(lambda v, x=f.value: v == x)
                elif isinstance(f, In):
                    self.tests.append(lambda v, x=f.value: v in x)
                elif isinstance(f, IsNull):
                    self.tests.append(lambda v: v is None)
                elif isinstance(f, IsNotNull):
                    self.tests.append(lambda v: v is not None)
            yield f  # files are left out here; Spark still tests the rows


class PlyDataSource(DataSource):
    """``spark.read.format("drapekit_ply").load(path)``; and, for ``write_ply``,
    ``df.write.format("drapekit_ply").option("properties", json).save(path)`` with the column
    ``line`` (vertex text ending in a newline) or, with another ``form`` than ascii, the vertex
    columns, and, with the option ``scene_type``, ``scene`` (the id as text), sorted by scene within
    each task."""

    @classmethod
    def name(cls):
        return FORMAT_NAME

    def schema(self):
        _, shards = shards_of(self.options["path"])
        if not shards:
            raise CloudError(f"no PLY files under {self.options['path']}")
        columns, scene = _schema(shards)
        own = [f"scene_id {scene if scene in SCENE_TYPES else 'string'}"] if scene else []
        return ", ".join([*own, *[f"`{n}` {t}" for n, t in columns.items()]])

    def reader(self, schema):
        return _PlyReader(dict(self.options), schema)

    def writer(self, schema, overwrite):
        return _PlyArrowWriter(dict(self.options), overwrite)


class FilteredPlyDataSource(PlyDataSource):
    """The same for sessions with filter push-down."""

    def reader(self, schema):
        return _FilteredPlyReader(dict(self.options), schema)


def register_ply(spark: SparkSession) -> None:
    pushed = str(spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).lower() == "true"
    spark.dataSource.register(FilteredPlyDataSource if pushed else PlyDataSource)


def vertex_properties(vertices: DataFrame) -> list[tuple[str, str]]:
    """PLY property list of an ``export_frame`` result."""
    return [(f.name, fmt.PLY_TYPES[f.dataType.simpleString()]) for f in vertices.schema.fields if f.name != "scene_id"]


def vertex_lines(vertices: DataFrame) -> DataFrame:
    """``(scene?, line)``: the text of each vertex, sorted by scene within each task.  float32
    values are written as the shortest text that reads back to the same float32; a NULL value
    is written as ``nan``."""
    cols = [c for c in vertices.columns if c != "scene_id"]
    line = F.concat(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in cols]), F.lit("\n"))
    return _by_scene(vertices, [line.alias("line")])


def _by_scene(vertices: DataFrame, columns: list) -> DataFrame:
    if "scene_id" not in vertices.columns:
        return vertices.select(*columns)
    return vertices.select(F.col("scene_id").cast("string").alias("scene"), *columns).sortWithinPartitions("scene")


@dataclass(frozen=True)
class PlyOutput:
    """What ``write_ply`` wrote: the properties, and the points that went into the writer."""

    path: str
    properties: list
    points: int


def _delete(root: str):
    def run(batches):
        fs, base = arrow_fs(root)
        for batch in batches:
            for rel in batch.column(0).to_pylist():
                try:
                    fs.delete_file(f"{base}/{rel}")
                except FileNotFoundError:
                    pass
            yield batch

    return run


def _replaced(path: str) -> set[str]:
    """The files that an overwrite will replace."""
    listed = _read_manifest(path)
    if listed is not None:
        return {s.rel for s in listed}
    import pyarrow.fs as pafs

    fs, root = arrow_fs(path)
    infos = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    return {os.path.relpath(i.path, root) for i in infos if i.is_file and i.path.endswith(".ply")}


def write_ply(df: DataFrame, path: str, check_empty: bool = True, spill_bytes: int = SPILL_BYTES, form: str = "ascii") -> PlyOutput:
    """Write ``df`` (x, y, z + optional colours / normals, any names P17/P18 know) as PLY
    shards under ``path``, in one of ``ply_format.FORMATS``.  Raises on missing x/y/z or
    (``check_empty``) an empty cloud; what stood there before then stays.

    ``points`` of the result is counted in front of the writer, so S8 can tell whether the
    writer lost any."""
    require_xyz(df, check_empty=False)
    if form not in fmt.FORMATS:
        raise CloudError(f"unknown PLY format {form!r}")
    spark = df.sparkSession
    from drapekit.operators.aggregates import observed_count
    from drapekit.session import ship_package

    ship_package(spark)
    register_ply(spark)
    vertices = export_frame(df)
    props = vertex_properties(vertices)
    scene = vertices.schema["scene_id"].dataType.simpleString() if "scene_id" in vertices.columns else ""
    counted, seen = observed_count(vertices, "points")
    before = _replaced(path)
    # no repartition by scene: with one scene per job that would put the whole cloud in one
    # task; every task writes one shard per scene it holds instead
    rows = vertex_lines(counted) if form == "ascii" else _by_scene(counted, [n for n, _ in props])
    writer = rows.write.format(FORMAT_NAME).mode("overwrite").option("path", path).option("properties", json.dumps(props)).option("form", form)
    writer.option("scene_type", scene).option("spill_bytes", str(spill_bytes)).option("refuse_empty", str(check_empty).lower()).save()
    points = seen.get["points"]
    if check_empty and not points:
        raise CloudError("no point cloud data")
    if before:
        old = spark.createDataFrame([(rel,) for rel in sorted(before)], "rel string")
        old.repartition(max(1, len(before) // 1000)).mapInArrow(_delete(path), "rel string").write.format("noop").mode("overwrite").save()
    return PlyOutput(path, props, points)


def read_header(path: str) -> tuple[int, list[tuple[str, str]]]:
    """Vertex count and property list of one PLY file (reads only the header)."""
    vertex = fmt.read_head(path).vertex
    return vertex.count, vertex.properties


def read_ply(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The vertices of every shard under ``path`` (or one file), each typed by its own header.
    ``scene_id=`` folders become a column of the type that was written; columns that some
    shards lack are NULL there.  The rows do not depend on the session's settings."""
    from drapekit.session import ship_package

    ship_package(spark)
    register_ply(spark)
    _, shards = shards_of(path)
    if not shards:
        raise CloudError(f"no PLY files under {path}")
    out = spark.read.format(FORMAT_NAME).option("range_bytes", str(range_bytes)).load(path)
    scene = _schema(shards)[1]
    if scene and scene not in SCENE_TYPES:
        out = out.withColumn("scene_id", F.col("scene_id").cast(scene))
    return out


def _uri(path: str) -> str:
    """A path as Spark names files."""
    scheme, mark, rest = path.partition("://")
    if mark:
        return f"{scheme}://{quote(rest, safe='/:@=')}"
    return "file://" + quote(os.path.abspath(path.removeprefix("file:")), safe="/:@=")


def _checked(root: str):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found: dict[str, list] = {"path": [], "bytes": [], "points": [], "header_points": []}
            for rel in batch.column(0).to_pylist():
                fs, p = arrow_fs(f"{root}/{rel}")
                points = expected = size = None
                try:
                    header = fmt.read_head(f"{root}/{rel}")
                    size, expected = fs.get_file_info(p).size, header.vertex.count
                    rest = [e for e in header.elements if e.name != "vertex" and e.count]
                    with fs.open_input_file(p) as f:
                        if header.format == "ascii":
                            points = fmt.count_lines(f, header.size) - sum(e.count for e in rest)
                        elif rest:  # vertices that are there
                            points = sum(r.rows for r in fmt.ranges(rel, header, size, 1 << 62))
                        else:
                            body = size - header.size
                            stride = header.dtype(header.vertex).itemsize
                            points = body // stride if body % stride == 0 else -1
                except (FileNotFoundError, CloudError):  # not ok, and the report goes on
                    points = None
                for c, v in zip(found, (_uri(f"{root}/{rel}"), size, points, expected)):
                    found[c].append(v)
            yield pa.RecordBatch.from_pydict(found, schema=pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("bytes", "points", "header_points")]]))

    return run


def verify_output(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard of the output ``(path, bytes, points, header_points, ok)``: the vertex
    count in each header against the vertices actually present.  Every file is read once, by
    one task; a file that the manifest lists and that is gone has no points and is not ok."""
    from drapekit.session import ship_package

    ship_package(spark)
    root, shards = shards_of(path)
    files = spark.createDataFrame([(s.rel,) for s in shards], "rel string")
    # a task costs more than a small file: as many as the bytes need, at least two per core
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-sum(s.bytes for s in shards) // RANGE_BYTES))
    per = files.repartition(max(1, min(len(shards), tasks, 10_000))).mapInArrow(_checked(root), "path string, bytes long, points long, header_points long")
    return per.withColumn("ok", F.coalesce(F.col("points") == F.col("header_points"), F.lit(False)))


def verify_summary(report: DataFrame, expected: int | None = None) -> DataFrame:
    """Whole-output check: ``(files, bytes, points, ok)``.  With ``expected`` (``points`` of
    ``write_ply``) the output must also hold that many points."""
    same = F.lit(True) if expected is None else F.coalesce(F.sum("points"), F.lit(0)) == F.lit(expected)
    return report.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes"),
        F.coalesce(F.sum("points"), F.lit(0)).cast("long").alias("points"),
        (F.coalesce(F.bool_and("ok"), F.lit(True)) & same).alias("ok"),
    )
