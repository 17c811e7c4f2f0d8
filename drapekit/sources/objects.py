"""Object storage: read object bytes, whole or in blocks (S2), and copy objects to an output folder (S3).

Credentials and endpoints belong to the Hadoop / Arrow filesystem configuration
(``spark.hadoop.fs.s3a.*`` for Spark reads); nothing here logs or embeds them.

S3 copies run inside tasks (``mapInPandas`` over the manifest, spread by ``repartition``),
each task streaming its objects from the source filesystem to the destination.  The result
table (one row per object: where it went, its size, or why it failed) is written to the
shared checkpoint folder and read back, so the copies happen exactly once per run even though
later steps look at the result several times.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drapekit.functions.text import resolve_object
from drapekit.session import scratch_path

FETCH_SCHEMA = "ref string, name string, path string, bytes long, error string"
BLOCK_SCHEMA = "path string, modificationTime timestamp, length long, place long, content binary"


def read_objects(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    recursive: bool = False,
    block_bytes: int | None = None,
    span: tuple[int, int | None] = (0, None),
) -> DataFrame:
    """One row per object ``(path, modificationTime, length, content)``.

    With ``block_bytes`` one row per block ``(path, modificationTime, length, place, content)`` of
    the bytes from ``span``'s start up to its end: objects of any size.  A task has the span of one
    large object, or of small ones of ``spark.sql.files.maxPartitionBytes`` together, each from
    front to back.  Blocks need a store that Arrow reads (``reads_ranges``).  Spark lists no
    empty objects, so neither form has a row for them."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    objects = reader.load(path)
    if block_bytes is None:
        return objects
    from drapekit.session import ship_package

    ship_package(spark)
    objects = objects.select("path", "modificationTime", "length")
    if span[0]:
        objects = objects.where(F.col("length") > span[0])
    return objects.mapInArrow(_block_batches(block_bytes, *span), BLOCK_SCHEMA)


def _block_batches(block_bytes: int, start: int, end: int | None):
    def run(batches):
        import pyarrow as pa

        from drapekit.sources.fs import arrow_fs as fs_of

        for batch in batches:
            for k, (path, length) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                stop = length if end is None else min(end, length)
                fs, p = fs_of(path)
                with fs.open_input_file(p) as f:
                    f.seek(start)
                    for place in range(start, stop, block_bytes):
                        content = f.read(min(block_bytes, stop - place))
                        if len(content) != min(block_bytes, stop - place):
                            raise OSError(f"{path} is shorter than it was listed: {length} bytes")
                        own = [*batch.slice(k, 1).columns, pa.array([place], pa.int64()), pa.array([content], pa.binary())]
                        yield pa.RecordBatch.from_arrays(own, [*batch.schema.names, "place", "content"])

    return run


def object_manifest(refs: DataFrame, ref: str = "ref", bucket: str = "bucket", default_bucket: str | None = None, roots: dict[str, str] | None = None) -> DataFrame:
    """References -> ``(ref, src, name, error)`` with ``src = s3://bucket/key`` (P3).  ``roots``
    maps buckets to other places (a mirror, a mounted folder)."""
    b = F.col(bucket) if bucket in refs.columns else F.lit(None).cast("string")
    r = refs.select(F.col(ref).alias("ref"), resolve_object(F.col(ref), b, default_bucket).alias("o"))
    root = F.concat(F.lit("s3://"), F.col("o.bucket"))
    for name, place in (roots or {}).items():
        root = F.when(F.col("o.bucket") == name, F.lit(place.rstrip("/"))).otherwise(root)
    return r.select(
        "ref",
        F.when(F.col("o.error").isNull(), F.concat(root, F.lit("/"), F.col("o.key"))).alias("src"),
        F.col("o.filename").alias("name"),
        F.col("o.error").alias("error"),
    )


def _copy_batches(out_dir: str):
    def run(batches):
        from drapekit.sources.fs import arrow_fs as fs_of

        dst_fs, dst_root = fs_of(out_dir)
        dst_fs.create_dir(dst_root, recursive=True)
        for pdf in batches:
            paths, sizes, errors = [], [], []
            for src, name, err in zip(pdf["src"], pdf["name"], pdf["error"]):
                if err is not None and not (isinstance(err, float) and pd.isna(err)):
                    paths.append(None), sizes.append(None), errors.append(err)
                    continue
                target = f"{dst_root}/{name}"
                # a failed or speculative attempt leaves at most a file of its own
                part = f"{dst_root}/.{uuid.uuid4().hex}.part"
                try:
                    sfs, spath = fs_of(src)
                    n = 0
                    with sfs.open_input_stream(spath) as fin, dst_fs.open_output_stream(part) as fout:
                        while True:
                            chunk = fin.read(8 << 20)
                            if not chunk:
                                break
                            fout.write(chunk)
                            n += len(chunk)
                    dst_fs.move(part, target)
                    paths.append(target), sizes.append(n), errors.append(None)
                except Exception as e:  # noqa: BLE001 - reported per object
                    paths.append(None), sizes.append(None), errors.append(f"{type(e).__name__}: {e}"[:500])
            yield pd.DataFrame(
                {"ref": pdf["ref"], "name": pdf["name"], "path": paths, "bytes": pd.array(sizes, dtype="Int64"), "error": errors}
            )

    return run


def fetch_objects(
    manifest: DataFrame,
    out_dir: str,
    fail_fast: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """S3: copy each ``src`` to ``out_dir/name``; returns ``(ref, name, path, bytes, error)``.

    Two refs with one file name would overwrite each other; the one with the largest ``ref``
    is copied and the others are reported as ``SHADOWED``.  ``fail_fast`` raises after the run
    when any object failed (the whole batch counts as failed, like the reference)."""
    spark = manifest.sparkSession
    from drapekit.session import ship_package

    ship_package(spark)
    m = manifest.select("ref", "src", "name", "error")
    winner = m.filter(F.col("error").isNull()).groupBy("name").agg(F.max("ref").alias("_win"))
    m = m.join(winner, "name", "left").select(
        "ref",
        "src",
        "name",
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("ref") != F.col("_win"), F.lit("SHADOWED"))
        .alias("error"),
    )
    if partitions:
        m = m.repartition(partitions, "name")
    else:
        m = m.repartition("name")
    copied = m.mapInPandas(_copy_batches(out_dir), FETCH_SCHEMA)
    result_path = scratch_path(spark, "fetch")
    copied.write.mode("overwrite").parquet(result_path)
    result = spark.read.parquet(result_path)
    if fail_fast:
        bad = result.filter(F.col("error").isNotNull() & (F.col("error") != "SHADOWED")).limit(3).collect()
        if bad:
            raise RuntimeError(f"object fetch failed: {[(r['ref'], r['error']) for r in bad]}")
    return result
