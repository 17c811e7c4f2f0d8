"""Session helpers.

The library never creates a session on its own inside an operator; these helpers are for
scripts, tests and the bench.  On a cluster the session is configured by the platform and
``checkpoint_dir`` only reads what is there.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on (fixed values, chosen for correctness, not speed):
#   UTC session time zone - timestamps compare the same way as the SQL oracle
#   filter push-down    - the PLY reader leaves out the files of other scenes
#   AQE on              - runtime re-planning: coalescing, skew splits, broadcast by real size
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app: str = "drapekit",
    shuffle_partitions: int = 8,
    conf: dict | None = None,
) -> SparkSession:
    """Create (or get) a session with the library's defaults.

    ``master`` defaults to ``local[$BENCH_CPUS or 8]`` for local work; on a cluster pass
    ``None`` through ``spark-submit`` instead of calling this helper.
    """
    if master is None:
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.setdefault("spark.driver.memory", os.environ.get("DRAPEKIT_DRIVER_MEMORY", "16g"))
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session (one machine, as in tests) may go
    without: it gets a fresh folder under the system temp dir.  Any other session raises,
    because its executors would each write to a disk of their own."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        return configured
    if sc is None or not (sc.master or "").startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="drapekit-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for intermediate tables and outputs.  It goes
    when the driver's JVM ends (or earlier, with ``drop_scratch``): results are lazy frames
    that read it until then."""
    import uuid

    path = f"{checkpoint_dir(spark).rstrip('/')}/drapekit-{name}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)  # the file system only remembers folders that exist
    files.deleteOnExit(folder)
    # the folder itself is made again by whoever writes to it
    files.delete(folder, True)
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders made so far.  Frames that still read them become invalid."""
    while _SCRATCH:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``drapekit`` importable in the Python workers: zip the package once per
    application and hand it to ``addPyFile`` (what ``--py-files`` does at submit time).
    Code that runs inside tasks (co-grouped kNN cells, the PLY writer, object copies) imports
    from the package, and workers do not share the driver's ``sys.path``."""
    import zipfile

    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect: ship as a session artifact
        sc, key = None, f"connect-{id(spark)}"
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="drapekit-pkg-"), "drapekit.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(key)
