"""Session and scratch-location helpers.

Library functions never create a session; they take the caller's.  These
helpers exist for tests, ``bench.py`` and the driver entry point.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "rainfold") -> SparkSession:
    """A local session configured the way the test-suite and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # Local sessions keep scratch tables in a folder that goes with the process.
        .config("spark.checkpoint.dir", _local_scratch())
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_scratch() -> str:
    """A scratch folder of this process, removed when it ends."""
    path = tempfile.mkdtemp(prefix="rainfold-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system);
    a machine-local folder would be invisible to other executors.  Only a
    local-mode session without the setting (tests) gets a fresh temp folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = _local_scratch()
        spark.sparkContext.setCheckpointDir(base)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location below the shared checkpoint folder."""
    path = f"{checkpoint_base(spark)}/rainfold-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES and name != "pyfiles":
        _SCOPES[-1].append(path)
    return path


_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Removes the scratch paths that were made inside, when it ends.

    For use around a query and the action that consumes it: a result that is
    read later must not be removed earlier.
    """
    mine: list[str] = []
    _SCOPES.append(mine)
    try:
        yield
    finally:
        _SCOPES.remove(mine)
        jvm = spark.sparkContext._jvm
        for path in mine:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme so Python-side code can open the path."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri



_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rainfold`` importable in Python workers (``addPyFile``).

    Pandas functions are pickled by reference to this package, so executors
    need it.  The package is zipped once per application, written below the
    shared scratch folder (through the Arrow file system of that URI) and
    registered with ``addPyFile``, which also serves it to remote executors.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import io
    import zipfile

    from pyarrow import fs as pafs

    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.join("rainfold", os.path.relpath(full, root)))
    target = scratch_path(spark, "pyfiles")
    filesystem, path = pafs.FileSystem.from_uri(target if "://" in target else "file://" + local_path(target))
    filesystem.create_dir(path, recursive=True)
    with filesystem.open_output_stream(f"{path}/rainfold.zip") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(f"{target}/rainfold.zip")
    _SHIPPED.add(app)


def materialize(df, name: str):
    """Cut lineage: write ``df`` as Parquet below the shared checkpoint folder
    and read it back.

    One job writes the rows; later stages read files that survive executor
    loss, and reads prune columns like any Parquet scan.  (A reliable RDD
    checkpoint of an unpersisted plan computes it twice.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{name}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
