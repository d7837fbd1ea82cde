"""Spark session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the sizing: it coalesces small shuffle partitions, splits skewed
# join and rebalance partitions, and turns a join into a broadcast only after it has
# measured the side. Everything here can be overridden per job.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the engine's defaults; ``settings`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = dict(SETTINGS)
    options.update({k.replace("__", "."): v for k, v in settings.items()})
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Where the intermediates of the job at hand go, if it removes them when it is done.
_scratch: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; it then uses a temporary folder. On
    a cluster the folder should name its store (``hdfs://``, ``s3a://``, ``file://`` for a mounted
    one): a bare path may mean another disk on each machine. One that Spark was started with has
    been resolved in the default store, and that is taken; if it is a disk, once it has been seen
    that what all tasks write there is found again. Where another user has made the folder for
    intermediates below it, so that this one can't write there, the folder that Spark has made
    there for this application is taken.
    """
    context = spark.sparkContext
    resolved = context.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or resolved
    local = context.master.startswith("local")
    if not folder:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sessionlake-"))
        folder = context.getCheckpointDir()
    elif not local and not _names_store(folder):
        if not resolved or not _names_store(resolved):
            raise RuntimeError(f"spark.checkpoint.dir must name its store on a cluster: {folder!r}")
        folder = resolved.rstrip("/")
        if folder.startswith("file:") and folder not in _seen_shared:
            _see_shared(spark, folder)
            _seen_shared.add(folder)
    elif resolved and folder != resolved and not _writable(spark, f"{folder.rstrip('/')}/sessionlake"):
        folder = resolved
    return folder.rstrip("/")


# Disks that a look has found to be shared.
_seen_shared: set[str] = set()


def _names_store(folder: str) -> bool:
    return "://" in folder or folder.startswith("file:")


# Folders that were tried, and whether this user can write below them.
_tried: dict[str, bool] = {}


def _writable(spark: SparkSession, folder: str) -> bool:
    if folder not in _tried:
        files, address = _file_system(spark, f"{folder}/look-{uuid.uuid4().hex}")
        try:
            _tried[folder] = files.mkdirs(address)  # a disk says no, other stores raise
        except Py4JJavaError:
            _tried[folder] = False
        if _tried[folder]:
            files.delete(address, True)
    return _tried[folder]


def _see_shared(spark: SparkSession, folder: str) -> None:
    """Raise unless every row that tasks write below ``folder`` is read back. A write to disks of
    several machines doesn't fail by itself: rows would be missing."""
    n = max(2, spark.sparkContext.defaultParallelism)
    path = f"{folder}/sessionlake/shared-{uuid.uuid4().hex}"
    spark.range(0, n, 1, n).write.parquet(path)
    found = spark.read.schema("id long").parquet(path).count()
    files, address = _file_system(spark, path)
    files.delete(address, True)
    if found != n:
        raise RuntimeError(
            f"spark.checkpoint.dir must name its store on a cluster: not all executors share {folder!r}"
        )


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no other run uses."""
    parent = _scratch.get() or f"{shared_folder(spark)}/sessionlake"
    return f"{parent}/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    address = spark._jvm.org.apache.hadoop.fs.Path(path)
    return address.getFileSystem(spark._jsc.hadoopConfiguration()), address


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store it names."""
    files, address = _file_system(spark, path)
    return files.exists(address)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder, in whatever store its path names, unless it is there."""
    files, address = _file_system(spark, path)
    files.mkdirs(address)


@contextlib.contextmanager
def intermediates_removed(spark: SparkSession) -> Iterator[None]:
    """Remove what the job inside has materialized, when it ends, well or not. Frames that are
    returned from it mustn't read intermediates any more."""
    if _scratch.get() is not None:  # part of a larger job
        yield
        return
    folder = new_folder(spark, "job")
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        files, address = _file_system(spark, folder)
        files.delete(address, True)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and keeps later reads columnar. The
    size of what is read is known then, so Spark broadcasts it if it is small enough.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
