"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators rely on: UTC for hour()/to_date(), ANSI arithmetic,
# adaptive execution (runtime broadcast decisions, skew-join splitting,
# partition coalescing) and day-level overwrite of partitioned tables.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Python call sites in error messages cost several JVM round trips per
    # Column call; the 190-column plans are built from thousands of them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "pagefeatures",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster, leave ``master`` as None so that spark-submit decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: days that one task writes side by side; rows of further ones are sorted by day first
DAYS_OPEN = 8


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    """One setting of the session, put back at the end of the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def days_side_by_side(spark: SparkSession, days: int = DAYS_OPEN):
    """Writes partitioned by day keep a file open for each day instead of sorting their rows by day.

    The sort holds every column of a task's rows, and spills where a task reads many
    rows from small files.  The setting is put back at the end of the block.
    """
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(days))


def shuffles_freed(spark: SparkSession):
    """What is written in the block drops its shuffle files when it is written.

    Otherwise they stay until the driver's garbage collector comes across them, so the
    disk holds those of several steps at once.  The written table is what later steps
    read, and nothing else reads these files.  The setting is put back at the end of the block.
    """
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only a local-mode session without one gets a private folder under the
    system temp dir; a cluster session without one is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            d = None
    if not d:
        jdir = sc._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            # the context appends a random sub-folder; share its parent
            d = jdir.get().rsplit("/", 1)[0]
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="pagefeatures-")
        sc.setCheckpointDir(os.path.join(d, "checkpoints"))
        spark.conf.set("spark.checkpoint.dir", d)
    elif not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(d.rstrip("/") + "/checkpoints")
    return d.rstrip("/")


def _at(spark: SparkSession, path: str):
    """(file system, path) of Hadoop: HDFS, object stores, local."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system (HDFS, object stores, local)."""
    fs, p = _at(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it exists, through the Hadoop file system."""
    fs, p = _at(spark, path)
    fs.delete(p, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file or folder; ``new`` must not exist."""
    fs, p = _at(spark, old)
    _, to = _at(spark, new)
    if not fs.rename(p, to):
        raise OSError(f"cannot rename {old} to {new}")


def swap_in(spark: SparkSession, new: str, place: str) -> None:
    """Put a finished folder in ``place``, where another one may be: that one leaves only now.

    A failure between the two steps leaves ``new`` as it is, so the call can be repeated.
    """
    remove_path(spark, place)
    rename_path(spark, new, place)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    Their functions are then found also where the package isn't installed.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    with tempfile.TemporaryDirectory() as folder:
        target = os.path.join(folder, "pagefeatures-code.zip")
        with zipfile.ZipFile(target, "w") as z:
            for at, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(at, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
        fs, shared = _at(spark, f"{shared_dir(spark)}/code/{sc.applicationId}/pagefeatures-code.zip")
        _, local = _at(spark, f"file://{target}")
        fs.copyFromLocalFile(True, True, local, shared)
    sc.addPyFile(fs.makeQualified(shared).toString())
    _SHIPPED.add(sc.applicationId)
