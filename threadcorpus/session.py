"""Session construction and shared-storage helpers."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (a shuffle
# join whose side turns out small becomes a broadcast join; skewed partitions
# are split), and UTC keeps epoch-second arithmetic independent of the host.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "threadcorpus", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster the submitter decides both.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each application; Python stages import it there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), f"threadcorpus-source-{sc.applicationId}.zip")
    with zipfile.ZipFile(path, "w") as packed:  # stays while the application runs: executors fetch it from the driver
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    packed.write(file, os.path.relpath(file, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. When it is unset, a local session gets a fresh folder under the system
    temporary directory; on a cluster, whose machines do not share that, it is
    an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="threadcorpus-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in the checkpoint folder.

    Used for reusable models (lexicon, n-gram profile), stage outputs and
    results whose physical layout later steps depend on. Unlike an eager
    ``checkpoint()`` of an uncached plan, the plan runs once; the table read
    back carries file sizes the planner uses for join decisions.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession) -> str:
    """A new folder for an intermediate table; within :func:`scratch` it is deleted at the end."""
    path = os.path.join(checkpoint_dir(spark), "tables", uuid.uuid4().hex)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end the tables that :func:`materialize` writes within, also after an error.

    Frames that read them must not be used afterwards.
    """
    _SCRATCH.append([])
    tables = {t.name for t in spark.catalog.listTables()}
    try:
        yield
    finally:
        for table in spark.catalog.listTables():
            if table.name not in tables and table.name.startswith("thread_store_"):
                spark.sql(f"DROP TABLE IF EXISTS {table.name}")
        for name in _SCRATCH.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def in_scratch(job: Callable) -> Callable:
    """A job ``(spark, ...)`` that leaves nothing but its outputs: its intermediate tables are deleted."""
    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with scratch(spark):
            return job(spark, *args, **kwargs)
    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
