"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "brindle", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local session, where driver and executors share one disk, may fall back to a
    temporary folder; a cluster without the setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="brindle-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(base)
    return base


_run_dirs: set[str] = set()


def run_dir(spark: SparkSession) -> str:
    """The folder of this application below `shared_dir`; its owner removes it at exit."""
    context = spark.sparkContext
    path = f"{shared_dir(spark).rstrip('/')}/brindle/{context.applicationId}"
    if path not in _run_dirs:
        _run_dirs.add(path)
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(context._jsc.hadoopConfiguration())

        def remove() -> None:
            with contextlib.suppress(Py4JError, OSError):  # the JVM may be gone
                system.delete(folder, True)

        atexit.register(remove)
    return path


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A path below `run_dir` that nothing has been written to."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back, with a folder per value of the columns `by`.

    The table lives as long as the program, or until `free`. This cuts lineage in a way that survives
    the loss of executors, and because the result is a Parquet table its later readers prune columns
    and Catalyst knows its size, so a join with it is broadcast only below
    `spark.sql.autoBroadcastJoinThreshold`.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def free(*tables: DataFrame) -> None:
    """Delete tables that `materialize` has returned; whatever reads them must have been written."""
    for table in tables:
        context = table.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(table._written_to)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame) -> DataFrame:
    """Split a scan with fewer partitions than cores; leaves every larger scan as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
