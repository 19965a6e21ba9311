"""Session, table access and lineage cutting shared by all operators."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "passageworks", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; settings the cluster already made are kept."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return (
        b.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; a temporary one only where that is unset and all
    executors are on this machine. Raises ValueError on a cluster without one."""
    conf = spark.sparkContext.getConf()
    found = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="passageworks-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_written: list[str] = []


def materialize(df: DataFrame, hint: str = "t") -> DataFrame:
    """Cut the lineage: write df once as Parquet into the shared folder and read it back.

    Unlike a cached or locally checkpointed frame the files outlive any executor, and later readers prune columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{hint}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Let the driver notice unreachable plans now, so the shuffle files of steps already written out leave the disks."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def drop_materialized(spark: SparkSession) -> int:
    """Delete what materialize has written in this process; call it when no frame built on it is needed any more."""
    n = 0
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def share_file(spark: SparkSession, path: str) -> str:
    """Send a file of the driver or of a shared file system to all executors; the name under which SparkFiles.get finds it there."""
    if (key := (spark.sparkContext.applicationId, path)) not in _shared:
        spark.sparkContext.addFile(path)
        _shared.add(key)
    return os.path.basename(path)


_shared: set[tuple[str, str]] = set()
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that no node needs it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="passageworks-code-"), "passageworks.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("passageworks", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(out)
    _shipped.add(app)
