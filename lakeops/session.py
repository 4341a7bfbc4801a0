"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "lakeops", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators are tested under; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: list[str] = []


def allow_local_scratch() -> None:
    """Let sessions with a ``local`` or ``local[...]`` master, whose tasks all share one machine, do
    without ``spark.checkpoint.dir``. For entry scripts; never called by the library."""
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="lakeops-"))


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if _local_root and (master == "local" or master.startswith("local[")):
        return _local_root[0]
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder."""
    return f"{shared_root(spark)}/lakeops/{label}-{uuid.uuid4().hex}"


def write_bytes(spark: SparkSession, label: str, content: bytes) -> str:
    """A new file of a few MB in the shared folder, written through its own file system; its path."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, label))
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    return path.toString()


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    For results that several later passes need: it cuts the lineage, survives the loss of
    executors, and the parquet files keep their statistics for the planner.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
