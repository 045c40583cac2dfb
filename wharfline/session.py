"""Session settings and the shared scratch area used to cut lineage.

Several operators need a physical cut in the plan: a numbering of rows, for
example, is only meaningful if every later read sees the same partitions.  The
cut is a parquet table below ``spark.checkpoint.dir``, which on a cluster is a
folder that every node sees, so a lost executor loses no cut data.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUN = uuid.uuid4().hex
_local_root: str | None = None


def local_session(
    app: str = "wharfline", cores: str | int = "*", partitions: int = 8, scratch: str | None = None
) -> SparkSession:
    """A small single-machine session for tests and the bench; ``scratch``: the folder of the cut tables."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    if scratch:
        spark.sparkContext.setCheckpointDir(scratch)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for cut tables: the one the session names, or a test folder in local mode."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="wharfline-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/wharfline-{_RUN}/{label}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch area and continue from the written table.

    Unlike an RDD checkpoint the table stays columnar: readers prune columns and
    skip row groups by their min/max values.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the cut tables of this Python process; call once their readers are done."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/wharfline-{_RUN}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)
