"""Session defaults and the shared folder for tables written between two steps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Sizes (shuffle partitions, executor memory, split size) belong to spark-submit;
# these switches hold at any scale.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@cache
def _local_dir(application_id: str) -> str:
    folder = tempfile.mkdtemp(prefix="footfall-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is written there yet."""
    return f"{shared_dir(spark).rstrip('/')}/footfall/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the stored copy.

    Cuts lineage in a way that survives lost executors and fixes any column whose
    value depends on how rows were laid out.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete the copy that ``materialize`` wrote, once nothing reads it any more."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
