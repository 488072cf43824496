"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Split a hot join key even when the join feeds an aggregation on that same key.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# A table this large is joined by a shuffle. Spark takes a written table for as large as its files; its rows in the driver, where a
# broadcast is put together, are 20 to 50 times as large, and a plan of many joins puts several together at once.
MOST_BROADCAST_BYTES = 1024 * 1024

_own: dict[str, str] = {}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options that the operators rely on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key, now in (("spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")),
                     ("spark.sql.adaptive.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"))):
        if not now.startswith("-") and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) > MOST_BROADCAST_BYTES:
            spark.conf.set(key, str(MOST_BROADCAST_BYTES))  # a smaller limit of the session stays
    return spark


def size_shuffle(spark: SparkSession, shuffled_bytes: int) -> int:
    """Set the shuffle width from the bytes to be shuffled; AQE merges what turns out small."""
    wanted = -(-shuffled_bytes // TARGET_PARTITION_BYTES)
    width = max(spark.sparkContext.defaultParallelism, int(wanted))
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    return width


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach: the one in spark.checkpoint.dir. Without that setting a local master gets a folder of
    its own, which goes when the process ends; a cluster is refused, as its machines would not see each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _own.get("folder")
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own["folder"] = folder  # kept here, as a running session cannot change the setting
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several later steps read, so its inputs are scanned once and
    lost executors never cause a different second evaluation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
