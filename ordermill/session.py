"""Spark session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import math
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# UTC makes order dates independent of where the driver runs; ANSI turns overflow into an error.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# How tables are written; about a third less than with Spark's default.
COMPRESSION = "zstd"

SHUFFLE_PARTITION_BYTES = 128 * 1024**2


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Partitions so that one shuffled share of `input_bytes` stays near 128 MB.

    AQE merges what turns out too small, so this may err on the high side.
    """
    return max(cores, math.ceil(input_bytes / SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "ordermill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the plans expect; `extra` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = dict(SETTINGS)
    if shuffle_partitions:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    options.update(extra or {})
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: `spark.checkpoint.dir`, or where that is unset one in the warehouse.

    Where neither is set, the warehouse is a folder of this machine. That will do for a local session only; on a cluster it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    on_one_machine = spark.sparkContext.master.split("[")[0] == "local"
    if not on_one_machine and warehouse.startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return f"{warehouse}/_shared"


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of all files under the paths, from their listing; nothing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder; it goes when the application ends."""
    path = f"{shared_dir(spark)}/ordermill-{name}-{uuid.uuid4().hex}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def observed(observation: Observation, df: DataFrame | None = None) -> dict:
    """What was observed, or nothing where Spark found the plan to be empty and left the observation out with it.

    With `df`, the frame that was written, that is made sure of.
    """
    try:
        return dict(observation.get)
    except Py4JJavaError:
        if df is not None and not df.isEmpty():
            raise
        return {}


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Used where several branches of one query need the same expensive rows: the branches then
    read only their own columns, and a lost executor re-reads files instead of the whole lineage.
    The folder is removed when the application ends. `options` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)
