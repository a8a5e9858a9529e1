"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Runtime SQL settings every plan here relies on. All can be set on a live session.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rows of few partitions are written without sorting them by partition first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}

def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and bench.py; sets a shared folder where none is set."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("marketlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**SQL_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="marketlake-"))
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables, below the cluster's `spark.checkpoint.dir`."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, lineage cut.

    For a result that several branches of one plan read. Survives lost executors, and
    each reader scans only the columns it needs.
    """
    path = shared_dir(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever file system the path names."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there)


def table_or_empty(
    spark: SparkSession, schema: T.StructType, path: str, **options: str
) -> DataFrame:
    """A Parquet table, without rows as long as nothing was written there."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.options(**options).schema(schema).parquet(path)
