"""Session settings every operator relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Payloads with a repeated key keep the last value instead of being rejected.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Pushed into the scan, every path of a payload is read for every row, also those a condition would skip.
    "spark.sql.variant.pushVariantIntoScan": "false",
    # Stored payloads differ from row to row: taken apart into columns they are dearer to write and to read.
    "spark.sql.variant.inferShreddingSchema": "false",
    "spark.sql.variant.writeShredding.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole texts go to Python functions: what a worker holds at once is bounded by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable options to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_spark(app: str = "sightline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, or a new one in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set")
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written once as Parquet to the shared folder and read back.

    For results several branches of one plan use: the files cut the lineage, survive lost
    executors, and each branch reads only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sightline/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
