"""Tables of the given folder, and results written once to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; in local mode without one, a temporary folder is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written once as Parquet and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """The frame, after its session was told to hand rows to Python in small batches, so that long texts fit in a worker's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return df


def held_out(doc_id: str | Column, parts: int, part: int) -> Column:
    """True where crc32 of the id as text leaves the remainder `part`; rows without an id are never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """The frame's columns as one struct named row, beside further columns, so that no name can clash; `row.*` unpacks it."""
    own = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row")
    return df.select(own, *[value.alias(name) for name, value in more.items()])
