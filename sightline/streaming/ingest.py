"""Structured Streaming forms of ingestion: raw files, duplicate removal, latest slices.

Targets are plain Parquet folders with one sub-folder per micro-batch (and per bucket of keys where rows are looked up), so a batch
that is run again after a failure overwrites its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sightline.operators.shape import insert_or_ignore, latest_per

RAW_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def raw_stream(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    """New JSON files below the raw root as a stream."""
    return (
        spark.readStream.format("binaryFile").schema(RAW_SCHEMA)
        .option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger).load(root)
    )


class Buckets:
    """Rows kept by hash of their key, in versions: a batch replaces the buckets it touches by new versions and reads no other ones.

    Layout: ``root/bucket=<n>/batch=<id>``. The content of a bucket is its version of the highest batch. A batch that runs again reads
    the versions before it and writes its own once more. Versions older than the one just read are removed.
    """

    def __init__(self, root: str, keys: Sequence[str], count: int):
        self.root, self.keys, self.count = root, list(keys), count

    def number(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.count)).cast("int")

    def _versions(self, spark: SparkSession, bucket: int) -> list[int]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/bucket={bucket}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def _remove(self, spark: SparkSession, bucket: int, batch: int) -> None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/bucket={bucket}/batch={batch}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    def read(self, spark: SparkSession, schema: T.StructType, buckets: Sequence[int] | None = None, before: int = 2**62) -> DataFrame:
        """Current rows of the given (or all) buckets as of the batches before one."""
        paths = []
        for bucket in range(self.count) if buckets is None else buckets:
            versions = [v for v in self._versions(spark, bucket) if v < before]
            paths += [f"{self.root}/bucket={bucket}/batch={versions[-1]}"] if versions else []
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def replace(self, rows: DataFrame, touched: Sequence[int], batch: int) -> None:
        """Write new versions of the touched buckets, each by one task."""
        spark = rows.sparkSession
        placed = rows.withColumn("bucket", self.number()).withColumn("batch", F.lit(batch))
        writer = placed.repartition(max(1, len(touched)), "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket", "batch").parquet(self.root)
        for bucket in touched:
            older = [v for v in self._versions(spark, bucket) if v < batch]
            for version in older[:-1]:
                self._remove(spark, bucket, version)

    def touched(self, batch: DataFrame) -> list[int]:
        """Numbers of the batch's buckets, at most `count`."""
        return sorted(r[0] for r in batch.select(self.number()).distinct().collect())


def insert_or_ignore_sink(target: str, keys: Sequence[str], order: Sequence[Column], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: first row per key wins, keys of earlier batches are skipped.

    Fresh rows go to ``target/batch=<id>``; the keys seen so far are kept in buckets beside it, of which a batch reads and writes those
    of its own keys only, one version each, however many batches there were.
    """
    seen = Buckets(f"{target}-keys", keys, buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = seen.touched(batch)
            known = seen.read(batch.sparkSession, batch.select(*keys).schema, touched, batch_id)
            insert_or_ignore(known, batch, keys, order).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
            seen.replace(known.unionByName(batch.select(*keys)).distinct(), touched, batch_id)
        finally:
            batch.unpersist()
    return write


def latest_slice_sink(target: str, keys: Sequence[str], time: str, tie: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink that keeps the latest row of every slice; a late older row does not replace a newer one.

    The current rows of the touched buckets are merged with the batch, so reading them needs no look at earlier batches.
    """
    state = Buckets(target, keys, buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = state.touched(batch)
            current = state.read(batch.sparkSession, batch.schema, touched, batch_id)
            state.replace(latest_per(current.unionByName(batch), keys, time, tie), touched, batch_id)
        finally:
            batch.unpersist()
    return write


def current_slices(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The upkept latest rows: one version of every bucket, no window over the history."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    numbers = sorted(int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket="))
    return Buckets(target, [], 0).read(spark, schema, numbers)


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """First arrival per key; state is dropped once the watermark has passed."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def start_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """Process everything available, then stop."""
    return (
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


