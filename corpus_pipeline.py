"""A corpus pipeline: documents of a known language, without near copies or private values, mixed and packed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import languages, mixing, near_dups, packing, pii
from sightline.llm.tables import held_out, shared_folder, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose whole text some language's model codes in less than a uniform code; the trees learn from these documents."""
    trees = languages.fit(docs, ~held_out("doc_id", 5, 0))
    known = F.col("text").rlike(r"\p{L}")
    if trees.languages:
        known = known & (F.col("lang_bits") < languages.UNIFORM)
    return languages.identify(docs, trees).filter(known).select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    return near_dups.drop_near_duplicates(docs)


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private values replaced by pseudonyms; n_chars follows the text."""
    return pii.pseudonymise(docs).withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in the mix's order."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 ids."""
    rows = packing.pack(docs)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", identified), ("near_dedup", deduplicated), ("pii", pseudonymised), ("mixing", mixed), ("packing", packed)]
#: Hashing, drawing and tokenizing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
