"""Sinks: relation exports with counts, and report files with nested values as JSON text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.operators.shape import union_all


def export_relations(relations: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Write every relation as Parquet and return (relation, rows) read back from the files.

    The counts come from Parquet footers, not from a second run of the query.
    """
    counts = []
    for name, df in relations.items():
        path = f"{root}/{name}"
        df.write.mode("errorifexists").parquet(path)
        counts.append(df.sparkSession.read.schema(df.schema).parquet(path).agg(F.count("*").alias("rows")).withColumn("relation", F.lit(name)))
    return union_all(counts).select("relation", "rows")


def relation_counts(relations: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("rows")).withColumn("relation", F.lit(n)) for n, df in relations.items()]
    return union_all(parts).select("relation", "rows")


def report_rows(df: DataFrame) -> DataFrame:
    """Flat form for CSV: complex columns as JSON text, everything else unchanged."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return df.select(*[
        (F.to_json(F.col(f.name)) if isinstance(f.dataType, nested) else F.col(f.name)).alias(f.name)
        for f in df.schema.fields
    ])


def write_reports(df: DataFrame, root: str, name: str) -> None:
    flat = report_rows(df)
    flat.write.mode("overwrite").option("header", "true").csv(f"{root}/{name}_csv")
    df.write.mode("overwrite").json(f"{root}/{name}_json")
