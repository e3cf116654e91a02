"""Helpers the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_dir

# Column names the operators add while they work; no input column may use the prefix.
PREFIX = "__tm_"


def plain_columns(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under names of our own, whatever else the table holds."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a read, not the work before it. The folder
    goes when the application ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    schema = df.schema
    df.write.parquet(path)
    jvm, context = spark._jvm, spark.sparkContext
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(schema).parquet(path)


def row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes over all columns; equal rows are equal in both.

    Columns of maps and variants cannot be compared in Spark and stay out.
    """
    parts: list[Column] = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.MapType, T.VariantType)):
            continue
        if isinstance(field.dataType, (T.ArrayType, T.StructType)):
            column = F.to_json(F.struct(column))
        parts += [column.isNull(), column]
    return [F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)]
