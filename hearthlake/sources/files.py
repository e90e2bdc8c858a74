"""JSON and Parquet folders."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hearthlake.operators.columns import PARQUET_SPECIAL, rename_columns


def object_path(bucket: str, key: str) -> str:
    """Path of an object-store folder as Spark reads it."""
    return f"s3a://{bucket}/{key.lstrip('/')}"


def read_json_folder(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines of a folder, plain or gzipped, names without Parquet-special characters.

    Without ``schema`` Spark infers it, which reads the folder once more.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return rename_columns(reader.json(path), lambda name: re.sub(PARQUET_SPECIAL, "", name))


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Files that each hold one JSON object or list, plain or gzipped; a list gives one row per item."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", True).json(path)


def write_json_gzip(df: DataFrame, path: str) -> None:
    df.write.json(path, compression="gzip")


def read_parquet_union(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All Parquet files at any depth under ``path``; a column a file lacks is NULL there.

    Without ``schema`` Spark merges the schemas of all file footers in a job of its own.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    return reader.parquet(path)
