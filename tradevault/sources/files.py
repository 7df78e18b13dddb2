"""Incremental CSV and XML ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def ingest_csv(spark: SparkSession, path: str, schema: str | StructType, streaming: bool = True) -> DataFrame:
    """Files with a header; new files are picked up once. Columns are matched by the header's order and the schema's
    names; a header that differs from the schema is refused."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def ingest_xml(spark: SparkSession, path: str, row_tag: str, schema: str | StructType, streaming: bool = False) -> DataFrame:
    """One row per ``row_tag`` element."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("xml").option("rowTag", row_tag).schema(schema).load(path)
