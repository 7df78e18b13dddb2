"""Small helpers that every operator of this folder uses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def named(df: DataFrame, name: str) -> Column:
    """A column by its exact name, also if that holds dots."""
    return df[f"`{name}`"]


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows that training leaves aside: crc32 of the id as text, modulo 4, is 2. A NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let an Arrow batch hold at most four megabytes, unless the session asks for less.

    By default a batch holds 64 MB; Spark keeps and reuses its Python workers, which then keep several times that.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name)
    if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def added(df: DataFrame, name: str, fn: Callable, kind: str, *inputs: str) -> DataFrame:
    """``df`` with one more column made by an Arrow function; a column of that name is replaced.

    The function is marked non-deterministic so that Catalyst evaluates it once per row, not once per reference.
    """
    bounded_batches(df.sparkSession)
    return df.withColumn(name, F.arrow_udf(fn, kind).asNondeterministic()(*[F.col(f"`{c}`") for c in inputs]))


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the cluster's shared folder and read it back."""
    from tradevault.session import work_dir

    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, in any letter case."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
