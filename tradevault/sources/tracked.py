"""CSV ingest that keeps track of the schema: new columns are taken in, values that do not fit are kept aside.

A stream of file names finds new files once. The files of a micro-batch are read by the header of each, so columns may come in any
order, be missing or be new. A declared column has its declared type, a new one is text. A value that its type does not take goes, as
it stands, into ``_rescued`` (a JSON object by column); a row with more or fewer cells than its header goes there whole, as
``_row``. Each batch that changes the columns adds a version to a schema log, keyed by the batch, so a replay writes the same; all
batches are read with the newest version, where older files have NULL in newer columns.
"""

from __future__ import annotations

import csv
import json
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradevault.sources.tables import exists

RESCUED, ROW = "_rescued", "_row"
FILES = "path string, modificationTime timestamp, length long, content binary"


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names in the first line of a file, on whatever file system; an empty file has none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    names = [n.strip() for n in next(csv.reader([(line or "").lstrip("﻿")]), [])]
    low = [n.lower() for n in names]
    if len(set(low)) < len(low) or set(low) & {RESCUED, ROW, ""}:
        raise ValueError(f"{path}: repeated, empty or reserved names in the header {names}")
    return tuple(names)


class SchemaLog:
    """Versions of a table's columns, one per batch that changed them."""

    def __init__(self, spark: SparkSession, path: str, declared: T.StructType):
        self.spark, self.path, self.declared = spark, path.rstrip("/"), declared

    def before(self, batch: int | None = None) -> T.StructType:
        """The columns known before a batch (or now)."""
        if not exists(self.spark, self.path):
            return self.declared
        rows = self.spark.read.schema("schema string, tv_batch int").parquet(self.path)
        last = (rows if batch is None else rows.filter(F.col("tv_batch") < batch)).agg(F.max_by("schema", "tv_batch")).first()[0]
        return self.declared if last is None else T.StructType.fromJson(json.loads(last))

    def add(self, batch: int, schema: T.StructType) -> None:
        self.spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/tv_batch={batch}")


def extended(schema: T.StructType, headers: list[tuple[str, ...]]) -> T.StructType:
    """The schema with the headers' unknown names (in any letter case) added as text, in order of appearance."""
    known = {f.name.lower() for f in schema.fields}
    out = T.StructType(list(schema.fields))
    for name in (n for h in headers for n in h):
        if name.lower() not in known:
            known.add(name.lower())
            out = out.add(name, T.StringType())
    return out


def fitted(spark: SparkSession, paths: list[str], header: tuple[str, ...], schema: T.StructType) -> DataFrame:
    """Files of one header in the table's columns, with what does not fit in ``_rescued``."""
    raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]).add(ROW, T.StringType())
    rows = spark.read.schema(raw).option("header", True).option("columnNameOfCorruptRecord", ROW).csv(paths)
    at = {n.lower(): F.col(f"c{i}") for i, n in enumerate(header)}
    columns, kept = [], [F.col(ROW)]
    for f in schema.fields:
        value: Column | None = at.get(f.name.lower())
        if value is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        fit = value if isinstance(f.dataType, T.StringType) else F.trim(value).try_cast(f.dataType)
        columns.append(fit.alias(f.name))
        kept.append(F.when(value.isNotNull() & fit.isNull(), value).alias(f.name))
    left = F.to_json(F.struct(*kept))
    return rows.select(*columns, F.when(left != "{}", left).alias(RESCUED))


def tracked_csv(spark: SparkSession, path: str, declared: T.StructType, out: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Take in the files that are there now; rows go to ``out``/data, the schema log to ``out``/schema."""
    log = SchemaLog(spark, f"{out}/schema", declared)

    def each(batch: DataFrame, no: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]  # at most files_per_batch names
        by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
        for p in sorted(paths):
            by_header[header_of(spark, p)].append(p)
        by_header.pop((), None)
        if not by_header:
            return
        before = log.before(no)
        schema = extended(before, list(by_header))
        if schema != before or not exists(spark, log.path):
            log.add(no, schema)
        frames = [fitted(spark, p, h, schema) for h, p in by_header.items()]
        reduce(DataFrame.unionByName, frames).write.mode("overwrite").parquet(f"{out}/data/tv_batch={no}")

    names = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", files_per_batch).load(path).select("path")
    names.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(each).start().awaitTermination()


def read_tracked(spark: SparkSession, out: str, declared: T.StructType) -> DataFrame:
    """All rows in the newest columns, and ``_rescued``."""
    schema = T.StructType(list(SchemaLog(spark, f"{out}/schema", declared).before().fields)).add(RESCUED, T.StringType())
    return spark.read.schema(schema).parquet(f"{out}/data").select(*schema.names)
