"""Bloom filters over many partitions as a table of bitmaps, built and asked with built-in functions.

A key sets ``PROBES`` bits among the ``bits`` of its partition. The filter of a partition is a few rows (partition, page, bitmap) of
32,768 bits each, so filters of any size are built by one aggregate, merged by another, and asked by one equi join per
probe; none is ever held by the driver or as one value. A key that is in the partition is always told; one that is not is told
with a probability of about (1 - e^(-PROBES * keys / bits)) ** PROBES.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 4
BITS = 1 << 20


def probes(keys: Sequence[str], bits: int) -> Column:
    """The places of a key's bits, from 1: two hashes, combined by steps."""
    a, b = F.pmod(F.xxhash64(*keys), F.lit(bits)), F.pmod(F.xxhash64(F.lit(7), *keys), F.lit(bits))
    return F.array(*[F.pmod(a + b * i, F.lit(bits)) + 1 for i in range(PROBES)])


def build(rows: DataFrame, partition: str, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """(partition, page, bitmap) of the rows' keys."""
    places = rows.select(partition, F.explode(probes(keys, bits)).alias("place"))
    return places.groupBy(partition, F.bitmap_bucket_number("place").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))


def merge(filters: DataFrame, partition: str) -> DataFrame:
    """One filter per partition from filters of parts of it, built with the same number of bits."""
    return filters.groupBy(partition, "page").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def may_hold(rows: DataFrame, filters: DataFrame, partition: str, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """The distinct keys of ``rows`` (with their partition) that a partition may hold: all of their bits are set."""
    asked = rows.select(partition, *keys).distinct().withColumn("__places", probes(keys, bits))
    flat = asked.select(partition, *keys, F.explode("__places").alias("__place")).withColumn("page", F.bitmap_bucket_number("__place"))
    at = F.bitmap_bit_position("__place")
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (at % 8).cast("int")) == 1
    names = list(dict.fromkeys([partition, *keys]))
    hits = flat.join(filters, [partition, "page"]).filter(is_set)
    return hits.groupBy(*names).agg(F.count("*").alias("__hits")).filter(F.col("__hits") == PROBES).select(*names)
