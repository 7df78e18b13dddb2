"""Ordered per-key calculations that do not put a large key into one task.

A plain ``Window.partitionBy(key)`` sorts every row of a key in one task, so one hot key can stall a job. Here a key with more
than ``target_rows`` rows is cut into chunks of about that many rows. Cut points are quantiles of the full order (so rows that
share a time stamp are cut by the tie-break, and outliers do not matter), taken from a hash sample of the large keys' rows. The
window runs per (key, chunk), and one edge row per (key, chunk) carries the last/first values, counts and sums across chunks.

One lazy plan of ``with_ordered`` serves every size: no job runs while it is built, and column types are the same with and without large keys.
Where no key is large, the tables of cuts and edges are empty and adaptive execution drops their joins. Key sizes are counted
with map-side combining over the key columns alone; ``sizes`` names a narrower table with the same keys to count instead, and
``large`` takes cuts that were computed before. Rows with a NULL key form one group, as in SQL, which is cut like any other.
As that plan computes its rows again for cuts and edges, ``in_order`` counts first and takes a plain window where no key is large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradevault.functions.hashing import as_col

_C, _K, _O = "__chunk", "__key", "__order"
TARGET_ROWS = 2_000_000
#: Hashes of keys that are counted before the keys themselves.
BINS = 1 << 16
#: Sampled rows per chunk: a chunk deviates from the target by a few parts in a hundred.
SAMPLES_PER_CHUNK = 1000


def packed(cols: Sequence[Column | str]) -> Column:
    """Columns as one struct. A struct of NULLs is not NULL, so NULL keys group and join like others."""
    return F.struct(*[as_col(c).alias(f"c{i}") for i, c in enumerate(cols)])


def large_keys(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], target_rows: int = TARGET_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """(key, cuts): the keys with more than ``target_rows`` rows and the sorted cut points of their order.

    At most (rows / target_rows) keys come out, with (rows of the key / target_rows) cuts each. The sample is drawn by a
    hash of the order columns, so a recomputed task sees the same cuts.
    """
    n = (df if sizes is None else sizes).groupBy(packed(keys).alias(_K)).agg(F.count("*").alias("__n")).filter(F.col("__n") > target_rows)
    rows = df.select(packed(keys).alias(_K), packed(order).alias(_O)).join(F.broadcast(n), _K)
    rate = F.least(F.lit(1.0), F.lit(float(SAMPLES_PER_CHUNK)) / target_rows)
    drawn = rows.filter(F.pmod(F.xxhash64(_O), F.lit(1 << 30)) < rate * (1 << 30))
    line = drawn.groupBy(_K).agg(F.sort_array(F.collect_list(_O)).alias("__line"), F.max("__n").alias("__n"))
    chunks = F.ceil(F.col("__n") / target_rows).cast("int")
    at = F.transform(F.sequence(F.lit(1), chunks - 1), lambda i: F.floor(F.size("__line") * i / chunks).cast("int") + 1)
    return line.select(_K, F.array_distinct(F.transform(at, lambda i: F.get(F.col("__line"), i - 1))).alias("__cuts"))


def some_large(df: DataFrame, keys: Sequence[str], target_rows: int | None = None) -> bool:
    """Whether a key may have more than ``target_rows`` rows, by one job that counts rows per hash of the key with map-side
    combining: a few bytes per hash are shuffled, however many keys there are. Keys of one hash count together, so it may say
    yes too often, never no."""
    bins = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(BINS)).alias("__bin")).agg(F.count("*").alias("__n"))
    return not bins.filter(F.col("__n") > (target_rows or TARGET_ROWS)).isEmpty()


def even_chunk(df: DataFrame, keys: Sequence[str], digest: Column | str, target_rows: int | None = None) -> Column | None:
    """A ``chunk`` for rows in the order of a digest of bytes, which spreads any key evenly: parts of the digest's range, as many as the
    largest key has ``target_rows``. The sizes of keys are counted now; None where no key is large. NULL comes first."""
    target = target_rows or TARGET_ROWS
    most = df.groupBy(*keys).agg(F.count("*").alias("__n")).agg(F.max("__n")).first()[0] or 0
    parts = min(-(-most // target), 1 << 24)
    at = F.conv(F.hex(F.substring(as_col(digest), 1, 4)), 16, 10).cast("long")
    return F.coalesce(F.floor(at * parts / (1 << 32)).cast("int"), F.lit(0)) if parts > 1 else None


def in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    chunk: Column | None = None,
    *,
    target_rows: int | None = None,
    sizes: DataFrame | None = None,
    even: bool = False,
    lag: Mapping[str, Column | str] | None = None,
    lead: Mapping[str, Column | str] | None = None,
    number: str | None = None,
    running: Mapping[str, Column | str] | None = None,
    fill: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """``with_ordered`` that counts key sizes now, in one job over the keys (of ``sizes``). Where no key is large, one plain window adds
    the columns: the rows are computed and shuffled once, not again for cuts and edges, and not at all where they
    lie by the keys already. A stream, a given ``chunk`` and large keys go to ``with_ordered``. ``even``: it was counted before that no key is large."""
    given = dict(target_rows=target_rows, sizes=sizes, lag=lag, lead=lead, number=number, running=running, fill=fill)
    if chunk is not None or df.isStreaming or not (even or not some_large(df if sizes is None else sizes, keys, target_rows)):
        return with_ordered(df, keys, order, chunk, **given)
    line = Window.partitionBy(*keys).orderBy(*order)
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.lag(as_col(c)).over(line).alias(o) for o, c in dict(lag or {}).items()]
    cols += [F.lead(as_col(c)).over(line).alias(o) for o, c in dict(lead or {}).items()]
    cols += [F.row_number().over(line).cast("long").alias(number)] if number else []
    cols += [F.sum(as_col(c)).over(upto).alias(o) for o, c in dict(running or {}).items()]
    cols += [F.last(as_col(c), ignorenulls=True).over(upto).alias(o) for o, c in dict(fill or {}).items()]
    return df.select("*", *cols)


def with_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    chunk: Column | None = None,
    *,
    target_rows: int | None = None,
    sizes: DataFrame | None = None,
    large: DataFrame | None = None,
    lag: Mapping[str, Column | str] | None = None,
    lead: Mapping[str, Column | str] | None = None,
    number: str | None = None,
    running: Mapping[str, Column | str] | None = None,
    fill: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Add ordered columns to ``df``.

    ``order`` is ascending and must be unique within a key. A given ``chunk`` (which must not decrease along the order) replaces
    the cuts: every key is cut by it.
    ``lag``/``lead`` give the previous/next value, ``number`` a 1-based ordinal, ``running`` a sum up to and including
    the row, ``fill`` the last non-null value up to and including the row.
    """
    lag, lead, running, fill = dict(lag or {}), dict(lead or {}), dict(running or {}), dict(fill or {})
    inner = Window.partitionBy(_K, _C).orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    cols = [F.row_number().over(inner).alias("__rn"), F.lead(F.lit(True)).over(inner).isNull().alias("__tail")]
    # values are wrapped in a struct so that "no neighbour" and "neighbour holds NULL" stay apart
    if lag:
        this = F.struct(*[as_col(c).alias(o) for o, c in lag.items()])
        cols += [this.alias("__self"), F.lag(this).over(inner).alias("__lag")]
    if lead:
        this = F.struct(*[as_col(c).alias(o) for o, c in lead.items()])
        cols += [F.lead(this).over(inner).alias("__lead"), F.first(this).over(upto).alias("__head")]
    for o, c in running.items():
        cols.append(F.sum(as_col(c)).over(upto).alias(f"__sum_{o}"))
    for o, c in fill.items():
        cols.append(F.last(as_col(c), ignorenulls=True).over(upto).alias(f"__fill_{o}"))

    keyed = df.withColumn(_K, packed(keys))
    if chunk is None:
        cuts = large_keys(df, keys, order, target_rows or TARGET_ROWS, sizes) if large is None else large
        here = packed(order)
        passed = F.size(F.filter("__cuts", lambda c: c <= here))
        # keys of normal size have no cuts, chunk 0 and no edges
        chunked = keyed.join(F.broadcast(cuts), _K, "left").withColumn(_C, F.coalesce(F.when(F.col("__cuts").isNotNull(), passed), F.lit(0)))
        chunked = chunked.withColumn("__cut", F.col("__cuts").isNotNull()).drop("__cuts")
    else:
        chunked = keyed.withColumn(_C, chunk).withColumn("__cut", F.lit(True))
    main = chunked.select("*", *cols)

    across = Window.partitionBy(_K).orderBy(_C)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = []
    if lag:
        carried.append(F.lag("__self").over(across).alias("__c_lag"))
    if lead:
        carried.append(F.lead("__head").over(across).alias("__c_lead"))
    if number:
        carried.append(F.sum("__rn").over(before).alias("__c_rn"))
    for o in running:
        carried.append(F.sum(f"__sum_{o}").over(before).alias(f"__c_sum_{o}"))
    for o in fill:
        carried.append(F.last(f"__fill_{o}", ignorenulls=True).over(before).alias(f"__c_fill_{o}"))
    if number and not (lag or lead or running or fill):
        # an ordinal needs the sizes of chunks alone, which are counted map-side: rows are not shuffled and sorted a second time
        edges = chunked.filter("__cut").groupBy(_K, _C).agg(F.count("*").alias("__rn")).select(_K, _C, *carried)
    else:
        edges = main.filter("__tail and __cut").select(_K, _C, *carried)
    joined = main.join(edges, [_K, _C], "left")

    out = [F.col(c) for c in df.columns]
    if lag:
        found = F.coalesce("__lag", "__c_lag")
        out += [found[o].alias(o) for o in lag]
    if lead:
        found = F.coalesce("__lead", "__c_lead")
        out += [found[o].alias(o) for o in lead]
    if number:
        out.append((F.col("__rn") + F.coalesce("__c_rn", F.lit(0))).cast("long").alias(number))
    for o in running:
        total = F.when(F.col(f"__c_sum_{o}").isNull(), F.col(f"__sum_{o}")).otherwise(
            F.col(f"__c_sum_{o}") + F.coalesce(F.col(f"__sum_{o}"), F.lit(0))
        )
        out.append(total.cast(main.schema[f"__sum_{o}"].dataType).alias(o))
    for o in fill:
        out.append(F.coalesce(f"__fill_{o}", f"__c_fill_{o}").alias(o))
    return joined.select(*out)


def share_of(df: DataFrame, keys: Sequence[str], value: str, out: str, sizes: DataFrame | None = None) -> DataFrame:
    """Each row's share of its key's total; rows with a NULL key share one total. The total is aggregated map-side first and
    joined back, so a hot key is never gathered; AQE splits the hot join partition. ``sizes`` names a narrower table with the same keys:
    it is counted now, and where no key is large, rows are computed and shuffled once, for a plain window."""
    if sizes is not None and not df.isStreaming and not some_large(sizes, keys):
        whole = F.sum(value).over(Window.partitionBy(*keys))
        found = df.withColumn("__total", whole)
        share = F.when(F.col("__total") != 0, F.col(value).cast("double") / F.col("__total").cast("double"))
        return found.withColumn(out, share).drop("__total")
    keyed = df.select(packed(keys).alias(_K), *[c for c in df.columns if c not in keys or c == value])  # the key is shuffled once, in its packed form
    total = keyed.groupBy(_K).agg(F.sum(value).alias("__total"))
    part = F.col(value).cast("double") / F.col("__total").cast("double")
    found = keyed.join(total, _K, "left").withColumn(out, F.when(F.col("__total") != 0, part))
    key = {k: F.col(_K)[f"c{i}"].alias(k) for i, k in enumerate(keys)}
    return found.select(*[key.get(c, F.col(c)) for c in df.columns], *([out] if out not in df.columns else []))
