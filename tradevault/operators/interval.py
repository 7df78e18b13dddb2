"""Time-aware joins: effective-window lookup, current-row lookup and nearest-in-time join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevault.functions.hashing import as_col
from tradevault.functions.ordered import in_order
from tradevault.functions.scalars import open_end

_STEP = {"month": "1 month", "quarter": "3 months", "year": "1 year"}


def date_span(df: DataFrame, col: str) -> tuple[str, str] | None:
    """First and last date of a column: one aggregate over one column, two values returned."""
    lo, hi = df.agg(F.min(F.to_date(col)).cast("string"), F.max(F.to_date(col)).cast("string")).first()
    return None if lo is None else (lo, hi)


#: A dimension of at most so many versions, and so many of a key, is sent whole to every task.
FEW, FEW_OF_KEY = 100_000, 100


def few_versions(dim: DataFrame, key: str) -> bool:
    """Whether a dimension is small, by one job that reads no more than ``FEW`` of its rows; for a dimension that is stored."""
    rows = dim.select(key).limit(FEW + 1).groupBy(key).agg(F.count("*").alias("__n"))
    total, most = rows.agg(F.sum("__n"), F.max("__n")).first()
    return total is None or (total <= FEW and most <= FEW_OF_KEY)


def _in_buckets(versions: DataFrame, bucket: str) -> DataFrame:
    """One row per calendar bucket a window touches."""
    steps = (
        f"sequence(cast(date_trunc('{bucket}', __s) as date), cast(date_trunc('{bucket}', __e) as date),"
        f" interval {_STEP[bucket]})"
    )
    return versions.withColumn("__b", F.explode(F.expr(steps)))


def pit_lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    date_col: str,
    take: Mapping[str, str],
    *,
    start: str = "effective_start_date",
    end: str = "effective_end_date",
    bucket: str = "quarter",
    span: tuple[str, str] | None = None,
    few: bool = False,
) -> DataFrame:
    """Left join of each fact row to the dimension version whose closed window holds the fact's date.

    Windows of one key must not overlap; an inverted window covers nothing. A plain equi join with a range residual compares every fact row of a key with
    every version of it; here versions are spread over the calendar buckets they cover, so a fact row meets only the
    versions of its own bucket. The spread versions are a hash table in each partition of a shuffle, so neither side is sorted (and
    spilled). They are not broadcast: Spark takes their size from the file they are read from, which tells nothing of the buckets,
    and would send a spread dimension far above its limit through the driver. Skewed partitions of facts are split.

    ``span`` is the date range of the facts, known for an incremental batch (or see ``date_span``): versions outside it
    are dropped and one join does all. Without it (a stream) open versions are joined one to one on the key first. ``few``: the dimension
    was found small (see ``few_versions``); it is broadcast as it is, and facts are not shuffled for it.
    """
    names = list(take)
    payload = F.struct(*[F.col(c).alias(o) for o, c in take.items()])
    dim = dim.select(
        F.col(dim_key).alias("__k"), F.col(start).alias("__s"), F.col(end).alias("__e"), payload.alias("__p")
    ).filter(F.col("__s") <= F.col("__e"))
    day = F.col(date_col)
    in_window = (
        (F.col(key) == F.col("__k")) & (F.date_trunc(bucket, day).cast("date") == F.col("__b"))
        & day.between(F.col("__s"), F.col("__e"))
    )
    if few:
        whole = F.broadcast(dim)
        out = fact.join(whole, (F.col(key) == F.col("__k")) & day.between(F.col("__s"), F.col("__e")), "left")
        return out.select(*fact.columns, *[F.col("__p")[n].alias(n) for n in names])
    if span is not None:
        lo, hi = (F.lit(x).cast("date") for x in span)
        live = dim.filter((F.col("__s") <= hi) & (F.col("__e") >= lo)).withColumns(
            {"__s": F.greatest("__s", lo), "__e": F.least("__e", hi)}
        )
        out = fact.join(_in_buckets(live, bucket).hint("shuffle_hash"), in_window, "left")
        return out.select(*fact.columns, *[F.col("__p")[n].alias(n) for n in names])
    now = dim.filter(F.col("__e") >= open_end()).select(
        F.col("__k").alias("__nk"), F.col("__s").alias("__ns"), F.col("__p").alias("__np")
    )
    out = fact.join(now, (F.col(key) == F.col("__nk")) & (day >= F.col("__ns")), "left").join(
        _in_buckets(dim.filter(F.col("__e") < open_end()), bucket).hint("shuffle_hash"), in_window, "left"
    )
    hit = F.coalesce("__np", "__p")
    return out.select(*fact.columns, *[hit[n].alias(n) for n in names])


def current_lookup(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str, take: Mapping[str, str], how: str = "left"
) -> DataFrame:
    """Join to the current version only."""
    now = dim.filter("is_current").select(F.col(dim_key).alias("__k"), *[F.col(c).alias(o) for o, c in take.items()])
    return fact.join(now, F.col(key) == F.col("__k"), how).drop("__k")


def join_date(fact: DataFrame, dim_date: DataFrame, ts: str, take: Sequence[str] = ("date_sk",)) -> DataFrame:
    """Equi join of a truncated timestamp to the calendar, whose size is fixed by its date range."""
    days = dim_date.select(F.col("calendar_date").alias("__d"), *take)
    return fact.join(F.broadcast(days), F.to_date(ts) == F.col("__d"), "left").drop("__d")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    take: Mapping[str, Column | str],
    *,
    tie: Sequence[Column | str] = (),
    direction: str = "backward",
    target_rows: int | None = None,
) -> DataFrame:
    """Add to each left row the nearest right row at or before (``backward``) or at or after (``forward``) its time.

    Both sides are put on one time line and the last seen right row is carried along it: cost grows with the rows, never
    with pairs. ``tie`` orders right rows of equal time (the last wins). Long time lines are cut by size.
    """
    sign = 1 if direction == "backward" else -1

    def at(ts: str) -> Column:
        return (F.lit(sign) * F.unix_micros(F.col(ts).cast("timestamp"))).alias("__t")

    tie_key = F.struct(*[as_col(c) for c in tie]) if tie else F.lit(0)
    row = F.struct(*[F.col(c) for c in left.columns])
    hit = F.struct(*[as_col(c).alias(o) for o, c in take.items()])
    r = right.select(*keys, at(right_ts), F.lit(0).alias("__kind"), tie_key.alias("__tie"), hit.alias("__hit"))
    lrows = left.select(*keys, at(left_ts), F.lit(1).alias("__kind"), row.alias("__row"))
    both = lrows.unionByName(r, allowMissingColumns=True)
    filled = in_order(
        both, list(keys), ["__t", "__kind", "__tie"], target_rows=target_rows, fill={"__found": "__hit"}
    ).filter("__kind = 1")
    return filled.select("__row.*", *[F.col("__found")[o].alias(o) for o in take])
