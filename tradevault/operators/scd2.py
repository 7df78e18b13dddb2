"""Type-2 history: day-grain version building, incremental refresh, satellite end-dating, latest-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradevault.functions.hashing import as_col, row_hash, surrogate_key
from tradevault.functions.ordered import in_order
from tradevault.functions.scalars import open_end


def latest_by(df: DataFrame, keys: Sequence[str], seq: Sequence[Column | str]) -> DataFrame:
    """The row with the greatest sequence per key: an aggregate that is combined before the shuffle, so a hot key comes down to one row a
    task. Its values are structs, for which Spark aggregates over rows sorted by key."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*rest), F.struct(*[as_col(s) for s in seq]))
    return df.groupBy(*keys).agg(picked.alias("__r")).select(*keys, "__r.*").select(*df.columns)


def day_changes(
    changes: DataFrame, keys: Sequence[str], date_col: str, seq: Sequence[Column | str], keep: Sequence[str]
) -> DataFrame:
    """Last change per (key, day). Afterwards a key holds at most one row per calendar day, so windows over a key are
    bounded by the calendar however hot the key is."""
    picked = F.max_by(F.struct(*keep), F.struct(*[as_col(s) for s in seq]))
    return changes.groupBy(*keys, date_col).agg(picked.alias("__r")).select(*keys, date_col, "__r.*")


def scd2_build(
    changes: DataFrame,
    keys: Sequence[str],
    date_col: str,
    seq: Sequence[Column | str],
    tracked: Sequence[str],
    *,
    carried: Sequence[str] = (),
    op_col: str | None = None,
    sk: str | None = None,
) -> DataFrame:
    """Closed-date versions from a change feed in any order.

    The last change of a day counts, repeats with an equal row hash collapse, a version ends the day before its
    successor starts, and a DELETE closes the version with nothing after it. ``carried`` columns ride along untracked.
    """
    keep = [*tracked, *carried] + ([op_col] if op_col else [])
    daily = day_changes(changes, keys, date_col, seq, keep).withColumn("row_hash", row_hash(tracked))
    alive = F.col(op_col) != "DELETE" if op_col else F.lit(True)
    state = F.when(F.coalesce(alive, F.lit(True)), F.col("row_hash"))
    line = Window.partitionBy(*keys).orderBy(date_col)
    turns = (
        daily.withColumn("__state", state)
        .withColumn("__before", F.lag("__state").over(line))
        .filter(~F.col("__state").eqNullSafe(F.col("__before")))
    )
    nxt = F.lead(date_col).over(line)
    out = (
        turns.withColumn("__next", nxt)
        .filter("__state is not null")
        .select(
            *keys, *tracked, *carried,
            F.col(date_col).alias("effective_start_date"),
            F.coalesce(F.date_sub("__next", 1), open_end()).alias("effective_end_date"),
            F.col("__next").isNull().alias("is_current"),
            "row_hash",
        )
    )
    if sk:
        out = out.withColumn(sk, surrogate_key([*keys, "effective_start_date"]))
    return out


def as_changes(dim: DataFrame, keys: Sequence[str], tracked: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """Versions back to a change feed, with a DELETE the day after a version that has no direct successor."""
    line = Window.partitionBy(*keys).orderBy("effective_start_date")
    nxt = F.lead("effective_start_date").over(line)
    gap = (F.col("effective_end_date") < open_end()) & ~F.date_add("effective_end_date", 1).eqNullSafe(nxt)
    marked = dim.withColumn("__gap", gap)
    opened = marked.select(
        *keys, *tracked, *carried, F.col("effective_start_date").alias("change_date"), F.lit("UPSERT").alias("op")
    )
    closed = marked.filter("__gap").select(
        *keys, *tracked, *carried, F.date_add("effective_end_date", 1).alias("change_date"), F.lit("DELETE").alias("op")
    )
    return opened.unionByName(closed)


def scd2_upsert(
    dim: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    *,
    carried: Sequence[str] = (),
    history: DataFrame | None = None,
    sk: str | None = None,
) -> DataFrame:
    """New state of a type-2 table after a batch: changed versions are closed and their successors opened in one pass.

    ``batch`` holds keys, tracked and carried columns, ``change_date``, ``op`` and ``seq``. Only keys in the batch are
    rebuilt; all others pass through. Equal hashes change nothing, so applying a batch twice gives the same table.
    With ``history`` (retained day-grain changes, same columns) a late change may split a published version exactly as
    a full rebuild would; without it the published versions stand in for the history.
    """
    touched = batch.select(*keys).distinct()
    if history is None:
        past = as_changes(dim.join(touched, list(keys), "left_semi"), keys, tracked, carried)
        past = past.withColumn("seq", F.lit(None).cast(batch.schema["seq"].dataType))
    else:
        past = history.join(touched, list(keys), "left_semi")
    cols = [*keys, *tracked, *carried, "change_date", "op", "seq"]
    feed = past.select(*cols, F.lit(0).alias("__late")).unionByName(batch.select(*cols, F.lit(1).alias("__late")))
    order = ["__late", "seq"] if history is None else ["seq"]
    rebuilt = scd2_build(feed, keys, "change_date", order, tracked, carried=carried, op_col="op", sk=sk)
    kept = dim.join(touched, list(keys), "left_anti")
    return kept.select(*rebuilt.columns).unionByName(rebuilt)


def end_date_sat(sat: DataFrame, keys: Sequence[str], load: str = "load_date", chunk: Column | None = None) -> DataFrame:
    """Half-open end of each satellite row: the next row's load time, NULL for the open row."""
    return in_order(sat, keys, [load], chunk, lead={"load_end_date": load})


def collapse_repeats(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str, chunk: Column | None = None, even: bool = False,
) -> DataFrame:
    """Rows whose value differs from the previous row of the key (the first row always stays). ``even``: no key is large (see ``in_order``)."""
    seen = in_order(df, keys, order, chunk, even=even, lag={"__before": value, "__has": F.lit(True)})
    changed = F.col("__has").isNull() | ~F.col(value).eqNullSafe(F.col("__before"))
    return seen.filter(changed).drop("__before", "__has")
