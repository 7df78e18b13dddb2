"""Vault loading: hubs, links, satellites, point-in-time tables and the as-of read through them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevault.functions.hashing import as_col, hash_key, link_key, narrow, narrowed, row_hash, text_columns, widened
from tradevault.functions.ordered import in_order, some_large
from tradevault.operators.scd2 import collapse_repeats


def _unseen(new: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    return new if existing is None else new.join(existing.select(*keys), list(keys), "left_anti")


def load_hub(
    stage: DataFrame, entity: str, bk: Sequence[str], source: Column | str, load: str = "load_date",
    existing: DataFrame | None = None,
) -> DataFrame:
    """New hub rows: one per unseen hash key, with the first load time and that row's key text. The hash key is shuffled as bytes, a source
    that is the same for all rows not at all."""
    src = F.lit(source) if isinstance(source, str) else source
    hk, key = f"{entity}_hk", f"{entity}_bk"
    text = F.concat_ws("||", *[as_col(c).cast("string") for c in bk])
    rows = stage.select(narrow(hash_key(bk, src)).alias(hk), text.alias(key), F.col(load).alias("load_date"), src.alias("record_source"))
    fixed = isinstance(source, str)
    first = F.min(F.struct("load_date", key, *([] if fixed else ["record_source"])))
    out = rows.groupBy(hk).agg(first.alias("f")).select(
        widened(hk).alias(hk), f"f.{key}", "f.load_date", (src if fixed else F.col("f.record_source")).alias("record_source"))
    return _unseen(out, existing, [hk])


def load_link(
    stage: DataFrame, link: str, members: Mapping[str, Column | str], source: str, load: str = "load_date",
    existing: DataFrame | None = None,
) -> DataFrame:
    """New link rows. ``members`` maps hash-key column names to expressions; two may point at the same hub. Members are shuffled as bytes."""
    hk = f"{link}_hk"
    rows = stage.select(*[as_col(c).alias(n) for n, c in members.items()], F.col(load).alias("load_date"))
    text = [c for c in text_columns(rows) if c in members]
    out = (
        narrowed(rows, text).groupBy(*members)
        .agg(F.min("load_date").alias("load_date"))
        .withColumns({c: widened(c) for c in text})
        .select(link_key(list(members)).alias(hk), *members, "load_date", F.lit(source).alias("record_source"))
    )
    return _unseen(out, existing, [hk])


def load_sat(
    stage: DataFrame, hk: str, attrs: Sequence[str], load: str = "load_date", *,
    sub_keys: Sequence[str] = (), tie: Sequence[str] = (), existing: DataFrame | None = None, chunk: Column | None = None,
    source: Column | str | None = None, sizes: DataFrame | None = None,
) -> DataFrame:
    """Change-only satellite rows: a row is new when its attribute hash differs from the row before it.

    There is one row per key and load time: of rows with equal load time the last by ``tie`` (then by hash) counts, and a stored
    one stays. Existing rows take part in the ordering, so a late row is placed correctly; only rows not yet stored are
    returned. ``sub_keys`` makes the satellite multi-active; ``source`` fills record_source.

    Where no key is large (counted now, from ``sizes`` if a narrower table has the same keys) and nothing is stored yet, one shuffle by
    the narrowed key does all: the row per load time, its hash and the comparison with the row before.
    """
    keys = [hk, *sub_keys]
    extra = [] if source is None else [(F.lit(source) if isinstance(source, str) else source).alias("record_source")]
    text = [k for k in keys if stage.schema[k].dataType.simpleString() == "string"]
    even = existing is None and chunk is None and not stage.isStreaming and not some_large(stage if sizes is None else sizes, keys)
    if even:
        used = dict.fromkeys([*keys, load, *tie, *attrs, *[c for c in stage.columns if extra and not isinstance(source, str)]])
        stage = narrowed(stage.select(*used), text).repartition(*keys)
    rows = stage.select(*keys, F.col(load).alias("load_date"), *tie, row_hash(attrs).alias("hash_diff"), *attrs, *extra)
    rows = rows.withColumn("__stored", F.lit(False))
    if existing is not None:
        kept = [c for c in ("record_source",) if extra and c in existing.columns]
        old = existing.select(*keys, "load_date", "hash_diff", *attrs, *kept).withColumn("__stored", F.lit(True))
        rows = rows.unionByName(old, allowMissingColumns=True)
    rest = [c for c in rows.columns if c not in (*keys, "load_date")]
    last = F.max_by(F.struct(*rest), F.struct("__stored", *tie, "hash_diff"))
    rows = rows.groupBy(*keys, "load_date").agg(last.alias("__r")).select(*keys, "load_date", "__r.*")
    out = collapse_repeats(rows, keys, ["load_date"], "hash_diff", chunk, even)
    out = out.filter(~F.col("__stored")).drop("__stored")
    return out.withColumns({k: widened(k) for k in text}) if even else out


def append_sat(stage: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Append-only satellite rows: whatever is not stored yet, compared on key and hash; nothing is ever closed."""
    new = stage.dropDuplicates([*keys, "hash_diff"])
    return _unseen(new, existing, [*keys, "hash_diff"])


def build_pit(
    hub: DataFrame, hk: str, sats: Mapping[str, DataFrame], snapshots: Column, *, loads: str = "load_date"
) -> DataFrame:
    """For each hub row and snapshot date, each satellite's latest load time up to the end of that date.

    ``snapshots`` is an array of dates; a hub row is expanded by it. Snapshot rows and satellite days then share one time
    line and the last load is carried along it, so there is no correlated subquery, cross join or range join. Satellites
    are first reduced to the last load per key and day.
    """
    grid = hub.select(hk, F.explode(snapshots).alias("snapshot_date"))
    line = grid.withColumn("__snap", F.lit(1))
    for name, sat in sats.items():
        days = sat.groupBy(hk, F.to_date(loads).alias("snapshot_date")).agg(F.max(loads).alias(f"__{name}"))
        line = line.unionByName(days.withColumn("__snap", F.lit(0)), allowMissingColumns=True)
    filled = in_order(
        line, [hk], ["snapshot_date", "__snap"],
        fill={f"{name}_load_date": f"__{name}" for name in sats},
    )
    return filled.filter("__snap = 1").select(hk, "snapshot_date", *[f"{name}_load_date" for name in sats])


def retain(pit: DataFrame, as_of: Column | str, days: int = 7) -> DataFrame:
    """Snapshots no older than ``days`` before the given date."""
    return pit.filter(F.col("snapshot_date") > F.date_sub(F.to_date(as_col(as_of)), days))


def as_of(
    hub: DataFrame, hk: str, pit: DataFrame, sats: Mapping[str, DataFrame], *,
    mandatory: Sequence[str] = (), date: Column | None = None,
) -> DataFrame:
    """Hub with each satellite's attributes as they stood on the snapshot: equi joins on (hash key, load time)."""
    snap = pit if date is None else pit.filter(F.col("snapshot_date") == date)
    out = snap.join(hub, hk)
    for name, sat in sats.items():
        attrs = [c for c in sat.columns if c not in (hk, "load_date", "load_end_date", "hash_diff", "record_source")]
        side = sat.select(hk, F.col("load_date").alias(f"{name}_load_date"), *attrs)
        out = out.join(side, [hk, f"{name}_load_date"], "inner" if name in mandatory else "left")
    return out


def load_ref_hub(stage: DataFrame, code: str, source: str, load: Column, existing: DataFrame | None = None) -> DataFrame:
    """Reference hub: one row per code, with its hash key, first load time and lineage; codes already stored are left out."""
    rows = stage.filter(F.col(code).isNotNull()).select(F.col(code), load.alias("load_date"))
    out = rows.groupBy(code).agg(F.min("load_date").alias("load_date"))
    out = out.select(hash_key([code], F.lit(source)).alias(f"{code}_hk"), code, "load_date", F.lit(source).alias("record_source"))
    return _unseen(out, existing, [code])


def load_ref(stage: DataFrame, attrs: Sequence[str], source: str, load: Column) -> DataFrame:
    """Reference table pass-through with load time, attribute hash and lineage."""
    return stage.withColumns(
        {"load_date": load, "hash_diff": row_hash(attrs), "record_source": F.lit(source)}
    )
