"""Joins shared by the plans. None carries a size hint unless the size is fixed by the code itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevault.functions.hashing import narrowed, text_columns, widened
from tradevault.functions.ordered import BINS, TARGET_ROWS, packed


def assemble_entity(
    hub: DataFrame, pit: DataFrame, hk: str, mandatory: Mapping[str, DataFrame], optional: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Hub, point-in-time table, required satellites (inner) and optional ones (left) on (hash key, load time)."""
    out = pit.join(hub, hk)
    for how, sats in (("inner", mandatory), ("left", optional or {})):
        for name, sat in sats.items():
            out = out.join(sat.withColumnRenamed("load_date", f"{name}_load_date"), [hk, f"{name}_load_date"], how)
    return out


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Join dimension tables in the order given; each entry is (dimension, key shared with the fact, how). The fact's text is moved as bytes."""
    keys = [key for _, key, _ in dims]
    text = [c for c in text_columns(fact) if c not in keys]
    fact = narrowed(fact, text)
    for dim, key, how in dims:
        fact = fact.join(dim, key, how)
    return fact.withColumns({c: widened(f"`{c}`") for c in text})


def describe(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], keys_of: DataFrame | None = None) -> DataFrame:
    """``star_join`` of a fact whose rows share their dimension rows: the distinct combinations of keys pass through the joins, one narrow
    row each, and the wide fact is shuffled once, its text as bytes, to pick up its combination. ``keys_of`` names a plainer
    table with the same key columns to take the combinations from. A stream is joined row by row, as its distinct rows would be state."""
    if fact.isStreaming:
        return star_join(fact, dims)
    keys = [key for _, key, _ in dims]
    found = (fact if keys_of is None else keys_of).select(*keys).distinct()
    for dim, key, how in dims:
        found = found.join(dim, key, how)
    more = [c for c in found.columns if c not in keys]
    text = [c for c in text_columns(fact) if c not in keys]
    found = found.select(packed(keys).alias("__keys"), *more)
    out = narrowed(fact.withColumn("__keys", packed(keys)), text).join(found, "__keys").drop("__keys")
    return out.withColumns({c: widened(f"`{c}`") for c in text})


def key_splits(child: DataFrame, key: str, target_rows: int = TARGET_ROWS) -> DataFrame:
    """(key, splits) of the keys that own more than ``target_rows`` rows; store it with the child table it is counted from.

    Rows are counted per hash of the key first, and only keys of hashes above the target by themselves, so distinct keys are not shuffled."""
    rows = child.filter(F.col(key).isNotNull()).select(key, F.pmod(F.xxhash64(key), F.lit(BINS)).alias("__bin"))
    full = rows.groupBy("__bin").agg(F.count("*").alias("__rows")).filter(F.col("__rows") > target_rows).select("__bin")
    counted = rows.join(F.broadcast(full), "__bin", "left_semi").groupBy(key).agg(F.count("*").alias("__n"))
    return counted.filter(F.col("__n") > target_rows).select(key, F.ceil(F.col("__n") / target_rows).cast("int").alias("__splits"))


def expand_left(
    parent: DataFrame, child: DataFrame, key: str, target_rows: int = TARGET_ROWS, sizes: DataFrame | None = None, splits: DataFrame | tuple[()] | None = None,
) -> DataFrame:
    """Left join of one parent row to its many children, safe for a parent that owns most children.

    Adaptive execution can only split the left side of a left join. So the children of a key above the target are salted and
    its parent row is repeated once per salt; all other keys have one salt. One lazy plan serves every size. ``sizes`` names a
    narrower table with the child keys to count; ``splits`` gives what ``key_splits`` stored with the child, and nothing is counted.
    ``splits=()`` says that no key is above the target: a plain join, which joins on the same key share their shuffle with.
    At most (children / target) keys are salted, which bounds what is broadcast.
    """
    if isinstance(splits, tuple):
        return parent.join(child, key, "left")
    if splits is None:
        splits = key_splits(child if sizes is None else sizes, key, target_rows)
    splits = F.broadcast(splits)
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("__splits", F.lit(1)) - 1))
    p = parent.join(splits, key, "left").withColumn("__salt", salts)
    spread = F.pmod(F.xxhash64(*child.columns), F.coalesce("__splits", F.lit(1)).cast("long")).cast("int")
    c = child.join(splits, key, "left").withColumn("__salt", spread).drop("__splits").withColumn("__child", F.lit(True))
    # a salted parent has children for certain: its empty salts are dropped
    out = p.join(c, [key, "__salt"], "left").filter("__child or __splits is null")
    return out.drop("__salt", "__splits", "__child")


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Distinct non-null child keys without a parent. Both sides shrink to distinct keys before the join."""
    c = child.select(*on).dropna().distinct()
    p = parent.select(*[F.col(v).alias(k) for k, v in on.items()]).distinct()
    return c.join(p, list(on), "left_anti")


def uncovered(parent: DataFrame, child: DataFrame, on: Sequence[str]) -> DataFrame:
    """Parents without a matching child; filter the child first."""
    return parent.join(child.select(*on), list(on), "left_anti")


def attach_counts(df: DataFrame, child: DataFrame, key: Sequence[str], out: str) -> DataFrame:
    """Child count per key with zero for none."""
    n = child.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    return df.join(n, list(key), "left").withColumn(out, F.coalesce("__n", F.lit(0))).drop("__n")


def exists_flag(df: DataFrame, child: DataFrame, key: Sequence[str], out: str, where: Column | str | None = None) -> DataFrame:
    """TRUE when a matching child exists, else FALSE."""
    rows = child if where is None else child.filter(where)
    found = rows.select(*key).distinct().withColumn("__f", F.lit(True))
    return df.join(found, list(key), "left").withColumn(out, F.coalesce("__f", F.lit(False))).drop("__f")


def code_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Codes on one side only, labelled with the side."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    only_a = left.join(right, key, "left_anti").withColumn("only_in", F.lit("left"))
    return only_a.unionByName(right.join(left, key, "left_anti").withColumn("only_in", F.lit("right")))


def reconcile(
    internal: DataFrame, external: DataFrame, keys: Sequence[str], measure: str, *, tolerance: float = 0.0
) -> DataFrame:
    """Two-sided comparison; the break is the external value minus the internal one, an absent side counts as zero."""
    # a NULL key is a key of its own, so it is matched as part of a struct
    key = F.struct(*keys).alias("__key")
    i = internal.groupBy(key).agg(F.sum(measure).alias("internal_value"), F.lit(True).alias("__i"))
    e = external.groupBy(key).agg(F.sum(measure).alias("external_value"), F.lit(True).alias("__e"))
    zero = F.lit(0)
    gap = F.coalesce("external_value", zero) - F.coalesce("internal_value", zero)
    status = (
        F.when(F.col("__i").isNull(), "EXTERNAL_ONLY")
        .when(F.col("__e").isNull(), "INTERNAL_ONLY")
        .when(F.abs("break_value") <= F.lit(tolerance), "MATCHED")
        .otherwise("BROKEN")
    )
    out = i.join(e, "__key", "full_outer").withColumn("break_value", gap).withColumn("reconciliation_status", status)
    return out.select(*[F.col("__key")[k].alias(k) for k in keys], "internal_value", "external_value", "break_value", "reconciliation_status")
