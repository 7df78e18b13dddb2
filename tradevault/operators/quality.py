"""Row expectations, table checks, integrity checks and state-machine validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradevault.functions.hashing import hash_key, link_key
from tradevault.functions.ordered import in_order
from tradevault.operators.interval import pit_lookup

Rules = Mapping[str, str]


def holds(rule: str) -> Column:
    """A rule that is not TRUE counts as broken, NULL included."""
    return F.coalesce(F.expr(rule), F.lit(False))


def violations(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with the number of broken rows, from a single pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count(F.when(~holds(r), 1)).alias(f"`{n}`") for n, r in rules.items()]
    ).toDF("total", *rules)
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("broken")) for n in rules]))
    return counts.select("total", pairs.alias("p")).select("p.rule", "p.broken", "total")


def expect(df: DataFrame, rules: Rules, mode: str = "fail") -> DataFrame:
    """Apply named rules while rows flow by, in batch or stream, without a second pass.

    ``fail`` stops the job at the first broken row and names the rules; ``drop`` removes broken rows; ``warn`` adds an
    array of broken rule names.
    """
    if not rules:
        return df
    broken = F.array_compact(F.array(*[F.when(~holds(r), F.lit(n)) for n, r in rules.items()]))
    if mode == "drop":
        return df.filter(reduce(lambda a, b: a & b, [holds(r) for r in rules.values()]))
    if mode == "warn":
        return df.withColumn("broken_rules", broken)
    if mode != "fail":
        raise ValueError(f"unknown mode {mode!r}")
    stop = F.raise_error(F.concat(F.lit("expectation failed: "), F.concat_ws(",", broken)))
    return df.filter(F.when(F.size(broken) == 0, F.lit(True)).otherwise(stop.cast("boolean")))


def quarantine(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and rows that fail with the names of the rules they broke."""
    marked = expect(df, rules, "warn")
    return marked.filter(F.size("broken_rules") == 0).drop("broken_rules"), marked.filter(F.size("broken_rules") > 0)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def count_band(df: DataFrame, low: int, high: int) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("n"), F.when(n.between(low, high), "PASS").otherwise("FAIL").alias("outcome"))


def freshness(df: DataFrame, col: str, as_of: str, days: int) -> DataFrame:
    last = F.max(F.to_date(col))
    ok = last >= F.date_sub(F.to_date(F.lit(as_of)), days)
    return df.agg(last.alias("last_seen"), F.when(ok, "PASS").otherwise("FAIL").alias("outcome"))


def scd2_invariants(dim: DataFrame, key: str, lineage: str = "dv2_source_hk") -> DataFrame:
    """Broken type-2 rules, one row per rule with a count.

    A deleted key may have no current row, so the rule is at most one. Versions are at most one per key and day, which
    bounds the overlap window.
    """
    line = Window.partitionBy(key).orderBy("effective_start_date", "effective_end_date")
    nxt = F.lead("effective_start_date").over(line)
    # a running count of current rows marks every second one of a key
    current_no = F.sum(F.col("is_current").cast("int")).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = dim.withColumns({"__next": nxt, "__cur": current_no})
    rules = {
        "one_current_row": "NOT is_current OR __cur <= 1",
        "row_hash_64": "length(row_hash) = 64",
        "start_not_after_end": "effective_start_date <= effective_end_date",
        "closed_row_bounded": "is_current OR effective_end_date < DATE'9999-12-31'",
        "key_not_null": f"{key} IS NOT NULL",
        "lineage_not_null": f"{lineage} IS NOT NULL",
        "no_overlap": "__next IS NULL OR effective_end_date < __next",
    }
    return violations(seen, rules)


def fact_invariants(fact: DataFrame, codes: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Required keys, registered event code, and event date equal to the date of the timestamp."""
    known = codes.select("cat_event_code").distinct().withColumn("__known", F.lit(True))
    rules = {
        "firm_roe_id_required": "firm_roe_id IS NOT NULL",
        "lineage_required": "dv2_source_hk IS NOT NULL",
        "code_required": "cat_event_code IS NOT NULL",
        "code_registered": "__known",
        "event_date_matches": f"event_date = to_date({ts})",
    }
    return violations(fact.join(F.broadcast(known), "cat_event_code", "left"), rules)


def misfiled(fact: DataFrame, event_types: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Codes in a fact whose submission file type does not belong there, with row counts."""
    per_code = fact.groupBy("cat_event_code").agg(F.count(F.lit(1)).alias("n"))
    types = event_types.select("cat_event_code", "submission_file_type")
    return per_code.join(types, "cat_event_code", "left").filter(
        F.col("submission_file_type").isNull() | ~F.col("submission_file_type").isin(*allowed)
    )


def unresolved_keys(fact: DataFrame, dim: DataFrame, fact_sk: str, dim_sk: str) -> DataFrame:
    keys = fact.select(F.col(fact_sk).alias(dim_sk)).dropna().distinct()
    return keys.join(dim.select(dim_sk).distinct(), dim_sk, "left_anti")


def point_in_time_offenders(fact: DataFrame, dim: DataFrame, fact_sk: str, dim_sk: str, date_col: str) -> DataFrame:
    """Fact rows whose resolved version was not in force on their date. Surrogate keys are unique, so this is one to one."""
    d = dim.select(F.col(dim_sk).alias(fact_sk), "effective_start_date", "effective_end_date")
    return fact.join(d, fact_sk).filter(
        (F.col(date_col) < F.col("effective_start_date")) | (F.col(date_col) > F.col("effective_end_date"))
    )


def unregistered_firms(fact: DataFrame, registry: DataFrame, firm: str, date_col: str) -> DataFrame:
    """(firm, date) pairs outside every registration window of the firm; pairs are made distinct first."""
    pairs = fact.select(firm, F.col(date_col).alias("event_date")).distinct()
    found = pit_lookup(pairs, registry, firm, firm, "event_date", {"__start": "effective_start_date"})
    return found.filter(F.col("__start").isNull()).select(firm, "event_date")


def state_transitions(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], status: str = "status", chunk: Column | None = None
) -> DataFrame:
    """Each status row with the status before it."""
    return in_order(rows, keys, order, chunk, lag={"from_state": status})


def invalid_transitions(transitions: DataFrame, edges: DataFrame, machine: str, status: str = "status") -> DataFrame:
    """Rows whose move is not an edge of the machine; a first row must be the entry state, a repeat is no move."""
    allowed = edges.filter(F.col("machine") == machine).select(
        F.col("from_state").alias("__from"), F.col("to_state").alias("__to")
    )
    moved = transitions.filter(~F.col("from_state").eqNullSafe(F.col(status)))
    on = F.col("from_state").eqNullSafe(F.col("__from")) & (F.col(status) == F.col("__to"))
    return moved.join(F.broadcast(allowed), on, "left_anti")


def invalid_moves(transitions: DataFrame, edges: DataFrame, status: str = "status") -> DataFrame:
    """As ``invalid_transitions`` for rows of many machines, named by their ``machine`` column; the moves of all are one short list."""
    allowed = edges.select(F.col("machine").alias("__machine"), F.col("from_state").alias("__from"), F.col("to_state").alias("__to"))
    moved = transitions.filter(~F.col("from_state").eqNullSafe(F.col(status)))
    on = (F.col("machine") == F.col("__machine")) & F.col("from_state").eqNullSafe(F.col("__from")) & (F.col(status) == F.col("__to"))
    return moved.join(F.broadcast(allowed), on, "left_anti")


def clock_sync(df: DataFrame, offset_ms: str, manual: str, by: Sequence[str]) -> DataFrame:
    """Share of readings within 50 ms (electronic) or 1 s (manual)."""
    limit = F.when(F.col(manual), 1000).otherwise(50)
    ok = F.abs(F.col(offset_ms)) <= limit
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("readings"), F.count(F.when(~ok, 1)).alias("breaches"),
        F.max(F.abs(F.col(offset_ms))).alias("worst_offset_ms"),
    )


def bad_hub_keys(hub: DataFrame, entity: str) -> DataFrame:
    """Hub rows whose hash key does not recompute from key text and source (single-part keys)."""
    return hub.filter(F.col(f"{entity}_hk") != hash_key([f"{entity}_bk"], F.col("record_source")))


def bad_link_keys(link: DataFrame, hk: str, members: Sequence[str]) -> DataFrame:
    return link.filter(F.col(hk) != link_key(members))


def missing_snapshots(hub: DataFrame, pit: DataFrame, hk: str, date: Column) -> DataFrame:
    """Hub rows without a point-in-time row on a date."""
    return hub.select(hk).join(pit.filter(F.col("snapshot_date") == date).select(hk), hk, "left_anti")


def bridge_orphans(bridge: DataFrame, hub: DataFrame, hk: str) -> DataFrame:
    keys = bridge.select(hk).dropna().distinct()
    return keys.join(hub.select(hk), hk, "left_anti")


def not_in_code_list(df: DataFrame, col: str, codes: DataFrame, code: str) -> DataFrame:
    """Distinct values outside a code list, with row counts; NULL is not checked."""
    per_value = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).filter(F.col(col).isNotNull())
    return per_value.join(codes.select(F.col(code).alias(col)).distinct(), col, "left_anti")


def rate_above_default(df: DataFrame, reduced: str, default: str) -> DataFrame:
    return df.filter(F.col(reduced) > F.col(default))


def bad_quotes(df: DataFrame) -> DataFrame:
    """Two-way quotes that miss a side, and crossed quotes."""
    two_way = (F.col("quote_side") == "TWO_WAY") & (F.col("bid_price").isNull() | F.col("ask_price").isNull())
    crossed = F.col("bid_price") > F.col("ask_price")
    issue = F.when(two_way, "MISSING_SIDE").when(crossed, "CROSSED")
    return df.withColumn("issue", issue).filter("issue is not null")
