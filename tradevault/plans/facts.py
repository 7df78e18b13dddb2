"""Event-grain facts: curate, gate, resolve dimension keys at the event date, gate again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevault.functions.hashing import as_col, narrow_join, narrowed, text_columns, widened
from tradevault.functions.ordered import packed
from tradevault.operators.interval import current_lookup, few_versions, join_date, pit_lookup
from tradevault.operators.joins import attach_counts
from tradevault.operators.quality import expect
from tradevault.operators.scd2 import latest_by
from tradevault.plans import rules

# fixed values: event codes per fact
OPTION_ORDER_CODES = [
    "MONO",
    "MONOS",
    "MOOR",
    "MOMR",
    "MOCR",
    "MOORS",
    "MOMRS",
    "MOCRS",
    "MOOA",
    "MOIR",
    "MOIM",
    "MOIC",
    "MOIMR",
    "MOICR",
    "MOCO",
    "MOCOM",
    "MOCOC",
    "MOOM",
    "MOOMS",
    "MOOMR",
    "MOOJ",
    "MOOC",
    "MOOCR",
    "MONQ",
    "MORQ",
    "MOQR",
    "MOQC",
    "MOQM",
    "MOOE",
]
OPTION_EXECUTION_CODES = [
    "MOOT",
    "MOOF",
    "MOOFS",
    "MOFA",
]
OPTION_ALLOCATION_CODES = [
    "MOPA",
    "MOAA",
]
MULTILEG_CODES = [
    "MLNO",
    "MLOR",
    "MLMR",
    "MLCR",
    "MLOA",
    "MLIR",
    "MLIM",
    "MLIC",
    "MLIMR",
    "MLICR",
    "MLCO",
    "MLCOM",
    "MLCOC",
    "MLOM",
    "MLOMR",
    "MLOC",
    "MLOCR",
    "MLNQ",
    "MLRQ",
    "MLQS",
    "MLQR",
    "MLQC",
    "MLQM",
    "MLOS",
    "MLOE",
]
EQUITY_EXECUTION_CODES = [
    "MEOT",
    "MEOTS",
]
EQUITY_ALLOCATION_CODES = [
    "MEPA",
    "MEAA",
]
EQUITY_QUOTE_CODES = [
    "MENQ",
    "MENQS",
    "MERQ",
    "MERQS",
    "MEQR",
    "MEQC",
    "MEQM",
    "MEQS",
]
EQUITY_ORDER_CODES = [
    "MENO",
    "MENOS",
    "MEOR",
    "MEORS",
    "MEMR",
    "MEMRS",
    "MECR",
    "MECRS",
    "MEOA",
    "MEIR",
    "MEIM",
    "MEIC",
    "MEIMR",
    "MEICR",
    "MECO",
    "MECOM",
    "MECOC",
    "MEOM",
    "MEOMS",
    "MEOMR",
    "MEOJ",
    "MEOC",
    "MEOCR",
    "MEOE",
]

FACT_CODES: dict[str, list[str]] = {
    "option_order": OPTION_ORDER_CODES,
    "option_execution": OPTION_EXECUTION_CODES,
    "option_allocation": OPTION_ALLOCATION_CODES,
    "multileg": MULTILEG_CODES,
    "equity_execution": EQUITY_EXECUTION_CODES,
    "equity_allocation": EQUITY_ALLOCATION_CODES,
    "equity_quote": EQUITY_QUOTE_CODES,
    "equity_order": EQUITY_ORDER_CODES,
}


def curate(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Projection to an event shape: output name -> column or expression."""
    return df.select(*[as_col(c).alias(n) for n, c in mapping.items()])


def with_constants(df: DataFrame, spec: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Constant or typed-NULL columns: name -> (value, type)."""
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in spec.items()})


def route_events(df: DataFrame, code_col: str = "cat_event_code", families: Mapping[str, Sequence[str]] = FACT_CODES) -> DataFrame:
    """Label each event with the fact it belongs to; NULL for none. The code lists are fixed, so this is one expression."""
    target = F.coalesce(*[F.when(F.col(code_col).isin(*codes), F.lit(name)) for name, codes in families.items()])
    return df.withColumn("fact", target)


def events_of(df: DataFrame, fact: str, code_col: str = "cat_event_code") -> DataFrame:
    """Events of one fact; the code list reaches the scan as a pushed filter."""
    return df.filter(F.col(code_col).isin(*FACT_CODES[fact]))


def resolve(
    fact: DataFrame, roles: Sequence[tuple[DataFrame, str, str, str, str]], date_col: str = "event_date",
    span: tuple[str, str] | None = None, keys_of: DataFrame | None = None, stored: bool = False,
) -> DataFrame:
    """Resolve surrogate keys at the event date. Each role is (dimension, fact key, dimension key, dimension sk, output).

    What a row resolves to depends on its keys and its date alone. So the distinct combinations of these, combined before the
    shuffle, pass through the lookups, one narrow row each however many events share them (all events of an order, mostly), and
    the wide fact is shuffled once, its text as bytes and unsorted, to pick up its combination. A combination that owns most events
    is a skewed many-to-one join, which adaptive execution splits. ``keys_of`` names a plainer table with the same key columns to take
    them from. ``stored``: dimensions are stored tables, so the small among them are found by counting and cost no shuffle.
    A stream is looked up row by row, as its distinct rows would be state.
    """
    if fact.isStreaming:
        for dim, key, dim_key, sk, out in roles:
            fact = pit_lookup(fact, dim, key, dim_key, date_col, {out: sk}, span=span)
        return fact
    keys = list(dict.fromkeys([*[r[1] for r in roles], date_col]))
    found = (fact if keys_of is None else keys_of).select(*keys).distinct()
    for dim, key, dim_key, sk, out in roles:
        found = pit_lookup(found, dim, key, dim_key, date_col, {out: sk}, span=span, few=stored and few_versions(dim, dim_key))
    outs = [r[4] for r in roles]
    found = found.select(packed(keys).alias("__keys"), *outs)
    text = [c for c in text_columns(fact) if c not in keys]
    wide = narrowed(fact.withColumn("__keys", packed(keys)), text)
    out = wide.join(found.hint("shuffle_hash"), "__keys", "left").select(*fact.columns, *outs)
    return out.withColumns({c: widened(f"`{c}`") for c in text})


def standard_roles(dims: Mapping[str, DataFrame], names: Sequence[str]) -> list[tuple[DataFrame, str, str, str, str]]:
    """Roles by name; ``counterparty`` is a second use of the party dimension."""
    out = []
    for n in names:
        d = "party" if n == "counterparty" else n
        sk = "counterparty_party_sk" if n == "counterparty" else f"dim_{n}_sk"
        out.append((dims[d], f"{n}_id", f"{d}_id_bk", f"dim_{d}_sk", sk))
    return out


def order_event_fact(events: DataFrame, dims: Mapping[str, DataFrame], span: tuple[str, str] | None = None) -> DataFrame:
    """Order-event fact: gate, seven point-in-time lookups, gate. Also runs on a stream against static dimensions."""
    gated = expect(events, rules.ORDER_EVENT, "fail")
    roles = standard_roles(dims, ["party", "instrument", "venue", "account", "desk", "trader", "counterparty"])
    return expect(resolve(gated, roles, span=span, keys_of=events, stored=True), rules.RESOLVED, "fail")


def allocation_fact(allocations: DataFrame, dims: Mapping[str, DataFrame], span: tuple[str, str] | None = None) -> DataFrame:
    gated = expect(allocations, rules.ALLOCATION, "fail")
    roles = standard_roles(dims, ["party", "instrument", "account", "desk"])
    return expect(resolve(gated, roles, span=span, keys_of=allocations, stored=True), rules.RESOLVED, "fail")


def quote_fact(quotes: DataFrame, dims: Mapping[str, DataFrame], span: tuple[str, str] | None = None) -> DataFrame:
    gated = expect(quotes, rules.QUOTE, "fail")
    roles = standard_roles(dims, ["party", "instrument", "venue", "trader", "counterparty"])
    return expect(resolve(gated, roles, span=span, keys_of=quotes, stored=True), rules.RESOLVED, "fail")


def current_rows(sat: DataFrame, end_col: str = "load_end_dts") -> DataFrame:
    return sat.filter(F.col(end_col).isNull())


open_roles = current_rows


def option_fact(link: DataFrame, event_sat: DataFrame, fact: str, order_sat: DataFrame | None = None) -> DataFrame:
    """Option order, execution or allocation fact from the event link and the current event (and order) state."""
    out = narrow_join(events_of(link, fact, "event_code"), current_rows(event_sat), "option_event_hk", "left")
    if order_sat is not None:
        out = narrow_join(out, current_rows(order_sat), "option_order_hk", "left")
    out = out.withColumnRenamed("event_code", "cat_event_code").withColumn("event_date", F.to_date("event_timestamp"))
    checks = {"non_null_event_dts": "event_timestamp IS NOT NULL"}
    if fact != "option_order":
        checks["non_null_quantity"] = "event_qty IS NOT NULL AND event_qty > 0"
    if fact == "option_execution":
        checks["non_null_price"] = "event_price IS NOT NULL AND event_price > 0"
    return expect(out, checks, "fail")


def multileg_headers(
    link: DataFrame, event_sat: DataFrame, order_sat: DataFrame, legs: DataFrame, dim_party: DataFrame,
    dim_date: DataFrame, mode: str = "fail",
) -> DataFrame:
    """Header fact: one row per multi-leg event with its leg count (2 to 50)."""
    h = (
        events_of(link, "multileg", "event_code")
        .join(current_rows(event_sat), "multileg_event_hk")
        .join(current_rows(order_sat), "multileg_order_hk")
    )
    h = attach_counts(h, legs, ["multileg_order_hk"], "leg_count").filter("leg_count > 0")
    h = join_date(h, dim_date, "event_timestamp")
    h = current_lookup(h, dim_party, "sender_party_id", "party_id_bk", {"party_sk": "dim_party_sk"})
    h = with_constants(h, {"instrument_sk": (None, "bigint"), "multileg_strategy_sk": (None, "bigint"), "quality_outcome": ("PASS", "string")})
    return expect(h.withColumn("event_date", F.to_date("event_timestamp")), rules.MULTILEG_HEADER, mode)


def expand_legs(header: DataFrame, legs: DataFrame, leg_sat: DataFrame, dim_instrument: DataFrame, mode: str = "fail") -> DataFrame:
    """Leg fact: one row per header and leg, with the current leg state and instrument version. The leg's key passes the joins as bytes."""
    key = text_columns(legs.select("multileg_leg_hk"))
    legs, leg_sat = (narrowed(t, key) for t in (legs, current_rows(leg_sat)))
    out = header.join(legs, "multileg_order_hk").join(leg_sat, "multileg_leg_hk")
    out = current_lookup(
        out.drop("instrument_sk"), dim_instrument, "leg_instrument_id", "instrument_id_bk",
        {"instrument_sk": "dim_instrument_sk", "leg_symbol": "symbol"}, "inner",
    )
    return expect(out.withColumns({c: widened(c) for c in key}), rules.MULTILEG_LEGS, mode)


def match_strategy(header: DataFrame, strategies: DataFrame) -> DataFrame:
    """Strategies whose leg-count band holds the header's count; a band without an upper end is open.

    Bands are met by the distinct leg counts of the headers, a short list of numbers whatever the number of headers, and
    the headers then join on equality.
    """
    bands = strategies.filter("is_current").select("leg_count_min", "leg_count_max", "multileg_strategy_bk")
    counts = header.select("leg_count").distinct()
    inside = (F.col("leg_count") >= F.col("leg_count_min")) & (F.col("leg_count") <= F.coalesce("leg_count_max", "leg_count"))
    return header.join(counts.join(bands, inside).select("leg_count", "multileg_strategy_bk"), "leg_count", "left")


IDEMPOTENCY_KEY = ["firm_roe_id", "cat_event_code", "event_date"]


def new_events(
    batch: DataFrame, existing: DataFrame | None, keys: Sequence[str] = tuple(IDEMPOTENCY_KEY),
    seq: Sequence[str] = ("event_timestamp", "event_nanos", "dv2_source_hk"),
) -> DataFrame:
    """Rows to append: the latest event per key inside the batch, and only keys not stored yet.

    Only stored dates that occur in the batch are read when ``existing`` is partitioned by event date.
    """
    latest = latest_by(batch, list(keys), list(seq))
    if existing is None:
        return latest
    days = batch.select("event_date").distinct()
    stored = existing.join(F.broadcast(days), "event_date", "left_semi").select(*keys)
    return latest.join(stored, list(keys), "left_anti")
