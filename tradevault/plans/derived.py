"""Derived analytics: roll-ups, best execution, latency, confirmation, routing, concentration, fail rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradevault.functions.hashing import as_col, narrowed, text_columns, widened
from tradevault.functions.ordered import share_of, in_order
from tradevault.functions.scalars import micros_between, ratio
from tradevault.operators.interval import asof_join



def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def sum_if(cond: Column, value: Column | str) -> Column:
    return F.coalesce(F.sum(F.when(cond, as_col(value))), F.lit(0))


def count_per(df: DataFrame, key: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias(out))


def participation(df: DataFrame, flags: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Totals of flags per period, each with the total of the period before. Periods are few after the aggregation."""
    totals = df.groupBy(*by).agg(*[count_if(F.col(f)).alias(f) for f in flags])
    line = Window.orderBy(*by)
    return totals.withColumns({f"prior_{f}": F.lag(f).over(line) for f in flags})


def daily_lifecycle(fills: DataFrame, by: Sequence[str] = ("fact_date", "party_id", "instrument_id", "venue_id")) -> DataFrame:
    """Orders, executions, notionals, average fill price, volume-weighted price and settlement fails per key.

    Distinct orders come from a first aggregation per (key, order), so no row is multiplied for a distinct count.
    Columns used: order_id, order_status, side, quantity, amount, price, settlement_status.
    """
    buy, done = F.col("side") == "BUY", F.col("settlement_status") == "SETTLED"
    per_order = fills.groupBy(*by, "order_id").agg(
        F.max(F.col("order_status") == "FILLED").alias("filled"),
        F.max(F.col("order_status") == "CANCELLED").alias("cancelled"),
        F.max(F.col("order_status") == "REJECTED").alias("rejected"),
        F.count("*").alias("n"),
        sum_if(buy, "amount").alias("buy"), sum_if(~buy, "amount").alias("sell"),
        F.sum("price").alias("price_sum"), F.sum("amount").alias("amount"), F.sum("quantity").alias("quantity"),
        count_if(~done).alias("fails"),
    )
    return per_order.groupBy(*by).agg(
        F.count("*").alias("order_count"),
        count_if(F.col("filled")).alias("executed_order_count"),
        count_if(F.col("cancelled")).alias("cancelled_order_count"),
        count_if(F.col("rejected")).alias("rejected_order_count"),
        F.sum("n").alias("execution_count"),
        F.sum("buy").alias("buy_notional"), F.sum("sell").alias("sell_notional"), F.sum("amount").alias("total_notional"),
        ratio(F.sum("price_sum"), F.sum("n")).alias("avg_fill_price"),
        ratio(F.sum("amount"), F.sum("quantity")).alias("vwap"),
        F.sum("fails").alias("settlement_fail_count"),
    )


def party_instrument_activity(fills: DataFrame) -> DataFrame:
    """Party by instrument by day: first order, last execution, counts, quantities and notional."""
    by = ["party_id", "instrument_id", "activity_date"]
    buy = F.col("side") == "BUY"
    per_order = fills.withColumn("activity_date", F.to_date("order_ts")).groupBy(*by, "order_id").agg(
        F.min("order_ts").alias("first_ts"), F.max("fill_ts").alias("last_ts"), F.count("*").alias("n"),
        sum_if(buy, "quantity").alias("b"), sum_if(~buy, "quantity").alias("s"), F.sum("amount").alias("amount"),
    )
    return per_order.groupBy(*by).agg(
        F.min("first_ts").alias("first_order_timestamp"), F.max("last_ts").alias("last_execution_timestamp"),
        F.count("*").alias("order_count"), F.sum("n").alias("execution_count"), F.sum("b").alias("buy_quantity"),
        F.sum("s").alias("sell_quantity"), F.sum("amount").alias("notional"),
    )


def venue_quality_aggregates() -> list[Column]:
    """Aggregates of the hourly venue view; batch and stream share them.

    Columns used: quantity, order_quantity, improvement_bps, spread_bps, latency_ms.
    """
    return [
        F.sum("quantity").alias("executed_qty"),
        ratio(F.sum("quantity"), F.sum("order_quantity")).alias("fill_rate"),
        ratio(F.sum("improvement_bps"), F.count("improvement_bps")).alias("price_improvement_bps_avg"),
        ratio(F.sum("spread_bps"), F.count("spread_bps")).alias("effective_spread_bps_avg"),
        ratio(F.sum("latency_ms"), F.count("latency_ms")).alias("avg_latency_ms"),
    ]


def venue_quality_hourly(execs: DataFrame, ts: str = "fill_ts") -> DataFrame:
    hour = F.date_trunc("hour", ts).alias("hour_ts")
    return execs.groupBy(hour, "venue_id", "instrument_id").agg(*venue_quality_aggregates())


def venue_score(df: DataFrame) -> DataFrame:
    """Our composite (0 to 100): 50 for the fill rate, 30 for a tight spread, 20 for low latency."""
    spread = F.greatest(F.lit(0.0), 1 - F.coalesce("effective_spread_bps_avg", F.lit(0.0)) / 100)
    latency = F.greatest(F.lit(0.0), 1 - F.coalesce("avg_latency_ms", F.lit(0.0)) / 1000)
    fill = F.least(F.lit(1.0), F.coalesce("fill_rate", F.lit(0.0)))
    return df.withColumn("venue_quality_score", fill * 50 + spread * 30 + latency * 20)


def event_coverage(events: DataFrame, by: Sequence[str]) -> DataFrame:
    """Reported, late, rejected and corrected shares. Columns used: reported, late, rejected, corrected (boolean)."""
    flags = ("reported", "late", "rejected", "corrected")
    counts = events.groupBy(*by).agg(
        F.count("*").alias("event_count"), *[count_if(F.col(f)).alias(f"{f}_count") for f in flags]
    )
    return counts.withColumn("coverage_pct", ratio("reported_count", "event_count"))


def uncovered_codes(event_types: DataFrame, used: DataFrame, code: str = "cat_event_code") -> DataFrame:
    return event_types.select(code, "category").join(used.select(code).distinct(), code, "left_anti")


def coverage_depth(mapping: DataFrame, codes: DataFrame) -> DataFrame:
    """How many codes have how many mapping rows; mapping rows list their codes separated by commas."""
    refs = mapping.select(F.explode(F.split("event_codes", ",")).alias("c")).select(F.trim("c").alias("cat_event_code"))
    depth = refs.groupBy("cat_event_code").agg(F.count("*").alias("__n"))
    per_code = codes.select("cat_event_code").join(depth, "cat_event_code", "left")
    return per_code.groupBy(F.coalesce("__n", F.lit(0)).alias("mapping_rows")).agg(F.count("*").alias("codes"))


def routing_summary(routes: DataFrame) -> DataFrame:
    """Routes and quantity per venue and order type, with the venue's share of the order type."""
    per = routes.groupBy("venue_id", "order_type").agg(F.count("*").alias("routes"), F.sum("quantity").alias("quantity"))
    return share_of(per, ["order_type"], "routes", "route_share")


def concentration(exposures: DataFrame, party: str, against: str, amount: str) -> DataFrame:
    """Sum of squared exposure shares per party, from exact sums: total of squares over the square of the total."""
    per = exposures.groupBy(party, against).agg(F.sum(amount).cast("decimal(18,4)").alias("x"))
    sq = F.sum((F.col("x") * F.col("x")).cast("decimal(38,4)"))
    total = F.sum("x").cast("double")
    return per.groupBy(party).agg(
        F.count("*").alias("counterparties"), (sq.cast("double") / (total * total)).alias("concentration_score")
    )


def fail_rate(settlements: DataFrame, by: Sequence[str], penalty_rate: float = 0.0001) -> DataFrame:
    """Empirical settlement fail rate and expected penalty per bucket."""
    failed = F.col("settlement_status") == "FAILED"
    return settlements.groupBy(*by).agg(
        F.count("*").alias("settlements"), count_if(failed).alias("fails"),
        ratio(count_if(failed), F.count("*")).alias("fail_probability"),
        (sum_if(failed, "amount").cast("double") * penalty_rate).alias("expected_penalty"),
    )


# ---- windows ------------------------------------------------------------------------------------------------------


def fill_progress(execs: DataFrame, order_quantity: str = "order_quantity") -> DataFrame:
    """Fill ordinal, cumulative and leaves quantity, and the fill's share of the order quantity."""
    out = in_order(
        execs, ["order_id"], ["fill_ts", "fill_id"],
        number="fill_sequence", running={"cumulative_qty": "quantity"},
    )
    return out.withColumns(
        {
            "leaves_qty": F.col(order_quantity) - F.col("cumulative_qty"),
            "fill_contribution_pct": ratio("quantity", order_quantity),
        }
    )


def ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str) -> DataFrame:
    return in_order(df, keys, order, number=out)


def monotonic_violations(df: DataFrame, part: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Rows whose value is below the value before it in the order."""
    seen = in_order(df, part, order, lag={"previous_value": value})
    return seen.filter(F.col(value) < F.col("previous_value"))


def allocation_pct(allocations: DataFrame, parent: str = "parent_execution_id", qty: str = "allocated_quantity") -> DataFrame:
    return share_of(allocations, [parent], qty, "allocation_pct")


def allocate(fills: DataFrame, instructions: DataFrame, key: str, fill: str = "fill_id", qty: str = "units") -> DataFrame:
    """Split each fill's whole units over the instructions of its key, largest remainder first, so that parts add up.

    ``instructions`` has allocation_rule, target_percentage, target_quantity and account_id. Integer arithmetic keeps
    the split exact.
    """
    text = [c for c in text_columns(fills) if c == fill]
    fills = narrowed(fills, text)
    rule = F.col("allocation_rule")
    weight = (
        F.when(rule == "PCT_BASED", F.round(F.col("target_percentage") * 10000))
        .when(rule == "EQUAL", F.lit(1))
        .otherwise(F.col("target_quantity"))
        .cast("long")
    )
    weighted = instructions.withColumn("__w", weight)
    total = weighted.groupBy(key).agg(F.sum("__w").alias("__total"))
    rows = fills.join(weighted.join(total, key), key).filter("__total > 0")
    num = F.col(qty).cast("long") * F.col("__w")
    rows = rows.withColumns(
        {"__base": F.expr(f"(cast({qty} as bigint) * __w) div __total"), "__rem": num % F.col("__total")}
    )
    left = rows.groupBy(fill).agg((F.max(F.col(qty).cast("long")) - F.sum("__base")).alias("__left"))
    ranked = in_order(
        rows, [fill], [-F.col("__rem"), "account_id"], number="__rank"
    )
    units = F.col("__base") + F.when(F.col("__rank") <= F.col("__left"), 1).otherwise(0)
    out = ranked.join(left, fill).withColumn("allocated_units", units).drop("__w", "__total", "__base", "__rem", "__rank", "__left")
    return out.withColumns({c: widened(f"`{c}`") for c in text})


def top_instruction(instructions: DataFrame, key: Sequence[str]) -> DataFrame:
    """Preferred instruction per key: lowest priority rank, then id. An aggregate, not a per-key sort."""
    rest = [c for c in instructions.columns if c not in key]
    best = F.min_by(F.struct(*rest), F.struct("priority_rank", "instruction_id"))
    return instructions.groupBy(*key).agg(best.alias("b")).select(*key, "b.*")


def break_aging(daily: DataFrame, keys: Sequence[str], as_of: str) -> DataFrame:
    """Day-over-day position change and age of the break. One row per key and day, so the window is bounded by days."""
    line = Window.partitionBy(*keys).orderBy("position_date")
    before = F.lag("net_quantity").over(line)
    return daily.withColumns(
        {
            "position_change": F.col("net_quantity") - F.coalesce(before, F.lit(0)),
            "aging_days": F.datediff(F.to_date(F.lit(as_of)), "position_date"),
        }
    )


# ---- derived links and satellites ------------------------------------------------------------------------------------


def derive_order_link(
    executions: DataFrame, orders: DataFrame, exact: Sequence[str], nearest: Sequence[str], max_gap_seconds: int
) -> DataFrame:
    """Order of each execution without an explicit link: exact keys first, else the nearest order in time.

    An exact match needs one order per exact key; where several share it the lowest id is taken. The remaining rows look
    back and forward along a time line per ``nearest`` key (no pairs are formed) and keep the closer order in reach.
    Confidence is 1.00 for exact, else falls linearly from 0.90 to 0.50 with the gap.
    """
    by_key = orders.groupBy(*exact).agg(F.min("order_id").alias("order_id"))
    e = executions.drop("order_id")
    first = e.join(by_key, list(exact), "left")
    hits = first.filter("order_id is not null").select(
        "fill_id", "order_id", F.lit("EXACT_KEY").alias("derivation_rule"), F.lit(1.0).alias("confidence_score")
    )
    rest = e.join(by_key, list(exact), "left_anti")
    o = orders.select(*nearest, "order_id", "order_ts")
    take_b, take_f = {"b_id": "order_id", "b_ts": "order_ts"}, {"f_id": "order_id", "f_ts": "order_ts"}
    around = asof_join(rest, o, nearest, "fill_ts", "order_ts", take_b, tie=["order_id"])
    around = asof_join(around, o, nearest, "fill_ts", "order_ts", take_f, tie=["order_id"], direction="forward")
    gap_b, gap_f = micros_between("b_ts", "fill_ts"), micros_between("fill_ts", "f_ts")
    back = gap_f.isNull() | (gap_b <= gap_f)
    gap = F.when(back, gap_b).otherwise(gap_f)
    limit = max_gap_seconds * 1_000_000
    near = (
        around.withColumns({"order_id": F.when(back, F.col("b_id")).otherwise(F.col("f_id")), "__gap": gap})
        .filter(F.col("__gap") <= limit)
        .select(
            "fill_id", "order_id", F.lit("TIMESTAMP_NEAREST").alias("derivation_rule"),
            (0.9 - 0.4 * F.col("__gap") / F.lit(float(limit))).alias("confidence_score"),
        )
    )
    return hits.unionByName(near)


def best_execution(execs: DataFrame, quotes: DataFrame) -> DataFrame:
    """Per execution: arrival mid, interval benchmarks, shortfall, improvement, effective and realised spread in bps.

    The arrival mid is the last quote at or before the order, the post-trade mid the first quote at or after the
    execution; interval benchmarks are the instrument's day. Columns used: instrument_id, order_ts, fill_ts, side, price,
    limit_price, quantity, amount; quotes: instrument_id, quote_ts, bid_price, ask_price, quote_id.
    """
    q = quotes.withColumn("mid", (F.col("bid_price") + F.col("ask_price")) / F.lit(2).cast("decimal(2,0)"))
    q = q.select("instrument_id", "quote_ts", F.col("mid").cast("double").alias("mid"), "quote_id")
    rows = asof_join(execs, q, ["instrument_id"], "order_ts", "quote_ts", {"arrival_price": "mid"}, tie=["quote_id"])
    rows = asof_join(rows, q, ["instrument_id"], "fill_ts", "quote_ts", {"post_mid": "mid"}, tie=["quote_id"], direction="forward")
    day = execs.groupBy("instrument_id", F.to_date("fill_ts").alias("__day")).agg(
        ratio(F.sum("amount"), F.sum("quantity")).alias("vwap_benchmark"),
        ratio(F.sum("price"), F.count("*")).alias("twap_benchmark"),
    )
    rows = rows.withColumn("__day", F.to_date("fill_ts")).join(day, ["instrument_id", "__day"], "left").drop("__day")
    sign = F.when(F.col("side") == "BUY", 1.0).otherwise(-1.0)
    px, arr, lim, post = (F.col(c).cast("double") for c in ("price", "arrival_price", "limit_price", "post_mid"))
    return rows.withColumns(
        {
            "implementation_shortfall_bps": sign * (px - arr) / arr * 10000.0,
            "price_improvement_bps": sign * (lim - px) / lim * 10000.0,
            "effective_spread_bps": 2.0 * F.abs(px - arr) / arr * 10000.0,
            "realized_spread_bps": 2.0 * sign * (px - post) / arr * 10000.0,
        }
    )


def execution_latency(df: DataFrame, breach_ms: int = 50) -> DataFrame:
    """Stage latencies in ms, clock breach flag and bucket. Columns used: order_ts, route_ts, ack_ts, fill_ts."""

    def ms(a: str, b: str) -> Column:
        return F.floor(micros_between(a, b) / 1000).cast("long")

    total = ms("order_ts", "fill_ts")
    bucket = (
        F.when(micros_between("order_ts", "fill_ts") < 1000, "SUB_MS")
        .when(total < 10, "LOW").when(total < 1000, "MED").when(total < 60_000, "HIGH").otherwise("OUTLIER")
    )
    return df.withColumns(
        {
            "order_to_route_ms": ms("order_ts", "route_ts"), "route_to_ack_ms": ms("route_ts", "ack_ts"),
            "ack_to_exec_ms": ms("ack_ts", "fill_ts"), "total_order_life_ms": total,
            "clock_sync_breach": ms("order_ts", "route_ts") > breach_ms, "latency_bucket": bucket,
        }
    )


def confirmation_sla(df: DataFrame, trade_ts: str = "trade_ts", affirm_ts: str = "affirm_ts") -> DataFrame:
    """Same-day affirmation, minutes to affirm and bucket; an unaffirmed trade is at risk."""
    minutes = F.floor(micros_between(trade_ts, affirm_ts) / 60_000_000).cast("long")
    bucket = F.when(minutes.isNull(), "NONE").when(minutes <= 60, "HOUR").when(minutes <= 480, "DAY").otherwise("LATE")
    return df.withColumns(
        {
            "same_day_affirm_flag": F.coalesce(F.to_date(trade_ts) == F.to_date(affirm_ts), F.lit(False)),
            "time_to_affirm_minutes": minutes, "affirm_latency_bucket": bucket, "dk_risk_flag": F.col(affirm_ts).isNull(),
        }
    )
