"""Registered queries: aggregates, windows, bridges, derived analytics and risk."""

from pyspark.sql import functions as F

from tradevault.demo import stage as s
from tradevault.demo.registry import query
from tradevault.functions import daycount
from tradevault.functions.hashing import hash_key, key_part, narrow, part_hash, widened
from tradevault.operators import hierarchy, joins, quality
from tradevault.plans import bridges, derived, dims, risk
from tradevault.sources import seeds

DBL = "CAST({0} AS DOUBLE)"

# ---- joins and set operations ------------------------------------------------------------------------------------------


@query("J8_orphans", s.with_stage("lines_s", """
SELECT DISTINCT order_id FROM lines_s WHERE order_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"""))
def j8(spark, d):
    parent = s.table(spark, d, "orders").filter("o_orderstatus <> 'P'")
    return joins.orphans(s.lines(spark, d), parent, {"order_id": "o_orderkey"})


@query("J9_uncovered_parents", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""")
def j9(spark, d):
    child = s.table(spark, d, "orders").filter("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey")
    return joins.uncovered(s.table(spark, d, "customer").select("c_custkey", "c_name"), child, ["c_custkey"])


@query("J10_attach_counts", """
SELECT c_custkey, COUNT(o_orderkey) AS order_count FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_custkey""")
def j10(spark, d):
    child = s.table(spark, d, "orders").filter("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey")
    return joins.attach_counts(s.table(spark, d, "customer").select("c_custkey"), child, ["c_custkey"], "order_count")


@query("A1_child_counts", """SELECT l_orderkey AS order_id, COUNT(*) AS n FROM lineitem GROUP BY 1""")
def a1(spark, d):
    return derived.count_per(s.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id")), ["order_id"])


@query("A2_exists_flag", """
SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS has_return FROM orders""")
def a2(spark, d):
    child = s.table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.exists_flag(s.table(spark, d, "orders").select("o_orderkey"), child, ["o_orderkey"], "has_return", "l_returnflag = 'R'")


@query("A5_duplicate_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""")
def a5(spark, d):
    return quality.duplicates(s.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("A6_count_band", """SELECT COUNT(*) AS n, CASE WHEN COUNT(*) BETWEEN 20 AND 30 THEN 'PASS' ELSE 'FAIL' END AS outcome FROM nation""")
def a6(spark, d):
    return quality.count_band(s.table(spark, d, "nation"), 20, 30)


@query("A6_freshness", """SELECT CAST(MAX(CAST(ts AS DATE)) AS VARCHAR) AS last_seen, CASE WHEN MAX(CAST(ts AS DATE)) >= DATE '2024-02-03' - 7 THEN 'PASS' ELSE 'FAIL' END AS outcome FROM events""")
def a6b(spark, d):
    return quality.freshness(s.table(spark, d, "events"), "ts", "2024-02-03", 7)


@query("A7_participation", """
WITH t AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS yr, SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS filled,
  SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent FROM orders GROUP BY 1)
SELECT yr, CAST(filled AS BIGINT) AS filled, CAST(urgent AS BIGINT) AS urgent, CAST(lag(filled) OVER (ORDER BY yr) AS BIGINT) AS prior_filled,
  CAST(lag(urgent) OVER (ORDER BY yr) AS BIGINT) AS prior_urgent FROM t""")
def a7(spark, d):
    o = s.table(spark, d, "orders").select(
        F.year("o_orderdate").alias("yr"), (F.col("o_orderstatus") == "F").alias("filled"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent")
    )
    return derived.participation(o, ["filled", "urgent"], ["yr"])


@query("A8_daily_lifecycle", s.with_stage("fills", """
SELECT CAST(order_date AS VARCHAR) AS fact_date, party_id, instrument_id, venue_id, COUNT(DISTINCT order_id) AS order_count,
  COUNT(DISTINCT CASE WHEN order_status = 'FILLED' THEN order_id END) AS executed_order_count, COUNT(*) AS execution_count,
  CAST(coalesce(SUM(amount) FILTER (side = 'BUY'), 0) AS DOUBLE) AS buy_notional, CAST(coalesce(SUM(amount) FILTER (side = 'SELL'), 0) AS DOUBLE) AS sell_notional,
  CAST(SUM(amount) AS DOUBLE) AS total_notional, CAST(SUM(price) AS DOUBLE) / COUNT(*) AS avg_fill_price,
  CAST(SUM(amount) AS DOUBLE) / CAST(SUM(quantity) AS DOUBLE) AS vwap, COUNT(*) FILTER (settlement_status = 'FAILED') AS settlement_fail_count
FROM fills GROUP BY order_date, party_id, instrument_id, venue_id"""))
def a8(spark, d):
    f = s.fills(spark, d).withColumnRenamed("order_date", "fact_date")
    return derived.daily_lifecycle(f).drop("cancelled_order_count", "rejected_order_count")


@query("A9_party_instrument_activity", s.with_stage("fills", f"""
SELECT party_id, instrument_id, CAST(order_date AS VARCHAR) AS activity_date, strftime(MIN(order_ts), '%Y-%m-%d %H:%M:%S.%f') AS first_order_timestamp,
  strftime(MAX(fill_ts), '%Y-%m-%d %H:%M:%S.%f') AS last_execution_timestamp, COUNT(DISTINCT order_id) AS order_count, COUNT(*) AS execution_count,
  CAST(SUM(CASE WHEN side = 'BUY' THEN quantity ELSE 0 END) AS DOUBLE) AS buy_quantity, CAST(SUM(CASE WHEN side = 'SELL' THEN quantity ELSE 0 END) AS DOUBLE) AS sell_quantity,
  CAST(SUM(amount) AS DOUBLE) AS notional FROM fills GROUP BY party_id, instrument_id, order_date"""))
def a9(spark, d):
    return derived.party_instrument_activity(s.fills(spark, d))


def venue_rows(spark, d):
    f = s.fills(spark, d)
    return f.withColumns(
        {
            "order_quantity": F.col("quantity") + F.col("line_no"),
            "improvement_bps": F.col("discount") * 10000, "spread_bps": F.col("tax") * 100,
            "latency_ms": F.col("venue_id") % 1000,
        }
    )


@query("A10_venue_quality_hourly", s.with_stage("fills", """
SELECT strftime(date_trunc('hour', fill_ts), '%Y-%m-%d %H:%M:%S.%f') AS hour_ts, venue_id, instrument_id, CAST(SUM(quantity) AS DOUBLE) AS executed_qty,
  round(CAST(SUM(quantity) AS DOUBLE) / CAST(SUM(quantity + line_no) AS DOUBLE), 9) AS fill_rate,
  round(CAST(SUM(discount * 10000) AS DOUBLE) / COUNT(*), 9) AS price_improvement_bps_avg, round(CAST(SUM(tax * 100) AS DOUBLE) / COUNT(*), 9) AS effective_spread_bps_avg,
  round(CAST(SUM(venue_id % 1000) AS DOUBLE) / COUNT(*), 9) AS avg_latency_ms FROM fills GROUP BY date_trunc('hour', fill_ts), venue_id, instrument_id"""))
def a10(spark, d):
    out = derived.venue_quality_hourly(venue_rows(spark, d))
    r = ["fill_rate", "price_improvement_bps_avg", "effective_spread_bps_avg", "avg_latency_ms"]
    return out.withColumns({c: F.round(c, 9) for c in r})


@query("A10_venue_score", s.with_stage("fills", """
SELECT venue_id, round(least(1.0, CAST(SUM(quantity) AS DOUBLE) / CAST(SUM(quantity + line_no) AS DOUBLE)) * 50
  + greatest(0.0, 1 - (CAST(SUM(tax * 100) AS DOUBLE) / COUNT(*)) / 100) * 30 + greatest(0.0, 1 - (CAST(SUM(venue_id % 1000) AS DOUBLE) / COUNT(*)) / 1000) * 20, 6) AS venue_quality_score
FROM fills GROUP BY venue_id"""))
def a10b(spark, d):
    out = venue_rows(spark, d).groupBy("venue_id").agg(*derived.venue_quality_aggregates())
    return derived.venue_score(out).select("venue_id", F.round("venue_quality_score", 6).alias("venue_quality_score"))


@query("A11_event_coverage", s.with_stage("order_events", """
SELECT CAST(event_date AS VARCHAR) AS event_date, party_id % 5 AS reporter, cat_event_code, COUNT(*) AS event_count, COUNT(*) FILTER (instrument_id % 10 <> 0) AS reported_count,
  COUNT(*) FILTER (instrument_id % 10 = 1) AS late_count, COUNT(*) FILTER (instrument_id % 10 = 2) AS rejected_count, COUNT(*) FILTER (instrument_id % 10 = 3) AS corrected_count,
  CAST(COUNT(*) FILTER (instrument_id % 10 <> 0) AS DOUBLE) / COUNT(*) AS coverage_pct FROM order_events GROUP BY event_date, party_id % 5, cat_event_code"""))
def a11(spark, d):
    k = F.col("instrument_id") % 10
    ev = s.order_events(spark, d).withColumns(
        {"reporter": F.col("party_id") % 5, "reported": k != 0, "late": k == 1, "rejected": k == 2, "corrected": k == 3}
    )
    return derived.event_coverage(ev, ["event_date", "reporter", "cat_event_code"])


@query("A11_uncovered_codes", s.with_stage("order_events", """
SELECT t.cat_event_code FROM (VALUES """ + ", ".join(f"('{r[2]}')" for r in seeds.read_config("event_types")[1]) + """) t(cat_event_code)
WHERE cat_event_code NOT IN (SELECT cat_event_code FROM order_events)"""))
def a11b(spark, d):
    return derived.uncovered_codes(dims.dim_event_type(spark), s.order_events(spark, d)).select("cat_event_code")


def exposure_trades(spark, d):
    return s.fills(spark, d).select("party_id", (F.col("venue_id") % 10).alias("counterparty_id"), F.col("settle_date").alias("exposure_date"), "side", "amount")


@query("A12_exposure_sketches", s.with_stage("fills", """
WITH dly AS (SELECT party_id, venue_id % 10 AS counterparty_id, settle_date, CAST(greatest(0, SUM(CASE WHEN side = 'BUY' THEN amount ELSE -amount END)) AS DOUBLE) AS net FROM fills GROUP BY 1, 2, 3),
x AS (SELECT party_id, counterparty_id, COUNT(*) AS days, list_sort(list(net)) AS v FROM dly GROUP BY 1, 2)
SELECT party_id, counterparty_id, days, v[CAST(ceil(days * 0.05) AS INT)] AS ee_5pct, v[CAST(ceil(days * 0.95) AS INT)] AS ee_95pct, v[days] AS pfe FROM x"""))
def a12b(spark, d):
    """Two feeds by month, sketched apart and merged; a pair has fewer days than a sketch keeps, so its quantiles are exact."""
    trades = exposure_trades(spark, d)
    odd = F.month("exposure_date") % 2 == 1
    parts = [risk.exposure_sketches(trades.filter(odd)), risk.exposure_sketches(trades.filter(~odd))]
    return risk.sketched_exposure(risk.merged_sketches(parts[0].unionByName(parts[1])))


@query("A12_counterparty_exposure", s.with_stage("fills", """
WITH dly AS (SELECT party_id, venue_id % 10 AS counterparty_id, settle_date, SUM(amount) AS gross, SUM(CASE WHEN side = 'BUY' THEN amount ELSE -amount END) AS net FROM fills GROUP BY 1, 2, 3),
e AS (SELECT party_id, counterparty_id, SUM(gross) AS gross_exposure, greatest(0, SUM(net)) AS net_exposure, quantile_cont(CAST(greatest(0, net) AS DOUBLE), 0.05) AS p5,
  quantile_cont(CAST(greatest(0, net) AS DOUBLE), 0.95) AS p95, MAX(CAST(greatest(0, net) AS DOUBLE)) AS pfe FROM dly GROUP BY 1, 2),
c AS (SELECT party_id, venue_id % 10 AS counterparty_id, SUM(quantity * 100) AS received, SUM(CAST(line_no AS DECIMAL(18,4))) AS posted FROM fills WHERE line_no < 3 GROUP BY 1, 2)
SELECT party_id, counterparty_id, CAST(gross_exposure AS DOUBLE) AS gross_exposure, CAST(net_exposure AS DOUBLE) AS net_exposure, round(p5, 4) AS ee_5pct, round(p95, 4) AS ee_95pct,
  round(pfe, 4) AS pfe, CAST(greatest(0, net_exposure - coalesce(received, 0) + coalesce(posted, 0)) AS DOUBLE) AS unsecured_exposure
FROM e LEFT JOIN c USING (party_id, counterparty_id)"""))
def a12(spark, d):
    col = s.fills(spark, d).filter("line_no < 3").select(
        "party_id", (F.col("venue_id") % 10).alias("counterparty_id"), (F.col("quantity") * 100).alias("collateral_received"),
        F.col("line_no").cast("decimal(18,4)").alias("collateral_posted"),
    )
    out = risk.counterparty_exposure(exposure_trades(spark, d), col)
    return out.select(
        "party_id", "counterparty_id", "gross_exposure", "net_exposure", F.round("ee_5pct", 4).alias("ee_5pct"),
        F.round("ee_95pct", 4).alias("ee_95pct"), F.round("pfe", 4).alias("pfe"), "unsecured_exposure",
    )


@query("A13_net_settlement", s.with_stage("fills", """
SELECT party_id, instrument_id, CAST(settle_date AS VARCHAR) AS settle_date, CAST(SUM(CASE WHEN side = 'BUY' THEN -quantity ELSE quantity END) AS DOUBLE) AS net_quantity,
  CAST(SUM(CASE WHEN side = 'BUY' THEN amount ELSE -amount END) AS DOUBLE) AS net_amount, COUNT(*) AS gross_obligations FROM fills GROUP BY party_id, instrument_id, settle_date"""))
def a13(spark, d):
    return risk.net_settlement(s.fills(spark, d))


@query("A14_positions", s.with_stage("fills", """
WITH h AS (SELECT party_id, instrument_id, SUM(CASE WHEN side = 'BUY' THEN quantity ELSE 0 END) AS ql, SUM(CASE WHEN side = 'SELL' THEN quantity ELSE 0 END) AS qs,
  CAST(SUM(amount) FILTER (side = 'BUY') AS DOUBLE) / CAST(SUM(quantity) FILTER (side = 'BUY') AS DOUBLE) AS ac FROM fills WHERE CAST(fill_ts AS DATE) <= DATE '1999-12-31' GROUP BY 1, 2),
p AS (SELECT instrument_id, price FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY fill_ts DESC, fill_id DESC) rn FROM fills WHERE CAST(fill_ts AS DATE) <= DATE '1999-12-31') WHERE rn = 1)
SELECT party_id, instrument_id, CAST(ql AS DOUBLE) AS quantity_long, CAST(qs AS DOUBLE) AS quantity_short, CAST(ql - qs AS DOUBLE) AS net_quantity, ac AS average_cost,
  CAST(ql - qs AS DOUBLE) * CAST(price AS DOUBLE) AS market_value, (CAST(price AS DOUBLE) - ac) * CAST(ql - qs AS DOUBLE) AS unrealized_pnl
FROM h LEFT JOIN p USING (instrument_id)"""))
def a14(spark, d):
    f = s.fills(spark, d)
    px = f.select("instrument_id", F.col("fill_ts").alias("price_ts"), F.col("fill_id").alias("price_id"), "price")
    return risk.positions(f, px, "1999-12-31").drop("market_price")


@query("A15_routing_summary", s.with_stage("fills", """
SELECT venue_id, order_type, COUNT(*) AS routes, CAST(SUM(quantity) AS DOUBLE) AS quantity, CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER (PARTITION BY order_type) AS DOUBLE) AS route_share
FROM fills GROUP BY venue_id, order_type"""))
def a15(spark, d):
    return derived.routing_summary(s.fills(spark, d))


@query("A16_concentration", s.with_stage("fills", """
WITH x AS (SELECT party_id, venue_id, SUM(quantity) AS x FROM fills GROUP BY 1, 2)
SELECT party_id, COUNT(*) AS counterparties, round(CAST(SUM(x * x) AS DOUBLE) / (CAST(SUM(x) AS DOUBLE) * CAST(SUM(x) AS DOUBLE)), 9) AS concentration_score FROM
 (SELECT party_id, CAST(x AS DECIMAL(18,4)) AS x FROM x) GROUP BY party_id"""))
def a16(spark, d):
    out = derived.concentration(s.fills(spark, d), "party_id", "venue_id", "quantity")
    return out.withColumn("concentration_score", F.round("concentration_score", 9))


@query("A17_fail_rate", s.with_stage("fills", """
SELECT venue_id, order_type, COUNT(*) AS settlements, COUNT(*) FILTER (settlement_status = 'FAILED') AS fails, CAST(COUNT(*) FILTER (settlement_status = 'FAILED') AS DOUBLE) / COUNT(*) AS fail_probability,
  round(CAST(coalesce(SUM(amount) FILTER (settlement_status = 'FAILED'), 0) AS DOUBLE) * 0.0001, 6) AS expected_penalty FROM fills GROUP BY venue_id, order_type"""))
def a17(spark, d):
    out = derived.fail_rate(s.fills(spark, d), ["venue_id", "order_type"])
    return out.withColumn("expected_penalty", F.round("expected_penalty", 6))


@query("A18_coverage_depth", """
WITH m AS (SELECT unnest(string_split(CASE WHEN user_id % 2 = 0 THEN 'click,view' ELSE event_type END, ',')) AS c FROM events),
codes AS (SELECT DISTINCT event_type AS c FROM events UNION SELECT 'none'),
n AS (SELECT codes.c, COUNT(m.c) AS k FROM codes LEFT JOIN m ON codes.c = m.c GROUP BY 1)
SELECT k AS mapping_rows, COUNT(*) AS codes FROM n GROUP BY 1""")
def a18(spark, d):
    ev = s.table(spark, d, "events")
    mapping = ev.select(F.when(F.col("user_id") % 2 == 0, "click, view").otherwise(F.col("event_type")).alias("event_codes"))
    codes = ev.select(F.col("event_type").alias("cat_event_code")).distinct().unionByName(spark.range(1).select(F.lit("none").alias("cat_event_code")))
    return derived.coverage_depth(mapping, codes)


@query("J16_reconcile", s.with_stage("fills", """
WITH i AS (SELECT party_id, instrument_id, SUM(quantity) AS v FROM fills WHERE line_no <> 7 GROUP BY 1, 2),
e AS (SELECT party_id, instrument_id, SUM(quantity + CASE WHEN venue_id % 50 = 0 THEN 1 ELSE 0 END) AS v FROM fills WHERE line_no <> 1 GROUP BY 1, 2)
SELECT party_id, instrument_id, CAST(i.v AS DOUBLE) AS internal_value, CAST(e.v AS DOUBLE) AS external_value, CAST(coalesce(e.v, 0) - coalesce(i.v, 0) AS DOUBLE) AS break_value,
  CASE WHEN i.v IS NULL THEN 'EXTERNAL_ONLY' WHEN e.v IS NULL THEN 'INTERNAL_ONLY' WHEN e.v = i.v THEN 'MATCHED' ELSE 'BROKEN' END AS reconciliation_status
FROM i FULL JOIN e USING (party_id, instrument_id)"""))
def j16(spark, d):
    f = s.fills(spark, d).select("party_id", "instrument_id", "quantity", "line_no", "venue_id")
    ext = f.filter("line_no <> 1").withColumn("quantity", F.col("quantity") + F.when(F.col("venue_id") % 50 == 0, 1).otherwise(0))
    return joins.reconcile(f.filter("line_no <> 7"), ext, ["party_id", "instrument_id"], "quantity")


# ---- hierarchies -----------------------------------------------------------------------------------------------------


def ownership_edges(spark, d):
    c = s.table(spark, d, "customer").filter("c_custkey > 0")
    second = (F.col("c_acctbal") < 0) & (F.floor(F.col("c_custkey") / 5) != F.floor(F.col("c_custkey") / 3))
    a = c.select(F.floor(F.col("c_custkey") / 3).alias("owner"), F.col("c_custkey").alias("owned"), F.when(second, 0.5).otherwise(1.0).alias("pct"))
    b = c.filter(second).select(F.floor(F.col("c_custkey") / 5).alias("owner"), F.col("c_custkey").alias("owned"), F.lit(0.5).alias("pct"))
    return a.unionByName(b)


@query("J13_ownership_chains", """
WITH RECURSIVE c AS (SELECT *, c_acctbal < 0 AND c_custkey // 5 <> c_custkey // 3 AS two FROM customer WHERE c_custkey > 0),
e AS (SELECT c_custkey // 3 AS owner, c_custkey AS owned, CASE WHEN two THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS pct FROM c
  UNION ALL SELECT c_custkey // 5, c_custkey, 0.5::DOUBLE FROM c WHERE two),
w AS (SELECT owned AS party, owner, pct, 1 AS depth, owned || '/' || owner AS path FROM e
  UNION ALL SELECT w.party, e.owner, w.pct * e.pct, w.depth + 1, w.path || '/' || e.owner FROM w JOIN e ON w.owner = e.owned)
SELECT party, owner AS ultimate_owner, pct AS effective_pct, CAST(depth AS BIGINT) AS chain_depth, path FROM w WHERE owner NOT IN (SELECT owned FROM e)""")
def j13(spark, d):
    out = hierarchy.ownership_chains(ownership_edges(spark, d))
    return out.withColumn("path", F.array_join(F.col("path").cast("array<string>"), "/"))


def cross_held_edges(spark, d):
    """The ownership edges, and every tenth customer also holds a twentieth of its parent, whose other owners hold the rest."""
    held = s.table(spark, d, "customer").filter("c_custkey % 10 = 4 AND c_custkey >= 3")
    back = held.select(F.col("c_custkey").alias("owner"), F.floor(F.col("c_custkey") / 3).alias("owned"), F.lit(0.05).alias("pct"))
    rest = ownership_edges(spark, d).join(back.select("owned", F.lit(0.95).alias("left")), "owned", "left")
    return rest.select("owner", "owned", (F.col("pct") * F.coalesce("left", F.lit(1.0))).alias("pct")).unionByName(back)


LEVELS = 48  # longer walks go to and fro over cross holdings and carry less than 1e-15
J13_SQL = """
WITH c AS (SELECT *, c_acctbal < 0 AND c_custkey // 5 <> c_custkey // 3 AS two FROM customer WHERE c_custkey > 0),
back AS (SELECT c_custkey AS owner, c_custkey // 3 AS owned, 0.05::DOUBLE AS pct FROM customer WHERE c_custkey % 10 = 4 AND c_custkey >= 3),
one AS (SELECT c_custkey // 3 AS owner, c_custkey AS owned, CASE WHEN two THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS pct FROM c
  UNION ALL SELECT c_custkey // 5, c_custkey, 0.5::DOUBLE FROM c WHERE two),
e AS (SELECT owner, owned, SUM(pct) AS pct FROM (SELECT owner, owned, pct * CASE WHEN owned IN (SELECT owned FROM back) THEN 0.95::DOUBLE ELSE 1 END AS pct FROM one UNION ALL SELECT * FROM back) GROUP BY 1, 2),
x0 AS (SELECT DISTINCT owner AS party, owner AS top, 1.0::DOUBLE AS w FROM e WHERE owner NOT IN (SELECT owned FROM e)),
""" + ",\n".join(f"x{k + 1} AS MATERIALIZED (SELECT owned AS party, top, SUM(w * pct) AS w FROM x{k} JOIN e ON owner = party GROUP BY 1, 2)" for k in range(LEVELS)) + """
SELECT party, top AS ultimate_owner, round(SUM(w), 9) AS effective_pct, MIN(k) AS chain_depth FROM (
""" + " UNION ALL ".join(f"SELECT *, {k} AS k FROM x{k}" for k in range(1, LEVELS + 1)) + ") GROUP BY 1, 2"


@query("J13_effective_ownership", J13_SQL)
def j13b(spark, d):
    out = hierarchy.effective_ownership(cross_held_edges(spark, d))
    return out.select("party", "ultimate_owner", F.round("effective_pct", 9).alias("effective_pct"), "chain_depth")


@query("J14_hierarchy_path", """
SELECT 'R' || r_regionkey AS node, 1 AS depth, 'R' || r_regionkey AS path FROM region
UNION ALL SELECT 'N' || n_nationkey, 2, 'R' || n_regionkey || '/N' || n_nationkey FROM nation
UNION ALL SELECT 'C' || c_custkey, 3, 'R' || n_regionkey || '/N' || n_nationkey || '/C' || c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def j14(spark, d):
    def n(prefix, col):
        return F.concat(F.lit(prefix), F.col(col).cast("string"))

    nodes = (
        s.table(spark, d, "region").select(n("R", "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent"))
        .unionByName(s.table(spark, d, "nation").select(n("N", "n_nationkey").alias("node"), n("R", "n_regionkey").alias("parent")))
        .unionByName(s.table(spark, d, "customer").select(n("C", "c_custkey").alias("node"), n("N", "c_nationkey").alias("parent")))
    )
    return hierarchy.hierarchy_paths(nodes, "node", "parent")


# ---- windows ---------------------------------------------------------------------------------------------------------


@query("W2_monotonicity", s.with_stage("fills", """
SELECT fill_id, CAST(previous_value AS DOUBLE) AS previous_value, CAST(price AS DOUBLE) AS price FROM (SELECT *, lag(price) OVER (PARTITION BY instrument_id ORDER BY fill_ts, fill_id) AS previous_value FROM fills) WHERE price < previous_value"""))
def w2(spark, d):
    out = derived.monotonic_violations(s.fills(spark, d), ["instrument_id"], ["fill_ts", "fill_id"], "price")
    return out.select("fill_id", "previous_value", "price")


@query("W5_fill_progress", s.with_stage("fills", """
SELECT fill_id, row_number() OVER w AS fill_sequence, CAST(SUM(quantity) OVER w AS DOUBLE) AS cumulative_qty, CAST(q - SUM(quantity) OVER w AS DOUBLE) AS leaves_qty,
  CAST(quantity AS DOUBLE) / CAST(q AS DOUBLE) AS fill_contribution_pct FROM (SELECT *, SUM(quantity) OVER (PARTITION BY order_id) + 5 AS q FROM fills)
WINDOW w AS (PARTITION BY order_id ORDER BY fill_ts, fill_id ROWS UNBOUNDED PRECEDING)"""))
def w5(spark, d):
    f = s.fills(spark, d)
    q = s.lines(spark, d).groupBy("order_id").agg((F.sum("quantity") + 5).alias("order_quantity"))
    out = derived.fill_progress(f.join(q, "order_id"))
    return out.select("fill_id", "fill_sequence", "cumulative_qty", "leaves_qty", "fill_contribution_pct")


@query("W6_route_ordinal", s.with_stage("fills", """
SELECT fill_id, row_number() OVER (PARTITION BY venue_id ORDER BY fill_ts, fill_id) AS route_sequence FROM fills"""))
def w6(spark, d):
    return derived.ordinal(s.fills(spark, d), ["venue_id"], ["fill_ts", "fill_id"], "route_sequence").select("fill_id", "route_sequence")


@query("W7_allocation_share", s.with_stage("lines_s", """
SELECT fill_id, CAST(quantity AS DOUBLE) / CAST(SUM(quantity) OVER (PARTITION BY order_id) AS DOUBLE) AS allocation_pct FROM lines_s"""))
def w7(spark, d):
    return derived.allocation_pct(s.lines(spark, d), "order_id", "quantity").select("fill_id", "allocation_pct")


@query("W8_allocate", s.with_stage("fills", """
WITH ins AS (SELECT c_custkey AS party_id, c_custkey || '-' || slot AS account_id, CASE WHEN c_custkey % 4 = 1 THEN 1 WHEN c_custkey % 4 = 0 THEN (c_custkey % 7 + slot) * 100 ELSE c_custkey % 7 + slot END AS w
  FROM customer, (VALUES (1), (2), (3)) t(slot)),
j AS (SELECT fill_id, account_id, CAST(quantity AS BIGINT) AS u, w, SUM(w) OVER (PARTITION BY fill_id) AS tot FROM fills JOIN ins USING (party_id)),
k AS (SELECT *, u * w // tot AS base, u * w % tot AS rem FROM j),
r AS (SELECT *, row_number() OVER (PARTITION BY fill_id ORDER BY rem DESC, account_id) AS rk, u - SUM(base) OVER (PARTITION BY fill_id) AS lft FROM k)
SELECT fill_id, account_id, CAST(base + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS BIGINT) AS allocated_units FROM r"""))
def w8(spark, d):
    k = F.col("c_custkey")
    ins = s.table(spark, d, "customer").withColumn("slot", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).select(
        k.alias("party_id"), F.concat_ws("-", k, "slot").alias("account_id"),
        F.when(k % 4 == 0, "PCT_BASED").when(k % 4 == 1, "EQUAL").when(k % 4 == 2, "QTY_BASED").otherwise("PRO_RATA").alias("allocation_rule"),
        ((k % 7 + F.col("slot")) / F.lit(100)).alias("target_percentage"), (k % 7 + F.col("slot")).alias("target_quantity"),
    )
    f = s.fills(spark, d).select("fill_id", "party_id", F.col("quantity").cast("long").alias("units"))
    return derived.allocate(f, ins, "party_id").select("fill_id", "account_id", "allocated_units")


@query("W9_state_transitions", """
SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_state, event_type AS status FROM events""")
def w9(spark, d):
    ev = s.table(spark, d, "events").withColumnsRenamed({"event_type": "status"})
    return quality.state_transitions(ev, ["user_id"], ["ts", "event_id"]).select("event_id", "from_state", "status")


@query("W10_next_trading_day", """
WITH cal AS (SELECT CAST(range AS DATE) AS c FROM range(DATE '2024-01-01', DATE '2024-04-01', INTERVAL 1 DAY)),
tr AS (SELECT c, dayofweek(c) BETWEEN 1 AND 5 AND c NOT IN (DATE '2024-01-01', DATE '2024-01-15', DATE '2024-02-19', DATE '2024-03-29') AS t FROM cal)
SELECT event_id, CAST((SELECT c FROM tr WHERE t AND c > CAST(ts AS DATE) ORDER BY c LIMIT 1 OFFSET 1) AS VARCHAR) AS t_plus_2 FROM events""")
def w10(spark, d):
    ev = s.table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"))
    return dims.add_business_days(ev, "day", 2, dims.dim_date(spark), "t_plus_2").select("event_id", "t_plus_2")


@query("W12_break_aging", s.with_stage("fills", """
WITH dly AS (SELECT party_id, instrument_id, settle_date AS position_date, SUM(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) AS net_quantity FROM fills GROUP BY 1, 2, 3)
SELECT party_id, instrument_id, CAST(position_date AS VARCHAR) AS position_date, CAST(net_quantity AS DOUBLE) AS net_quantity,
  CAST(net_quantity - coalesce(lag(net_quantity) OVER (PARTITION BY party_id, instrument_id ORDER BY position_date), 0) AS DOUBLE) AS position_change,
  CAST(DATE '2001-12-31' - position_date AS BIGINT) AS aging_days FROM dly"""))
def w12(spark, d):
    from tradevault.functions.scalars import signed

    daily = s.fills(spark, d).groupBy("party_id", "instrument_id", F.col("settle_date").alias("position_date")).agg(F.sum(signed("side", "quantity")).alias("net_quantity"))
    return derived.break_aging(daily, ["party_id", "instrument_id"], "2001-12-31")


# ---- top-k and set operations ------------------------------------------------------------------------------------------


@query("O1_ordered_codes", """SELECT n_nationkey, n_name FROM nation WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_20') ORDER BY n_name""")
def o1(spark, d):
    n = s.table(spark, d, "nation").select("n_nationkey", "n_name")
    return n.filter(F.col("n_name").isin("NATION_1", "NATION_7", "NATION_20")).orderBy("n_name")


@query("O2_top_instruction", s.with_stage("lines_s", """
SELECT order_id, fill_id AS instruction_id, CAST(line_no AS BIGINT) AS priority_rank FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY line_no, fill_id) AS rn FROM lines_s) WHERE rn = 1"""))
def o2(spark, d):
    ins = s.lines(spark, d).select("order_id", F.col("fill_id").alias("instruction_id"), F.col("line_no").alias("priority_rank"))
    return derived.top_instruction(ins, ["order_id"])


@query("U2_distinct_keys", """SELECT DISTINCT l_partkey, l_suppkey FROM lineitem""")
def u2(spark, d):
    return s.table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("U3_code_diff", """
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT k, 'left' AS only_in FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'right' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def u3(spark, d):
    o = s.table(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    return joins.code_diff(o.filter("o_orderstatus = 'F'"), o.filter("o_orderpriority = '1-URGENT'"), "k")


# ---- bridges -----------------------------------------------------------------------------------------------------------


def hk(col, source):
    return hash_key([col], source)


@query("B1_trade_lifecycle", s.with_stage("fills", """
WITH x AS (SELECT sha256(o.order_id || '||oms') AS order_hk, sha256(o.party_id || '||kyc') AS party_hk, CASE WHEN fill_id IS NOT NULL THEN sha256(instrument_id || '||sec') END AS instrument_hk,
  CASE WHEN fill_id IS NOT NULL THEN sha256(fill_id || '||exe') END AS execution_hk, CASE WHEN side = 'BUY' THEN sha256(fill_id || '||all') END AS allocation_hk,
  CASE WHEN settlement_status = 'SETTLED' THEN sha256(fill_id || '||clr') END AS clearing_hk,
  CASE WHEN side = 'BUY' AND line_no < 5 THEN sha256(fill_id || '||cnf') END AS confirmation_hk,
  CASE WHEN side = 'BUY' AND line_no < 6 THEN sha256(fill_id || '||stl') END AS settlement_hk,
  CASE WHEN side = 'BUY' AND line_no < 6 THEN settlement_status END AS st, o.order_status FROM orders_s o LEFT JOIN lines_s l ON l.order_id = o.order_id)
SELECT sha256(concat_ws('||', '__N__', '__N__', order_hk, coalesce(execution_hk, '__N__'), coalesce(allocation_hk, '__N__'), coalesce(confirmation_hk, '__N__'), coalesce(clearing_hk, '__N__'),
  coalesce(settlement_hk, '__N__'), party_hk, coalesce(instrument_hk, '__N__'))) AS bridge_hk, order_hk, execution_hk, allocation_hk, clearing_hk, confirmation_hk, settlement_hk,
  CASE WHEN st = 'SETTLED' THEN 'SETTLED' WHEN st = 'FAILED' THEN 'FAILED' WHEN order_status = 'CANCELLED' THEN 'CANCELLED' ELSE 'IN_FLIGHT' END AS lifecycle_status FROM x"""))
def b1(spark, d):
    sources = {"order": "OMS", "party": "KYC", "instrument": "SEC", "execution": "EXE", "allocation": "ALL", "clearing": "CLR", "confirmation": "CNF", "settlement": "STL"}

    def of(col, entity):
        """The key of an entity before its hash: the hash of a hash tells as much as the shorter bytes it is made of."""
        return narrow(key_part(col)).alias(f"{entity}_hk")

    def link(*cols, where=None):
        lines = s.lines(spark, d)
        return (lines if where is None else lines.filter(where)).select(*cols)

    orders = s.orders(spark, d).select(of("order_id", "order"), of("party_id", "party"), "order_status")
    exe, alloc = of("fill_id", "execution"), of("fill_id", "allocation")
    links = {
        "execution": link(of("order_id", "order"), exe, of("instrument_id", "instrument")),
        "allocation": link(exe, alloc, where="side = 'BUY'"),
        "clearing": link(exe, of("fill_id", "clearing"), where="settlement_status = 'SETTLED'"),
        "confirmation": link(alloc, of("fill_id", "confirmation"), where="side = 'BUY' and line_no < 5"),
        "settlement": link(alloc, of("fill_id", "settlement"), "settlement_status", where="side = 'BUY' and line_no < 6"),
    }
    parent = {"execution": "order_hk", "allocation": "execution_hk", "clearing": "execution_hk", "confirmation": "allocation_hk", "settlement": "allocation_hk"}
    splits = {n: s.stored(spark, d, f"splits_{n}_{joins.TARGET_ROWS}", lambda sp, dd, n=n: joins.key_splits(links[n], parent[n], joins.TARGET_ROWS)) for n in links}
    splits = {n: () if large.isEmpty() else large for n, large in splits.items()}
    keys = {f"{entity}_hk": part_hash(widened(f"{entity}_hk"), source) for entity, source in sources.items()}
    return bridges.trade_lifecycle(orders, links, splits, keys).select(
        "bridge_hk", "order_hk", "execution_hk", "allocation_hk", "clearing_hk", "confirmation_hk", "settlement_hk", "lifecycle_status"
    )


@query("B2_order_to_execution", s.with_stage("fills", f"""
SELECT sha256(order_id || '||oms') AS order_hk, sha256(fill_id || '||exe') AS execution_hk, row_number() OVER w AS fill_sequence, CAST(SUM(quantity) OVER w AS DOUBLE) AS cumulative_fill_qty,
  sha256(sha256(order_id || '||oms') || '||' || sha256(fill_id || '||exe')) AS bridge_hk FROM fills WINDOW w AS (PARTITION BY order_id ORDER BY fill_ts, sha256(fill_id || '||exe') ROWS UNBOUNDED PRECEDING)"""))
def b2(spark, d):
    f = s.fills(spark, d)
    e = hk("fill_id", "EXE").alias("execution_hk")
    out = bridges.order_to_execution(
        f.select(hk("order_id", "OMS").alias("order_hk"), e), f.select(e, F.col("fill_ts").alias("execution_timestamp"), "quantity")
    )
    return out.select("order_hk", "execution_hk", "fill_sequence", "cumulative_fill_qty", "bridge_hk")


@query("B3_execution_to_allocation", s.with_stage("fills", """
SELECT order_id, fill_id, CAST(quantity AS DOUBLE) / CAST(SUM(quantity) OVER (PARTITION BY order_id) AS DOUBLE) AS allocation_pct,
  sha256(concat_ws('||', sha256(order_id || '||exe'), sha256(fill_id || '||all'), sha256(party_id || '||acc'))) AS bridge_hk FROM fills"""))
def b3(spark, d):
    f = s.fills(spark, d)
    # keys are hashed after the join, which moves their narrower parts
    a = key_part("fill_id").alias("allocation_hk")
    out = bridges.execution_to_allocation(
        f.select(key_part("order_id").alias("execution_hk"), a, "order_id"),
        f.select(a, key_part("party_id").alias("account_hk"), F.col("quantity").alias("allocated_quantity"), "fill_id"),
        {f"{stage}_hk": part_hash(F.col(f"{stage}_hk"), source) for stage, source in (("execution", "EXE"), ("allocation", "ALL"), ("account", "ACC"))},
    )
    return out.select("order_id", "fill_id", "allocation_pct", "bridge_hk")


@query("B4_allocation_to_settlement", s.with_stage("fills", """
WITH x AS (SELECT sha256(fill_id || '||all') AS a, CASE WHEN line_no < 6 THEN sha256(fill_id || '||clr') END AS c, CASE WHEN settlement_status = 'SETTLED' THEN sha256(fill_id || '||stl') END AS t, * FROM fills)
SELECT a AS allocation_hk, c AS clearing_hk, t AS settlement_hk, CAST(order_date + 2 AS VARCHAR) AS contractual_settle_date, CASE WHEN t IS NOT NULL THEN CAST(settle_date AS VARCHAR) END AS actual_settle_date,
  CASE WHEN t IS NOT NULL THEN CAST(settle_date - (order_date + 2) AS BIGINT) END AS settle_delay_days, sha256(concat_ws('||', a, coalesce(c, '__N__'), coalesce(t, '__N__'))) AS bridge_hk FROM x"""))
def b4(spark, d):
    f, a = s.fills(spark, d), hk("fill_id", "ALL").alias("allocation_hk")
    lines = s.lines(spark, d)
    out = bridges.allocation_to_settlement(
        f.select(a, F.date_add("order_date", 2).alias("contractual_settle_date")),
        lines.filter("line_no < 6").select(a, hk("fill_id", "CLR").alias("clearing_hk")),
        lines.filter("settlement_status = 'SETTLED'").select(a, hk("fill_id", "STL").alias("settlement_hk"), F.col("settle_date").alias("actual_settle_date")),
    )
    return out.select("allocation_hk", "clearing_hk", "settlement_hk", "contractual_settle_date", "actual_settle_date", "settle_delay_days", "bridge_hk")


@query("B6_quote_rfq_response", s.with_stage("quotes", """
SELECT quote_id, instrument_id, row_number() OVER (PARTITION BY instrument_id ORDER BY quote_ts, quote_id) AS response_sequence,
  CAST(bid_price AS DOUBLE) AS bid_price, sha256(concat_ws('||', sha256(instrument_id || '||rfq'), quote_id, sha256(venue_id || '||kyc'))) AS bridge_hk FROM quotes"""))
def b6(spark, d):
    q = s.quotes(spark, d)
    req = s.table(spark, d, "part").select(hk("p_partkey", "RFQ").alias("quote_request_hk"), F.col("p_partkey").alias("instrument_id"))
    rsp = q.select(
        hk("instrument_id", "RFQ").alias("quote_request_hk"), F.col("quote_id").alias("quote_hk"), hk("venue_id", "KYC").alias("responding_party_hk"),
        F.col("quote_ts").alias("response_timestamp"), "bid_price", "ask_price",
    )
    out = bridges.quote_rfq_response(req, rsp)
    return out.select(F.col("quote_hk").alias("quote_id"), "instrument_id", "response_sequence", "bid_price", "bridge_hk")


@query("B7_party_agreement_netting", s.with_stage("orders_s", """
WITH t AS (SELECT DISTINCT party_id, party_id % 10 AS cp, order_date, order_type FROM orders_s)
SELECT party_id, cp AS counterparty_id, CAST(order_date AS VARCHAR) AS effective_start, CAST(lead(order_date) OVER (PARTITION BY party_id, cp, order_type ORDER BY order_date) AS VARCHAR) AS effective_end,
  order_type AS netting_set_id, sha256(concat_ws('||', sha256(party_id || '||kyc'), sha256(cp || '||kyc'), sha256(party_id || '||leg'), order_type)) AS bridge_hk FROM t"""))
def b7(spark, d):
    o = s.orders(spark, d)
    cp = F.col("party_id") % 10
    agreements = o.select("party_id", cp.alias("counterparty_id")).distinct().select(
        "party_id", "counterparty_id", hk("party_id", "KYC").alias("party_hk"), hk("counterparty_id", "KYC").alias("counterparty_hk"), hk("party_id", "LEG").alias("agreement_hk")
    )
    terms = o.select(hk("party_id", "LEG").alias("agreement_hk"), F.col("order_type").alias("netting_set_id"), F.col("order_date").alias("effective_start")).distinct()
    return bridges.party_agreement_netting(agreements, terms).select(
        "party_id", "counterparty_id", "effective_start", "effective_end", "netting_set_id", "bridge_hk"
    )


@query("B8_order_routing_chain", s.with_stage("fills", """
SELECT fill_id AS route_id, row_number() OVER (PARTITION BY order_id ORDER BY fill_ts, sha256(venue_id || '||ven'), fill_id) AS route_sequence,
  CASE WHEN order_id % 2 = 1 THEN sha256((order_id - 1) || '||oms') END AS parent_order_hk,
  sha256(concat_ws('||', sha256(order_id || '||oms'), sha256(venue_id || '||ven'), fill_id)) AS bridge_hk FROM fills"""))
def b8(spark, d):
    f = s.fills(spark, d)
    routes = f.select(
        hk("order_id", "OMS").alias("order_hk"), hk("venue_id", "VEN").alias("destination_venue_hk"), F.col("fill_id").alias("route_id"),
        F.col("fill_ts").alias("route_timestamp"),
    )
    parents = s.orders(spark, d).filter("order_id % 2 = 1").withColumn("p", F.col("order_id") - 1).select(
        hk("order_id", "OMS").alias("order_hk"), hk("p", "OMS").alias("parent_order_hk")
    )
    return bridges.order_routing_chain(routes, parents).select("route_id", "route_sequence", "parent_order_hk", "bridge_hk")


# ---- derived links and satellites ----------------------------------------------------------------------------------------


def limit_px():
    return (F.col("price") + (F.col("line_no") - 4).cast("decimal(18,8)") / 4).cast("decimal(18,8)")



@query("B9_best_execution", s.with_stage("fills quotes", """
WITH q AS (SELECT instrument_id, quote_ts, quote_id, CAST((bid_price + ask_price) AS DOUBLE) / 2 AS mid FROM quotes),
f AS (SELECT *, CAST(price + (line_no - 4) * 0.25 AS DECIMAL(18,8)) AS lim, CASE WHEN side = 'BUY' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sg FROM fills),
a AS (SELECT f.*, qa.mid AS arr FROM f ASOF LEFT JOIN (SELECT instrument_id, quote_ts, max_by(mid, quote_id) AS mid FROM q GROUP BY 1, 2) qa ON f.instrument_id = qa.instrument_id AND f.order_ts >= qa.quote_ts),
b AS (SELECT a.*, qb.mid AS post FROM a ASOF LEFT JOIN (SELECT instrument_id, quote_ts, max_by(mid, quote_id) AS mid FROM q GROUP BY 1, 2) qb ON a.instrument_id = qb.instrument_id AND a.fill_ts <= qb.quote_ts),
dy AS (SELECT instrument_id, CAST(fill_ts AS DATE) AS dd, CAST(SUM(amount) AS DOUBLE) / CAST(SUM(quantity) AS DOUBLE) AS vw, CAST(SUM(price) AS DOUBLE) / COUNT(*) AS tw FROM fills GROUP BY 1, 2)
SELECT fill_id, arr AS arrival_price, vw AS vwap_benchmark, tw AS twap_benchmark, sg * (CAST(price AS DOUBLE) - arr) / arr * 10000.0::DOUBLE AS implementation_shortfall_bps,
  sg * (CAST(lim AS DOUBLE) - CAST(price AS DOUBLE)) / CAST(lim AS DOUBLE) * 10000.0::DOUBLE AS price_improvement_bps, 2.0::DOUBLE * abs(CAST(price AS DOUBLE) - arr) / arr * 10000.0::DOUBLE AS effective_spread_bps,
  2.0::DOUBLE * sg * (CAST(price AS DOUBLE) - post) / arr * 10000.0::DOUBLE AS realized_spread_bps
FROM b JOIN dy ON b.instrument_id = dy.instrument_id AND CAST(b.fill_ts AS DATE) = dy.dd"""))
def b9(spark, d):
    out = derived.best_execution(s.fills(spark, d).withColumn("limit_price", limit_px()), s.quotes(spark, d))
    return out.select(
        "fill_id", "arrival_price", "vwap_benchmark", "twap_benchmark", "implementation_shortfall_bps", "price_improvement_bps",
        "effective_spread_bps", "realized_spread_bps",
    )


@query("B10_execution_latency", s.with_stage("fills", """
WITH x AS (SELECT fill_id, epoch_us(order_ts) AS o, epoch_us(order_ts) + (venue_id % 97) * 1000 AS r, epoch_us(order_ts) + (venue_id % 97) * 1000 + line_no * 1500 AS k, epoch_us(fill_ts) AS f FROM fills)
SELECT fill_id, (r - o) // 1000 AS order_to_route_ms, (k - r) // 1000 AS route_to_ack_ms, (f - k) // 1000 AS ack_to_exec_ms, (f - o) // 1000 AS total_order_life_ms, (r - o) // 1000 > 50 AS clock_sync_breach,
  CASE WHEN f - o < 1000 THEN 'SUB_MS' WHEN (f - o) // 1000 < 10 THEN 'LOW' WHEN (f - o) // 1000 < 1000 THEN 'MED' WHEN (f - o) // 1000 < 60000 THEN 'HIGH' ELSE 'OUTLIER' END AS latency_bucket FROM x"""))
def b10(spark, d):
    f = s.fills(spark, d).withColumn("route_ts", s.plus_micros("order_ts", (F.col("venue_id") % 97) * 1000))
    f = f.withColumn("ack_ts", s.plus_micros("route_ts", F.col("line_no").cast("long") * 1500))
    return derived.execution_latency(f).select(
        "fill_id", "order_to_route_ms", "route_to_ack_ms", "ack_to_exec_ms", "total_order_life_ms", "clock_sync_breach", "latency_bucket"
    )


@query("B11_confirmation_sla", s.with_stage("fills", """
WITH x AS (SELECT fill_id, fill_ts AS t, CASE WHEN return_flag <> 'A' THEN make_timestamp(epoch_us(fill_ts) + (instrument_id % 2000) * 60000000) END AS a FROM fills)
SELECT fill_id, coalesce(CAST(t AS DATE) = CAST(a AS DATE), false) AS same_day_affirm_flag, (epoch_us(a) - epoch_us(t)) // 60000000 AS time_to_affirm_minutes,
  CASE WHEN a IS NULL THEN 'NONE' WHEN (epoch_us(a) - epoch_us(t)) // 60000000 <= 60 THEN 'HOUR' WHEN (epoch_us(a) - epoch_us(t)) // 60000000 <= 480 THEN 'DAY' ELSE 'LATE' END AS affirm_latency_bucket,
  a IS NULL AS dk_risk_flag FROM x"""))
def b11(spark, d):
    f = s.fills(spark, d).withColumn("affirm_ts", F.when(F.col("return_flag") != "A", s.plus_micros("fill_ts", (F.col("instrument_id") % 2000) * s.MINUTE)))
    return derived.confirmation_sla(f, "fill_ts").select("fill_id", "same_day_affirm_flag", "time_to_affirm_minutes", "affirm_latency_bucket", "dk_risk_flag")


@query("J12_derived_order_link", s.with_stage("fills", """
WITH e AS (SELECT fill_id, party_id, CASE WHEN line_no <= 3 THEN order_date ELSE order_date + 400 * line_no END AS trade_date, fill_ts FROM fills),
k AS (SELECT party_id, order_date, MIN(order_id) AS order_id FROM orders_s GROUP BY 1, 2),
x AS (SELECT e.*, k.order_id FROM e LEFT JOIN k ON e.party_id = k.party_id AND e.trade_date = k.order_date),
ob AS (SELECT party_id, order_ts, MAX(order_id) AS order_id FROM orders_s GROUP BY 1, 2),
b AS (SELECT x.fill_id, x.party_id, x.fill_ts, ob.order_id AS bi, epoch_us(x.fill_ts) - epoch_us(ob.order_ts) AS bg FROM x ASOF LEFT JOIN ob ON x.party_id = ob.party_id AND x.fill_ts >= ob.order_ts WHERE x.order_id IS NULL),
f AS (SELECT b.*, ob.order_id AS fi, epoch_us(ob.order_ts) - epoch_us(b.fill_ts) AS fg FROM b ASOF LEFT JOIN ob ON b.party_id = ob.party_id AND b.fill_ts <= ob.order_ts),
n AS (SELECT fill_id, CASE WHEN fg IS NULL OR bg <= fg THEN bi ELSE fi END AS order_id, CASE WHEN fg IS NULL OR bg <= fg THEN bg ELSE fg END AS gap FROM f)
SELECT fill_id, order_id, 'EXACT_KEY' AS derivation_rule, 1.0::DOUBLE AS confidence_score FROM x WHERE order_id IS NOT NULL
UNION ALL SELECT fill_id, order_id, 'TIMESTAMP_NEAREST', round(0.9 - 0.4 * gap / 600000000.0::DOUBLE, 6) FROM n WHERE gap <= 600000000"""))
def j12(spark, d):
    shift = F.when(F.col("line_no") <= 3, 0).otherwise(400 * F.col("line_no"))
    e = s.fills(spark, d).select("fill_id", "order_id", "party_id", F.date_add("order_date", shift.cast("int")).alias("trade_date"), "fill_ts")
    o = s.orders(spark, d).withColumn("trade_date", F.col("order_date"))
    out = derived.derive_order_link(e, o, ["party_id", "trade_date"], ["party_id"], 600)
    return out.withColumn("confidence_score", F.round("confidence_score", 6))


# ---- collateral, margin, corporate actions, accruals ---------------------------------------------------------------------


CATS = ["CASH", "UST_1_5Y", "CORP_IG", "EQUITY_DEVELOPED"]


def holdings(spark, d):
    cat = F.element_at(F.array(*[F.lit(c) for c in CATS]), (F.col("line_no") % 4 + 1).cast("int"))
    return s.lines(spark, d).select(
        "fill_id", (F.col("venue_id") % 20).cast("string").alias("collateral_agreement_id"), cat.alias("collateral_category"),
        F.col("amount").alias("market_value"), F.trunc("settle_date", "year").alias("valuation_date"),
    )


def haircuts(spark, d):
    # two windows per agreement and category, split at 1998-07-01
    h = holdings(spark, d).select("collateral_agreement_id", "collateral_category").distinct()
    base = (F.length("collateral_category") / F.lit(100)).cast("decimal(8,4)")
    early = h.withColumns({"haircut_percentage": base, "effective_date": F.lit("1990-01-01").cast("date"), "end_date": F.lit("1998-06-30").cast("date")})
    late = h.withColumns({"haircut_percentage": (base * 2).cast("decimal(8,4)"), "effective_date": F.lit("1998-07-01").cast("date"), "end_date": F.lit("9999-12-31").cast("date")})
    return early.unionByName(late).withColumn("concentration_limit_pct", F.lit(0.25).cast("decimal(8,4)"))


CV_SQL = """cv AS (SELECT fill_id, CAST(venue_id % 20 AS VARCHAR) AS ag, cat, valuation_date, amount * (1 - CAST(length(cat) AS DECIMAL(8,4)) * 0.01 * CASE WHEN valuation_date >= DATE '1998-07-01' THEN 2 ELSE 1 END) AS v FROM (
  SELECT *, CASE line_no % 4 WHEN 0 THEN 'CASH' WHEN 1 THEN 'UST_1_5Y' WHEN 2 THEN 'CORP_IG' ELSE 'EQUITY_DEVELOPED' END AS cat, CAST(date_trunc('year', settle_date) AS DATE) AS valuation_date FROM lines_s))"""


@query("X9_collateral_value", s.with_stage("lines_s", f"""
WITH {CV_SQL} SELECT fill_id, ag AS collateral_agreement_id, cat AS collateral_category, CAST(CAST(v AS DECIMAL(28,6)) AS DOUBLE) AS collateral_value FROM cv"""))
def x9(spark, d):
    out = risk.collateral_value(holdings(spark, d), haircuts(spark, d))
    return out.select("fill_id", "collateral_agreement_id", "collateral_category", F.col("collateral_value").cast("decimal(28,6)").alias("collateral_value"))


@query("X9_concentration_breaches", s.with_stage("lines_s", f"""
WITH {CV_SQL}, c AS (SELECT ag, valuation_date, cat, SUM(CAST(v AS DECIMAL(28,8))) AS cvv FROM cv GROUP BY ALL), p AS (SELECT *, CAST(cvv AS DOUBLE) / CAST(SUM(cvv) OVER (PARTITION BY ag, valuation_date) AS DOUBLE) AS pool_share FROM c)
SELECT ag AS collateral_agreement_id, CAST(valuation_date AS VARCHAR) AS valuation_date, cat AS collateral_category, round(pool_share, 9) AS pool_share FROM p WHERE pool_share > 0.25"""))
def x9b(spark, d):
    out = risk.concentration_breaches(risk.collateral_value(holdings(spark, d), haircuts(spark, d)))
    return out.select("collateral_agreement_id", "valuation_date", "collateral_category", F.round("pool_share", 9).alias("pool_share"))


@query("X10_margin_call", s.with_stage("orders_s", """
WITH x AS (SELECT order_id, greatest(0, order_total - (order_id % 1000) * 100 - 50000) AS need, CASE order_id % 3 WHEN 0 THEN 'UP' WHEN 1 THEN 'DOWN' ELSE 'NEAREST' END AS m FROM orders_s)
SELECT order_id, CASE WHEN need < 5000 THEN 0.0::DOUBLE ELSE 1000.0::DOUBLE * CASE m WHEN 'UP' THEN ceil(CAST(need AS DOUBLE) / 1000.0::DOUBLE) WHEN 'DOWN' THEN floor(CAST(need AS DOUBLE) / 1000.0::DOUBLE) ELSE floor(CAST(need AS DOUBLE) / 1000.0::DOUBLE + 0.5) END END AS call_amount FROM x"""))
def x10(spark, d):
    k = F.col("order_id")
    dec = "decimal(18,4)"
    df = s.orders(spark, d).select(
        "order_id", F.col("order_total").alias("exposure_amount"), ((k % 1000) * 100).cast(dec).alias("collateral_held"), F.lit(50000).cast(dec).alias("threshold_amount"),
        F.lit(5000).cast(dec).alias("minimum_transfer_amount"), F.lit(1000).cast(dec).alias("rounding_amount"),
        F.when(k % 3 == 0, "UP").when(k % 3 == 1, "DOWN").otherwise("NEAREST").alias("rounding_method"),
    )
    return risk.margin_call(df).select("order_id", "call_amount")


@query("X11_corporate_action_adjustment", s.with_stage("lines_s", """
WITH ca AS (SELECT DISTINCT instrument_id, settle_date AS ex_date FROM lines_s WHERE line_no = 7),
p AS (SELECT *, (SELECT COUNT(*) FROM ca WHERE ca.instrument_id = lines_s.instrument_id AND ca.ex_date > lines_s.settle_date) AS k FROM lines_s)
SELECT fill_id, CAST(price AS DOUBLE) * pow(0.5, k) AS adjusted_price, CAST(quantity AS DOUBLE) / pow(0.5, k) AS adjusted_quantity FROM p"""))
def x11(spark, d):
    li = s.lines(spark, d)
    actions = li.filter("line_no = 7").select("instrument_id", F.col("settle_date").alias("ex_date")).distinct().withColumn("adjustment_factor", F.lit(0.5))
    out = risk.adjust_history(li.withColumnRenamed("settle_date", "price_date"), actions)
    return out.select("fill_id", "adjusted_price", "adjusted_quantity")


@query("F8_year_fractions", s.with_stage("lines_s orders_s", """
WITH z AS (SELECT fill_id, order_date, settle_date, least(order_date, settle_date) AS a, greatest(order_date, settle_date) AS b, CASE WHEN settle_date < order_date THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sg
  FROM lines_s JOIN orders_s USING (order_id)),
cal AS (SELECT CAST(range AS DATE) AS c FROM range(DATE '1994-01-01', DATE '2004-01-01', INTERVAL 1 DAY)),
no AS (SELECT c, SUM(CASE WHEN dayofweek(c) BETWEEN 1 AND 5 THEN 1 ELSE 0 END) OVER (ORDER BY c) AS n FROM cal),
yr AS (SELECT c, SUM(1.0::DOUBLE / CASE WHEN year(c) % 4 = 0 AND (year(c) % 100 <> 0 OR year(c) % 400 = 0) THEN 366 ELSE 365 END) OVER (ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f,
  COUNT(*) FILTER (month(c) = 2 AND day(c) = 29) OVER (ORDER BY c) AS feb29 FROM cal)
SELECT fill_id, sg * CAST(b - a AS DOUBLE) / 360 AS act_360, sg * CAST(b - a AS DOUBLE) / 365 AS act_365_fixed,
  sg * ((year(b) - year(a)) * 360 + (month(b) - month(a)) * 30 + (CASE WHEN day(b) = 31 AND day(a) >= 30 THEN 30 ELSE day(b) END - least(day(a), 30)))::DOUBLE / 360 AS "30_360",
  sg * ((year(b) - year(a)) * 360 + (month(b) - month(a)) * 30 + (least(day(b), 30) - least(day(a), 30)))::DOUBLE / 360 AS "30e_360",
  round(sg * (coalesce(yb.f, 0) - coalesce(ya.f, 0)), 9) + 0 AS act_act_isda, sg * (CAST(b - a AS DOUBLE) - (yb.feb29 - ya.feb29)) / 365 AS nl_365, CAST(nb.n - na.n AS DOUBLE) / 252 AS bus_252
FROM z JOIN yr ya ON ya.c = a JOIN yr yb ON yb.c = b JOIN no na ON na.c = order_date JOIN no nb ON nb.c = settle_date"""))
def f8(spark, d):
    f = dims.business_days_between(s.fills(spark, d), "order_date", "settle_date", dims.dim_date(spark, "1994-01-01", "2003-12-31"), "days")
    names = {"ACT_360": "act_360", "ACT_365_FIXED": "act_365_fixed", "30_360": "30_360", "30E_360": "30e_360", "NL_365": "nl_365"}
    cols = [daycount.year_fraction("order_date", "settle_date", k).alias(v) for k, v in names.items()]
    isda = F.round(daycount.year_fraction("order_date", "settle_date", "ACT_ACT_ISDA"), 9) + 0
    return f.select("fill_id", *cols, isda.alias("act_act_isda"), daycount.year_fraction("order_date", "settle_date", "BUS_252", F.col("days")).alias("bus_252"))
