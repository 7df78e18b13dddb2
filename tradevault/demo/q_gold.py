"""Registered queries: dimensions, facts and read models."""

from pyspark.sql import functions as F

from tradevault.demo import stage as s
from tradevault.demo.registry import query
from tradevault.operators import interval, joins
from tradevault.plans import dims, facts, views
from tradevault.sources.seeds import read_config

FEEDS = {
    "party": s.party_feed, "instrument": s.instrument_feed, "venue": s.venue_feed, "account": s.account_feed,
    "desk": s.desk_feed, "trader": s.trader_feed,
}


def dim(spark, d, name):
    return dims.build_dim(FEEDS[name](spark, d), dims.DIMS[f"dim_{name}"])


def stored_dim(spark, d, name):
    return s.stored(spark, d, f"dim_{name}", lambda sp, dd: dim(sp, dd, name))


def dim_map(spark, d, *names):
    return {n: stored_dim(spark, d, n) for n in names}


def order_span(spark, d):
    return interval.date_span(s.table(spark, d, "orders"), "o_orderdate")


# ---- dimensions ------------------------------------------------------------------------------------------------

SHOWN = {
    "party": ("G3", ["party_type", "party_status", "domicile_country", "legal_name"]),
    "instrument": ("G4", ["symbol", "asset_class", "currency_code"]),
    "venue": ("G5", ["mic", "venue_name", "venue_category", "country_code"]),
    "account": ("G6", ["account_type", "account_status"]),
    "desk": ("G7", ["desk_name", "desk_hierarchy", "region"]),
    "trader": ("G8", ["cat_trader_id", "given_name_hash", "desk_id_bk"]),
}


def _register_dim(name, gid, attrs):
    key, sk = f"{name}_id_bk", f"dim_{name}_sk"
    cols = ", ".join(attrs)

    @query(f"{gid}_dim_{name}", s.with_dims("", name, f"""
SELECT {key}, {cols}, CAST(effective_start_date AS VARCHAR) AS effective_start_date,
  CAST(effective_end_date AS VARCHAR) AS effective_end_date, is_current, row_hash, {sk},
  sha256({key} || '||vault') AS dv2_source_hk FROM dim_{name}"""))
    def run(spark, d):
        return dim(spark, d, name).select(
            key, *attrs, "effective_start_date", "effective_end_date", "is_current", "row_hash", sk, "dv2_source_hk"
        )


for _n, (_gid, _attrs) in SHOWN.items():
    _register_dim(_n, _gid, _attrs)


@query("G1_calendar_of_events", """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS calendar_date FROM events),
hol(h) AS (VALUES (DATE '2024-01-01'), (DATE '2024-01-15')),
cal AS (SELECT CAST(range AS DATE) AS c FROM range(DATE '2024-01-01', DATE '2024-03-01', INTERVAL 1 DAY)),
tr AS (SELECT c, dayofweek(c) BETWEEN 1 AND 5 AND c NOT IN (SELECT h FROM hol) AS t FROM cal),
no AS (SELECT c, t, SUM(CASE WHEN t THEN 1 ELSE 0 END) OVER (ORDER BY c) AS n FROM tr)
SELECT CAST(strftime(calendar_date, '%Y%m%d') AS BIGINT) AS date_sk, CAST(calendar_date AS VARCHAR) AS calendar_date,
  CAST(dayofweek(calendar_date) + 1 AS BIGINT) AS day_of_week, strftime(calendar_date, '%A') AS day_name,
  CAST(weekofyear(calendar_date) AS BIGINT) AS week_of_year, strftime(calendar_date, '%B') AS month_name,
  CAST(quarter(calendar_date) AS BIGINT) AS quarter, no.t AS is_trading_day, calendar_date IN (SELECT h FROM hol) AS holiday_flag,
  CAST(calendar_date + 1 AS VARCHAR) AS t_plus_1_settlement_date, CAST(calendar_date + 3 AS VARCHAR) AS t_plus_3_error_correction_deadline,
  strftime(CAST(calendar_date + 1 AS TIMESTAMP) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS cat_submission_deadline_timestamp,
  CAST(n1.c AS VARCHAR) AS t_plus_1_business, CAST(n3.c AS VARCHAR) AS t_plus_3_business
FROM d JOIN no ON no.c = calendar_date
JOIN no n1 ON n1.t AND n1.n = no.n + 1 JOIN no n3 ON n3.t AND n3.n = no.n + 3""")
def g1(spark, d):
    cal = dims.dim_date(spark)
    days = s.table(spark, d, "events").select(F.to_date("ts").alias("calendar_date")).distinct().join(F.broadcast(cal), "calendar_date")
    days = dims.add_business_days(days, "calendar_date", 1, cal, "t_plus_1_business")
    days = dims.add_business_days(days, "calendar_date", 3, cal, "t_plus_3_business")
    return days.select(
        "date_sk", "calendar_date", "day_of_week", "day_name", "week_of_year", "month_name", "quarter", "is_trading_day",
        "holiday_flag", "t_plus_1_settlement_date", "t_plus_3_error_correction_deadline",
        "cat_submission_deadline_timestamp", "t_plus_1_business", "t_plus_3_business",
    )


CODE_TYPES = """(VALUES ('MENO','New Order','ORDER','EQUITY_ORDER'), ('MECO','Child Order','CHILD_ORDER','EQUITY_ORDER'),
 ('MEOR','Order Route','ROUTING','EQUITY_ORDER'), ('MEOT','Trade','EXECUTION','EQUITY_EXECUTION'),
 ('MEOC','Order Cancelled','MODIFICATION','EQUITY_ORDER')) AS t(cat_event_code, event_name, event_phase, category)"""


TAXONOMY_SQL = "(VALUES " + ", ".join("(" + ", ".join([str(i + 1), *["'" + x.replace("'", "''") + "'" for x in r[:5]]]) + ")" for i, r in enumerate(read_config("event_types")[1])) + ") AS t(pos, section, event_name, code, category, phase)"


@query("G2_event_type_dimension", s.with_stage("order_events", f"""
SELECT CAST(pos AS BIGINT) AS dim_event_type_sk, code AS cat_event_code, event_name, phase AS event_phase, section AS section_number, category,
  CASE WHEN category LIKE '%\\_ALLOCATION' ESCAPE '\\' THEN 'Allocations' WHEN category LIKE '%\\_QUOTE' ESCAPE '\\' THEN 'QuoteEvents' WHEN category LIKE '%OPTION%' THEN 'OptionEvents' ELSE 'OrderEvents' END AS submission_file_type,
  category LIKE '%OPTION%' AS is_options, category LIKE '%MULTILEG%' AS is_multileg, COUNT(cat_event_code) AS n
FROM {TAXONOMY_SQL} LEFT JOIN order_events ON cat_event_code = code GROUP BY ALL"""))
def g2_all(spark, d):
    """All codes of the taxonomy with the events that use them."""
    used = s.order_events(spark, d).groupBy("cat_event_code").agg(F.count(F.lit(1)).alias("n"))
    out = dims.dim_event_type(spark).join(used, "cat_event_code", "left").fillna(0, ["n"])
    return out.select("dim_event_type_sk", "cat_event_code", "event_name", "event_phase", "section_number", "category", "submission_file_type", "is_options", "is_multileg", "n")


@query("G2_event_types_used", s.with_stage("order_events", f"""
SELECT cat_event_code, event_name, event_phase, category, 'OrderEvents' AS submission_file_type, false AS is_options,
  false AS is_multileg, true AS is_electronic, COUNT(*) AS n
FROM order_events JOIN {CODE_TYPES} USING (cat_event_code) GROUP BY ALL"""))
def g2(spark, d):
    et = dims.dim_event_type(spark)
    used = s.order_events(spark, d).groupBy("cat_event_code").agg(F.count(F.lit(1)).alias("n"))
    return used.join(et, "cat_event_code").select(
        "cat_event_code", "event_name", "event_phase", "category", "submission_file_type", "is_options", "is_multileg",
        "is_electronic", "n",
    )


# ---- point-in-time lookups and facts -----------------------------------------------------------------------------


@query("J2_pit_lookup", s.with_dims("fills", "party", """
SELECT fill_id, party_id, CAST(order_date AS VARCHAR) AS order_date, dim_party_sk, party_status
FROM fills LEFT JOIN dim_party ON party_id = party_id_bk AND order_date BETWEEN effective_start_date AND effective_end_date"""))
def j2(spark, d):
    out = interval.pit_lookup(
        s.fills(spark, d), dim(spark, d, "party"), "party_id", "party_id_bk", "order_date",
        {"dim_party_sk": "dim_party_sk", "party_status": "party_status"}, span=order_span(spark, d),
    )
    return out.select("fill_id", "party_id", "order_date", "dim_party_sk", "party_status")


@query("J3_counterparty_role", s.with_dims("fills", "party", """
SELECT fill_id, p.dim_party_sk, c.dim_party_sk AS counterparty_party_sk
FROM fills LEFT JOIN dim_party p ON party_id = p.party_id_bk AND order_date BETWEEN p.effective_start_date AND p.effective_end_date
LEFT JOIN dim_party c ON venue_id = c.party_id_bk AND order_date BETWEEN c.effective_start_date AND c.effective_end_date"""))
def j3(spark, d):
    p = dim(spark, d, "party")
    f = s.fills(spark, d).withColumnsRenamed({"venue_id": "counterparty_id"})
    return facts.resolve(f, facts.standard_roles({"party": p}, ["party", "counterparty"]), "order_date").select(
        "fill_id", "dim_party_sk", "counterparty_party_sk"
    )


@query("J4_current_lookup", s.with_dims("lines_s", "venue", """
SELECT fill_id, dim_venue_sk, venue_category FROM lines_s LEFT JOIN dim_venue ON venue_id = venue_id_bk AND is_current"""))
def j4(spark, d):
    out = interval.current_lookup(
        s.lines(spark, d), dim(spark, d, "venue"), "venue_id", "venue_id_bk",
        {"dim_venue_sk": "dim_venue_sk", "venue_category": "venue_category"},
    )
    return out.select("fill_id", "dim_venue_sk", "venue_category")


@query("J5_date_lookup", """
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_sk FROM events""")
def j5(spark, d):
    ev = s.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return interval.join_date(ev, dims.dim_date(spark), "ts").select("event_id", "date_sk")


@query("J7_star_join", s.with_dims("fills", "party instrument venue", """
SELECT fill_id, party_type, asset_class, mic, CAST(amount AS DOUBLE) AS amount FROM fills
JOIN dim_party p ON party_id = party_id_bk AND p.is_current
JOIN dim_instrument i ON instrument_id = instrument_id_bk AND i.is_current
LEFT JOIN dim_venue v ON venue_id = venue_id_bk AND v.is_current"""))
def j7(spark, d):
    def now(name, *cols):
        return dim(spark, d, name).filter("is_current").select(F.col(f"{name}_id_bk").alias(f"{name}_id"), *cols)

    star = joins.star_join(
        s.fills(spark, d),
        [(now("party", "party_type"), "party_id", "inner"), (now("instrument", "asset_class"), "instrument_id", "inner"),
         (now("venue", "mic"), "venue_id", "left")],
    )
    return star.select("fill_id", "party_type", "asset_class", "mic", "amount")


ALL_DIMS = ("party", "instrument", "venue", "account", "desk", "trader")
FACT_SQL = """
WITH fact AS (SELECT e.*, p.dim_party_sk, i.dim_instrument_sk, v.dim_venue_sk, a.dim_account_sk, k.dim_desk_sk, t.dim_trader_sk,
  c.dim_party_sk AS counterparty_party_sk
FROM order_events e
JOIN dim_party p ON e.party_id = p.party_id_bk AND e.event_date BETWEEN p.effective_start_date AND p.effective_end_date
JOIN dim_instrument i ON e.instrument_id = i.instrument_id_bk AND e.event_date BETWEEN i.effective_start_date AND i.effective_end_date
LEFT JOIN dim_venue v ON e.venue_id = v.venue_id_bk AND e.event_date BETWEEN v.effective_start_date AND v.effective_end_date
LEFT JOIN dim_account a ON e.account_id = a.account_id_bk AND e.event_date BETWEEN a.effective_start_date AND a.effective_end_date
LEFT JOIN dim_desk k ON e.desk_id = k.desk_id_bk AND e.event_date BETWEEN k.effective_start_date AND k.effective_end_date
LEFT JOIN dim_trader t ON e.trader_id = t.trader_id_bk AND e.event_date BETWEEN t.effective_start_date AND t.effective_end_date
LEFT JOIN dim_party c ON e.counterparty_id = c.party_id_bk AND e.event_date BETWEEN c.effective_start_date AND c.effective_end_date)
"""


def order_fact(spark, d, dm, events=None):
    events = s.order_events(spark, d) if events is None else events
    return facts.order_event_fact(events, dm, order_span(spark, d))


SKS = "dim_party_sk dim_instrument_sk dim_venue_sk dim_account_sk dim_desk_sk dim_trader_sk counterparty_party_sk".split()


def stored_fact(spark, d):
    """The order event fact as a pipeline stores it; G11 is the step that builds it."""
    return s.stored(spark, d, "fact_order_events", lambda sp, dd: order_fact(sp, dd, dim_map(sp, dd, *ALL_DIMS)))


@query("G11_order_event_fact", s.with_dims("order_events", " ".join(ALL_DIMS), FACT_SQL + f"""
SELECT firm_roe_id, cat_order_id, cat_event_code, {', '.join(SKS)}, CAST(event_date AS VARCHAR) AS event_date, side,
  CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price, dv2_source_hk FROM fact"""))
def g11(spark, d):
    return order_fact(spark, d, dim_map(spark, d, *ALL_DIMS)).select(
        "firm_roe_id", "cat_order_id", "cat_event_code", *SKS, "event_date", "side", "quantity", "price", "dv2_source_hk"
    )


def allocations(spark, d):
    f = s.fills(spark, d)
    return f.select(
        F.concat_ws("-", "order_id", "line_no").alias("firm_roe_id"), F.col("order_id").cast("string").alias("cat_order_id"),
        F.col("fill_id").alias("cat_allocation_id"), F.lit("MEPA").alias("cat_event_code"), "party_id", "instrument_id",
        F.col("party_id").alias("account_id"), (F.col("party_id") % 25).alias("desk_id"), F.col("fill_id").alias("parent_execution_id"),
        F.lit("PRO_RATA").alias("allocation_method"), F.col("quantity").alias("allocated_quantity"), F.col("price").alias("allocated_price"),
        "settle_date", F.col("fill_ts").alias("allocation_timestamp"), F.col("order_date").alias("event_date"),
        F.col("fill_id").alias("dv2_source_hk"),
    )


def allocation_rows(spark, d):
    dm = dim_map(spark, d, "party", "instrument", "account", "desk")
    return facts.allocation_fact(allocations(spark, d), dm, order_span(spark, d))


@query("G12_allocation_fact", s.with_dims("fills", "party instrument account desk", """
SELECT fill_id AS cat_allocation_id, p.dim_party_sk, i.dim_instrument_sk, a.dim_account_sk, k.dim_desk_sk,
  CAST(quantity AS DOUBLE) AS allocated_quantity, CAST(settle_date AS VARCHAR) AS settle_date
FROM fills
JOIN dim_party p ON party_id = p.party_id_bk AND order_date BETWEEN p.effective_start_date AND p.effective_end_date
JOIN dim_instrument i ON instrument_id = i.instrument_id_bk AND order_date BETWEEN i.effective_start_date AND i.effective_end_date
LEFT JOIN dim_account a ON party_id = a.account_id_bk AND order_date BETWEEN a.effective_start_date AND a.effective_end_date
LEFT JOIN dim_desk k ON party_id % 25 = k.desk_id_bk"""))
def g12(spark, d):
    return allocation_rows(spark, d).select(
        "cat_allocation_id", "dim_party_sk", "dim_instrument_sk", "dim_account_sk", "dim_desk_sk", "allocated_quantity", "settle_date"
    )


@query("G13_quote_fact", s.with_dims("quotes", "party instrument venue trader", """
SELECT quote_id AS cat_quote_id, p.dim_party_sk, i.dim_instrument_sk, v.dim_venue_sk, t.dim_trader_sk, CAST(bid_price AS DOUBLE) AS bid_price,
  CAST(ask_price AS DOUBLE) AS ask_price, CASE return_flag WHEN 'R' THEN 'BID' WHEN 'A' THEN 'OFFER' ELSE 'TWO_WAY' END AS quote_side
FROM quotes q
JOIN dim_party p ON venue_id = p.party_id_bk AND CAST(quote_ts AS DATE) BETWEEN p.effective_start_date AND p.effective_end_date
JOIN dim_instrument i ON instrument_id = i.instrument_id_bk AND CAST(quote_ts AS DATE) BETWEEN i.effective_start_date AND i.effective_end_date
LEFT JOIN dim_venue v ON venue_id = v.venue_id_bk AND CAST(quote_ts AS DATE) BETWEEN v.effective_start_date AND v.effective_end_date
LEFT JOIN dim_trader t ON venue_id = t.trader_id_bk"""))
def g13(spark, d):
    return quote_rows(spark, d).select(
        "cat_quote_id", "dim_party_sk", "dim_instrument_sk", "dim_venue_sk", "dim_trader_sk", "bid_price", "ask_price", "quote_side"
    )


def quote_rows(spark, d):
    q = s.quotes(spark, d).select(
        F.col("quote_id").alias("firm_roe_id"), F.col("quote_id").alias("cat_quote_id"), F.lit("MENQ").alias("cat_event_code"),
        F.col("venue_id").alias("party_id"), F.col("venue_id").alias("counterparty_id"), "instrument_id", "venue_id",
        F.col("venue_id").alias("trader_id"),
        F.when(F.col("return_flag") == "R", "BID").when(F.col("return_flag") == "A", "OFFER").otherwise("TWO_WAY").alias("quote_side"),
        "bid_price", "ask_price", F.lit("FIRM").alias("quote_type"), F.col("quote_ts").alias("quote_timestamp"),
        F.to_date("quote_ts").alias("event_date"), F.col("quote_id").alias("dv2_source_hk"),
    )
    return facts.quote_fact(q, dim_map(spark, d, "party", "instrument", "venue", "trader"), interval.date_span(q, "event_date"))


@query("P4_route_events", s.with_stage("order_events", """
SELECT cat_event_code, CASE WHEN cat_event_code IN ('MEOT') THEN 'equity_execution' ELSE 'equity_order' END AS fact, COUNT(*) AS n
FROM order_events GROUP BY ALL"""))
def p4(spark, d):
    return facts.route_events(s.order_events(spark, d)).groupBy("cat_event_code", "fact").agg(F.count(F.lit(1)).alias("n"))


@query("G16_equity_allocations_and_quotes", s.with_dims("fills quotes", "party instrument venue account desk trader", """
SELECT 'equity_allocation' AS fact, fill_id AS dv2_source_hk, p.dim_party_sk, i.dim_instrument_sk, a.dim_account_sk, NULL::BIGINT AS dim_venue_sk, CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price
FROM fills JOIN dim_party p ON party_id = p.party_id_bk AND order_date BETWEEN p.effective_start_date AND p.effective_end_date
JOIN dim_instrument i ON instrument_id = i.instrument_id_bk AND order_date BETWEEN i.effective_start_date AND i.effective_end_date
LEFT JOIN dim_account a ON party_id = a.account_id_bk AND order_date BETWEEN a.effective_start_date AND a.effective_end_date
UNION ALL SELECT 'equity_quote', quote_id, p.dim_party_sk, i.dim_instrument_sk, NULL, v.dim_venue_sk, NULL, CAST(bid_price AS DOUBLE)
FROM quotes JOIN dim_party p ON venue_id = p.party_id_bk AND CAST(quote_ts AS DATE) BETWEEN p.effective_start_date AND p.effective_end_date
JOIN dim_instrument i ON instrument_id = i.instrument_id_bk AND CAST(quote_ts AS DATE) BETWEEN i.effective_start_date AND i.effective_end_date
LEFT JOIN dim_venue v ON venue_id = v.venue_id_bk AND CAST(quote_ts AS DATE) BETWEEN v.effective_start_date AND v.effective_end_date"""))
def g16b(spark, d):
    """Allocation and quote events routed by their codes to the two facts, with their keys resolved and gated."""
    a = facts.events_of(allocation_rows(spark, d), "equity_allocation").select(
        F.lit("equity_allocation").alias("fact"), "dv2_source_hk", "dim_party_sk", "dim_instrument_sk", "dim_account_sk", F.lit(None).cast("long").alias("dim_venue_sk"),
        F.col("allocated_quantity").alias("quantity"), F.col("allocated_price").cast("double").alias("price"),
    )
    q = facts.events_of(quote_rows(spark, d), "equity_quote").select(
        F.lit("equity_quote").alias("fact"), "dv2_source_hk", "dim_party_sk", "dim_instrument_sk", F.lit(None).cast("long").alias("dim_account_sk"), "dim_venue_sk",
        F.lit(None).cast("decimal(18,4)").alias("quantity"), F.col("bid_price").cast("double").alias("price"),
    )
    return a.unionByName(q)


@query("G16_equity_split", s.with_stage("order_events", """
SELECT 'equity_execution' AS fact, dv2_source_hk, CAST(execution_price AS DOUBLE) AS px FROM order_events WHERE cat_event_code IN ('MEOT','MEOTS')
UNION ALL SELECT 'equity_order', dv2_source_hk, CAST(price AS DOUBLE) FROM order_events WHERE cat_event_code IN ('MENO','MECO','MEOR','MEOC')"""))
def g16(spark, d):
    ev = s.order_events(spark, d)
    x = facts.events_of(ev, "equity_execution").select(F.lit("equity_execution").alias("fact"), "dv2_source_hk", F.col("execution_price").alias("px"))
    o = facts.events_of(ev, "equity_order").select(F.lit("equity_order").alias("fact"), "dv2_source_hk", F.col("price").alias("px"))
    return x.unionByName(o)


@query("G17_idempotent_append", s.with_stage("order_events", """
WITH stored AS (SELECT DISTINCT firm_roe_id, cat_event_code, event_date FROM order_events WHERE side = 'SELL'),
l AS (SELECT *, row_number() OVER (PARTITION BY firm_roe_id, cat_event_code, event_date
  ORDER BY event_timestamp DESC, event_nanos DESC, dv2_source_hk DESC) AS rn FROM order_events)
SELECT firm_roe_id, cat_event_code, CAST(event_date AS VARCHAR) AS event_date, dv2_source_hk FROM l
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM stored x WHERE x.firm_roe_id = l.firm_roe_id AND x.cat_event_code = l.cat_event_code AND x.event_date = l.event_date)"""))
def g17(spark, d):
    ev = s.order_events(spark, d).select("firm_roe_id", "cat_event_code", "event_date", "event_timestamp", "event_nanos", "dv2_source_hk", "side")
    return facts.new_events(ev, ev.filter("side = 'SELL'")).select("firm_roe_id", "cat_event_code", "event_date", "dv2_source_hk")


# ---- read models -------------------------------------------------------------------------------------------------


@query("V1_order_reconstruction", s.with_dims("order_events", " ".join(ALL_DIMS), FACT_SQL + f"""
SELECT f.cat_order_id, f.firm_roe_id, f.cat_event_code, event_name, event_phase, reporting.legal_name AS reporting_firm_name,
  i.symbol, i.asset_class, v.mic AS venue_mic, a.account_type, f.side, CAST(f.quantity AS DOUBLE) AS quantity, f.dv2_source_hk,
  row_number() OVER w AS lifecycle_sequence, lag(f.cat_event_code) OVER w AS prior_event_code, lead(f.cat_event_code) OVER w AS next_event_code
FROM fact f JOIN {CODE_TYPES} USING (cat_event_code)
JOIN dim_party reporting ON f.dim_party_sk = reporting.dim_party_sk JOIN dim_instrument i ON f.dim_instrument_sk = i.dim_instrument_sk
LEFT JOIN dim_venue v ON f.dim_venue_sk = v.dim_venue_sk LEFT JOIN dim_account a ON f.dim_account_sk = a.dim_account_sk
WINDOW w AS (PARTITION BY f.cat_order_id ORDER BY f.event_timestamp, coalesce(f.event_nanos, 0), f.dv2_source_hk)"""))
def v1(spark, d):
    dm = dim_map(spark, d, *ALL_DIMS)
    et = dims.dim_event_type(spark)
    out = views.order_reconstruction(stored_fact(spark, d), et, dm["party"], dm["instrument"], dm["venue"], dm["account"])
    return out.select(
        "cat_order_id", "firm_roe_id", "cat_event_code", "event_name", "event_phase", "reporting_firm_name", "symbol",
        "asset_class", "venue_mic", "account_type", "side", "quantity", "dv2_source_hk", "lifecycle_sequence",
        "prior_event_code", "next_event_code",
    )


@query("W1_lifecycle_sequence", s.with_stage("order_events", """
SELECT dv2_source_hk, row_number() OVER w AS lifecycle_sequence, lag(cat_event_code) OVER w AS prior_event_code,
  lead(cat_event_code) OVER w AS next_event_code FROM order_events
WINDOW w AS (PARTITION BY cat_order_id ORDER BY event_timestamp, event_nanos, dv2_source_hk)"""))
def w1(spark, d):
    from tradevault.functions.ordered import with_ordered

    return with_ordered(
        s.order_events(spark, d), ["cat_order_id"], ["event_timestamp", "event_nanos", "dv2_source_hk"], F.to_date("event_timestamp"),
        lag={"prior_event_code": "cat_event_code"}, lead={"next_event_code": "cat_event_code"}, number="lifecycle_sequence",
    ).select("dv2_source_hk", "lifecycle_sequence", "prior_event_code", "next_event_code")


def batches(spark, d):
    """Submission batches from orders: one per order, file type by status, acknowledged by priority."""
    o = s.table(spark, d, "orders")
    ts = F.col("o_orderdate").cast("timestamp")
    pr = F.col("o_orderpriority")
    return o.select(
        F.concat(F.lit("B"), (F.col("o_orderkey") % 5000).cast("string")).alias("batch_id"),
        F.to_date(F.date_trunc("month", ts)).alias("event_date"),
        F.concat(F.lit("F"), (F.col("o_custkey") % 4).cast("string")).alias("cat_reporter_imid"),
        F.when(F.col("o_orderstatus") == "P", "QuoteEvents").otherwise("OrderEvents").alias("submission_file_type"),
        (F.col("o_orderkey") % 100).alias("record_count"), (F.col("o_orderkey") % 90).alias("records_accepted"),
        (F.col("o_orderkey") % 10).alias("records_rejected"), (F.col("o_orderkey") % 3).alias("records_repaired"),
        ts.alias("submission_timestamp"), (ts + F.expr("interval 8 hours")).alias("submission_deadline"),
        (F.col("o_orderkey") % 211 == 0).alias("is_late_submission"),
        F.when(pr == "1-URGENT", "REJECTED").when(pr == "2-HIGH", "PENDING").otherwise("ACCEPTED").alias("ack_status"),
    )


def feedback_errors(spark, d):
    li = s.lines(spark, d)
    return li.select(
        "fill_id", F.concat(F.lit("B"), (F.col("order_id") % 5000).cast("string")).alias("batch_id"),
        F.to_date(F.date_trunc("month", "settle_date")).alias("event_date"),
        F.concat_ws("-", "order_id", "line_no").alias("firm_roe_id"),
        F.when(F.col("return_flag") == "R", "MENQ").otherwise("MENO").alias("cat_event_code"),
        F.when(F.col("settlement_status") == "SETTLED", "OPEN").when(F.col("return_flag") == "N", "RESOLVED").otherwise("ESCALATED").alias("resolution_status"),
        (F.col("line_no") - 2).alias("days_to_deadline"), F.date_add("settle_date", 3).alias("t_plus_3_deadline"),
        "settle_date",
    )


BATCH_SQL = """batches AS (SELECT 'B' || (o_orderkey % 5000) AS batch_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS event_date,
  'F' || (o_custkey % 4) AS cat_reporter_imid, CASE WHEN o_orderstatus = 'P' THEN 'QuoteEvents' ELSE 'OrderEvents' END AS submission_file_type,
  o_orderkey % 100 AS record_count, o_orderkey % 90 AS records_accepted, o_orderkey % 10 AS records_rejected, o_orderkey % 3 AS records_repaired,
  o_orderdate AS submission_timestamp, o_orderdate + INTERVAL 8 HOUR AS submission_deadline, o_orderkey % 211 = 0 AS is_late_submission,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'REJECTED' WHEN '2-HIGH' THEN 'PENDING' ELSE 'ACCEPTED' END AS ack_status FROM orders)"""
ERROR_SQL = """errors AS (SELECT fill_id, 'B' || (order_id % 5000) AS batch_id, CAST(date_trunc('month', settle_date) AS DATE) AS event_date,
  order_id || '-' || line_no AS firm_roe_id, CASE WHEN return_flag = 'R' THEN 'MENQ' ELSE 'MENO' END AS cat_event_code,
  CASE WHEN settlement_status = 'SETTLED' THEN 'OPEN' WHEN return_flag = 'N' THEN 'RESOLVED' ELSE 'ESCALATED' END AS resolution_status,
  line_no - 2 AS days_to_deadline, settle_date + 3 AS t_plus_3_deadline, settle_date FROM lines_s)"""
STATUS_SQL = f"""
WITH {BATCH_SQL}, {ERROR_SQL},
b AS (SELECT event_date, cat_reporter_imid, submission_file_type, COUNT(*) AS batch_count, SUM(record_count) AS total_records,
  SUM(records_accepted) AS total_accepted, SUM(records_rejected) AS total_rejected, SUM(records_repaired) AS total_repaired,
  MIN(submission_timestamp) AS first_submission_ts, MAX(submission_timestamp) AS last_submission_ts, MIN(submission_deadline) AS submission_deadline,
  MAX(CASE WHEN is_late_submission THEN 1 ELSE 0 END) AS any_late_flag,
  COUNT(DISTINCT CASE WHEN ack_status = 'ACCEPTED' THEN batch_id END) AS accepted_batches,
  COUNT(DISTINCT CASE WHEN ack_status = 'REJECTED' THEN batch_id END) AS rejected_batches,
  COUNT(DISTINCT CASE WHEN ack_status IN ('PENDING','PROCESSING') THEN batch_id END) AS pending_batches
  FROM batches GROUP BY ALL),
e0 AS (SELECT event_date, firm_roe_id, cat_event_code, COUNT(*) AS open_error_count, SUM(CASE WHEN resolution_status = 'OPEN' THEN 1 ELSE 0 END) AS unresolved_count,
  SUM(CASE WHEN days_to_deadline < 0 THEN 1 ELSE 0 END) AS overdue_count, MIN(t_plus_3_deadline) AS earliest
  FROM errors WHERE resolution_status IN ('OPEN','IN_PROGRESS','ESCALATED') GROUP BY ALL),
e AS (SELECT event_date, CASE cat_event_code WHEN 'MENQ' THEN 'QuoteEvents' ELSE 'OrderEvents' END AS submission_file_type,
  SUM(open_error_count) AS open_error_count, SUM(unresolved_count) AS unresolved_count, SUM(overdue_count) AS overdue_count, MIN(earliest) AS earliest_correction_deadline
  FROM e0 GROUP BY ALL)
"""


@query("V2_daily_submission_status", s.with_stage("lines_s", STATUS_SQL + """
SELECT CAST(b.event_date AS VARCHAR) AS event_date, cat_reporter_imid, b.submission_file_type, batch_count, CAST(total_records AS BIGINT) AS total_records,
  CAST(total_accepted AS BIGINT) AS total_accepted, CAST(total_rejected AS BIGINT) AS total_rejected, CAST(total_repaired AS BIGINT) AS total_repaired,
  strftime(first_submission_ts, '%Y-%m-%d %H:%M:%S.%f') AS first_submission_ts, strftime(submission_deadline, '%Y-%m-%d %H:%M:%S.%f') AS submission_deadline,
  CAST(any_late_flag AS BIGINT) AS any_late_flag, accepted_batches, rejected_batches, pending_batches,
  CAST(coalesce(open_error_count, 0) AS BIGINT) AS open_error_count, CAST(coalesce(unresolved_count, 0) AS BIGINT) AS unresolved_count,
  CAST(coalesce(overdue_count, 0) AS BIGINT) AS overdue_count, CAST(earliest_correction_deadline AS VARCHAR) AS earliest_correction_deadline,
  CASE WHEN any_late_flag = 1 THEN 'LATE' WHEN coalesce(overdue_count, 0) > 0 THEN 'OVERDUE_CORRECTIONS' WHEN pending_batches > 0 THEN 'PENDING'
    WHEN rejected_batches > 0 THEN 'REJECTED' WHEN accepted_batches = batch_count AND batch_count > 0 THEN 'GREEN' ELSE 'UNKNOWN' END AS overall_status
FROM b LEFT JOIN e ON b.event_date = e.event_date AND b.submission_file_type = e.submission_file_type"""))
def v2(spark, d):
    out = views.daily_submission_status(batches(spark, d), feedback_errors(spark, d), dims.dim_event_type(spark))
    return out.drop("last_submission_ts")


@query("A3_submission_batches", s.with_stage("lines_s", STATUS_SQL + """
SELECT CAST(event_date AS VARCHAR) AS event_date, cat_reporter_imid, submission_file_type, batch_count, accepted_batches, rejected_batches, pending_batches,
  CAST(total_records AS BIGINT) AS total_records FROM b"""))
def a3(spark, d):
    return views.submission_batches(batches(spark, d)).select(
        "event_date", "cat_reporter_imid", "submission_file_type", "batch_count", "accepted_batches", "rejected_batches", "pending_batches", "total_records"
    )


@query("A4_errors_by_file", s.with_stage("lines_s", STATUS_SQL + """
SELECT CAST(event_date AS VARCHAR) AS event_date, submission_file_type, CAST(open_error_count AS BIGINT) AS open_error_count,
  CAST(unresolved_count AS BIGINT) AS unresolved_count, CAST(overdue_count AS BIGINT) AS overdue_count,
  CAST(earliest_correction_deadline AS VARCHAR) AS earliest_correction_deadline FROM e"""))
def a4(spark, d):
    return views.errors_by_file(feedback_errors(spark, d), dims.dim_event_type(spark))


@query("V3_best_execution_audit", s.with_dims("order_events", " ".join(ALL_DIMS), FACT_SQL + """
SELECT f.dv2_source_hk, f.cat_event_code, 'Trade' AS event_name, i.symbol, v.mic AS execution_venue_mic, v.venue_category, f.side,
  CAST(f.execution_price AS DOUBLE) AS execution_price, CAST(f.price AS DOUBLE) AS limit_price,
  CAST(CASE f.side WHEN 'BUY' THEN f.execution_price - f.price WHEN 'SELL' THEN f.price - f.execution_price
    WHEN 'SELL_SHORT' THEN f.price - f.execution_price END AS DOUBLE) AS price_improvement,
  p.legal_name AS executing_firm_name, t.cat_trader_id, k.desk_name
FROM fact f JOIN dim_party p ON f.dim_party_sk = p.dim_party_sk JOIN dim_instrument i ON f.dim_instrument_sk = i.dim_instrument_sk
LEFT JOIN dim_venue v ON f.dim_venue_sk = v.dim_venue_sk LEFT JOIN dim_trader t ON f.dim_trader_sk = t.dim_trader_sk
LEFT JOIN dim_desk k ON f.dim_desk_sk = k.dim_desk_sk WHERE f.cat_event_code = 'MEOT'"""))
def v3(spark, d):
    dm = dim_map(spark, d, *ALL_DIMS)
    et = dims.dim_event_type(spark)
    out = views.best_execution_audit(
        stored_fact(spark, d), et, dm["party"], dm["instrument"], dm["venue"], dm["trader"], dm["desk"]
    )
    return out.select(
        "dv2_source_hk", "cat_event_code", "event_name", "symbol", "execution_venue_mic", "venue_category", "side", "execution_price",
        "limit_price", "price_improvement", "executing_firm_name", "cat_trader_id", "desk_name",
    )
