"""Registered queries: projections, quality, facts by family, account flows, submission, reference data."""

from pyspark.sql import functions as F

from tradevault.demo import stage as s
from tradevault.demo.q_gold import CODE_TYPES, FACT_SQL, dim, order_fact, order_span, stored_dim, dim_map, ALL_DIMS
from tradevault.demo.registry import query
from tradevault.functions.hashing import narrow, widened
from tradevault.functions.scalars import change_operation, code_list, is_hashed, mask_hash, operating_or_segment, resolve_identifier
from tradevault.operators import interval, quality
from tradevault.plans import dims, facts, refdata, rules, states, submission, views
from tradevault.sources import seeds
from tradevault.sources.seeds import small_frame

# ---- projections ---------------------------------------------------------------------------------------------------------


@query("P5_typed_constants", """SELECT o_orderkey, CAST(NULL AS BIGINT) AS instrument_sk, 'PASS' AS quality_outcome, 0 AS error_count FROM orders""")
def p5(spark, d):
    o = s.table(spark, d, "orders").select("o_orderkey")
    return facts.with_constants(o, {"instrument_sk": (None, "bigint"), "quality_outcome": ("PASS", "string"), "error_count": (0, "int")})


@query("P6_preferred_identifier", """
WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'US' || p_partkey END AS isin, CASE WHEN p_partkey % 2 = 0 THEN 'C' || p_partkey END AS cusip, CASE WHEN p_partkey % 5 = 0 THEN 'BBG' || p_partkey END AS figi FROM part)
SELECT p_partkey, coalesce(isin, cusip, figi) AS security_id, CASE WHEN isin IS NOT NULL THEN 'ISIN' WHEN cusip IS NOT NULL THEN 'CUSIP' WHEN figi IS NOT NULL THEN 'FIGI' END AS security_id_source FROM x""")
def p6(spark, d):
    k = F.col("p_partkey")
    t = k.cast("string")
    p = s.table(spark, d, "part").select(
        "p_partkey", F.when(k % 3 == 0, F.concat(F.lit("US"), t)).alias("isin"), F.when(k % 2 == 0, F.concat(F.lit("C"), t)).alias("cusip"),
        F.when(k % 5 == 0, F.concat(F.lit("BBG"), t)).alias("figi"),
    )
    value, scheme = resolve_identifier([("ISIN", "isin"), ("CUSIP", "cusip"), ("FIGI", "figi")])
    return p.select("p_partkey", value.alias("security_id"), scheme.alias("security_id_source"))


@query("P7_operating_or_segment", """SELECT s_suppkey, CASE WHEN s_suppkey IS NOT DISTINCT FROM nullif(s_suppkey - s_suppkey % 4, 8) THEN 'OPRT' ELSE 'SGMT' END AS category FROM supplier""")
def p7(spark, d):
    oper = F.nullif(F.col("s_suppkey") - F.col("s_suppkey") % 4, F.lit(8))
    return s.table(spark, d, "supplier").select("s_suppkey", operating_or_segment("s_suppkey", oper).alias("category"))


@query("P8_audit_stamp", """
SELECT n_nationkey, '2026-01-01' AS effective_start_date, '9999-12-31' AS effective_end_date, true AS is_active, 'INTERNAL_TAXONOMY' AS source_authority, '2026.1' AS source_version,
  CAST(epoch(TIMESTAMP '2026-01-01 06:00:00') AS BIGINT) AS cdc_sequence, 'UPSERT' AS cdc_operation FROM nation""")
def p8(spark, d):
    out = seeds.with_audit(s.table(spark, d, "nation"), "INTERNAL_TAXONOMY", "2026.1", "nation", F.lit("2026-01-01 06:00:00").cast("timestamp"))
    return out.select("n_nationkey", "effective_start_date", "effective_end_date", "is_active", "source_authority", "source_version", "cdc_sequence", "cdc_operation")


@query("P9_change_operation", """SELECT event_id, CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS op FROM events""")
def p9(spark, d):
    st = F.when(F.col("event_type") == "error", "DELETED").when(F.col("event_type") != "view", F.col("event_type"))
    return s.table(spark, d, "events").select("event_id", change_operation(st).alias("op"))


MAPPING = [
    submission.FieldMapping("firm_roe_id", "firmROEID", "OrderEvents", (), True),
    submission.FieldMapping("cat_event_code", "type", "OrderEvents", (), True),
    submission.FieldMapping("event_timestamp", "eventTimestamp", "OrderEvents", (), True),
    submission.FieldMapping("side", "side", "OrderEvents", ("MENO", "MECO")),
    submission.FieldMapping("quantity", "quantity", "OrderEvents", ("MENO", "MECO", "MEOR")),
    submission.FieldMapping("execution_quantity", "quantity", "OrderEvents", ("MEOT",)),
    submission.FieldMapping("execution_price", "price", "OrderEvents", ("MEOT", "MEOC")),
    submission.FieldMapping("event_date", "eventDate", "Allocations"),
]
LINE_SQL = """'{"firmROEID":"' || firm_roe_id || '","type":"' || cat_event_code || '","eventTimestamp":"' || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"'
  || CASE WHEN cat_event_code IN ('MENO','MECO') THEN ',"side":"' || side || '"' ELSE '' END
  || CASE WHEN cat_event_code IN ('MENO','MECO','MEOR') THEN ',"quantity":"' || quantity || '"' WHEN cat_event_code = 'MEOT' THEN ',"quantity":"' || execution_quantity || '"' ELSE '' END
  || CASE WHEN cat_event_code IN ('MEOT','MEOC') AND execution_price IS NOT NULL THEN ',"price":"' || execution_price || '"' ELSE '' END || '}'"""


def shaped(spark, d):
    return submission.shape_submission(s.order_events(spark, d), MAPPING, "OrderEvents")


@query("P10_shape_submission", s.with_stage("order_events", f"SELECT dv2_source_hk, {LINE_SQL} AS line FROM order_events"))
def p10(spark, d):
    return shaped(spark, d).select("dv2_source_hk", "line")


@query("P11_taxonomy_flags", s.with_stage("order_events", f"""
SELECT dv2_source_hk, CASE WHEN category LIKE '%\\_ALLOCATION' ESCAPE '\\' THEN 'Allocations' ELSE 'OrderEvents' END AS submission_file_type, category LIKE '%OPTION%' AS is_options FROM order_events JOIN {CODE_TYPES} USING (cat_event_code)"""))
def p11(spark, d):
    et = F.broadcast(dims.taxonomy_flags(seeds.load_taxonomy(spark)).withColumnRenamed("message_type", "cat_event_code").select("cat_event_code", "submission_file_type", "is_options"))
    return s.order_events(spark, d).select("dv2_source_hk", "cat_event_code").join(et, "cat_event_code").drop("cat_event_code")


@query("P12_masked_names", """SELECT c_custkey, sha256(lower(trim(c_name))) AS name_hash, true AS hashed, substr(c_name, 1, 4) AS prefix FROM customer""")
def p12(spark, d):
    out = s.table(spark, d, "customer").select("c_custkey", mask_hash("c_name").alias("name_hash"), F.substring("c_name", 1, 4).alias("prefix"))
    return out.withColumn("hashed", is_hashed("name_hash"))


def messages(spark, d):
    """Order and execution messages as tag maps."""
    li = s.lines(spark, d)

    def tag(*kv):
        return F.create_map(*[F.lit(x) if i % 2 == 0 else F.col(x).cast("string") for i, x in enumerate(kv)])

    order = li.select("fill_id", F.lit("35=D").alias("msg_type"), tag("11", "order_id", "38", "quantity", "44", "price", "54", "side", "1", "venue_id").alias("fields"))
    fill = li.select("fill_id", F.lit("35=8").alias("msg_type"), tag("17", "fill_id", "31", "price", "32", "quantity", "75", "settle_date", "44", "price").alias("fields"))
    return order.unionByName(fill)


@query("P13_message_tags", s.with_stage("lines_s", """
SELECT fill_id, CAST(order_id AS VARCHAR) AS client_order_id, CAST(quantity AS VARCHAR) AS order_quantity, CAST(price AS VARCHAR) AS limit_price, side, CAST(venue_id AS VARCHAR) AS account_id FROM lines_s"""))
def p13(spark, d):
    out = refdata.map_message_tags(messages(spark, d).filter("msg_type = '35=D'"), "order_event")
    return out.select("fill_id", "client_order_id", "order_quantity", "limit_price", "side", "account_id")


@query("P13_execution_tags", s.with_stage("lines_s", """
SELECT fill_id, fill_id AS cat_execution_id, CAST(price AS VARCHAR) AS execution_price, CAST(quantity AS VARCHAR) AS execution_quantity, CAST(settle_date AS VARCHAR) AS trade_date FROM lines_s"""))
def p13b(spark, d):
    out = refdata.map_message_tags(messages(spark, d).filter("msg_type = '35=8'"), "execution")
    return out.select("fill_id", "cat_execution_id", "execution_price", "execution_quantity", "trade_date")


@query("F4_price_improvement", s.with_stage("order_events", """
SELECT dv2_source_hk, CAST(CASE side WHEN 'BUY' THEN execution_price - price WHEN 'SELL' THEN price - execution_price END AS DOUBLE) AS price_improvement FROM order_events WHERE cat_event_code = 'MEOT'"""))
def f4(spark, d):
    from tradevault.functions.scalars import price_improvement

    return s.order_events(spark, d).filter("cat_event_code = 'MEOT'").select("dv2_source_hk", price_improvement("side", "execution_price", "price").alias("price_improvement"))


@query("F6_code_lists", """
SELECT event_id, unnest(string_split(CASE WHEN event_id % 2 = 0 THEN event_type || ',MARGIN' ELSE event_type END, ',')) AS account_type FROM events""")
def f6(spark, d):
    ev = s.table(spark, d, "events")
    t = F.when(F.col("event_id") % 2 == 0, F.concat("event_type", F.lit(", MARGIN,"))).otherwise(F.col("event_type"))
    return ev.select("event_id", F.explode(code_list(t)).alias("account_type"))


@query("F7_payload_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS VARCHAR) AS new_value FROM events""")
def f7(spark, d):
    ev = s.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    change = F.to_json(F.create_map(F.lit("k"), F.struct(F.col("k").cast("string").alias("old_value"), (F.col("k") + 1).cast("string").alias("new_value"))))
    return submission.corrected_fields(ev.withColumn("corrected_fields", change)).select("event_id", "k", "new_value")


# ---- option, multi-leg and strategy facts ------------------------------------------------------------------------------------

OPT = {"MENO": "MONO", "MECO": "MOCO", "MEOR": "MOOR", "MEOT": "MOOT", "MEOC": "MOPA"}


def option_tables(spark, d):
    ev = s.order_events(spark, d)
    link = ev.select(
        F.col("dv2_source_hk").alias("option_event_hk"), F.col("cat_order_id").alias("option_order_hk"), s.choose("cat_event_code", OPT).alias("event_code"), "event_timestamp"
    )
    sat = ev.select(F.col("dv2_source_hk").alias("option_event_hk"), F.col("quantity").alias("event_qty"), F.col("price").alias("event_price"), "fill_id", F.lit(None).cast("timestamp").alias("load_end_dts"))
    old = sat.withColumns({"load_end_dts": F.lit("2020-01-01").cast("timestamp"), "event_qty": F.lit(-1).cast("decimal(18,4)")})
    osat = s.orders(spark, d).select(F.col("order_id").cast("string").alias("option_order_hk"), "order_type", F.lit(None).cast("timestamp").alias("load_end_dts"))
    return link, sat.unionByName(old), osat


@query("G14_option_orders", s.with_stage("order_events", """
SELECT dv2_source_hk AS option_event_hk, CASE cat_event_code WHEN 'MENO' THEN 'MONO' WHEN 'MECO' THEN 'MOCO' ELSE 'MOOR' END AS cat_event_code, CAST(event_date AS VARCHAR) AS event_date,
  CAST(quantity AS DOUBLE) AS event_qty, e.order_type FROM order_events e WHERE cat_event_code IN ('MENO','MECO','MEOR')"""))
def g14(spark, d):
    link, sat, osat = option_tables(spark, d)
    return facts.option_fact(link, sat.drop("fill_id"), "option_order", osat).select(
        "option_event_hk", "cat_event_code", "event_date", "event_qty", "order_type"
    )


@query("G14_option_executions", s.with_stage("order_events", """
SELECT dv2_source_hk AS option_event_hk, 'MOOT' AS cat_event_code, CAST(quantity AS DOUBLE) AS event_qty, CAST(price AS DOUBLE) AS event_price FROM order_events WHERE cat_event_code = 'MEOT'"""))
def g14b(spark, d):
    link, sat, _ = option_tables(spark, d)
    return facts.option_fact(link, sat, "option_execution").select("option_event_hk", "cat_event_code", "event_qty", "event_price")


@query("G14_option_allocations", s.with_stage("order_events", """
SELECT dv2_source_hk AS option_event_hk, 'MOPA' AS cat_event_code, CAST(event_date AS VARCHAR) AS event_date, CAST(quantity AS DOUBLE) AS event_qty, fill_id FROM order_events WHERE cat_event_code = 'MEOC'"""))
def g14c(spark, d):
    link, sat, _ = option_tables(spark, d)
    return facts.option_fact(link, sat, "option_allocation").select("option_event_hk", "cat_event_code", "event_date", "event_qty", "fill_id")


OPTION_SQL = s.with_stage("order_events", """
SELECT CASE WHEN cat_event_code = 'MEOT' THEN 'execution' WHEN cat_event_code = 'MEOC' THEN 'allocation' ELSE 'order' END AS event_family, dv2_source_hk AS sk,
  CASE cat_event_code WHEN 'MENO' THEN 'MONO' WHEN 'MECO' THEN 'MOCO' WHEN 'MEOR' THEN 'MOOR' WHEN 'MEOT' THEN 'MOOT' ELSE 'MOPA' END AS cat_event_code,
  CASE WHEN cat_event_code IN ('MEOT','MEOC') THEN fill_id ELSE cat_order_id END AS related_id, CASE WHEN cat_event_code <> 'MEOT' THEN side END AS side, CAST(quantity AS DOUBLE) AS quantity FROM order_events""")


def option_view(spark, d):
    ev = s.order_events(spark, d, unsorted=True).withColumn("cat_event_code", s.choose("cat_event_code", OPT)).withColumns(
        {"sk": F.col("dv2_source_hk"), "event_dts": F.col("event_timestamp"), "option_id": F.col("instrument_id"), "trade_id": F.lit(None).cast("string"), "fulfillment_id": F.col("fill_id"), "allocation_id": F.col("fill_id")}
    )
    o, x, a = (facts.events_of(ev, k) for k in ("option_order", "option_execution", "option_allocation"))
    return views.option_lifecycle(o, x, a).select("event_family", "sk", "cat_event_code", "related_id", "side", "quantity")


query("U1_option_lifecycle", OPTION_SQL)(option_view)
query("V4_option_lifecycle", OPTION_SQL)(option_view)


def multileg_tables(spark, d):
    o, li = s.orders(spark, d), s.lines(spark, d)
    key = F.col("order_id").cast("string")
    none = F.lit(None).cast("timestamp").alias("load_end_dts")
    link = o.select(key.alias("multileg_event_hk"), key.alias("multileg_order_hk"), F.col("party_id").alias("sender_party_id"), F.lit("MLNO").alias("event_code"), F.col("order_ts").alias("event_timestamp"))
    esat = o.select(key.alias("multileg_event_hk"), none)
    osat = o.select(key.alias("multileg_order_hk"), F.col("order_total").alias("net_price"), F.lit(1).alias("order_quantity"), none)
    legs = li.select(F.col("order_id").cast("string").alias("multileg_order_hk"), F.col("fill_id").alias("multileg_leg_hk"), F.col("line_no").alias("leg_seq"), F.col("side").alias("leg_side"), F.lit(1).alias("leg_ratio"), F.col("instrument_id").alias("leg_instrument_id"))
    lsat = li.select(F.col("fill_id").alias("multileg_leg_hk"), F.col("quantity").alias("leg_quantity"), F.col("price").alias("leg_price"), none)
    return link, esat, osat, legs, lsat


def multileg_head(spark, d):
    link, esat, osat, legs, _ = multileg_tables(spark, d)
    cal = dims.dim_date(spark, "1994-01-01", "2003-12-31")
    return facts.multileg_headers(link, esat, osat, legs, stored_dim(spark, d, "party"), cal, mode="warn")


def multileg_facts(spark, d):
    _, _, _, legs, lsat = multileg_tables(spark, d)
    head = multileg_head(spark, d)
    good = head.filter(F.size("broken_rules") == 0)
    return head, facts.expand_legs(good.select("multileg_order_hk", "multileg_event_hk", "leg_count", F.lit(None).cast("long").alias("instrument_sk")), legs, lsat, stored_dim(spark, d, "instrument"))


@query("G15_multileg_headers", s.with_dims("orders_s lines_s", "party", """
WITH n AS (SELECT order_id, COUNT(*) AS leg_count FROM lines_s GROUP BY 1)
SELECT CAST(o.order_id AS VARCHAR) AS multileg_order_hk, leg_count, CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_sk, dim_party_sk AS party_sk, CAST(order_total AS DOUBLE) AS net_price,
  CASE WHEN leg_count < 2 THEN 'leg_count_at_least_2' WHEN leg_count > 50 THEN 'leg_count_capped' ELSE '' END AS broken
FROM orders_s o JOIN n USING (order_id) LEFT JOIN dim_party ON party_id = party_id_bk AND is_current"""))
def g15(spark, d):
    return multileg_head(spark, d).select("multileg_order_hk", "leg_count", "date_sk", "party_sk", "net_price", F.concat_ws(",", "broken_rules").alias("broken"))


@query("G15_multileg_legs", s.with_dims("lines_s", "instrument", """
WITH n AS (SELECT order_id, COUNT(*) AS leg_count FROM lines_s GROUP BY 1)
SELECT fill_id AS multileg_leg_hk, leg_count, side AS leg_side, CAST(quantity AS DOUBLE) AS leg_quantity, dim_instrument_sk AS instrument_sk, symbol AS leg_symbol
FROM lines_s JOIN n USING (order_id) JOIN dim_instrument ON instrument_id = instrument_id_bk AND is_current WHERE leg_count BETWEEN 2 AND 50"""))
def g15b(spark, d):
    return multileg_facts(spark, d)[1].select("multileg_leg_hk", "leg_count", "leg_side", "leg_quantity", "instrument_sk", "leg_symbol")


@query("J6_expand_legs", s.with_dims("lines_s", "instrument", """
SELECT fill_id AS multileg_leg_hk, CAST(order_id AS VARCHAR) AS multileg_order_hk, CAST(line_no AS BIGINT) AS leg_seq, dim_instrument_sk AS instrument_sk FROM lines_s JOIN dim_instrument ON instrument_id = instrument_id_bk AND is_current"""))
def j6(spark, d):
    link, _, _, legs, lsat = multileg_tables(spark, d)
    out = facts.expand_legs(link.select("multileg_order_hk", F.lit(None).alias("instrument_sk")), legs, lsat, stored_dim(spark, d, "instrument"))
    return out.select("multileg_leg_hk", "multileg_order_hk", "leg_seq", "instrument_sk")


STRATEGIES = [("SINGLE", 1, 1), ("VERTICAL", 2, 2), ("BUTTERFLY", 3, 4), ("CUSTOM", 4, 50), ("BASKET", 60, 100), ("INDEX", 90, None)]


@query("G18_strategy_match", s.with_stage("lines_s", """
WITH n AS (SELECT order_id, COUNT(*) AS leg_count FROM lines_s GROUP BY 1 UNION ALL SELECT -1 - instrument_id, COUNT(*) FROM lines_s GROUP BY 1)
SELECT order_id, leg_count, k AS multileg_strategy_bk FROM n
LEFT JOIN (VALUES ('SINGLE',1,1),('VERTICAL',2,2),('BUTTERFLY',3,4),('CUSTOM',4,50),('BASKET',60,100),('INDEX',90,NULL)) t(k,a,b) ON leg_count >= a AND leg_count <= coalesce(b, leg_count)"""))
def g18(spark, d):
    # orders have few lines; the baskets of one instrument's lines reach the bands above 50
    lines = s.lines(spark, d)
    head = lines.select("order_id").unionByName(lines.select((F.lit(-1) - F.col("instrument_id")).alias("order_id"))).groupBy("order_id").agg(F.count("*").alias("leg_count"))
    st = spark.createDataFrame(STRATEGIES, "multileg_strategy_bk string, leg_count_min int, leg_count_max int").withColumn("is_current", F.lit(True))
    return facts.match_strategy(head, st).select("order_id", "leg_count", "multileg_strategy_bk")


@query("V5_multileg_lifecycle", s.with_dims("orders_s lines_s", "party instrument", """
WITH n AS (SELECT order_id, COUNT(*) AS leg_count FROM lines_s GROUP BY 1)
SELECT CAST(o.order_id AS VARCHAR) AS multileg_order_hk, leg_count, legal_name AS party_name, 'Multi-Leg New Order' AS event_name, fill_id IS NOT NULL AS has_leg, side AS leg_side, CAST(price AS DOUBLE) AS leg_price, instrument_id AS leg_instrument
FROM orders_s o JOIN n USING (order_id) JOIN lines_s l USING (order_id) JOIN dim_party p ON party_id = party_id_bk AND p.is_current WHERE leg_count BETWEEN 2 AND 50"""))
def v5(spark, d):
    head, legs = multileg_facts(spark, d)
    out = views.multileg_lifecycle(head, legs, stored_dim(spark, d, "party"), dims.dim_event_type(spark), stored_dim(spark, d, "instrument"))
    return out.select("multileg_order_hk", "leg_count", "party_name", "event_name", F.lit(True).alias("has_leg"), "leg_side", "leg_price", "leg_instrument")


# ---- quality -----------------------------------------------------------------------------------------------------------------


def dirty(spark, d):
    k = F.col("instrument_id")
    return s.order_events(spark, d).withColumns(
        {
            "side": F.when(k % 17 == 0, F.lit(None)).when(k % 13 == 0, "HOLD").otherwise(F.col("side")),
            "cat_event_code": F.when(k % 11 == 0, F.lower("cat_event_code")).when(k % 19 == 0, F.lit(None)).otherwise(F.col("cat_event_code")),
        }
    )


DIRTY_SQL = """dirty AS (SELECT * REPLACE (CASE WHEN instrument_id % 17 = 0 THEN NULL WHEN instrument_id % 13 = 0 THEN 'HOLD' ELSE side END AS side,
  CASE WHEN instrument_id % 11 = 0 THEN lower(cat_event_code) WHEN instrument_id % 19 = 0 THEN NULL ELSE cat_event_code END AS cat_event_code) FROM order_events)"""
CODE_OK = "coalesce(regexp_matches(cat_event_code, '^[A-Z]{3,10}(_[A-Z])?$'), false)"
SIDE_OK = "coalesce(side IS NULL OR side IN ('BUY','SELL','SELL_SHORT','SELL_SHORT_EXEMPT'), false)"


@query("Q1_expectation_counts", s.with_stage("order_events", f"""
WITH {DIRTY_SQL} SELECT 'firm_roe_id_required' AS rule, 0 AS broken, COUNT(*) AS total FROM dirty UNION ALL SELECT 'dv2_source_hk_required', 0, COUNT(*) FROM dirty
UNION ALL SELECT 'cat_event_code_required', COUNT(*) FILTER (cat_event_code IS NULL), COUNT(*) FROM dirty UNION ALL SELECT 'event_timestamp_required', 0, COUNT(*) FROM dirty
UNION ALL SELECT 'event_date_required', 0, COUNT(*) FROM dirty UNION ALL SELECT 'cat_event_code_format', COUNT(*) FILTER (NOT {CODE_OK}), COUNT(*) FROM dirty
UNION ALL SELECT 'side_enum', COUNT(*) FILTER (NOT {SIDE_OK}), COUNT(*) FROM dirty"""))
def q1(spark, d):
    return quality.violations(dirty(spark, d), rules.ORDER_EVENT)


@query("Q1_expectation_drop", s.with_stage("order_events", f"WITH {DIRTY_SQL} SELECT dv2_source_hk FROM dirty WHERE {CODE_OK} AND {SIDE_OK}"))
def q1b(spark, d):
    return quality.expect(dirty(spark, d), rules.ORDER_EVENT, "drop").select("dv2_source_hk")


@query("Q1_expectation_quarantine", s.with_stage("order_events", f"""
WITH {DIRTY_SQL} SELECT dv2_source_hk, concat_ws(',', CASE WHEN cat_event_code IS NULL THEN 'cat_event_code_required' END, CASE WHEN NOT {CODE_OK} THEN 'cat_event_code_format' END,
  CASE WHEN NOT {SIDE_OK} THEN 'side_enum' END) AS broken FROM dirty WHERE NOT ({CODE_OK} AND {SIDE_OK})"""))
def q1c(spark, d):
    return quality.quarantine(dirty(spark, d), rules.ORDER_EVENT)[1].select("dv2_source_hk", F.concat_ws(",", "broken_rules").alias("broken"))


@query("Q2_rule_catalogue", """
SELECT 'supplier_code' AS checked, 0 AS broken_codes, COUNT(*) AS total, COUNT(*) FILTER (NOT regexp_matches(lpad(CAST(s_suppkey AS VARCHAR), 4, 'X'), '^[A-Z0-9]{4}$')) AS bad_format FROM supplier""")
def q2(spark, d):
    mic = s.table(spark, d, "supplier").select(
        F.lpad(F.col("s_suppkey").cast("string"), 4, "X").alias("mic_code"), F.col("s_name").alias("mic_name"), F.lit("US").alias("country_code"), F.lit("ACTIVE").alias("status")
    )
    stamped = seeds.with_audit(mic, "ISO_10383", "1", "x", F.lit("2026-01-01").cast("timestamp"))
    v = quality.violations(stamped, rules.rules_for("ref_mic", "mic_code", "mic_name"))
    return v.agg(
        F.sum(F.when(F.col("rule") == "code_not_null", F.col("broken"))).alias("broken_codes"), F.max("total").alias("total"),
        F.sum(F.when(F.col("rule") == "mic_code_4_upper_alnum", F.col("broken"))).alias("bad_format"),
    ).withColumn("checked", F.lit("supplier_code"))


@query("Q3_table_count", """SELECT COUNT(*) AS n, CASE WHEN COUNT(*) BETWEEN 25 AND 25 THEN 'PASS' ELSE 'FAIL' END AS outcome FROM nation""")
def q3(spark, d):
    return quality.count_band(s.table(spark, d, "nation"), 25, 25)


@query("Q5_fact_invariants", s.with_stage("order_events", f"""
WITH {DIRTY_SQL} SELECT 'firm_roe_id_required' AS rule, 0 AS broken, COUNT(*) AS total FROM dirty UNION ALL SELECT 'lineage_required', 0, COUNT(*) FROM dirty
UNION ALL SELECT 'code_required', COUNT(*) FILTER (cat_event_code IS NULL), COUNT(*) FROM dirty UNION ALL SELECT 'code_registered', COUNT(*) FILTER (cat_event_code IS NULL OR cat_event_code <> upper(cat_event_code)), COUNT(*) FROM dirty
UNION ALL SELECT 'event_date_matches', 0, COUNT(*) FROM dirty"""))
def q5(spark, d):
    return quality.fact_invariants(dirty(spark, d), dims.dim_event_type(spark))


@query("Q6_file_alignment", s.with_stage("order_events", f"""
WITH {DIRTY_SQL} SELECT cat_event_code, COUNT(*) AS n, CASE WHEN cat_event_code = upper(cat_event_code) THEN 'OrderEvents' END AS submission_file_type FROM dirty
WHERE cat_event_code IS NULL OR cat_event_code <> upper(cat_event_code) GROUP BY cat_event_code"""))
def q6(spark, d):
    return quality.misfiled(dirty(spark, d), dims.dim_event_type(spark), ["OrderEvents"])


@query("Q7_unresolved_keys", s.with_dims("fills", "party", """
SELECT DISTINCT dim_party_sk FROM fills JOIN dim_party ON party_id = party_id_bk AND order_date BETWEEN effective_start_date AND effective_end_date WHERE NOT is_current"""))
def q7(spark, d):
    p = stored_dim(spark, d, "party")
    f = interval.pit_lookup(s.fills(spark, d), p, "party_id", "party_id_bk", "order_date", {"dim_party_sk": "dim_party_sk"}, span=order_span(spark, d))
    return quality.unresolved_keys(f, p.filter("is_current"), "dim_party_sk", "dim_party_sk")


@query("Q7_point_in_time", s.with_dims("fills", "party", """
SELECT fill_id FROM fills f JOIN dim_party p ON party_id = party_id_bk AND is_current WHERE f.order_date < p.effective_start_date"""))
def q7b(spark, d):
    p = stored_dim(spark, d, "party")
    # the hash of a row passes both joins as bytes
    f = interval.current_lookup(s.fills(spark, d).withColumn("fill_id", narrow("fill_id")), p, "party_id", "party_id_bk", {"dim_party_sk": "dim_party_sk"})
    return quality.point_in_time_offenders(f, p, "dim_party_sk", "dim_party_sk", "order_date").select(widened("fill_id").alias("fill_id"))


@query("Q8_firm_registration", s.with_dims("order_events", "account", """
SELECT DISTINCT party_id, CAST(event_date AS VARCHAR) AS event_date FROM order_events e WHERE NOT EXISTS (SELECT 1 FROM (SELECT account_id_bk, effective_start_date + CAST(account_id_bk % 900 AS INTEGER) AS a, effective_end_date AS b FROM dim_account) r
  WHERE r.account_id_bk = e.party_id AND e.event_date BETWEEN a AND b)"""))
def q8(spark, d):
    reg = dim(spark, d, "account").select(
        F.col("account_id_bk").alias("party_id"), F.date_add("effective_start_date", (F.col("account_id_bk") % 900).cast("int")).alias("effective_start_date"), "effective_end_date"
    )
    return quality.unregistered_firms(s.order_events(spark, d), reg, "party_id", "event_date")


EVENT_STATUS = {"signup": "NEW", "view": "ACCEPTED", "click": "WORKING", "purchase": "PARTIALLY_FILLED", "error": "CANCELLED"}


def status_rows(spark, d):
    return s.table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), s.choose("event_type", EVENT_STATUS).alias("status"))


STATUS_MOVES = """m AS (SELECT event_id, status, lag(status) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_state FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'NEW' WHEN 'view' THEN 'ACCEPTED'
  WHEN 'click' THEN 'WORKING' WHEN 'purchase' THEN 'PARTIALLY_FILLED' ELSE 'CANCELLED' END AS status FROM events))"""
BAD_MOVES = f"""
WITH {STATUS_MOVES} SELECT event_id, from_state, status FROM m WHERE from_state IS DISTINCT FROM status AND NOT (from_state IS NULL AND status = 'NEW')
AND coalesce(from_state || '>' || status, '') NOT IN ('NEW>ACCEPTED', 'ACCEPTED>WORKING', 'WORKING>ACCEPTED', 'WORKING>PARTIALLY_FILLED', 'WORKING>CANCELLED', 'PARTIALLY_FILLED>CANCELLED')"""


@query("Q9_state_machine", BAD_MOVES)
def q9(spark, d):
    moves = quality.state_transitions(status_rows(spark, d), ["user_id"], ["ts", "event_id"])
    return quality.invalid_transitions(moves, states.edge_frame(spark), "order").select("event_id", "from_state", "status")


def machine_states(machine):
    """States of a machine in the order of its moves."""
    return list(dict.fromkeys(x for move in states.moves(machine) for x in move))


EVENT_ORDER = ["signup", "view", "click", "purchase", "error"]
FEED_SQL = ", ".join(f"('{m}', '{e}', '{machine_states(m)[i % len(machine_states(m))]}')" for m in states.machines() for i, e in enumerate(EVENT_ORDER))
EDGE_SQL = ", ".join(f"('{m}', {a}, '{b}')" for m in states.machines() for a, b in [("NULL", states.entry_state(m)), *[(f"'{x}'", y) for x, y in states.moves(m)]])


@query("Q9_all_machines", f"""
WITH feed(machine, event_type, status) AS (VALUES {FEED_SQL}), edge(machine, f, t) AS (VALUES {EDGE_SQL}),
m AS (SELECT machine, event_id, status, lag(status) OVER (PARTITION BY machine, user_id ORDER BY ts, event_id) AS from_state FROM events JOIN feed USING (event_type))
SELECT machine, from_state, status, COUNT(*) AS n FROM m WHERE from_state IS DISTINCT FROM status
AND NOT EXISTS (SELECT 1 FROM edge WHERE edge.machine = m.machine AND edge.f IS NOT DISTINCT FROM m.from_state AND edge.t = m.status) GROUP BY ALL""")
def q9_all(spark, d):
    """Every machine fed by the events: an event type stands for the machine's state of its place, and each feed is checked per user."""
    feed = small_frame(spark, ["machine", "event_type", "status"], [(m, e, machine_states(m)[i % len(machine_states(m))]) for m in states.machines() for i, e in enumerate(EVENT_ORDER)])
    ev = s.table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    moves = quality.state_transitions(ev.join(F.broadcast(feed), "event_type"), ["machine", "user_id"], ["ts", "event_id"])
    return quality.invalid_moves(moves, states.edge_frame(spark)).groupBy("machine", "from_state", "status").agg(F.count("*").alias("n"))


@query("Q10_clock_sync", """
SELECT event_type AS system_name, COUNT(*) AS readings, COUNT(*) FILTER (abs(off) > CASE WHEN user_id % 2 = 0 THEN 1000 ELSE 50 END) AS breaches, MAX(abs(off)) AS worst_offset_ms FROM (SELECT *, event_id % 2500 - 1200 AS off FROM events) GROUP BY 1""")
def q10(spark, d):
    ev = s.table(spark, d, "events").select(F.col("event_type").alias("system_name"), (F.col("event_id") % 2500 - 1200).alias("off"), (F.col("user_id") % 2 == 0).alias("manual"))
    return quality.clock_sync(ev, "off", "manual", ["system_name"])


@query("Q12_enumeration_membership", """SELECT event_type, COUNT(*) AS n FROM events WHERE event_type NOT IN ('click', 'view', 'signup') GROUP BY 1""")
def q12(spark, d):
    codes = s.table(spark, d, "events").filter("event_type in ('click', 'view', 'signup')")
    return quality.not_in_code_list(s.table(spark, d, "events"), "event_type", codes, "event_type")


@query("Q13_rate_check", """SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount > l_tax""")
def q13(spark, d):
    return quality.rate_above_default(s.table(spark, d, "lineitem"), "l_discount", "l_tax").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query("Q13_bad_quotes", s.with_stage("quotes", """
WITH q AS (SELECT quote_id, CASE return_flag WHEN 'N' THEN 'TWO_WAY' ELSE 'BID' END AS quote_side, CASE WHEN instrument_id % 7 <> 0 THEN bid_price END AS b, CASE WHEN instrument_id % 5 = 0 THEN ask_price - 1 ELSE ask_price END AS a FROM quotes)
SELECT quote_id, CASE WHEN quote_side = 'TWO_WAY' AND (b IS NULL OR a IS NULL) THEN 'MISSING_SIDE' WHEN b > a THEN 'CROSSED' END AS issue FROM q WHERE (quote_side = 'TWO_WAY' AND (b IS NULL OR a IS NULL)) OR b > a"""))
def q13b(spark, d):
    k = F.col("instrument_id")
    q = s.quotes(spark, d).withColumns(
        {"quote_side": F.when(F.col("return_flag") == "N", "TWO_WAY").otherwise("BID"), "bid_price": F.when(k % 7 != 0, F.col("bid_price")),
         "ask_price": F.when(k % 5 == 0, F.col("ask_price") - 1).otherwise(F.col("ask_price"))}
    )
    return quality.bad_quotes(q).select("quote_id", "issue")


# ---- integrity by metadata -------------------------------------------------------------------------------------------------------


def records_fact(spark, d):
    """A monthly record of each customer with its party and account, resolved at the date of the record."""
    days = F.explode(F.sequence(F.to_date(F.lit("1995-01-31")), F.to_date(F.lit("2001-07-31")), F.expr("interval 1 month")))
    rows = s.table(spark, d, "customer").select(F.col("c_custkey").alias("party_id"), F.col("c_custkey").alias("account_id"), days.alias("snapshot_date"))
    dm = dim_map(spark, d, "party", "account")
    return facts.resolve(rows, facts.standard_roles(dm, ["party", "account"]), "snapshot_date", ("1995-01-31", "2001-07-31"), stored=True)


def _missing(dim, day, rows, key):
    return f"(SELECT COUNT(*) FROM {rows} f WHERE NOT EXISTS (SELECT 1 FROM dim_{dim} x WHERE x.{dim}_id_bk = {key} AND {day} BETWEEN x.effective_start_date AND x.effective_end_date))"


QUOTE_DAY = "CAST(f.quote_ts AS DATE)"
PAIRS = {
    **{("order_events", n): _missing(n, "f.event_date", "order_events", f"f.{n}_id") for n in ("party", "instrument", "venue", "account", "desk", "trader")},
    ("allocations", "party"): _missing("party", "f.order_date", "fills", "f.party_id"), ("allocations", "instrument"): _missing("instrument", "f.order_date", "fills", "f.instrument_id"),
    ("allocations", "account"): _missing("account", "f.order_date", "fills", "f.party_id"), ("allocations", "desk"): _missing("desk", "f.order_date", "fills", "f.party_id % 25"),
    ("quotes", "party"): _missing("party", QUOTE_DAY, "quotes", "f.venue_id"), ("quotes", "instrument"): _missing("instrument", QUOTE_DAY, "quotes", "f.instrument_id"),
    ("quotes", "venue"): _missing("venue", QUOTE_DAY, "quotes", "f.venue_id"), ("quotes", "trader"): _missing("trader", QUOTE_DAY, "quotes", "f.venue_id"),
    **{("customer_records", n): _missing(n, "f.day", "records", "f.c_custkey") for n in ("party", "account")},
}


@query("Q7_integrity_matrix", s.with_dims("order_events fills quotes", "party instrument venue account desk trader", """
WITH records AS (SELECT c_custkey, CAST(unnest([last_day(CAST(m AS DATE)) FOR m IN range(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)]) AS DATE) AS day FROM customer),
nulls(fact, dimension, n) AS (""" + " UNION ALL ".join(f"SELECT '{f}', '{dim}', {q}" for (f, dim), q in PAIRS.items()) + """)
SELECT fact, dimension, c AS "check", CASE WHEN c = 'null_key' THEN n ELSE 0 END AS n FROM nulls, (VALUES ('null_key'), ('unknown_key'), ('not_in_force')) u(c)"""))
def q7c(spark, d):
    from tradevault.demo.q_gold import allocation_rows, quote_rows
    from tradevault.plans.integrity import integrity_matrix, key_columns

    dm = dim_map(spark, d, *ALL_DIMS)
    built = {"order_events": lambda sp, dd: order_fact(sp, dd, dm), "customer_records": records_fact, "allocations": allocation_rows, "quotes": quote_rows}
    # every row of each fact, with the keys and the date that the checks read
    kept = {n: s.stored(spark, d, f"keys_{n}", lambda sp, dd, n=n: built[n](sp, dd).select(*key_columns(n))) for n in built}
    return integrity_matrix(kept, dm)


@query("J8_relationship_report", s.with_stage("lines_s", """
SELECT 'order_route.order_event_id' AS relationship, 'order_event' AS target, 'orphans' AS "check", COUNT(DISTINCT order_id) AS n FROM lines_s WHERE order_id % 7 = 0
UNION ALL SELECT 'execution.order_event_id', 'order_event', 'orphans', COUNT(DISTINCT order_id) FROM lines_s WHERE order_id % 7 = 0
UNION ALL SELECT 'allocation.execution_id', 'execution', 'orphans', COUNT(*) FROM lines_s WHERE side = 'SELL'"""))
def j8b(spark, d):
    from tradevault.plans.integrity import relationship_report

    li = s.lines(spark, d)
    tables_ = {
        "order_event": s.orders(spark, d).filter("order_id % 7 <> 0").select(F.col("order_id").alias("order_event_id")),
        "order_route": li.select(F.col("order_id").alias("order_event_id")),
        "execution": li.filter("side <> 'SELL'").select(F.col("fill_id").alias("execution_id")),
        "allocation": li.select(F.col("fill_id").alias("execution_id")),
    }
    report = relationship_report(tables_)
    more = relationship_report({"order_event": tables_["order_event"], "execution": li.select(F.col("order_id").alias("order_event_id"))})
    return report.unionByName(more)
