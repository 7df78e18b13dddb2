"""Registered queries: vault loading, satellites, point-in-time tables, keys and type-2 operators."""

from pyspark.sql import functions as F

from tradevault.demo import stage as s
from tradevault.demo.registry import query
from tradevault.functions.hashing import hash_key, link_key, row_hash, surrogate_key
from tradevault.operators import joins, quality, scd2, vault
from tradevault.plans import vault_load
from tradevault.plans.facts import current_rows, open_roles
from tradevault.session import work_dir

TS = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}"


def ts(c):
    return TS.format(c=c)


def status_stage(spark, d):
    """Account status rows from events."""
    return s.table(spark, d, "events").select(
        hash_key(["user_id"], "ACCOUNT_MASTER").alias("account_hk"), "user_id", F.col("ts").cast("timestamp").alias("load_date"),
        "event_id", F.col("event_type").alias("account_status"), (F.col("event_id") % 4).alias("slot"), "value", "props",
    )


SAT_STAGE = """st AS (SELECT sha256(user_id || '||account_master') AS account_hk, user_id, ts AS load_date, event_id, event_type AS account_status,
  event_id % 4 AS slot FROM events)"""


@query("F1_hash_keys", """
SELECT event_id, sha256(coalesce(lower(trim(CAST(user_id AS VARCHAR))), '__NULL__') || '||' || coalesce(lower(trim(CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END)), '__NULL__')) AS hk,
  sha256(coalesce(CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END, '') || '|' || CAST(user_id AS VARCHAR)) AS rh
FROM events""")
def f1(spark, d):
    ev = s.table(spark, d, "events").withColumn("t", F.when(F.col("event_id") % 5 != 0, F.col("event_type")))
    return ev.select("event_id", hash_key(["user_id", "t"]).alias("hk"), row_hash(["t", "user_id"]).alias("rh"))


@query("G10_surrogate_keys", """
SELECT o_orderkey, CAST('0x' || substr(sha256(o_orderkey || '|' || CAST(o_orderdate AS DATE)), 1, 15) AS BIGINT) AS sk FROM orders""")
def g10(spark, d):
    o = s.table(spark, d, "orders").withColumn("start", F.to_date("o_orderdate"))
    return o.select("o_orderkey", surrogate_key(["o_orderkey", "start"]).alias("sk"))


@query("DV1_hub_load", s.with_stage("orders_s", f"""
SELECT order_hk, order_bk, {ts('load_date')}, 'OMS_ORDER' AS record_source FROM (
  SELECT sha256(party_id || '||oms_order') AS order_hk, CAST(party_id AS VARCHAR) AS order_bk, MIN(order_ts) AS load_date FROM orders_s GROUP BY ALL)
WHERE order_hk NOT IN (SELECT sha256(party_id || '||oms_order') FROM orders_s WHERE order_status = 'FILLED' AND party_id % 3 = 0)"""))
def dv1(spark, d):
    st = s.orders(spark, d).withColumnRenamed("order_ts", "load_date")
    old = vault.load_hub(st.filter("order_status = 'FILLED' and party_id % 3 = 0"), "order", ["party_id"], "OMS_ORDER")
    return vault.load_hub(st, "order", ["party_id"], "OMS_ORDER", existing=old)


def link_stage(spark, d):
    return s.fills(spark, d).select(
        hash_key(["order_id"], "OMS_ORDER").alias("order_hk"), hash_key(["party_id"], "KYC_SYSTEM").alias("party_hk"),
        hash_key(["instrument_id"], "SECURITY_MASTER").alias("instrument_hk"), hash_key(["venue_id"], "KYC_SYSTEM").alias("other_party_hk"),
        F.col("fill_ts").alias("load_date"),
    )


LINK_SQL = """ls AS (SELECT sha256(order_id || '||oms_order') AS order_hk, sha256(party_id || '||kyc_system') AS party_hk,
  sha256(instrument_id || '||security_master') AS instrument_hk, sha256(venue_id || '||kyc_system') AS other_party_hk, fill_ts AS load_date FROM fills)"""


@query("DV2_link_load_three_way", s.with_stage("fills", f"""
WITH {LINK_SQL} SELECT sha256(order_hk || '||' || party_hk || '||' || instrument_hk) AS link_hk, order_hk, party_hk, instrument_hk,
  strftime(MIN(load_date), '%Y-%m-%d %H:%M:%S.%f') AS load_date, 'TRADE_CAPTURE' AS record_source FROM ls GROUP BY ALL"""))
def dv2(spark, d):
    m = {c: c for c in ("order_hk", "party_hk", "instrument_hk")}
    return vault.load_link(link_stage(spark, d), "link", m, "TRADE_CAPTURE")


@query("DV2_link_load_self", s.with_stage("fills", f"""
WITH {LINK_SQL} SELECT sha256(party_hk || '||' || other_party_hk) AS link_hk, party_hk AS parent_party_hk, other_party_hk AS child_party_hk,
  strftime(MIN(load_date), '%Y-%m-%d %H:%M:%S.%f') AS load_date FROM ls GROUP BY party_hk, other_party_hk"""))
def dv2b(spark, d):
    m = {"parent_party_hk": "party_hk", "child_party_hk": "other_party_hk"}
    return vault.load_link(link_stage(spark, d), "link", m, "KYC_SYSTEM").drop("record_source")


@query("DV3_satellite_load", f"""
WITH {SAT_STAGE}, l AS (SELECT *, lag(account_status) OVER (PARTITION BY account_hk ORDER BY load_date, event_id) AS before FROM st)
SELECT account_hk, {ts('load_date')}, sha256(account_status) AS hash_diff, account_status FROM l WHERE before IS DISTINCT FROM account_status""")
def dv3(spark, d):
    return vault.load_sat(status_stage(spark, d), "account_hk", ["account_status"], tie=["event_id"]).select(
        "account_hk", "load_date", "hash_diff", "account_status"
    )


@query("DV3_satellite_increment", f"""
WITH {SAT_STAGE}, l AS (SELECT *, lag(account_status) OVER (PARTITION BY account_hk ORDER BY load_date, event_id) AS before FROM st)
SELECT account_hk, {ts('load_date')}, account_status FROM l WHERE before IS DISTINCT FROM account_status AND load_date >= TIMESTAMP '2024-01-15'""")
def dv3b(spark, d):
    st = status_stage(spark, d)
    day = F.lit("2024-01-15").cast("timestamp")
    old = vault.load_sat(st.filter(F.col("load_date") < day), "account_hk", ["account_status"], tie=["event_id"])
    new = vault.load_sat(st.filter(F.col("load_date") >= day), "account_hk", ["account_status"], tie=["event_id"], existing=old.drop("event_id"))
    return new.select("account_hk", "load_date", "account_status")


@query("DV4_append_satellite", f"""
WITH {SAT_STAGE} SELECT DISTINCT account_hk, {ts('load_date')}, sha256(account_status) AS hash_diff FROM st WHERE slot <> 1""")
def dv4(spark, d):
    st = status_stage(spark, d).withColumn("hash_diff", row_hash(["account_status"]))
    return vault.append_sat(st, st.filter("slot = 1"), ["account_hk", "load_date"]).select("account_hk", "load_date", "hash_diff")


@query("DV5_multi_active_satellite", f"""
WITH {SAT_STAGE}, l AS (SELECT *, lag(account_status) OVER (PARTITION BY account_hk, slot ORDER BY load_date, event_id) AS before FROM st)
SELECT account_hk, slot, {ts('load_date')}, account_status FROM l WHERE before IS DISTINCT FROM account_status""")
def dv5(spark, d):
    return vault.load_sat(
        status_stage(spark, d), "account_hk", ["account_status"], sub_keys=["slot"], tie=["event_id"]
    ).select("account_hk", "slot", "load_date", "account_status")


@query("DV6_link_satellite", s.with_stage("fills", """
SELECT sha256(fill_id || '||' || order_id) AS link_hk, strftime(fill_ts, '%Y-%m-%d %H:%M:%S.%f') AS load_date,
  row_number() OVER w AS fill_sequence, CAST(SUM(quantity) OVER w AS DOUBLE) AS cumulative_qty
FROM fills WINDOW w AS (PARTITION BY order_id ORDER BY fill_ts, fill_id ROWS UNBOUNDED PRECEDING)"""))
def dv6(spark, d):
    from tradevault.functions.ordered import in_order

    lines = s.lines(spark, d)
    rows = in_order(
        s.fills(spark, d), ["order_id"], ["fill_ts", "fill_id"], number="fill_sequence", running={"cumulative_qty": "quantity"}, sizes=lines.select("order_id")
    ).withColumn("link_hk", link_key(["fill_id", "order_id"]))
    ids = lines.select(link_key(["fill_id", "order_id"]).alias("link_hk"))
    return vault.load_sat(rows, "link_hk", ["fill_sequence", "cumulative_qty"], load="fill_ts", sizes=ids).select(
        "link_hk", "load_date", "fill_sequence", "cumulative_qty"
    )


SNAPS = ["2024-01-05", "2024-01-15", "2024-01-25"]


def snaps():
    return F.array(*[F.to_date(F.lit(x)) for x in SNAPS])


def pit_inputs(spark, d):
    st = status_stage(spark, d)
    hub = vault.load_hub(st.withColumn("account_bk", F.col("user_id")), "account", ["account_bk"], "ACCOUNT_MASTER")
    status = vault.load_sat(st, "account_hk", ["account_status"], tie=["event_id"]).drop("event_id")
    detail = vault.load_sat(st.filter("slot = 0").withColumn("k", F.get_json_object("props", "$.k")), "account_hk", ["k"], tie=["event_id"]).drop("event_id")
    return hub, status, detail


PIT_SQL = SAT_STAGE + """, hub AS (SELECT DISTINCT account_hk, CAST(user_id AS VARCHAR) AS account_bk FROM st),
l AS (SELECT *, lag(account_status) OVER (PARTITION BY account_hk ORDER BY load_date, event_id) AS before FROM st),
status AS (SELECT account_hk, load_date, account_status FROM l WHERE before IS DISTINCT FROM account_status),
d0 AS (SELECT sha256(user_id || '||account_master') AS account_hk, ts AS load_date, event_id, json_extract_string(props, '$.k') AS k FROM events WHERE event_id % 4 = 0),
d1 AS (SELECT *, lag(k) OVER (PARTITION BY account_hk ORDER BY load_date, event_id) AS before FROM d0),
detail AS (SELECT account_hk, load_date, k FROM d1 WHERE before IS DISTINCT FROM k),
snap(snapshot_date) AS (VALUES (DATE '2024-01-05'), (DATE '2024-01-15'), (DATE '2024-01-25')),
pit AS (SELECT h.account_hk, snapshot_date,
  (SELECT MAX(load_date) FROM status x WHERE x.account_hk = h.account_hk AND x.load_date < CAST(snapshot_date + 1 AS TIMESTAMP)) AS status_load_date,
  (SELECT MAX(load_date) FROM detail x WHERE x.account_hk = h.account_hk AND x.load_date < CAST(snapshot_date + 1 AS TIMESTAMP)) AS detail_load_date
  FROM hub h CROSS JOIN snap)"""


@query("DV7_point_in_time_table", f"""
WITH {PIT_SQL} SELECT account_hk, CAST(snapshot_date AS VARCHAR) AS snapshot_date, {ts('status_load_date')}, {ts('detail_load_date')} FROM pit""")
def dv7(spark, d):
    hub, status, detail = pit_inputs(spark, d)
    return vault.build_pit(hub, "account_hk", {"status": status, "detail": detail}, snaps())


@query("DV8_pit_retention", f"""
WITH {PIT_SQL} SELECT account_hk, CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM pit WHERE snapshot_date > DATE '2024-01-28' - 7""")
def dv8(spark, d):
    hub, status, _ = pit_inputs(spark, d)
    pit = vault.build_pit(hub, "account_hk", {"status": status}, snaps())
    return vault.retain(pit, F.lit("2024-01-28")).select("account_hk", "snapshot_date")


@query("DV9_as_of_read", f"""
WITH {PIT_SQL} SELECT account_bk, account_status, k FROM pit JOIN hub USING (account_hk)
JOIN status s ON s.account_hk = pit.account_hk AND s.load_date = status_load_date
LEFT JOIN detail x ON x.account_hk = pit.account_hk AND x.load_date = detail_load_date WHERE snapshot_date = DATE '2024-01-15'""")
def dv9(spark, d):
    hub, status, detail = pit_inputs(spark, d)
    pit = vault.build_pit(hub, "account_hk", {"status": status, "detail": detail}, snaps())
    out = vault.as_of(
        hub.drop("load_date", "record_source"), "account_hk", pit, {"status": status, "detail": detail}, mandatory=["status"],
        date=F.to_date(F.lit("2024-01-15")),
    )
    return out.select("account_bk", "account_status", "k")


@query("J1_assemble_entity", f"""
WITH {PIT_SQL} SELECT account_bk, CAST(snapshot_date AS VARCHAR) AS snapshot_date, account_status, k FROM pit JOIN hub USING (account_hk)
JOIN status s ON s.account_hk = pit.account_hk AND s.load_date = status_load_date
LEFT JOIN detail x ON x.account_hk = pit.account_hk AND x.load_date = detail_load_date""")
def j1(spark, d):
    hub, status, detail = pit_inputs(spark, d)
    pit = vault.build_pit(hub, "account_hk", {"status": status, "detail": detail}, snaps())
    out = joins.assemble_entity(
        hub.select("account_hk", "account_bk"), pit, "account_hk", {"status": status.drop("hash_diff")}, {"detail": detail.drop("hash_diff")}
    )
    return out.select("account_bk", "snapshot_date", "account_status", "k")


@query("DV10_reference_load", """
SELECT n_nationkey, n_name, sha256(n_name || '|' || n_regionkey) AS hash_diff, 'ISO_10383_MIC' AS record_source, '2026-01-01 00:00:00.000000' AS load_date FROM nation""")
def dv10(spark, d):
    n = s.table(spark, d, "nation")
    out = vault.load_ref(n, ["n_name", "n_regionkey"], "ISO_10383_MIC", F.lit("2026-01-01").cast("timestamp"))
    return out.select("n_nationkey", "n_name", "hash_diff", "record_source", "load_date")


@query("DV10_reference_hub", """
SELECT sha256(lower(n_name) || '||iso') AS n_name_hk, n_name, CASE WHEN n_regionkey < 2 THEN '2025-01-01 00:00:00.000000' ELSE '2026-01-01 00:00:00.000000' END AS load_date, 'ISO' AS record_source FROM nation""")
def dv10b(spark, d):
    """A first load of some regions' codes, then all codes: only the new ones are added."""
    n = s.table(spark, d, "nation")
    first = vault.load_ref_hub(n.filter("n_regionkey < 2"), "n_name", "ISO", F.lit("2025-01-01").cast("timestamp"))
    return first.unionByName(vault.load_ref_hub(n, "n_name", "ISO", F.lit("2026-01-01").cast("timestamp"), first))


@query("G6_dim_account_from_vault", f"""
WITH ch AS (SELECT user_id, CAST(ts AS DATE) AS change_date, event_id AS seq, event_type AS account_status FROM events), {s.scd2_sql('v', 'ch', 'user_id', ['account_status'])}
SELECT user_id, account_status, CAST(effective_start_date AS VARCHAR) AS effective_start_date, CAST(effective_end_date AS VARCHAR) AS effective_end_date, is_current, row_hash FROM v""")
def g6_vault(spark, d):
    """Hub, satellite and daily point-in-time table, put together by load time, become the account's type-2 versions."""
    st = status_stage(spark, d)
    hub = vault.load_hub(st.withColumn("account_bk", F.col("user_id")), "account", ["account_bk"], "ACCOUNT_MASTER")
    sat = vault.load_sat(st, "account_hk", ["account_status"], tie=["event_id"]).select("account_hk", "load_date", "hash_diff", "account_status")
    lo, hi = st.agg(F.min(F.to_date("load_date")), F.max(F.to_date("load_date"))).first()
    if lo is None:
        lo = hi = SNAPS[0]
    days = F.sequence(F.to_date(F.lit(str(lo))), F.to_date(F.lit(str(hi))))
    pit = vault.build_pit(hub, "account_hk", {"sat_account_status": sat}, days)
    daily = joins.assemble_entity(hub.drop("load_date", "record_source"), pit, "account_hk", {"sat_account_status": sat})
    feed = daily.select(F.col("account_bk").cast("long").alias("user_id"), "account_status", F.col("snapshot_date").alias("change_date"))
    return scd2.scd2_build(feed, ["user_id"], "change_date", ["change_date"], ["account_status"])


@query("DV11_rebuild", s.with_stage("fills", f"""
WITH {SAT_STAGE}, l AS (SELECT *, lag(account_status) OVER (PARTITION BY account_hk ORDER BY load_date) AS before FROM st)
SELECT 'hub_account' AS table_name, COUNT(DISTINCT user_id) AS n FROM events
UNION ALL SELECT 'hub_order', COUNT(DISTINCT order_id) FROM fills
UNION ALL SELECT 'hub_execution', COUNT(DISTINCT fill_id) FROM fills
UNION ALL SELECT 'sat_account_status', COUNT(*) FROM l WHERE before IS DISTINCT FROM account_status
UNION ALL SELECT 'link_execution_order', COUNT(*) FROM fills
UNION ALL SELECT 'pit_account', 3 * COUNT(DISTINCT user_id) FROM events"""))
def dv11(spark, d):
    st = status_stage(spark, d).withColumn("account_bk", F.col("user_id"))
    f = s.fills(spark, d).select(
        F.col("order_id").alias("order_bk"), F.col("fill_id").alias("execution_bk"), F.col("fill_ts").alias("load_date"),
        hash_key(["order_id"], "STAGE").alias("order_hk"), hash_key(["fill_id"], "STAGE").alias("execution_hk"),
    )
    stages = {"hub_account": st, "hub_order": f, "hub_execution": f, "sat_account_status": st, "link_execution_order": f}
    out = work_dir(spark, "vault")
    names = vault_load.rebuild(spark, stages, out, snaps(), {"hub_account": "ACCOUNT_MASTER"})
    return vault_load.row_counts(spark, out, names)


# ---- satellites and type-2 operators ---------------------------------------------------------------------------------


@query("W4_end_date_satellite", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS load_date, strftime(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), '%Y-%m-%d %H:%M:%S.%f') AS load_end_date FROM events""")
def w4(spark, d):
    return scd2.end_date_sat(status_stage(spark, d), ["user_id"]).select("event_id", "load_date", "load_end_date")


@query("P2_current_rows", """
SELECT user_id, event_type AS account_status FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS e FROM events) WHERE e IS NULL""")
def p2(spark, d):
    return current_rows(scd2.end_date_sat(status_stage(spark, d), ["user_id"]), "load_end_date").select("user_id", "account_status")


@query("P3_open_roles", s.with_stage("lines_s", """
SELECT fill_id FROM lines_s WHERE settlement_status = 'FAILED'"""))
def p3(spark, d):
    roles = s.lines(spark, d).withColumn("role_end_date", F.when(F.col("settlement_status") == "SETTLED", F.col("settle_date")))
    return open_roles(roles, "role_end_date").select("fill_id")


CHANGES_SQL = """ch AS (SELECT user_id, CAST(ts AS DATE) AS change_date, event_id AS seq, event_type,
  CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS op FROM events)"""


def changes(spark, d):
    return s.table(spark, d, "events").select(
        "user_id", F.to_date("ts").alias("change_date"), F.col("event_id").alias("seq"), "event_type",
        F.when(F.col("event_type") == "error", "DELETE").otherwise("UPSERT").alias("op"),
    )


V_SQL = f"""
WITH {CHANGES_SQL}, {s.scd2_sql('v', 'ch', 'user_id', ['event_type'], op='op')}
SELECT user_id, event_type, CAST(effective_start_date AS VARCHAR) AS effective_start_date, CAST(effective_end_date AS VARCHAR) AS effective_end_date,
  is_current, row_hash FROM v"""


@query("W3_scd2_build", V_SQL)
def w3(spark, d):
    return scd2.scd2_build(changes(spark, d), ["user_id"], "change_date", ["seq"], ["event_type"], op_col="op")


@query("G9_scd2_upsert", V_SQL)
def g9(spark, d):
    ch = changes(spark, d)
    cut = F.to_date(F.lit("2024-01-16"))
    old = scd2.scd2_build(ch.filter(F.col("change_date") < cut), ["user_id"], "change_date", ["seq"], ["event_type"], op_col="op")
    return scd2.scd2_upsert(old, ch.filter(F.col("change_date") >= cut), ["user_id"], ["event_type"])


@query("G9_scd2_late_changes", V_SQL)
def g9b(spark, d):
    """Odd change ids arrive late; the retained day-grain history lets them split published versions."""
    ch = changes(spark, d)
    first, late = ch.filter("seq % 2 = 0"), ch.filter("seq % 2 = 1")
    old = scd2.scd2_build(first, ["user_id"], "change_date", ["seq"], ["event_type"], op_col="op")
    return scd2.scd2_upsert(old, late, ["user_id"], ["event_type"], history=first)


@query("W11_latest_by_key", """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def w11(spark, d):
    return scd2.latest_by(s.table(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


# ---- integrity of keys and windows -------------------------------------------------------------------------------------


@query("Q4_scd2_invariants", s.with_dims("", "account", """
SELECT r AS rule, 0 AS broken, (SELECT COUNT(*) FROM dim_account) AS total FROM (VALUES ('one_current_row'), ('row_hash_64'), ('start_not_after_end'),
  ('closed_row_bounded'), ('key_not_null'), ('lineage_not_null'), ('no_overlap')) t(r)"""))
def q4(spark, d):
    from tradevault.demo.q_gold import dim

    return quality.scd2_invariants(dim(spark, d, "account"), "account_id_bk")


@query("Q11_vault_gates", f"""
WITH {SAT_STAGE} SELECT 'bad_hub_keys' AS gate, 0 AS n UNION ALL SELECT 'bad_link_keys', 0 UNION ALL SELECT 'sat_without_parent', COUNT(DISTINCT account_hk) FROM st
  WHERE slot = 3 AND account_hk NOT IN (SELECT account_hk FROM st WHERE slot < 3)
UNION ALL SELECT 'missing_snapshots', COUNT(DISTINCT account_hk) FROM st WHERE slot < 3""")
def q11(spark, d):
    st = status_stage(spark, d).withColumn("account_bk", F.col("user_id"))
    hub = vault.load_hub(st.filter("slot < 3"), "account", ["account_bk"], "ACCOUNT_MASTER")
    pit = vault.build_pit(hub, "account_hk", {"s": st}, snaps())
    link = vault.load_link(link_stage(spark, d), "link", {"order_hk": "order_hk", "party_hk": "party_hk"}, "X")
    parts = {
        "bad_hub_keys": quality.bad_hub_keys(hub, "account"),
        "bad_link_keys": quality.bad_link_keys(link, "link_hk", ["order_hk", "party_hk"]),
        "sat_without_parent": joins.orphans(st.filter("slot = 3"), hub, {"account_hk": "account_hk"}),
        "missing_snapshots": quality.missing_snapshots(hub, pit, "account_hk", F.to_date(F.lit("2024-01-06"))),
    }
    out = None
    for name, df in parts.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("gate"), "n")
        out = row if out is None else out.unionByName(row)
    return out
