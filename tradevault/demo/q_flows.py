"""Registered queries: customer-account flows, submission files, feedback, code lists and streams."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradevault.demo import stage as s
from tradevault.demo.q_gold import stored_dim
from tradevault.demo.q_ops import BAD_MOVES, LINE_SQL, MAPPING, status_rows
from tradevault.demo.q_vault import V_SQL
from tradevault.demo.registry import ORACLE, query
from tradevault.functions.hashing import hash_key, row_hash
from tradevault.operators import interval
from tradevault.plans import accounts, dims, refdata, states, submission, views
from tradevault.session import work_dir
from tradevault.sources import files, tables, tracked
from tradevault.sources.named_files import written_files
from tradevault.streaming import flows, moves, rollup

# ---- account data from customers and orders ------------------------------------------------------------------------------------

ROLE = {"1-URGENT": "TRDHOLDER", "2-HIGH": "NTHOLDER", "3-MEDIUM": "AUTH3RD", "4-NOT SPECIFIED": "AUTHREP", "5-LOW": "TRDHOLDER"}


def fhk(col):
    return hash_key([F.lit(7), col])


def hub_fdid(spark, d):
    return s.table(spark, d, "customer").select(
        fhk("c_custkey").alias("cais_fdid_hk"), F.col("c_custkey").alias("firm_designated_id"), F.lit(7).cast("long").alias("cat_reporter_crd")
    )


def fdid_state(spark, d):
    ended = F.col("c_acctbal") < 0
    return s.table(spark, d, "customer").select(
        fhk("c_custkey").alias("cais_fdid_hk"), F.lit("ACCOUNT").alias("fdid_type"), F.to_date(F.lit("2000-01-01")).alias("fdid_date"),
        F.when(ended, F.to_date(F.lit("2003-01-01"))).alias("fdid_end_date"), F.when(ended, "ENDED").alias("fdid_end_reason"),
        F.lit(None).cast("timestamp").alias("load_end_dts"),
    )


def roles(spark, d):
    """One role row per order: the account is the customer, the holder one of seven records of it."""
    o = s.table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"), fhk("o_custkey").alias("cais_fdid_hk"), F.col("o_custkey").alias("fdid"),
        F.concat_ws("-", "o_custkey", F.col("o_orderkey") % 7).alias("customer_record_id"),
        hash_key([F.concat_ws("-", "o_custkey", F.col("o_orderkey") % 7)]).alias("cais_customer_hk"),
        s.choose("o_orderpriority", ROLE).alias("customer_role"), F.to_date("o_orderdate").alias("role_start_date"),
        F.when(F.col("o_orderstatus") == "P", F.to_date("o_orderdate")).alias("role_end_date"), F.lit(None).cast("string").alias("role_end_reason"),
        F.col("o_orderstatus").alias("st"),
    )


ROLES_SQL = """r AS (SELECT o_orderkey AS order_id, o_custkey AS fdid, sha256('7||' || o_custkey) AS cais_fdid_hk, o_custkey || '-' || (o_orderkey % 7) AS customer_record_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'TRDHOLDER' WHEN '2-HIGH' THEN 'NTHOLDER' WHEN '3-MEDIUM' THEN 'AUTH3RD' WHEN '4-NOT SPECIFIED' THEN 'AUTHREP' ELSE 'TRDHOLDER' END AS customer_role,
  CAST(o_orderdate AS DATE) AS role_start_date, CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) END AS role_end_date, o_orderstatus AS st FROM orders)"""


@query("C1_account_snapshot", f"""
WITH {ROLES_SQL}, o AS (SELECT fdid, COUNT(*) AS n, bool_or(customer_role = 'TRDHOLDER') AS t FROM r WHERE role_end_date IS NULL GROUP BY 1), l AS (SELECT DISTINCT fdid FROM r WHERE st = 'O' AND order_id % 3 = 0)
SELECT c_custkey AS firm_designated_id, coalesce(n, 0) AS customer_count, coalesce(t, false) AS has_active_trdholder, c_custkey IN (SELECT fdid FROM l) AS has_active_ltid, '2003-06-30' AS as_of_date,
  CASE WHEN coalesce(t, false) OR c_acctbal < 0 THEN '' ELSE 'trdholder_required' END AS broken FROM customer LEFT JOIN o ON fdid = c_custkey""")
def c1(spark, d):
    r = roles(spark, d)
    lt = r.filter("order_id % 3 = 0").select("cais_fdid_hk", F.when(F.col("st") != "O", F.col("role_start_date")).alias("ltid_end_date"))
    out = accounts.account_snapshot(hub_fdid(spark, d), fdid_state(spark, d), r, lt, "2003-06-30", mode="warn")
    return out.select("firm_designated_id", "customer_count", "has_active_trdholder", "has_active_ltid", "as_of_date", F.concat_ws(",", "broken_rules").alias("broken"))


@query("C2_customer_snapshot", f"""
WITH {ROLES_SQL} SELECT customer_record_id, COUNT(*) FILTER (role_end_date IS NULL) AS fdid_count, CASE WHEN fdid % 2 = 0 THEN 'NATURAL_PERSON' ELSE 'LEGAL_ENTITY' END AS customer_type, true AS has_pii_in_tid,
  CASE WHEN COUNT(*) FILTER (role_end_date IS NULL) >= 1 THEN '' ELSE 'must_have_fdid' END AS broken FROM r GROUP BY customer_record_id, fdid""")
def c2(spark, d):
    r = roles(spark, d)
    hub = r.select("cais_customer_hk", "customer_record_id", "fdid").distinct().withColumn("cat_reporter_crd", F.lit(7))
    state = hub.select("cais_customer_hk", F.when(F.col("fdid") % 2 == 0, "NATURAL_PERSON").otherwise("LEGAL_ENTITY").alias("customer_type"), F.lit(None).cast("timestamp").alias("load_end_dts"))
    out = accounts.customer_snapshot(hub, state, r, "2003-06-30", mode="warn")
    return out.select("customer_record_id", "fdid_count", "customer_type", "has_pii_in_tid", F.concat_ws(",", "broken_rules").alias("broken"))


def submission_files(spark, d):
    """A data file and an identifiers file per order; some stems lack a partner, are late, or carry a wrong version."""
    o = s.table(spark, d, "orders").withColumn("ts0", F.col("o_orderdate").cast("timestamp"))
    k = F.col("o_orderkey")
    stem = F.concat_ws("_", F.lit("900"), (k % 50).cast("string"), F.date_format("ts0", "yyyyMMdd"), F.lit("0"), k.cast("string"))
    data = o.select(
        F.concat(stem, F.lit(".json.bz2")).alias("submission_filename"), F.lit("CAIS_DATA_FILE").alias("file_type"), F.col("ts0").alias("posted_ts"),
        F.when(k % 31 == 0, "1.0.0").otherwise("2.0.0").alias("version"), F.when(k % 41 == 0, -1).otherwise(k % 50).alias("reporter_crd"), k.alias("k"),
    )
    ids = o.filter("o_orderkey % 29 <> 0").select(
        F.concat(stem, F.lit("_TID.json.bz2")).alias("submission_filename"), F.lit("TRANSFORMED_IDENTIFIERS_FILE").alias("file_type"),
        s.plus_micros("ts0", (k % 70).cast("long") * s.MINUTE).alias("posted_ts"), F.lit(None).cast("string").alias("version"), F.lit(None).cast("long").alias("reporter_crd"), k.alias("k"),
    )
    return data.unionByName(ids)


@query("C4_submission_precheck", """
SELECT concat_ws('_', '900', o_orderkey % 50, strftime(o_orderdate, '%Y%m%d'), '0', o_orderkey) AS stem, r AS rejection_reason, r IS NULL AS accepted FROM (
SELECT *, CASE WHEN o_orderkey % 29 = 0 THEN 'UNPAIRED' WHEN o_orderkey % 70 > 60 THEN 'PAIR_TOO_FAR_APART' WHEN o_orderkey % 31 = 0 THEN 'WRONG_VERSION' WHEN o_orderkey % 41 = 0 THEN 'REPORTER_MISMATCH' END AS r FROM orders)""")
def c4(spark, d):
    return accounts.precheck(submission_files(spark, d)).select("stem", "rejection_reason", "accepted")


def submission_link(spark, d):
    return submission_files(spark, d).select(
        "submission_filename", F.col("posted_ts").alias("submission_dts"), F.lit(900).alias("cat_submitter_id"), (F.col("k") % 50).alias("cat_reporter_crd"),
        "file_type", F.when(F.col("k") % 2 == 0, "NEW").otherwise("UPDATE").alias("submission_action"), F.col("k").alias("cais_submission_sk"),
    )


@query("C3_submission_registry", """
WITH x AS (SELECT o_orderkey AS k, concat_ws('_', '900', o_orderkey % 50, strftime(o_orderdate, '%Y%m%d'), '0', o_orderkey) AS stem, CASE WHEN o_orderkey % 50 > 0 THEN '' ELSE 'non_null_reporter_crd' END AS broken FROM orders)
SELECT stem || '.json.bz2' AS submission_filename, 'CAIS_DATA_FILE' AS file_type, CASE WHEN k % 2 = 0 THEN 'NEW' ELSE 'UPDATE' END AS submission_action, false AS accepted, 0 AS error_count, broken FROM x
UNION ALL SELECT stem || '_TID.json.bz2', 'TRANSFORMED_IDENTIFIERS_FILE', CASE WHEN k % 2 = 0 THEN 'NEW' ELSE 'UPDATE' END, false, 0, broken FROM x WHERE k % 29 <> 0""")
def c3(spark, d):
    out = accounts.submission_registry(submission_link(spark, d), mode="warn")
    return out.select("submission_filename", "file_type", "submission_action", "accepted", "error_count", F.concat_ws(",", "broken_rules").alias("broken"))


def account_records(spark, d):
    """Account records with nested lists: customers and large traders from the customer's orders."""
    o = s.table(spark, d, "orders")
    lists = o.groupBy("o_custkey").agg(
        F.array_sort(F.collect_set(F.struct(
            F.concat_ws("-", "o_custkey", F.col("o_orderkey") % 7).alias("customer_record_id"), F.lit("TRDHOLDER").alias("customer_role"), F.lit(None).cast("date").alias("role_start_date")
        ))).alias("customers"),
        F.array_sort(F.collect_set(F.when(F.col("o_orderpriority") == "1-URGENT", F.struct(
            F.concat(F.lit("LT"), (F.col("o_custkey") % 11).cast("string")).alias("ltid"), F.to_date(F.lit("2004-01-01")).alias("ltid_effective_date")
        )))).alias("large_traders"),
    )
    c = s.table(spark, d, "customer").join(lists, F.col("c_custkey") == F.col("o_custkey"))
    return c.select(
        F.lit(7).alias("cat_reporter_crd"), F.col("c_custkey").alias("firm_designated_id"), F.col("c_mktsegment").alias("fdid_type"), F.lit("2004-01-01").cast("timestamp").alias("load_dts"),
        "customers", "large_traders", F.array(F.struct(F.lit("ADDRESS1").alias("addr_type"), F.col("c_nationkey").alias("city"))).alias("addresses"),
    )


@query("C5_new_records", """
WITH n AS (SELECT * FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey IN (SELECT o_custkey FROM orders)), o AS (SELECT * FROM orders WHERE o_custkey % 3 <> 0)
SELECT 'hub_cais_fdid' AS target, COUNT(*) AS n FROM n UNION ALL SELECT 'sat_cais_fdid_state', COUNT(*) FROM n UNION ALL SELECT 'sat_cais_fdid_address', COUNT(*) FROM n
UNION ALL SELECT 'link_cais_fdid_customer', COUNT(DISTINCT o_custkey || '-' || (o_orderkey % 7)) FROM o
UNION ALL SELECT 'hub_cais_large_trader', COUNT(DISTINCT o_custkey % 11) FROM o WHERE o_orderpriority = '1-URGENT' AND o_custkey % 11 <> 4
UNION ALL SELECT 'link_cais_fdid_large_trader', COUNT(DISTINCT o_custkey) FROM o WHERE o_orderpriority = '1-URGENT'""")
def c5(spark, d):
    known = hub_fdid(spark, d).filter("firm_designated_id % 3 = 0")
    lt_known = spark.range(1).select(hash_key([F.lit("LT4")]).alias("large_trader_hk"))
    out = accounts.new_records(account_records(spark, d), known, lt_known, ["fdid_type"])
    rows = None
    for name, df in out.items():
        n = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("target"), "n")
        rows = n if rows is None else rows.unionByName(n)
    return rows


def role_sets(spark, d):
    """Open roles before (filled orders) and the submitted full state (working orders); the lowest role name counts."""
    r = roles(spark, d)
    key = ["cais_fdid_hk", "customer_record_id"]
    prior = r.filter("st = 'F'").groupBy(*key).agg(F.min("customer_role").alias("customer_role"), F.min("role_start_date").alias("role_start_date"))
    now = r.filter("st = 'O'").groupBy(*key).agg(F.min("customer_role").alias("customer_role"))
    return prior, now


ROLE_ACTIONS = f"""
WITH {ROLES_SQL}, p AS (SELECT cais_fdid_hk, customer_record_id, MIN(customer_role) AS pr, MIN(role_start_date) AS ps FROM r WHERE st = 'F' AND fdid IN (SELECT fdid FROM r WHERE st = 'O') GROUP BY 1, 2),
n AS (SELECT cais_fdid_hk, customer_record_id, MIN(customer_role) AS nr FROM r WHERE st = 'O' GROUP BY 1, 2),
a AS (SELECT cais_fdid_hk, customer_record_id, pr, nr, ps, CASE WHEN nr IS NULL THEN 'IMPLICIT_END' WHEN pr IS NULL THEN 'ADDED' WHEN pr <> nr THEN 'ROLE_CHANGED' ELSE 'UNCHANGED' END AS action FROM p FULL JOIN n USING (cais_fdid_hk, customer_record_id))
"""


@query("C6_role_reconciliation", ROLE_ACTIONS + "SELECT customer_record_id, pr AS prior_role, nr AS customer_role, action FROM a")
def c6(spark, d):
    prior, now = role_sets(spark, d)
    out = accounts.reconcile_roles(prior, now, F.to_date(F.lit("2004-01-01")))
    return out.select("customer_record_id", "prior_role", "customer_role", "action")


@query("C6_role_rows", ROLE_ACTIONS + """
SELECT customer_record_id, pr AS customer_role, CAST(ps AS VARCHAR) AS role_start_date, '2004-01-01' AS role_end_date, CASE action WHEN 'IMPLICIT_END' THEN 'ENDED' ELSE 'OTHER' END AS role_end_reason FROM a WHERE action IN ('IMPLICIT_END','ROLE_CHANGED')
UNION ALL SELECT customer_record_id, nr, '2004-01-01', NULL, NULL FROM a WHERE action IN ('ADDED','ROLE_CHANGED')""")
def c6b(spark, d):
    prior, now = role_sets(spark, d)
    return accounts.role_rows(accounts.reconcile_roles(prior, now, F.to_date(F.lit("2004-01-01")))).drop("cais_fdid_hk")


@query("C6_state_update", """
WITH c AS (SELECT *, c_custkey % 4 = 0 AS chg, c_custkey % 5 = 0 AS gone FROM customer)
SELECT c_custkey AS firm_designated_id, CASE WHEN chg THEN c_mktsegment || '*' ELSE c_mktsegment END AS fdid_type, false AS closed, CASE WHEN gone THEN 'NEW' ELSE 'UPDATE' END AS submission_action FROM c WHERE chg OR gone
UNION ALL SELECT c_custkey, c_mktsegment, true, 'UPDATE' FROM c WHERE chg AND NOT gone""")
def c6c(spark, d):
    c = s.table(spark, d, "customer").select("c_custkey", fhk("c_custkey").alias("cais_fdid_hk"), F.col("c_mktsegment").alias("fdid_type"))
    cur = c.filter("c_custkey % 5 <> 0").select(
        "cais_fdid_hk", "fdid_type", F.lit("2003-01-01").cast("timestamp").alias("load_dts"), F.lit(None).cast("timestamp").alias("load_end_dts"), row_hash(["fdid_type"]).alias("hash_diff")
    )
    sub = c.select("cais_fdid_hk", F.when(F.col("c_custkey") % 4 == 0, F.concat("fdid_type", F.lit("*"))).otherwise(F.col("fdid_type")).alias("fdid_type"), F.lit("2004-01-01").cast("timestamp").alias("load_dts"))
    out = accounts.state_changes(cur, sub, ["fdid_type"]).join(c.select("cais_fdid_hk", F.col("c_custkey").alias("firm_designated_id")), "cais_fdid_hk")
    return out.select("firm_designated_id", "fdid_type", F.col("load_end_dts").isNotNull().alias("closed"), "submission_action")


@query("C7_account_end_cascade", f"""
WITH {ROLES_SQL}, e AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'CORRECTION' ELSE 'ENDED' END AS reason FROM customer WHERE c_acctbal < 0 AND NOT (c_custkey % 3 = 0 AND c_custkey % 2 = 0))
SELECT order_id, CASE WHEN role_end_date IS NOT NULL THEN CAST(role_end_date AS VARCHAR) WHEN reason IS NOT NULL THEN '2003-01-01' END AS role_end_date, CASE WHEN role_end_date IS NULL THEN reason END AS role_end_reason
FROM r LEFT JOIN e ON fdid = c_custkey""")
def c7(spark, d):
    k = F.col("c_custkey")
    ended = s.table(spark, d, "customer").filter("c_acctbal < 0").select(
        fhk("c_custkey").alias("cais_fdid_hk"), F.when(k % 3 == 0, "CORRECTION").otherwise("ENDED").alias("fdid_end_reason"),
        F.to_date(F.lit("2003-01-01")).alias("fdid_end_date"), F.when(k % 2 == 0, F.to_date(F.lit("2002-01-01"))).otherwise(F.to_date(F.lit("2003-01-01"))).alias("fdid_date"),
    )
    good, _ = accounts.end_accounts(ended)
    return accounts.cascade_end(good, roles(spark, d), "role_end_date", "role_end_reason").select("order_id", "role_end_date", "role_end_reason")


@query("C8_replaced_accounts", """
WITH r AS (SELECT c_custkey, c_custkey * 2 AS t FROM customer WHERE c_acctbal < 0), k AS (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0 UNION SELECT c_custkey FROM customer WHERE c_custkey % 6 = 0)
SELECT c_custkey AS firm_designated_id, CASE WHEN t IN (SELECT c_custkey FROM k) THEN 'REPLACED' ELSE 'REPLACING_FDID_NOT_FOUND' END AS outcome FROM r""")
def c8(spark, d):
    c = s.table(spark, d, "customer")
    rep = c.filter("c_acctbal < 0").select(F.lit(7).alias("cat_reporter_crd"), F.col("c_custkey").alias("firm_designated_id"), (F.col("c_custkey") * 2).alias("replaced_by_fdid"))
    hub = hub_fdid(spark, d).filter("firm_designated_id % 3 <> 0")
    in_file = hub_fdid(spark, d).filter("firm_designated_id % 6 = 0").select("cat_reporter_crd", "firm_designated_id")
    found, missing = accounts.replaced_accounts(rep, hub, in_file)
    return found.select("firm_designated_id", F.col("fdid_end_reason").alias("outcome")).unionByName(
        missing.select(F.col("affected_record_id").cast("long").alias("firm_designated_id"), F.col("inconsistency_code").alias("outcome"))
    )


@query("C9_mass_transfer", """
SELECT 'opened' AS part, c_custkey AS firm_designated_id FROM customer WHERE c_custkey % 4 <> 0 UNION ALL SELECT 'ended', c_custkey FROM customer WHERE c_custkey % 4 <> 0 UNION ALL SELECT 'rejected', c_custkey FROM customer WHERE c_custkey % 4 = 0""")
def c9(spark, d):
    rec = s.table(spark, d, "customer").select(
        F.lit(8).alias("cat_reporter_crd"), F.col("c_custkey").alias("firm_designated_id"), F.lit(7).alias("prior_cat_reporter_crd"),
        F.col("c_custkey").alias("prior_cat_reporter_fdid"), F.to_date(F.lit("2004-01-01")).alias("event_date"),
    )
    hub = hub_fdid(spark, d)
    out = accounts.mass_transfer(rec, hub.filter("firm_designated_id % 4 <> 0"))
    ended = out["ended"].join(hub, "cais_fdid_hk").select(F.lit("ended").alias("part"), "firm_designated_id")
    return out["opened"].select(F.lit("opened").alias("part"), "firm_designated_id").unionByName(ended).unionByName(
        out["rejected"].select(F.lit("rejected").alias("part"), "firm_designated_id")
    )


@query("C10_inconsistency_resolution", """
WITH o AS (SELECT o_custkey AS id, MIN(o_orderdate) AS dt FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), f AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT CAST(id AS VARCHAR) AS affected_record_id, CASE WHEN f.id IS NULL THEN 'RESOLVED' WHEN o.id IS NULL THEN 'OPENED' ELSE 'STILL_OPEN' END AS change, strftime(coalesce(dt, TIMESTAMP '2004-01-01'), '%Y-%m-%d %H:%M:%S.%f') AS detected_dts
FROM o FULL JOIN f USING (id)""")
def c10(spark, d):
    o = s.table(spark, d, "orders").withColumns({"affected_record_id": F.col("o_custkey").cast("string"), "inconsistency_code": F.lit("X1")})
    opened = o.filter("o_orderstatus = 'F'").groupBy("inconsistency_code", "affected_record_id").agg(F.min(F.col("o_orderdate").cast("timestamp")).alias("detected_dts"))
    out = accounts.inconsistency_changes(opened, o.filter("o_orderpriority = '1-URGENT'"), F.lit("2004-01-01").cast("timestamp"))
    return out.select("affected_record_id", "change", "detected_dts")


@query("C11_identifier_replacement", """
SELECT 'C' || c_custkey AS customer_record_id, CASE WHEN c_custkey % 10 = 0 THEN '2004-01-01 00:00:00.000000' END AS load_end_dts, CAST(NULL AS VARCHAR) AS correcting_customer_record_id FROM customer
UNION ALL SELECT 'N' || c_custkey, NULL, 'C' || c_custkey FROM customer WHERE c_custkey % 10 = 0""")
def c11(spark, d):
    c = s.table(spark, d, "customer")
    when = F.lit("2004-01-01").cast("timestamp").alias("load_dts")
    old = c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_record_id"), F.lit("NATURAL_PERSON").alias("customer_type"), F.lit("2003-01-01").cast("timestamp").alias("load_dts"), F.lit(None).cast("timestamp").alias("load_end_dts"), F.lit(None).cast("string").alias("correcting_customer_record_id"))
    new = c.filter("c_custkey % 10 = 0").select(F.concat(F.lit("N"), F.col("c_custkey").cast("string")).alias("customer_record_id"), F.lit("NATURAL_PERSON").alias("customer_type"), when, F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("correcting_customer_record_id"))
    return accounts.replace_identifiers(old, new).select("customer_record_id", "load_end_dts", "correcting_customer_record_id")


@query("C12_outstanding_rejections", """
SELECT o_orderkey AS cais_submission_sk, CAST(CAST(o_orderdate AS DATE) + 5 - DATE '1998-06-30' AS BIGINT) AS days_to_repair, CAST(o_orderdate AS DATE) + 5 < DATE '1998-06-30' AS is_overdue FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 7 = 0""")
def c12(spark, d):
    o = s.table(spark, d, "orders").withColumn("t", F.col("o_orderdate").cast("timestamp"))
    rej = o.filter("o_orderkey % 7 = 0").select(F.col("o_orderkey").alias("cais_submission_sk"), (F.col("t") + F.expr("interval 5 days")).alias("repair_due_dts"), F.when(F.col("o_orderstatus") == "F", F.col("t")).alias("resolved_dts"))
    sub = o.select(F.col("o_orderkey").alias("cais_submission_sk"), F.col("o_custkey").alias("cat_reporter_crd"))
    return accounts.outstanding_rejections(rej, sub, "1998-06-30").select("cais_submission_sk", "days_to_repair", "is_overdue")


@query("V6_overdue_inconsistencies", """
SELECT o_orderkey AS cais_submission_sk, CAST(DATE '1998-06-30' - CAST(o_orderdate AS DATE) AS BIGINT) AS days_since_detected, DATE '1998-06-30' - CAST(o_orderdate AS DATE) > 5 AS is_overdue, 'f' || o_orderkey AS submission_filename FROM orders WHERE o_orderstatus <> 'F'""")
def v6(spark, d):
    o = s.table(spark, d, "orders").withColumn("t", F.col("o_orderdate").cast("timestamp"))
    inc = o.select(F.col("o_orderkey").alias("cais_submission_sk"), F.col("t").alias("detected_dts"), F.when(F.col("o_orderstatus") == "F", F.col("t")).alias("resolved_dts"))
    sub = o.select(F.col("o_orderkey").alias("cais_submission_sk"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("submission_filename"), F.col("o_custkey").alias("cat_reporter_crd"))
    return views.overdue_inconsistencies(inc, sub, "1998-06-30").select("cais_submission_sk", "days_since_detected", "is_overdue", "submission_filename")


# ---- submission files --------------------------------------------------------------------------------------------------------------


def submission_rows(spark, d, max_rows=700):
    ev = s.order_events(spark, d).withColumns(
        {"submitter_id": F.lit("900"), "reporter_crd": (F.col("party_id") % 3).cast("string"), "gen_date": F.trunc("event_date", "year"), "file_group": F.lit("")}
    )
    return submission.shape_submission(submission.split_files(ev, "dv2_source_hk", max_rows), MAPPING, "OrderEvents")


FILES_SQL = f"""f AS (SELECT *, (record_no - 1) // 700 + 1 AS file_no FROM (SELECT dv2_source_hk, event_timestamp, {LINE_SQL} AS line, party_id % 3 AS crd, year(event_date) AS y,
  row_number() OVER (PARTITION BY party_id % 3, year(event_date) ORDER BY sha256(dv2_source_hk), dv2_source_hk) AS record_no FROM order_events))"""
NAME_SQL = "'900_' || crd || '_' || y || '0101_0_' || lpad(CAST(file_no AS VARCHAR), 4, '0') || '.json.bz2'"


@query("X1_batch_metadata", s.with_stage("order_events", f"""
WITH {FILES_SQL} SELECT {NAME_SQL} AS file_name, COUNT(*) AS record_count, CAST(SUM(strlen(line) + 1) AS BIGINT) AS file_size_bytes, sha256(string_agg(line, chr(10) ORDER BY record_no) || chr(10)) AS sha256_checksum,
  strftime(MIN(event_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS min_event_timestamp, strftime(MAX(event_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS max_event_timestamp FROM f GROUP BY crd, y, file_no"""))
def x1(spark, d):
    return submission.batch_metadata(submission_rows(spark, d)).select(
        "file_name", "record_count", "file_size_bytes", "sha256_checksum", "min_event_timestamp", "max_event_timestamp"
    )


@query("X2_file_names", s.with_stage("order_events", f"WITH {FILES_SQL} SELECT dv2_source_hk, record_no, {NAME_SQL} AS file_name FROM f"))
def x2(spark, d):
    return submission_rows(spark, d).select("dv2_source_hk", "record_no", "file_name")


@query("IO10_submission_files", s.with_stage("order_events", f"""
WITH {FILES_SQL} SELECT {NAME_SQL} AS file_name, COUNT(*) AS lines, CAST(SUM(strlen(line) + 1) AS BIGINT) AS bytes FROM f GROUP BY crd, y, file_no"""))
def io10(spark, d):
    path = work_dir(spark, "submission")
    submission.write_submission(submission_rows(spark, d), path)
    name = F.regexp_extract(F.input_file_name(), "([^/]+)$", 1)
    lines = spark.read.option("pathGlobFilter", "*.json.bz2").text(path).select(name.alias("file_name"), "value")
    return lines.groupBy("file_name").agg(F.count("*").alias("lines"), F.sum(F.octet_length("value") + 1).alias("bytes"))


@query("IO10_file_checksums", s.with_stage("order_events", f"""
WITH {FILES_SQL} SELECT {NAME_SQL} AS file_name, COUNT(*) AS record_count, CAST(SUM(strlen(line) + 1) AS BIGINT) AS file_size_bytes, sha256(string_agg(line, chr(10) ORDER BY record_no) || chr(10)) AS sha256_checksum
FROM f GROUP BY crd, y, file_no"""))
def io10b(spark, d):
    path = work_dir(spark, "submission")
    submission.write_submission(submission_rows(spark, d), path)
    return written_files(spark, path)


@query("X3_deadlines", """
WITH b AS (SELECT o_orderkey, o_orderdate AS t, CAST(o_orderdate AS DATE) AS d, CASE o_orderstatus WHEN 'O' THEN 'OrderEvents' WHEN 'F' THEN 'Allocations' ELSE 'CAIS' END AS k FROM orders),
u AS (SELECT *, CAST(d + 1 AS TIMESTAMP) + CASE k WHEN 'OrderEvents' THEN INTERVAL 6 HOUR WHEN 'Allocations' THEN INTERVAL '17:30:00' ELSE INTERVAL '23:59:00' END AS local FROM b),
z AS (SELECT *, CASE WHEN local >= make_timestamp(year(local), 4, 1 + (7 - dayofweek(make_date(year(local), 4, 1))::INTEGER) % 7, 2, 0, 0.0)
  AND local < make_timestamp(year(local), 10, 31 - dayofweek(make_date(year(local), 10, 31))::INTEGER, 2, 0, 0.0) THEN 4 ELSE 5 END AS off FROM u)
SELECT o_orderkey, strftime(local + to_hours(off), '%Y-%m-%d %H:%M:%S.%f') AS submission_deadline, t + to_hours(30) > local + to_hours(off) AS is_late_submission FROM z""")
def x3(spark, d):
    b = s.table(spark, d, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("event_date"), (F.col("o_orderdate").cast("timestamp") + F.expr("interval 30 hours")).alias("submission_timestamp"),
        F.when(F.col("o_orderstatus") == "O", "OrderEvents").when(F.col("o_orderstatus") == "F", "Allocations").otherwise("CAIS").alias("submission_file_type"),
    )
    return submission.with_lateness(b).select("o_orderkey", "submission_deadline", "is_late_submission")


@query("X4_feedback_errors", """
WITH cal AS (SELECT CAST(range AS DATE) AS c FROM range(DATE '2024-01-01', DATE '2024-04-01', INTERVAL 1 DAY)),
tr AS (SELECT c, dayofweek(c) BETWEEN 1 AND 5 AND c NOT IN (DATE '2024-01-01', DATE '2024-01-15', DATE '2024-02-19', DATE '2024-03-29') AS t FROM cal),
no AS (SELECT c, t, SUM(CASE WHEN t THEN 1 ELSE 0 END) OVER (ORDER BY c) AS n FROM tr),
x AS (SELECT event_id, event_type, n3.c AS dl, n3.n - (SELECT n FROM no WHERE c = DATE '2024-01-20') AS dd FROM events JOIN no n0 ON n0.c = CAST(ts AS DATE) JOIN no n3 ON n3.t AND n3.n = n0.n + 3)
SELECT event_id, CAST(dl AS VARCHAR) AS t_plus_3_deadline, CAST(dd AS BIGINT) AS days_to_deadline, CASE WHEN event_type = 'view' THEN 0 WHEN dd < -5 THEN 3 WHEN dd < 0 THEN 2 WHEN dd < 2 THEN 1 ELSE 0 END AS escalation_level FROM x""")
def x4(spark, d):
    fb = s.table(spark, d, "events").select("event_id", F.to_date("ts").alias("event_date"), F.when(F.col("event_type") == "view", "RESOLVED").otherwise("OPEN").alias("resolution_status"))
    return submission.ingest_feedback(fb, dims.dim_date(spark), "2024-01-20").select("event_id", "t_plus_3_deadline", "days_to_deadline", "escalation_level")


@query("X5_feedback_match", """
WITH f AS (SELECT 'S' || user_id AS fn, event_type FROM events)
SELECT 'S' || c_custkey AS submission_filename, COUNT(*) FILTER (event_type = 'error') AS error_count, COUNT(*) FILTER (event_type = 'click') AS rejection_count, COUNT(*) FILTER (event_type = 'view') AS inconsistency_count,
  COUNT(fn) > 0 AND COUNT(*) FILTER (event_type = 'click') = 0 AS accepted FROM customer LEFT JOIN f ON fn = 'S' || c_custkey GROUP BY c_custkey""")
def x5(spark, d):
    name = lambda c: F.concat(F.lit("S"), F.col(c).cast("string")).alias("submission_filename")
    fb = s.table(spark, d, "events").select(
        name("user_id"), s.choose("event_type", {"error": "ERROR", "click": "REJECTION", "view": "INCONSISTENCY"}).alias("feedback_type")
    )
    return submission.match_feedback(s.table(spark, d, "customer").select(name("c_custkey")), fb)


def correction_events(spark, d):
    """Every fourth event corrects another: chains of up to eight corrections, some of which close into a circle."""
    ev = s.table(spark, d, "events")
    k = F.col("event_id")
    ref = F.when(k % 256 == 3, k + 56).when((k % 8 == 3) & (k % 64 > 3), k - 8).when(k % 4 == 3, k - k % 8)
    return ev.select("event_id", ref.alias("original_event_ref"), F.col("ts").cast("timestamp").alias("ts"), "value")


CORR_SQL = """c AS (SELECT event_id, CASE WHEN event_id % 256 = 3 THEN event_id + 56 WHEN event_id % 8 = 3 AND event_id % 64 > 3 THEN event_id - 8 WHEN event_id % 4 = 3 THEN event_id - event_id % 8 END AS original_event_ref, ts, value FROM events),
walk AS (SELECT event_id, original_event_ref AS ref, 1 AS depth, event_id AS low FROM c WHERE original_event_ref IS NOT NULL
  UNION ALL SELECT walk.event_id, c.original_event_ref, depth + 1, least(low, c.event_id) FROM walk JOIN c ON c.event_id = walk.ref WHERE c.original_event_ref IS NOT NULL AND depth < 20),
ended AS (SELECT event_id, max_by(ref, depth) AS ref, max_by(low, depth) AS low, max(depth) AS depth FROM walk GROUP BY 1),
root AS (SELECT event_id, depth = 20 AS cyclic, CASE WHEN depth = 20 THEN low ELSE ref END AS effective_id, CASE WHEN depth < 20 THEN depth END AS chain_depth FROM ended)"""


@query("X6_correction_pairs", f"""WITH RECURSIVE {CORR_SQL} SELECT a.event_id, a.original_event_ref, b.value AS original_value, b.event_id IS NOT NULL AS original_found, effective_id, CAST(chain_depth AS BIGINT) AS chain_depth, cyclic
FROM c a JOIN root USING (event_id) LEFT JOIN c b ON b.event_id = a.original_event_ref""")
def x6(spark, d):
    out = submission.pair_corrections(correction_events(spark, d), "event_id", "original_event_ref", ["ts"])
    return out.select("event_id", "original_event_ref", "original_value", "original_found", "effective_id", "chain_depth", "cyclic")


@query("X6_effective_events", f"""
WITH RECURSIVE {CORR_SQL}, k AS (SELECT c.*, coalesce(effective_id, event_id) AS eff FROM c LEFT JOIN root USING (event_id))
SELECT eff AS effective_id, event_id, value FROM k QUALIFY row_number() OVER (PARTITION BY eff ORDER BY (original_event_ref IS NOT NULL) DESC, ts DESC, event_id DESC) = 1""")
def x6b(spark, d):
    return submission.effective_events(correction_events(spark, d), "event_id", "original_event_ref", ["ts", "event_id"]).select("effective_id", "event_id", "value")


@query("X7_audit_trail", """
WITH x AS (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, lag(event_type) OVER w AS pt, lag(json_extract_string(props, '$.k')) OVER w AS pk, lag(event_id) OVER w AS pe FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, 'event_type' AS attribute, pt AS old_value, event_type AS new_value FROM x WHERE pe IS NOT NULL AND pt IS DISTINCT FROM event_type UNION ALL SELECT event_id, 'k', pk, k FROM x WHERE pe IS NOT NULL AND pk IS DISTINCT FROM k""")
def x7(spark, d):
    ev = s.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return submission.audit_trail(ev, ["user_id"], ["ts", "event_id"], ["event_type", "k"]).select("event_id", "attribute", "old_value", "new_value")


@query("X8_modification_gap", s.with_stage("fills", """
SELECT fill_id, CAST((epoch_us(fill_ts) - epoch_us(order_ts)) // 1000 AS BIGINT) AS request_to_accept_ms, false AS audit_flag FROM fills"""))
def x8(spark, d):
    return submission.modification_gap(s.fills(spark, d), "order_ts", "fill_ts").select("fill_id", "request_to_accept_ms", "audit_flag")


# ---- reference data -------------------------------------------------------------------------------------------------------------------


@query("X12_rating_harmonisation", """
WITH a AS (SELECT 'SP' AS rating_agency, c_custkey AS k, c_acctbal AS b FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'FITCH', c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 1)
SELECT rating_agency, k % 22 + 1 AS numeric_equivalent, COUNT(*) AS n, CAST(MIN((k % 22 + 1) * 5) AS BIGINT) AS basel_risk_weight, k % 22 + 1 <= 10 AS is_investment_grade, CAST(MIN(CASE WHEN rating_agency = 'SP' THEN (k % 22 + 1) * 2 END) AS BIGINT) AS default_probability FROM a GROUP BY 1, 2, 5""")
def x12(spark, d):
    c = s.table(spark, d, "customer")
    grade = (F.col("c_custkey") % 22 + 1)
    sp = c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("code"), F.lit("LONG_TERM").alias("scale"), grade.alias("num"))
    fitch = c.filter("c_custkey % 2 = 1").select(F.col("c_custkey").alias("rating"), F.lit("LONG_TERM").alias("term"), grade.alias("rank"))
    grades = c.select(grade.alias("numeric_equivalent")).distinct()
    weights = grades.withColumn("basel_risk_weight", F.col("numeric_equivalent") * 5)
    pd_ = grades.withColumns({"rating_agency": F.lit("SP"), "agency_scale": F.lit("LONG_TERM"), "default_probability": F.col("numeric_equivalent") * 2})
    out = refdata.harmonize_ratings(
        {"SP": (sp, {"credit_rating_code": "code", "agency_scale": "scale", "numeric_equivalent": "num"}),
         "FITCH": (fitch, {"credit_rating_code": "rating", "agency_scale": "term", "numeric_equivalent": "rank"})}, weights, pd_,
    )
    return out.groupBy("rating_agency", "numeric_equivalent", "is_investment_grade").agg(
        F.count("*").alias("n"), F.min("basel_risk_weight").alias("basel_risk_weight"), F.min("default_probability").alias("default_probability")
    )


@query("X12_class_changes", """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'INVESTMENT' ELSE 'SPECULATIVE' END AS old_class, CASE WHEN c_acctbal - c_custkey % 500 >= 0 THEN 'INVESTMENT' ELSE 'SPECULATIVE' END AS new_class FROM customer WHERE c_acctbal >= 0 AND c_acctbal - c_custkey % 500 < 0""")
def x12b(spark, d):
    old = s.table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("v"))
    new = old.withColumn("v", F.col("v") - F.col("c_custkey") % 500)
    return refdata.class_changes(old, new, ["c_custkey"], "v", F.when(F.col("v") >= 0, "INVESTMENT").otherwise("SPECULATIVE"))


@query("X12_count_band", """
SELECT c_mktsegment, COUNT(*) AS n, (SELECT COUNT(*) FROM customer) // 5 AS expected, CASE WHEN abs(COUNT(*) - (SELECT COUNT(*) FROM customer) // 5) <= ((SELECT COUNT(*) FROM customer) // 5) * 0.1 THEN 'PASS' ELSE 'FAIL' END AS outcome FROM customer GROUP BY 1""")
def x12c(spark, d):
    c = s.table(spark, d, "customer")
    want = c.count() // 5
    return refdata.count_within(c, "c_mktsegment", {k: want for k in ("MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD")})


@query("X13_code_list_diff", """
WITH o AS (SELECT s_suppkey AS k, s_name AS n FROM supplier WHERE s_suppkey % 5 <> 0), w AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN s_name || '*' ELSE s_name END AS n FROM supplier WHERE s_suppkey % 4 <> 0)
SELECT k, CASE WHEN o.n IS NULL THEN 'ADDED' WHEN w.n IS NULL THEN 'RETIRED' ELSE 'CHANGED' END AS change FROM o FULL JOIN w USING (k) WHERE o.n IS NULL OR w.n IS NULL OR o.n <> w.n""")
def x13(spark, d):
    sup = s.table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("n"))
    new = sup.filter("k % 4 <> 0").withColumn("n", F.when(F.col("k") % 3 == 0, F.concat("n", F.lit("*"))).otherwise(F.col("n")))
    return refdata.code_list_diff(sup.filter("k % 5 <> 0"), new, ["k"], ["k", "n"])


# ---- tables, files and streams --------------------------------------------------------------------------------------------------------


@query("IO9_partitioned_write", s.with_stage("order_events", "SELECT CAST(event_date AS VARCHAR) AS event_date, COUNT(*) AS n FROM order_events GROUP BY 1"))
def io9(spark, d):
    path = work_dir(spark, "fact")
    ev = s.order_events(spark, d).withColumn("event_month", F.trunc("event_date", "month"))
    tables.write_partitioned(ev, path, ["event_month"], ["cat_order_id"])
    return spark.read.parquet(path).groupBy("event_date").agg(F.count("*").alias("n"))


@query("IO11_read_event_date", "SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def io11(spark, d):
    path = work_dir(spark, "by_date")
    ev = s.table(spark, d, "events").withColumn("event_date", F.to_date("ts"))
    tables.write_partitioned(ev, path, ["event_date"])
    return tables.read_event_date(spark, path, "2024-01-15").select("event_id", "user_id")


def event_stream(spark, d):
    ev = tables.stream_table(spark, d, "events")
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def replay_stream(spark, d, parts=4):
    """The events as a stream of several batches, out of order: files are cut by a hash of the event."""
    path = work_dir(spark, "landing")
    ev = s.table(spark, d, "events").withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(parts)))
    ev.write.partitionBy("part").parquet(path)
    per_batch = max(1, len(spark.read.parquet(path).inputFiles()) // parts)
    schema = s.table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(f"{path}/part=*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("IO2_stream_scan", "SELECT event_id, user_id, event_type FROM events")
def io2(spark, d):
    base = work_dir(spark, "io2")
    flows.append_files(event_stream(spark, d).select("event_id", "user_id", "event_type"), f"{base}/out", f"{base}/cp").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("IO3_csv_ingest", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def io3(spark, d):
    base = work_dir(spark, "io3")
    sup = s.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    sup.write.option("header", True).csv(f"{base}/in")
    stream = files.ingest_csv(spark, f"{base}/in", sup.schema)
    flows.append_files(stream, f"{base}/out", f"{base}/cp").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("IO3_schema_tracking", """
SELECT CASE WHEN s_suppkey % 7 <> 3 THEN s_suppkey END AS s_suppkey, s_name, CASE WHEN s_suppkey % 3 > 0 THEN s_nationkey END AS s_nationkey, CASE WHEN s_suppkey % 3 = 2 THEN 'R' || s_nationkey END AS rating,
  CASE WHEN s_suppkey % 7 = 3 THEN '{"s_suppkey":"K' || s_suppkey || '"}' END AS _rescued FROM supplier""")
def io3b(spark, d):
    """Files of three headers: fewer, other and new columns in another order, and keys that do not fit their type."""
    base = work_dir(spark, "io3b")
    sup = s.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    text = sup.withColumn("code", F.when(k % 7 == 3, F.concat(F.lit("K"), k.cast("string"))).otherwise(k.cast("string")))
    shapes = [["code as s_suppkey", "s_name"], ["s_nationkey as S_NATIONKEY", "s_name", "code as s_suppkey"], ["s_name", "concat('R', s_nationkey) as rating", "code as s_suppkey", "s_nationkey"]]
    for n, shape in enumerate(shapes):
        text.filter(k % 3 == n).selectExpr(*shape).write.option("header", True).csv(f"{base}/in/{n}")
    tracked.tracked_csv(spark, f"{base}/in/*", sup.schema, f"{base}/out", f"{base}/cp", files_per_batch=1)
    return tracked.read_tracked(spark, f"{base}/out", sup.schema)


def signed_fills(spark, d):
    """Fills with their sign and the number of their batch, in one pass."""
    k, amount = F.col("k"), F.col("amount")

    def row(sign, no, value):
        return F.struct(F.lit(sign).alias("sign"), no.cast("int").alias("no"), value.cast("decimal(18,4)").alias("amount"))

    right = row(1, F.when(k % 7 == 0, 2).otherwise(k % 3), amount)
    wrong = [row(1, F.when(k == 0, 2).otherwise(0), amount + 1), row(-1, F.lit(1), amount + 1)]
    f = s.fills(spark, d).withColumnRenamed("order_date", "fact_date").withColumn("k", F.pmod(F.xxhash64("fill_id"), F.lit(21)))
    rows = f.withColumn("e", F.explode(F.when(k % 7 == 0, F.array(right, *wrong)).otherwise(F.array(right))))
    own = [*rollup.BY, "order_id", "order_status", "side", "quantity", "price", "settlement_status"]
    return rows.select(*own, "e.sign", "e.no", "e.amount")


@query("A8_incremental_lifecycle", ORACLE["A8_daily_lifecycle"])
def a8_incremental(spark, d):
    """Fills in three batches; every seventh comes first with a wrong amount and is corrected later, some are withdrawn before they come."""
    base = work_dir(spark, "ivm")
    landing = f"{base}/landing"
    signed_fills(spark, d).write.partitionBy("no").parquet(landing)
    feed = spark.read.parquet(landing)
    table = rollup.DailyLifecycle(spark, base, buckets=8)
    for no in range(3):
        table.apply(no, feed.filter(F.col("no") == no))
    return table.read().drop("cancelled_order_count", "rejected_order_count")


@query("IO4_xml_ingest", "SELECT r_name AS currency_code, MIN(n_nationkey) % 5 AS minor_unit, 'C' || lpad(CAST(MIN(n_nationkey) AS VARCHAR), 2, '0') AS country_code FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def io4(spark, d):
    base = work_dir(spark, "io4")
    # one currency per region, listed once per country
    nation = s.table(spark, d, "nation").join(s.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    n = nation.select(F.lower("r_name").alias("Ccy"), F.col("r_name").alias("CcyNm"), F.col("n_nationkey").cast("string").alias("CcyNbr"), (F.col("n_nationkey") % 5).cast("string").alias("CcyMnrUnts"), F.lower("n_name").alias("CtryNm"))
    countries = nation.select(F.col("n_name").alias("country_name"), F.concat(F.lit("C"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("country_code"))
    n.write.format("xml").option("rowTag", "CcyNtry").option("rootTag", "CcyTbl").save(f"{base}/in")
    raw = files.ingest_xml(spark, f"{base}/in", "CcyNtry", refdata.CURRENCY_XML)
    return refdata.curate(raw, "ref_currency", countries=countries).select("currency_code", "minor_unit", "country_code")


@query("ST1_scd2_stream", V_SQL)
def st1(spark, d):
    base = work_dir(spark, "st1")
    ch = replay_stream(spark, d).select(
        "user_id", F.to_date("ts").alias("change_date"), F.col("event_id").alias("seq"), "event_type", F.when(F.col("event_type") == "error", "DELETE").otherwise("UPSERT").alias("op")
    )
    dim, log = flows.type2_tables(spark, base, ["user_id"], 8)
    flows.scd2_stream(ch, ["user_id"], ["event_type"], dim, log, f"{base}/cp")
    return dim.read()


@query("ST2_gated_stream", "SELECT event_id, CASE WHEN value < 20 AND event_type <> 'error' THEN '' ELSE concat_ws(',', CASE WHEN event_type = 'error' THEN 'not_error' END, CASE WHEN value >= 20 THEN 'small' END) END AS broken FROM events")
def st2(spark, d):
    base = work_dir(spark, "st2")
    flows.gated_stream(replay_stream(spark, d), {"not_error": "event_type <> 'error'", "small": "value < 20"}, f"{base}/good", f"{base}/bad", f"{base}/cp")
    good, bad = spark.read.parquet(f"{base}/good"), spark.read.parquet(f"{base}/bad")
    return good.select("event_id", F.lit("").alias("broken")).unionByName(bad.select("event_id", F.col("broken_rules").alias("broken")))


@query("ST3_enriched_stream", s.with_dims("", "account", """
SELECT event_id, dim_account_sk FROM events LEFT JOIN dim_account ON user_id = account_id_bk AND CAST(ts AS DATE) BETWEEN effective_start_date AND effective_end_date"""))
def st3(spark, d):
    base = work_dir(spark, "st3")
    acc = stored_dim(spark, d, "account")
    ev = replay_stream(spark, d).withColumn("event_date", F.to_date("ts"))
    out = interval.pit_lookup(ev, acc, "user_id", "account_id_bk", "event_date", {"dim_account_sk": "dim_account_sk"})
    flows.append_files(out, f"{base}/out", f"{base}/cp", ["event_date"]).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", "dim_account_sk")


@query("J15_stream_enrichment", "SELECT event_id, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey")
def j15(spark, d):
    base = work_dir(spark, "j15")
    out = replay_stream(spark, d).join(s.table(spark, d, "customer").withColumnRenamed("c_custkey", "user_id"), "user_id", "left")
    flows.append_files(out.select("event_id", "c_mktsegment"), f"{base}/out", f"{base}/cp").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("ST4_idempotent_stream", "SELECT CAST(user_id AS VARCHAR) AS firm_roe_id, event_type AS cat_event_code, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date FROM events GROUP BY 1, 2, 3")
def st4(spark, d):
    base = work_dir(spark, "st4")
    ev = replay_stream(spark, d).select(
        F.col("user_id").cast("string").alias("firm_roe_id"), F.col("event_type").alias("cat_event_code"), F.to_date("ts").alias("event_date"), F.col("ts").alias("event_timestamp"),
        F.lit(0).alias("event_nanos"), F.col("event_id").cast("string").alias("dv2_source_hk"),
    )
    flows.idempotent_stream(ev, f"{base}/fact", f"{base}/cp")
    return spark.read.parquet(f"{base}/fact").select("firm_roe_id", "cat_event_code", "event_date")


@query("ST5_code_list_stream", """
SELECT s_suppkey AS code, s_name AS name, '2024-01-01' AS effective_start_date, true AS is_current FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT s_suppkey, s_name, '2024-01-01', false FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT s_suppkey, s_name || '*', '2024-02-01', true FROM supplier WHERE s_suppkey % 3 = 0""")
def st5(spark, d):
    base = work_dir(spark, "st5")
    sup = s.table(spark, d, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"), F.lit("2024-01-01").alias("day"))
    later = sup.withColumns({"name": F.when(F.col("code") % 3 == 0, F.concat("name", F.lit("*"))).otherwise(F.col("name")), "day": F.lit("2024-02-01")})
    sup.write.option("header", True).csv(f"{base}/in/a")
    later.write.option("header", True).csv(f"{base}/in/b")
    stream = files.ingest_csv(spark, f"{base}/in/*", sup.schema).select(
        "code", "name", F.to_date("day").alias("change_date"), F.lit("UPSERT").alias("op"), F.unix_date(F.to_date("day")).cast("long").alias("seq")
    )
    dim, log = flows.type2_tables(spark, base, ["code"], 8)
    flows.scd2_stream(stream, ["code"], ["name"], dim, log, f"{base}/cp")
    return dim.read().select("code", "name", "effective_start_date", "is_current")


#: Allocations per part of the stream; its state holds a part and the days around it.
ST7_ROWS = 4_000_000


@query("ST7_late_allocations", s.with_stage("fills", """
SELECT fill_id, order_id, line_no NOT IN (6, 7) AS matched FROM fills"""))
def st7(spark, d):
    f = s.fills(spark, d)
    shift = F.when(F.col("line_no") >= 6, 30).otherwise(F.col("line_no") % 3)
    a = f.select(F.col("fill_id").alias("allocation_id"), "order_id", F.timestamp_micros(F.unix_micros("order_ts") + shift.cast("long") * 86400 * s.SECOND).alias("allocation_ts"))
    o = s.orders(spark, d).select("order_id", "order_ts")
    base = work_dir(spark, "st7")
    # both sides arrive in the same parts of time, each run once it is there, so that the watermark drops state as it goes
    cuts = flows.time_parts(a, "allocation_ts", ST7_ROWS)
    for name, side, ts in (("a", a, "allocation_ts"), ("o", o, "order_ts")):
        side.withColumn("part", flows.part_of(ts, cuts)).hint("rebalance", "part").write.partitionBy("part").parquet(f"{base}/staged_{name}")
    sa = spark.readStream.schema(a.schema).parquet(f"{base}/a/*")
    so = spark.readStream.schema(o.schema).parquet(f"{base}/o/*")
    out = flows.late_allocations(sa, so, salts=2).select(F.col("allocation_id").alias("fill_id"), "order_id", F.col("order_ts").isNotNull().alias("matched"))
    staged = {name: spark.read.schema(T.StructType([*side.schema, T.StructField("part", T.IntegerType())])).parquet(f"{base}/staged_{name}") for name, side in (("a", a), ("o", o))}
    for n in range(len(cuts) + 1):
        for name, rows in staged.items():
            rows.filter(F.col("part") == n).drop("part").write.parquet(f"{base}/{name}/{n}")
        if n == len(cuts):
            # one row far in the future on each side moves the watermark, so that unmatched rows come out
            end = staged["a"].agg(F.max("allocation_ts").alias("t")).withColumn("t", F.col("t") + F.expr("interval 100 days"))
            end.select(F.lit("END").alias("allocation_id"), F.lit(-1).cast("long").alias("order_id"), F.col("t").alias("allocation_ts")).write.parquet(f"{base}/a/end")
            end.select(F.lit(-2).cast("long").alias("order_id"), F.col("t").alias("order_ts")).write.parquet(f"{base}/o/end")
        flows.append_files(out, f"{base}/out", f"{base}/cp").awaitTermination()
    return spark.read.parquet(f"{base}/out").filter("fill_id <> 'END'")


@query("ST8_venue_quality_stream", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS hour_ts, user_id AS venue_id, user_id % 7 AS instrument_id, COUNT(*) AS executed_qty, CAST(COUNT(*) AS DOUBLE) / CAST(COUNT(*) * 2 AS DOUBLE) AS fill_rate,
  CAST(SUM(event_id % 1000) AS DOUBLE) / COUNT(*) AS avg_latency_ms FROM events GROUP BY date_trunc('hour', ts), user_id""")
def st8(spark, d):
    base = work_dir(spark, "st8")
    # a marker far in the future moves the watermark past the last window, so that it comes out
    src = s.table(spark, d, "events")
    src.write.parquet(f"{base}/in")
    end = src.agg(F.max("ts").alias("ts")).select(F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), (F.col("ts").cast("timestamp") + F.expr("interval 100 days")).cast(src.schema["ts"].dataType).alias("ts"))
    end.write.parquet(f"{base}/in_end")
    both = spark.readStream.schema(src.schema).parquet(f"{base}/in*").withColumn("ts", F.col("ts").cast("timestamp"))
    ev = both.select(
        F.col("ts").alias("fill_ts"), F.col("user_id").alias("venue_id"), (F.col("user_id") % 7).alias("instrument_id"), F.lit(1).alias("quantity"), F.lit(2).alias("order_quantity"),
        F.lit(1).alias("improvement_bps"), F.lit(1).alias("spread_bps"), (F.col("event_id") % 1000).alias("latency_ms"),
    )
    out = flows.venue_quality_stream(ev, delay="2 hours").select("hour_ts", "venue_id", "instrument_id", "executed_qty", "fill_rate", "avg_latency_ms")
    flows.append_files(out, f"{base}/out", f"{base}/cp").awaitTermination()
    return spark.read.parquet(f"{base}/out").filter("venue_id <> -1")


@query("ST9_state_check_stream", BAD_MOVES)
def st9(spark, d):
    base = work_dir(spark, "st9")
    rows = status_rows(spark, d).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "status")
    # five batches in the order of time, but every fourth event arrives a batch late, and a last one that only moves the watermark
    first = F.floor(F.unix_micros("ts") / (7 * 86400 * s.SECOND))
    low = rows.agg(F.min(first)).first()[0] or 0
    part = (first - low + F.when(F.col("event_id") % 4 == 1, 1).otherwise(0)).cast("int")
    end = rows.agg(F.max("ts").alias("ts")).select(F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), (F.col("ts") + F.expr("interval 100 days")).alias("ts"), F.lit("NEW").alias("status"))
    parts = rows.withColumn("part", part)
    for n in range((parts.agg(F.max("part")).first()[0] or 0) + 1):
        parts.filter(F.col("part") == n).drop("part").coalesce(1).write.parquet(f"{base}/in/{n:04d}")
    end.coalesce(1).write.parquet(f"{base}/in/end")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    with moves.rocksdb(spark):
        bad = moves.state_check_stream(stream, "user_id", "ts", "event_id", "status", states.edge_frame(spark), "order", "14 days")
        flows.append_files(bad, f"{base}/bad", f"{base}/cp").awaitTermination()
    return spark.read.parquet(f"{base}/bad").filter("user_id <> -1").select("event_id", "from_state", "status")
