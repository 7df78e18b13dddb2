"""The given tables mapped onto the trade domain, as DataFrames and as the same definitions in SQL.

customer = party and account, supplier = venue and trader, part = instrument, nation/region = desks, orders = orders,
lineitem = fills and settlements, events = account status changes and message traffic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradevault.session import work_dir

BASE_DATE = "1994-12-31"
MINUTE, SECOND, MILLI = 60_000_000, 1_000_000, 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,4)")


def plus_micros(ts: str, micros: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + micros)


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table, written once per application to the shared folder and read back, as a pipeline stores it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = work_dir(spark, name)
        build(spark, sf_dir).write.option("compression", "zstd").parquet(path)  # random digits hold no repeats: an entropy coder packs them
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


ORDER_TYPE = {
    "1-URGENT": "MARKET", "2-HIGH": "LIMIT", "3-MEDIUM": "STOP", "4-NOT SPECIFIED": "STOP_LIMIT", "5-LOW": "PEGGED",
}
ORDER_STATUS = {"O": "WORKING", "F": "FILLED", "P": "PARTIALLY_FILLED"}


def choose(c: str, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(c) == k, v) if out is None else out.when(F.col(c) == k, v)
    return out


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("party_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_ts"), F.to_date("o_orderdate").alias("order_date"),
        choose("o_orderstatus", ORDER_STATUS).alias("order_status"),
        choose("o_orderpriority", ORDER_TYPE).alias("order_type"), money("o_totalprice").alias("order_total"),
    )


def line_columns() -> list[Column]:
    """A line item's columns in the trade domain, with a hash of the whole row as its id."""
    dec = "decimal(18,2)"
    text = F.concat_ws(
        "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        *[F.col(c).cast(dec).cast("string") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        "l_returnflag", "l_linestatus", F.to_date("l_shipdate").cast("string"),
    )
    return [
        F.sha2(text, 256).alias("fill_id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("instrument_id"), F.col("l_suppkey").alias("venue_id"),
        F.col("l_linenumber").alias("line_no"), money("l_quantity").alias("quantity"),
        money("l_extendedprice").alias("amount"),
        (F.col("l_extendedprice").cast(dec) / F.col("l_quantity").cast(dec)).cast("decimal(18,8)").alias("price"),
        money("l_discount").alias("discount"), money("l_tax").alias("tax"),
        F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("side"),
        F.when(F.col("l_linestatus") == "F", "SETTLED").otherwise("FAILED").alias("settlement_status"),
        F.col("l_returnflag").alias("return_flag"), F.to_date("l_shipdate").alias("settle_date"),
    ]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with a hash of the whole row as its id."""
    return table(spark, sf_dir, "lineitem").select(*line_columns())


def fills(spark: SparkSession, sf_dir: str, unsorted: bool = False) -> DataFrame:
    """Line items with their order: the execution stream. The given columns meet the orders, as they are narrower than the hash of a row.
    ``unsorted`` joins by a hash table of the orders in each partition, so the line items are not sorted (and spilled)."""
    o = orders(spark, sf_dir).select(F.col("order_id").alias("l_orderkey"), "party_id", "order_ts", "order_date", "order_type", "order_status")
    both = table(spark, sf_dir, "lineitem").join(o.hint("shuffle_hash") if unsorted else o, "l_orderkey")
    offset = F.col("line_no").cast("long") * MINUTE + (F.col("instrument_id") % 60) * SECOND + (F.col("venue_id") % 1000) * MILLI
    own = ["party_id", "order_ts", "order_date", "order_type", "order_status"]
    return both.select(*line_columns(), *own).withColumn("fill_ts", plus_micros("order_ts", offset))


def order_events(spark: SparkSession, sf_dir: str, unsorted: bool = False) -> DataFrame:
    """Three reportable events per fill: new or child order, route, trade or cancel."""
    f = fills(spark, sf_dir, unsorted)
    traded = F.col("settlement_status") == "SETTLED"

    def event(code: Column, back_seconds: int, is_trade: bool) -> Column:
        hit = traded & F.lit(is_trade)
        return F.struct(
            code.alias("cat_event_code"),
            plus_micros("fill_ts", F.lit(-back_seconds * SECOND)).alias("event_timestamp"),
            F.when(hit, F.col("price")).alias("execution_price"),
            F.when(hit, F.col("quantity")).alias("execution_quantity"),
        )

    steps = F.array(
        event(F.when(F.col("line_no") == 1, "MENO").otherwise("MECO"), 20, False),
        event(F.lit("MEOR"), 10, False),
        event(F.when(traded, "MEOT").otherwise("MEOC"), 0, True),
    )
    limit = (F.col("price") + (F.col("line_no") - 4).cast("decimal(18,8)") / 4).cast("decimal(18,8)")
    e = f.withColumn("limit_price", limit).withColumn("e", F.explode(steps))
    return e.select(
        F.concat_ws("-", "order_id", "line_no").alias("firm_roe_id"), F.col("order_id").cast("string").alias("cat_order_id"),
        "e.cat_event_code", "party_id", "instrument_id", "venue_id", F.col("party_id").alias("account_id"),
        (F.col("party_id") % 25).alias("desk_id"), F.col("venue_id").alias("trader_id"),
        F.col("venue_id").alias("counterparty_id"), "e.event_timestamp",
        F.to_date("e.event_timestamp").alias("event_date"), (F.col("venue_id") * 37 % 1000).alias("event_nanos"),
        "side", "order_type", "quantity", F.col("limit_price").alias("price"), "e.execution_price", "e.execution_quantity",
        F.sha2(F.concat_ws("|", "fill_id", "e.cat_event_code"), 256).alias("dv2_source_hk"), "fill_id",
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-sided quotes per instrument around traded prices."""
    two = "decimal(18,2)"
    px = F.col("price").cast("decimal(18,4)")
    return (
        lines(spark, sf_dir)
        .withColumn("settle_ts", F.col("settle_date").cast("timestamp"))
        .select(
            F.col("fill_id").alias("quote_id"), "instrument_id", "venue_id",
            plus_micros("settle_ts", F.col("line_no").cast("long") * 3600 * SECOND).alias("quote_ts"),
            (px - F.col("discount").cast(two)).alias("bid_price"), (px + F.col("tax").cast(two)).alias("ask_price"),
            "quantity", "return_flag",
        )
    )


def party_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Party changes: one base row per customer, then one change per order (its type is the party's status)."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_id_bk"), F.col("c_name").alias("legal_name"),
        F.col("c_mktsegment").alias("party_type"), F.col("c_nationkey").cast("string").alias("domicile_country"),
    )
    base = c.withColumns(
        {"change_date": F.to_date(F.lit(BASE_DATE)), "seq": F.lit(-1).cast("long"), "party_status": F.lit("ONBOARDED")}
    )
    o = orders(spark, sf_dir).select(
        F.col("party_id").alias("party_id_bk"), F.col("order_date").alias("change_date"), F.col("order_id").alias("seq"),
        F.col("order_type").alias("party_status"),
    )
    return base.unionByName(o.join(c, "party_id_bk"))


def instrument_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument changes; digests order changes of a day, and sort by their bytes as by their digits."""
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("instrument_id_bk"), F.col("p_name").alias("symbol"), F.col("p_type").alias("asset_class"),
    )
    base = p.withColumns(
        {"change_date": F.to_date(F.lit(BASE_DATE)), "seq": F.lit("").cast("binary"), "currency_code": F.lit("USD")}
    )
    li = lines(spark, sf_dir).select(
        F.col("instrument_id").alias("instrument_id_bk"), F.col("settle_date").alias("change_date"),
        F.unhex("fill_id").alias("seq"), F.when(F.col("settlement_status") == "SETTLED", "USD").otherwise("EUR").alias("currency_code"),
    )
    return base.unionByName(li.join(p, "instrument_id_bk"))


def venue_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("venue_id_bk"), F.col("s_name").alias("venue_name"),
        F.lpad(F.col("s_suppkey").cast("string"), 4, "X").alias("mic"),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("country_code"),
    )
    base = s.withColumns(
        {"change_date": F.to_date(F.lit(BASE_DATE)), "seq": F.lit("").cast("binary"), "venue_category": F.lit("N")}
    )
    li = lines(spark, sf_dir).select(
        F.col("venue_id").alias("venue_id_bk"), F.col("settle_date").alias("change_date"), F.unhex("fill_id").alias("seq"),
        F.col("return_flag").alias("venue_category"),
    )
    return base.unionByName(li.join(s, "venue_id_bk"))


def account_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account changes from events; an ``error`` event deletes the account."""
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id_bk"), F.col("c_mktsegment").alias("account_type"),
        F.to_date(F.lit(BASE_DATE)).alias("change_date"), F.lit(-1).cast("long").alias("seq"),
        F.lit("OPEN").alias("account_status"), F.lit("UPSERT").alias("op"),
    )
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("account_id_bk"), F.lit("EVENT").alias("account_type"), F.to_date("ts").alias("change_date"),
        F.col("event_id").alias("seq"), F.col("event_type").alias("account_status"),
        F.when(F.col("event_type") == "error", "DELETE").otherwise("UPSERT").alias("op"),
    )
    return base.unionByName(ev)


def desk_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("desk_id_bk"), F.col("n_name").alias("desk_name"),
        F.concat_ws("/", "r_name", "n_name").alias("desk_hierarchy"), F.col("r_name").alias("region"),
        F.to_date(F.lit(BASE_DATE)).alias("change_date"), F.lit(0).cast("long").alias("seq"),
    )


def trader_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("trader_id_bk"), F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("cat_trader_id"),
        F.sha2(F.lower("s_name"), 256).alias("given_name_hash"), F.col("s_nationkey").cast("string").alias("desk_id_bk"),
        F.to_date(F.lit(BASE_DATE)).alias("change_date"), F.lit(0).cast("long").alias("seq"),
    )


# ---- the same definitions in SQL -------------------------------------------------------------------------------

SQL: dict[str, str] = {
    "orders_s": """
SELECT o_orderkey AS order_id, o_custkey AS party_id, o_orderdate AS order_ts, CAST(o_orderdate AS DATE) AS order_date,
  CASE o_orderstatus WHEN 'O' THEN 'WORKING' WHEN 'F' THEN 'FILLED' WHEN 'P' THEN 'PARTIALLY_FILLED' END AS order_status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'MARKET' WHEN '2-HIGH' THEN 'LIMIT' WHEN '3-MEDIUM' THEN 'STOP'
    WHEN '4-NOT SPECIFIED' THEN 'STOP_LIMIT' WHEN '5-LOW' THEN 'PEGGED' END AS order_type,
  CAST(o_totalprice AS DECIMAL(18,4)) AS order_total
FROM orders""",
    "lines_s": """
SELECT sha256(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,2)),
    CAST(l_extendedprice AS DECIMAL(18,2)), CAST(l_discount AS DECIMAL(18,2)), CAST(l_tax AS DECIMAL(18,2)),
    l_returnflag, l_linestatus, CAST(l_shipdate AS DATE))) AS fill_id,
  l_orderkey AS order_id, l_partkey AS instrument_id, l_suppkey AS venue_id, l_linenumber AS line_no,
  CAST(l_quantity AS DECIMAL(18,4)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,4)) AS amount,
  CAST(round(l_extendedprice / l_quantity, 8) AS DECIMAL(18,8)) AS price,
  CAST(l_discount AS DECIMAL(18,4)) AS discount, CAST(l_tax AS DECIMAL(18,4)) AS tax,
  CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side,
  CASE WHEN l_linestatus = 'F' THEN 'SETTLED' ELSE 'FAILED' END AS settlement_status,
  l_returnflag AS return_flag, CAST(l_shipdate AS DATE) AS settle_date
FROM lineitem""",
    "fills": """
SELECT l.*, o.party_id, o.order_ts, o.order_date, o.order_type, o.order_status,
  make_timestamp(epoch_us(o.order_ts) + l.line_no * 60000000 + (l.instrument_id % 60) * 1000000
    + (l.venue_id % 1000) * 1000) AS fill_ts
FROM lines_s l JOIN orders_s o ON l.order_id = o.order_id""",
    "order_events": """
SELECT order_id || '-' || line_no AS firm_roe_id, CAST(order_id AS VARCHAR) AS cat_order_id, code AS cat_event_code,
  party_id, instrument_id, venue_id, party_id AS account_id, party_id % 25 AS desk_id, venue_id AS trader_id,
  venue_id AS counterparty_id, ts AS event_timestamp, CAST(ts AS DATE) AS event_date, venue_id * 37 % 1000 AS event_nanos,
  side, order_type, quantity, CAST(price + (line_no - 4) * 0.25 AS DECIMAL(18,8)) AS price,
  CASE WHEN code = 'MEOT' THEN price END AS execution_price, CASE WHEN code = 'MEOT' THEN quantity END AS execution_quantity,
  sha256(fill_id || '|' || code) AS dv2_source_hk, fill_id
FROM (
  SELECT *, CASE k WHEN 0 THEN CASE WHEN line_no = 1 THEN 'MENO' ELSE 'MECO' END WHEN 1 THEN 'MEOR'
      ELSE CASE WHEN settlement_status = 'SETTLED' THEN 'MEOT' ELSE 'MEOC' END END AS code,
    make_timestamp(epoch_us(fill_ts) - (2 - k) * 10000000) AS ts
  FROM (SELECT *, unnest([0, 1, 2]) AS k FROM fills))""",
    "quotes": """
SELECT fill_id AS quote_id, instrument_id, venue_id,
  make_timestamp(epoch_us(CAST(settle_date AS TIMESTAMP)) + line_no * 3600000000) AS quote_ts,
  CAST(price AS DECIMAL(18,4)) - discount AS bid_price, CAST(price AS DECIMAL(18,4)) + tax AS ask_price,
  quantity, return_flag
FROM lines_s""",
    "party_feed": """
SELECT c_custkey AS party_id_bk, DATE '1994-12-31' AS change_date, -1 AS seq, c_name AS legal_name,
  c_mktsegment AS party_type, CAST(c_nationkey AS VARCHAR) AS domicile_country, 'ONBOARDED' AS party_status FROM customer
UNION ALL
SELECT c_custkey, order_date, order_id, c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR), order_type
FROM orders_s JOIN customer ON party_id = c_custkey""",
    "instrument_feed": """
SELECT p_partkey AS instrument_id_bk, DATE '1994-12-31' AS change_date, '' AS seq, p_name AS symbol,
  p_type AS asset_class, 'USD' AS currency_code FROM part
UNION ALL
SELECT p_partkey, settle_date, fill_id, p_name, p_type, CASE WHEN settlement_status = 'SETTLED' THEN 'USD' ELSE 'EUR' END
FROM lines_s JOIN part ON instrument_id = p_partkey""",
    "venue_feed": """
SELECT s_suppkey AS venue_id_bk, DATE '1994-12-31' AS change_date, '' AS seq, s_name AS venue_name,
  lpad(CAST(s_suppkey AS VARCHAR), 4, 'X') AS mic, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS country_code,
  'N' AS venue_category FROM supplier
UNION ALL
SELECT s_suppkey, settle_date, fill_id, s_name, lpad(CAST(s_suppkey AS VARCHAR), 4, 'X'),
  lpad(CAST(s_nationkey AS VARCHAR), 2, '0'), return_flag
FROM lines_s JOIN supplier ON venue_id = s_suppkey""",
    "account_feed": """
SELECT c_custkey AS account_id_bk, DATE '1994-12-31' AS change_date, -1 AS seq, c_mktsegment AS account_type,
  'OPEN' AS account_status, 'UPSERT' AS op FROM customer
UNION ALL
SELECT user_id, CAST(ts AS DATE), event_id, 'EVENT', event_type, CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END
FROM events""",
    "desk_feed": """
SELECT CAST(n_nationkey AS BIGINT) AS desk_id_bk, n_name AS desk_name, r_name || '/' || n_name AS desk_hierarchy,
  r_name AS region, DATE '1994-12-31' AS change_date, 0 AS seq
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "trader_feed": """
SELECT s_suppkey AS trader_id_bk, 'T' || s_suppkey AS cat_trader_id, sha256(lower(s_name)) AS given_name_hash,
  CAST(s_nationkey AS VARCHAR) AS desk_id_bk, DATE '1994-12-31' AS change_date, 0 AS seq
FROM supplier""",
}

NEEDS = {
    "fills": ["orders_s", "lines_s"], "order_events": ["fills"], "quotes": ["lines_s"], "party_feed": ["orders_s"],
    "instrument_feed": ["lines_s"], "venue_feed": ["lines_s"],
}


def with_stage(names: str, body: str) -> str:
    """``WITH`` the named staged tables (and what they need), then ``body``; a body may start with more CTEs."""
    seen: list[str] = []

    def visit(n: str) -> None:
        for d in NEEDS.get(n, []):
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names.split():
        visit(n)
    head = ",\n".join(f"{n} AS ({SQL[n].strip()})" for n in seen)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def scd2_sql(name: str, feed: str, key: str, tracked: list[str], carried: list[str] = (), op: str | None = None,
             sk: str | None = None, seq: str = "seq", hash_order: list[str] | None = None) -> str:
    """CTEs that build day-grain versions of ``feed`` with window functions. ``hash_order`` lists all hashed columns,
    also those the feed lacks."""
    hashed = ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), '')" if c in tracked else "''" for c in (hash_order or tracked)
    )
    live = f"CASE WHEN {op} <> 'DELETE' THEN row_hash END" if op else "row_hash"
    sk_sql = (
        f", CAST('0x' || substr(sha256({key} || '|' || change_date), 1, 15) AS BIGINT) AS {sk}" if sk else ""
    )
    return f"""{name}_d AS (SELECT *, row_number() OVER (PARTITION BY {key}, change_date ORDER BY {seq} DESC) AS rn FROM {feed}),
{name}_h AS (SELECT *, sha256(concat_ws('|', {hashed})) AS row_hash FROM {name}_d WHERE rn = 1),
{name}_s AS (SELECT *, {live} AS st FROM {name}_h),
{name}_t AS (SELECT *, lag(st) OVER (PARTITION BY {key} ORDER BY change_date) AS before FROM {name}_s),
{name}_v AS (SELECT *, lead(change_date) OVER (PARTITION BY {key} ORDER BY change_date) AS nxt
  FROM {name}_t WHERE st IS DISTINCT FROM before),
{name} AS (SELECT {key}, {', '.join([*tracked, *carried])}, change_date AS effective_start_date,
  coalesce(nxt - 1, DATE '9999-12-31') AS effective_end_date, nxt IS NULL AS is_current, row_hash{sk_sql}
  FROM {name}_v WHERE st IS NOT NULL)"""


DIM_SQL = {
    "dim_party": scd2_sql(
        "dim_party", "party_feed", "party_id_bk", ["party_type", "party_status", "domicile_country"], ["legal_name"],
        sk="dim_party_sk",
        hash_order="lei cat_imid crd fdid party_type party_status legal_form incorporation_country domicile_country tax_residency "
        "ultimate_parent_party_id g_sib_flag pep_flag mifid_ii_category".split(),
    ),
    "dim_instrument": scd2_sql(
        "dim_instrument", "instrument_feed", "instrument_id_bk", ["symbol", "asset_class", "currency_code"],
        sk="dim_instrument_sk",
        hash_order="isin cusip figi symbol asset_class cfi_code issuer_party_id currency_code primary_listing_mic".split(),
    ),
    "dim_venue": scd2_sql(
        "dim_venue", "venue_feed", "venue_id_bk", ["mic", "venue_name", "venue_category", "country_code"],
        sk="dim_venue_sk", hash_order="mic venue_name venue_category country_code operating_segment".split(),
    ),
    "dim_account": scd2_sql(
        "dim_account", "account_feed", "account_id_bk", ["account_type", "account_status"], op="op", sk="dim_account_sk",
        hash_order="account_type account_status custodian_id clearing_member_id cat_large_trader_flag".split(),
    ),
    "dim_desk": scd2_sql(
        "dim_desk", "desk_feed", "desk_id_bk", ["desk_name", "desk_hierarchy", "region"], sk="dim_desk_sk",
        hash_order="desk_name desk_hierarchy region asset_class_coverage".split(),
    ),
    "dim_trader": scd2_sql(
        "dim_trader", "trader_feed", "trader_id_bk", ["cat_trader_id", "given_name_hash", "desk_id_bk"], sk="dim_trader_sk",
        hash_order="cat_trader_id given_name_hash family_name_hash desk_id_bk active_flag".split(),
    ),
}
DIM_FEED = {
    "dim_party": "party_feed", "dim_instrument": "instrument_feed", "dim_venue": "venue_feed",
    "dim_account": "account_feed", "dim_desk": "desk_feed", "dim_trader": "trader_feed",
}


def with_dims(stages: str, dims: str, body: str) -> str:
    """``with_stage`` plus the named dimensions (``party venue`` ...)."""
    names = [f"dim_{d}" for d in dims.split()]
    body = body.strip()
    rest = ",\n" + body[5:] if body[:5].upper() == "WITH " else "\n" + body
    ctes = ",\n".join(DIM_SQL[n] for n in names)
    return with_stage(" ".join([*stages.split(), *[DIM_FEED[n] for n in names]]), f"WITH {ctes}{rest}")
