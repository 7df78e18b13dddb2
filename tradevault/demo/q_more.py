"""Registered queries: scalar groups, scheduled runs, in-stream deduplication, and items that share a definition."""

from pyspark.sql import functions as F

from tradevault.demo import stage as s
from tradevault.demo.registry import alias, query
from tradevault.session import work_dir
from tradevault.streaming import flows


@query("F2_text_functions", """
SELECT c_custkey, upper(c_mktsegment) AS up, substr(c_name, 1, 8) AS head, CAST(length(c_name) AS BIGINT) AS len, c_mktsegment || ':' || c_custkey AS joined,
  regexp_matches(c_name, '^Customer#[0-9]{9}$') AS well_formed FROM customer""")
def f2(spark, d):
    return s.table(spark, d, "customer").select(
        "c_custkey", F.upper("c_mktsegment").alias("up"), F.substring("c_name", 1, 8).alias("head"), F.length("c_name").alias("len"),
        F.concat("c_mktsegment", F.lit(":"), F.col("c_custkey").cast("string")).alias("joined"), F.col("c_name").rlike("^Customer#[0-9]{9}$").alias("well_formed"),
    )


@query("F3_date_functions", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS key, CAST(CAST(o_orderdate AS DATE) + 3 AS VARCHAR) AS plus_three, CAST(dayofweek(o_orderdate) + 1 AS BIGINT) AS day_of_week,
  CAST(weekofyear(o_orderdate) AS BIGINT) AS week_of_year, CAST(quarter(o_orderdate) AS BIGINT) AS quarter, CAST(DATE '2001-12-31' - CAST(o_orderdate AS DATE) AS BIGINT) AS days_left,
  CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS month_start FROM orders""")
def f3(spark, d):
    day = F.to_date("o_orderdate")
    return s.table(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("key"), F.date_add(day, 3).alias("plus_three"), F.dayofweek(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"), F.quarter(day).alias("quarter"), F.datediff(F.to_date(F.lit("2001-12-31")), day).alias("days_left"),
        F.trunc(day, "month").alias("month_start"),
    )


@query("F5_typed_casts", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)::BIGINT AS k, TRY_CAST(event_type AS INTEGER)::BIGINT AS not_a_number, CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS amount FROM events""")
def f5(spark, d):
    return s.table(spark, d, "events").select(
        "event_id", F.expr("try_cast(get_json_object(props, '$.k') as int)").alias("k"), F.expr("try_cast(event_type as int)").alias("not_a_number"),
        F.col("value").cast("decimal(18,4)").alias("amount"),
    )


@query("ST6_scheduled_runs", """
SELECT event_id, CASE WHEN CAST(ts AS DATE) < DATE '2024-01-16' THEN 0 ELSE 1 END AS run FROM events""")
def st6(spark, d):
    """Two landings, each picked up by one scheduled run; a third run finds nothing."""
    base = work_dir(spark, "st6")
    ev = s.table(spark, d, "events").select("event_id", "ts")
    late = F.to_date("ts") >= F.to_date(F.lit("2024-01-16"))

    def each(batch, no):
        batch.select("event_id").write.mode("overwrite").parquet(f"{base}/out/tv_batch={no}")

    for part in (ev.filter(~late), ev.filter(late), None):
        if part is not None:
            part.write.mode("append").parquet(f"{base}/in")
        flows.run_available(spark.readStream.schema(ev.schema).parquet(f"{base}/in"), f"{base}/cp", each)
    return spark.read.parquet(f"{base}/out").select("event_id", F.col("tv_batch").alias("run"))


@query("ST4_deduplicated_stream", "SELECT DISTINCT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date FROM events")
def st4b(spark, d):
    base = work_dir(spark, "st4b")
    ev = s.table(spark, d, "events").select("user_id", "event_type", F.to_date("ts").alias("event_date"), F.col("ts").cast("timestamp").alias("event_timestamp"))
    ev.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(ev.schema).parquet(f"{base}/in")
    out = flows.deduplicated(stream, ["user_id", "event_type", "event_date"])
    flows.append_files(out, f"{base}/out", f"{base}/cp").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("user_id", "event_type", "event_date")


for _name, _of in {
    "B5_party_instrument_activity": "A9_party_instrument_activity", "B12_fail_risk": "A17_fail_rate", "B13_derived_order_link": "J12_derived_order_link",
    "B14_beneficial_owners": "J13_ownership_chains", "B15_daily_lifecycle": "A8_daily_lifecycle", "B16_venue_quality": "A10_venue_quality_hourly",
    "B17_event_coverage": "A11_event_coverage", "B18_counterparty_exposure": "A12_counterparty_exposure", "J11_link_chain_bridge": "B1_trade_lifecycle",
}.items():
    alias(_name, _of)
