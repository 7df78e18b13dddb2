"""Registered queries: staging."""

from pyspark.sql import functions as F

from tradevault.demo import stage as s
from tradevault.demo.registry import query
from tradevault.plans import facts


@query("IO1_table_scan", s.with_stage("fills", """
SELECT fill_id, order_id, instrument_id, venue_id, line_no, CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price,
  side, settlement_status, party_id, CAST(settle_date AS VARCHAR) AS settle_date,
  strftime(fill_ts, '%Y-%m-%d %H:%M:%S.%f') AS fill_ts FROM fills"""))
def io1(spark, d):
    return s.fills(spark, d).select(
        "fill_id", "order_id", "instrument_id", "venue_id", "line_no", "quantity", "price", "side", "settlement_status",
        "party_id", "settle_date", "fill_ts",
    )


@query("P1_curate_events", s.with_stage("order_events", """
SELECT firm_roe_id, cat_order_id, cat_event_code, party_id, instrument_id, event_nanos, side, order_type,
  CAST(price AS DOUBLE) AS price, CAST(execution_price AS DOUBLE) AS execution_price, dv2_source_hk,
  strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp, CAST(event_date AS VARCHAR) AS event_date FROM order_events"""))
def p1(spark, d):
    """The events under raw names, curated back to the event shape by a mapping of names and expressions."""
    names = ["firm_roe_id", "cat_order_id", "cat_event_code", "party_id", "instrument_id", "event_nanos", "side", "order_type", "price", "execution_price", "dv2_source_hk"]
    raw = s.order_events(spark, d).select(*[F.col(n).alias(f"raw_{n}") for n in names], F.unix_micros("event_timestamp").alias("raw_micros"))
    at = F.timestamp_micros("raw_micros")
    return facts.curate(raw, {**{n: f"raw_{n}" for n in names}, "event_timestamp": at, "event_date": F.to_date(at)})
