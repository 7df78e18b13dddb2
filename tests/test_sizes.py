"""What grows with the input: stream state, dimensions that a query does not use, keys moved as text."""

import contextlib
import io

from pyspark.sql import functions as F

from rows_helper import rows
from tradevault.demo import catalog  # noqa: F401  (fills the registry)
from tradevault.demo import q_flows, q_ops, stage
from tradevault.operators import vault
from tradevault.plans import facts
from tradevault.streaming import flows


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_stream_parts_do_not_split_a_time(spark):
    df = spark.createDataFrame([(i, i // 7) for i in range(100)] + [(100, None)], "id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    cuts = flows.time_parts(df, "ts", 30)
    out = df.withColumn("part", flows.part_of("ts", cuts))
    assert flows.time_parts(df, "ts", 1000) == [] and 2 <= len(cuts) <= 3
    assert out.filter("s is not null").groupBy("s").agg(F.countDistinct("part").alias("n")).filter("n > 1").isEmpty()
    assert out.filter("s is null").first()["part"] == 0
    assert rows(out.filter("s is not null").groupBy("part").agg((F.max("s") - F.min("s") < 7).alias("near")), "near") == [(True,)] * (len(cuts) + 1)


def test_late_allocations_in_parts(spark, tmp_path, monkeypatch):
    from datetime import datetime, timedelta

    first = datetime(1996, 1, 1)
    o = [(i, float(i % 5), first + timedelta(days=i)) for i in range(30)]
    li = [(i, 1, 1, n, 1.0, 2.0, 0.0, 0.0, "R", "F", first) for i in range(30) for n in (1, 2, 6)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(li, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.createDataFrame(o, "o_orderkey long, o_totalprice double, o_orderdate timestamp")
    orders.selectExpr("*", "1L o_custkey", "'O' o_orderstatus", "'5-LOW' o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(q_flows, "ST7_ROWS", 25)
    runs = []
    start = flows.append_files
    monkeypatch.setattr(flows, "append_files", lambda *a, **k: runs.append(1) or start(*a, **k))
    got = q_flows.st7(spark, str(tmp_path))
    want = stage.lines(spark, str(tmp_path)).select("fill_id", "order_id", F.expr("line_no not in (6, 7)").alias("matched"))
    assert rows(got, *want.columns) == rows(want, *want.columns) and len(runs) > 2


def test_headers_build_no_instrument_dimension(spark, sf, monkeypatch):
    asked = []
    real = q_ops.stored_dim
    monkeypatch.setattr(q_ops, "stored_dim", lambda sp, d, name: asked.append(name) or real(sp, d, name))
    q_ops.g15(spark, sf)
    assert asked == ["party"]


def test_hash_of_a_fill_passes_joins_as_bytes(spark, sf):
    assert "unhex" in plan(q_ops.q7b(spark, sf))


def test_leg_key_passes_joins_as_bytes(spark):
    header = spark.createDataFrame([("o1", "e1"), ("o2", "e2")], "multileg_order_hk string, multileg_event_hk string")
    legs = spark.createDataFrame([("o1", "0f", 7, 1, "BUY"), ("o1", "0F", 7, 1, "SELL"), ("o2", "x", 8, 1, "BUY"), ("o2", None, 7, 1, "BUY")], "multileg_order_hk string, multileg_leg_hk string, leg_instrument_id long, leg_ratio int, leg_side string")
    sat = spark.createDataFrame([("0f", 1.0, None), ("0F", 2.0, None), ("x", 3.0, None), (None, 4.0, None)], "multileg_leg_hk string, leg_quantity double, load_end_dts timestamp")
    dim = spark.createDataFrame([(7, 70, "S", True), (8, 80, "T", True)], "instrument_id_bk long, dim_instrument_sk long, symbol string, is_current boolean")
    out = facts.expand_legs(header, legs, sat, dim)
    assert rows(out, "multileg_leg_hk", "leg_quantity", "instrument_sk") == [("0F", 2.0, 70), ("0f", 1.0, 70), ("x", 3.0, 80)]
    assert "unhex" in plan(out)


def test_vault_keys_are_shuffled_as_bytes(spark):
    stage_rows = spark.createDataFrame([("A", 2, "0f", None), ("a", 1, "0F", "k"), ("b", 1, "0f", None)], "id string, load_date long, m1 string, m2 string")
    hub = vault.load_hub(stage_rows, "x", ["id"], "SRC")
    assert rows(hub, "x_bk", "load_date", "record_source") == [("a", 1, "SRC"), ("b", 1, "SRC")] and "unhex" in plan(hub)
    link = vault.load_link(stage_rows, "link", {"m1": "m1", "m2": "m2"}, "SRC")
    assert link.columns == ["link_hk", "m1", "m2", "load_date", "record_source"] and "unhex" in plan(link)
    assert rows(link, "m1", "m2", "load_date") == [("0F", "k", 1), ("0f", None, 1)]
