import datetime as dt

from pyspark.sql import functions as F

from rows_helper import rows
from tradevault.functions.hashing import hash_key, row_hash
from tradevault.operators import quality, scd2, vault

CH = "k string, change_date date, seq long, v string, op string"
D = lambda n: dt.date(2024, 1, n)
OPEN = dt.date(9999, 12, 31)
FEED = [
    ("a", D(1), 1, "x", "UPSERT"), ("a", D(1), 2, "y", "UPSERT"),  # two changes on one day: the last counts
    ("a", D(3), 3, "y", "UPSERT"),  # unchanged repeat
    ("a", D(5), 4, "z", "UPSERT"),
    ("b", D(1), 5, "x", "UPSERT"), ("b", D(4), 6, "x", "DELETE"), ("b", D(8), 7, "x", "UPSERT"),  # delete, re-insert
    ("c", D(2), 8, "x", "DELETE"),  # delete of an unknown key
]
WANT = [
    ("a", "y", D(1), D(4), False), ("a", "z", D(5), OPEN, True),
    ("b", "x", D(1), D(3), False), ("b", "x", D(8), OPEN, True),
]
COLS = ["k", "v", "effective_start_date", "effective_end_date", "is_current"]


def build(df):
    return scd2.scd2_build(df, ["k"], "change_date", ["seq"], ["v"], op_col="op")


def test_build_from_any_order(spark):
    for feed in (FEED, FEED[::-1], FEED[::2] + FEED[1::2]):
        assert rows(build(spark.createDataFrame(feed, CH)), *COLS) == WANT


def test_upsert_closes_and_opens_in_one_pass_and_is_idempotent(spark):
    old = build(spark.createDataFrame(FEED[:3] + FEED[4:5], CH))
    batch = spark.createDataFrame([FEED[3], FEED[5], FEED[6]], CH)
    once = scd2.scd2_upsert(old, batch, ["k"], ["v"])
    assert rows(once, *COLS) == WANT
    assert rows(scd2.scd2_upsert(once, batch, ["k"], ["v"]), *COLS) == WANT


def test_late_change_splits_a_published_version(spark):
    history = spark.createDataFrame(FEED, CH)
    late = spark.createDataFrame([("a", D(2), 9, "q", "UPSERT")], CH)
    want = build(history.unionByName(late))
    got = scd2.scd2_upsert(build(history), late, ["k"], ["v"], history=history)
    assert rows(got, *COLS) == rows(want, *COLS)
    # the repeat of y on day 3, dropped from the first build, reappears after the late change
    assert ("a", "y", D(3), D(4), False) in rows(got, *COLS)


def test_invariants_hold_and_report_damage(spark):
    dim = build(spark.createDataFrame(FEED, CH)).withColumn("dv2_source_hk", F.lit("x"))
    assert all(r["broken"] == 0 for r in quality.scd2_invariants(dim, "k").collect())
    bad = dim.unionByName(dim.filter("k = 'a' and is_current"))
    broken = {r["rule"]: r["broken"] for r in quality.scd2_invariants(bad, "k").collect()}
    assert broken["one_current_row"] == 1 and broken["no_overlap"] == 1


def test_hash_guards_nulls_and_shifts(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None), ("a", "")], "x string, y string")
    h = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert h[0] == h[1] and h[2] == h[3] and h[0] != h[2]
    k = [r[0] for r in df.select(hash_key(["x", "y"])).collect()]
    assert len(set(k)) == 4
    same = spark.createDataFrame([(" Ab ",), ("ab",)], "x string").select(hash_key(["x"])).distinct()
    assert same.count() == 1


def test_satellite_load_is_idempotent_and_places_late_rows(spark):
    S = "hk string, load_date timestamp, v string"
    t = lambda n: dt.datetime(2024, 1, n, 10)
    stage = spark.createDataFrame([("h", t(1), "a"), ("h", t(2), "a"), ("h", t(3), "b")], S)
    first = vault.load_sat(stage, "hk", ["v"])
    assert rows(first, "load_date", "v") == [(t(1), "a"), (t(3), "b")]
    assert vault.load_sat(stage, "hk", ["v"], existing=first).count() == 0
    late = spark.createDataFrame([("h", t(2), "c")], S)
    assert rows(vault.load_sat(late, "hk", ["v"], existing=first), "load_date", "v") == [(t(2), "c")]


def test_hub_and_link_keep_first_load(spark):
    t = lambda n: dt.datetime(2024, 1, n)
    stage = spark.createDataFrame([("P1", t(2)), ("p1 ", t(1)), ("P2", t(3))], "id string, load_date timestamp")
    hub = vault.load_hub(stage, "party", ["id"], "SRC")
    assert hub.count() == 2 and hub.agg(F.min("load_date")).first()[0] == t(1)
    assert vault.load_hub(stage, "party", ["id"], "SRC", existing=hub).count() == 0
    assert quality.bad_hub_keys(hub, "party").count() == 0
