"""Keys shuffled as bytes and once: narrowed text, plain windows where no key is large, links joined from the last stage back."""

import contextlib
import io

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rows_helper import rows
from tradevault.functions.hashing import hash_key, key_part, narrow, narrow_join, part_hash, widened
from tradevault.functions.ordered import in_order
from tradevault.operators import vault
from tradevault.operators.joins import expand_left, key_splits
from tradevault.plans import bridges, submission
from tradevault.sources import tables


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


def test_narrowed_text_comes_back(spark):
    texts = [None, "", "a", "ab", "AB", "0f" * 32, "0F" * 32, "abc", "xyz", " ab", "ÿé", "\x01", "12", "123"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("n", narrow("t")).withColumn("back", widened("n"))
    got = df.collect()
    assert all(r["t"] == r["back"] for r in got)
    assert len({bytes(r["n"]) for r in got if r["n"] is not None}) == len(texts) - 1
    assert {len(r["n"]) for r in got if r["t"] == "0f" * 32} == {33}


@pytest.mark.parametrize("target", [3, 10_000])
def test_in_order_equals_the_plain_window(spark, target):
    data = [("hot" if i % 3 else None if i % 2 else f"k{i}", i % 40, i, None if i % 5 else "v", i % 7) for i in range(300)]
    df = spark.createDataFrame(data, "k string, t long, id long, v string, n int")
    out = in_order(df, ["k"], ["t", "id"], target_rows=target, lag={"b": "v"}, lead={"a": "n"}, number="no", running={"total": "n"}, fill={"seen": "v"})
    w = Window.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("*", F.lag("v").over(w), F.lead("n").over(w), F.row_number().over(w), F.sum("n").over(upto), F.last("v", True).over(upto))
    assert rows(out, *out.columns) == rows(want, "*")


def test_rows_are_shuffled_once_where_no_key_is_large(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 1, 3)], "k string, t long, v long")
    assert shuffles(in_order(df, ["k"], ["t"], number="no", lag={"b": "v"})) == 1
    assert shuffles(vault.load_sat(df, "k", ["v"], load="t")) == 1


def test_sat_keeps_rows_and_key_text(spark):
    stage = spark.createDataFrame([("ab", 1, "x"), ("ab", 2, "x"), ("ab", 3, "y"), ("ab", 3, "y"), (None, 1, None), (None, 2, "z"), ("K1", 5, "x")], "hk string, t long, v string")
    assert rows(vault.load_sat(stage, "hk", ["v"], load="t"), "hk", "load_date", "v") == sorted(
        [("ab", 1, "x"), ("ab", 3, "y"), (None, 1, None), (None, 2, "z"), ("K1", 5, "x")], key=repr)


def test_splits_do_not_shuffle_distinct_keys(spark):
    child = spark.createDataFrame([("hot", i) for i in range(40)] + [(f"k{i}", i) for i in range(30)] + [(None, i) for i in range(50)], "k string, c int")
    out = key_splits(child, "k", 10)
    assert rows(out, *out.columns) == [("hot", 4)]
    text = plan(out)
    assert "hashpartitioning(__bin" in text and text.index("hashpartitioning(k#") < text.index("hashpartitioning(__bin")
    assert "__bin" in text[text.index("hashpartitioning(k#"):text.index("hashpartitioning(__bin")]


@pytest.mark.parametrize("known", [True, False])
def test_links_are_joined_from_the_last_stage(spark, known):
    orders = spark.createDataFrame([("o1", "p", "WORKING"), ("o1", "q", "WORKING"), ("o2", "p", "CANCELLED"), (None, "p", "WORKING")], "order_hk string, party_hk string, order_status string")
    links = {
        "execution": spark.createDataFrame([("o1", "e1", "i"), ("o1", "e2", "i"), ("o1", "e2", "j"), (None, "e3", "i")], "order_hk string, execution_hk string, instrument_hk string"),
        "allocation": spark.createDataFrame([("e1", "a1"), ("e1", "a1"), ("e2", None), ("e9", "a9")], "execution_hk string, allocation_hk string"),
        "clearing": spark.createDataFrame([("e2", "c1"), ("e2", "c2")], "execution_hk string, clearing_hk string"),
        "settlement": spark.createDataFrame([("a1", "s1", "SETTLED"), ("a1", "s2", "FAILED"), (None, "s3", "SETTLED")], "allocation_hk string, settlement_hk string, settlement_status string"),
    }
    out = bridges.trade_lifecycle(orders, links, {n: () for n in links} if known else None)
    want = orders
    for stage, key in (("execution", "order_hk"), ("allocation", "execution_hk"), ("clearing", "execution_hk"), ("settlement", "allocation_hk")):
        want = want.join(links[stage], key, "left")
    cols = ["order_hk", "party_hk", "order_status", "execution_hk", "instrument_hk", "allocation_hk", "clearing_hk", "settlement_hk", "settlement_status"]
    assert rows(out, *cols) == rows(want, *cols) and out.count() > 8
    assert out.filter("quote_hk is null and confirmation_hk is null").count() == out.count()


def test_keys_are_hashed_after_the_joins(spark):
    orders = spark.createDataFrame([(1, 7), (2, 7), (None, 7)], "id long, p long").select(narrow(key_part("id")).alias("order_hk"), F.lit("p").alias("party_hk"), F.lit("WORKING").alias("order_status"))
    link = spark.createDataFrame([(1, "ab"), (None, "cd")], "id long, e string").select(narrow(key_part("id")).alias("order_hk"), narrow(key_part("e")).alias("execution_hk"), F.lit("i").alias("instrument_hk"))
    keys = {"order_hk": part_hash(widened("order_hk"), "OMS"), "execution_hk": part_hash(widened("execution_hk"), "EXE")}
    out = bridges.trade_lifecycle(orders, {"execution": link}, {"execution": ()}, keys)
    plain_keys = spark.createDataFrame([(1, "ab"), (2, None), (None, "cd")], "id long, e string")
    want = plain_keys.select(hash_key(["id"], "OMS"), F.when(F.col("e").isNotNull(), hash_key(["e"], "EXE")))
    assert rows(out, "order_hk", "execution_hk") == rows(want, "*")


def test_left_join_without_large_keys_is_plain(spark):
    parent = spark.createDataFrame([("a", 1), ("n", 2), (None, 3)], "k string, p int")
    child = spark.createDataFrame([("a", 1), ("a", 2), (None, 9)], "k string, c int")
    out = expand_left(parent, child, "k", splits=())
    assert rows(out, "k", "p", "c") == rows(parent.join(child, "k", "left"), "k", "p", "c") and "__salt" not in plan(out)


def test_join_moves_text_as_bytes(spark):
    left = spark.createDataFrame([("ab", "x", 1), ("AB", "y", 2), (None, "z", 3), ("ab", None, 4)], "k string, v string, n int")
    right = spark.createDataFrame([("ab", "0f"), ("ab", "g"), (None, "h")], "k string, w string")
    for how in ("inner", "left"):
        out = narrow_join(left, right, "k", how)
        assert out.columns == ["k", "v", "n", "w"]
        assert rows(out, *out.columns) == rows(left.join(right, "k", how), "k", "v", "n", "w")


def test_partitioned_write_moves_text_as_bytes(spark, tmp_path):
    df = spark.createDataFrame([("m1", "ab" * 32, 2), ("m1", None, 1), ("m2", "AB", 3), (None, "", 4)], "m string, h string, n int")
    tables.write_partitioned(df, str(tmp_path / "t"), ["m"], ["n"])
    assert rows(spark.read.parquet(str(tmp_path / "t")), "m", "h", "n") == rows(df, "m", "h", "n")
    assert list((tmp_path / "t" / "m=m1").glob("*.zstd.parquet"))


def test_file_numbers_do_not_depend_on_the_bytes(spark):
    data = [(f"{i:02x}" * 4, "900", str(i % 2), "2024-01-01", "" if i % 3 else None, "{}") for i in range(30)]
    df = spark.createDataFrame(data, "id string, submitter_id string, reporter_crd string, gen_date string, file_group string, line string").withColumn("gen_date", F.to_date("gen_date"))
    out = submission.split_files(df, "id", 4)
    w = Window.partitionBy(*submission.FILE_KEY).orderBy(F.sha2("id", 256), "id")
    assert rows(out, "id", "record_no", "file_group", "line") == rows(df.withColumn("record_no", F.row_number().over(w)), "id", "record_no", "file_group", "line")
