"""What is shuffled and broadcast: a key once, no hash of a row where its columns do, no spread dimension."""

import contextlib
import io
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from rows_helper import rows
from tradevault.demo import catalog, q_derived, q_flows, q_gold, q_ops, stage  # noqa: F401  (the catalog first, as it orders the imports)
from tradevault.functions import ordered
from tradevault.functions.hashing import hash_key, link_key
from tradevault.functions.ordered import share_of
from tradevault.operators import interval, joins
from tradevault.operators.interval import pit_lookup
from tradevault.plans import facts, integrity, submission, views
from tradevault.streaming import merged


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_share_keeps_the_columns_and_shuffles_the_key_once(spark):
    df = spark.createDataFrame([(1, "a", 1, "x"), (2, "a", 3, "y"), (3, None, 4, "z")], "id long, k string, q int, v string")
    out = share_of(df, ["k"], "q", "s")
    assert out.columns == ["id", "k", "q", "v", "s"]
    assert rows(out, *out.columns) == [(1, "a", 1, "x", 0.25), (2, "a", 3, "y", 0.75), (3, None, 4, "z", 1.0)]
    assert not re.search(r"Project \[[^\n]*\bk#\d+[^\n]*struct\(c0, k#\d+\) AS __key", plan(out))


def test_fills_hash_after_the_join(spark, sf):
    text = plan(stage.fills(spark, sf))
    assert "sha2" in text and text.index("sha2") < text.index("Join")
    assert "sha2" not in text[text.index("Join"):]


def test_spread_versions_are_not_broadcast(spark):
    fact = spark.createDataFrame([(1, "2024-02-01")], "key long, d string").select("key", F.to_date("d").alias("day"))
    dim = spark.createDataFrame([(1, 7, "2000-01-01", "2024-03-31"), (1, 8, "2024-04-01", "9999-12-31")], "k long, sk long, s string, e string")
    dim = dim.select("k", "sk", F.to_date("s").alias("effective_start_date"), F.to_date("e").alias("effective_end_date"))
    for span in (("2024-02-01", "2024-02-01"), None):
        out = pit_lookup(fact, dim, "key", "k", "day", {"sk": "sk"}, span=span)
        assert [tuple(r[c] for c in ("key", "sk")) for r in out.collect()] == [(1, 7)]
        assert not [line for line in plan(out).splitlines() if "BroadcastHashJoin" in line and "__b" in line]


def test_option_view_shuffles_line_items_once_and_sorts_none(spark, sf):
    """All three families read one shuffle of the line items, and no join of theirs sorts it."""
    text = plan(q_ops.option_view(spark, sf))
    assert text.count("ShuffledHashJoin") == 3 and "SortMergeJoin" not in text and "BroadcastHashJoin" not in text and "Sort [" not in text


def test_signed_fills_are_made_in_one_pass(spark, sf):
    """Right, wrong and withdrawn fills come from one join; the same rows as from a branch each."""
    got = q_flows.signed_fills(spark, sf)
    assert len(re.findall(r"\w+Join\b", plan(got))) == 1
    k = F.pmod(F.xxhash64("fill_id"), F.lit(21))
    f = stage.fills(spark, sf).withColumnRenamed("order_date", "fact_date").withColumn("k", k)
    right = f.withColumns({"sign": F.lit(1), "no": F.when(F.col("k") % 7 == 0, 2).otherwise((F.col("k") % 3).cast("int"))})
    wrong = f.filter("k % 7 = 0").withColumn("amount", (F.col("amount") + 1).cast("decimal(18,4)"))
    late = wrong.withColumns({"sign": F.lit(1), "no": F.when(F.col("k") == 0, 2).otherwise(0)})
    want = right.unionByName(late).unionByName(wrong.withColumns({"sign": F.lit(-1), "no": F.lit(1)}))
    assert rows(got, *got.columns) == rows(want, *got.columns)


def test_newest_rows_need_no_join(spark):
    table = merged.MergeTable(spark, "unused", ["k"])
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("a", 3, 1), (None, 4, 0), (None, 5, 2)], "k string, v int, tv_batch int")
    out = table.newest(df)
    assert "Join" not in plan(out) and rows(out, "k", "v") == [("a", 2), ("a", 3), (None, 5)]


def test_files_of_cut_groups_count_chunks_and_shuffle_no_lines(spark, monkeypatch):
    """Numbers of a group that is cut are those of one window; the cut needs no second window, and the id is not ordered by."""
    data = [(f"{i:02x}" * 4 if i % 9 else None, str(i % 2), "{}") for i in range(60)] + [("same", "0", "{}")] * 9
    df = spark.createDataFrame(data, "id string, reporter_crd string, line string")
    df = df.withColumns({"submitter_id": F.lit("900"), "gen_date": F.lit("2024-01-01").cast("date"), "file_group": F.lit(None).cast("string")})
    want = df.withColumn("record_no", F.row_number().over(Window.partitionBy(*submission.FILE_KEY).orderBy(F.sha2("id", 256), "id")).cast("long"))
    monkeypatch.setattr(ordered, "TARGET_ROWS", 5)
    out = submission.split_files(df, "id", 4)
    assert rows(out, "id", "reporter_crd", "record_no", "line") == rows(want, "id", "reporter_crd", "record_no", "line")
    assert len(re.findall(r"Window \[[^\n]*row_number", plan(out))) == 1
    assert rows(out.groupBy("reporter_crd").agg(F.max("file_no").alias("n")), "reporter_crd", "n") == [("0", 10), ("1", 8)]


def test_share_with_sizes_computes_its_rows_once(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 3), (3, None, 4), (4, "z", 0), (5, "z", None)], "id long, k string, q int")
    want = [(1, 0.25), (2, 0.75), (3, 1.0), (4, None), (5, None)]
    out = share_of(df, ["k"], "q", "s", sizes=df.select("k"))
    assert out.columns == ["id", "k", "q", "s"] and rows(out, "id", "s") == want and "Join" not in plan(out)
    monkeypatch.setattr(ordered, "TARGET_ROWS", 1)
    cut = share_of(df, ["k"], "q", "s", sizes=df.select("k"))
    assert rows(cut, "id", "s") == want and "Join" in plan(cut)


def test_allocation_bridge_hashes_keys_after_the_join(spark, sf):
    text = plan(q_derived.b3(spark, sf))
    assert "unhex" in text and len(re.findall(r"Window \[", text)) == 1
    f = stage.fills(spark, sf)
    got = q_derived.b3(spark, sf).select("fill_id", "bridge_hk")
    keys = [hash_key([c], source) for c, source in (("order_id", "EXE"), ("fill_id", "ALL"), ("party_id", "ACC"))]
    assert rows(got, "fill_id", "bridge_hk") == rows(f.select("fill_id", link_key(keys).alias("bridge_hk")), "fill_id", "bridge_hk")


def test_a_small_dimension_costs_a_lookup_no_shuffle(spark, monkeypatch):
    fact = spark.createDataFrame([(1, "2024-02-01"), (1, "2024-04-01"), (1, "1990-01-01"), (2, "2024-02-01"), (None, "2024-02-01"), (1, None)], "desk_id long, d string").select("desk_id", F.to_date("d").alias("event_date"))
    dim = spark.createDataFrame([(1, 7, "2000-01-01", "2024-03-31"), (1, 8, "2024-04-01", "9999-12-31"), (2, 9, "2024-03-01", "2024-01-01"), (None, 6, "2000-01-01", "9999-12-31")], "desk_id_bk long, dim_desk_sk long, s string, e string")
    dim = dim.select("desk_id_bk", "dim_desk_sk", F.to_date("s").alias("effective_start_date"), F.to_date("e").alias("effective_end_date"))
    roles = [(dim, "desk_id", "desk_id_bk", "dim_desk_sk", "dim_desk_sk")]
    want = sorted([(1, 7), (1, 8), (1, None), (2, None), (None, None), (1, None)], key=repr)
    span = ("1990-01-01", "2024-04-01")
    small = facts.resolve(fact, roles, span=span, stored=True)
    assert interval.few_versions(dim, "desk_id_bk") and not re.search(r"Generate explode\(sequence", plan(small))
    monkeypatch.setattr(interval, "FEW_OF_KEY", 1)
    large = facts.resolve(fact, roles, span=span, stored=True)
    assert not interval.few_versions(dim, "desk_id_bk") and re.search(r"Generate explode\(sequence", plan(large))
    assert rows(small, "desk_id", "dim_desk_sk") == rows(large, "desk_id", "dim_desk_sk") == want
    assert "BroadcastHashJoin" not in plan(large) and "SortMergeJoin" not in plan(large)


def test_text_of_a_fact_passes_lookups_and_sequences_as_bytes(spark):
    fact = spark.createDataFrame([("o", "A", 1, 0, "0f", 1, 5), ("o", "B", 1, 0, "0F", 1, None), ("o", "A", 0, 0, "x", 2, 5), ("p", "C", 0, 0, "z", 1, 5)], "cat_order_id string, cat_event_code string, t long, event_nanos int, dv2_source_hk string, k long, v long")
    fact = fact.withColumn("event_timestamp", F.timestamp_seconds("t"))
    types = spark.createDataFrame([("A",), ("B",)], "cat_event_code string")
    out = views.with_sequence(fact, types)
    assert rows(out, "dv2_source_hk", "lifecycle_sequence", "prior_event_code", "next_event_code") == [("0F", 2, "A", "A"), ("0f", 3, "B", None), ("x", 1, None, "B")]
    one = spark.createDataFrame([(1, "one"), (1, "uno")], "k long, name string")
    two = spark.createDataFrame([(5, "five")], "v long, label string")
    out = joins.describe(fact, [(one, "k", "inner"), (two, "v", "left")])
    assert rows(out, "dv2_source_hk", "name", "label") == [("0F", "one", None), ("0F", "uno", None), ("0f", "one", "five"), ("0f", "uno", "five"), ("z", "one", "five"), ("z", "uno", "five")]
    assert "unhex" in plan(out) and "unhex" in plan(views.with_sequence(fact, types))
    assert rows(out, *out.columns) == rows(joins.star_join(fact, [(one, "k", "inner"), (two, "v", "left")]), *out.columns)


def test_matrix_counts_every_row_and_every_month(spark, tmp_path):
    dim = spark.createDataFrame([(1, "2024-01-01", "2024-01-31"), (2, "2024-01-01", "9999-12-31")], "dim_party_sk long, s string, e string")
    dim = dim.select("dim_party_sk", F.to_date("s").alias("effective_start_date"), F.to_date("e").alias("effective_end_date"))
    fact = spark.createDataFrame([(1, "2024-02-01")] * 3 + [(1, "2024-01-31"), (2, "2023-12-31"), (3, "2024-01-01"), (3, "2024-01-02"), (None, "2024-01-01"), (None, None), (2, None)], "dim_party_sk long, d string")
    fact = fact.select("dim_party_sk", F.to_date("d").alias("snapshot_date"))
    out = integrity.integrity_matrix({"customer_records": fact}, {"party": dim})
    assert rows(out, "check", "n") == [("not_in_force", 4), ("null_key", 2), ("unknown_key", 1)]
    assert integrity.key_columns("customer_records") == ["dim_party_sk", "dim_account_sk", "snapshot_date"]
    spark.createDataFrame([(1, "c", "M", 1)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    orders = "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderstatus string, o_orderpriority string, o_totalprice double"
    spark.createDataFrame([], orders).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([], "event_id long, user_id long, ts timestamp, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    got = q_ops.records_fact(spark, str(tmp_path))
    days = rows(got, "snapshot_date")
    assert len(days) == 79 and got.filter("snapshot_date <> last_day(snapshot_date) or dim_party_sk is null").isEmpty()


def test_quotes_are_looked_up_once_a_role(spark, sf):
    """The dates of the quotes are known, so each dimension takes one join, not one for open and one for closed versions."""
    text = plan(q_gold.quote_rows(spark, sf))
    assert "__nk" not in text and len(re.findall(r"\bJoin|Join\b", text)) == 6
