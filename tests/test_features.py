"""Named files, schema tracking, the incremental roll-up, Bloom filters and quantile sketches."""

import bz2
import datetime as dt
import hashlib
import json
import random
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rows_helper import rows
from tradevault.operators import bloom
from tradevault.plans import derived, facts, risk, submission
from tradevault.session import work_dir
from tradevault.sources import named_files, tracked
from tradevault.streaming import flows, rollup

D = dt.date


# ---- files under their own name


def files_of(spark, n, max_rows):
    df = spark.range(n).select(
        F.col("id").cast("string").alias("rid"), F.concat(F.lit('{"ä":'), F.col("id").cast("string"), F.lit("}")).alias("line"), F.lit("1").alias("submitter_id"),
        F.lit("2").alias("reporter_crd"), F.lit("2024-01-05").cast("date").alias("gen_date"), F.lit("").alias("file_group"), F.lit("2024-01-05").cast("timestamp").alias("event_timestamp"),
    )
    return submission.split_files(df, "rid", max_rows=max_rows)


def test_files_have_their_names_and_checksums(spark):
    out = files_of(spark, 25, 10)
    path = work_dir(spark, "named")
    submission.write_submission(out, path)
    meta = {r["file_name"]: r for r in submission.batch_metadata(out).collect()}
    assert {p.name for p in Path(path).iterdir() if p.suffix == ".bz2"} == set(meta) == {r["file_name"] for r in out.select("file_name").distinct().collect()}
    for name, m in meta.items():
        data = bz2.open(f"{path}/{name}").read()
        assert len(data) == m["file_size_bytes"] and hashlib.sha256(data).hexdigest() == m["sha256_checksum"]
    listed = rows(named_files.written_files(spark, path), "file_name", "file_size_bytes", "record_count", "sha256_checksum")
    assert listed == sorted((n, m["file_size_bytes"], m["record_count"], m["sha256_checksum"]) for n, m in meta.items())
    assert not (Path(path) / "_pending").exists()


def test_a_failed_task_leaves_no_file(spark):
    path = work_dir(spark, "named")
    bad = files_of(spark, 25, 10).withColumn("line", F.when(F.col("record_no") == 21, F.raise_error(F.lit("stop"))).otherwise(F.col("line")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        submission.write_submission(bad, path)
    assert not [p for p in Path(path).rglob("*") if p.is_file()]
    submission.write_submission(files_of(spark, 25, 10), path)
    assert len(list(Path(path).glob("*.json.bz2"))) == 3


def test_names_that_are_no_file_names(spark):
    for name in ("a/b", "_x", ""):
        df = spark.createDataFrame([(name, 1, "x")], "n string, o int, l string")
        with pytest.raises(Exception, match="is no file name"):
            named_files.write_named(df, "n", "o", "l", work_dir(spark, "named"))


# ---- schema tracking


def test_three_headers_in_one_stream(spark):
    base = work_dir(spark, "csv")
    land = Path(base) / "in"
    land.mkdir(parents=True)
    declared = spark.createDataFrame([], "id int, day date, name string").schema
    run = lambda: tracked.tracked_csv(spark, f"{base}/in", declared, f"{base}/out", f"{base}/cp", files_per_batch=2)
    (land / "a.csv").write_text("id,day,name\n1,2024-01-01,x\n2,not a day,y\n")
    run()
    (land / "b.csv").write_text("Name,ID,rating\nz,3,AA\n\"q,r\",four,B\n")
    (land / "c.csv").write_text("id,name,Rating,city\n5,v,C,Rome\n6,w\n")
    run()
    (land / "d.csv").write_text("")
    (land / "e.csv").write_text("id,day,name\n7,2024-02-02,u\n")
    run()
    run()
    out = tracked.read_tracked(spark, f"{base}/out", declared)
    assert out.columns == ["id", "day", "name", "rating", "city", "_rescued"]
    got = {(r["name"]): (r["id"], r["day"], r["rating"], r["city"], r["_rescued"] and json.loads(r["_rescued"])) for r in out.collect()}
    assert got == {
        "x": (1, D(2024, 1, 1), None, None, None), "y": (2, None, None, None, {"day": "not a day"}), "z": (3, None, "AA", None, None),
        "q,r": (None, None, "B", None, {"id": "four"}), "v": (5, None, "C", "Rome", None), "w": (6, None, None, None, {"_row": "6,w"}), "u": (7, D(2024, 2, 2), None, None, None),
    }
    (land / "f.csv").write_text("id,ID\n1,2\n")
    with pytest.raises(Exception, match="repeated, empty or reserved"):
        run()


# ---- incremental roll-up

FILL = "fact_date date, party_id long, instrument_id long, venue_id long, order_id long, order_status string, side string, quantity decimal(18,4), amount decimal(18,4), price decimal(18,4), settlement_status string, sign int"


def make_fills(rnd, n):
    return [
        (D(2024, 1, 1 + rnd.randrange(3)), rnd.randrange(3), rnd.randrange(2), 0, rnd.randrange(8), rnd.choice(["FILLED", "CANCELLED", "WORKING"]), rnd.choice(["BUY", "SELL", None]),
         Decimal(rnd.randrange(1, 99)), Decimal(rnd.randrange(1, 9999)) / 100, Decimal(rnd.randrange(1, 999)) / 10, rnd.choice(["SETTLED", "FAILED", None]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed,batches", [(1, 1), (2, 4)])
def test_any_split_equals_the_batch_roll_up(spark, seed, batches):
    """Late fills, corrections (old withdrawn, new added) and withdrawn fills, in any split, each batch replayed once."""
    rnd = random.Random(seed)
    fills = make_fills(rnd, 40)
    feed = [(*f, 1) for f in fills]
    kept = list(fills)
    for f in rnd.sample(fills, 12):
        feed.append((*f, -1))
        kept.remove(f)
        if rnd.random() < 0.6:
            feed.append((*f[:8], f[8] + 1, *f[9:], 1))
            kept.append((*f[:8], f[8] + 1, *f[9:]))
    rnd.shuffle(feed)
    table = rollup.DailyLifecycle(spark, work_dir(spark, "ivm"), buckets=2)
    for no in range(batches):
        part = spark.createDataFrame(feed[no::batches], FILL)
        table.apply(no, part)
        if no == 1:
            table.apply(no, part)
    want = derived.daily_lifecycle(spark.createDataFrame([(*f, 1) for f in kept], FILL))
    text = lambda df: rows(df.select(*[F.col(c).cast("decimal(30,6)").cast("string").alias(c) if c not in ("fact_date",) else c for c in want.columns]), *want.columns)
    assert text(table.read()) == text(want)


# ---- Bloom filters


def test_filters_never_miss_and_seldom_err(spark):
    stored = spark.range(3000).select((F.col("id") % 3).alias("part"), F.concat(F.lit("k"), F.col("id")).alias("k"))
    filters = bloom.merge(bloom.build(stored.filter("part < 2"), "part", ["k"], 1 << 16).unionByName(bloom.build(stored.filter("part = 2"), "part", ["k"], 1 << 16)), "part")
    told = bloom.may_hold(stored, filters, "part", ["k"], 1 << 16)
    assert told.count() == 3000
    others = spark.range(3000, 9000).select((F.col("id") % 4).alias("part"), F.concat(F.lit("k"), F.col("id")).alias("k"))
    assert bloom.may_hold(others, filters, "part", ["k"], 1 << 16).count() < 60
    assert bloom.may_hold(others.limit(0), filters, "part", ["k"], 1 << 16).count() == 0


def test_a_resent_batch_reads_only_folders_that_may_hold_its_keys(spark, monkeypatch):
    E = "firm_roe_id string, cat_event_code string, event_date date, event_timestamp timestamp, event_nanos long, dv2_source_hk string"
    base = work_dir(spark, "bf")
    days = spark.range(200).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("event_date"))

    def events(prefix):
        return days.select(F.concat(F.lit(prefix), F.date_format("event_date", "MMdd")).alias("firm_roe_id"), F.lit("MENO").alias("cat_event_code"), "event_date", F.col("event_date").cast("timestamp").alias("event_timestamp"), F.lit(1).cast("long").alias("event_nanos"), F.lit(prefix).alias("dv2_source_hk"))

    opened = []
    monkeypatch.setattr(flows, "may_be_stored", lambda *a, old=flows.may_be_stored: opened.append(old(*a)) or opened[-1])
    def land(name, df):
        df.coalesce(1).write.parquet(f"{base}/in/{name}")
        stream = spark.readStream.schema(E).parquet(f"{base}/in/*")
        flows.idempotent_stream(stream, f"{base}/fact", f"{base}/cp")

    land("a", events("a"))
    land("b", events("b").unionByName(events("a").limit(3)))  # 200 new keys over all dates, three that are stored
    assert len(opened) == 2 and opened[0] == [] and 3 <= len(opened[1]) <= 5
    out = spark.read.parquet(f"{base}/fact")
    assert out.count() == 400 and out.select(*facts.IDEMPOTENCY_KEY).distinct().count() == 400


# ---- quantile sketches


@pytest.mark.parametrize("n", [50, 5_000, 60_000])
def test_rank_error_and_merges_in_any_order(spark, n):
    """One pair with n days: ranks within 1.33 percent whatever the merge order; up to k days the sketch is exact."""
    trades = spark.range(n).select(
        F.lit(1).alias("party_id"), F.lit(2).alias("counterparty_id"), F.col("id").alias("exposure_date"), F.lit("BUY").alias("side"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("decimal(18,4)").alias("amount"),
    )
    exact = sorted(float(r["amount"]) for r in trades.select("amount").collect())
    parts = [risk.exposure_sketches(trades.filter(F.col("exposure_date") % 4 == k)) for k in range(4)]
    for order in ([0, 1, 2, 3], [3, 1, 0, 2]):
        union = parts[order[0]]
        for k in order[1:]:
            union = union.unionByName(parts[k])
        r = risk.sketched_exposure(risk.merged_sketches(union)).first()
        assert r["days"] == n and r["pfe"] == exact[-1]
        for q, got in ((0.05, r["ee_5pct"]), (0.95, r["ee_95pct"])):
            rank = sum(x <= got for x in exact) / n
            assert abs(rank - q) <= 0.0133 + 1 / n
    if n <= risk.SKETCH_K:
        one = risk.sketched_exposure(risk.exposure_sketches(trades)).first()
        assert one["ee_5pct"] == exact[-(-n * 5 // 100) - 1] and one["ee_95pct"] == exact[-(-n * 95 // 100) - 1]
