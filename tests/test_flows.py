import bz2
import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rows_helper import rows
from tradevault.functions import daycount
from tradevault.operators import scd2, vault
from tradevault.plans import accounts, dims, refdata, submission, vault_load, views
from tradevault.session import work_dir
from tradevault.sources import seeds
from tradevault.streaming import flows

D = dt.date


# ---- seeds, calendar, accruals


@pytest.mark.parametrize("name,n", [("order_types", 25), ("time_in_force", 8), ("handling_instructions", 3), ("day_counts", 15), ("party_roles", 22), ("instrument_types", 31)])
def test_seed_sizes(spark, name, n):
    df = seeds.seed_ref(spark, name)
    assert df.count() == n and df.filter("length(row_hash) <> 64").count() == 0


def test_external_seed_keeps_its_own_window(spark, tmp_path):
    f = tmp_path / "regulators.csv"
    f.write_text("regulator_code,regulator_name,effective_start_date,is_active\nSEC,Commission,2020-01-01,\nESMA,Authority,,false\n")
    out = seeds.seed_ref_csv(
        spark, str(f), "regulator_code string, regulator_name string, effective_start_date date, is_active boolean",
        ["regulator_code", "regulator_name"], "INTERNAL_TAXONOMY", "2026.1", F.lit("2026-01-01").cast("timestamp"),
    )
    assert rows(out, "regulator_code", "effective_start_date", "effective_end_date", "is_active") == [
        ("ESMA", D(2026, 1, 1), D(9999, 12, 31), False), ("SEC", D(2020, 1, 1), D(9999, 12, 31), True)]


def test_taxonomy_and_enumerations(spark, tmp_path):
    et = dims.dim_event_type(spark)
    assert et.count() == 99 and et.agg(F.max("dim_event_type_sk")).first()[0] == 99
    first = {r["cat_event_code"]: r["dim_event_type_sk"] for r in et.collect()}
    assert first["MENO"] == 1 and first["MONO"] == 40 and first["MLOE"] == 99
    kinds = {r[0]: r[1] for r in et.groupBy("submission_file_type").count().collect()}
    assert set(kinds) == {"OrderEvents", "OptionEvents", "QuoteEvents", "Allocations"} and kinds["Allocations"] == 4
    assert seeds.load_enumerations(spark).count() == 53
    short = tmp_path / "t.csv"
    short.write_text("section,event_name,message_type,category,phase,description\n1,a,B,C,D,e\n")
    with pytest.raises(ValueError):
        seeds.load_taxonomy(spark, str(short))


def test_vault_metadata():
    sizes = {k: len(vault_load.vault_tables(k)) for k in ("hub", "link", "sat", "pit")}
    assert sizes == {"hub": 20, "link": 32, "sat": 52, "pit": 16}


def test_calendar(spark):
    cal = dims.dim_date(spark)
    assert cal.count() == 5844
    assert cal.filter("day_of_week in (1, 7) and is_trading_day").count() == 0
    assert cal.filter("holiday_flag and is_trading_day").count() == 0
    days = spark.createDataFrame([(D(2024, 7, 3),), (D(2024, 7, 5),), (D(2024, 7, 6),)], "d date")
    out = {r["d"]: r["n"] for r in dims.add_business_days(days, "d", 1, cal, "n").collect()}
    assert out == {D(2024, 7, 3): D(2024, 7, 5), D(2024, 7, 5): D(2024, 7, 8), D(2024, 7, 6): D(2024, 7, 8)}


@pytest.mark.parametrize("code,a,b,want", [
    ("ACT_360", D(2024, 1, 1), D(2024, 7, 1), 182 / 360), ("30_360", D(2024, 1, 31), D(2024, 3, 31), 60 / 360),
    ("30E_360", D(2024, 1, 31), D(2024, 2, 29), 29 / 360), ("30E_360_ISDA", D(2024, 1, 31), D(2024, 2, 29), 30 / 360),
    ("30U_360", D(2023, 2, 28), D(2023, 8, 31), 180 / 360), ("ACT_ACT_ISDA", D(2023, 7, 1), D(2024, 7, 1), 184 / 365 + 182 / 366),
    ("NL_365", D(2024, 2, 28), D(2024, 3, 1), 1 / 365), ("ACT_365_L", D(2024, 1, 1), D(2024, 7, 1), 182 / 366), ("1_1", D(2024, 1, 1), D(2025, 1, 1), 1.0),
    ("ACT_ACT_AFB", D(2022, 1, 1), D(2024, 1, 1), 2.0), ("ACT_ACT_ICMA", D(2023, 1, 1), D(2024, 7, 1), 1 + 182 / 366),
])
def test_year_fractions(spark, code, a, b, want):
    df = spark.createDataFrame([(a, b)], "a date, b date")
    assert df.select(daycount.year_fraction("a", "b", code)).first()[0] == pytest.approx(want)


@pytest.mark.parametrize("code", ["ACT_360", "ACT_365_25", "30_360", "30U_360", "30E_360_ISDA", "ACT_ACT_ISDA", "ACT_ACT_ICMA", "ACT_365_L", "ACT_ACT_AFB", "NL_365", "SIMPLE"])
def test_a_period_backwards_is_minus_the_period(spark, code):
    df = spark.createDataFrame([(D(2023, 1, 31), D(2024, 2, 29)), (D(2024, 3, 1), D(2024, 3, 1)), (D(2024, 1, 1), None)], "a date, b date")
    got = [tuple(r) for r in df.select(daycount.year_fraction("a", "b", code), daycount.year_fraction("b", "a", code)).collect()]
    assert got[0][0] > 0 and got[0][1] == -got[0][0] and got[1][0] == got[1][1] == 0 and got[2] == (None, None)


# ---- submission

EV = "cat_event_code string, id string, qty decimal(10,2), note string, ts timestamp"
MAP = [
    submission.FieldMapping("id", "eventID", "OrderEvents", (), True), submission.FieldMapping("qty", "quantity", "OrderEvents", ("MENO",)),
    submission.FieldMapping("note", "note", "OrderEvents"), submission.FieldMapping("ts", "eventTimestamp", "OrderEvents"), submission.FieldMapping("id", "x", "Allocations"),
]


def test_mapping(spark):
    t = dt.datetime(2024, 1, 2, 3, 4, 5, 600)
    df = spark.createDataFrame([("MENO", "1", Decimal(5), None, t), ("MEOR", "2", Decimal(5), "n", None)], EV)
    got = [r["line"] for r in submission.shape_submission(df, MAP, "OrderEvents").collect()]
    assert got == ['{"eventID":"1","quantity":"5.00","eventTimestamp":"2024-01-02T03:04:05.000600+00:00"}', '{"eventID":"2","note":"n"}']
    with pytest.raises(Exception, match="required field eventID is NULL"):
        submission.shape_submission(spark.createDataFrame([("MENO", None, Decimal(5), None, t)], EV), MAP, "OrderEvents").collect()


def test_files_and_checksum(spark):
    df = spark.range(25).select(
        F.col("id").cast("string").alias("rid"), F.concat(F.lit('{"a":'), F.col("id").cast("string"), F.lit("}")).alias("line"), F.lit("1").alias("submitter_id"),
        F.lit("2").alias("reporter_crd"), F.lit("2024-01-05").cast("date").alias("gen_date"), F.lit("").alias("file_group"), F.lit("2024-01-05").cast("timestamp").alias("event_timestamp"),
    )
    out = submission.split_files(df, "rid", max_rows=10)
    meta = {r["file_name"]: r for r in submission.batch_metadata(out).collect()}
    assert sorted(r["record_count"] for r in meta.values()) == [5, 10, 10] and "1_2_20240105_0_0001.json.bz2" in meta
    path = work_dir(spark, "t")
    submission.write_submission(out, path)
    for name, m in meta.items():
        data = bz2.open(f"{path}/{name}").read()
        assert len(data) == m["file_size_bytes"] and hashlib.sha256(data).hexdigest() == m["sha256_checksum"]


def test_deadline_follows_new_york_clock(spark):
    df = spark.createDataFrame([(D(2024, 1, 2), "OrderEvents"), (D(2024, 7, 2), "Allocations"), (D(2024, 7, 2), "QuoteEvents")], "d date, k string")
    got = [r[0] for r in df.select(submission.deadline("d", "k")).collect()]
    assert got == [dt.datetime(2024, 1, 3, 11, 0), dt.datetime(2024, 7, 3, 21, 30), dt.datetime(2024, 7, 3, 10, 0)]


def test_status_precedence(spark):
    t = dt.datetime(2024, 1, 3)
    B = "batch_id string, event_date date, cat_reporter_imid string, submission_file_type string, record_count long, records_accepted long, records_rejected long, records_repaired long, submission_timestamp timestamp, submission_deadline timestamp, is_late_submission boolean, ack_status string"
    row = lambda firm, kind, late, ack: (f"{firm}{ack}", D(2024, 1, 2), firm, kind, 1, 1, 0, 0, t, t, late, ack)
    b = spark.createDataFrame(
        [row("late", "OrderEvents", True, "REJECTED"), row("over", "QuoteEvents", False, "PENDING"), row("pend", "OrderEvents", False, "PROCESSING"), row("pend", "OrderEvents", False, "REJECTED"),
         row("rej", "OrderEvents", False, "REJECTED"), row("green", "OrderEvents", False, "ACCEPTED"), row("unk", "OrderEvents", None, "PARTIAL")], B)
    e = spark.createDataFrame([(D(2024, 1, 2), "f", "MENQ", "OPEN", -1, D(2024, 1, 5))], "event_date date, firm_roe_id string, cat_event_code string, resolution_status string, days_to_deadline int, t_plus_3_deadline date")
    got = {r["cat_reporter_imid"]: r["overall_status"] for r in views.daily_submission_status(b, e, dims.dim_event_type(spark)).collect()}
    assert got == {"late": "LATE", "over": "OVERDUE_CORRECTIONS", "pend": "PENDING", "rej": "REJECTED", "green": "GREEN", "unk": "UNKNOWN"}


# ---- account flows


def test_roles_and_correction_rule(spark):
    prior = spark.createDataFrame([("h1", "c1", "TRDHOLDER", D(2020, 1, 1)), ("h1", "c2", "AUTHREP", D(2020, 1, 1)), ("h2", "c3", "AUTHREP", D(2020, 1, 1)), ("h3", "c5", "AUTHREP", D(2020, 1, 1))], "cais_fdid_hk string, customer_record_id string, customer_role string, role_start_date date")
    sub = spark.createDataFrame([("h1", "c1", "NTHOLDER"), ("h1", "c4", "AUTHREP"), ("h3", None, None)], "cais_fdid_hk string, customer_record_id string, customer_role string")
    acts = accounts.reconcile_roles(prior, sub, F.to_date(F.lit("2024-01-01")))
    assert rows(acts, "customer_record_id", "action") == [("c1", "ROLE_CHANGED"), ("c2", "IMPLICIT_END"), ("c4", "ADDED"), ("c5", "IMPLICIT_END")]
    assert accounts.role_rows(acts).count() == 5
    ended = spark.createDataFrame([("h1", D(2024, 1, 1), "CORRECTION", D(2024, 1, 1)), ("h2", D(2024, 1, 1), "CORRECTION", D(2023, 1, 1))], "cais_fdid_hk string, fdid_end_date date, fdid_end_reason string, fdid_date date")
    good, bad = accounts.end_accounts(ended)
    assert rows(good, "cais_fdid_hk") == [("h1",)] and rows(bad, "cais_fdid_hk") == [("h2",)]


# ---- reference data


def test_code_list_refresh_versions_on_hash_only(spark):
    M = "MIC string, `OPERATING MIC` string, `MARKET NAME-INSTITUTION DESCRIPTION` string, `LEGAL ENTITY NAME` string, `MARKET CATEGORY CODE` string, ACRONYM string, `ISO COUNTRY CODE (ISO 3166)` string, CITY string, WEBSITE string, STATUS string, `LAST UPDATE DATE` string, `CREATION DATE` string"
    row = lambda mic, name, status, day: (mic, mic, name, None, "RMKT", None, "us", "NY", None, status, day, day)
    load = lambda d: F.lit(d).cast("timestamp")
    prep = lambda data, d: refdata.prepare(refdata.curate(spark.createDataFrame(data, M), "ref_mic", F.to_date(F.lit(d))), "ref_mic", "file", load(d))
    v1 = refdata.refresh(None, prep([row("xnys", "NYSE", "Active", "20240101"), row("xold", "OLD", "Active", "20240101")], "2024-01-02"), "ref_mic")
    again = refdata.refresh(v1, prep([row("xnys", "NYSE", "Active", "20240105")], "2024-01-05"), "ref_mic")
    assert again.count() == 2  # a new load date alone opens no version
    v2 = refdata.refresh(v1, prep([row("xnys", "New York", "Active", "20240201"), row("xold", "OLD", "Deleted", "20240201")], "2024-02-01"), "ref_mic")
    assert rows(v2, "mic_code", "mic_name", "is_current") == [("XNYS", "NYSE", False), ("XNYS", "New York", True), ("XOLD", "OLD", False)]
    assert {r["city"] for r in v2.collect()} == {"NY"} and "website_url" in v2.columns  # described columns ride along
    with pytest.raises(Exception, match="mic_code_4_upper_alnum"):
        prep([row("toolong", "x", "Active", "20240101")], "2024-01-02").collect()


# ---- streams


def test_change_stream_equals_batch_in_any_batch_order(spark):
    C = "k string, change_date date, seq long, v string, op string"
    data = [(f"k{i % 5}", D(2024, 1, 1 + (i * 7) % 20), i, "abc"[(i * 5) % 3], "DELETE" if i % 11 == 0 else "UPSERT") for i in range(60)]
    cols = ["k", "v", "effective_start_date", "effective_end_date", "is_current"]
    want = rows(scd2.scd2_build(spark.createDataFrame(data, C), ["k"], "change_date", ["seq"], ["v"], op_col="op"), *cols)
    for step in (1, -1):
        base = work_dir(spark, "st")
        for n, part in enumerate([data[0:20], data[20:40], data[40:60]][::step]):
            spark.createDataFrame(part, C).coalesce(1).write.parquet(f"{base}/in/p{n}")
        stream = spark.readStream.schema(C).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/p*")
        dim, log = flows.type2_tables(spark, base, ["k"], 4)
        flows.scd2_stream(stream, ["k"], ["v"], dim, log, f"{base}/cp")
        assert rows(dim.read(), *cols) == want
        flows.scd2_stream(stream, ["k"], ["v"], dim, log, f"{base}/cp")  # nothing new: nothing changes
        assert rows(dim.read(), *cols) == want


def test_replay_adds_nothing(spark):
    E = "firm_roe_id string, cat_event_code string, event_date date, event_timestamp timestamp, event_nanos long, dv2_source_hk string"
    t = dt.datetime(2024, 1, 1, 10)
    data = [("f1", "MENO", D(2024, 1, 1), t, 1, "a"), ("f1", "MENO", D(2024, 1, 1), t, 2, "b"), ("f2", "MENO", D(2024, 1, 1), t, 1, "c")]
    base = work_dir(spark, "rp")
    spark.createDataFrame(data, E).coalesce(1).write.parquet(f"{base}/in/p0")
    spark.createDataFrame(data[:1], E).coalesce(1).write.parquet(f"{base}/in/p1")
    stream = spark.readStream.schema(E).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/p*")
    flows.idempotent_stream(stream, f"{base}/fact", f"{base}/cp")
    assert rows(spark.read.parquet(f"{base}/fact"), "dv2_source_hk") == [("b",), ("c",)]


def test_a_batch_of_deletes_only(spark):
    C = "k string, change_date date, seq long, v string, op string"
    base = work_dir(spark, "del")
    batches = [[("a", D(2024, 1, 1), 1, "x", "DELETE")], [("a", D(2024, 1, 3), 2, "y", "UPSERT"), ("b", D(2024, 1, 3), 3, "z", "UPSERT")], [("a", D(2024, 1, 5), 4, "y", "DELETE")]]
    dim, log = flows.type2_tables(spark, base, ["k"], 4)
    for n, part in enumerate(batches):
        spark.createDataFrame(part, C).coalesce(1).write.parquet(f"{base}/in/p{n}")
        stream = spark.readStream.schema(C).parquet(f"{base}/in/p*")
        flows.scd2_stream(stream, ["k"], ["v"], dim, log, f"{base}/cp")
    want = rows(scd2.scd2_build(spark.createDataFrame(sum(batches, []), C), ["k"], "change_date", ["seq"], ["v"], op_col="op"), "k", "v", "effective_end_date")
    assert rows(dim.read(), "k", "v", "effective_end_date") == want
    dim.vacuum()
    assert rows(dim.read(), "k", "v", "effective_end_date") == want


def test_unreadable_table_is_not_an_empty_one(spark, tmp_path):
    (tmp_path / "fact" / "tv_batch=0").mkdir(parents=True)
    (tmp_path / "fact" / "tv_batch=0" / "part-0.parquet").write_text("damaged")
    schema = spark.range(1).schema
    assert flows.stored_before(spark, str(tmp_path / "none"), 1, schema) is None
    with pytest.raises(Exception):
        flows.stored_before(spark, str(tmp_path / "fact"), 1, schema).collect()


def test_unknown_file_type_and_missing_code_stop(spark):
    b = spark.createDataFrame([("OrderEvnts",)], "t string").withColumn("d", F.lit("2024-01-02").cast("date"))
    with pytest.raises(Exception, match="no submission deadline"):
        b.select(submission.deadline("d", "t")).collect()
    rows_ = spark.createDataFrame([(None, 1)], "cat_event_code string, price int")
    field = submission.FieldMapping(file_type="OrderEvents", column="price", field="px", required=False, event_codes=())
    with pytest.raises(Exception, match="row without cat_event_code"):
        submission.shape_submission(rows_, [field], "OrderEvents").collect()


def test_one_satellite_row_per_load_time(spark):
    t = dt.datetime(2024, 1, 1)
    stage = spark.createDataFrame([("h", t, 1, "x"), ("h", t, 2, "y"), ("h", dt.datetime(2024, 1, 2), 1, "y")], "hk string, load_date timestamp, seq int, v string")
    first = vault.load_sat(stage, "hk", ["v"], tie=["seq"], source="FEED")
    assert rows(first, "load_date", "v", "record_source") == [(t, "y", "FEED")]
    late = spark.createDataFrame([("h", t, 9, "z")], "hk string, load_date timestamp, seq int, v string")
    assert vault.load_sat(late, "hk", ["v"], tie=["seq"], existing=first).count() == 0  # the stored row of that load time stays


def test_currency_countries_come_from_the_country_list(spark):
    raw = spark.createDataFrame([("usd", "US Dollar", "840", "2", "united states"), ("USD", "US Dollar", "840", "2", "Ecuador"), ("xau", "Gold", "959", "N.A.", "ZZ08")], refdata.CURRENCY_XML)
    countries = spark.createDataFrame([("United States", "US"), ("Ecuador", "EC")], "country_name string, country_code string")
    assert rows(refdata.curate(raw, "ref_currency", countries=countries), "currency_code", "country_code", "minor_unit") == [("USD", "EC", 2), ("XAU", None, None)]
    cfi = spark.createDataFrame([("esxxxx", "Shares", None, None, None, None, None, None)], "cfi_code string, name string, description string, subcategory string, attr_1 string, attr_2 string, attr_3 string, attr_4 string")
    assert rows(refdata.curate(cfi, "ref_cfi_category"), "cfi_code", "category") == [("ESXXXX", "E")]


def test_calendar_misses_stop(spark):
    df = spark.createDataFrame([(D(1999, 1, 4),)], "d date")
    with pytest.raises(Exception, match="calendar does not reach"):
        dims.add_business_days(df, "d", 3, dims.dim_date(spark), "due").collect()
