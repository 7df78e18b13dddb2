"""Calendar, event-type and type-2 dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradevault.functions.hashing import hash_key
from tradevault.functions.scalars import resolve_identifier
from tradevault.operators.quality import expect
from tradevault.operators.scd2 import scd2_build
from tradevault.sources.seeds import load_taxonomy, small_frame

# fixed values: exchange holidays
HOLIDAYS = {
    "2024-01-01": "New Year's Day",
    "2024-01-15": "Martin Luther King Jr. Day",
    "2024-02-19": "Presidents Day",
    "2024-03-29": "Good Friday",
    "2024-05-27": "Memorial Day",
    "2024-06-19": "Juneteenth",
    "2024-07-04": "Independence Day",
    "2024-09-02": "Labor Day",
    "2024-11-28": "Thanksgiving Day",
    "2024-12-25": "Christmas Day",
    "2025-01-01": "New Year's Day",
    "2025-01-20": "Martin Luther King Jr. Day",
    "2025-02-17": "Presidents Day",
    "2025-04-18": "Good Friday",
    "2025-05-26": "Memorial Day",
    "2025-06-19": "Juneteenth",
    "2025-07-04": "Independence Day",
    "2025-09-01": "Labor Day",
    "2025-11-27": "Thanksgiving Day",
    "2025-12-25": "Christmas Day",
    "2026-01-01": "New Year's Day",
    "2026-01-19": "Martin Luther King Jr. Day",
    "2026-02-16": "Presidents Day",
    "2026-04-03": "Good Friday",
    "2026-05-25": "Memorial Day",
    "2026-06-19": "Juneteenth",
    "2026-07-03": "Independence Day (observed)",
    "2026-09-07": "Labor Day",
    "2026-11-26": "Thanksgiving Day",
    "2026-12-25": "Christmas Day",
}


def dim_date(
    spark: SparkSession, start: str = "2020-01-01", end: str = "2035-12-31", holidays: Mapping[str, str] = HOLIDAYS
) -> DataFrame:
    """One row per calendar date. Sunday is day 1. ``trading_day_no`` counts trading days up to and including the date.

    The calendar has a fixed number of rows, so its one global window is bounded.
    """
    days = spark.sql(f"select explode(sequence(date'{start}', date'{end}', interval 1 day)) as calendar_date")
    names = small_frame(spark, ["d", "holiday_name"], list(holidays.items())).select(
        F.to_date("d").alias("calendar_date"), "holiday_name"
    )
    d = F.col("calendar_date")
    out = days.join(F.broadcast(names), "calendar_date", "left").withColumns(
        {
            "date_sk": F.date_format(d, "yyyyMMdd").cast("int"),
            "day_of_week": F.dayofweek(d),
            "day_name": F.date_format(d, "EEEE"),
            "day_of_month": F.dayofmonth(d),
            "day_of_year": F.dayofyear(d),
            "week_of_year": F.weekofyear(d),
            "month_number": F.month(d),
            "month_name": F.date_format(d, "MMMM"),
            "quarter": F.quarter(d),
            "year_number": F.year(d),
            "fiscal_year": F.year(d),
            "fiscal_quarter": F.quarter(d),
            "holiday_flag": F.col("holiday_name").isNotNull(),
            "t_plus_1_settlement_date": F.date_add(d, 1),
            "t_plus_3_error_correction_deadline": F.date_add(d, 3),
            "cat_submission_deadline_timestamp": F.date_add(d, 1).cast("timestamp") + F.expr("interval 8 hours"),
        }
    )
    out = out.withColumn("is_trading_day", F.col("day_of_week").between(2, 6) & ~F.col("holiday_flag"))
    out = out.withColumn("is_settlement_day", F.col("is_trading_day"))
    return out.withColumn(
        "trading_day_no", F.sum(F.col("is_trading_day").cast("int")).over(Window.orderBy("calendar_date"))
    )


def add_business_days(df: DataFrame, date_col: str, n: int, calendar: DataFrame, out: str) -> DataFrame:
    """The n-th trading day after a date: two equi joins on the trading-day ordinal. A date outside the calendar, or whose
    n-th day is, stops the job; a NULL date stays NULL."""
    at = calendar.select(F.col("calendar_date").alias("__d"), F.col("trading_day_no").alias("__no"))
    to = calendar.filter("is_trading_day").select(F.col("trading_day_no").alias("__to"), F.col("calendar_date").alias(out))
    return (
        df.join(F.broadcast(at), F.col(date_col) == F.col("__d"), "left")
        .join(F.broadcast(to), F.col("__no") + n == F.col("__to"), "left")
        .withColumn(out, in_calendar(out, date_col))
        .drop("__d", "__no", "__to")
    )


def in_calendar(found: str, *dates: str) -> Column:
    """The value found, or a stop if all dates are given and the calendar does not hold them."""
    given = F.col(dates[0]).isNotNull()
    for d in dates[1:]:
        given = given & F.col(d).isNotNull()
    text = F.concat_ws(" ", F.lit("calendar does not reach"), *[F.col(d).cast("string") for d in dates])
    return F.when(F.col(found).isNull() & given, F.raise_error(text)).otherwise(F.col(found))


def business_days_between(df: DataFrame, start: str, end: str, calendar: DataFrame, out: str) -> DataFrame:
    """Trading days after ``start`` up to and including ``end``; negative when ``end`` is earlier. Dates outside the calendar
    stop the job."""
    a = calendar.select(F.col("calendar_date").alias("__a"), F.col("trading_day_no").alias("__an"))
    b = calendar.select(F.col("calendar_date").alias("__b"), F.col("trading_day_no").alias("__bn"))
    return (
        df.join(F.broadcast(a), F.col(start) == F.col("__a"), "left")
        .join(F.broadcast(b), F.col(end) == F.col("__b"), "left")
        .withColumn(out, F.col("__bn") - F.col("__an"))
        .withColumn(out, in_calendar(out, start, end))
        .drop("__a", "__an", "__b", "__bn")
    )


def file_type(category: Column) -> Column:
    return (
        F.when(category.endswith("_ALLOCATION"), "Allocations")
        .when(category.endswith("_QUOTE"), "QuoteEvents")
        .when(category.contains("OPTION"), "OptionEvents")
        .otherwise("OrderEvents")
    )


def taxonomy_flags(df: DataFrame) -> DataFrame:
    c = F.col("category")
    return df.withColumns(
        {
            "submission_file_type": file_type(c), "is_manual": F.lit(False), "is_electronic": F.lit(True),
            "is_options": c.contains("OPTION"), "is_multileg": c.contains("MULTILEG"), "is_reportable": F.lit(True),
        }
    )


def dim_event_type(spark: SparkSession, path: str | None = None) -> DataFrame:
    return taxonomy_flags(load_taxonomy(spark, path)).select(
        F.col("position").alias("dim_event_type_sk"), F.col("message_type").alias("cat_event_code"), "event_name",
        F.col("description").alias("event_description"), F.col("phase").alias("event_phase"), "submission_file_type",
        F.col("section").alias("section_number"), "category", "is_manual", "is_electronic", "is_options", "is_multileg",
        "is_reportable",
    )


@dataclass(frozen=True)
class DimConfig:
    name: str
    key: str
    sk: str
    tracked: Sequence[str]
    carried: Sequence[str] = ()
    rules: Mapping[str, str] = field(default_factory=dict)


_HASH_RULE = {"row_hash_sha256_len": "length(row_hash) = 64"}

DIMS: dict[str, DimConfig] = {
    c.name: c
    for c in (
        DimConfig(
            "dim_party", "party_id_bk", "dim_party_sk",
            ["lei", "cat_imid", "crd", "fdid", "party_type", "party_status", "legal_form", "incorporation_country",
             "domicile_country", "tax_residency", "ultimate_parent_party_id", "g_sib_flag", "pep_flag", "mifid_ii_category"],
            ["legal_name"],
            {"party_id_bk_not_null": "party_id_bk IS NOT NULL", "party_type_not_null": "party_type IS NOT NULL", **_HASH_RULE},
        ),
        DimConfig(
            "dim_instrument", "instrument_id_bk", "dim_instrument_sk",
            ["isin", "cusip", "figi", "symbol", "asset_class", "cfi_code", "issuer_party_id", "currency_code", "primary_listing_mic"],
            [],
            {"instrument_id_bk_not_null": "instrument_id_bk IS NOT NULL",
             "security_id_source_enum": "security_id_source IS NULL OR security_id_source IN ('ISIN','CUSIP','FIGI')", **_HASH_RULE},
        ),
        DimConfig(
            "dim_venue", "venue_id_bk", "dim_venue_sk",
            ["mic", "venue_name", "venue_category", "country_code", "operating_segment"], [],
            {"venue_id_bk_not_null": "venue_id_bk IS NOT NULL", "mic_format": "mic IS NULL OR length(mic) = 4",
             "country_code_format": "country_code IS NULL OR length(country_code) = 2", **_HASH_RULE},
        ),
        DimConfig(
            "dim_account", "account_id_bk", "dim_account_sk",
            ["account_type", "account_status", "custodian_id", "clearing_member_id", "cat_large_trader_flag"], [],
            {"account_id_bk_not_null": "account_id_bk IS NOT NULL", **_HASH_RULE},
        ),
        DimConfig(
            "dim_desk", "desk_id_bk", "dim_desk_sk",
            ["desk_name", "desk_hierarchy", "region", "asset_class_coverage"], [],
            {"desk_id_bk_not_null": "desk_id_bk IS NOT NULL", **_HASH_RULE},
        ),
        DimConfig(
            "dim_trader", "trader_id_bk", "dim_trader_sk",
            ["cat_trader_id", "given_name_hash", "family_name_hash", "desk_id_bk", "active_flag"], [],
            {"trader_id_bk_not_null": "trader_id_bk IS NOT NULL",
             "given_name_pii_hashed": "given_name_hash IS NULL OR length(given_name_hash) = 64",
             "family_name_pii_hashed": "family_name_hash IS NULL OR length(family_name_hash) = 64", **_HASH_RULE},
        ),
    )
}


def with_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Typed NULL for every named column the frame lacks."""
    add = {c: F.lit(None).cast("string") for c in cols if c not in df.columns}
    return df.withColumns(add) if add else df


def build_dim(feed: DataFrame, config: DimConfig, source: str = "vault") -> DataFrame:
    """Type-2 dimension from a change feed (key, attributes, change_date, seq, optional op)."""
    feed = with_missing(feed, [*config.tracked, *config.carried])
    op = "op" if "op" in feed.columns else None
    dim = scd2_build(
        feed, [config.key], "change_date", ["seq"], config.tracked, carried=config.carried, op_col=op, sk=config.sk
    )
    if config.name == "dim_instrument":
        value, scheme = resolve_identifier([("ISIN", "isin"), ("CUSIP", "cusip"), ("FIGI", "figi")])
        dim = dim.withColumns({"security_id": value, "security_id_source": scheme})
    dim = dim.withColumns({"dv2_source_hk": hash_key([config.key], source), "record_source": F.lit(source)})
    return expect(dim, config.rules, "fail")
