"""Fixed code lists that ship with the package, and loaders for external seed files."""

from __future__ import annotations

import csv
import functools
from collections.abc import Sequence
from importlib import resources

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradevault.functions.hashing import row_hash
from tradevault.functions.scalars import open_end

TAXONOMY_ROWS = 99
TAXONOMY_SCHEMA = "section string, event_name string, message_type string, category string, phase string, description string"
ENUMERATION_SCHEMA = "enum_field string, enum_value string, description string"


@functools.lru_cache
def read_config(name: str) -> tuple[tuple[str, ...], tuple[tuple[str, ...], ...]]:
    """Header and rows of a packaged list (all of them are small, fixed text)."""
    with resources.files("tradevault.config").joinpath(f"{name}.csv").open(encoding="utf-8") as f:
        rows = [r for r in csv.reader(line for line in f if not line.startswith("#"))]
    return tuple(rows[0]), tuple(tuple(r) for r in rows[1:])


def small_frame(spark: SparkSession, header: Sequence[str], rows: Sequence[Sequence[str | None]]) -> DataFrame:
    """A short text list as a local relation, whose size the optimizer knows."""
    cols = [pa.array([r[i] for r in rows], pa.string()) for i in range(len(header))]
    return spark.createDataFrame(pa.table(dict(zip(header, cols))))


def config_frame(spark: SparkSession, name: str) -> DataFrame:
    """A packaged list as a DataFrame; empty text is NULL and ``true``/``false`` columns are boolean."""
    header, rows = read_config(name)
    df = small_frame(spark, header, [[v or None for v in r] for r in rows])
    flags = [h for i, h in enumerate(header) if rows and all(r[i] in ("true", "false") for r in rows)]
    return df.withColumns({h: F.col(h).cast("boolean") for h in flags}) if flags else df


# list name -> (hashed columns, authority)
SEEDS: dict[str, tuple[list[str], str]] = {
    "order_types": (
        ["order_type_code", "order_type_name", "category", "fix_tag_40_value", "requires_price", "requires_stop_price", "is_algo_order"],
        "FIX_PROTOCOL",
    ),
    "time_in_force": (
        ["tif_code", "tif_name", "category", "fix_tag_59_value", "requires_expire_date", "auto_cancels_intraday"],
        "FIX_PROTOCOL",
    ),
    "handling_instructions": (
        ["handling_instruction_code", "handling_instruction_name", "category", "fix_tag_21_value", "requires_manual_intervention", "triggers_cat_moot"],
        "FIX_PROTOCOL",
    ),
    "day_counts": (
        ["day_count_code", "day_count_name", "category", "isda_code", "fpml_code", "numerator_method", "denominator_method"],
        "ISDA",
    ),
    "party_roles": (
        ["party_role_code", "party_role_name", "category", "regulatory_capacity", "requires_lei", "requires_crd", "is_regulated_role", "fix_party_role_value"],
        "INTERNAL_TAXONOMY",
    ),
    "instrument_types": (
        ["instrument_type_code", "instrument_type_name", "category", "asset_class", "cfi_category_prefix", "is_listed", "is_cleared", "is_otc", "supports_fractional"],
        "INTERNAL_TAXONOMY",
    ),
}


def with_audit(
    df: DataFrame, authority: str, version: str, source: str, load: Column | None = None, op: Column | None = None
) -> DataFrame:
    """Stamp the open window, active flag, lineage, load time and change sequence. Existing window columns are kept
    where they are not NULL."""
    load = F.current_timestamp() if load is None else load
    today = F.to_date(load)

    def default(name: str, value: Column) -> Column:
        return F.coalesce(F.col(name), value) if name in df.columns else value

    return df.withColumns(
        {
            "effective_start_date": default("effective_start_date", today).cast("date"),
            "effective_end_date": default("effective_end_date", open_end()).cast("date"),
            "is_active": default("is_active", F.lit(True)).cast("boolean"),
            "source_authority": F.lit(authority),
            "source_version": F.lit(version),
            "last_updated_date": default("last_updated_date", today),
            "record_source": F.lit(source),
            "load_date": load,
            "cdc_sequence": load.cast("long"),
            "cdc_operation": F.lit("UPSERT") if op is None else op,
        }
    )


def seed_ref(spark: SparkSession, name: str, version: str = "1", load: Column | None = None) -> DataFrame:
    """A packaged code list, stamped and hashed."""
    hashed, authority = SEEDS[name]
    df = with_audit(config_frame(spark, name), authority, version, f"seed/{name}", load)
    return df.withColumn("row_hash", row_hash(hashed))


def seed_ref_csv(
    spark: SparkSession, path: str, schema: str, hashed: list[str], authority: str, version: str, load: Column | None = None
) -> DataFrame:
    """An external seed file; window columns in the file win over the defaults."""
    df = spark.read.csv(path, schema=schema, header=True)
    return with_audit(df, authority, version, path, load).withColumn("row_hash", row_hash(hashed))


def load_taxonomy(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Event taxonomy from a file, or the packaged one; any other row count than 99 is refused."""
    if path is None:
        df = config_frame(spark, "event_types").withColumn("description", F.lit(None).cast("string"))
        n = len(read_config("event_types")[1])
    else:
        df = spark.read.csv(path, schema=TAXONOMY_SCHEMA, header=True, comment="#")
        n = df.count()
    if n != TAXONOMY_ROWS:
        raise ValueError(f"expected {TAXONOMY_ROWS} event types, got {n}")
    # one partition keeps the order of the checked, short list
    return df.coalesce(1).withColumn("position", (F.monotonically_increasing_id() + 1).cast("int"))


def load_enumerations(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path is None:
        return config_frame(spark, "account_enumerations")
    return spark.read.csv(path, schema=ENUMERATION_SCHEMA, header=True, comment="#")
