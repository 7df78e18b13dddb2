"""Small column expressions shared by the plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradevault.functions.hashing import as_col

OPEN_END = "9999-12-31"


def open_end() -> Column:
    return F.to_date(F.lit(OPEN_END))


def resolve_identifier(named: Sequence[tuple[str, Column | str]]) -> tuple[Column, Column]:
    """First non-null identifier of an ordered list, and the name of the scheme it came from."""
    value = F.coalesce(*[as_col(c) for _, c in named])
    scheme = F.coalesce(*[F.when(as_col(c).isNotNull(), F.lit(name)) for name, c in named])
    return value, scheme


def operating_or_segment(code: Column | str, operating: Column | str) -> Column:
    return F.when(as_col(code).eqNullSafe(as_col(operating)), "OPRT").otherwise("SGMT")


def change_operation(status: Column | str) -> Column:
    return F.when(as_col(status) == "DELETED", "DELETE").otherwise("UPSERT")


def mask_hash(c: Column | str) -> Column:
    """One-way mask of personal data; NULL stays NULL."""
    return F.sha2(F.lower(F.trim(as_col(c).cast("string"))), 256)


def is_hashed(c: Column | str) -> Column:
    return as_col(c).isNull() | as_col(c).rlike("^[0-9a-f]{64}$")


def code_list(c: Column | str) -> Column:
    """Comma-delimited codes to an array of trimmed codes; the empty text gives an empty array."""
    parts = F.transform(F.split(as_col(c), ","), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def price_improvement(side: Column | str, executed: Column | str, limit: Column | str) -> Column:
    """Positive is worse for a buy (executed minus limit) and better for a sell written as limit minus executed.

    Sides other than BUY, SELL and SELL_SHORT give NULL.
    """
    side, executed, limit = as_col(side), as_col(executed), as_col(limit)
    return F.when(side == "BUY", executed - limit).when(side.isin("SELL", "SELL_SHORT"), limit - executed)


def signed(side: Column | str, quantity: Column | str) -> Column:
    side, quantity = as_col(side), as_col(quantity)
    return F.when(side == "BUY", quantity).otherwise(-quantity)


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double ratio of two exact values; NULL when the denominator is zero."""
    return F.when(as_col(den) != 0, as_col(num).cast("double") / as_col(den).cast("double"))


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_micros(as_col(end)) - F.unix_micros(as_col(start))
