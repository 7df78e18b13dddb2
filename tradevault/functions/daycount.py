"""Accrual year fractions, one column expression per convention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevault.functions.hashing import as_col


def _thirty(start: Column, end: Column, d1: Column, d2: Column) -> Column:
    days = (F.year(end) - F.year(start)) * 360 + (F.month(end) - F.month(start)) * 30 + (d2 - d1)
    return days.cast("double") / 360


def _leap(d: Column) -> Column:
    y = F.year(d)
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def _year_start(y: Column) -> Column:
    return F.make_date(y, F.lit(1), F.lit(1))


def _month_end(d: Column) -> Column:
    return d == F.last_day(d)


def _feb29_count(start: Column, end: Column) -> Column:
    """Number of 29 Februaries d with start < d <= end, from leap-year counts (no per-day expansion)."""

    def leaps(y: Column) -> Column:
        return F.floor(y / 4) - F.floor(y / 100) + F.floor(y / 400)

    def upto(d: Column) -> Column:
        passed = _leap(d) & ((F.month(d) > 2) | ((F.month(d) == 2) & (F.dayofmonth(d) == 29)))
        return leaps(F.year(d) - 1) + F.when(passed, 1).otherwise(0)

    return upto(end) - upto(start)


def year_fraction(start: Column | str, end: Column | str, convention: str, business_days: Column | None = None) -> Column:
    """Year fraction between two dates. A period that ends before it starts is minus the period the other way round.

    BUS_252 needs ``business_days``: the number of business days from start (excluded) to end (included), usually the
    difference of two trading-day ordinals of the date dimension; it carries its own sign.
    """
    s, e = as_col(start), as_col(end)
    if convention in ("BUS_252", "1_1"):
        return _forward(s, e, convention, business_days)
    return F.when(e >= s, _forward(s, e, convention, None)).otherwise(-_forward(e, s, convention, None))


def _forward(s: Column, e: Column, convention: str, business_days: Column | None) -> Column:
    days = F.datediff(e, s).cast("double")
    ds, de = F.dayofmonth(s), F.dayofmonth(e)
    if convention == "ACT_360":
        return days / 360
    if convention == "ACT_365_FIXED":
        return days / 365
    if convention == "ACT_365_25":
        return days / 365.25
    if convention in ("30_360", "30U_360"):
        d1 = F.when(ds == 31, 30).otherwise(ds)
        d2 = F.when((de == 31) & (d1 == 30), 30).otherwise(de)
        if convention == "30U_360":
            feb_s = (F.month(s) == 2) & _month_end(s)
            feb_e = (F.month(e) == 2) & _month_end(e)
            d1 = F.when(feb_s | (ds == 31), 30).otherwise(ds)
            d2 = F.when(feb_s & feb_e, 30).when((de == 31) & (d1 == 30), 30).otherwise(de)
        return _thirty(s, e, d1, d2)
    if convention == "30E_360":
        return _thirty(s, e, F.least(ds, F.lit(30)), F.least(de, F.lit(30)))
    if convention == "30E_360_ISDA":
        return _thirty(s, e, F.when(_month_end(s), 30).otherwise(ds), F.when(_month_end(e), 30).otherwise(de))
    if convention == "ACT_ACT_ISDA":
        len_s, len_e = F.when(_leap(s), 366.0).otherwise(365.0), F.when(_leap(e), 366.0).otherwise(365.0)
        first = F.datediff(_year_start(F.year(s) + 1), s) / len_s
        last = F.datediff(e, _year_start(F.year(e))) / len_e
        split = first + last + (F.year(e) - F.year(s) - 1)
        return F.when(F.year(s) == F.year(e), days / len_s).otherwise(split)
    if convention == "ACT_365_L":
        return days / F.when(_feb29_count(s, e) > 0, 366.0).otherwise(365.0)
    if convention == "ACT_ACT_AFB":
        whole = F.floor(F.months_between(e, s) / 12).cast("int")
        stub_end = F.add_months(e, -12 * whole)
        stub = F.datediff(stub_end, s).cast("double")
        return whole + stub / F.when(_feb29_count(s, stub_end) > 0, 366.0).otherwise(365.0)
    if convention == "ACT_ACT_ICMA":
        # one regular annual period per coupon year: actual days over the days of the period that holds the stub
        whole = F.floor(F.months_between(e, s) / 12).cast("int")
        p0, p1 = F.add_months(s, 12 * whole), F.add_months(s, 12 * (whole + 1))
        return whole + F.datediff(e, p0) / F.datediff(p1, p0).cast("double")
    if convention == "NL_365":
        return (days - _feb29_count(s, e)) / 365
    if convention == "BUS_252":
        if business_days is None:
            raise ValueError("BUS_252 needs business_days")
        return business_days.cast("double") / 252
    if convention == "1_1":
        return F.lit(1.0)
    if convention == "SIMPLE":
        return days / 365
    raise ValueError(f"unknown day count {convention!r}")


def with_year_fraction(df: DataFrame, start: str, end: str, convention: str, out: str = "year_fraction") -> DataFrame:
    return df.withColumn(out, year_fraction(start, end, convention))
