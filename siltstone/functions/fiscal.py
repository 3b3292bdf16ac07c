"""Periods, fiscal years and quarters, as Column expressions over ISO date strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import col


def period_year(start: Column, end: Column, instant: Column, filing_year: Column) -> Column:
    """calendar year of instant, end or start, else the filing's year."""
    return F.coalesce(F.substring(F.coalesce(instant, end, start), 1, 4).try_cast("int"), filing_year.cast("int"))


def calendar_quarter(month: Column) -> Column:
    """F72."""
    return F.concat(F.lit("Q"), F.ceil(month / 3).cast("string"))


def fiscal_quarter(day: Column, year_end: Column) -> Column:
    """quarter of a date given the fiscal year end as MM-DD; the day after the year end still is Q4; calendar quarter without one."""
    d = F.to_date(day)
    end = F.try_to_date(F.concat(F.year(d).cast("string"), F.lit("-"), year_end))
    shifted = F.pmod(F.month(d) - F.month(end) % 12, F.lit(12))
    quarter = F.when(shifted.between(1, 3), "Q1").when(shifted.between(4, 6), "Q2").when(shifted.between(7, 9), "Q3").otherwise("Q4")
    return F.when(d.isNull(), F.lit(None).cast("string")).when(end.isNull(), calendar_quarter(F.month(d))).when(d == F.date_add(end, 1), "Q4").otherwise(quarter)


def compact_date(c: Column | str) -> Column:
    """ISO or eight digits as YYYYMMDD, else null."""
    s = F.regexp_replace(F.trim(col(c)), "-", "")
    return F.when(s.rlike(r"^\d{8}$"), s)


def iso_date(c: Column | str) -> Column:
    """F74."""
    return F.date_format(col(c), "yyyy-MM-dd")


def period_label(start: Column, end: Column, instant: Column, year: Column, between: str = " — ") -> Column:
    """FYyear start - end, or FYyear instant."""
    head = F.concat(F.lit("FY"), year.cast("string"), F.lit(" "))
    return F.when(instant.isNotNull(), F.concat(head, instant)).when(start.isNotNull() & end.isNotNull(), F.concat(head, start, F.lit(between), end)).when(end.isNotNull(), F.concat(head, end))


def quarter_number(c: Column | str) -> Column:
    """first digits."""
    return F.regexp_extract(F.coalesce(col(c).cast("string"), F.lit("")), r"(\d+)", 1).try_cast("int")


def period_type(start: Column, end: Column, instant: Column) -> Column:
    """F44."""
    return F.when(instant.isNotNull(), "instant").when(start.isNotNull() & end.isNotNull(), "duration")


def year_bounds(year: Column) -> Column:
    """first day of the year and of the next."""
    return F.struct(F.make_date(year, F.lit(1), F.lit(1)).alias("first"), F.make_date(year + 1, F.lit(1), F.lit(1)).alias("next"))
