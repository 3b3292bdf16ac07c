"""Filters and validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import RECORD_ID


def metadata_filter(ticker: str | None = None, form: str | None = None, year: int | None = None, lenient: bool = True, names: tuple[str, str, str] = ("ticker", "form", "fy")) -> Column:
    """P01 (lenient: a year that is no number passes), P02 and P04 (strict: it drops)."""
    t, f, y = names
    out = F.lit(True)
    if ticker:
        out = out & (F.upper(t) == ticker.upper())
    if form:
        out = out & (F.upper(f) == form.upper())
    if year is not None:
        number = F.col(y).cast("string").try_cast("int")
        out = out & (F.coalesce(number == year, F.lit(lenient)))
    return F.coalesce(out, F.lit(False))


def entity_filter(column: str, wanted: list[str]) -> Column:
    """Any overlap; no wish passes all."""
    return F.coalesce(F.arrays_overlap(F.col(column), F.array(*map(F.lit, wanted))), F.lit(False)) if wanted else F.lit(True)


def predicate(grammar: dict[str, dict]) -> Column:
    """{field: {eq | in | gte | lte | between | contains | has: value}}, all must hold."""
    build = {
        "eq": lambda c, v: c == v,
        "in": lambda c, v: c.isin(list(v)),
        "gte": lambda c, v: c >= v,
        "lte": lambda c, v: c <= v,
        "between": lambda c, v: c.between(*v),
        "contains": lambda c, v: c.contains(v),
        "has": F.array_contains,
    }
    parts = []
    for field, rules in grammar.items():
        for op, value in rules.items():
            if op not in build:
                raise ValueError(f"unknown operator {op!r} for {field!r}")
            parts.append(build[op](F.col(field), value))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def valid_record_id(c: str) -> Column:
    """P06."""
    return F.coalesce(F.col(c).rlike(RECORD_ID), F.lit(False))


def is_textblock(c: str) -> Column:
    """P11."""
    return F.coalesce(F.col(c).contains("TextBlock"), F.lit(False))


def concept_like(c: str, part: str) -> Column:
    """Part of the name, in any case; % and _ are letters like others."""
    return F.coalesce(F.lower(c).contains(part.lower()), F.lit(False))


def keep_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The given columns that are there, in the given order, and no others."""
    return df.select(*[c for c in names if c in df.columns])


def coalesce_aliases(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Each field from the first of its names that is there and not blank."""
    out = {}
    for field, names in aliases.items():
        there = [F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in [field, *names] if n in df.columns]
        out[field] = F.coalesce(*there) if there else F.lit(None).cast("string")
    return df.withColumns(out)


def reorder(df: DataFrame, first: list[str]) -> DataFrame:
    """The given columns that are there, then the rest."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def normalise_record(df: DataFrame) -> DataFrame:
    """Ticker in upper case, language in lower case, year and fy as numbers, form to a known one."""
    rules = {
        "ticker": lambda c: F.upper(F.trim(c)),
        "language": lambda c: F.lower(F.trim(c)),
        "year": lambda c: c.cast("string").try_cast("int"),
        "fy": lambda c: c.cast("string").try_cast("int"),
        "form": lambda c: F.when(F.upper(F.trim(c)).isin("10-K", "10-Q", "8-K"), F.upper(F.trim(c))).otherwise("OTHER"),
    }
    return df.withColumns({n: f(F.col(n)) for n, f in rules.items() if n in df.columns})


def quarantine(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds reason, the first rule that fails, null for valid rows. Rows fail one by one, not with their file."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(rules.items()):
        reason = F.when(~F.coalesce(ok, F.lit(False)), name).otherwise(reason)
    return df.withColumn("reason", reason)


def above_confidence(entities: str, least: float = 0.5) -> Column:
    """Entities with that confidence."""
    return F.filter(entities, lambda e: e["confidence"] >= least)


def search_entities(nodes: DataFrame, label: str | None = None, name: str | None = None, ticker: str | None = None, year: int | None = None, limit: int = 20) -> DataFrame:
    """Nodes by label, part of the name, ticker and year, most mentioned first."""
    out = nodes
    if label:
        out = out.where(F.col("label") == label)
    if name:
        out = out.where(F.upper("name").contains(name.upper()))
    if ticker:
        out = out.where(F.array_contains("tickers", ticker.upper()))
    if year is not None:
        out = out.where(F.array_contains("years", year))
    return out.orderBy(F.desc("mention_count"), "node_id").limit(limit)
