"""What file names, folders, headers and records say about a filing, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import col

_DASH = "[-‐-―]"


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def sniff_meta(path: Column | str) -> Column:
    """accession (any dash), form, last date of eight digits, ticker, year and calendar quarter of a quarter's last month."""
    p = col(path)
    accno = F.regexp_replace(_some(F.regexp_extract(p, rf"(\d{{10}}{_DASH}\d{{2}}{_DASH}\d{{6}})", 1)), _DASH, "-")
    form = F.upper(_some(F.regexp_extract(p, r"(?i)\b(10-[KQ]|20-F|40-F|8-K)(?![A-Za-z0-9])", 1)))
    dates = F.regexp_extract_all(p, F.lit(r"(?<!\d)((?:19|20)\d{6})(?!\d)"), 1)
    day = F.try_element_at(dates, F.lit(-1))
    ticker = F.upper(_some(F.regexp_extract(F.element_at(F.split(p, "/"), -1), r"(?i)^(?:US_)?([A-Z]{1,10})[_-]", 1)))
    month = F.substring(day, 5, 2).try_cast("int")
    quarter = F.when(month.isin(3, 6, 9, 12), F.concat(F.lit("Q"), (month / 3).cast("int").cast("string")))
    return F.struct(accno.alias("accno"), form.alias("form"), day.alias("doc_date"), ticker.alias("ticker"), F.substring(day, 1, 4).try_cast("int").alias("year"), quarter.alias("fq"))


def meta_from_parents(path: Column | str) -> Column:
    """ticker before and accession after the folder that is named like a form."""
    parts = F.split(col(path), "/")
    forms = F.transform(parts, lambda x: F.upper(x).isin("10-K", "10-Q", "8-K", "20-F", "40-F"))
    at = F.array_position(forms, True).cast("int")
    pick = lambda i: F.when((at > 0) & (at + i > 0), F.try_element_at(parts, at + i))
    return F.struct(F.upper(pick(-1)).alias("ticker"), F.upper(pick(0)).alias("form"), pick(1).alias("accno"))


def filing_guess(path: Column | str) -> Column:
    """F16: accession is the folder's name if it has a dash; ticker is the start of the file's name."""
    parts = F.split(col(path), "/")
    folder = F.try_element_at(parts, F.lit(-2))
    return F.struct(F.when(folder.contains("-"), folder).alias("accno"), F.upper(_some(F.regexp_extract(F.element_at(parts, -1), r"^([A-Za-z]+)", 1))).alias("ticker"))


def coalesced_meta(path: Column | str) -> Column:
    """by the strict rules for names first, then by folders."""
    a, b = sniff_meta(path), meta_from_parents(path)
    return F.struct(F.coalesce(a["ticker"], b["ticker"]).alias("ticker"), F.coalesce(a["form"], b["form"]).alias("form"), F.coalesce(a["accno"], b["accno"]).alias("accno"), a["year"].alias("year"))


#: Currency words and signs of tables; there ¥ is the yen.
TABLE_CURRENCIES = [("USD", r"(?i)\b(us ?dollars?|usd)\b|\$"), ("EUR", r"(?i)\b(euros?|eur)\b|€"), ("GBP", r"(?i)\b(pounds?|gbp)\b|£"), ("CNY", r"(?i)\b(rmb|cny|yuan)\b"), ("JPY", r"(?i)\b(yen|jpy)\b|¥")]


def unit_and_currency(*places: Column) -> Column:
    """F32: scale (1e9, 1e6 or 1e3) and currency by the first place that tells."""
    scale = lambda c: F.when(c.rlike(r"(?i)\bbillions?\b"), "1e9").when(c.rlike(r"(?i)\bmillions?\b"), "1e6").when(c.rlike(r"(?i)\bthousands?\b"), "1e3")

    def currency(c: Column) -> Column:
        out = F.lit(None).cast("string")
        for code, rule in reversed(TABLE_CURRENCIES):
            out = F.when(c.rlike(rule), code).otherwise(out)
        return out

    return F.struct(F.coalesce(*map(scale, places)).alias("unit"), F.coalesce(*map(currency, places)).alias("currency"))


def humanize_header(header: Column | str, unit: Column, currency: Column) -> Column:
    """header (currency, scale)."""
    word = F.when(unit == "1e3", "thousands").when(unit == "1e6", "millions").when(unit == "1e9", "billions")
    inside = F.concat_ws(", ", currency, word)
    return F.when(inside == "", col(header)).otherwise(F.concat(col(header), F.lit(" ("), inside, F.lit(")")))


def json_or_null(c: Column | str, schema: str) -> Column:
    """parsed, null if it is no JSON of that schema."""
    return F.from_json(col(c), schema, {"mode": "PERMISSIVE"})


def context_of(context: Column, start: Column, end: Column, instant: Column) -> Column:
    """period of the context where it has one, else of the flat columns."""
    p = context["period"]
    own = F.coalesce(p["start_date"], p["end_date"], p["instant"]).isNotNull()
    pick = lambda a, b: F.when(own, a).otherwise(b)
    return F.struct(pick(p["start_date"], start).alias("start_date"), pick(p["end_date"], end).alias("end_date"), pick(p["instant"], instant).alias("instant"))
