"""Numbers in text and in facts, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import col, located

#: Scale words, currency signs and codes.
SCALES = {"billion": 1e9, "bn": 1e9, "b": 1e9, "million": 1e6, "mn": 1e6, "m": 1e6, "thousand": 1e3, "k": 1e3}
CURRENCIES = {"$": "USD", "usd": "USD", "us$": "USD", "eur": "EUR", "€": "EUR", "cny": "CNY", "rmb": "CNY", "¥": "CNY", "jpy": "JPY", "gbp": "GBP", "£": "GBP"}
#: What numbers in text look like, references to rules that are no numbers, and what tells that a date or a tagged name is near.
NUMBER = r"([$€£¥])?((?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?)\s*"
SCALE_WORD = r"(billion|million|thousand|bn|mn|m|k)"
LEGAL = r"\b(?:Rule|Item)\s+\d+[a-z0-9\-]*\b|\bSection\s+\d+(?:\([a-z]\))?\b|§\s*\d+(?:\.\d+)*|\b12b-2\b"
NEAR_DATE = r"(?i)\b(?:19|20)\d{2}-\d{2}-\d{2}\b|\b(?:january|february|march|april|may|june|july|august|september|october|november|december)\s+\d{1,2},\s*(?:19|20)\d{2}\b"
NEAR_NAME = r"\b[A-Za-z0-9:.\-]*Member\b|\b(?:us-gaap|dei|srt|ifrs-full):[A-Za-z]\w*"
MONTHS = r"(?i)\bmonths?\b"
AROUND = 30
PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def is_numeric_like(c: Column | str) -> Column:
    """P10: a number once , ( ) $ are gone."""
    return F.coalesce(F.trim(F.translate(col(c), ",()$", "")).rlike(PLAIN), F.lit(False))


def float_maybe(c: Column | str, percent: bool = False) -> Column:
    """number without commas and a trailing percent sign, which divides by 100 if percent is set; else null."""
    s = F.trim(F.replace(col(c), F.lit(","), F.lit("")))
    has = s.endswith("%")
    bare = F.trim(F.regexp_replace(s, "%$", ""))
    v = F.when(bare.rlike(PLAIN), bare.try_cast("double"))
    return F.when(has, v / 100).otherwise(v) if percent else v


def human_number(c: Column | str) -> Column:
    """parentheses are negative, commas, $ and no-break spaces go, K M B T scale; else null."""
    s = F.trim(F.regexp_replace(col(c), "[,$ ]", ""))
    negative = s.rlike(r"^\(.*\)$")
    s = F.trim(F.regexp_replace(s, r"^\(|\)$", ""))
    number, unit = F.regexp_extract(s, r"^([+-]?\d+(?:\.\d+)?)\s*([KMBTkmbt]?)$", 1), F.upper(F.regexp_extract(s, r"^([+-]?\d+(?:\.\d+)?)\s*([KMBTkmbt]?)$", 2))
    scale = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).when(unit == "T", 1e12).otherwise(1.0)
    v = F.when(number != "", number.try_cast("double") * scale)
    return F.when(negative, -v).otherwise(v)


def number_tokens(c: Column | str, legacy: bool = False) -> Column:
    """Numbers with sign of currency, scale and the letters around; those of legal references are left out.

    References are part of the pattern, so a number in one is never a match of its own.
    legacy: a scale letter needs no end of word, so that "5 more" is five million.
    """
    text = F.coalesce(col(c), F.lit(""))
    number = NUMBER + (f"{SCALE_WORD}?" if legacy else rf"(?:{SCALE_WORD}\b)?")
    numbers = F.filter(located(text, f"(?i){LEGAL}|{number}"), lambda m: ~m["raw"].rlike(f"(?i)^(?:{LEGAL})$"))
    scales = F.create_map(*[F.lit(x) for kv in SCALES.items() for x in kv])
    signs = F.create_map(*[F.lit(x) for kv in CURRENCIES.items() for x in kv])

    # step by step, so that each part is made once
    def parts(m: Column) -> Column:
        part = lambda i: F.nullif(F.regexp_extract(m["raw"], f"(?i)^{number}", i), F.lit(""))
        first = F.greatest(m["start"] - AROUND, F.lit(0))
        window = F.substring(text, first + 1, m["end"] + AROUND - first)
        return F.struct(F.trim(m["raw"]).alias("raw"), F.replace(part(2), F.lit(","), F.lit("")).cast("double").alias("base"), F.lower(part(3)).alias("unit"), part(1).alias("sign"), window.alias("window"))

    def token(p: Column) -> Column:
        used = F.when(~((p["unit"] == "m") & p["window"].rlike(MONTHS)), p["unit"])
        return F.struct(
            p["raw"].alias("raw"), (p["base"] * F.coalesce(F.element_at(scales, used), F.lit(1.0))).alias("value"), p["base"].alias("base_value"), p["unit"].alias("unit_token"), used.alias("scale_used"),
            F.element_at(signs, p["sign"]).alias("currency"), p["window"].rlike(NEAR_DATE).alias("near_date"), p["window"].rlike(NEAR_NAME).alias("near_xbrl_qname"), p["window"].alias("window"),
        )

    none = F.array().cast("array<struct<raw:string,value:double,base_value:double,unit_token:string,scale_used:string,currency:string,near_date:boolean,near_xbrl_qname:boolean,window:string>>")
    return F.when(text.rlike(r"\d"), F.transform(F.transform(numbers, parts), token)).otherwise(none)


def percents(c: Column | str) -> Column:
    """n% as fractions, in order."""
    return F.transform(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"(\d+(?:\.\d+)?)\s*%"), 1), lambda x: x.cast("double") / 100)


def currencies(c: Column | str) -> Column:
    """codes of currency signs and words, distinct and sorted."""
    s = F.lower(F.coalesce(col(c), F.lit("")))
    found = F.regexp_extract_all(s, F.lit(r"[$€£¥]|\b(?:usd|eur|cny|rmb|jpy|gbp)\b"), 0)
    code = F.create_map(*[F.lit(x) for kv in CURRENCIES.items() for x in kv])
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.element_at(code, x))))


def iso_durations(c: Column | str) -> Column:
    """PnYnMnD as days of 365, 30 and 1, in order."""
    found = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"(?i)\bP(?=\d)(?:\d+Y)?(?:\d+M)?(?:\d+D)?\b"), 0)
    part = lambda x, u: F.coalesce(F.regexp_extract(x, rf"(?i)(\d+){u}", 1).try_cast("int"), F.lit(0))
    return F.transform(found, lambda x: part(x, "Y") * 365 + part(x, "M") * 30 + part(x, "D"))


def short_value(c: Column | str) -> Column:
    """T, B, M or K with three decimals, else as it is with up to six significant digits."""
    v, a = col(c), F.abs(col(c))
    scaled = lambda x, u: F.concat(F.format_string("%.3f", v / F.lit(x)), F.lit(" " + u))
    small = F.regexp_replace(F.regexp_replace(F.format_string("%.3f", v), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(v.isNull(), "").when(a >= 1e12, scaled(1e12, "T")).when(a >= 1e9, scaled(1e9, "B")).when(a >= 1e6, scaled(1e6, "M")).when(a >= 1e3, scaled(1e3, "K")).otherwise(small)


def normalize_unit(unit: Column | str, qname: Column | str, display: Column | str) -> Column:
    """(unit, family): currency, shares, percent or pure; percent can follow from the display or concept."""
    u, shown = F.trim(col(unit)), F.coalesce(col(display).contains("%"), F.lit(False))
    iso = F.regexp_extract(u, r"(?:iso4217:)?([A-Z]{3})(?:\b|[^A-Z])", 1)
    pair = lambda a, b: F.struct(F.lit(a).cast("string").alias("unit"), F.lit(b).cast("string").alias("family"))
    percent = pair("%", "percent")
    none = u.isNull() | (u == "")
    return (
        F.when(none & (shown | F.lower(col(qname)).contains("percent")), percent)
        .when(none, pair(None, None))
        .when(iso != "", F.struct(iso.alias("unit"), F.lit("currency").alias("family")))
        .when(u.rlike(r"(?i)\bshares?\b"), pair("shares", "shares"))
        .when(u.rlike(r"(?i)\bpercent\b"), percent)
        .when(u.rlike(r"(?i)\bpure\b") & shown, percent)
        .when(u.rlike(r"(?i)\bpure\b"), pair("pure", "pure"))
        .otherwise(F.struct(u.alias("unit"), F.lit(None).cast("string").alias("family")))
    )


def is_percent(family: Column, display: Column, concept: Column) -> Column:
    """By unit, display or concept."""
    return F.coalesce(family == "percent", F.lit(False)) | F.coalesce(display.contains("%"), F.lit(False)) | F.coalesce(F.lower(concept).contains("percent"), F.lit(False))


def scale_percent(value: Column, percent: Column) -> Column:
    """divided by 100 once where percent holds."""
    return F.when(percent, value / 100).otherwise(value)


def consolidate_value(*candidates: Column) -> Column:
    """first candidate that reads as a number."""
    return F.coalesce(*(human_number(c.cast("string")) for c in candidates))


def decimals(c: Column | str) -> Column:
    """whole numbers, integral ones as well; INF and others null."""
    v = F.when(F.trim(col(c)).rlike(PLAIN), F.trim(col(c)).try_cast("double"))
    return F.when(v == F.floor(v), v.cast("int"))


def finite_ratio(a: Column, b: Column) -> Column:
    """percentage with two decimals, half to even; 0 without a base."""
    return F.when(b > 0, F.bround(a * 100.0 / b, 2)).otherwise(0.0)


def inner_product(a: Column | str, b: Column | str) -> Column:
    """in double precision."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_norm(a: Column | str) -> Column:
    return F.sqrt(inner_product(a, a))


def l2_similarity(a: Column | str, b: Column | str) -> Column:
    """1 / (1 + squared distance)."""
    d = F.aggregate(F.zip_with(col(a), col(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)
    return 1 / (1 + d)


def jaccard(a: Column | str, b: Column | str) -> Column:
    """of two arrays of distinct items; 0 if both are empty."""
    union = F.size(F.array_union(col(a), col(b)))
    return F.when(union > 0, F.size(F.array_intersect(col(a), col(b))) / union).otherwise(0.0)


def year_decay(gap: Column, rate: float) -> Column:
    """F64: 0.9 * 2.71828 ** (-rate * (gap - 1)) for a gap, else 1."""
    return F.when(gap > 0, F.pow(F.lit(2.71828), -rate * F.greatest(F.lit(0), gap - 1)) * 0.9).otherwise(1.0)


def bm25_idf(n: Column, df: Column) -> Column:
    return F.log((n - df + 0.5) / (df + 0.5) + 1)


def bm25_tf(tf: Column, length: Column, average: Column, k1: float = 1.5, b: float = 0.75) -> Column:
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / (average + 1e-9)) + 1e-12)
