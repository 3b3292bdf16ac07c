"""Text functions as Column expressions. Null in, null out, unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that keyword search ignores.
BM25_STOPWORDS = (
    "the a an and or of in to for on by as at is are with its this that from which be we our their it was were has have"
    " had but not no can could would should may might will shall into than then there here also"
).split()
#: Words that word sets for evidence ignore.
EVIDENCE_STOPWORDS = "the a an and or of to in for on by with as at from this that these those is are was were be been being it its".split()
#: Patterns of tokens, record ids and headings.
TOKEN = r"[A-Za-z0-9%$€¥£.\-]+"
MAPPING_TOKEN = r"[A-Za-z0-9%$€¥£./\-]+"
WORD = r"[A-Za-z0-9_\x{4e00}-\x{9fff}]+"
RECORD_ID = r"^\d{10}-\d{2}-\d{6}::text::chunk-\d+$"
NOISE_HEADER = r"(?i)^\s*(table\s+of\s+contents|contents|index|page\s+\d+|exhibit\s+\d+|signature[s]?|united\s+states|securities\s+and\s+exchange\s+commission)\s*$"
ONLY_PUNCTUATION = r"^[^A-Za-z0-9\x{80}-\x{10ffff}]+$"
#: Bullets of lists, lines that mark a table, and lines that lead into one.
BULLET = r"^\s*(?:[•\-–—]|\(\s*(?:[ivxlcdm]+|\d+|[a-zA-Z])\s*\)|(?:\d+\.|[a-zA-Z]\.))\s+"
TABLE_LINE = r"^\s*\[(?:TABLE|Table)\b.*\]\s*$"
TABLE_LEAD = r"(?i)(the following table|the following|were as follows|are as follows|presented?\s+(?:below|as follows)|\(in (?:millions|thousands)\):)\s*(?:\[\w+\])?\s*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def located(c: Column | str, pattern: str) -> Column:
    """Matches of a pattern that never matches nothing, in order: (raw, start, end), by the lengths of what lies between them."""
    s = F.coalesce(col(c), F.lit(""))
    raw, between = F.regexp_extract_all(s, F.lit(pattern), 0), F.split(s, pattern, -1)
    none = F.array().cast("array<struct<raw:string,start:int,end:int>>")
    pairs = F.zip_with(raw, F.slice(between, 1, F.size(raw)), lambda m, gap: F.struct(m.alias("raw"), F.length(gap).alias("gap")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["raw"])
        return F.struct(end.alias("at"), F.array_append(acc["found"], F.struct(x["raw"].alias("raw"), start.alias("start"), end.alias("end"))).alias("found"))

    # most texts have none: one look tells
    return F.when(s.rlike(pattern), F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda acc: acc["found"])).otherwise(none)


def normalize_spaces(c: Column | str) -> Column:
    """no-break spaces to spaces, runs of blanks and tabs to one, ends trimmed."""
    return F.trim(F.regexp_replace(F.replace(col(c), F.lit(" "), F.lit(" ")), r"[ \t]+", " "))


def to_ascii(c: Column | str) -> Column:
    """dashes, bullets, ballot boxes and no-break spaces to ASCII."""
    out = F.translate(col(c), "—–• ", "--* ")
    return F.replace(F.replace(out, F.lit("☒"), F.lit("[x]")), F.lit("☐"), F.lit("[ ]"))


def strip_html(c: Column | str) -> Column:
    """tags to blanks, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(col(c), "<[^>]+>", " "), r"\s+", " "))


def bm25_tokens(c: Column | str, stopwords: list[str] | None = None, min_length: int = 2) -> Column:
    """lower-case tokens of at least min_length that are no stopwords."""
    stop = BM25_STOPWORDS if stopwords is None else stopwords
    found = F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(TOKEN), 0)
    return F.filter(found, lambda t: (F.length(t) >= min_length) & ~t.isin(stop))


def mapping_tokens(c: Column | str) -> Column:
    """lower-case tokens, slashes included, without stopwords."""
    return F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(MAPPING_TOKEN), 0)


def word_set(c: Column | str) -> Column:
    """distinct lower-case words that are no evidence stopwords."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(WORD), 0), lambda t: ~t.isin(EVIDENCE_STOPWORDS)))


def label_tokens(c: Column | str) -> Column:
    """lower case, punctuation other than - / % to blanks, collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(col(c)), r"[^a-z0-9\-/% ]+", " "), r" +", " "))


def is_probable_heading(c: Column | str) -> Column:
    """note or item number, capitals of 3 to 70, or a short capitalised phrase without punctuation."""
    s = F.trim(col(c))
    capitals = (F.upper(s) == s) & (F.lower(s) != s) & F.length(s).between(3, 70)
    return s.rlike(r"(?i)^note\s+\d+\b") | capitals | s.rlike(r"(?i)^item\s+\d+[a-z]?\b") | s.rlike(r"^[A-Z][A-Za-z0-9&,\-\s]{0,70}$")


def is_noise_line(c: Column | str, min_chars: int = 25, retrieval_only: bool = True) -> Column:
    """Empty or only punctuation; unless retrieval_only also headers and short lines without a number, date or rule."""
    s = F.coalesce(col(c), F.lit(""))
    plain = (s == "") | s.rlike(ONLY_PUNCTUATION)
    if retrieval_only:
        return plain
    telling = s.rlike(r"\d") | s.contains("☒") | s.contains("☐") | s.rlike(r"(?i)\bCommission\s+File\s+Number\b")
    return plain | (~is_probable_heading(s) & (((F.length(s) < min_chars) & ~telling) | s.rlike(NOISE_HEADER)))


def keep_for_search(c: Column | str) -> Column:
    """No short number, header boilerplate or address line."""
    s = F.trim(F.coalesce(col(c), F.lit("")))
    short_number = s.rlike(r"^[\d.,()$%\s-]{1,12}$")
    boilerplate = s.rlike(r"(?i)^(form\s+(10-k|10-q|8-k|20-f)|table of contents|index|signatures?)$")
    address = s.rlike(r"(?i)^washington,?\s+d\.?c\.?.*$") & (F.length(s) <= 30)
    return (s != "") & ~short_number & ~boilerplate & ~address


def count_fact_tokens(c: Column | str) -> Column:
    """occurrences of tagged names."""
    return F.regexp_count(col(c), F.lit(r"\b(us-gaap|xbrli|iso4217):"))


def is_table_marker(c: Column | str) -> Column:
    """a table marker line, or a line that leads into a table."""
    return col(c).rlike(TABLE_LINE) | col(c).rlike(TABLE_LEAD)


def chunk_number(record_id: Column | str) -> Column:
    """digits after ::text::chunk-, else NA."""
    n = F.regexp_extract(F.coalesce(col(record_id), F.lit("")), r"::text::chunk-(\d+)$", 1)
    return F.when(n != "", n).otherwise("NA")


def path_priority(path: Column | str, keywords: tuple[str, ...] = ("latest", "final", "clean")) -> Column:
    """number of keywords in the path."""
    return sum((F.lower(col(path)).contains(k).cast("int") for k in keywords), F.lit(0))


def title_from_meta(heading: Column, ticker: Column, form: Column, year: Column) -> Column:
    """heading [TICKER FORM FYyear]; Untitled without a heading."""
    inside = F.concat_ws(" ", ticker, form, F.concat(F.lit("FY"), year.cast("string")))
    head = F.coalesce(F.nullif(F.trim(heading), F.lit("")), F.lit("Untitled"))
    return F.when(inside == "", head).otherwise(F.concat(head, F.lit(" ["), inside, F.lit("]")))


def snippet(c: Column | str, size: int = 420) -> Column:
    """white space collapsed, cut to size with an ellipsis."""
    s = F.trim(F.regexp_replace(col(c), r"\s+", " "))
    return F.when(F.length(s) <= size, s).otherwise(F.concat(F.substring(s, 1, size), F.lit("...")))


def section_tag(heading: Column | str, content: Column | str) -> Column:
    """of the heading, else of the content."""

    def of(c: Column) -> Column:
        s = F.lower(F.coalesce(c, F.lit("")))
        return (
            F.when(s.contains("item 1a") & s.contains("risk"), "risk_factors")
            .when(s.contains("forward-looking"), "fwd_statements")
            .when(s.contains("management’s discussion") | s.contains("md&a") | s.contains("management's discussion"), "md&a")
        )

    return F.coalesce(of(col(heading)), of(col(content)))


def mentions_other_years(c: Column | str) -> Column:
    """a year from 2010 to 2025 before an annual report."""
    return F.coalesce(col(c).rlike(r"(?i)\b20(1\d|2[0-5])\b\s+(?:(?:annual\s+report(?:\s+on\s+form)?\s+)?10(?:-|[\x{2013}\x{2014}])k|form\s+10(?:-|[\x{2013}\x{2014}])k)"), F.lit(False))


#: Corporate suffixes and other names of organisations.
ORG_SUFFIX = r"(?i)\s*,?\s*\b(Corporation|Inc\.?|Corp\.?|Limited|Ltd\.?|Company|Holdings?|LLC|LLP|PLC|Co\.?|Group)\s*$"
ORG_ALIASES = {"ALPHABET": "ALPHABET INC", "GOOGLE": "ALPHABET INC", "META": "META PLATFORMS INC", "FACEBOOK": "META PLATFORMS INC", "AMAZON": "AMAZON.COM INC", "MICROSOFT": "MICROSOFT"}


def normalize_org(c: Column | str) -> Column:
    """upper case without corporate suffix, other names resolved."""
    bare = F.trim(F.regexp_replace(F.upper(F.trim(col(c))), ORG_SUFFIX, ""))
    out = bare
    for name, other in ORG_ALIASES.items():
        out = F.when(bare == name, other).otherwise(out)
    return out


def normalize_entity(text: Column, label: Column) -> Column:
    """organisations normalised, other names in upper case, the rest trimmed."""
    return F.when(label == "ORG", normalize_org(text)).when(label.isin("PERSON", "GPE", "TICKER", "FIN_METRIC"), F.upper(F.trim(text))).otherwise(F.trim(text))


def name_variants(name: Column | str, ticker: Column | str) -> Column:
    """full name, its first word of three letters or more, ticker, name without suffix; all in upper case."""
    full = F.upper(F.trim(col(name)))
    first = F.element_at(F.split(full, r"\s+"), 1)
    return F.array_distinct(F.filter(F.array(full, F.when(F.length(first) >= 3, first), F.upper(F.trim(col(ticker))), normalize_org(name)), lambda v: v.isNotNull() & (v != "")))


def statement_hint(qname: Column | str) -> Column:
    """statement that a concept belongs to, by its first fitting rule."""
    s = F.lower(col(qname))
    has = lambda *words: s.rlike("|".join(words))
    return (
        F.when(s.rlike("^us-gaap:(propertyplantandequipment|accumulateddepreciation|intangibleasset|goodwill|inventory)"), "balance")
        .when(has("revenue", "income", "earnings", "profit", "loss", "eps"), "income")
        .when(has("cash", "operatingactivities", "investingactivities", "financingactivities"), "cashflow")
        .when(has("disclosure", "note", "supplemental", "schedule", "textblock"), "notes")
        .when(has("asset", "liabilit", "equity", "payable", "receivable", "goodwill", "inventory"), "balance")
        .otherwise("other")
    )


def short_role(uri: Column | str) -> Column:
    """role of a label; standard if none."""
    last = F.element_at(F.split(col(uri), "/"), -1)
    roles = {"label": "standard", "terseLabel": "terse", "verboseLabel": "verbose", "documentation": "documentation", "totalLabel": "total"}
    out = last
    for k, v in roles.items():
        out = F.when(col(uri) == f"http://www.xbrl.org/2003/role/{k}", v).otherwise(out)
    return F.when(col(uri).isNull() | (col(uri) == ""), "standard").otherwise(out)


def canonical_lang(lang: Column | str) -> Column:
    """canonical form of a known language, others as they are."""
    s = F.lower(F.trim(col(lang)))
    out = col(lang)
    for k, v in {"en": "en", "en-us": "en-US", "en-gb": "en-GB", "zh": "zh", "zh-cn": "zh", "nl": "nl"}.items():
        out = F.when(s == k, v).otherwise(out)
    return F.nullif(out, F.lit(""))


def locator_qname(href: Column | str) -> Column:
    """fragment after #, its first underscore to a colon."""
    return F.regexp_replace(F.substring_index(col(href), "#", -1), "^([^_]*)_", "$1:")


#: Standard names of filings' files, the looser ones before them, and accession numbers.
FILE_NAME = r"(?i)^(?:US_)?([A-Z]{1,10})_(\d{4})_(10-K|10-Q|20-F|40-F|8-K)_(\d{10}-\d{2}-\d{6})(?:_[a-z0-9\-]+)?_(\d{8})(?:[._]\w+)?\.(xml|html|htm|txt)$"
LEGACY_NAME = r"(?i)^US_(.+?)_(\d{4})_(10-[KQ])_(.+)\.(.+)$"
ACCESSION = r"(\d{10}-\d{2}-\d{6})"


def meta_from_filename(name: Column | str) -> Column:
    """ticker, year, form, accession, date and extension of a standard file name, else of a looser one without a date; nulls if it is neither."""
    strict = lambda i: F.nullif(F.regexp_extract(col(name), FILE_NAME, i), F.lit(""))
    loose = lambda i: F.nullif(F.regexp_extract(col(name), LEGACY_NAME, i), F.lit(""))
    part = lambda i, j: F.coalesce(strict(i), loose(j))
    accno = part(4, 4)
    short = F.nullif(F.regexp_extract(accno, ACCESSION, 1), F.lit(""))
    return F.struct(F.upper(part(1, 1)).alias("ticker"), part(2, 2).try_cast("int").alias("year"), F.upper(part(3, 3)).alias("form"), F.coalesce(short, accno).alias("accno"), strict(5).alias("doc_date"), F.lower(part(6, 5)).alias("ext"))


def meta_from_path(path: Column | str) -> Column:
    """ticker, year, form and accession of .../ticker/year/form_accession/file."""
    parts = F.split(col(path), "/")
    at = lambda i: F.try_element_at(parts, F.lit(i))
    return F.struct(F.upper(at(-4)).alias("ticker"), at(-3).try_cast("int").alias("year"), F.upper(F.substring_index(at(-2), "_", 1)).alias("form"), F.regexp_extract(at(-2), "_(.*)$", 1).alias("accno"))


def split_sentences(c: Column | str) -> Column:
    """Pieces that end with . ! ? before white space or the end of a line; CJK marks count as well."""
    s = F.translate(F.coalesce(col(c), F.lit("")), "。！？", ".!?")
    marked = F.regexp_replace(F.regexp_replace(s, r"([.!?])[ \t\n\r]+", "$1\n"), r"[\n\r]+", "\n")
    return F.filter(F.transform(F.split(marked, "\n"), lambda x: F.trim(x)), lambda x: x != "")


#: Fixed value: where sentences of evidence end.
EVIDENCE_END = r"(?<=[.|?!。！？;；:：])\s+|(?<=…)\s+|(?<=[—–\-])\s+"


def evidence_sentences(c: Column | str) -> Column:
    """Pieces that end with a mark, a bar or a dash before white space."""
    return F.filter(F.split(F.coalesce(col(c), F.lit("")), EVIDENCE_END), lambda x: F.trim(x) != "")


def split_units(c: Column | str) -> Column:
    """Lines; a bullet line is a unit, others are split after . ? ! ; : and dashes."""
    lines = F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    cut = lambda x: F.filter(F.transform(F.split(x, r"(?<=[.?!。！？;:—–])\s+"), lambda x: F.trim(x)), lambda y: y != "")
    return F.flatten(F.transform(lines, lambda x: F.when(x.rlike(BULLET), F.array(x)).otherwise(cut(x))))


def approximate_tokens(c: Column | str) -> Column:
    """a quarter of the letters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(col(c), F.lit(""))) / 4).cast("int"))


def stable_id(c: Column | str) -> Column:
    """a 63-bit id of a record id."""
    return F.shiftrightunsigned(F.xxhash64(col(c)), 1)


def token_windows(c: Column | str, size: int = 900, overlap: int = 120) -> Column:
    """Array of (start, end, text) windows over white-space tokens; the last one ends with the text."""
    tokens = F.filter(F.split(F.coalesce(col(c), F.lit("")), r"\s+"), lambda t: t != "")
    n, stride = F.size(tokens), size - overlap
    last = F.greatest(F.lit(0), F.ceil((n - size) / stride).cast("int"))
    one = lambda i: F.struct((i * stride).alias("start"), F.least(n, i * stride + size).alias("end"), F.array_join(F.slice(tokens, i * stride + 1, size), " ").alias("text"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), one)).otherwise(F.array().cast("array<struct<start:int,end:int,text:string>>"))
