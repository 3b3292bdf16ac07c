"""Tagged facts: XML instances and linkbases to rows, cleaning, text of facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import fiscal, nested, numeric
from siltstone.functions import text as X
from siltstone.operators import xml_files


def xbrl_facts(files: DataFrame, key: str, xml: str) -> DataFrame:
    return xml_files.facts(files, key, xml)


def xbrl_arcs(files: DataFrame, key: str, xml: str) -> DataFrame:
    return xml_files.arcs(files, key, xml)


#: What the hint of a statement follows from.
EPS = r"(?i)(EarningsPerShare|DilutedShares|BasicShares|AntidilutiveSecurities|WeightedAverageNumber)"
UNREALIZED = r"(?i)Accumulated.*Unrealized.*(Gain|Loss)"
BALANCE_LIKE = (
    r"(?i)(CashAndCashEquivalents(AtCarryingValue)?|MarketableSecurities(Current|Noncurrent)?|Assets|Liabilities|StockholdersEquity|ShareholdersEquity"
    r"|RetainedEarnings|AccumulatedOtherComprehensiveIncome|ShortTerm|LongTerm|Debt|Inventory|Receivables|PropertyPlantAndEquipment|PPE)"
)
DIMENSIONLESS = ["us-gaap:CashAndCashEquivalentsAtCarryingValue", "us-gaap:MarketableSecuritiesCurrent", "us-gaap:MarketableSecuritiesNoncurrent"]


def hint_overrides(hint: Column, concept: Column, instant: Column, signature: Column) -> Column:
    """later rules win: per-share figures, unrealised gains and fair values, balance-like instants, known balances."""
    at = instant.isNotNull()
    fair = F.coalesce(signature.contains("FairValueByFairValueHierarchyLevelAxis"), F.lit(False))
    return F.when(concept.isin(DIMENSIONLESS), "balance").when(at & concept.rlike(BALANCE_LIKE), "balance").when(at & (concept.rlike(UNREALIZED) | fair), "balance").when(concept.rlike(EPS), "income").otherwise(hint)


def clean_facts(facts: DataFrame, ticker: Column, form: Column, accno: Column, filing_year: Column) -> DataFrame:
    """Value, unit, period, dimensions, hint and text of raw facts (the columns of xbrl_facts)."""
    out = facts.withColumn("_u", numeric.normalize_unit("unit", "qname", "value"))
    out = out.withColumns({"unit_normalized": F.col("_u.unit"), "unit_family": F.col("_u.family"), "dims_signature": F.when(F.col("qname").isin(DIMENSIONLESS), "").otherwise(nested.dims_signature("dimensions"))}).drop("_u")
    percent = numeric.is_percent(F.col("unit_family"), F.col("value"), F.col("qname"))
    plain = numeric.human_number(F.regexp_replace("value", "%", ""))
    out = out.withColumns(
        {
            "value_num": numeric.scale_percent(plain, percent),
            "fy": fiscal.period_year(F.col("period_start"), F.col("period_end"), F.col("instant"), filing_year),
            "period_type": fiscal.period_type(F.col("period_start"), F.col("period_end"), F.col("instant")),
            "statement_hint": hint_overrides(X.statement_hint("qname"), F.col("qname"), F.col("instant"), F.col("dims_signature")),
        }
    )
    label = fiscal.period_label(F.col("period_start"), F.col("period_end"), F.col("instant"), F.col("fy"))
    out = out.withColumns({"period_label": label, "value_display": F.coalesce(numeric.short_value("value_num"), F.col("value"))})
    return out.withColumn("rag_text", rag_text(F.col("qname"), F.col("value_display"), F.col("period_label"), ticker, form, accno))


def rag_text(label: Column, value: Column, period: Column, ticker: Column, form: Column, accno: Column) -> Column:
    """F37."""
    return F.concat(F.coalesce(F.nullif(F.trim(label), F.lit("")), F.lit("(no label)")), F.lit(": "), F.coalesce(value, F.lit("")), F.lit(" ("), F.coalesce(period, F.lit("")), F.lit("; "), F.concat_ws(" ", ticker, form, F.concat(F.lit("accno="), accno)), F.lit(")"))


def fact_line(label: Column, value: Column, unit: Column, period: Column, entity: Column, dims: Column, footnotes: Column) -> Column:
    """parts that are missing or blank are left out."""
    part = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{name}="), c))
    return F.concat_ws(" | ", F.concat(label, F.lit(": "), F.coalesce(value, F.lit(""))), part("Unit", unit), part("Period", period), part("Entity", entity), part("Dimensions", dims), part("Footnotes", footnotes))


def fact_document(lines: DataFrame, keys: list[str], order: str, line: str) -> DataFrame:
    """Lines of a filing joined in order."""
    return lines.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: x[line]), "\n").alias("document"))


def block_lines(html: str) -> Column:
    """Lines of a text block: of each table row its cells; without rows the texts between tags. Characters given by number count as blanks."""
    plain = lambda c: X.strip_html(F.regexp_replace(F.regexp_replace(c, r"&#x?[0-9A-Fa-f]+;|&nbsp;", " "), "&amp;", "&"))
    cells = lambda r: F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=<t[dh]\b|</t[dh]\s*>|\z)"), F.lit(1))
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr\s*>|</table|\z)"), F.lit(1))
    by_row = F.filter(F.transform(rows, lambda r: F.trim(F.array_join(F.filter(F.transform(cells(r), plain), lambda x: x != ""), " "))), lambda x: x != "")
    between = F.filter(F.transform(F.split(html, r"<[^>]*>|\n"), plain), lambda x: x != "")
    return F.when(F.size(by_row) > 0, by_row).otherwise(between)


def explode_textblocks(facts: DataFrame, concept: str, html: str, signature: str) -> DataFrame:
    """A row for each number of a text block in place of the block, with the table row or line it stands in as excerpt.

    Ungrouped numbers stay whole. value_num and unit ($, %) are those of the number; other
    rows keep theirs, null if there are none. Blocks without markup give no rows.
    """
    block = F.coalesce(F.lower(concept).contains("textblock"), F.lit(False))
    own = {"value": F.col(html), "excerpt": F.lit(None).cast("string")} | {c: F.lit(None).cast(t) for c, t in (("value_num", "double"), ("unit", "string")) if c not in facts.columns}
    others = facts.where(~block).withColumns(own)
    lines = facts.where(block & F.col(html).contains("<") & F.col(html).contains(">")).withColumn("_line", F.explode(block_lines(html)))
    found = lines.withColumn("_x", F.explode(F.regexp_extract_all("_line", F.lit(r"\(?\$?\d{1,3}(?:,\d{3})+(?:\.\d+)?\)?%?|\(?\$?\d+(?:\.\d+)?\)?%?"), F.lit(0))))
    number, percent = numeric.human_number(F.regexp_replace("_x", "%$", "")), F.col("_x").endswith("%")
    rows = found.withColumns(
        {
            "value": F.col("_x"),
            "value_num": F.when(percent, number / 100).otherwise(number),
            "unit": F.when(percent, "%").when(F.col("_x").rlike(r"^\(?\$") | F.col("_line").contains(" $"), "$").otherwise(F.col("unit") if "unit" in facts.columns else F.lit(None)),
            "excerpt": F.when(F.length("_line") > 256, F.concat(F.substring("_line", 1, 256), F.lit("…"))).otherwise(F.col("_line")),
            signature: F.concat_ws("|", F.nullif(F.col(signature), F.lit("")), F.lit("extracted=textblock")),
        }
    )
    return others.unionByName(rows.select(*others.columns))


def clean_edges(edges: DataFrame, columns: list[str], doubles: list[str], ints: list[str]) -> DataFrame:
    """Given columns (null where missing), numbers cast, rows distinct."""
    out = edges.withColumns({c: F.lit(None).cast("string") for c in columns if c not in edges.columns})
    out = out.withColumns({c: F.col(c).cast("string").try_cast("double") for c in doubles} | {c: F.col(c).cast("string").try_cast("int") for c in ints})
    return out.select(*columns).dropDuplicates()


def dei(facts: DataFrame, keys: list[str], concept: str, value: str) -> DataFrame:
    """symbol, document type, fiscal year and period, and year end of each filing."""
    of = lambda name: F.min(F.when(F.col(concept) == f"dei:{name}", F.col(value)))
    return facts.groupBy(*keys).agg(of("TradingSymbol").alias("ticker"), of("DocumentType").alias("form"), of("DocumentFiscalYearFocus").try_cast("int").alias("fy"), of("DocumentFiscalPeriodFocus").alias("fq"), of("DocumentPeriodEndDate").alias("period_end"), F.regexp_replace(of("CurrentFiscalYearEndDate"), "^-+", "").alias("fye"))


def first_record(facts: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """given columns of each filing's first record, nulls and all."""
    return facts.groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("_r")).select(*keys, "_r.*")


TARGET = "target string, kind string, pattern string, unit string"


def extraction_targets(spark: SparkSession, config: dict | list | None = None) -> DataFrame:
    """What to extract: a list, or one under extraction_targets or targets; without any a single numeric target."""
    listed = config if isinstance(config, list) else (config or {}).get("extraction_targets") or (config or {}).get("targets")
    rows = [{"target": t} if isinstance(t, str) else t for t in listed or [{"target": "value"}]]
    return spark.createDataFrame([(r.get("target") or r.get("name"), r.get("kind") or r.get("type") or "numeric", r.get("pattern"), r.get("unit")) for r in rows], TARGET)


def numeric_answers(lines: DataFrame, line: str, pattern: str) -> DataFrame:
    """Numbers that a pattern finds in fact lines (the numeric question path without a model)."""
    return lines.withColumn("answer", numeric.human_number(F.regexp_extract(line, pattern, 1))).where("answer IS NOT NULL")
