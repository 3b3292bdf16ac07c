"""Operators that depend on the order of rows; order columns are always given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def carry_forward(df: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Last value so far that is not null, the row's own included."""
    w = W.Window.partitionBy(*by).orderBy(*order).rowsBetween(W.Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def section_path(df: DataFrame, by: list[str], order: list[str], text: str) -> DataFrame:
    """Part, item and section path of each row; an item's number can end with a letter."""
    part = F.nullif(F.upper(F.regexp_extract(text, r"(?i)^\s*part\s+([ivx]+)\s*[\.\-:]?\s*(.*)$", 1)), F.lit(""))
    item = F.nullif(F.upper(F.regexp_extract(text, r"(?i)^\s*item\s+(\d+(?:\.\d+)*[a-z]?)\s*[\.\-:]?\s*(.*)$", 1)), F.lit(""))
    out = carry_forward(df, by, order, part, "part")
    out = carry_forward(out, by, order, item, "item")
    path = F.concat_ws(" / ", F.concat(F.lit("Part "), F.col("part")), F.concat(F.lit("Item "), F.col("item")))
    return out.withColumn("section_path", path)


def sections(df: DataFrame, by: list[str], order: list[str], heading: str) -> DataFrame:
    """Adds section, from 0. A new one begins where the row before has a heading and it is another one; rows without heading belong to the next that has one."""
    w = W.Window.partitionBy(*by).orderBy(*order)
    before = F.lag(heading).over(w)
    new = F.when(before.isNotNull() & (F.col(heading).isNull() | (F.col(heading) != before)), 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("section", F.sum("_new").over(w.rowsBetween(W.Window.unboundedPreceding, 0)).cast("int")).drop("_new")


def index_and_count(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """chunk_index from 0 and chunk_count."""
    return df.withColumns({"chunk_index": F.row_number().over(W.Window.partitionBy(*by).orderBy(*order)) - 1, "chunk_count": F.count("*").over(W.Window.partitionBy(*by)).cast("int")})


def ranked(df: DataFrame, by: list[str], order: list[Column | str], name: str = "rank") -> DataFrame:
    """W07."""
    return df.withColumn(name, F.row_number().over(W.Window.partitionBy(*by).orderBy(*order)))


def stitch_adjacent(df: DataFrame, by: list[str], number: str, heading: str, content: str) -> DataFrame:
    """Runs of consecutive numbers with one heading, contents joined by a blank line."""
    w = W.Window.partitionBy(*by, heading).orderBy(number)
    runs = df.withColumn("_run", F.col(number) - F.row_number().over(w))
    parts = F.transform(F.array_sort(F.collect_list(F.struct(number, content))), lambda x: x[content])
    return runs.groupBy(*by, heading, "_run").agg(F.min(number).alias("first_no"), F.count("*").alias("n_parts"), F.array_join(parts, "\n\n").alias("content")).drop("_run")


def top_k(df: DataFrame, by: list[str], order: list[Column | str], k: int) -> DataFrame:
    """First k rows of each group, with their rank."""
    return ranked(df, by, order).where(F.col("rank") <= k)


def period_weight(header: Column | str) -> Column:
    """Ten times the year plus the quarter; current without a year and prior weigh extra."""
    h = F.upper(F.col(header) if isinstance(header, str) else header)
    year = F.regexp_extract(h, r"(20\d{2}|19\d{2})", 1).try_cast("int")
    quarter = F.regexp_extract(h, r"Q([1-4])", 1).try_cast("int")
    base = F.when(h.contains("CURRENT") & year.isNull(), 3000).when(h.contains("PRIOR") | h.contains("PREVIOUS"), 1000).otherwise(0)
    return F.coalesce(year, F.lit(0)) * 10 + F.coalesce(quarter, F.lit(0)) + base
