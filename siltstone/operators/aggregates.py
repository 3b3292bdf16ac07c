"""Aggregates, deduplication and quality figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from siltstone.functions.numeric import finite_ratio


def best_label(labels: DataFrame, keys: list[str], text: str, role_rank: Column, lang_rank: Column, order: str) -> DataFrame:
    """Label with the least role, then language rank, then order; null keys are a group."""
    return labels.groupBy(*keys).agg(F.min_by(text, F.struct(role_rank.alias("r"), lang_rank.alias("l"), F.col(order).alias("o"))).alias("best_label"))


def longest_label(labels: DataFrame, keys: list[str], text: str, where: Column, order: str) -> DataFrame:
    """Longest text for which `where` holds, of equally long ones the first."""
    return labels.groupBy(*keys).agg(F.max_by(F.when(where, F.col(text)), F.when(where, F.struct(F.length(text).alias("n"), (-F.col(order)).alias("o")))).alias("longest_label"))


def pivot_labels(labels: DataFrame, keys: list[str], role: str, lang: str, text: str, columns: list[str]) -> DataFrame:
    """A column label_{role}_{lang} for each listed; the least of the texts that are not blank."""
    kind = F.concat_ws("_", F.lit("label"), F.col(role), F.coalesce(lang, F.lit("none")))
    clean = labels.where(F.trim(F.col(text)) != "").withColumn("_k", kind)
    return clean.groupBy(*keys).pivot("_k", columns).agg(F.min(text))


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column | str], n: int = 1) -> DataFrame:
    """First n rows of each key; null keys are equal."""
    w = W.Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def resolve_conflicts(df: DataFrame, key: str, priority: Column, modified: str, order: str) -> DataFrame:
    """One row a record id: higher path priority, then newer, then later; heading and title filled from rows of the same text."""
    w = W.Window.partitionBy(key, "text_hash")
    same = W.Window.partitionBy(key).orderBy(F.desc("_p"), F.desc(modified), F.desc(order))
    filled = df.withColumn("_p", priority)
    for c in ("heading", "title"):
        if c in df.columns:
            filled = filled.withColumn(c, F.coalesce(F.nullif(F.col(c), F.lit("")), F.max(F.nullif(F.col(c), F.lit(""))).over(w)))
    return filled.withColumn("_rn", F.row_number().over(same)).where("_rn = 1").drop("_rn", "_p")


def duplicate_count(keys: list[str]) -> Column:
    """Rows beyond the first of their key."""
    return F.count("*") - F.count_distinct(F.struct(*keys))


def quality_score(df: DataFrame, by: list[str], required: list[str], year: str, number: str, keys: list[str]) -> DataFrame:
    """Presence, filling, numeric year, clean number and duplicates of each group, and the score from 0 to 100 they make."""
    present = sum((F.lit(1.0 if c in df.columns else 0.0) for c in required), F.lit(0.0)) / len(required) * 100
    there = [c for c in required if c in df.columns]
    filled = sum((F.count(c) for c in there), F.lit(0)) / len(required)
    stats = df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        present.alias("presence_pct"),
        finite_ratio(filled, F.count("*")).alias("filled_pct"),
        finite_ratio(F.count_if(F.col(year).cast("string").try_cast("int").isNotNull()), F.count("*")).alias("year_pct"),
        finite_ratio(F.count_if(F.col(number).cast("string").try_cast("double").isNotNull()), F.count("*")).alias("clean_pct"),
        finite_ratio(duplicate_count(keys), F.count("*")).alias("dup_pct"),
    )
    raw = 0.15 * F.col("presence_pct") + 0.35 * F.col("filled_pct") + 0.10 * F.col("year_pct") + 0.40 * F.col("clean_pct") - F.least(F.lit(10.0), 0.2 * F.col("dup_pct"))
    return stats.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw)))


def weighted_average(df: DataFrame, value: str, weight: str) -> DataFrame:
    """A14."""
    return df.agg(F.round(F.sum(F.col(value) * F.col(weight)) / F.sum(weight), 2).alias("weighted_avg"))


def audit(meta: DataFrame, record_id: str, chunk_no: str) -> DataFrame:
    """Records, ids of a bad form, ids whose number differs from the stored one."""
    number = F.regexp_extract(F.coalesce(record_id, F.lit("")), r"::text::chunk-(\d+)$", 1)
    return meta.agg(F.count("*").alias("total"), F.count_if(~F.coalesce(F.col(record_id).rlike(r"^\d{10}-\d{2}-\d{6}::text::chunk-\d+$"), F.lit(False))).alias("bad_format"), F.count_if((number != "") & (number != F.col(chunk_no).cast("string"))).alias("mismatched"))


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """A17, A29."""
    return df.groupBy(column).agg(F.count("*").alias("n"))
