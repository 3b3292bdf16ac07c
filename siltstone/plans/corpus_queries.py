"""Queries of the composed stages: names of filings, index and question path."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import filing, nested
from siltstone.functions import text as X
from siltstone.operators.chunking import chunk_documents, document_lines, heading_of
from siltstone.plans import runner
from siltstone.plans.catalogue import query
from siltstone.plans.table_queries import table
from siltstone.sources.files import record_type


_FORM = "CASE o_orderkey % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' END"
_TICKER = "CASE WHEN o_custkey % 4 < 3 THEN ['ABC', 'X', 'LONGNAME'][o_custkey % 4 + 1] END"


@query(f"SELECT o_orderkey, '000000000' || o_custkey % 10 || '-24-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS accno, {_FORM} AS form, CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y%m%d') END AS doc_date, {_TICKER} AS ticker, CASE WHEN o_orderkey % 5 > 0 AND month(o_orderdate) % 3 = 0 THEN 'Q' || CAST(month(o_orderdate) // 3 AS VARCHAR) END AS fq FROM orders")
def f12_sniff_meta(spark, sf):
    """Dashes of three kinds, two dates of which the last counts, tickers and forms that are missing at times."""
    k, t = F.col("o_orderkey"), F.col("o_custkey") % 4
    dash = F.when(k % 2 == 0, "–").otherwise("-")
    form = F.when(k % 3 == 0, "10-K").when(k % 3 == 1, "10-q").otherwise("other")
    name = F.when(t == 0, "abc-").when(t == 1, "US_x_").when(t == 2, "LongName-").otherwise("12-")
    day = F.when(k % 5 > 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("none")
    first = F.when(k % 5 > 0, "19990101").otherwise("first")
    p = F.concat(F.lit("/d/"), form, F.lit("/"), first, F.lit("/000000000"), (F.col("o_custkey") % 10).cast("string"), dash, F.lit("24"), dash, F.lpad(k.cast("string"), 6, "0"), F.lit("/"), name, day, F.lit(".xml"))
    m = table(spark, sf, "orders").select("o_orderkey", filing.sniff_meta(p).alias("m"))
    return m.select("o_orderkey", "m.accno", "m.form", "m.doc_date", "m.ticker", "m.fq")


@query("SELECT o_orderkey, 'T' || CAST(o_custkey AS VARCHAR) AS ticker, CASE WHEN o_orderkey % 4 > 0 THEN year(o_orderdate) END AS year, CASE WHEN o_orderkey % 2 = 0 THEN '10-Q' ELSE '8-K' END AS form, CASE WHEN o_orderkey % 3 > 0 THEN 'a_' || o_orderkey ELSE '' END AS accno FROM orders")
def f14_meta_from_path(spark, sf):
    k = F.col("o_orderkey")
    year = F.when(k % 4 > 0, F.year("o_orderdate").cast("string")).otherwise("undated")
    form = F.when(k % 2 == 0, "10-q").otherwise("8-K")
    p = F.concat(F.lit("/data/t"), F.col("o_custkey").cast("string"), F.lit("/"), year, F.lit("/"), form, F.when(k % 3 > 0, F.concat(F.lit("_a_"), k.cast("string"))).otherwise(""), F.lit("/text.jsonl"))
    m = table(spark, sf, "orders").select("o_orderkey", X.meta_from_path(p).alias("m"))
    return m.select("o_orderkey", "m.ticker", "m.year", "m.form", "m.accno")


@query("SELECT p_partkey, p_name || CASE p_partkey % 3 WHEN 0 THEN ' (USD, millions)' WHEN 1 THEN ' (JPY, thousands)' ELSE '' END AS h FROM part")
def f33_humanize_header(spark, sf):
    k = F.col("p_partkey") % 3
    t = F.when(k == 0, "$ in millions").when(k == 1, "thousands of yen").otherwise("plain")
    d = table(spark, sf, "part").withColumn("u", filing.unit_and_currency(t))
    return d.select("p_partkey", filing.humanize_header("p_name", F.col("u.unit"), F.col("u.currency")).alias("h"))


@query("SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'standard' WHEN 1 THEN 'terse' WHEN 2 THEN n_name ELSE 'standard' END AS role, CASE n_nationkey % 3 WHEN 0 THEN 'en-US' WHEN 1 THEN 'zh' ELSE 'x-' || n_nationkey END AS lang, 'us-gaap:' || n_name AS qname FROM nation")
def f34_roles(spark, sf):
    k = F.col("n_nationkey")
    uri = F.when(k % 4 == 0, "http://www.xbrl.org/2003/role/label").when(k % 4 == 1, "http://www.xbrl.org/2003/role/terseLabel").when(k % 4 == 2, F.concat(F.lit("http://x/role/"), "n_name"))
    lang = F.when(k % 3 == 0, " EN-us").when(k % 3 == 1, "zh-CN").otherwise(F.concat(F.lit("x-"), k.cast("string")))
    href = F.concat(F.lit("a.xsd#us-gaap_"), "n_name")
    return table(spark, sf, "nation").select("n_nationkey", X.short_role(uri).alias("role"), X.canonical_lang(lang).alias("lang"), X.locator_qname(href).alias("qname"))


@query("SELECT p_partkey, p_brand || CASE WHEN p_size % 3 = 0 THEN '*' || p_type ELSE '' END || CASE WHEN p_partkey % 2 = 0 THEN '/' || p_name ELSE '' END AS u FROM part")
def f31_unit_string(spark, sf):
    none = F.array().cast("array<string>")
    return table(spark, sf, "part").select("p_partkey", nested.unit_string(F.when(F.col("p_size") % 3 == 0, F.array("p_brand", "p_type")).otherwise(F.array("p_brand")), F.when(F.col("p_partkey") % 2 == 0, F.array("p_name")).otherwise(none)).alias("u"))


@query("SELECT event_id, CASE event_type WHEN 'error' THEN 'fact' WHEN 'click' THEN 'text' ELSE 'label_long' END AS kind FROM events")
def s13_record_routing(spark, sf):
    name = F.when(F.col("event_type") == "error", "x/fact.jsonl").when(F.col("event_type") == "click", "x/text_corpus.jsonl").otherwise("x/labels.parquet")
    return table(spark, sf, "events").select("event_id", record_type(name).alias("kind"))


def _chunks(docs):
    lines = document_lines(docs, "doc_id", "text").withColumn("h", heading_of("text"))
    return chunk_documents(lines, "doc", "line", "h", "text")


def _index(spark, sf):
    return runner.build_index(_chunks(table(spark, sf, "documents")))


@query()
def r02_build_index(spark, sf):
    """All that the index holds, vectors included. Documents of one source were filed before with another text, and those of another also lie in a folder of lower priority with a later date; neither stays."""
    docs = table(spark, sf, "documents")
    filed = lambda d, path, at: _chunks(d).withColumns({"path": F.lit(path), "at": F.lit(at)})
    other = lambda source: docs.where(F.col("source") == source).withColumn("text", F.lit("an older text"))
    chunks = filed(docs, "clean/text_chunks.jsonl", 2).unionByName(filed(other("src3"), "clean/text_chunks.jsonl", 1)).unionByName(filed(other("src5"), "raw/text_chunks.jsonl", 3))
    return runner.build_index(chunks, path="path", modified="at").select("id", "id64", "title", "heading", "snippet", "chunk_index", "text_hash", "embedding")


@query()
def r20_run_query(spark, sf):
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    return runner.search_index(_index(spark, sf), q).select("qid", "doc", "rank")
