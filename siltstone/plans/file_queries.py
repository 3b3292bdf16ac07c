"""Queries of readers and writers: what is written to the shared folder is read again."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import entities as E
from siltstone.operators.chunking import document_lines
from siltstone.plans.catalogue import query
from siltstone.plans.table_queries import table
from siltstone.plans.text_queries import _EDGES, _MENTIONS, _edges, _mentions
from siltstone.session import shared_dir
from siltstone.sources import files as Fs


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/siltstone-{uuid.uuid4().hex}/{name}"


def _s(c: str) -> Column:
    return F.col(c).cast("string")


@query("SELECT s_name AS ticker, f.form, y.year FROM supplier, (VALUES ('10-K'), ('10-Q')) f(form), (SELECT s_suppkey AS k, unnest([2000 + s_nationkey, 2021]) AS year FROM supplier) y WHERE s_suppkey = y.k AND s_nationkey % 3 <> 2 AND s_suppkey % 4 <> 3")
def s01_companies(spark, sf):
    s = table(spark, sf, "supplier")
    rows = s.select(F.col("s_name").alias("ticker"), F.when(F.col("s_nationkey") % 3 == 2, "HK").when(F.col("s_nationkey") % 3 == 1, "us").otherwise("US").alias("market"), F.when(F.col("s_suppkey") % 4 == 3, "HKEX").when(F.col("s_suppkey") % 4 == 2, "edgar").otherwise("EDGAR").alias("source"), F.lit("10-K| 10-Q|").alias("form_types"), F.concat((2000 + F.col("s_nationkey")).cast("string"), F.lit("|x|2021")).alias("years"), F.lit("").alias("notes"))
    path = place(spark, "companies")
    Fs.write(rows, path, "csv")
    return Fs.companies(spark, path)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 AND o_custkey <> 7 THEN lpad(CAST(o_custkey AS VARCHAR), 10, '0') WHEN o_orderkey % 4 = 1 THEN lpad(CAST(o_custkey + 10000 AS VARCHAR), 10, '0') WHEN o_orderkey % 4 = 2 THEN 'mapped' WHEN o_orderkey <> 7 THEN lpad(CAST(o_orderkey AS VARCHAR), 10, '0') END AS cik FROM orders")
def s05_cik_chain(spark, sf):
    k, none = F.col("o_orderkey") % 4, F.lit(None).cast("string")
    path = F.when(k == 0, F.concat(F.lit("/edgar/data/"), _s("o_custkey"), F.lit("/x"))).otherwise("/other/")
    html = F.when(k == 1, F.concat(F.lit("<b>CIK</b>: "), (F.col("o_custkey") + 10000).cast("string")))
    accno = F.concat(F.lpad(_s("o_orderkey"), 10, "0"), F.lit("-24-000001"))
    return table(spark, sf, "orders").select("o_orderkey", Fs.cik(path, html, F.when(k == 2, "mapped").otherwise(none), accno, ["0000000007"]).alias("cik"))


@query("SELECT event_type AS status, 2 * count(*) AS n FROM events GROUP BY 1")
def s06_log_append(spark, sf):
    log = table(spark, sf, "events").select("event_id", F.col("event_type").alias("status"))
    path = place(spark, "log")
    for _ in range(2):
        Fs.write(log, path, "csv", mode="append")
    return spark.read.schema("event_id long, status string").csv(path, header=True).groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR) WHEN 1 THEN CAST(year(o_orderdate) + 1 AS VARCHAR) WHEN 2 THEN CASE WHEN o_custkey % 100 < 70 THEN '20' ELSE '19' END || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') ELSE '0000' END AS year FROM orders")
def s08_filing_year(spark, sf):
    k, y = F.col("o_orderkey") % 4, F.year("o_orderdate")
    meta = F.when(k == 0, F.concat(F.lit('{"filing_date": "'), y.cast("string"), F.lit('-01-05"}')))
    text = F.when(k == 1, F.concat(F.lit("Filing Date: "), (y + 1).cast("string"), F.lit("-02-03"))).otherwise("nothing")
    accno = F.when(k == 2, F.concat(F.lit("0000000001-"), F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0"), F.lit("-000001"))).otherwise("none")
    return table(spark, sf, "orders").select("o_orderkey", Fs.filing_date(meta, text, accno).alias("year"))


@query("SELECT ['label', 'calculation', 'definition', 'presentation', 'schema', 'instance'][o_orderkey % 8 + 1] AS kind, count(*) AS n FROM orders WHERE o_orderkey % 8 < 6 GROUP BY 1")
def s09_s22_s23_payloads(spark, sf):
    end = F.element_at(F.array(*map(F.lit, ("_lab.xml", "_CAL.xml", "_def.xml", "_pre.xml", ".xsd", ".xml", "FilingSummary.xml", ".htm"))), (F.col("o_orderkey") % 8 + 1).cast("int"))
    return Fs.xml_payloads(table(spark, sf, "orders").select(F.concat(F.lit("a"), _s("o_orderkey"), end).alias("name")), "name").groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, 'US_AB_' || year(o_orderdate) || '_10-K_' || o_custkey || '.htm' AS name FROM orders")
def s10_standard_name(spark, sf):
    n = Fs.standard_name(F.lit("ab"), F.year("o_orderdate"), F.lit("10-k"), _s("o_custkey"), F.lit("HTM"))
    return table(spark, sf, "orders").select("o_orderkey", n.alias("name"))


@query("SELECT n_nationkey AS k, n_nationkey % 2 = 0 AS is_xml, length(n_name) AS n FROM nation")
def s11_whole_texts(spark, sf):
    path = place(spark, "texts")
    t = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("<?xml?>\n"), "n_name")).otherwise(F.concat(F.lit("<html>\n"), "n_name"))
    table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), t.alias("value")).repartition("k").write.partitionBy("k").text(path)
    out = Fs.texts(spark, path, "*.txt")
    return out.select(F.regexp_extract("path", r"k=(\d+)", 1).cast("int").alias("k"), "is_xml", F.length(F.regexp_replace("text", r"^<[^>]*>\s|\s$", "")).cast("long").alias("n"))


@query("SELECT doc_id, count(*) AS n_lines, sum(length(t)) AS letters FROM (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id, trim(t, ' ')) AS rn FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents) WHERE trim(t, ' ') <> '') WHERE rn = 1 GROUP BY 1")
def s12_text_lines(spark, sf):
    lines = document_lines(table(spark, sf, "documents"), "doc_id", "text")
    return lines.groupBy(F.col("doc").alias("doc_id")).agg(F.count("*").alias("n_lines"), F.sum(F.length("text")).alias("letters"))


@query("SELECT CASE WHEN n_nationkey % 5 > 0 THEN n_nationkey END AS k, n_nationkey % 5 = 0 AS bad FROM nation")
def s13_bad_lines(spark, sf):
    path = place(spark, "lines")
    line = F.when(F.col("n_nationkey") % 5 == 0, "{oops").otherwise(F.concat(F.lit('{"k": '), _s("n_nationkey"), F.lit("}")))
    table(spark, sf, "nation").select(line.alias("value")).write.text(path)
    return Fs.jsonl(spark, path, "k int").select("k", F.col("_corrupt_record").isNotNull().alias("bad"))


_CUSTOMER = "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer"


def _again(spark: SparkSession, sf: str, fmt: str, by: list[str] | None = None) -> DataFrame:
    c, path = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), place(spark, fmt)
    Fs.write(c, path, fmt, by=by)
    r = spark.read.schema(c.schema)
    return (r.json(path) if fmt == "jsonl" else r.csv(path, header=True) if fmt == "csv" else r.parquet(path)).select(*c.columns)


@query(_CUSTOMER)
def s14_jsonl(spark, sf):
    return _again(spark, sf, "jsonl")


@query(_CUSTOMER)
def s15_parquet(spark, sf):
    return _again(spark, sf, "parquet")


@query(_CUSTOMER)
def s16_csv(spark, sf):
    return _again(spark, sf, "csv")


@query(_CUSTOMER)
def s17_partitions(spark, sf):
    return _again(spark, sf, "parquet", ["c_mktsegment"])


@query("SELECT p_partkey, '{\"name\":\"' || p_name || '\",\"tags\":[\"' || p_brand || '\"]}' AS info FROM part")
def s18_nested_to_csv(spark, sf):
    path = place(spark, "nested")
    Fs.write(table(spark, sf, "part").select("p_partkey", F.struct(F.col("p_name").alias("name"), F.array("p_brand").alias("tags")).alias("info")), path, "csv")
    return spark.read.schema("p_partkey long, info string").option("escape", "\\").csv(path, header=True)


@query("SELECT event_id FROM events WHERE event_id % 3 = 0 OR event_id % 3 = 1 AND event_id % 2 = 0")
def s20_newer_inputs(spark, sf):
    """The manifest lacks a third, and has half of another third as older ones."""
    e = table(spark, sf, "events").select("event_id", F.lit(5.0).alias("mtime"))
    done = e.where("event_id % 3 > 0").withColumn("mtime", F.when((F.col("event_id") % 3 == 1) & (F.col("event_id") % 2 == 0), 4.0).otherwise(5.0))
    return Fs.unprocessed(e, done.unionByName(done.withColumn("mtime", F.lit(1.0))), "event_id", "mtime").select("event_id")


@query("SELECT o_orderstatus AS filing_id, o_orderkey AS doc_order, o_orderpriority AS value_raw, '[\"USD\"]' AS measures FROM orders")
def s24_s25_store(spark, sf):
    """Loading twice leaves one copy of each filing."""
    o, path = table(spark, sf, "orders"), place(spark, "store")
    none = F.lit(None).cast("string")
    facts = o.select(F.col("o_orderstatus").alias("filing_id"), F.lit("x:y").alias("qname"), F.col("o_orderpriority").alias("value_raw"), F.lit(False).alias("is_numeric"), none.alias("decimals"), F.lit("u").alias("unit_id"), F.lit("c").alias("context_id"), none.alias("label_role"), none.alias("footnote_refs"), F.col("o_orderkey").alias("doc_order"))
    units = o.select(F.col("o_orderstatus").alias("filing_id"), F.lit("u").alias("unit_id"), F.lit('["USD"]').alias("measures")).distinct()
    empty = {name: spark.createDataFrame([], schema) for name, schema in Fs.STORE.items() if name not in ("facts", "units")}
    for _ in range(2):
        Fs.save_store({"facts": facts, "units": units, **empty}, path)
    store = Fs.load_store(spark, path)
    return store["facts"].join(store["units"], ["filing_id", "unit_id"]).select("filing_id", "doc_order", "value_raw", "measures")


@query("SELECT vec_id AS id, len(embedding) AS dim, label FROM embeddings")
def s26_s27_index(spark, sf):
    path = place(spark, "index")
    Fs.save_index(table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id"), path)
    return Fs.load_index(spark, path).select("id", F.size("embedding").cast("long").alias("dim"), "label")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'inner' END AS lang, source FROM documents")
def s28_flat_meta(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang"), F.struct(F.lit("inner").alias("lang"), "source").alias("meta"))
    return Fs.flatten_meta(d)


@query(f"SELECT source AS a, target AS b, weight AS n FROM ({_EDGES}) UNION ALL SELECT label || '::' || upper(name), array_to_string(list_sort(list_distinct(list(ticker))), ','), count(*) FROM ({_MENTIONS}) GROUP BY label || '::' || upper(name)")
def s29_graph(spark, sf):
    path = place(spark, "graph")
    Fs.save_graph(E.graph_nodes(_mentions(spark, sf)), _edges(spark, sf), path)
    nodes, edges = Fs.load_graph(spark, path)
    return edges.select(F.col("source").alias("a"), F.col("target").alias("b"), F.col("weight").alias("n")).unionByName(nodes.select(F.col("node_id").alias("a"), F.array_join("tickers", ",").alias("b"), F.col("mention_count").alias("n")))


@query(f"SELECT label, name AS normalized, count(*) AS total, count(DISTINCT y) AS years FROM ({_MENTIONS}) GROUP BY 1, 2")
def s30_timelines(spark, sf):
    path = place(spark, "timelines")
    Fs.save_timelines(E.timeline_totals(E.timeline(_mentions(spark, sf), "sid")), path)
    return Fs.load_timelines(spark, path).select("label", "normalized", "total", F.size("entries").cast("long").alias("years"))


@query("SELECT p_partkey, m.concept, m.surface FROM part JOIN (VALUES ('tool', 'widget'), ('tool', 'bolt'), ('metal', 'rod')) m(concept, surface) ON contains(p_name, m.surface)")
def s32_mapping(spark, sf):
    from siltstone.operators.joins import surface_hits

    surfaces = Fs.mapping_surfaces(spark, {"tool": ["widget", "bolt"], "metal": ["rod"]})
    return surface_hits(table(spark, sf, "part"), "p_name", surfaces, "surface").select("p_partkey", "concept", "surface")
