"""Queries over texts: cleaning, sentences, chunks, pages, entities, graph and timelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import text as X
from siltstone.functions.numeric import jaccard
from siltstone.operators import chunking as C
from siltstone.operators import entities as E
from siltstone.operators import html_blocks as Hb
from siltstone.operators.aggregates import keep_first
from siltstone.operators.filters import search_entities
from siltstone.operators.joins import match_vocabulary
from siltstone.operators.search import term_frequencies
from siltstone.plans.catalogue import query
from siltstone.plans.table_queries import table

STOP = ", ".join(f"'{w}'" for w in X.BM25_STOPWORDS)
TOKENS = f"list_filter(regexp_extract_all(lower(coalesce(text, '')), '[A-Za-z0-9%$€¥£.\\-]+'), lambda t: length(t) >= 2 AND NOT list_contains([{STOP}], t))"


@query("SELECT doc_id, trim(regexp_replace(replace(text, chr(160), ' '), '[ \\t]+', ' ', 'g'), ' ') AS t FROM documents")
def f01_spaces(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.normalize_spaces("text").alias("t"))


@query("SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'), ' ') AS t FROM pages")
def f04_strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.strip_html("html").alias("t"))


@query("SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || ' (R&D) - 5%'), '[^a-z0-9\\-/% ]+', ' ', 'g'), ' +', ' ', 'g'), ' ') AS t FROM part")
def f08_label_tokens(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.label_tokens(F.concat("p_name", F.lit(" (R&D) - 5%"))).alias("t"))


@query(f"SELECT doc_id, len(t) AS n, list_sum(list_transform(t, lambda x: length(x))) AS chars FROM (SELECT doc_id, {TOKENS} AS t FROM documents)")
def f05_tokens(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", X.bm25_tokens("text").alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n"), F.when(F.size("t") > 0, F.aggregate("t", F.lit(0).cast("long"), lambda a, w: a + F.length(w))).alias("chars"))


@query("SELECT doc_id, CASE WHEN length(s) <= 420 THEN s ELSE substr(s, 1, 420) || '...' END AS s FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS s FROM documents)")
def f18_snippet(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.snippet("text").alias("s"))


@query("SELECT n_name, x, y FROM (SELECT n_name, upper(trim(n_name)) AS x, CASE WHEN upper(n_name) = 'FRANCE' THEN 'FRANCE' ELSE upper(n_name) END AS y FROM nation)")
def f25_normalize_org(spark, sf):
    return table(spark, sf, "nation").select("n_name", X.normalize_org(F.concat("n_name", F.lit(", Inc."))).alias("x"), X.normalize_org("n_name").alias("y"))


@query(f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS}) AS term FROM documents) GROUP BY 1, 2")
def a01_term_stats(spark, sf):
    return term_frequencies(table(spark, sf, "documents"), "doc_id", "text").select(F.col("doc").alias("doc_id"), "term", "tf")


@query("WITH l AS (SELECT doc_id, unnest(list_zip(string_split(text, chr(10)), range(len(string_split(text, chr(10)))))) AS z FROM documents), r AS (SELECT doc_id, z[2] AS line, z[1] AS t, row_number() OVER (PARTITION BY doc_id, trim(z[1], ' ') ORDER BY z[2]) AS rn FROM l WHERE trim(z[1], ' ') <> '') SELECT doc_id, line, length(t) AS n FROM r WHERE rn = 1")
def a21_text_dedup(spark, sf):
    return C.document_lines(table(spark, sf, "documents"), "doc_id", "text").select(F.col("doc").alias("doc_id"), F.col("line").cast("long").alias("line"), F.length("text").cast("long").alias("n"))


@query("SELECT doc_id, count(*) AS n_sentences, sum(length(trim(s, ' '))) AS n_chars FROM (SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace(text, '([.!?])[ \\t\\n\\r]+', '\\1' || chr(10), 'g'), '[\\n\\r]+', chr(10), 'g'), chr(10))) AS s FROM documents) WHERE trim(s, ' ') <> '' GROUP BY 1")
def t02_sentences(spark, sf):
    s = table(spark, sf, "documents").select("doc_id", F.explode(X.split_sentences("text")).alias("s"))
    return s.groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.sum(F.length("s")).alias("n_chars"))


@query("WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '') AS w FROM documents) SELECT doc_id, i * 780 AS start, least(len(w), i * 780 + 900) AS \"end\" FROM (SELECT doc_id, w, unnest(range(0, CAST(greatest(0, ceil((len(w) - 900) / 780.0)) AS BIGINT) + 1)) AS i FROM w WHERE len(w) > 0)")
def w09_token_windows(spark, sf):
    w = table(spark, sf, "documents").select("doc_id", F.explode(X.token_windows("text")).alias("w"))
    return w.select("doc_id", F.col("w.start").cast("long").alias("start"), F.col("w.end").cast("long").alias("end"))


@query("WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM documents), q AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM benchmark WHERE item_id % 50 = 0) SELECT doc_id, item_id, round(len(list_intersect(w.w, q.w)) / len(list_distinct(list_concat(w.w, q.w))), 6) AS jac FROM w, q")
def u04_jaccard(spark, sf):
    """The stated queries, items with an id divisible by 50, against all documents, in blocks."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), 0))
    d = table(spark, sf, "documents").select("doc_id", words("text").alias("a"))
    asked = table(spark, sf, "benchmark").where("item_id % 50 = 0").select("item_id", words("text").alias("b"))
    return match_vocabulary(d, asked, F.lit(True)).select("doc_id", "item_id", F.round(jaccard("a", "b"), 6).alias("jac"))


@query()
def t04_clean_rows(spark, sf):
    lines = C.document_lines(table(spark, sf, "documents"), "doc_id", "text")
    return C.clean_rows(lines, "doc", "line", "text").select("doc", "line", "sentence_no", "piece_no", "heading", "length", "numbers", "percents")


@query()
def t12_chunks(spark, sf):
    lines = C.document_lines(table(spark, sf, "documents"), "doc_id", "text").withColumn("h", C.heading_of("text"))
    return C.chunk_documents(lines, "doc", "line", "h", "text").select("doc", "section", "chunk_index", "chunk_count", F.length("content").alias("n"))


@query()
def t01_html_blocks(spark, sf):
    return Hb.html_blocks(table(spark, sf, "pages"), "page_id", "html").select("doc", "ord", "tag", "heading", "xpath", F.length("text").alias("n"))


def _filing_text() -> F.Column:
    return F.concat(F.lit("Contoso "), F.col("p_brand"), F.lit(" Holdings Inc. ("), F.upper(F.substring("p_name", 1, 3)), F.lit(") raised EBITDA and EPS to $"), F.col("p_size").cast("string"), F.lit(" million. Ticker: ABCD"))


@query()
def t16_tickers(spark, sf):
    out = E.extract_entities(table(spark, sf, "part").select("p_partkey", _filing_text().alias("text")), "text")
    return out.select("p_partkey", F.transform("entities", lambda e: F.concat_ws("|", e["label"], e["normalized"])).alias("entities"), "entity_labels")


#: Lines of an order as entities of a sentence: brand is an organisation, type a place.
_MENTIONS = "SELECT l.l_orderkey AS sid, row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, CASE WHEN p.p_partkey % 3 = 0 THEN 'GPE' ELSE 'ORG' END, upper(p.p_brand)) AS no, CASE WHEN p.p_partkey % 3 = 0 THEN 'GPE' ELSE 'ORG' END AS label, p.p_brand AS name, o.o_orderpriority AS ticker, year(o.o_orderdate) AS y FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey"


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    l, p, o = (table(spark, sf, t) for t in ("lineitem", "part", "orders"))
    j = l.join(p, F.col("l_partkey") == F.col("p_partkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(F.col("l_orderkey").alias("sid"), F.col("l_linenumber").alias("no"), F.when(F.col("p_partkey") % 3 == 0, "GPE").otherwise("ORG").alias("label"), F.col("p_brand").alias("normalized"), F.col("o_orderpriority").alias("ticker"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("form"), F.concat(F.lit("text of "), "l_returnflag").alias("text"))


@query(f"SELECT label || '::' || upper(name) AS node_id, count(*) AS mention_count, array_to_string(list_sort(list_distinct(list(ticker))), ',') AS tickers, array_to_string(list_sort(list_distinct(list(y))), ',') AS years FROM ({_MENTIONS}) GROUP BY 1")
def a07_nodes(spark, sf):
    n = E.graph_nodes(_mentions(spark, sf))
    return n.select("node_id", "mention_count", F.array_join("tickers", ",").alias("tickers"), F.array_join(F.transform("years", lambda y: y.cast("string")), ",").alias("years"))


_PAIRS = f"SELECT a.sid, a.no AS n1, b.no AS n2, a.label || '::' || upper(a.name) AS a, b.label || '::' || upper(b.name) AS b, CASE WHEN a.label <> b.label THEN 'located_in' ELSE 'co_mentioned' END AS rel FROM ({_MENTIONS}) a JOIN ({_MENTIONS}) b ON a.sid = b.sid AND (a.no < b.no) WHERE a.label || upper(a.name) <> b.label || upper(b.name)"
_EDGES = f"SELECT least(a, b) AS source, greatest(a, b) AS target, count(*) AS weight, coalesce(min(CASE WHEN rel <> 'co_mentioned' THEN rel END), 'co_mentioned') AS relation FROM ({_PAIRS}) GROUP BY 1, 2"


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    m = _mentions(spark, sf).withColumn("id", E.node_id(F.col("label"), F.col("normalized")))
    rows = m.groupBy("sid").agg(F.transform(F.array_sort(F.collect_list(F.struct("no", "id"))), lambda x: x["id"]).alias("ids"))
    pairs = E.entity_pairs(rows, "ids")
    label = lambda c: F.substring_index(c, "::", 1)
    return E.graph_edges(pairs.withColumn("rel", E.relation(label("a"), label("b"), F.lit(""))), "rel", "sid")


@query(f"SELECT a, b, count(*) AS n FROM ({_PAIRS}) GROUP BY 1, 2")
def j15_pairs(spark, sf):
    m = _mentions(spark, sf).withColumn("id", E.node_id(F.col("label"), F.col("normalized")))
    rows = m.groupBy("sid").agg(F.transform(F.array_sort(F.collect_list(F.struct("no", "id"))), lambda x: x["id"]).alias("ids"))
    return E.entity_pairs(rows, "ids").groupBy("a", "b").agg(F.count("*").alias("n"))


@query(_EDGES)
def a08_edges(spark, sf):
    return _edges(spark, sf)


@query(f"SELECT 'ORG::BRAND#1' AS node, CASE WHEN source = 'ORG::BRAND#1' THEN target ELSE source END AS neighbor, weight FROM ({_EDGES}) WHERE source = 'ORG::BRAND#1' OR target = 'ORG::BRAND#1'")
def a11_neighbors(spark, sf):
    return E.neighbors(_edges(spark, sf), spark.createDataFrame([("ORG::BRAND#1",)], "node string"))


_NATION_EDGES = "SELECT n_name AS source, r_name AS target FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey"


@query(
    f"WITH RECURSIVE e AS ({_NATION_EDGES}), b AS (SELECT source AS x, target AS y FROM e UNION ALL SELECT target, source FROM e), s(node, d) AS (SELECT r_name, 0 FROM region WHERE r_regionkey = 1 UNION SELECT b.y, s.d + 1 FROM s JOIN b ON s.node = b.x WHERE s.d < 2), n AS (SELECT DISTINCT node FROM s) SELECT DISTINCT source, target FROM e WHERE source IN (SELECT node FROM n) OR target IN (SELECT node FROM n)"
)
def j16_subgraph(spark, sf):
    n, r, s = (table(spark, sf, t) for t in ("nation", "region", "supplier"))
    edges = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("source"), F.col("r_name").alias("target")).unionByName(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("source"), F.col("n_name").alias("target"))).withColumn("weight", F.lit(1))
    _, found = E.subgraph(edges, r.where("r_regionkey = 1").select(F.col("r_name").alias("node")), 2)
    return found.select("source", "target")


@query(f"SELECT node_id, mention_count FROM (SELECT label || '::' || upper(name) AS node_id, label, name, count(*) AS mention_count, list(DISTINCT ticker) AS tickers, list(DISTINCT y) AS years FROM ({_MENTIONS}) GROUP BY 1, 2, 3) WHERE label = 'ORG' AND contains(upper(name), 'BRAND#1') AND list_contains(tickers, '1-URGENT') AND list_contains(years, 1995) ORDER BY mention_count DESC, node_id LIMIT 5")
def p07_entity_search(spark, sf):
    return search_entities(E.graph_nodes(_mentions(spark, sf)), "ORG", "brand#1", "1-urgent", 1995, 5).select("node_id", "mention_count")


_TIMELINE = f"SELECT label, name AS normalized, y AS year, count(*) AS mentions, array_to_string(list_sort(list_distinct(list(ticker))), ',') AS tickers FROM ({_MENTIONS}) GROUP BY 1, 2, 3"


@query(f"SELECT t.*, c.contexts FROM ({_TIMELINE}) t JOIN (SELECT label, normalized, year, string_agg(context, ';' ORDER BY o, context) AS contexts FROM (SELECT label, normalized, year, context, o, row_number() OVER (PARTITION BY label, normalized, year ORDER BY o, context) AS rn FROM (SELECT label, name AS normalized, y AS year, 'text of ' || flag AS context, min(sid) AS o FROM ({_MENTIONS.replace('year(o.o_orderdate) AS y', 'year(o.o_orderdate) AS y, l.l_returnflag AS flag')}) GROUP BY 1, 2, 3, 4)) WHERE rn <= 3 GROUP BY 1, 2, 3) c USING (label, normalized, year)")
def a09_timeline(spark, sf):
    t = E.timeline(_mentions(spark, sf), "sid")
    return t.select("label", "normalized", "year", "mentions", F.array_join("tickers", ",").alias("tickers"), F.array_join("contexts", ";").alias("contexts"))


@query(f"SELECT label, normalized, CAST(sum(mentions) AS BIGINT) AS total, string_agg(year || ':' || mentions, ',' ORDER BY year) AS entries FROM ({_TIMELINE}) GROUP BY 1, 2")
def a10_timeline_total(spark, sf):
    t = E.timeline_totals(E.timeline(_mentions(spark, sf), "sid"))
    return t.select("label", "normalized", "total", F.array_join(F.transform("entries", lambda e: F.concat_ws(":", e["year"].cast("string"), e["mentions"].cast("string"))), ",").alias("entries"))


@query(f"SELECT sid, array_to_string(list_sort(list_distinct(list(CASE WHEN label = 'ORG' THEN name END))), ',') AS orgs FROM ({_MENTIONS}) GROUP BY 1")
def a12_chunk_entities(spark, sf):
    m = E.merge_chunk_entities(_mentions(spark, sf), ["sid"])
    return m.select("sid", F.coalesce(F.array_join(F.try_element_at("entities", F.lit("entities_org")), ","), F.lit("")).alias("orgs"))


@query("SELECT a.p_partkey, CASE WHEN a.p_size % 3 = 0 THEN 'executive_of' WHEN a.p_size % 3 = 1 THEN 'subsidiary_of' ELSE 'co_mentioned' END AS rel FROM part a")
def t22_relation(spark, sf):
    k = F.col("p_size") % 3
    return table(spark, sf, "part").select("p_partkey", E.relation(F.lit("ORG"), F.when(k == 0, "PERSON").otherwise("ORG"), F.when(k == 1, "it was acquired").otherwise("x")).alias("rel"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'T' || CAST(s_suppkey AS VARCHAR) END AS resolved_ticker, round(CASE WHEN s_suppkey % 2 = 0 THEN 0.95 WHEN s_suppkey % 3 = 0 THEN 0.92 ELSE 0.9 END, 6) AS confidence FROM supplier")
def t21_disambiguate(spark, sf):
    s = table(spark, sf, "supplier")
    ents = s.select("s_suppkey", F.lit("ORG").alias("label"), F.upper("s_name").alias("normalized"), F.lit(0.9).alias("confidence"), F.when(F.col("s_suppkey") % 3 == 0, "quarter revenue").otherwise("nothing").alias("ctx"))
    reg = s.where("s_suppkey % 2 = 0").select(F.col("s_name").alias("variant"), F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("ticker"))
    return E.disambiguate(ents, reg, "ctx").select("s_suppkey", "resolved_ticker", F.round("confidence", 6).alias("confidence"))


@query("SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'T' || s_suppkey WHEN 1 THEN 'OWN' || s_suppkey END AS ticker, round(CASE WHEN s_suppkey % 4 < 2 THEN 1.0 WHEN s_suppkey % 4 = 3 THEN 0.98 WHEN s_suppkey % 3 = 0 THEN 0.99 ELSE 0.97 END, 6) AS confidence, CASE WHEN s_suppkey % 4 < 3 THEN s_suppkey % 4 < 2 OR s_suppkey % 3 = 0 END AS is_company FROM (SELECT *, s_suppkey AS k FROM supplier)")
def t21_own_company(spark, sf):
    """By the registry, by the document's own company, by financial context, and what is no organisation."""
    s, k = table(spark, sf, "supplier"), F.col("s_suppkey") % 4
    key = F.col("s_suppkey").cast("string")
    ents = s.select("s_suppkey", F.when(k == 3, "GPE").otherwise("ORG").alias("label"), F.upper("s_name").alias("normalized"), F.when(k == 3, 0.98).otherwise(0.97).alias("confidence"), F.when(F.col("s_suppkey") % 3 == 0, "quarter revenue").otherwise("nothing").alias("ctx"), F.lower(F.concat(F.lit("own"), key)).alias("own"))
    registry = s.where("s_suppkey % 4 = 0").select(F.col("s_name").alias("variant"), F.concat(F.lit("T"), key).alias("ticker"))
    names = s.where("s_suppkey % 4 <> 2").select(F.concat(F.lit("OWN"), key).alias("ticker"), F.col("s_name").alias("variant"))
    return E.disambiguate(ents, registry, "ctx", "own", names).select("s_suppkey", F.col("resolved_ticker").alias("ticker"), F.round("confidence", 6).alias("confidence"), "is_company")


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def a24_filing_dedup(spark, sf):
    return keep_first(table(spark, sf, "documents"), ["source", "lang"], ["doc_id"]).select("doc_id", "lang")
