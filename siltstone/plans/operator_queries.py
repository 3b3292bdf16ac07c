"""Queries of filters, joins, aggregates, entities, chunks, facts and evidence that the other modules leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import text as X
from siltstone.operators import aggregates as A
from siltstone.operators import chunking as C
from siltstone.operators import entities as E
from siltstone.operators import evidence as Ev
from siltstone.operators import facts as Fx
from siltstone.operators import filters as P
from siltstone.operators import html_blocks as Hb
from siltstone.operators import joins as J
from siltstone.operators import search as S
from siltstone.operators import windows as Wn
from siltstone.operators import xml_files as Xml
from siltstone.plans import runner
from siltstone.plans.catalogue import query
from siltstone.plans.search_queries import _SHOW, _dense, _query_vectors, _show, dense_sql
from siltstone.plans.table_queries import _ORDERS_META, _meta, table
from siltstone.plans.text_queries import _EDGES, _MENTIONS, _NATION_EDGES, _edges, _mentions


def _s(c: str) -> Column:
    return F.col(c).cast("string")


@query(f"SELECT o_orderkey FROM (SELECT o_orderkey, {_ORDERS_META} FROM orders) WHERE upper(ticker) = '2-HIGH' AND upper(form) = 'O' AND TRY_CAST(fy AS INT) = 1996")
def p04_strict_post_filter(spark, sf):
    return _meta(spark, sf).where(P.metadata_filter("2-high", "o", 1996, lenient=False)).select("o_orderkey")


@query("SELECT o_orderkey, o_orderkey % 3 <> 0 AS ok FROM orders")
def p06_valid_record_id(spark, sf):
    rid = F.concat(F.lpad(_s("o_custkey"), 10, "0"), F.lit("-24-"), F.lpad(_s("o_orderkey"), 6, "0"), F.when(F.col("o_orderkey") % 3 == 0, "::chunk-").otherwise("::text::chunk-"), _s("o_custkey"))
    return table(spark, sf, "orders").select("o_orderkey", rid.alias("id")).where(F.length("id") > 0).select("o_orderkey", P.valid_record_id("id").alias("ok"))


@query("SELECT p_partkey FROM part WHERE contains(lower(p_name), 'widget')")
def p13_concept_like(spark, sf):
    return table(spark, sf, "part").where(P.concept_like("p_name", "WIDGET")).select("p_partkey")


@query("SELECT p_name, p_partkey FROM part")
def p14_keep_columns(spark, sf):
    return P.keep_columns(table(spark, sf, "part"), ["accno", "p_name", "p_partkey", "qname"])


@query("SELECT n_name, n_nationkey, n_regionkey, array_to_string(['n_name', 'n_nationkey', 'n_regionkey'], ',') AS columns FROM nation")
def p15_reorder(spark, sf):
    n = P.reorder(table(spark, sf, "nation"), ["n_name", "accno"])
    return n.withColumn("columns", F.lit(",".join(n.columns)))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE o_orderpriority END AS ticker, CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(NULL AS VARCHAR) AS form FROM orders")
def p16_aliases(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.col("o_orderpriority")).alias("ticker"), F.col("o_orderstatus").alias("symbol"), F.year("o_orderdate").alias("fiscal_year"))
    return P.coalesce_aliases(o, {"ticker": ["symbol"], "year": ["fy", "fiscal_year"], "form": ["filing_form"]}).select("o_orderkey", "ticker", "year", "form")


_LINE_ENTITIES = "SELECT l_orderkey AS sid, l_linenumber AS i, CASE WHEN l_partkey % 2 = 0 THEN 'ORG' ELSE 'GPE' END AS label, 'N' || l_suppkey % 3 AS normalized, l_linenumber * 10 - l_suppkey % 7 AS start, round(l_discount * 10, 1) AS confidence FROM lineitem"


def _line_entities(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("sid"), F.col("l_linenumber").alias("i"), F.when(F.col("l_partkey") % 2 == 0, "ORG").otherwise("GPE").alias("label"), F.concat(F.lit("N"), (F.col("l_suppkey") % 3).cast("string")).alias("normalized"), (F.col("l_linenumber") * 10 - F.col("l_suppkey") % 7).alias("start"), F.round(F.col("l_discount") * 10, 1).alias("confidence"))
    return l.groupBy("sid").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "start", "label", "normalized", "confidence"))), lambda x: F.struct(x["label"].alias("label"), x["normalized"].alias("normalized"), x["start"].alias("start"), x["confidence"].alias("confidence"))).alias("e"))


@query(f"SELECT sid, string_agg(label || normalized || '@' || start, ',' ORDER BY start, i, label, normalized) AS kept FROM (SELECT *, row_number() OVER (PARTITION BY sid, label, normalized ORDER BY confidence DESC, i, start) AS rn FROM ({_LINE_ENTITIES})) WHERE rn = 1 GROUP BY 1")
def a22_o07_entity_dedup(spark, sf):
    d = E.dedup_entities(_line_entities(spark, sf), "e")
    return d.select("sid", F.array_join(F.transform("e", lambda x: F.concat(x["label"], x["normalized"], F.lit("@"), x["start"].cast("string"))), ",").alias("kept"))


@query(f"SELECT sid, count(CASE WHEN confidence >= 0.5 THEN 1 END) AS n FROM ({_LINE_ENTITIES}) GROUP BY 1")
def p18_confidence(spark, sf):
    return _line_entities(spark, sf).select("sid", F.size(P.above_confidence("e")).cast("long").alias("n"))


_PART_LABELS = "SELECT p_brand, p_type, arg_min(p_name, (CASE WHEN p_size < 10 THEN 0 ELSE 1 END, p_size % 3, p_partkey)) AS best_label, arg_max(p_name, (length(p_name), -p_partkey)) FILTER (WHERE p_size > 20) AS longest_label FROM part GROUP BY 1, 2"


@query(_PART_LABELS)
def j02_label_merge(spark, sf):
    p, keys = table(spark, sf, "part"), ["p_brand", "p_type"]
    best = A.best_label(p, keys, "p_name", F.when(F.col("p_size") < 10, 0).otherwise(1), F.col("p_size") % 3, "p_partkey")
    return best.join(A.longest_label(p, keys, "p_name", F.col("p_size") > 20, "p_partkey"), keys, "left")


@query("SELECT w.*, b.best_label FROM (SELECT p_brand, min(CASE WHEN p_size % 2 = 0 THEN p_name END) AS label_standard_none, min(CASE WHEN p_size % 2 = 1 THEN p_name END) AS label_terse_none FROM part GROUP BY 1) w LEFT JOIN (SELECT p_brand, arg_min(p_name, (p_size % 3, p_size % 5, p_partkey)) AS best_label FROM part GROUP BY 1) b ON w.p_brand = b.p_brand")
def j03_wide_best(spark, sf):
    p = table(spark, sf, "part").withColumns({"role": F.when(F.col("p_size") % 2 == 0, "standard").otherwise("terse"), "lang": F.lit(None).cast("string")})
    wide = A.pivot_labels(p, ["p_brand"], "role", "lang", "p_name", ["label_standard_none", "label_terse_none"])
    return wide.join(A.best_label(p, ["p_brand"], "p_name", F.col("p_size") % 3, F.col("p_size") % 5, "p_partkey"), ["p_brand"], "left")


@query(f"SELECT r.qid, r.doc, r.rank, d.lang FROM ({_SHOW} ({dense_sql('SELECT * FROM embeddings', 3)})) r LEFT JOIN documents d ON r.doc = d.doc_id")
def j05_j17_vectors_to_meta(spark, sf):
    hits = _show(_dense(_query_vectors(spark, sf), table(spark, sf, "embeddings"), 3)).select("qid", "doc", "rank")
    return hits.join(table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "lang"), "doc", "left").select("qid", "doc", "rank", "lang")


@query("SELECT n_nationkey, 'label' AS kind, 'us-gaap:' || n_name AS from_concept, CASE WHEN k = 0 THEN lower(n_name) ELSE 'the ' || lower(n_name) END AS text, ['en', 'de'][k + 1] AS lang, ['standard', 'terse'][k + 1] AS role FROM nation, (VALUES (0), (1)) v(k)")
def j08_label_arcs(spark, sf):
    ns, label = '<link:linkbase xmlns:link="http://l" xmlns:xlink="http://www.w3.org/1999/xlink"><link:labelLink xlink:role="r"><link:loc xlink:label="a" xlink:href="x.xsd#us-gaap_', '<link:label xlink:label="l" xml:lang="{}" xlink:role="http://www.xbrl.org/2003/role/{}">'
    x = F.concat(F.lit(ns), "n_name", F.lit('"/>'), F.lit(label.format("en", "label")), F.lower("n_name"), F.lit("</link:label>"), F.lit(label.format("de", "terseLabel")), F.lit("the "), F.lower("n_name"), F.lit('</link:label><link:labelArc xlink:from="a" xlink:to="l"/><link:labelArc xlink:from="unknown" xlink:to="l"/></link:labelLink></link:linkbase>'))
    arcs = Fx.xbrl_arcs(table(spark, sf, "nation").select("n_nationkey", x.alias("x")), "n_nationkey", "x")
    return arcs.select("n_nationkey", "kind", "from_concept", "text", "lang", X.short_role("role").alias("role"))


@query("SELECT n_nationkey, 'calculation' AS kind, 'us-gaap:' || n_name AS from_concept, 'us-gaap:Part' AS to_concept, -1.0 AS weight, CAST(n_regionkey AS DOUBLE) AS ord FROM nation UNION ALL SELECT n_nationkey, 'presentation', 'us-gaap:Part', 'us-gaap:' || n_name, NULL, 2.5 FROM nation")
def t11_linkbase_arcs(spark, sf):
    loc = F.concat(F.lit('<link:loc xlink:label="a" xlink:href="x.xsd#us-gaap_'), "n_name", F.lit('"/><link:loc xlink:label="b" xlink:href="x.xsd#us-gaap_Part"/>'))
    x = F.concat(
        F.lit('<linkbase xmlns:link="http://l" xmlns:xlink="http://www.w3.org/1999/xlink"><link:calculationLink xlink:role="r">'), loc, F.lit('<link:calculationArc xlink:from="a" xlink:to="b" xlink:arcrole="s" weight="-1" order="'), _s("n_regionkey"),
        F.lit('"/><link:calculationArc xlink:from="a" xlink:to="zz" order="2"/></link:calculationLink><link:presentationLink>'), loc, F.lit('<link:presentationArc xlink:from="b" xlink:to="a" order="2.5"/></link:presentationLink></linkbase>'),
    )
    return Fx.xbrl_arcs(table(spark, sf, "nation").select("n_nationkey", x.alias("x")), "n_nationkey", "x").select("n_nationkey", "kind", "from_concept", "to_concept", "weight", "ord")


@query("SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN d.lang ELSE 'x' || l.quality END AS lang, coalesce(l.toxic, -1) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def j18_fill_from_file(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang"), F.lit(None).cast("int").alias("toxic"))
    meta = table(spark, sf, "labels").select("doc_id", F.concat(F.lit("x"), _s("quality")).alias("lang"), "toxic")
    return J.fill_from(rows, meta, ["doc_id"], ["lang", "toxic"]).withColumn("toxic", F.coalesce("toxic", F.lit(-1)))


@query("SELECT o_custkey, o_orderpriority, last FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, min(o_orderkey)) AS rn FROM orders GROUP BY 1, 2) JOIN (SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders GROUP BY 1) USING (o_custkey) WHERE rn = 1")
def a05_modal_and_latest(spark, sf):
    o = table(spark, sf, "orders")
    last = o.groupBy("o_custkey").agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last"))
    return J.modal(o, ["o_custkey"], "o_orderpriority", "o_orderkey").join(last, "o_custkey")


@query("SELECT qid, v AS form FROM (SELECT o_custkey AS qid, lower(o_orderstatus) AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, min(rank)) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 20 GROUP BY 1, 2) WHERE rn = 1")
def a06_anchor_mode(spark, sf):
    h = table(spark, sf, "orders").select(F.col("o_custkey").alias("qid"), "o_orderkey", F.col("o_orderstatus").alias("form"), "o_totalprice")
    return Ev.anchors(Wn.ranked(h, ["qid"], [F.desc("o_totalprice"), "o_orderkey"]), ["qid"], "rank", "form")


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'fail' WHEN event_id % 2 = 0 THEN 'skip' ELSE 'ok' END AS status FROM events) GROUP BY 1")
def a17_stage_counters(spark, sf):
    e = table(spark, sf, "events").withColumn("status", F.when(F.col("event_type") == "error", "fail").when(F.col("event_id") % 2 == 0, "skip").otherwise("ok"))
    return A.counts_by(e, "status")


@query("SELECT o_orderkey, CASE WHEN max(v) OVER w > min(v) OVER w THEN (v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w) ELSE v END AS s FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 2 = 0 THEN 3.0 ELSE CAST(o_orderkey % 11 AS DOUBLE) END AS v FROM orders) WINDOW w AS (PARTITION BY o_custkey)")
def a18_min_max(spark, sf):
    o = table(spark, sf, "orders").withColumn("v", F.when(F.col("o_custkey") % 2 == 0, 3.0).otherwise((F.col("o_orderkey") % 11).cast("double")))
    return o.select("o_orderkey", S.normalised(["o_custkey"], "v", "minmax", None).alias("s"))


@query(f"SELECT (SELECT count(DISTINCT label || '::' || upper(name)) FROM ({_MENTIONS})) AS n_nodes, (SELECT count(*) FROM ({_EDGES})) AS n_edges")
def a30_graph_size(spark, sf):
    return E.graph_size(E.graph_nodes(_mentions(spark, sf)), _edges(spark, sf))


@query("SELECT o_orderkey, part, item, concat_ws(' / ', 'Part ' || part, 'Item ' || item) AS section_path FROM (SELECT o_orderkey, last_value(CASE WHEN o_orderkey % 5 = 0 THEN ['I', 'II', 'IV'][o_orderkey % 3 + 1] END IGNORE NULLS) OVER w AS part, last_value(CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0 THEN (o_orderkey % 9) || 'A' END IGNORE NULLS) OVER w AS item FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING))")
def w03_section_state(spark, sf):
    part = F.concat(F.lit(" Part "), F.element_at(F.array(*map(F.lit, ("i", "II", "iv"))), (F.col("o_orderkey") % 3 + 1).cast("int")), F.lit(". x"))
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, part).when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Item "), (F.col("o_orderkey") % 9).cast("string"), F.lit("a. Text"))).otherwise("body of the part").alias("t"))
    return Wn.section_path(rows, ["o_custkey"], ["o_orderkey"], "t").select("o_orderkey", "part", "item", "section_path")


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    """p_size units of 400 letters under one heading: nine fill a chunk."""
    line = F.concat(F.lpad(_s("p_partkey"), 9, "0"), F.repeat(F.lit("x"), 389), F.lit(" y"))
    rows = table(spark, sf, "part").select("p_partkey", F.posexplode(F.array_repeat(line, F.col("p_size"))).alias("line", "t")).withColumn("h", F.concat(F.lit("Heading "), _s("p_partkey")))
    return C.chunk_documents(rows, "p_partkey", "line", "h", "t")


@query("SELECT p_partkey AS doc, i AS chunk_index, CAST(ceil(p_size / 9.0) AS INT) AS chunk_count, p_partkey || '::text::chunk-' || i AS id, least(9, p_size - 9 * i) AS n_units FROM part, (SELECT unnest(range(0, 6)) AS i) WHERE i < ceil(p_size / 9.0)")
def w05_t12_t13_chunks(spark, sf):
    """Units in a chunk: its lines but for the heading and the words of the one before."""
    c = _packed(spark, sf)
    head = F.when(F.col("chunk_index") > 0, 2).otherwise(1)
    return c.select("doc", "chunk_index", "chunk_count", "id", (F.size(F.split("content", "\n")) - head).alias("n_units"))


@query("SELECT p_partkey, i AS chunk_index, CASE WHEN i > 0 THEN 18 ELSE 0 END AS overlap FROM part, (SELECT unnest(range(0, 6)) AS i) WHERE i < ceil(p_size / 9.0)")
def w05_overlap(spark, sf):
    """Words that a chunk repeats: the last 80 of the one before, here all of its 18."""
    c = _packed(spark, sf)
    return c.select(F.col("doc").alias("p_partkey"), "chunk_index", F.when(F.col("chunk_index") > 0, F.size(F.split(F.split("content", "\n")[1], " "))).otherwise(0).alias("overlap"))


@query(f"{_SHOW} ({dense_sql('SELECT * FROM embeddings WHERE label IN (1, 2)', 5)})")
def o02_dense_topk(spark, sf):
    """The filter comes before the best are chosen, so none is lost to it."""
    return _show(_dense(_query_vectors(spark, sf), table(spark, sf, "embeddings").where("label IN (1, 2)"), 5))


@query("SELECT o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, r) AS rank FROM (SELECT *, (o_orderkey % 17) * 1.0 / r AS score FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 12)) WHERE rank <= 3")
def o03_two_level_limit(spark, sf):
    first = Wn.ranked(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], "r").where("r <= 12")
    again = first.withColumn("score", F.col("o_orderkey") % 17 * 1.0 / F.col("r"))
    return Wn.top_k(again, ["o_custkey"], [F.desc("score"), "r"], 3).select("o_orderkey", F.col("rank").cast("long").alias("rank"))


@query("SELECT event_id FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 101 END AS doc_order, event_type FROM events) ORDER BY doc_order NULLS LAST, event_type, event_id LIMIT 500")
def o04_sql_order(spark, sf):
    e = table(spark, sf, "events").withColumn("doc_order", F.when(F.col("event_id") % 7 != 0, F.col("event_id") % 101))
    return e.orderBy(F.asc_nulls_last("doc_order"), "event_type", "event_id").limit(500).select("event_id")


@query(f"SELECT node, neighbor, weight FROM (SELECT *, row_number() OVER (ORDER BY weight DESC, neighbor) AS rn FROM (SELECT 'ORG::BRAND#1' AS node, CASE WHEN source = 'ORG::BRAND#1' THEN target ELSE source END AS neighbor, weight FROM ({_EDGES}) WHERE source = 'ORG::BRAND#1' OR target = 'ORG::BRAND#1')) WHERE rn <= 10")
def o08_neighbor_sort(spark, sf):
    n = E.neighbors(_edges(spark, sf), spark.createDataFrame([("ORG::BRAND#1",)], "node string"))
    return n.orderBy(F.desc("weight"), "neighbor").limit(10)


@query("SELECT p_partkey, concept, value, dims_signature, excerpt FROM (SELECT p_partkey, 'us-gaap:DebtTextBlock' AS concept, unnest(['2023', p_size || ',100']) AS value, 'extracted=textblock' AS dims_signature, 'In 2023 paid ' || p_size || ',100' AS excerpt FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'us-gaap:Debt', '<p>In 2023 paid ' || p_size || ',100</p>', '', NULL FROM part WHERE p_partkey % 2 = 1)")
def u02_t10_textblock_numbers(spark, sf):
    facts = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, "us-gaap:DebtTextBlock").otherwise("us-gaap:Debt").alias("concept"), F.concat(F.lit("<p>In 2023 paid "), _s("p_size"), F.lit(",100</p>")).alias("html"), F.lit("").alias("dims_signature"))
    return Fx.explode_textblocks(facts, "concept", "html", "dims_signature").select("p_partkey", "concept", "value", "dims_signature", "excerpt")


@query(f"WITH RECURSIVE e AS ({_NATION_EDGES}), b AS (SELECT source AS x, target AS y FROM e UNION ALL SELECT target, source FROM e), s(node, d) AS (SELECT r_name, 0 FROM region WHERE r_regionkey = 1 UNION SELECT b.y, s.d + 1 FROM s JOIN b ON s.node = b.x WHERE s.d < 2) SELECT node FROM s GROUP BY node HAVING min(d) = 2")
def u05_v04_frontier(spark, sf):
    """Nodes that are two steps away and not nearer."""
    n, r, s = (table(spark, sf, t) for t in ("nation", "region", "supplier"))
    edges = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("source"), F.col("r_name").alias("target")).unionByName(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("source"), F.col("n_name").alias("target"))).withColumn("weight", F.lit(1))
    start = r.where("r_regionkey = 1").select(F.col("r_name").alias("node"))
    return E.subgraph(edges, start, 2)[0].join(E.subgraph(edges, start, 1)[0], "node", "left_anti")


@query("SELECT p_partkey, x.value, x.value_num, x.unit, x.excerpt FROM (SELECT p_partkey, unnest([{'value': '$' || p_size || ',100', 'value_num': p_size * 1000.0 + 100, 'unit': '$', 'excerpt': 'Cash of ' || p_brand[1:5] || ' $' || p_size || ',100'}, {'value': '5%', 'value_num': 0.05, 'unit': '%', 'excerpt': 'Rate & p 5% (3)'}, {'value': '(3)', 'value_num': -3.0, 'unit': NULL, 'excerpt': 'Rate & p 5% (3)'}, {'value': '9', 'value_num': 9.0, 'unit': NULL, 'excerpt': repeat('x ', 128) || '…'}]) AS x FROM part WHERE p_size % 3 = 0 UNION ALL SELECT p_partkey, unnest([{'value': '2023', 'value_num': 2023.0, 'unit': NULL, 'excerpt': 'In 2023'}, {'value': CAST(p_size AS VARCHAR), 'value_num': CAST(p_size AS DOUBLE), 'unit': NULL, 'excerpt': 'paid ' || p_size}]) FROM part WHERE p_size % 3 = 1)")
def t10_table_rows(spark, sf):
    """Numbers of text blocks by table row, by line where there are no rows, none where there is no markup."""
    rows = F.concat(F.lit("<p>no 77</p><table><tr><td>Cash of "), F.substring("p_brand", 1, 5), F.lit("</td><td>&#160;$"), _s("p_size"), F.lit(",100</td></tr><tr><th>Rate &amp; <b>p</b><td> 5%\n<td>(3)<tr><td></td></tr><tr><td>"), F.repeat(F.lit("x "), 150), F.lit("9</td></tr></table>"))
    lines = F.concat(F.lit("<p>In 2023</p><p>paid\t"), _s("p_size"), F.lit("</p>"))
    html = F.when(F.col("p_size") % 3 == 0, rows).when(F.col("p_size") % 3 == 1, lines).otherwise(F.concat(F.lit("plain "), _s("p_size")))
    facts = table(spark, sf, "part").select("p_partkey", F.lit("x:DebtTextblock").alias("concept"), html.alias("html"), F.lit("").alias("dims_signature"))
    return Fx.explode_textblocks(facts, "concept", "html", "dims_signature").select("p_partkey", "value", "value_num", "unit", "excerpt")


@query("SELECT p_partkey AS doc, b.ord, b.tag, b.text, b.heading, b.item, b.section FROM (SELECT p_partkey, unnest([{'ord': 0, 'tag': 'h1', 'text': 'Part II of ' || p_name, 'heading': 'Part II of ' || p_name, 'item': NULL, 'section': 'Part II / Part II of ' || p_name}, {'ord': 1, 'tag': 'p', 'text': 'Item ' || p_size || '. Sales & costs', 'heading': 'Item ' || p_size || '. Sales & costs', 'item': CAST(p_size AS VARCHAR), 'section': 'Part II / Item ' || p_size || ' / Item ' || p_size || '. Sales & costs'}, {'ord': 2, 'tag': 'li', 'text': p_brand || ' in a list', 'heading': 'Item ' || p_size || '. Sales & costs', 'item': CAST(p_size AS VARCHAR), 'section': 'Part II / Item ' || p_size || ' / Item ' || p_size || '. Sales & costs'}, {'ord': 3, 'tag': 'div', 'text': 'bold ' || p_type, 'heading': 'bold ' || p_type, 'item': CAST(p_size AS VARCHAR), 'section': 'Part II / Item ' || p_size || ' / bold ' || p_type}]) AS b FROM part)")
def t01_f10_blocks(spark, sf):
    h = F.concat(F.lit("<html><body><script>var x = 1;</script><h1>Part II of "), "p_name", F.lit("</h1><div><p>Item "), _s("p_size"), F.lit(". Sales &amp; costs<p>ab<ul><li>"), "p_brand", F.lit(" in\n a list<li>"), "p_brand", F.lit(" in a list</ul></div><div><b>bold "), "p_type", F.lit("</b></div></body></html>"))
    return Hb.html_blocks(table(spark, sf, "part").select("p_partkey", h.alias("h")), "p_partkey", "h").select("doc", "ord", "tag", "text", "heading", "item", "section")


_GRID = "[['Item', '2023 Q4', '2024 Q4'], ['Cash', '1,000', CAST(page_id AS VARCHAR)], ['Debt', '(5)', '7%']]"
_CELLS = f"SELECT page_id AS doc, 0 AS \"table\", r AS row, c AS col, ({_GRID})[r + 1][c + 1] AS text FROM pages, (SELECT unnest([0, 1, 2]) AS r), (SELECT unnest([0, 1, 2]) AS c)"


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    made = F.concat(F.lit("<table><tr><th>Item</th><th>2023 Q4</th><th>2024 Q4</th></tr><tr><td>Cash<td>1,000<td>"), _s("page_id"), F.lit("<tr><td>Debt</td><td>(5)</td><td>7%</td></tr></table>"))
    return Hb.table_cells(table(spark, sf, "pages").select("page_id", F.concat("html", made).alias("html")), "page_id", "html")


@query(_CELLS)
def t08_table_cells(spark, sf):
    return _cells(spark, sf)


@query("SELECT page_id AS doc, 0 AS \"table\", unnest([0, 1, 2]) AS col, unnest(['account', 'period', 'period']) AS kind FROM pages")
def t09_a28_columns(spark, sf):
    return Hb.compact_columns(_cells(spark, sf))


@query("SELECT page_id AS doc, unnest([0, 0, 0, 1, 1]) AS \"table\", unnest([0, 2, 3, 1, 2]) AS col, unnest(['account', 'period', 'period', 'account', 'period']) AS kind FROM pages")
def t09_fallback_columns(spark, sf):
    """A table without period columns, which takes its last two, and one whose column of numbers has empty cells."""
    plain = "<table><tr><th>Name of it<th>a<th>b<th>c<tr><td>cash held<td>u v<td>w<td>x<tr><td>debt held<td>y z<td>v<td>w</table>"
    made = F.concat(F.lit(plain + "<table><tr><td>n<td>Account<td>Sum<tr><td>-<td>Cash at "), _s("page_id"), F.lit("<td>5<tr><td>-<td>Debt<td>(7)<tr><td>1<td>Rest<td></table>"))
    return Hb.compact_columns(Hb.table_cells(table(spark, sf, "pages").select("page_id", made.alias("html")), "page_id", "html"))


@query("SELECT page_id AS doc, 0 AS \"table\", '| Item | 2023 Q4 |' || chr(10) || '| Cash | 1,000 |' AS markdown FROM pages")
def s31_o06_markdown(spark, sf):
    return Hb.markdown_table(_cells(spark, sf), max_rows=2, max_cols=2)


@query("SELECT p_partkey, 'us-gaap:Assets' AS qname, CAST(p_size AS DOUBLE) AS value_num, 'USD' AS unit_normalized, 'a:Axis=' || p_brand AS dims_signature, 'balance' AS statement_hint, 'FY2024 2024-12-31' AS period_label, 'us-gaap:Assets: ' || p_size || ' (FY2024 2024-12-31; TCK 10-K accno=' || p_partkey || ')' AS rag_text FROM part UNION ALL SELECT p_partkey, 'us-gaap:SalesRatePercent', p_size / 100.0, '%', '', 'other', 'FY2023 2023-01-01 — 2023-12-31', 'us-gaap:SalesRatePercent: ' || CASE WHEN p_size % 10 = 0 THEN format('{:.1f}', p_size / 100.0) ELSE format('{:.2f}', p_size / 100.0) END || ' (FY2023 2023-01-01 — 2023-12-31; TCK 10-K accno=' || p_partkey || ')' FROM part")
def t14_t15_s21_instance(spark, sf):
    x = F.concat(
        F.lit('<xbrl xmlns:us-gaap="http://g" xmlns:xbrldi="http://d" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"><context id="c1"><entity><identifier>9</identifier><segment><xbrldi:explicitMember dimension="a:Axis">'), "p_brand", F.lit('</xbrldi:explicitMember></segment></entity><period><instant>2024-12-31</instant></period></context><context id="c2"><entity><identifier>9</identifier></entity><period><startDate>2023-01-01</startDate><endDate>2023-12-31</endDate></period></context><unit id="u"><measure>iso4217:USD</measure></unit><us-gaap:Assets contextRef="c1" unitRef="u" decimals="-3">'),
        _s("p_size"), F.lit('</us-gaap:Assets><us-gaap:Debt contextRef="c2" xsi:nil="true"/><us-gaap:SalesRatePercent contextRef="c2">'), _s("p_size"), F.lit("%</us-gaap:SalesRatePercent></xbrl>"),
    )
    facts = Fx.xbrl_facts(table(spark, sf, "part").select("p_partkey", x.alias("xml")), "p_partkey", "xml")
    clean = Fx.clean_facts(facts, F.lit("TCK"), F.lit("10-K"), _s("p_partkey"), F.lit(2022))
    return clean.select("p_partkey", "qname", "value_num", "unit_normalized", "dims_signature", "statement_hint", "period_label", "rag_text")


@query("SELECT p_partkey AS id, ['no text', 'empty', 'no element', 'not well-formed', 'not well-formed'][p_size % 7 + 1] AS error FROM part WHERE p_size % 7 < 5")
def s21_unreadable(spark, sf):
    """Files that are no XML, by the kind of what is wrong with them."""
    bad = F.array(F.lit(None).cast("string"), F.lit(" "), F.col("p_name"), F.concat(F.lit("<a>"), "p_name"), F.concat(F.lit("<a><b>"), "p_name", F.lit("</a></b>")), F.concat(F.lit("<a>"), "p_name", F.lit("</a>")), F.concat(F.lit("<p:a xmlns:p='u' q='"), "p_brand", F.lit("'/>")))
    files = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.get(bad, F.col("p_size") % 7).alias("xml"))
    return Xml.unreadable(files, "id", "xml").select("id", "error")


_BLOCKED = ", ".join(f"'{w}'" for w in E.TICKER_BLOCKLIST)


def _filing(spark: SparkSession, sf: str) -> DataFrame:
    t = F.concat(F.lit("Contoso "), F.translate("p_type", "", ""), F.lit(" Holdings Inc. ("), F.upper(F.substring("p_name", 1, 3)), F.lit(") raised EBITDA and EPS, not EBITDA, to $"), _s("p_size"), F.lit(" million. Ticker: ABCD; symbol abcd"))
    return table(spark, sf, "part").select("p_partkey", t.alias("text"))


@query(f"SELECT p_partkey, CASE WHEN upper(substr(p_name, 1, 3)) NOT IN ({_BLOCKED}, 'ABCD') THEN upper(substr(p_name, 1, 3)) || '@' || (24 + length(p_type)) || ',' ELSE '' END || 'ABCD@' || (86 + length(p_type) + length(CAST(p_size AS VARCHAR))) AS tickers FROM part")
def t16_ticker_spans(spark, sf):
    t = _filing(spark, sf).select("p_partkey", E.tickers("text").alias("e"))
    return t.select("p_partkey", F.array_join(F.transform("e", lambda x: F.concat(x["text"], F.lit("@"), x["start"].cast("string"))), ",").alias("tickers"))


@query("SELECT p_partkey, 'EBITDA@' || (36 + length(p_type)) || ',EPS@' || (47 + length(p_type)) AS metrics FROM part")
def t17_metric_spans(spark, sf):
    t = _filing(spark, sf).select("p_partkey", E.fin_metrics("text").alias("e"))
    return t.select("p_partkey", F.array_join(F.transform("e", lambda x: F.concat(x["text"], F.lit("@"), x["start"].cast("string"))), ",").alias("metrics"))


@query(f"SELECT p_partkey, 'ORG|CONTOSO ' || p_type || ' HOLDINGS,' || CASE WHEN upper(substr(p_name, 1, 3)) NOT IN ({_BLOCKED}) THEN 'TICKER|' || upper(substr(p_name, 1, 3)) || ',' ELSE '' END || 'FIN_METRIC|EBITDA,FIN_METRIC|EPS,TICKER|ABCD' AS entities, 'FIN_METRIC,ORG,TICKER' AS labels FROM part")
def t18_t20_u03_v01_entities(spark, sf):
    e = E.extract_entities(_filing(spark, sf), "text")
    return e.select("p_partkey", F.array_join(F.transform("entities", lambda x: F.concat_ws("|", x["label"], x["normalized"])), ",").alias("entities"), F.array_join("entity_labels", ",").alias("labels"))


@query("SELECT p_partkey, t.target, t.kind FROM part, (VALUES ('revenue', 'numeric'), ('outlook', 'text')) t(target, kind)")
def t24_targets(spark, sf):
    targets = Fx.extraction_targets(spark, {"extraction_targets": ["revenue", {"name": "outlook", "type": "text"}]})
    return J.match_vocabulary(table(spark, sf, "part").select("p_partkey"), targets.select("target", "kind"), F.lit(True))


@query("SELECT doc_id, start, \"end\", md5(array_to_string(list_slice(w, start + 1, \"end\"), ' ')) AS m FROM (SELECT doc_id, w, i * 780 AS start, least(len(w), i * 780 + 900) AS \"end\" FROM (SELECT doc_id, w, unnest(range(0, CAST(greatest(0, ceil((len(w) - 900) / 780.0)) AS BIGINT) + 1)) AS i FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '') AS w FROM documents) WHERE len(w) > 0))")
def t07_token_chunks(spark, sf):
    w = table(spark, sf, "documents").select("doc_id", F.explode(X.token_windows("text")).alias("w"))
    return w.select("doc_id", F.col("w.start").cast("long").alias("start"), F.col("w.end").cast("long").alias("end"), F.md5("w.text").alias("m"))


@query("SELECT doc_id, len(list_filter(flatten(list_transform(list_filter(list_transform(string_split(replace(text, chr(13), ''), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> ''), lambda x: CASE WHEN regexp_matches(x, '^\\s*(?:[•\\-–—]|\\(\\s*(?:[ivxlcdm]+|\\d+|[a-zA-Z])\\s*\\)|(?:\\d+\\.|[a-zA-Z]\\.))\\s+') THEN [x] ELSE string_split(regexp_replace(x, '([.?!。！？;:—–])\\s+', '\\1' || chr(10), 'g'), chr(10)) END)), lambda y: trim(y, ' ') <> '')) AS n_units FROM documents")
def t05_split_units(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(X.split_units("text")).cast("long").alias("n_units"))


_CUT = "CASE WHEN length(s) <= 2000 THEN length(s) WHEN length(regexp_extract(substr(s, 1, 2001), '(?s)^(.*[.?!]\\s+)\\S', 1)) >= 1200 THEN length(regexp_extract(substr(s, 1, 2001), '(?s)^(.*[.?!]\\s+)\\S', 1)) ELSE 2800 END"
_STRIP = "regexp_replace(regexp_replace({0}, '^\\s+', ''), '\\s+$', '')"


@query(f"WITH RECURSIVE c(doc_id, pos, piece, s) AS (SELECT doc_id, -1, '', text FROM documents UNION ALL SELECT doc_id, pos + 1, {_STRIP.format('substr(s, 1, n)')}, {_STRIP.format('substr(s, n + 1)')} FROM (SELECT *, {_CUT} AS n FROM c WHERE s <> '')) SELECT doc_id, count(*) AS n_pieces, max(length(piece)) AS longest, sum(length(piece)) AS letters FROM c WHERE piece <> '' GROUP BY 1")
def t03_long_text(spark, sf):
    p = table(spark, sf, "documents").select("doc_id", F.explode(C.long_pieces("text")).alias("p"))
    return p.groupBy("doc_id").agg(F.count("*").alias("n_pieces"), F.max(F.length("p")).cast("long").alias("longest"), F.sum(F.length("p")).alias("letters"))


@query("SELECT p_partkey AS doc, 0 AS line, i AS sentence_no, [p_name || ' costs $' || p_size || '.5 million in all.', 'It is ' || p_size || '% more than before.'][i + 1] AS text, [[(p_size + 0.5) * 1e6], [CAST(p_size AS DOUBLE)]][i + 1] AS numbers, [[], [p_size / 100.0]][i + 1] AS percents, ['USD', ''][i + 1] AS currencies FROM part, (VALUES (0), (1)) v(i) WHERE p_size > 0")
def t04_sentence_rows(spark, sf):
    t = F.concat("p_name", F.lit("&nbsp;costs $"), _s("p_size"), F.lit(".5 million  in all. It is "), _s("p_size"), F.lit("% more than before."))
    rows = C.clean_rows(table(spark, sf, "part").where("p_size > 0").select(F.col("p_partkey").alias("d"), F.lit(0).alias("l"), t.alias("t")), "d", "l", "t")
    return rows.select("doc", "line", "sentence_no", "text", "numbers", "percents", F.array_join("currencies", ",").alias("currencies"))


@query("SELECT p_partkey || '::text::chunk-0' AS id, 'Untitled' AS title, sha256(p_name || ' of the brand ' || p_brand) AS text_hash, p_name || ' of the brand ' || p_brand AS snippet, 1 AS n FROM part")
def r02_s26_index_rows(spark, sf):
    lines = table(spark, sf, "part").select("p_partkey", F.lit(0).alias("line"), F.lit(None).cast("string").alias("h"), F.concat("p_name", F.lit(" of the brand "), "p_brand").alias("t"))
    chunks = C.chunk_documents(lines, "p_partkey", "line", "h", "t")
    index = runner.build_index(chunks.unionByName(chunks))  # each id twice: one stays
    return index.groupBy("id", "title", "text_hash", "snippet").agg(F.count("*").cast("int").alias("n"))


_LEN, _ES = "length(text)", "(length(text) - length(replace(text, 'e', '')))"


@query(f"SELECT doc_id, list_transform([{_LEN}, {_ES}, 1], lambda x: round(x / sqrt({_LEN} * {_LEN} + {_ES} * {_ES} + 1.0), 4)) AS v FROM documents")
def r01_embed_texts(spark, sf):
    """With an encoder that is passed in, of unit length; it sees texts in batches."""
    import numpy as np

    def encoder(texts: list[str], size: int) -> np.ndarray:
        v = np.array([[len(t), t.count("e"), 1.0] for t in texts]).reshape(-1, size)
        return v / np.sqrt((v * v).sum(axis=1, keepdims=True))

    d = S.embed_texts(table(spark, sf, "documents"), "text", 3, encoder, T.DoubleType())
    return d.select("doc_id", F.transform("embedding", lambda x: F.round(x, 4)).alias("v"))


@query("SELECT p_partkey, round(1 / (1 + exp(length(p_name) - length(p_brand))), 9) AS ce FROM part")
def r07_cross_encoder(spark, sf):
    import numpy as np

    score = S.cross_encoder(lambda pairs: np.array([[float(len(q)), float(len(t))] for q, t in pairs]))
    return table(spark, sf, "part").select("p_partkey", F.round(score("p_name", "p_brand"), 9).alias("ce"))


@query(f"SELECT p_partkey, CASE WHEN upper(substr(p_name, 1, 4)) NOT IN ({_BLOCKED}) AND regexp_full_match(upper(substr(p_name, 1, 4)), '[A-Z]{{1,5}}') THEN upper(substr(p_name, 1, 4)) ELSE '' END AS tickers, 'EPS,ROE' AS fin_metrics, 'ACME ' || p_type AS orgs FROM part")
def r12_question_entities(spark, sf):
    q = F.concat(F.lit("EPS and ROE of Acme "), "p_type", F.lit(" Ltd. ("), F.upper(F.substring("p_name", 1, 4)), F.lit(")"))
    e = runner.query_entities(table(spark, sf, "part").select("p_partkey", q.alias("q")), "p_partkey", "q")
    return e.select("p_partkey", F.array_join("tickers", ",").alias("tickers"), F.array_join("fin_metrics", ",").alias("fin_metrics"), F.array_join("orgs", ",").alias("orgs"))


@query(f"SELECT o_orderkey, array_to_string(regexp_extract_all('Margin in Q' || (1 + o_orderkey % 4) || ' of fiscal ' || year(o_orderdate) || ', on ' || strftime(o_orderdate, '%Y-%m-%d') || ' and since March 5, 2019, not 1850 or 20231', '{runner.DATE}'), ';') AS dates FROM orders")
def r12_question_dates(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    q = F.concat(F.lit("Margin in Q"), (1 + F.col("o_orderkey") % 4).cast("string"), F.lit(" of fiscal "), F.substring(day, 1, 4), F.lit(", on "), day, F.lit(" and since March 5, 2019, not 1850 or 20231"))
    return table(spark, sf, "orders").select("o_orderkey", q.alias("q")).select("o_orderkey", F.array_join(runner.dates("q"), ";").alias("dates"))


def _equal_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of 100 tokens each with the same words, so that only the score decides."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("id"), F.lit("one").alias("heading"), F.repeat(F.lit("word"), 100).alias("content"), (F.col("o_totalprice") * 1.0).alias("score"))
    return o


@query("SELECT qid, pos, id FROM (SELECT o_custkey AS qid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) - 1 AS pos, o_orderkey AS id FROM orders) WHERE pos < 4")
def r16_r17_packing(spark, sf):
    """Four of a hundred tokens fit into 450."""
    return Ev.pack_evidence(_equal_hits(spark, sf), "qid", budget=450, k=8).select("qid", F.col("pos").cast("long").alias("pos"), "id")


@query("SELECT qid, string_agg('[' || id || ']' || chr(10) || repeat('word', 100), chr(10) || chr(10) ORDER BY pos) AS block FROM (SELECT o_custkey AS qid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) - 1 AS pos, o_orderkey AS id FROM orders) WHERE pos < 4 GROUP BY 1")
def r18_evidence_text(spark, sf):
    return Ev.evidence_block(Ev.pack_evidence(_equal_hits(spark, sf), "qid", budget=450, k=8), "qid")


@query("SELECT doc_id AS id, CASE WHEN length(trim(text, ' ')) > 240 THEN substr(trim(text, ' '), 1, 240) || ' ...' ELSE trim(text, ' ') END AS quote FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0) AND trim(text, ' ') <> ''")
def r19_citation_guard(spark, sf):
    cites = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("quote"))
    return runner.guarded_citations(cites, table(spark, sf, "labels").where("toxic = 0").select(F.col("doc_id").alias("id")))


@query("SELECT p_partkey, p_size || '. [' || format('{:.4f}', p_retailprice / 8) || '] ' || p_partkey || CASE WHEN p_size % 2 = 0 THEN ' | ' || p_brand ELSE '' END || ' | ' || p_name AS line FROM part")
def r21_printed_hits(spark, sf):
    p = table(spark, sf, "part").withColumns({"score": F.col("p_retailprice") / 8, "h": F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" "), "p_brand"))})
    return S.format_hits(p, "p_size", "score", "p_partkey", "h", "p_name").select("p_partkey", "line")


@query(f"SELECT node_id, mention_count FROM (SELECT label || '::' || upper(name) AS node_id, count(*) AS mention_count, list(DISTINCT y) AS years FROM ({_MENTIONS}) WHERE label = 'GPE' GROUP BY 1) WHERE list_contains(years, 1996) ORDER BY mention_count DESC, node_id LIMIT 20")
def v02_entity_search(spark, sf):
    return P.search_entities(E.graph_nodes(_mentions(spark, sf)), label="GPE", year=1996).select("node_id", "mention_count")


@query(f"SELECT label, sum(n)::BIGINT AS total, string_agg(y || ':' || n, ',' ORDER BY y) AS entries FROM (SELECT label, y, count(*) AS n FROM ({_MENTIONS}) WHERE upper(name) = 'BRAND#7' GROUP BY 1, 2) GROUP BY 1")
def v03_timeline(spark, sf):
    t = E.find_timeline(E.timeline_totals(E.timeline(_mentions(spark, sf), "sid")), " brand#7 ")
    return t.select("label", "total", F.array_join(F.transform("entries", lambda e: F.concat_ws(":", e["year"].cast("string"), e["mentions"].cast("string"))), ",").alias("entries"))


@query("SELECT p_partkey AS doc, i AS line, ['Item ' || p_size || '. Sales', p_name || ' grew by ' || p_size || ' percent in the year'][i + 1] AS text FROM part, (VALUES (0), (1)) v(i)")
def v06_s33_stages(spark, sf):
    """The stages by their names; unknown ones are refused before anything runs."""
    h = F.concat(F.lit("<h2>Item "), _s("p_size"), F.lit(". Sales</h2><p>"), "p_name", F.lit(" grew by "), _s("p_size"), F.lit(" percent in the year</p>"))
    return runner.run(table(spark, sf, "part").select(F.col("p_partkey").alias("page_id"), h.alias("html")), "parse").select("doc", "line", "text")


@query("SELECT p_partkey AS qid, 1 AS rank, 'd' || p_partkey || '::text::chunk-0' AS doc FROM part")
def v08_v12_r20_questions(spark, sf):
    """Each question names the one document that has its number."""
    word = F.concat(F.lit("number"), _s("p_partkey"), F.lit("x"))
    p = table(spark, sf, "part")
    lines = p.select(F.concat(F.lit("d"), _s("p_partkey")).alias("doc"), F.lit(0).alias("line"), F.lit(None).cast("string").alias("h"), F.concat(F.lit("a plain text about "), word).alias("t"))
    index = runner.build_index(C.chunk_documents(lines, "doc", "line", "h", "t"))
    hits = runner.search_index(index, p.select(F.col("p_partkey").alias("qid"), F.concat(F.lit("what about "), word).alias("query")), k=1)
    return hits.select("qid", "rank", "doc")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size * 1000.0 END AS answer, 'FY' || p_size AS year_of FROM part WHERE p_size % 2 = 0")
def r22_answers_with_scale(spark, sf):
    line = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Revenue: "), _s("p_size"), F.lit(" K | Unit=USD"))).otherwise("none")
    found = Fx.numeric_answers(table(spark, sf, "part").select("p_partkey", "p_size", line.alias("line")), "line", r"^Revenue: ([\d.,]+ ?[KMBT]?)")
    return found.select("p_partkey", "answer", F.concat(F.lit("FY"), _s("p_size")).alias("year_of"))
