"""Queries of taxonomies and concept networks, over files that are made from the tables row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import search as S
from siltstone.operators import taxonomy as Tx
from siltstone.operators import xml_files as Xml
from siltstone.plans.catalogue import query
from siltstone.plans.table_queries import table


def _text(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _files(spark: SparkSession, sf: str) -> DataFrame:
    """An instance for each supplier, a schema for each nation with a linkbase that is not there, one for each region; regions import each other in a ring."""
    supplier, nation, region = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    instance = _text('<xbrl xmlns="http://i" xmlns:link="http://l" xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:n="http://n" xmlns:r="http://r"><link:schemaRef xlink:href="../nation/', F.col("s_nationkey"), '.xsd#all"/><context id="c"><entity><identifier>', F.col("s_suppkey"), '</identifier></entity></context><n:Balance contextRef="c">', F.col("s_acctbal"), '</n:Balance><r:Size contextRef="c">1</r:Size><r:Other contextRef="c">2</r:Other></xbrl>')
    of_nation = _text('<schema xmlns:link="http://l" xmlns:xlink="http://www.w3.org/1999/xlink"><annotation><appinfo><link:linkbaseRef xlink:href="labels/', F.col("n_nationkey"), '.xml"/></appinfo></annotation><import schemaLocation="./../region/', F.col("n_regionkey"), '.xsd"/><element id="n_Balance" name="Balance" type="monetary', F.col("n_nationkey"), '" periodType="instant" balance="debit"/></schema>')
    of_region = _text('<schema><include schemaLocation="', (F.col("r_regionkey") + 1) % 5, '.xsd"/><element id="r_Size" type="shares', F.col("r_regionkey"), '" periodType="duration"/><element name="Other"/></schema>')
    made = [(supplier, "supplier/", "s_suppkey", ".xml", instance), (nation, "nation/", "n_nationkey", ".xsd", of_nation), (region, "region/", "r_regionkey", ".xsd", of_region)]
    one, two, three = (t.select(_text("/t/", folder, F.col(key), end).alias("file"), xml.alias("xml")) for t, folder, key, end, xml in made)
    return one.unionByName(two).unionByName(three)


_LINKS = (
    "SELECT '/t/supplier/' || s_suppkey || '.xml' AS source, '/t/nation/' || s_nationkey || '.xsd' AS target, 'schemaRef' AS kind FROM supplier UNION ALL SELECT '/t/nation/' || n_nationkey || '.xsd', '/t/nation/labels/' || n_nationkey || '.xml', 'linkbaseRef' FROM nation"
    " UNION ALL SELECT '/t/nation/' || n_nationkey || '.xsd', '/t/region/' || n_regionkey || '.xsd', 'import' FROM nation UNION ALL SELECT '/t/region/' || r_regionkey || '.xsd', '/t/region/' || ((r_regionkey + 1) % 5) || '.xsd', 'include' FROM region"
)


@query(_LINKS)
def s21_references(spark, sf):
    return Tx.references(_files(spark, sf), "file", "xml")


@query(f"WITH RECURSIVE l AS ({_LINKS}), w(entry, file, depth) AS (SELECT '/t/supplier/' || s_suppkey || '.xml', '/t/supplier/' || s_suppkey || '.xml', 0 FROM supplier UNION SELECT w.entry, l.target, w.depth + 1 FROM w JOIN l ON w.file = l.source WHERE w.depth < 10) SELECT entry, file, min(depth) AS depth FROM w GROUP BY 1, 2")
def s21_reach(spark, sf):
    files = _files(spark, sf)
    return Tx.reach(Tx.references(files, "file", "xml"), files.where("file LIKE '/t/supplier/%'"))


@query(
    "SELECT '/t/supplier/' || s_suppkey || '.xml' AS file, f.qname, CASE f.qname WHEN 'n:Balance' THEN 'monetary' || s_nationkey WHEN 'r:Size' THEN 'shares' || n_regionkey END AS declared_type, CASE f.qname WHEN 'n:Balance' THEN 'instant' WHEN 'r:Size' THEN 'duration' END AS declared_period, CASE f.qname WHEN 'n:Balance' THEN 'debit' END AS declared_balance"
    " FROM supplier JOIN nation ON s_nationkey = n_nationkey, (VALUES ('n:Balance'), ('r:Size'), ('r:Other')) f(qname)"
)
def s21_declared_facts(spark, sf):
    """Facts with the type of the nearest declaration that their filing reaches."""
    files = _files(spark, sf)
    reached = Tx.reach(Tx.references(files, "file", "xml"), files.where("file LIKE '/t/supplier/%'"))
    facts = Tx.with_declared(Xml.facts(files, "file", "xml"), "file", "qname", reached, Tx.concepts(files, "file", "xml"))
    return facts.select("file", "qname", "declared_type", "declared_period", "declared_balance")


def _arcs(spark: SparkSession, sf: str) -> DataFrame:
    """Presentation: regions over nations over suppliers; a calculation network over nations turns that round."""
    ns = '<link:linkbase xmlns:link="http://l" xmlns:xlink="http://www.w3.org/1999/xlink">'
    loc = lambda label, name: _text(f'<link:loc xlink:label="{label}" xlink:href="t.xsd#t_', name, '"/>')
    nation = F.regexp_replace("n_name", " ", "")
    up = _text(ns, '<link:presentationLink xlink:role="p">', loc("a", _text("R", F.col("n_regionkey"))), loc("b", nation), '<link:presentationArc xlink:from="a" xlink:to="b"/></link:presentationLink><link:calculationLink xlink:role="c">', loc("a", _text("R", F.col("n_regionkey"))), loc("b", nation), '<link:calculationArc xlink:from="b" xlink:to="a" weight="1"/></link:calculationLink></link:linkbase>')
    down = _text(ns, '<link:presentationLink xlink:role="p">', loc("a", nation), loc("b", _text("S", F.col("s_suppkey"))), '<link:presentationArc xlink:from="a" xlink:to="b"/></link:presentationLink></link:linkbase>')
    n, s = table(spark, sf, "nation"), table(spark, sf, "supplier")
    files = n.select(_text("n", F.col("n_nationkey")).alias("file"), up.alias("xml")).unionByName(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(_text("s", F.col("s_suppkey")).alias("file"), down.alias("xml")))
    return Xml.arcs(files, "file", "xml")


_NET = "SELECT 'p' AS net, 't:R' || n_regionkey AS above, 't:' || replace(n_name, ' ', '') AS below FROM nation UNION SELECT 'c', 't:' || replace(n_name, ' ', ''), 't:R' || n_regionkey FROM nation UNION SELECT 'p', 't:' || replace(n_name, ' ', ''), 't:S' || s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey"
_AROUND = (
    f"WITH RECURSIVE l AS ({_NET}), st AS (SELECT 't:R' || r_regionkey AS concept FROM region UNION SELECT 't:' || replace(n_name, ' ', '') FROM nation), d(concept, net, related, distance) AS (SELECT concept, net, below, 1 FROM st JOIN l ON concept = above UNION SELECT d.concept, d.net, l.below, 2 FROM d JOIN l ON d.net = l.net AND d.related = l.above WHERE distance = 1),"
    " u(concept, net, related, distance) AS (SELECT concept, net, above, 1 FROM st JOIN l ON concept = below UNION SELECT u.concept, u.net, l.above, 2 FROM u JOIN l ON u.net = l.net AND u.related = l.below WHERE distance = 1),"
    " sib AS (SELECT st.concept, b.below AS related FROM st JOIN l a ON st.concept = a.below JOIN l b ON a.net = b.net AND a.above = b.above), every AS (SELECT concept, 'child' AS relation, related, distance FROM d UNION ALL SELECT concept, 'parent', related, distance FROM u UNION ALL SELECT concept, 'sibling', related, 1 FROM sib)"
    " SELECT concept, relation, related, min(distance) AS distance FROM every WHERE concept <> related GROUP BY 1, 2, 3"
)


def _around(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(_text("t:", F.regexp_replace("n_name", " ", "")).alias("concept"))
    return Tx.neighbourhood(_arcs(spark, sf), table(spark, sf, "region").select(_text("t:R", F.col("r_regionkey")).alias("concept")).unionByName(nation), 2)


@query(_AROUND)
def r10_neighbourhood(spark, sf):
    """Children and parents up to two steps away and siblings of all regions and nations, from the arcs of linkbases."""
    return _around(spark, sf)


_SURFACE_OF = "SELECT 't:R' || r_regionkey AS concept, lower(r_name) AS surface FROM region UNION ALL SELECT 't:' || replace(n_name, ' ', ''), lower(n_name) FROM nation"


@query(f"WITH a AS ({_AROUND}), s AS ({_SURFACE_OF}), h AS (SELECT c_custkey AS qid, s.concept FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN s ON contains(lower('sales in ' || n_name || ' of 2023'), s.surface)), c AS (SELECT qid, concept FROM h UNION SELECT qid, related FROM h JOIN a ON h.concept = a.concept WHERE relation IN ('child', 'parent', 'sibling') AND distance = 1), t AS (SELECT qid, surface AS term FROM c JOIN s ON c.concept = s.concept UNION SELECT c_custkey, '2023' FROM customer) SELECT qid, string_agg(term, ',' ORDER BY term) AS terms FROM t GROUP BY 1")
def r10_expand_by_arcs(spark, sf):
    """Questions expanded by what lies one step around the concepts they name."""
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    surfaces = region.select(_text("t:R", F.col("r_regionkey")).alias("concept"), F.lower("r_name").alias("surface")).unionByName(nation.select(_text("t:", F.regexp_replace("n_name", " ", "")).alias("concept"), F.lower("n_name").alias("surface")))
    q = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", _text("Sales in ", F.col("n_name"), " of 2023").alias("q"))
    related = _around(spark, sf).where("distance = 1").select("concept", "related").distinct()
    return S.expand_query(q, "c_custkey", "q", surfaces, related).select("qid", F.array_join("terms", ",").alias("terms"))
