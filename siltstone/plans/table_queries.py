"""Queries over the relational tables: filters, joins, aggregates, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import fiscal, nested, numeric
from siltstone.functions import text as X
from siltstone.operators import aggregates as A
from siltstone.operators import filters as P
from siltstone.operators import joins as J
from siltstone.operators import windows as Wn
from siltstone.operators.facts import clean_edges, fact_document, fact_line, hint_overrides, numeric_answers, rag_text
from siltstone.plans.catalogue import query
from siltstone.sources.files import primary_document, unprocessed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ORDERS_META = "o_orderpriority AS ticker, o_orderstatus AS form, CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS fy"


def _meta(spark: SparkSession, sf: str) -> DataFrame:
    fy = F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise(F.year("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("ticker"), F.col("o_orderstatus").alias("form"), fy.alias("fy"))


@query(f"SELECT * FROM (SELECT o_orderkey, {_ORDERS_META} FROM orders) WHERE upper(ticker) = '1-URGENT' AND upper(form) = 'F' AND coalesce(TRY_CAST(fy AS INT) = 1995, true)")
def p01_meta_filter(spark, sf):
    return _meta(spark, sf).where(P.metadata_filter("1-urgent", "f", 1995))


@query(f"SELECT * FROM (SELECT o_orderkey, {_ORDERS_META} FROM orders) WHERE upper(ticker) = '1-URGENT' AND upper(form) = 'F' AND TRY_CAST(fy AS INT) = 1995")
def p02_meta_filter_strict(spark, sf):
    return _meta(spark, sf).where(P.metadata_filter("1-urgent", "f", 1995, lenient=False))


@query("SELECT user_id, len(types) AS n_types FROM (SELECT user_id, list(DISTINCT event_type) AS types FROM events GROUP BY user_id) WHERE list_has_any(types, ['error', 'purchase'])")
def p03_entity_overlap(spark, sf):
    g = table(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("types"))
    return g.where(P.entity_filter("types", ["error", "purchase"])).select("user_id", F.size("types").cast("long").alias("n_types"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus IN ('F', 'O') AND l_quantity BETWEEN 10 AND 20 AND l_discount >= 0.05 AND l_linenumber <= 4 AND contains(l_returnflag, 'R')")
def p05_filter_grammar(spark, sf):
    rule = {"l_returnflag": {"eq": "R", "contains": "R"}, "l_linestatus": {"in": ["F", "O"]}, "l_quantity": {"between": (10, 20)}, "l_discount": {"gte": 0.05}, "l_linenumber": {"lte": 4}}
    return table(spark, sf, "lineitem").where(P.predicate(rule)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT p_partkey, s, s_num FROM (SELECT p_partkey, s, regexp_full_match(trim(translate(s, ',()$', '')), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') AS s_num FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '($' || CAST(p_size AS VARCHAR) || ',000)' WHEN p_size % 3 = 1 THEN CAST(p_size AS VARCHAR) || ' units' ELSE CAST(p_size AS VARCHAR) || '.5' END AS s FROM part))")
def p10_numeric_like(spark, sf):
    n = F.col("p_size").cast("string")
    s = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("($"), n, F.lit(",000)"))).when(F.col("p_size") % 3 == 1, F.concat(n, F.lit(" units"))).otherwise(F.concat(n, F.lit(".5")))
    return table(spark, sf, "part").select("p_partkey", s.alias("s")).withColumn("s_num", numeric.is_numeric_like("s"))


@query("SELECT coalesce(reason, 'valid') AS reason, count(*) AS n FROM (SELECT CASE WHEN NOT (value > 0) THEN 'value' WHEN NOT (event_type <> 'error') THEN 'type' WHEN NOT (user_id % 7 <> 0) THEN 'user' END AS reason FROM events) GROUP BY 1")
def p17_quarantine(spark, sf):
    rules = {"value": F.col("value") > 0, "type": F.col("event_type") != "error", "user": F.col("user_id") % 7 != 0}
    return P.quarantine(table(spark, sf, "events"), rules).groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, upper(trim(s_name)) AS ticker, CASE WHEN s_nationkey < 5 THEN '10-K' WHEN s_nationkey < 10 THEN '10-Q' ELSE 'OTHER' END AS form, TRY_CAST(CASE WHEN s_suppkey % 4 = 0 THEN 'x' ELSE CAST(2000 + s_nationkey AS VARCHAR) END AS INT) AS fy FROM supplier")
def p19_normalise_record(spark, sf):
    raw = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit(" "), F.lower("s_name")).alias("ticker"), F.when(F.col("s_nationkey") < 5, "10-k").when(F.col("s_nationkey") < 10, " 10-Q").otherwise("20-F").alias("form"), F.when(F.col("s_suppkey") % 4 == 0, "x").otherwise((2000 + F.col("s_nationkey")).cast("string")).alias("fy"))
    return P.normalise_record(raw)


@query("SELECT l.l_orderkey, l.l_linenumber, round(l.l_extendedprice, 2) AS value, o.o_orderstatus, s.s_name, p.p_name AS label FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN (SELECT * FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_partkey ORDER BY CASE WHEN p_type = 'x' THEN 0 ELSE 1 END, coalesce(p_brand, ''), p_type) AS rn FROM part) WHERE rn = 1) p ON l.l_partkey = p.p_partkey")
def j01_fact_star(spark, sf):
    facts = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_extendedprice", F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("p_partkey"))
    labels = J.ranked_labels(table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand"), ["p_partkey"], "p_type", "p_brand", "x").select("p_partkey", F.col("p_name").alias("label"))
    out = J.fact_star(facts, table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), table(spark, sf, "supplier").select("s_suppkey", "s_name"), labels, ["o_orderkey"], ["s_suppkey"], ["p_partkey"])
    return out.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", F.round("l_extendedprice", 2).alias("value"), "o_orderstatus", "s_name", "label")


@query("SELECT l.doc_id, length(trim(d.text)) AS n FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id AND trim(d.text) <> ''")
def j04_content_fetch(spark, sf):
    out = J.fetch_content(table(spark, sf, "labels").select("doc_id"), table(spark, sf, "documents").withColumn("o", F.col("n_chars")), "doc_id", "o", ["text"])
    return out.select("doc_id", F.length("content").cast("long").alias("n"))


@query("SELECT a.n_nationkey AS from_label, b.r_regionkey AS to_label, a.n_name AS from_concept, b.r_name AS to_concept FROM nation a JOIN region b ON a.n_regionkey = b.r_regionkey")
def j07_locator(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    arcs = nation.select(F.lit("r").alias("linkrole"), F.concat(F.lit("n"), "n_nationkey").alias("from_label"), F.concat(F.lit("r"), "n_regionkey").alias("to_label"))
    loc = nation.select(F.lit("r").alias("linkrole"), F.concat(F.lit("n"), "n_nationkey").alias("label"), F.col("n_name").alias("concept")).unionByName(region.select(F.lit("r").alias("linkrole"), F.concat(F.lit("r"), "r_regionkey").alias("label"), F.col("r_name").alias("concept")))
    out = J.resolve_arcs(arcs, loc)
    return out.select(F.substring("from_label", 2, 9).cast("int").alias("from_label"), F.substring("to_label", 2, 9).cast("int").alias("to_label"), "from_concept", "to_concept")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j09_missing_source(spark, sf):
    return J.missing_source(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id"), "doc_id")


@query("SELECT doc_id, CASE WHEN length(trim(text)) > 240 THEN substr(trim(text), 1, 240) || ' ...' ELSE trim(text) END AS quote FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND trim(text) <> ''")
def j10_valid_citations(spark, sf):
    cites = table(spark, sf, "documents").select("doc_id", F.col("text").alias("quote"))
    return J.valid_citations(cites, table(spark, sf, "labels").where("quality = 1").select("doc_id"), "doc_id", "quote")


@query("WITH v AS (SELECT upper(n_name) AS v, n_nationkey AS k FROM nation UNION SELECT split_part(upper(n_name), ' ', 1), n_nationkey FROM nation WHERE length(split_part(n_name, ' ', 1)) >= 3), last AS (SELECT v, arg_max(k, k) AS n_nationkey FROM v GROUP BY v) SELECT c.c_custkey, last.n_nationkey FROM (SELECT c.c_custkey, split_part(n.n_name, ' ', 1) AS name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) c LEFT JOIN last ON upper(trim(c.name)) = last.v")
def j11_alias_lookup(spark, sf):
    nation = table(spark, sf, "nation")
    names = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.element_at(F.split("n_name", " "), 1).alias("name"))
    registry = nation.select("n_nationkey", X.name_variants("n_name", F.lit(None).cast("string")).alias("variants"))
    return J.alias_lookup(names, registry, "name", "variants", "n_nationkey", "n_nationkey").select("c_custkey", "n_nationkey")


@query("WITH f AS (SELECT user_id, arg_min(event_type, event_id) AS fill FROM events WHERE event_type <> 'error' GROUP BY user_id) SELECT e.event_id, coalesce(nullif(CASE WHEN e.event_type = 'error' THEN ' ' ELSE e.event_type END, ' '), f.fill) AS fq FROM events e LEFT JOIN f USING (user_id)")
def j12_fq_backfill(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.when(F.col("event_type") == "error", " ").otherwise(F.col("event_type")).alias("fq"))
    return J.backfill(e, e, ["user_id"], "fq", "event_id").select("event_id", "fq")


@query("WITH n AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2) SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS rn FROM n) WHERE rn = 1")
def j13_dei_mode(spark, sf):
    return J.modal(table(spark, sf, "events"), ["user_id"], "event_type", "event_id")


@query("SELECT p_partkey, s.surface FROM part JOIN (SELECT unnest(['steel', 'copper', 'a', 'small']) AS surface) s ON contains(lower(p_name || ' ' || p_type), s.surface)")
def j14_surface_contains(spark, sf):
    s = spark.createDataFrame([("steel",), ("copper",), ("a",), ("small",)], "surface string")
    return J.surface_hits(table(spark, sf, "part").withColumn("t", F.concat_ws(" ", "p_name", "p_type")), "t", s, "surface").select("p_partkey", "surface")


@query("SELECT p_brand, p_type, arg_min(p_name, rk) AS best_label FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY CASE WHEN p_size < 10 THEN 0 ELSE 1 END, p_size % 3, p_partkey) AS rk FROM part) GROUP BY 1, 2")
def a02_best_label(spark, sf):
    return A.best_label(table(spark, sf, "part"), ["p_brand", "p_type"], "p_name", F.when(F.col("p_size") < 10, 0).otherwise(1), F.col("p_size") % 3, "p_partkey")


@query("SELECT p_brand, max(CASE WHEN rk = 1 AND p_size > 5 THEN p_name END) AS longest_label FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_size > 5 ORDER BY length(p_name) DESC, p_partkey) AS rk FROM part) GROUP BY 1")
def a03_longest_doc(spark, sf):
    return A.longest_label(table(spark, sf, "part"), ["p_brand"], "p_name", F.col("p_size") > 5, "p_partkey")


@query("SELECT p_brand, min(CASE WHEN p_size % 3 = 0 AND p_partkey % 2 = 0 THEN p_name END) AS label_standard_en, min(CASE WHEN p_size % 3 = 1 AND p_partkey % 2 = 0 THEN p_name END) AS label_terse_en, min(CASE WHEN p_size % 3 = 0 AND p_partkey % 2 = 1 THEN p_name END) AS label_standard_none FROM part GROUP BY 1")
def a04_label_pivot(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_name", F.when(F.col("p_size") % 3 == 0, "standard").when(F.col("p_size") % 3 == 1, "terse").otherwise("total").alias("role"), F.when(F.col("p_partkey") % 2 == 0, "en").alias("lang"))
    return A.pivot_labels(p, ["p_brand"], "role", "lang", "p_name", ["label_standard_en", "label_terse_en", "label_standard_none"])


_QUALITY = "SELECT user_id, count(*) AS n_rows, count(value) AS v, count(event_type) AS t, count(*) - count(DISTINCT (event_type, CAST(ts AS DATE))) AS dup, count(CASE WHEN event_id % 5 <> 0 THEN 1 END) AS clean FROM events GROUP BY 1"


@query(
    f"SELECT user_id, n_rows, round(greatest(0, least(100, 0.15 * 100 + 0.35 * filled + 0.10 * 100 + 0.40 * clean_pct - least(10, 0.2 * dup_pct))), 3) AS score FROM (SELECT user_id, n_rows, round_even((v + t) / 2.0 * 100.0 / n_rows, 2) AS filled, round_even(clean * 100.0 / n_rows, 2) AS clean_pct, round_even(dup * 100.0 / n_rows, 2) AS dup_pct FROM ({_QUALITY}))"
)
def a13_quality_score(spark, sf):
    e = table(spark, sf, "events").withColumns({"fy": F.year("ts"), "num": F.when(F.col("event_id") % 5 == 0, "x").otherwise(F.col("value").cast("string")), "day": F.to_date("ts")})
    out = A.quality_score(e, ["user_id"], ["value", "event_type"], "fy", "num", ["event_type", "day"])
    return out.select("user_id", "n_rows", F.round("score", 3).alias("score"))


@query("SELECT round(sum(avg_v * n) / sum(n), 2) AS weighted_avg FROM (SELECT l_returnflag, avg(l_quantity) AS avg_v, count(*) AS n FROM lineitem GROUP BY 1)")
def a14_weighted_avg(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.avg("l_quantity").alias("v"), F.count("*").alias("n"))
    return A.weighted_average(g, "v", "n")


@query("SELECT event_type, count(*) - count(DISTINCT (user_id, CAST(ts AS DATE))) AS dups FROM events GROUP BY 1")
def a15_dup_rate(spark, sf):
    return table(spark, sf, "events").withColumn("d", F.to_date("ts")).groupBy("event_type").agg(A.duplicate_count(["user_id", "d"]).alias("dups"))


@query("SELECT count(*) AS total, count(CASE WHEN doc_id % 9 = 0 THEN 1 END) AS bad_format, count(CASE WHEN doc_id % 7 = 0 AND doc_id % 9 <> 0 THEN 1 END) AS mismatched FROM documents")
def a16_audit_counts(spark, sf):
    n = F.col("doc_id") % 50
    rid = F.concat(F.when(F.col("doc_id") % 9 == 0, "bad").otherwise("0000000001-24-000001::text::chunk-"), F.when(F.col("doc_id") % 9 == 0, "").otherwise(n.cast("string")))
    d = table(spark, sf, "documents").select(rid.alias("id"), F.when(F.col("doc_id") % 7 == 0, n + 1).otherwise(n).alias("no"))
    return A.audit(d, "id", "no")


@query("SELECT DISTINCT event_type, user_id % 10 AS bucket FROM events")
def a19_distinct(spark, sf):
    return table(spark, sf, "events").select("event_type", (F.col("user_id") % 10).alias("bucket")).dropDuplicates()


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def a20_keep_first(spark, sf):
    return A.keep_first(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END DESC, ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def a23_conflict(spark, sf):
    e = table(spark, sf, "events").withColumn("text_hash", F.col("event_type"))
    return A.resolve_conflicts(e, "user_id", X.path_priority("event_type", ("purchase",)), "ts", "event_id").select("user_id", "event_id")


@query("SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, sha1(event_type) ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn <= 2")
def a25_sig_cap(spark, sf):
    return A.keep_first(table(spark, sf, "events").withColumn("sig", F.sha1("event_type")), ["user_id", "sig"], [F.desc("value"), "event_id"], 2).select("event_id")


@query("SELECT event_type, max(value) AS best FROM events GROUP BY 1 ORDER BY best DESC")
def a26_group_max(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.max("value").alias("best")).orderBy(F.desc("best"))


@query("SELECT md5(concat_ws('|', source, lang, text)) AS h, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def a27_hash_dedup(spark, sf):
    return table(spark, sf, "documents").groupBy(F.md5(F.concat_ws("|", "source", "lang", "text")).alias("h")).agg(F.min("doc_id").alias("doc_id"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def a29_record_counts(spark, sf):
    return A.counts_by(table(spark, sf, "events"), "event_type")


@query("SELECT p_brand, p_partkey FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_type = 'STEEL' THEN 0 ELSE 1 END, CAST(p_partkey AS VARCHAR), p_type) AS rn FROM part) WHERE rn = 1")
def w01_label_rank(spark, sf):
    return J.ranked_labels(table(spark, sf, "part").withColumn("lang", F.col("p_partkey").cast("string")), ["p_brand"], "p_type", "lang", "STEEL").select("p_brand", "p_partkey")


_RUNS = "SELECT event_id, user_id, ts, nullif(event_type, 'error') AS heading FROM events"


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "user_id", "ts", F.nullif("event_type", F.lit("error")).alias("heading"))


@query(f"SELECT event_id, last_value(heading IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS heading FROM ({_RUNS})")
def w02_heading_carry(spark, sf):
    return Wn.carry_forward(_runs(spark, sf), ["user_id"], ["ts", "event_id"], F.col("heading"), "carried").select("event_id", F.col("carried").alias("heading"))


_SECTIONS = f"SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS INT) AS section FROM (SELECT *, CASE WHEN before IS NOT NULL AND (heading IS NULL OR heading <> before) THEN 1 ELSE 0 END AS new FROM (SELECT *, lag(heading) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM ({_RUNS})))"


@query(f"SELECT event_id, section FROM ({_SECTIONS})")
def w04_sections(spark, sf):
    return Wn.sections(_runs(spark, sf), ["user_id"], ["ts", "event_id"], "heading").select("event_id", "section")


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS chunk_index, count(*) OVER (PARTITION BY user_id) AS chunk_count FROM events")
def w06_chunk_index(spark, sf):
    return Wn.index_and_count(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"]).select("event_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("chunk_count").cast("long").alias("chunk_count"))


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) AS rank FROM conversations")
def w07_rank(spark, sf):
    return Wn.ranked(table(spark, sf, "conversations"), ["conv_id"], [F.desc(F.length("text")), "turn"]).select("conv_id", "turn", F.col("rank").cast("long").alias("rank"))


@query("WITH n AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no, CAST(event_id AS VARCHAR) AS c FROM events), r AS (SELECT *, no - row_number() OVER (PARTITION BY user_id, event_type ORDER BY no) AS run FROM n) SELECT user_id, event_type, min(no) AS first_no, count(*) AS n_parts, string_agg(c, chr(10) || chr(10) ORDER BY no) AS content FROM r GROUP BY user_id, event_type, run")
def w08_stitch(spark, sf):
    e = Wn.ranked(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "no").select("user_id", "event_type", F.col("no").cast("long").alias("no"), F.col("event_id").cast("string").alias("c"))
    return Wn.stitch_adjacent(e, ["user_id"], "no", "event_type", "c")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def o01_topk(spark, sf):
    return table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_custkey")


@query("SELECT o_custkey, h FROM (SELECT o_custkey, h, row_number() OVER (PARTITION BY o_custkey ORDER BY w DESC, h) AS rn FROM (SELECT DISTINCT o_custkey, 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS h, year(o_orderdate) * 10 + quarter(o_orderdate) AS w FROM orders)) WHERE rn <= 2")
def o05_latest_periods(spark, sf):
    h = F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string"), F.lit(" "), F.year("o_orderdate").cast("string"))
    d = table(spark, sf, "orders").select("o_custkey", h.alias("h")).distinct().withColumn("w", Wn.period_weight("h"))
    return Wn.top_k(d, ["o_custkey"], [F.desc("w"), "h"], 2).select("o_custkey", "h")


@query("SELECT s_name AS name, 'supplier' AS kind, s_acctbal AS bal FROM supplier UNION ALL SELECT c_name, 'customer', c_acctbal FROM customer UNION ALL SELECT n_name, NULL, NULL FROM nation")
def u01_union(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("bal"))
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("bal"))
    return s.unionByName(c).unionByName(table(spark, sf, "nation").select(F.col("n_name").alias("name")), allowMissingColumns=True)


_HUMAN = "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '(' || p_size || ')' WHEN 1 THEN '$' || p_size || ',250' WHEN 2 THEN p_size || '.500 M' WHEN 3 THEN p_size || ' K' ELSE 'abc' END AS s FROM part"


def _human(spark: SparkSession, sf: str) -> DataFrame:
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 5
    s = F.when(k == 0, F.concat(F.lit("("), n, F.lit(")"))).when(k == 1, F.concat(F.lit("$"), n, F.lit(",250"))).when(k == 2, F.concat(n, F.lit(".500 M"))).when(k == 3, F.concat(n, F.lit(" K"))).otherwise("abc")
    return table(spark, sf, "part").select("p_partkey", s.alias("s"))


@query(f"SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN -1.0 * p_size WHEN 1 THEN CAST(p_size || '250' AS DOUBLE) WHEN 2 THEN (p_size + 0.5) * 1e6 WHEN 3 THEN p_size * 1e3 END AS v FROM part")
def f54_human_number(spark, sf):
    return _human(spark, sf).select("p_partkey", F.round(numeric.human_number("s"), 3).alias("v"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS DOUBLE) / 100 WHEN 1 THEN p_size + 1000.5 END AS v FROM part")
def f55_float_maybe(spark, sf):
    n, k = F.col("p_size"), F.col("p_partkey") % 3
    s = F.when(k == 0, F.concat(n.cast("string"), F.lit("%"))).when(k == 1, F.concat(F.lit("1,"), F.lpad(n.cast("string"), 3, "0"), F.lit(".5"))).otherwise("12d")
    return table(spark, sf, "part").select("p_partkey", numeric.float_maybe(s, percent=True).alias("v"))


@query("SELECT p_partkey, p_name || ' [' || p_brand || ' 10-K FY' || CAST(2000 + p_size AS VARCHAR) || ']' AS title FROM part")
def f17_title(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.title_from_meta(F.col("p_name"), F.col("p_brand"), F.lit("10-K"), 2000 + F.col("p_size")).alias("title"))


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'risk_factors' WHEN p_size % 4 = 1 THEN 'fwd_statements' WHEN p_size % 4 = 2 THEN 'md&a' END AS tag FROM part")
def f19_section_tag(spark, sf):
    k = F.col("p_size") % 4
    h = F.when(k == 0, "Item 1A. Risk Factors").when(k == 1, F.lit(None)).otherwise("Notes")
    c = F.when(k == 1, "Some Forward-Looking words").when(k == 2, "see MD&A").otherwise("plain")
    return table(spark, sf, "part").withColumns({"h": h, "c": c}).select("p_partkey", X.section_tag("h", "c").alias("tag"))


@query("SELECT o_orderkey, year(o_orderdate) + 20 BETWEEN 2010 AND 2025 AS other FROM orders")
def f20_other_years(spark, sf):
    t = F.concat(F.lit("see our "), (F.year("o_orderdate") + 20).cast("string"), F.lit(" annual report on Form 10-K"))
    return table(spark, sf, "orders").select("o_orderkey", X.mentions_other_years(t).alias("other"))


_CONCEPTS = ["us-gaap:Revenues", "us-gaap:CashFlow", "us-gaap:NoteDisclosure", "us-gaap:AssetsCurrent", "us-gaap:Goodwill", "us-gaap:Shares"]


@query("SELECT p_partkey, ['income', 'cashflow', 'notes', 'balance', 'balance', 'other'][p_partkey % 6 + 1] AS hint FROM part")
def f28_statement_hint(spark, sf):
    names = F.array(*map(F.lit, _CONCEPTS))
    return table(spark, sf, "part").select("p_partkey", X.statement_hint(F.element_at(names, (F.col("p_partkey") % 6 + 1).cast("int"))).alias("hint"))


@query("SELECT p_partkey, ['balance', 'income', 'balance', 'other'][p_partkey % 4 + 1] AS hint FROM part")
def f29_hint_overrides(spark, sf):
    k = F.col("p_partkey") % 4
    concept = F.when(k == 0, "us-gaap:CashAndCashEquivalentsAtCarryingValue").when(k == 1, "us-gaap:EarningsPerShareBasic").when(k == 2, "us-gaap:LongTermDebt").otherwise("us-gaap:LongTermDebt")
    instant = F.when(k == 2, "2024-12-31")
    return table(spark, sf, "part").select("p_partkey", hint_overrides(F.lit("other"), concept, instant, F.lit("")).alias("hint"))


@query("SELECT p_partkey, ['USD', 'shares', '%', 'pure', '%'][p_partkey % 5 + 1] AS unit, ['currency', 'shares', 'percent', 'pure', 'percent'][p_partkey % 5 + 1] AS family FROM part")
def f30_unit(spark, sf):
    k = F.col("p_partkey") % 5
    u = F.when(k == 0, "iso4217:USD").when(k == 1, "shares").when(k == 2, F.lit(None)).otherwise("pure")
    shown = F.when(k.isin(2, 4), "25%").otherwise("25")
    return table(spark, sf, "part").select("p_partkey", numeric.normalize_unit(u, F.lit("x"), shown).alias("u")).select("p_partkey", "u.unit", "u.family")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN v >= 1e9 THEN format('{:.3f} B', v / 1e9) WHEN v >= 1e6 THEN format('{:.3f} M', v / 1e6) ELSE format('{:.3f} K', v / 1e3) END AS shown FROM (SELECT l_orderkey, l_linenumber, round(l_extendedprice) * 1000 AS v FROM lineitem)")
def f36_value_short(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", numeric.short_value(F.round("l_extendedprice") * 1000).alias("shown"))


@query("SELECT p_partkey, p_name || ': ' || CAST(p_size AS VARCHAR) || ' (FY2024; ' || p_brand || ' 10-K accno=' || CAST(p_partkey AS VARCHAR) || ')' AS t FROM part")
def f37_rag_text(spark, sf):
    return table(spark, sf, "part").select("p_partkey", rag_text(F.col("p_name"), F.col("p_size").cast("string"), F.lit("FY2024"), F.col("p_brand"), F.lit("10-K"), F.col("p_partkey").cast("string")).alias("t"))


@query("SELECT p_partkey, p_name || ': ' || CAST(p_size AS VARCHAR) || ' | Unit=USD' || CASE WHEN p_size % 2 = 0 THEN ' | Dimensions=a=b' ELSE '' END AS t FROM part")
def f38_fact_line(spark, sf):
    none = F.lit(None).cast("string")
    return table(spark, sf, "part").select("p_partkey", fact_line(F.col("p_name"), F.col("p_size").cast("string"), F.lit("USD"), none, F.lit(""), F.when(F.col("p_size") % 2 == 0, "a=b"), none).alias("t"))


@query("SELECT p_partkey, [p_size / 100.0, 0.125] AS pct FROM part")
def f51_percent(spark, sf):
    t = F.concat(F.lit("up "), F.col("p_size").cast("string"), F.lit(" % and 12.5% more"))
    return table(spark, sf, "part").select("p_partkey", numeric.percents(t).alias("pct"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'EUR,USD' WHEN 1 THEN 'CNY' ELSE 'GBP,JPY' END AS codes FROM part")
def f52_currency(spark, sf):
    k = F.col("p_partkey") % 3
    t = F.when(k == 0, "$5 or 4 EUR, $6").when(k == 1, "¥ 7 RMB").otherwise("£3 and jpy 4")
    return table(spark, sf, "part").select("p_partkey", F.array_join(numeric.currencies(t), ",").alias("codes"))


@query("SELECT p_partkey, p_size * 365 + 6 * 30 AS days FROM part")
def f53_duration(spark, sf):
    t = F.concat(F.lit("S&P for P"), F.col("p_size").cast("string"), F.lit("Y6M"))
    return table(spark, sf, "part").select("p_partkey", F.element_at(numeric.iso_durations(t), 1).alias("days"))


@query("SELECT event_id, round(CASE WHEN event_type = 'purchase' THEN value / 100 ELSE value END, 6) AS v FROM events")
def f56_percent_scale(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.round(numeric.scale_percent(F.col("value"), numeric.is_percent(F.when(F.col("event_type") == "purchase", "percent"), F.lit("1"), F.lit("x"))), 6).alias("v"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 2000.0 ELSE -3.0 END AS v FROM events")
def f57_value_chain(spark, sf):
    k = F.col("event_id") % 3
    return table(spark, sf, "events").select("event_id", numeric.consolidate_value(F.when(k == 0, "1"), F.when(k == 1, "2 K").otherwise("n/a"), F.lit("(3)")).alias("v"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN -3 WHEN 1 THEN 2 END AS d FROM events")
def f58_decimals(spark, sf):
    k = F.col("event_id") % 3
    return table(spark, sf, "events").select("event_id", numeric.decimals(F.when(k == 0, "-3").when(k == 1, "2.0").otherwise("INF")).alias("d"))


@query("SELECT o_orderkey, round(CASE WHEN gap > 0 THEN 0.9 * pow(2.71828, -0.6 * greatest(0, gap - 1)) ELSE 1 END, 6) AS w FROM (SELECT o_orderkey, abs(year(o_orderdate) - 1995) AS gap FROM orders)")
def f64_year_decay(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.round(numeric.year_decay(F.abs(F.year("o_orderdate") - 1995), 0.6), 6).alias("w"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) ELSE 2030 END AS fy FROM orders")
def f70_period_fy(spark, sf):
    d = F.when(F.col("o_orderkey") % 2 == 0, fiscal.iso_date("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", fiscal.period_year(F.lit(None).cast("string"), d, F.lit(None).cast("string"), F.lit(2030)).alias("fy"))


@query("SELECT o_orderkey, CASE WHEN month(d) = 10 AND day(d) = 1 THEN 'Q4' WHEN s BETWEEN 1 AND 3 THEN 'Q1' WHEN s BETWEEN 4 AND 6 THEN 'Q2' WHEN s BETWEEN 7 AND 9 THEN 'Q3' ELSE 'Q4' END AS fq FROM (SELECT o_orderkey, o_orderdate AS d, (month(o_orderdate) - 9 + 12) % 12 AS s FROM orders)")
def f71_fiscal_quarter(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", fiscal.fiscal_quarter(fiscal.iso_date("o_orderdate"), F.lit("09-30")).alias("fq"))


@query("SELECT o_orderkey, 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS q FROM orders")
def f72_calendar_q(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", fiscal.calendar_quarter(F.month("o_orderdate")).alias("q"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS d FROM orders")
def f73_compact_date(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", fiscal.compact_date(fiscal.iso_date("o_orderdate")).alias("d"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'FY1995 ' || strftime(o_orderdate, '%Y-%m-%d') ELSE 'FY1995 1995-01-01 — ' || strftime(o_orderdate, '%Y-%m-%d') END AS label FROM orders")
def f75_period_label(spark, sf):
    d = fiscal.iso_date("o_orderdate")
    even = F.col("o_orderkey") % 2 == 0
    return table(spark, sf, "orders").select("o_orderkey", fiscal.period_label(F.when(~even, "1995-01-01"), F.when(~even, d), F.when(even, d), F.lit(1995)).alias("label"))


@query("SELECT event_id, 'a=x|k=' || CAST(json_extract_string(props, '$.k') AS VARCHAR) AS sig FROM events")
def f80_dims_signature(spark, sf):
    dims = F.map_concat(nested.dims_from_json("props"), F.create_map(F.lit("a"), F.lit("x")))
    return table(spark, sf, "events").select("event_id", nested.dims_signature(dims).alias("sig"))


@query("SELECT DISTINCT n_name AS from_concept, r_name AS to_concept, 1.0 AS weight, TRY_CAST(n_regionkey AS INT) AS fy, CAST(NULL AS VARCHAR) AS arcrole FROM nation JOIN region ON n_regionkey = r_regionkey")
def t23_edges_clean(spark, sf):
    e = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("from_concept"), F.col("r_name").alias("to_concept"), F.lit("1.0").alias("weight"), F.col("n_regionkey").cast("string").alias("fy"))
    return clean_edges(e.unionByName(e), ["from_concept", "to_concept", "weight", "fy", "arcrole"], ["weight"], ["fy"])


@query("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR) || ': ' || o_orderstatus, chr(10) ORDER BY o_orderkey) AS document FROM orders GROUP BY 1")
def t19_fact_document(spark, sf):
    lines = table(spark, sf, "orders").select("o_custkey", "o_orderkey", fact_line(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), *[F.lit(None).cast("string")] * 5).alias("line"))
    return fact_document(lines, ["o_custkey"], "o_orderkey", "line")


@query("SELECT p_partkey, CAST(p_size AS DOUBLE) AS answer FROM part WHERE p_size % 2 = 0")
def r22_numeric_answers(spark, sf):
    line = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Revenue: "), F.col("p_size").cast("string"), F.lit(" | Unit=USD"))).otherwise("Other: none")
    return numeric_answers(table(spark, sf, "part").select("p_partkey", line.alias("line")), "line", r"^Revenue: ([\d.,]+)").select("p_partkey", "answer")


@query("SELECT page_id FROM pages WHERE page_id NOT IN (SELECT page_id FROM pages WHERE page_id % 3 = 0)")
def s19_manifest_skip(spark, sf):
    p = table(spark, sf, "pages").select("page_id")
    return unprocessed(p, p.where("page_id % 3 = 0"), "page_id")


@query("SELECT folder, page_id FROM (SELECT page_id % 10 AS folder, page_id, row_number() OVER (PARTITION BY page_id % 10 ORDER BY CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END, length(html) DESC, page_id) AS rn FROM pages WHERE page_id < 10000000) WHERE rn = 1")
def s07_main_doc_pick(spark, sf):
    p = table(spark, sf, "pages").select("page_id", (F.col("page_id") % 10).alias("folder"), F.concat(F.lpad(F.col("page_id").cast("string"), 8, "0"), F.when(F.col("page_id") % 3 == 0, "-filing-details.htm").otherwise(".htm")).alias("name"), F.length("html").alias("size"))
    return primary_document(p, "folder", "name", "size").select("folder", "page_id")
