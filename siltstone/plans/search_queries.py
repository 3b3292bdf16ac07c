"""Queries of keyword, vector and hybrid search, reranking and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.numeric import inner_product, l2_similarity
from siltstone.operators import evidence as Ev
from siltstone.operators import keyword_index as K
from siltstone.operators import search as S
from siltstone.operators import vector_index as V
from siltstone.operators.filters import metadata_filter
from siltstone.operators.joins import fuse_lists, fused_order
from siltstone.operators.windows import ranked, top_k
from siltstone.plans.catalogue import query
from siltstone.plans.file_queries import place
from siltstone.plans.table_queries import table
from siltstone.plans.text_queries import TOKENS


def bm25_sql(docs: str, k: int) -> str:
    """BM25 of all benchmark items against docs, in SQL."""
    return f"""
WITH d AS (SELECT doc_id, {TOKENS} AS t FROM ({docs})), st AS (SELECT count(*) AS n, avg(len(t)) AS avg_len FROM d),
q AS (SELECT DISTINCT item_id, unnest({TOKENS}) AS term FROM benchmark),
tf AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS len, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
w AS (SELECT doc_id, tf.term, ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * len / (avg_len + 1e-9)) + 1e-12) AS w FROM tf JOIN df ON tf.term = df.term CROSS JOIN st),
s AS (SELECT item_id AS qid, doc_id AS doc, sum(w) AS score FROM q JOIN w ON q.term = w.term GROUP BY 1, 2 HAVING sum(w) > 0)
SELECT qid, doc, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc) AS rank FROM s) WHERE rank <= {k}"""


def dense_sql(vectors: str, k: int) -> str:
    """Inner products of the vectors whose id is divisible by 50 with all of a table, in SQL."""
    return f"""
WITH q AS (SELECT vec_id AS qid, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS qv FROM embeddings WHERE vec_id % 50 = 0), v AS (SELECT vec_id AS doc, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM ({vectors})),
s AS (SELECT qid, doc, list_inner_product(qv, e) AS score FROM q, v)
SELECT qid, doc, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc) AS rank FROM s) WHERE rank <= {k}"""


def _bm25(spark: SparkSession, sf: str, docs: DataFrame, k: int) -> DataFrame:
    return S.bm25(docs, table(spark, sf, "benchmark"), "doc_id", "text", "item_id", "text", k)


def _query_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The stated queries of vector search: ids divisible by 50."""
    return table(spark, sf, "embeddings").where("vec_id % 50 = 0")


def _item_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The vector of each benchmark item, that of its id."""
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("vec_id"))
    return table(spark, sf, "embeddings").join(items, "vec_id", "left_semi")


def _dense(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    q = queries.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
    return S.dense(vectors, q, "vec_id", "embedding", "qid", "qv", k)


_SHOW = "SELECT qid, doc, CAST(rank AS INT) AS rank, round(score, 6) AS score FROM"


def _show(df: DataFrame) -> DataFrame:
    return df.select("qid", "doc", "rank", F.round("score", 6).alias("score"))


@query(f"{_SHOW} ({bm25_sql('SELECT * FROM documents', 10)})")
def r03_bm25_topk(spark, sf):
    return _show(_bm25(spark, sf, table(spark, sf, "documents"), 10))


@query(f"{_SHOW} ({bm25_sql('SELECT * FROM documents WHERE upper(lang) = upper(chr(101) || chr(110))', 10)})")
def r03_bm25_filtered(spark, sf):
    d = table(spark, sf, "documents")
    return _show(_bm25(spark, sf, d.where(metadata_filter("en", names=("lang", "source", "n_chars"))), 10))


@query(f"{_SHOW} ({bm25_sql('SELECT * FROM documents', 10)})")
def r03_stored_index(spark, sf):
    """The same answers from a stored index: built, and read by term."""
    store = K.build(table(spark, sf, "documents"), place(spark, "keywords"), "doc_id", "text", parts=4)
    return _show(K.search(store, table(spark, sf, "benchmark"), "item_id", "text", 10))


@query(f"{_SHOW} ({bm25_sql('SELECT * FROM documents WHERE upper(lang) = upper(chr(101) || chr(110))', 10)})")
def r03_stored_filtered(spark, sf):
    """A filter on stored columns; statistics are those of the documents that pass."""
    store = K.build(table(spark, sf, "documents"), place(spark, "keywords"), "doc_id", "text", ["lang"], 4)
    return _show(K.search(store, table(spark, sf, "benchmark"), "item_id", "text", 10, F.upper("lang") == "EN"))


@query(f"{_SHOW} ({bm25_sql('SELECT * FROM documents', 10)})")
def s20_index_upkeep(spark, sf):
    """An index of an older state, brought up to date: documents of one language were missing, those of one source had other texts, and some are there no longer."""
    docs = table(spark, sf, "documents").withColumn("at", F.when(F.col("source") == "src3", 2).otherwise(1))
    then = docs.where("lang <> 'de'").withColumns({"text": F.when(F.col("source") == "src3", "an older text").otherwise(F.col("text")), "at": F.lit(1)})
    vanished = docs.where("source = 'src5'").withColumns({"doc_id": -1 - F.col("doc_id"), "at": F.lit(1)})
    store = K.build(then.unionByName(vanished), place(spark, "keywords"), "doc_id", "text", ["at"], 4)
    K.sync(store, docs, "doc_id", "text", "at")
    return _show(K.search(store, table(spark, sf, "benchmark"), "item_id", "text", 10))


@query(f"{_SHOW} ({dense_sql('SELECT * FROM embeddings', 10)})")
def r04_dense_topk(spark, sf):
    return _show(_dense(_query_vectors(spark, sf), table(spark, sf, "embeddings"), 10))


@query(f"{_SHOW} ({dense_sql('SELECT * FROM embeddings WHERE label = 3', 10)})")
def r04_dense_filtered(spark, sf):
    return _show(_dense(_query_vectors(spark, sf), table(spark, sf, "embeddings").where("label = 3"), 10))


@query(f"{_SHOW} ({dense_sql('SELECT * FROM embeddings WHERE label = 3', 10)})")
def r04_cell_index(spark, sf):
    """A stored index of cells, filtered by a stored column; cells that could hold better ones are read as well."""
    store = V.build(table(spark, sf, "embeddings"), place(spark, "cells"), "vec_id", "embedding", ["label"])
    return _show(V.search(store, _query_vectors(spark, sf), "vec_id", "embedding", 10, exact=True, where=F.col("label") == 3))


@query("SELECT a.vec_id, round(list_inner_product(list_transform(a.embedding, lambda x: CAST(x AS DOUBLE)), list_transform(b.embedding, lambda x: CAST(x AS DOUBLE))), 6) AS ip, round(1 / (1 + pow(list_distance(list_transform(a.embedding, lambda x: CAST(x AS DOUBLE)), list_transform(b.embedding, lambda x: CAST(x AS DOUBLE))), 2)), 6) AS l2 FROM embeddings a JOIN embeddings b ON a.vec_id + 1 = b.vec_id")
def f60_inner_product(spark, sf):
    e = table(spark, sf, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(inner_product("embedding", "b"), 6).alias("ip"), F.round(l2_similarity("embedding", "b"), 6).alias("l2"))


_SCORES = "SELECT user_id AS qid, event_id AS doc, value AS d, event_id % 7 AS ce FROM events"


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("user_id").alias("qid"), F.col("event_id").alias("doc"), F.col("value").alias("d"), (F.col("event_id") % 7).alias("ce"))


_MM = "CASE WHEN max({0}) OVER w > min({0}) OVER w THEN ({0} - min({0}) OVER w) / (max({0}) OVER w - min({0}) OVER w) ELSE 0.5 END"


@query(f"SELECT doc, round({_MM.format('d')}, 6) AS s FROM ({_SCORES}) WINDOW w AS (PARTITION BY qid)")
def f61_minmax(spark, sf):
    return _scores(spark, sf).select("doc", F.round(S.normalised(["qid"], "d"), 6).alias("s"))


@query(f"SELECT doc, round((d - avg(d) OVER w) / (stddev_pop(d) OVER w + 1e-12), 5) AS s FROM ({_SCORES}) WINDOW w AS (PARTITION BY qid)")
def f62_zscore(spark, sf):
    return _scores(spark, sf).select("doc", F.round(S.normalised(["qid"], "d", "zscore"), 5).alias("s"))


@query(f"SELECT doc, round(0.5 * ({_MM.format('ce')}) + 0.5 * ({_MM.format('d')}), 6) AS fused FROM ({_SCORES}) WINDOW w AS (PARTITION BY qid)")
def r05_fuse(spark, sf):
    return S.fuse_scores(_scores(spark, sf), ["qid"], "d", "ce").select("doc", F.round("fused", 6).alias("fused"))


def _two_lists(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf, "documents").select(F.col("source").alias("qid"), F.col("doc_id").alias("doc"), "n_chars")
    return top_k(d, ["qid"], [F.desc("n_chars"), "doc"], 20), top_k(d, ["qid"], [F.asc("n_chars"), "doc"], 25)


_A = "SELECT * FROM (SELECT source AS qid, doc_id AS doc, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 20"
_B = "SELECT * FROM (SELECT source AS qid, doc_id AS doc, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS rank FROM documents) WHERE rank <= 25"
_RRF = f"SELECT coalesce(a.qid, b.qid) AS qid, coalesce(a.doc, b.doc) AS doc, a.rank AS rank_a, b.rank AS rank_b, coalesce(2.0 / (60.0 + a.rank), 0) + coalesce(2.0 / (60.0 + b.rank), 0) AS rrf FROM ({_A}) a FULL JOIN ({_B}) b ON a.qid = b.qid AND a.doc = b.doc"


@query(f"SELECT qid, doc, coalesce(rank_a, 0) AS rank_a, coalesce(rank_b, 0) AS rank_b, round(rrf, 9) AS rrf FROM ({_RRF})")
def j06_ranked_union(spark, sf):
    f = fuse_lists(*_two_lists(spark, sf), ["qid", "doc"])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return f.select("qid", "doc", zero("rank_a"), zero("rank_b"), F.round("rrf", 9).alias("rrf"))


@query(f"SELECT qid, doc, rank FROM (SELECT qid, doc, row_number() OVER (PARTITION BY qid ORDER BY rrf DESC, rank_a NULLS LAST, rank_b NULLS LAST, doc) AS rank FROM ({_RRF})) WHERE rank <= 10")
def r06_rrf(spark, sf):
    f = fuse_lists(*_two_lists(spark, sf), ["qid", "doc"])
    return top_k(f, ["qid"], [*fused_order(), "doc"], 10).select("qid", "doc", F.col("rank").cast("long").alias("rank"))


_STOP_E = ", ".join(f"'{w}'" for w in "the a an and or of to in for on by with as at from this that these those is are was were be been being it its".split())
_WORDS = "list_distinct(list_filter(regexp_extract_all(lower(coalesce({0}, '')), '[A-Za-z0-9_\\x{{4e00}}-\\x{{9fff}}]+'), lambda t: NOT list_contains([" + _STOP_E + "], t)))"


_HYBRID = f"""
WITH b AS ({bm25_sql('SELECT * FROM documents', 50)}), q AS (SELECT vec_id AS qid, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS qv FROM embeddings WHERE vec_id IN (SELECT item_id FROM benchmark)),
sd AS (SELECT qid, vec_id AS doc, list_inner_product(qv, list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS score FROM q, embeddings),
d AS (SELECT * FROM (SELECT qid, doc, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc) AS rank FROM sd) WHERE rank <= 50),
f AS (SELECT coalesce(b.qid, d.qid) AS qid, coalesce(b.doc, d.doc) AS doc, b.rank AS ra, d.rank AS rb, coalesce(2.0 / (60.0 + b.rank), 0) + coalesce(2.0 / (60.0 + d.rank), 0) AS rrf FROM b FULL JOIN d ON b.qid = d.qid AND b.doc = d.doc),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rrf DESC, ra NULLS LAST, rb NULLS LAST, doc) AS r FROM f),
c AS (SELECT r.*, len(list_intersect({_WORDS.format('i.text')}, {_WORDS.format('t.text')})) / len({_WORDS.format('i.text')}) AS ce FROM r JOIN documents t ON r.doc = t.doc_id JOIN benchmark i ON r.qid = i.item_id WHERE r <= 256),
m AS (SELECT *, rrf * 0.5 + CASE WHEN max(ce) OVER w > min(ce) OVER w THEN (ce - min(ce) OVER w) / (max(ce) OVER w - min(ce) OVER w) ELSE ce END * 0.5 AS final FROM c WINDOW w AS (PARTITION BY qid))
SELECT qid, doc, CAST(rank AS INT) AS rank, round(final, 6) AS final_score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(final, 9) DESC, r) AS rank FROM m) WHERE rank <= 8"""


@query(_HYBRID)
def r08_hybrid(spark, sf):
    """The flagship: both legs for all benchmark items, fused, reranked, first eight."""
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    out = S.hybrid(_bm25(spark, sf, docs, 50), _dense(_item_vectors(spark, sf), table(spark, sf, "embeddings"), 50), docs, items, "doc_id", "text", "item_id", "text")
    return out.select("qid", "doc", "rank", F.round("final_score", 6).alias("final_score"))


_PASSED = "(SELECT qid, doc, row_number() OVER (PARTITION BY qid ORDER BY rank) AS rank FROM {} JOIN documents ON doc = doc_id WHERE upper(lang) = 'EN')"


@query(_HYBRID.replace("WITH b AS (", "WITH b0 AS (").replace(", q AS (", f", b AS {_PASSED.format('b0')}, q AS (", 1).replace("\nd AS (", "\nd0 AS (").replace("\nf AS (", f"\nd AS {_PASSED.format('d0')},\nf AS ("))
def r08_strict(spark, sf):
    """As the flagship, with hits of both legs held to a filter before they are fused."""
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    strict = metadata_filter("en", lenient=False, names=("lang", "source", "n_chars"))
    out = S.hybrid(_bm25(spark, sf, docs, 50), _dense(_item_vectors(spark, sf), table(spark, sf, "embeddings"), 50), docs, items, "doc_id", "text", "item_id", "text", strict=strict)
    return out.select("qid", "doc", "rank", F.round("final_score", 6).alias("final_score"))


@query("SELECT event_id, round(value * (1 + CASE WHEN user_id % 2 = 0 THEN 0.15 ELSE 0 END + CASE WHEN user_id % 3 = 0 THEN 0.05 ELSE 0 END + CASE WHEN event_type = 'error' THEN 0.10 ELSE 0 END), 6) AS s FROM events")
def r13_entity_boost(spark, sf):
    one = lambda ok: F.when(ok, F.array(F.lit("x"))).otherwise(F.array(F.lit("y")))
    e = table(spark, sf, "events").withColumns({"o": one(F.col("user_id") % 2 == 0), "g": one(F.col("user_id") % 3 == 0), "t": one(F.col("event_type") == "error"), "x": F.array(F.lit("x"))})
    return e.select("event_id", F.round(S.entity_boost("value", ("o", "x"), ("g", "x"), ("t", "x")), 6).alias("s"))


@query("SELECT event_id, round(value * CASE user_id % 4 WHEN 0 THEN 1.20 WHEN 1 THEN 0.92 WHEN 2 THEN 0.85 ELSE 1 END * CASE WHEN event_id % 2 = 0 THEN 0.90 ELSE 1 END * CASE WHEN event_id % 3 = 0 THEN 1.03 ELSE 1 END, 8) AS s FROM events")
def r14_prior_boost(spark, sf):
    k = F.col("user_id") % 4
    e = table(spark, sf, "events").withColumns({"tag": F.when(k == 0, "risk_factors").when(k == 1, "fwd_statements").when(k == 2, "md&a"), "oy": F.col("event_id") % 2 == 0, "l": F.when(F.col("event_id") % 3 == 0, F.array(F.lit("ORG"))).otherwise(F.array().cast("array<string>"))})
    return e.select("event_id", F.round(S.prior_boost("value", "tag", "oy", "l"), 8).alias("s"))


_HITS = "SELECT o_custkey AS qid, o_orderkey AS id, o_orderpriority AS ticker, o_orderstatus AS form, year(o_orderdate) AS fy, o_totalprice AS score, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders"


def _mode_sql(column: str) -> str:
    return f"SELECT qid, v AS {column} FROM (SELECT qid, lower(CAST({column} AS VARCHAR)) AS v, row_number() OVER (PARTITION BY qid ORDER BY count(*) DESC, min(rank)) AS rn FROM h WHERE rank <= 20 GROUP BY 1, 2) WHERE rn = 1"


@query(
    f"WITH h AS ({_HITS}), t AS ({_mode_sql('ticker')}), f AS ({_mode_sql('form')}), y AS ({_mode_sql('fy')}) SELECT h.id, round(score * CASE WHEN lower(h.ticker) <> t.ticker THEN 0.5 ELSE 1 END * CASE WHEN lower(h.form) <> f.form THEN 0.8 ELSE 1 END * CASE WHEN h.fy <> CAST(y.fy AS INT) THEN 0.9 * pow(2.71828, -0.6 * greatest(0, abs(h.fy - CAST(y.fy AS INT)) - 1)) ELSE 1 END, 7) AS score FROM h JOIN t USING (qid) JOIN f USING (qid) JOIN y USING (qid)"
)
def r15_anchor(spark, sf):
    h = table(spark, sf, "orders").select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("ticker"), F.col("o_orderstatus").alias("form"), F.year("o_orderdate").alias("fy"), F.col("o_totalprice").alias("score"))
    h = ranked(h, ["qid"], [F.desc("score"), "id"])
    return Ev.align(h, ["qid"], "score", "rank").select("id", F.round("score", 7).alias("score"))


@query("SELECT event_id, round(0.6 * (" + _MM.format("value").replace("0.5 END", "0.0 END") + ") + 0.3 * (" + _MM.format("event_id").replace("0.5 END", "0.0 END") + ") + CASE event_id % 3 WHEN 0 THEN 0.23 WHEN 1 THEN -0.15 ELSE 0.0 END, 6) AS score FROM events WINDOW w AS (PARTITION BY user_id)")
def r09_rule_rerank(spark, sf):
    k = F.col("event_id") % 3
    e = table(spark, sf, "events").withColumns({"q": F.lit("gross margin percentage"), "h": F.when(k == 0, "Gross Margin").when(k == 1, "Index").otherwise("x"), "c": F.lit("plain"), "cs": F.when(k == 0, F.array(F.lit("c"))).otherwise(F.array().cast("array<string>"))})
    return S.rule_rerank(e, ["user_id"], "value", "event_id", S.rule_score("q", "h", "c", "cs")).select("event_id", F.round("score", 6).alias("score"))


#: Questions, headings, contents and labels that each rule is hit by, or only just missed.
_Q = ["YoY growth", "sales compared to 2022", "gross margin percentage", "r&d spend", "fx effects", "exchange of shares", "fixed costs", "compared"]
_H = ["Net Sales of Widgets", "Gross Margin", "Operating Expenses", "Signatures", "Index", None, "Cover of Widgets"]
_C = ["more compared to before", "2023 2022 2021", "12% of it", "Research and Development", "in USD", "2023 and 2022", None, "nothing"]


def _pick(values: list, n: str) -> str:
    return "(CASE " + n + "".join(f" WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)) + " END)"


_RULES = f"""SELECT l_orderkey, l_linenumber, lower({_pick(_Q, 'l_orderkey % 8')}) AS q, lower(coalesce({_pick(_H, 'l_partkey % 7')}, '')) AS h, lower(coalesce({_pick(_C, 'l_suppkey % 8')}, '')) AS t, l_linenumber % 2 = 0 AS tagged FROM lineitem"""


@query(
    f"""SELECT l_orderkey, l_linenumber, round(greatest(-0.2, CASE WHEN tagged THEN 0.15 ELSE 0 END + CASE WHEN tagged AND contains(h, 'widgets') THEN 0.05 ELSE 0 END
+ CASE WHEN regexp_matches(q, '\\byoy\\b|year[- ]over[- ]year|compared to 20[0-9][0-9]') AND (contains(t, 'compared to') OR regexp_matches(t, '20[0-9][0-9].*20[0-9][0-9].*20[0-9][0-9]')) THEN 0.08 ELSE 0 END
+ CASE WHEN regexp_matches(q, '\\b(foreign exchange|fx|currency|currencies|usd)\\b') AND regexp_matches(t, 'foreign|currency|usd') THEN 0.08 ELSE 0 END
+ CASE WHEN contains(q, 'gross margin percentage') AND (contains(h, 'gross margin') OR contains(t, '%')) THEN 0.08 ELSE 0 END
+ CASE WHEN contains(q, 'r&d') AND (contains(h, 'operating expenses') OR contains(t, 'research and development')) THEN 0.08 ELSE 0 END
- CASE WHEN regexp_matches(h, 'signature|cover|index') THEN 0.15 ELSE 0 END), 6) AS s FROM ({_RULES})"""
)
def r09_rules(spark, sf):
    """Every rule, for all lines; 'exchange', 'fixed' and 'compared' alone are no intents."""
    one = lambda values, n: F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (F.col(n) % len(values) + 1).cast("int"))
    tagged = F.col("l_linenumber") % 2 == 0
    none = F.array().cast("array<string>")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", one(_Q, "l_orderkey").alias("q"), one(_H, "l_partkey").alias("h"), one(_C, "l_suppkey").alias("t"), F.when(tagged, F.array(F.lit("c"))).otherwise(none).alias("c"), F.when(tagged, F.array(F.lit(""), F.lit(None).cast("string"), F.lit("Widgets"))).otherwise(none).alias("l"))
    return rows.select("l_orderkey", "l_linenumber", F.round(S.rule_score("q", "h", "t", "c", "l"), 6).alias("s"))


_SURFACES = [("widget", "widget"), ("widget", "small gadget"), ("bolt", "bolt"), ("rod", "rod"), ("rod", "iron bar")]
_RELATED = [("widget", "bolt"), ("bolt", "rod")]
_HIT = "SELECT p_partkey AS qid, s.concept FROM part JOIN s ON contains(lower('Which ' || p_name || ' was sold in ' || (2000 + p_size) || ' and 1999'), s.surface)"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)


@query(f"WITH s(concept, surface) AS (VALUES {_values(_SURFACES)}), r(concept, related) AS (VALUES {_values(_RELATED)}), h AS ({_HIT}), c AS (SELECT qid, concept FROM h UNION SELECT qid, related FROM h JOIN r ON h.concept = r.concept), t AS (SELECT qid, surface AS term FROM c JOIN s ON c.concept = s.concept UNION SELECT p_partkey, CAST(2000 + p_size AS VARCHAR) FROM part) SELECT qid, string_agg(term, ',' ORDER BY term) AS terms FROM t GROUP BY 1")
def r10_query_expand(spark, sf):
    q = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("Which "), F.upper("p_name"), F.lit(" was sold in "), (2000 + F.col("p_size")).cast("string"), F.lit(" and 1999")).alias("q"))
    out = S.expand_query(q, "p_partkey", "q", spark.createDataFrame(_SURFACES, "concept string, surface string"), spark.createDataFrame(_RELATED, "concept string, related string"))
    return out.select("qid", F.array_join("terms", ",").alias("terms"))


_PATTERNS = [("widget|bolt", "hardware"), ("^[a-c]", "early"), (r"\brod$", "metal"), ("o{2}", "round"), (r"(red|blue)\s+\w+", "coloured")]


@query(f"WITH p(pattern, term) AS (VALUES {_values(_PATTERNS)}) SELECT p_partkey AS qid, string_agg(DISTINCT term, ',' ORDER BY term) AS terms FROM part JOIN p ON regexp_matches(lower(p_name), p.pattern) GROUP BY 1")
def r11_pattern_expansion(spark, sf):
    p = spark.createDataFrame(_PATTERNS, "pattern string, term string")
    return S.pattern_expansion(table(spark, sf, "part").select("p_partkey", F.initcap("p_name").alias("q")), "p_partkey", "q", p).select("qid", F.array_join("terms", ",").alias("terms"))


def _evidence(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), F.col("source").alias("heading"), F.col("text").alias("content"))
    return _bm25(spark, sf, table(spark, sf, "documents"), 30).join(docs, "doc").select("qid", F.col("doc").alias("id"), "heading", "content", "score")


@query()
def r16_pack(spark, sf):
    return Ev.pack_evidence(_evidence(spark, sf), "qid").select("qid", "pos", "id", F.length("content").alias("n"))


@query()
def r17_pack_coverage(spark, sf):
    return Ev.pack_evidence(_evidence(spark, sf), "qid", coverage=True).select("qid", "pos", "id")


@query()
def r18_block(spark, sf):
    return Ev.evidence_block(Ev.pack_evidence(_evidence(spark, sf), "qid"), "qid").select("qid", F.length("block").alias("n"))


@query("SELECT event_id FROM (SELECT event_id, sum(event_id % 50) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS used FROM events) WHERE used <= 240")
def w12_running_budget(spark, sf):
    return Ev.running_budget(table(spark, sf, "events").withColumn("n", F.col("event_id") % 50), ["user_id"], ["ts", "event_id"], "n", 240).select("event_id")


@query()
def r01_embed(spark, sf):
    return S.embed_texts(table(spark, sf, "benchmark"), "text", 16).select("item_id", F.round(F.sqrt(inner_product("embedding", "embedding")), 4).alias("norm"))


@query(
    """WITH RECURSIVE e AS (SELECT event_id, user_id, event_id % 50 AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT user_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS used, CAST(NULL AS BIGINT) AS took FROM (SELECT DISTINCT user_id FROM events)
UNION ALL SELECT r.user_id, e.i, CASE WHEN used + n <= 240 THEN used + n ELSE used END, CASE WHEN used + n <= 240 THEN e.event_id END FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1)
SELECT user_id, took AS event_id FROM r WHERE took IS NOT NULL"""
)
def w12_accept_if_fits(spark, sf):
    """Each row is taken if it still fits; later, smaller ones may fit where one did not."""
    return Ev.accept_if_it_fits(table(spark, sf, "events").withColumn("n", F.col("event_id") % 50), ["user_id"], ["ts", "event_id"], "n", 240, ["event_id"]).select("user_id", "event_id")
