"""Queries of text, number, period and nested functions: inputs made from columns, so that they differ by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import filing, fiscal, nested, numeric
from siltstone.functions import text as X
from siltstone.operators import chunking as C
from siltstone.operators import facts as Fx
from siltstone.operators import html_blocks as Hb
from siltstone.operators import search as S
from siltstone.operators.evidence import signature
from siltstone.operators.filters import is_textblock
from siltstone.plans.catalogue import query
from siltstone.plans.table_queries import table


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _pick(k: Column, *values) -> Column:
    """values[k], as a column."""
    return F.element_at(F.array(*(v if isinstance(v, Column) else F.lit(v) for v in values)), (k + 1).cast("int"))


@query("SELECT p_partkey, 'R&D <' || p_name || '> $' || p_size || ' ©' AS t FROM part")
def f02_unescape(spark, sf):
    t = F.concat(F.lit("R&amp;D &lt;"), "p_name", F.lit("&gt; &#36;"), _s("p_size"), F.lit(" &copy;"))
    return table(spark, sf, "part").select("p_partkey", C.unescaped(t).alias("t"))


@query("SELECT p_partkey, '-- * ' || p_name || ' [x] ' || p_size || ' [ ]' AS t FROM part")
def f03_to_ascii(spark, sf):
    t = F.concat(F.lit("—– • "), "p_name", F.lit(" ☒ "), _s("p_size"), F.lit(" ☐"))
    return table(spark, sf, "part").select("p_partkey", X.to_ascii(t).alias("t"))


@query("SELECT doc_id, len(t) AS n, array_to_string(list_slice(t, 1, 5), ' ') AS first FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[A-Za-z0-9%$€¥£./\\-]+') AS t FROM documents)")
def f06_mapping_tokens(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", X.mapping_tokens("text").alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n"), F.array_join(F.slice("t", 1, 5), " ").alias("first"))


_STOP_E = ", ".join(f"'{w}'" for w in X.EVIDENCE_STOPWORDS)


@query(f"SELECT doc_id, len(list_distinct(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[A-Za-z0-9_\\x{{4e00}}-\\x{{9fff}}]+'), lambda t: NOT list_contains([{_STOP_E}], t)))) AS n FROM documents")
def f07_word_set(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(X.word_set("text")).cast("long").alias("n"))


_LINES = "SELECT doc_id, z[2] AS line, z[1] AS t FROM (SELECT doc_id, unnest(list_zip(string_split(text, chr(10)), range(len(string_split(text, chr(10)))))) AS z FROM documents)"


def _lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t")).withColumn("line", F.col("line").cast("long"))


_HEADING = "(regexp_matches(s, '(?i)^note\\s+\\d+\\b') OR (upper(s) = s AND lower(s) <> s AND length(s) BETWEEN 3 AND 70) OR regexp_matches(s, '(?i)^item\\s+\\d+[a-z]?\\b') OR regexp_matches(s, '^[A-Z][A-Za-z0-9&,\\-\\s]{0,70}$'))"


@query(f"SELECT doc_id, line FROM (SELECT doc_id, line, trim(t, ' ') AS s FROM ({_LINES})) WHERE {_HEADING}")
def f09_headings(spark, sf):
    return _lines(spark, sf).where(X.is_probable_heading("t")).select("doc_id", "line")


_NOISE = "(s = '' OR regexp_full_match(s, '[^A-Za-z0-9\\x{80}-\\x{10ffff}]+'))"


@query(f"SELECT doc_id, line, {_NOISE} AS plain, {_NOISE} OR (NOT {_HEADING.replace('(upper(s) = s AND lower(s) <> s AND length(s) BETWEEN 3 AND 70)', '(upper(trim(s)) = trim(s) AND lower(trim(s)) <> trim(s) AND length(trim(s)) BETWEEN 3 AND 70)')} AND (length(s) < 25 AND NOT regexp_matches(s, '\\d') OR regexp_matches(s, '(?i)^\\s*(table\\s+of\\s+contents|contents|index|page\\s+\\d+)\\s*$'))) AS noise FROM (SELECT doc_id, line, trim(t, ' ') AS s FROM ({_LINES}))")
def p08_noise_lines(spark, sf):
    return _lines(spark, sf).withColumn("s", F.trim("t")).select("doc_id", "line", X.is_noise_line("s").alias("plain"), X.is_noise_line("s", retrieval_only=False).alias("noise"))


_SHORT = "CASE doc_id % 5 WHEN 0 THEN 'Form 10-K' WHEN 1 THEN '(' || doc_id || ')' WHEN 2 THEN 'Washington, D.C. ' || doc_id ELSE substr(text, 1, 40) END"


@query(f"SELECT doc_id, trim(s) <> '' AND NOT regexp_matches(trim(s), '^[\\d.,()$%\\s-]{{1,12}}$') AND NOT regexp_matches(trim(s), '(?i)^(form\\s+(10-k|10-q|8-k|20-f)|table of contents|index|signatures?)$') AND NOT (regexp_matches(trim(s), '(?i)^washington,?\\s+d\\.?c\\.?.*$') AND length(trim(s)) <= 30) AS keep FROM (SELECT doc_id, {_SHORT} AS s FROM documents)")
def p09_keep_for_search(spark, sf):
    k = F.col("doc_id") % 5
    s = F.when(k == 0, "Form 10-K").when(k == 1, F.concat(F.lit("("), _s("doc_id"), F.lit(")"))).when(k == 2, F.concat(F.lit("Washington, D.C. "), _s("doc_id"))).otherwise(F.substring("text", 1, 40))
    return table(spark, sf, "documents").select("doc_id", X.keep_for_search(s).alias("keep"))


@query("SELECT p_partkey, p_partkey % 3 = 0 AS t, p_partkey % 4 IN (1, 2) OR p_partkey % 4 = 3 AS pct FROM part")
def p11_p12_predicates(spark, sf):
    k = F.col("p_partkey") % 4
    d = table(spark, sf, "part").withColumn("c", F.concat(F.lit("us-gaap:"), F.translate("p_name", " ", ""), F.when(F.col("p_partkey") % 3 == 0, "PolicyTextBlock").otherwise("")))
    return d.select("p_partkey", is_textblock("c").alias("t"), numeric.is_percent(F.when(k == 1, "percent"), F.when(k == 2, "5%").otherwise("5"), F.when(k == 3, "x:RatePercentage").otherwise("x")).alias("pct"))


_FN = "CASE o_orderkey % 3 WHEN 0 THEN 'US_abc_' || year(o_orderdate) || '_10-k_0000000001-24-' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || '_' || strftime(o_orderdate, '%Y%m%d') || '.htm' WHEN 1 THEN 'US_x.y' || o_custkey || '_' || year(o_orderdate) || '_10-Q_odd' || o_orderkey || '.HTML' ELSE 'note' || o_orderkey || '.txt' END"


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'ABC' WHEN 1 THEN 'X.Y' || o_custkey END AS ticker, CASE WHEN o_orderkey % 3 < 2 THEN year(o_orderdate) END AS year, CASE o_orderkey % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' END AS form, CASE o_orderkey % 3 WHEN 0 THEN '0000000001-24-' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') WHEN 1 THEN 'odd' || o_orderkey END AS accno, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y%m%d') END AS doc_date, CASE o_orderkey % 3 WHEN 0 THEN 'htm' WHEN 1 THEN 'html' END AS ext FROM orders")
def f11_file_names(spark, sf):
    k, y = F.col("o_orderkey") % 3, F.year("o_orderdate").cast("string")
    strict = F.concat(F.lit("US_abc_"), y, F.lit("_10-k_0000000001-24-"), F.lpad(_s("o_custkey"), 6, "0"), F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".htm"))
    loose = F.concat(F.lit("US_x.y"), _s("o_custkey"), F.lit("_"), y, F.lit("_10-Q_odd"), _s("o_orderkey"), F.lit(".HTML"))
    name = F.when(k == 0, strict).when(k == 1, loose).otherwise(F.concat(F.lit("note"), _s("o_orderkey"), F.lit(".txt")))
    return table(spark, sf, "orders").select("o_orderkey", X.meta_from_filename(name).alias("m")).select("o_orderkey", "m.*")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'C' || o_custkey END AS ticker, CASE WHEN o_orderkey % 2 = 0 THEN '10-Q' END AS form, CASE WHEN o_orderkey % 2 = 0 THEN 'a' || o_orderkey END AS accno FROM orders")
def f13_meta_from_parents(spark, sf):
    p = F.concat(F.lit("/data/c"), _s("o_custkey"), F.when(F.col("o_orderkey") % 2 == 0, "/10-q/a").otherwise("/other/a"), _s("o_orderkey"), F.lit("/x.xml"))
    return table(spark, sf, "orders").select("o_orderkey", filing.meta_from_parents(p).alias("m")).select("o_orderkey", "m.ticker", "m.form", "m.accno")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'ABC' ELSE 'C' || o_custkey END AS ticker, '10-K' AS form, CASE WHEN o_orderkey % 2 = 0 THEN '0000000001-24-000001' ELSE 'z' || o_orderkey END AS accno FROM orders")
def f15_loose_meta(spark, sf):
    even = F.col("o_orderkey") % 2 == 0
    p = F.when(even, F.lit("/d/abc-0000000001-24-000001-10-K.xml")).otherwise(F.concat(F.lit("/c"), _s("o_custkey"), F.lit("/10-K/z"), _s("o_orderkey"), F.lit("/9.xml")))
    return table(spark, sf, "orders").select("o_orderkey", filing.coalesced_meta(p).alias("m")).select("o_orderkey", "m.ticker", "m.form", "m.accno")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '1-' || o_custkey END AS accno, 'ABC' AS ticker FROM orders")
def f16_filing_guess(spark, sf):
    p = F.concat(F.when(F.col("o_orderkey") % 2 == 0, F.lit("/d/1-")).otherwise(F.lit("/d/1_")), _s("o_custkey"), F.lit("/abc"), _s("o_orderkey"), F.lit(".xml"))
    return table(spark, sf, "orders").select("o_orderkey", filing.filing_guess(p).alias("m")).select("o_orderkey", "m.accno", "m.ticker")


@query("SELECT p_partkey, p_size % 4 + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS n, p_size % 3 = 0 AS marker FROM part")
def f21_f22_markers(spark, sf):
    tags = F.repeat(F.lit("us-gaap:Cash "), (F.col("p_size") % 4).cast("int"))
    t = F.concat(tags, "p_name", F.when(F.col("p_partkey") % 2 == 0, " iso4217:USD").otherwise(" xiso4217:USD"))
    line = F.when(F.col("p_size") % 6 == 0, "[TABLE 1 of 2]").when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit(" were as follows"))).otherwise(F.concat(F.lit("as follows "), "p_name"))
    return table(spark, sf, "part").select("p_partkey", X.count_fact_tokens(t).cast("long").alias("n"), X.is_table_marker(line).alias("marker"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE 'NA' END AS no, CAST(p_size % 2 + p_size % 3 % 2 AS INT) AS priority FROM part")
def f23_f24_ids_and_paths(spark, sf):
    rid = F.concat(F.lit("0000000001-24-000001::text::chunk-"), _s("p_size"), F.when(F.col("p_size") % 2 == 0, "").otherwise("x"))
    path = F.concat(F.lit("/a/"), F.when(F.col("p_size") % 2 == 1, "Latest/").otherwise("old/"), F.when(F.col("p_size") % 3 == 1, "final.jsonl").otherwise("x.jsonl"))
    return table(spark, sf, "part").select("p_partkey", X.chunk_number(rid).alias("no"), X.path_priority(path).cast("int").alias("priority"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN upper(p_name) WHEN 2 THEN 'ALPHABET INC' ELSE p_name END AS name FROM part")
def f26_normalize_entity(spark, sf):
    k = F.col("p_partkey") % 4
    t = F.when(k == 0, F.concat("p_name", F.lit(" Corp."))).when(k == 2, F.lit("Google")).otherwise(F.concat(F.lit(" "), "p_name", F.lit(" ")))
    return table(spark, sf, "part").select("p_partkey", X.normalize_entity(t, _pick(k, "ORG", "PERSON", "ORG", "DATE")).alias("name"))


@query("SELECT s_suppkey, upper(s_name) || ' HOLDINGS INC|' || upper(s_name) || '|T' || s_suppkey || '|' || upper(s_name) || ' HOLDINGS' AS v FROM supplier")
def f27_name_variants(spark, sf):
    v = X.name_variants(F.concat("s_name", F.lit(" Holdings Inc")), F.concat(F.lit("t"), _s("s_suppkey")))
    return table(spark, sf, "supplier").select("s_suppkey", F.array_join(v, "|").alias("v"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '1e6' WHEN 1 THEN '1e3' WHEN 2 THEN '1e9' END AS unit, CASE p_partkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'JPY' WHEN 2 THEN 'EUR' ELSE 'GBP' END AS currency FROM part")
def f32_unit_and_currency(spark, sf):
    k = F.col("p_partkey") % 4
    near = F.when(k == 0, F.concat("p_name", F.lit(" ($ in Millions)"))).when(k == 1, "thousands of yen").otherwise(F.col("p_name"))
    far = F.when(k == 2, "in billion euros").when(k == 3, "£ only").otherwise("thousand pounds")
    return table(spark, sf, "part").select("p_partkey", filing.unit_and_currency(near, far).alias("u")).select("p_partkey", "u.unit", "u.currency")


@query("SELECT p_partkey, 'us-gaap:' || replace(p_name, ' ', '_') AS q FROM part")
def f35_locator_qname(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.locator_qname(F.concat(F.lit("a/b.xsd#us-gaap_"), F.translate("p_name", " ", "_"))).alias("q"))


@query("SELECT doc_id, greatest(1, length(coalesce(text, '')) // 4) AS n FROM documents")
def f40_token_estimate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.approximate_tokens("text").cast("long").alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events")
def f41_safe_json(spark, sf):
    c = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("{oops"), "props")).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", filing.json_or_null(c, "k long").alias("j")).select("event_id", "j.k")


@query("SELECT p_partkey AS doc, 'p' AS tag, p_name || ' is the text' AS text, '/html[1]/body[1]/section[1]/p[' || CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END || ']' AS xpath, 'part' || p_partkey AS page_anchor, CASE WHEN p_size % 2 = 0 THEN p_size END AS page_no FROM part UNION ALL SELECT p_partkey, 'p', 'Page ' || p_size, '/html[1]/body[1]/section[1]/p[1]', 'part' || p_partkey, NULL FROM part WHERE p_size % 2 = 0")
def f42_selectors(spark, sf):
    h = F.concat(F.lit("<html><body><section id='part"), _s("p_partkey"), F.lit("'>"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("<p>Page "), _s("p_size"), F.lit("</p>"))).otherwise(""), F.lit("<p>"), "p_name", F.lit(" is the text</section></body></html>"))
    return Hb.html_blocks(table(spark, sf, "part").select("p_partkey", h.alias("h")), "p_partkey", "h").select("doc", "tag", "text", "xpath", "page_anchor", "page_no")


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || ' en' WHEN 1 THEN p_name || ' us' ELSE p_name || ' de' END AS label FROM part")
def f43_label_by_language(spark, sf):
    k = F.col("p_partkey") % 3
    item = lambda lang, end: F.struct(F.lit(lang).alias("lang"), F.concat("p_name", F.lit(" " + end)).alias("v"))
    items = F.when(k == 0, F.array(item("de", "de"), item("en-US", "us"), item("en", "en"))).when(k == 1, F.array(item("de", "de"), item("en-GB", "gb"), item("en-US", "us"))).otherwise(F.array(item("de", "de"), item("fr", "fr")))
    return table(spark, sf, "part").select("p_partkey", nested.best_by_rank(items, "v", "lang", ["en", "en-US", "en-GB"]).alias("label"))


@query("SELECT o_orderkey, ['instant', 'duration', NULL][o_orderkey % 3 + 1] AS t, strftime(o_orderdate, '%Y-%m-%d') AS d, o_custkey % 5 AS q FROM orders")
def f44_f74_f76_periods(spark, sf):
    k, d = F.col("o_orderkey") % 3, fiscal.iso_date("o_orderdate")
    t = fiscal.period_type(F.when(k == 1, d), F.when(k > 0, d), F.when(k == 0, d))
    return table(spark, sf, "orders").select("o_orderkey", t.alias("t"), d.alias("d"), fiscal.quarter_number(F.concat(F.lit("FQ"), (F.col("o_custkey") % 5).cast("string"), F.lit("x9"))).cast("long").alias("q"))


@query("SELECT o_custkey, fy, fq FROM (SELECT o_custkey, year(o_orderdate) AS fy, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS fq, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1")
def f45_first_record(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("fy"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("fq"))
    return Fx.first_record(o, ["o_custkey"], "o_orderkey", ["fy", "fq"])


_N = "CASE p_partkey % 3 WHEN 0 THEN [p_size + 0.5] WHEN 1 THEN [(p_size + 0.5) * 1e6, CAST(p_partkey AS DOUBLE)] ELSE [3.0, 1250.0 * 1000] END"


@query(f"SELECT p_partkey, list_transform({_N}, lambda x: CAST(x AS DOUBLE)) AS v, CASE p_partkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' END AS currency, CASE p_partkey % 3 WHEN 1 THEN 'million' END AS scale FROM part")
def f50_number_tokens(spark, sf):
    k, n = F.col("p_partkey") % 3, _s("p_size")
    t = F.when(k == 0, F.concat(F.lit("Rule 10b-5 and Section "), n, F.lit("(a): €"), n, F.lit(".5 more"))).when(k == 1, F.concat(F.lit("Item "), n, F.lit(" paid $"), n, F.lit(".5 million, ("), _s("p_partkey"), F.lit(")"))).otherwise("within 3 m of six months of the plan that was made here 1,250 K")
    d = table(spark, sf, "part").select("p_partkey", numeric.number_tokens(t).alias("n"))
    return d.select("p_partkey", F.transform("n", lambda x: x["value"]).alias("v"), F.col("n")[0]["currency"].alias("currency"), F.col("n")[0]["scale_used"].alias("scale"))


@query("SELECT p_partkey, substr(t, greatest(pos - 30, 0) + 1, pos + length(m) + 30 - greatest(pos - 30, 0)) AS w, p_size % 2 = 0 AS near_date FROM (SELECT p_partkey, p_size, 'The ' || p_name || ' was sold for $' AS head, '$' || p_size || '.25 billion' AS m, length(p_name) + 18 AS pos, 'The ' || p_name || ' was sold for $' || p_size || '.25 billion on ' || CASE WHEN p_size % 2 = 0 THEN 'June 5, 2023' ELSE 'some day in summer' END || ', as was said before' AS t FROM part)")
def w10_number_window(spark, sf):
    t = F.concat(F.lit("The "), "p_name", F.lit(" was sold for $"), _s("p_size"), F.lit(".25 billion on "), F.when(F.col("p_size") % 2 == 0, "June 5, 2023").otherwise("some day in summer"), F.lit(", as was said before"))
    d = table(spark, sf, "part").select("p_partkey", F.element_at(numeric.number_tokens(t), 1).alias("n"))
    return d.select("p_partkey", F.col("n.window").alias("w"), F.col("n.near_date").alias("near_date"))


@query("SELECT p_partkey, round(ln((1000 - p_size + 0.5) / (p_size + 0.5) + 1), 9) AS idf, round(p_size * 2.5 / (p_size + 1.5 * (1 - 0.75 + 0.75 * p_partkey / (40.0 + 1e-9)) + 1e-12), 9) AS tf FROM part")
def f59_bm25_weights(spark, sf):
    idf = numeric.bm25_idf(F.lit(1000), F.col("p_size"))
    return table(spark, sf, "part").select("p_partkey", F.round(idf, 9).alias("idf"), F.round(numeric.bm25_tf(F.col("p_size"), F.col("p_partkey"), F.lit(40.0)), 9).alias("tf"))


@query("SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 9) AS j FROM (SELECT p_partkey, list_distinct([p_size % 3, p_size % 5, 7]) AS a, list_distinct([p_size % 4, p_size % 5, 9]) AS b FROM part)")
def f63_jaccard(spark, sf):
    m = lambda *n: F.array_distinct(F.array(*(F.col("p_size") % x if x < 7 else F.lit(x) for x in n)))
    return table(spark, sf, "part").select("p_partkey", F.round(numeric.jaccard(m(3, 5, 7), m(4, 5, 9)), 9).alias("j"))


@query("SELECT p_partkey, CASE WHEN p_size % 4 > 0 THEN round_even(p_partkey * 100.0 / (p_size % 4), 2) ELSE 0 END AS r FROM part")
def f65_finite_ratio(spark, sf):
    return table(spark, sf, "part").select("p_partkey", numeric.finite_ratio(F.col("p_partkey"), F.col("p_size") % 4).alias("r"))


@query("SELECT doc_id, sha256(text) AS content, sha1('x|' || array_to_string(list_slice(list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> ''), 1, 80), ' ')) AS sig FROM documents")
def f66_hashes(spark, sf):
    d = table(spark, sf, "documents").withColumn("salt", F.lit("x"))
    return d.select("doc_id", F.sha2("text", 256).alias("content"), signature("text", "salt").alias("sig"))


@query("SELECT p_partkey, ['instant', 'duration', 'none'][p_partkey % 3 + 1] AS kind, CASE p_partkey % 3 WHEN 0 THEN '2024-12-31' END AS instant, CASE p_partkey % 3 WHEN 1 THEN '2024-01-01' END AS period_start FROM part")
def f77_fact_period(spark, sf):
    k = F.col("p_partkey") % 3
    period = F.when(k == 0, "<instant>2024-12-31</instant>").when(k == 1, "<startDate>2024-01-01</startDate><endDate>2024-12-31</endDate>").otherwise("<forever/>")
    x = F.concat(F.lit('<xbrl xmlns:g="http://g"><context id="c"><period>'), period, F.lit('</period></context><g:Cash contextRef="c">'), _s("p_size"), F.lit("</g:Cash></xbrl>"))
    f = Fx.xbrl_facts(table(spark, sf, "part").select("p_partkey", x.alias("x")), "p_partkey", "x")
    return f.select("p_partkey", F.coalesce(fiscal.period_type(F.col("period_start"), F.col("period_end"), F.col("instant")), F.lit("none")).alias("kind"), "instant", "period_start")


@query("SELECT o_custkey, min(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END) AS ticker, min(CASE WHEN o_orderkey % 4 = 1 THEN CAST(year(o_orderdate) AS VARCHAR) END)::INT AS fy, min(CASE WHEN o_orderkey % 4 = 2 THEN '12-3' || o_orderkey % 2 END) AS fye FROM orders GROUP BY 1")
def f78_dei(spark, sf):
    k = F.col("o_orderkey") % 4
    o = table(spark, sf, "orders").select("o_custkey", _pick(k, "dei:TradingSymbol", "dei:DocumentFiscalYearFocus", "dei:CurrentFiscalYearEndDate", "x:Other").alias("c"), F.when(k == 0, F.col("o_orderpriority")).when(k == 1, F.year("o_orderdate").cast("string")).otherwise(F.concat(F.lit("--12-3"), (F.col("o_orderkey") % 2).cast("string"))).alias("v"))
    return Fx.dei(o, ["o_custkey"], "c", "v").select("o_custkey", "ticker", "fy", "fye")


@query("SELECT o_orderkey, CAST(make_date(year(o_orderdate), 1, 1) AS VARCHAR) AS a, CAST(make_date(year(o_orderdate) + 1, 1, 1) AS VARCHAR) AS b FROM orders")
def f79_year_bounds(spark, sf):
    d = table(spark, sf, "orders").select("o_orderkey", fiscal.year_bounds(F.year("o_orderdate")).alias("y"))
    return d.select("o_orderkey", F.col("y.first").cast("string").alias("a"), F.col("y.next").cast("string").alias("b"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def f81_dims_from_json(spark, sf):
    return table(spark, sf, "events").select("event_id", nested.dims_from_json("props").alias("m")).select("event_id", F.col("m")["k"].alias("k"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'own' ELSE 'flat' END AS start_date, CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_name END AS instant FROM part")
def f82_context_backfill(spark, sf):
    own, none = F.col("p_size") % 2 == 0, F.lit(None).cast("string")
    context = F.struct(F.struct(F.when(own, "own").alias("start_date"), none.alias("end_date"), none.alias("instant")).alias("period"))
    p = table(spark, sf, "part").select("p_partkey", filing.context_of(context, F.lit("flat"), none, F.col("p_name")).alias("p"))
    return p.select("p_partkey", "p.start_date", "p.instant")


@query("SELECT p_partkey, 'A:Axis=' || p_brand || ';B:Axis=' || p_type AS dims FROM part")
def f83_dims_list(spark, sf):
    m = F.create_map(F.lit("B:Axis"), "p_type", F.lit("A:Axis"), "p_brand")
    d = table(spark, sf, "part").select("p_partkey", nested.dims_list(m).alias("d"))
    return d.select("p_partkey", F.array_join(F.transform("d", lambda x: F.concat(x["dimension"], F.lit("="), x["member"])), ";").alias("dims"))


@query("SELECT p_partkey, CASE WHEN p_size % 10 <= 5 THEN '0-' || greatest(5, p_size % 10 + 3) || ',20-22' ELSE '0-5,' || p_size % 10 || '-' || (p_size % 10 + 3) || ',20-22' END AS spans, p_size % 10 <= 4 OR (p_size % 10 > 5 AND 4 >= p_size % 10) OR 4 < 5 AS inside FROM part")
def f84_spans(spark, sf):
    at = (F.col("p_size") % 10).cast("int")
    span = lambda a, b: F.struct(F.lit(a).cast("int").alias("start") if isinstance(a, int) else a.alias("start"), F.lit(b).cast("int").alias("end") if isinstance(b, int) else b.alias("end"))
    merged = nested.merge_spans(F.array(span(20, 22), span(at, at + 3), span(0, 5)))
    d = table(spark, sf, "part").select("p_partkey", merged.alias("m"))
    return d.select("p_partkey", F.array_join(F.transform("m", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"), nested.inside_spans(F.lit(4), F.col("m")).alias("inside"))


@query("SELECT p_partkey, len(string_split(regexp_replace(t, '([.|?!:;-])\\s+', '\\1' || chr(10), 'g'), chr(10))) AS n FROM (SELECT p_partkey, p_name || '. Then ' || p_brand || '; and | or - so ' || p_size || ': end' AS t FROM part)")
def t06_evidence_sentences(spark, sf):
    t = F.concat("p_name", F.lit(". Then "), "p_brand", F.lit("; and | or - so "), _s("p_size"), F.lit(": end"))
    return table(spark, sf, "part").select("p_partkey", F.size(X.evidence_sentences(t)).cast("long").alias("n"))


_BEST = "list_transform(range(1, greatest(1, len(w) - 80 + 1) + 1), lambda i: list_sum(list_slice(h, i, i + 79)))"


@query(f"""
WITH d AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents),
h AS (SELECT *, list_transform(w, lambda x: CASE WHEN list_has_any(regexp_extract_all(lower(x), '[A-Za-z0-9%$€¥£.\\-]+'), ['thion', 'ening']) THEN 1 ELSE 0 END) AS h FROM d),
b AS (SELECT *, {_BEST} AS s FROM h)
SELECT doc_id, md5(CASE WHEN length(text) <= 500 THEN text ELSE substr(array_to_string(list_slice(w, list_position(s, list_max(s)), list_position(s, list_max(s)) + 79), ' '), 1, 500) END) AS m FROM b""")
def w11_f39_best_snippet(spark, sf):
    d = table(spark, sf, "documents").withColumn("q", F.lit("thion ening and"))
    return d.select("doc_id", F.md5(S.best_snippet("text", "q")).alias("m"))
