"""Stages, index and the question path from pages to evidence."""

import pytest
from pyspark.sql import functions as F

from siltstone.functions import filing
from siltstone.operators import search
from siltstone.plans import runner
from siltstone.session import written


def test_pages_to_evidence(spark):
    pages = spark.createDataFrame([(1, "<h1>Item 1A. Risk</h1><p>Revenue of Contoso Holdings Inc. (CTSO) rose 5%. Costs fell.</p>"), (2, "<h2>Notes</h2><p>Nothing about fish.</p>"), (3, None)], "page_id long, html string")
    index = runner.run(pages).persist()
    assert index.select("id").distinct().count() == index.count() == 2
    q = spark.createDataFrame([(1, "What about Contoso revenue?")], "qid int, query string")
    hits = runner.search_index(index, q).collect()
    assert hits[0].doc == "1::text::chunk-0" and [h.rank for h in hits] == list(range(1, len(hits) + 1))
    packed = runner.evidence_for(index, runner.search_index(index, q), budget=4000)
    assert packed.count() >= 1
    cites = spark.createDataFrame([("1::text::chunk-0", "x" * 300), ("9", "y"), ("1::text::chunk-0", " ")], "id string, quote string")
    assert [len(r.quote) for r in runner.guarded_citations(cites, packed).collect()] == [244]
    assert runner.query_entities(q.withColumn("query", F.lit("Is (CTSO) EBITDA up?")), "qid", "query").first().tickers == ["CTSO"]


def test_every_stage_of_the_index_shows(spark, tmp_path):
    """vectors are made and returned, of repeated ids one row stays, and a title that A23 filled is not lost."""
    from siltstone.operators.search import hashed_embedding
    from siltstone.plans.corpus_queries import r02_build_index

    docs = [(1, "Alpha beta gamma.", "src0"), (2, "Net sales rose by five percent.", "src3"), (3, "Delta epsilon.", "src5")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["id"]: r for r in r02_build_index(spark, str(tmp_path)).collect()}
    assert sorted(got) == [f"{d}::text::chunk-0" for d, _, _ in docs]
    for d, text, _ in docs:
        r = got[f"{d}::text::chunk-0"]
        assert r["snippet"] == text and r["embedding"] == hashed_embedding([f"{r['title']}\n\n{text}"], 64)[0].tolist()
    rows = spark.createDataFrame([("a", "text", None, None, "final", 1), ("a", "text", None, "Given", "other", 2), ("b", "more", "Head", None, "x", 1)], "id string, content string, heading string, title string, path string, at int")
    assert {r["id"]: r["title"] for r in runner.build_index(rows, path="path", modified="at").collect()} == {"a": "Given", "b": "Head"}


def test_stage_lists():
    assert runner.parse_stage_list("chunk, parse") == ["parse", "chunk"] and runner.parse_stage_list("all") == runner.STAGES
    with pytest.raises(ValueError):
        runner.parse_stage_list("parse,nope")


def test_what_paths_say(spark):
    df = spark.createDataFrame([("/d/AAPL/10-K/0000320193-23-000106/aapl-20230930.htm",), ("x",)], "p string")
    a, b = df.select(filing.sniff_meta("p"), filing.meta_from_parents("p"), filing.filing_guess("p")).collect()
    assert tuple(a[0]) == ("0000320193-23-000106", "10-K", "20230930", "AAPL", 2023, "Q3")
    assert tuple(a[1]) == ("AAPL", "10-K", "0000320193-23-000106") and a[2].accno == "0000320193-23-000106"
    assert b[0].accno is None and b[1].form is None


def test_headers(spark):
    df = spark.createDataFrame([("Sales", "in millions of yen")], "h string, t string").withColumn("u", filing.unit_and_currency(F.col("h"), F.col("t")))
    assert df.select(filing.humanize_header("h", F.col("u.unit"), F.col("u.currency"))).first()[0] == "Sales (JPY, millions)"


def test_many_questions_meet_shared_lists(spark):
    """the same hits as from lists of each question by itself, ties, odd questions and questions without words included."""
    word = lambda c, n, seed: F.concat(F.lit("w"), F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(n)).cast("string"))
    text = lambda n: F.concat_ws(" ", F.lit("common"), word("id", 4, 1), word("id", 7, 2), F.when(F.col("id") % 3 > 0, word("id", n, 3)), word("id", n, 4))
    docs = spark.range(300).select(F.concat(F.lit("d"), "id").alias("id"), F.when(F.col("id") % 50 > 0, text(90)).alias("content"))
    index = search.embed_texts(docs, "content", 4)
    asked = spark.range(120).select(F.col("id").alias("qid"), F.when(F.col("id") % 40 == 7, F.lit("")).when(F.col("id") % 40 == 8, F.lit(None)).when(F.col("id") % 40 == 9, word("id", 90, 3)).otherwise(text(110)).alias("query"))
    for candidates, most, k in ((5, 8, 3), (40, 30, 8)):
        one, many = ([(r["qid"], r["rank"], r["doc"], round(r["rrf"], 9), round(r["ce"], 9), round(r["final_score"], 9)) for r in runner.search_index(index, asked, k=k, candidates=candidates, ce_candidates=most, size=4, held=held).orderBy("qid", "rank").collect()] for held in (search.HELD, 0))
        assert one == many and len(one) > 300


def test_many_questions_make_no_row_for_each_candidate(spark):
    """what is shuffled grows with the questions, not with their hits."""
    from tests.test_growth import records_shuffled

    n, hits = 1000, 100
    docs = spark.range(n).select(F.concat(F.lit("d"), "id").alias("id"), F.concat(F.lit("a plain text number"), "id").alias("content"))
    index = written(search.embed_texts(docs, "content", 4), "index")
    asked = spark.range(n).select(F.col("id").alias("qid"), F.concat(F.lit("what text has number"), "id").alias("query"))
    before = records_shuffled(spark)
    found = {r["qid"]: r["doc"] for r in runner.search_index(index, asked, k=1, candidates=hits, size=4, held=0).collect()}
    assert found == {i: f"d{i}" for i in range(n)}
    assert records_shuffled(spark) - before < n * hits
