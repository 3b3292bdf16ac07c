"""What queries send and hold does not grow faster than their tables."""

from collections.abc import Iterator

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import search as S
from siltstone.session import BATCH_BYTES, SETTINGS, bound_batches


def records_shuffled(spark) -> int:
    """Rows that all stages of this session have written to shuffles so far."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_embeddings_keep_doubles_if_asked(spark):
    """F6."""
    unit = lambda texts, size: np.array([[len(t), 1.0, 1.0][:size] / np.sqrt(len(t) ** 2 + 2.0) for t in texts])
    df = spark.createDataFrame([("abcdefg",), (None,)], "t string")
    assert [r["embedding"][0] for r in S.embed_texts(df, "t", 3, unit, T.DoubleType()).collect()] == [7 / np.sqrt(51.0), 0.0]
    assert S.embed_texts(df, "t", 3, unit).schema["embedding"].dataType == T.ArrayType(T.FloatType())


def test_related_concepts_without_surface_meet_no_query(spark):
    """F2."""
    n = 1000
    queries = spark.range(n).select(F.col("id").alias("qid"), F.lit("sales in Peru of 2023").alias("q"))
    surfaces = spark.createDataFrame([("c", "peru"), ("r", "america"), ("c", None)], "concept string, surface string")
    related = spark.range(n).select(F.lit("c").alias("concept"), F.col("id").cast("string").alias("related")).union(spark.createDataFrame([("c", "r")], "concept string, related string"))
    before = records_shuffled(spark)
    out = S.expand_query(queries, "qid", "q", surfaces, related).collect()
    assert {tuple(r["terms"]) for r in out} == {("2023", "america", "peru")} and len(out) == n
    assert records_shuffled(spark) - before < 20 * n


def test_batches_to_python_are_bounded_by_bytes(spark):
    """F4, F5, F15, F18 to F22."""
    had = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, "123m")
    try:
        bound_batches(spark, True)
        assert spark.conf.get(BATCH_BYTES) == SETTINGS[BATCH_BYTES]
        sizes = F.pandas_udf(lambda s: s.map(lambda _, n=len(s): n), "int")
        seen = spark.range(0, 2000, 1, 1).select(sizes(F.repeat(F.lit("x"), 10_000)).alias("n")).agg(F.max("n")).first()[0]
        assert seen < 500
        bound_batches(spark, False)
        assert spark.conf.get(BATCH_BYTES) == "123m"
    finally:
        spark.conf.set(BATCH_BYTES, had)


def test_pivots_are_sampled_without_the_whole_table(spark):
    """the same rows as by ordering all, and some even where all rows are alike."""
    from siltstone.llm.hard_negatives import sampled

    rows = spark.range(20_000).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v")).repartition(16)
    some = sampled(rows, 20_000, 100)
    assert some == rows.select("v", F.xxhash64("v", "id").alias("h")).orderBy("h", "v").limit(100).collect()
    alike = spark.range(5_000).select(F.lit(7).cast("long").alias("id"), F.array(F.lit(2.0)).alias("v"))
    assert {tuple(r["v"]) for r in sampled(alike, 5_000, 1)} == {(2.0,)}


def test_evidence_of_many_questions_is_packed_without_a_call_for_each(spark):
    """F8, F11."""
    from siltstone.operators.evidence import pack_evidence

    hits = spark.createDataFrame([(1, 10, "h", "a word or two", 2.0), (1, 11, None, None, 1.0), (None, 12, "h", "x", None)], "qid long, id long, heading string, content string, score double")
    packed = pack_evidence(hits, "qid")
    assert sorted((r["qid"] or 0, r["pos"], r["id"], r["content"]) for r in packed.collect()) == [(0, 0, 12, "x"), (1, 0, 10, "a word or two"), (1, 1, 11, "")]
    assert "FlatMapGroups" not in packed._jdf.queryExecution().executedPlan().toString()


def test_frequent_terms_are_not_joined_with_every_question(spark):
    """results are those of the listed way, and rows sent do not grow with questions times documents."""
    n, k = 1500, 3
    docs = spark.range(n).select("id", F.concat_ws(" ", F.lit("plain about"), F.concat(F.lit("number"), F.col("id").cast("string")), F.when(F.col("id") % 3 == 0, "third third"), F.when(F.col("id") % 5 == 0, "fifth")).alias("t"))
    asks = spark.range(n).select("id", F.concat_ws(" ", F.lit("what about"), F.concat(F.lit("number"), (F.col("id") + 5).cast("string")), F.when(F.col("id") % 2 == 0, "third"), F.when(F.col("id") % 7 == 0, "fifth")).alias("q"))
    shown = lambda df: sorted((r["qid"], r["rank"], r["doc"], round(r["score"], 8)) for r in df.collect())
    want = shown(S.bm25(docs, asks, "id", "t", "id", "q", k))
    before = records_shuffled(spark)
    assert shown(S.bm25(docs, asks, "id", "t", "id", "q", k, listed=10)) == want
    assert records_shuffled(spark) - before < 100 * n


def test_frequent_terms_of_many_questions_are_scored_in_portions(spark, monkeypatch):
    """what a task holds does not grow with documents times questions; results stay."""
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict({"x": list(range(10))})
    cut = [p.column(0).to_pylist() for p in S.portions(rows, np.array([3, 3, 1, 9, 0, 0, 6, 2, 2, 2]), 6)]
    assert cut == [[0, 1], [2], [3], [4, 5, 6], [7, 8, 9]]
    docs = spark.range(300).select("id", F.concat_ws(" ", F.lit("plain about"), F.when(F.col("id") % 3 == 0, "third third"), F.concat(F.lit("number"), F.col("id").cast("string"))).alias("t"))
    asks = spark.range(40).select("id", F.concat_ws(" ", F.lit("what about"), F.concat(F.lit("number"), F.col("id").cast("string")), F.when(F.col("id") % 2 == 0, "third")).alias("q"))
    shown = lambda: sorted(map(tuple, S.bm25(docs, asks, "id", "t", "id", "q", 3).collect()))
    want = shown()
    monkeypatch.setattr(S, "PAIRS", 6)
    assert shown() == want


def test_vector_search_deals_out_many_best(spark, monkeypatch):
    """the best of all questions together do not have to fit one task."""
    v = spark.range(300).select("id", F.array(F.sin("id"), F.cos("id")).alias("v"))
    want = S.dense(v, v, "id", "v", "id", "v", 4).collect()
    monkeypatch.setattr(S, "HELD", 500)
    dealt = S.dense(v, v, "id", "v", "id", "v", 4)
    assert "CoGroup" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, want))


def test_costly_rows_of_a_small_file_are_dealt_out(spark):
    """pages and filings of one partition are parsed by many tasks, and come out whole."""
    from siltstone.operators import html_blocks as Hb
    from siltstone.operators import xml_files as Xml

    files = spark.range(0, 40, 1, 1).select("id", F.format_string("<html><p>page %d</p><table><tr><td>%d</td></tr></table></html>", "id", "id").alias("h"), F.format_string('<x><f contextRef="c">%d</f></x>', "id").alias("x"), F.lit("<x>").alias("bad"))
    made = {"text": Hb.html_blocks(files, "id", "h").where("tag = 'p'"), "cell": Hb.table_cells(files, "id", "h"), "fact": Xml.facts(files, "id", "x"), "bad": Xml.unreadable(files, "id", "bad")}
    for name, df in made.items():
        assert df.count() == 40, name
        assert df.rdd.getNumPartitions() > 1, name


def test_edges_are_counted_without_sorting_pairs(spark):
    """What reads the pairs is a hash aggregate; the first specific relation is found as before, a null order first."""
    from siltstone.operators.entities import graph_edges

    pairs = spark.createDataFrame([("a", "b", "owns", 3), ("b", "a", "runs", 2), ("a", "b", "co_mentioned", 1), ("c", "a", "co_mentioned", 1), ("d", "e", "owns", 1), ("e", "d", "runs", None), ("d", "e", "runs", 5), ("f", "f", "runs", 4), ("f", "f", "owns", 4)], "a string, b string, rel string, o long")
    edges = graph_edges(pairs, "rel", "o")
    assert sorted(map(tuple, edges.collect())) == [("a", "b", 3, "runs"), ("a", "c", 1, "co_mentioned"), ("d", "e", 3, "runs"), ("f", "f", 2, "owns")]
    nodes = [x for x in graph_edges(pairs, "rel", "o")._jdf.queryExecution().sparkPlan().toString().splitlines() if "Aggregate" in x]
    assert "HashAggregate" in nodes[-1]


def test_questions_make_the_index_once(spark):
    """both legs and the reranker read what was made once."""
    from siltstone.plans.runner import search_index

    made = spark.sparkContext.accumulator(0)

    def told(text):
        made.add(1)
        return text

    rows = spark.createDataFrame([(f"d{i}", f"alpha word{i} beta") for i in range(6)], "id string, content string")
    index = S.embed_texts(rows.withColumn("content", F.udf(told, "string").asNondeterministic()("content")), "content", 8)
    asked = spark.createDataFrame([(1, "alpha word3"), (2, "beta word5")], "qid long, query string")
    best = {r["qid"]: r["doc"] for r in search_index(index, asked, size=8).where("rank = 1").collect()}
    assert best == {1: "d3", 2: "d5"} and made.value == 6


def test_hits_are_sorted_once_for_all_anchors(spark):
    """what a task sorts is its hits alone, not once more for each anchor; scores are those of a join with anchors()."""
    from siltstone.operators import evidence as Ev
    from siltstone.operators.windows import ranked

    hits = spark.range(400).select(F.when(F.col("id") % 9 > 0, F.col("id") % 9).alias("qid"), "id", F.element_at(F.array(F.lit("A"), F.lit("a"), F.lit(""), F.lit(None), F.lit("b")), (F.xxhash64("id") % 3 + 3).cast("int")).alias("ticker"), F.when(F.col("id") % 9 != 4, F.concat(F.lit("f"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)).cast("string"))).alias("form"), (2015 + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(6))).cast("int").alias("fy"), F.lit(8.0).alias("score"))
    hits = ranked(hits, ["qid"], ["id"])
    want = hits
    for c in ("ticker", "form", "fy"):
        want = want.join(Ev.anchors(hits, ["qid"], "rank", c).withColumnRenamed(c, f"_{c}"), ["qid"], "left")
    decay = "CASE WHEN fy <> int(_fy) THEN 0.9 * pow(2.71828, -0.6 * greatest(0, abs(fy - int(_fy)) - 1)) ELSE 1 END"
    want = want.selectExpr("id", f"round(8 * CASE WHEN lower(ticker) <> _ticker AND ticker <> '' THEN 0.5 ELSE 1 END * CASE WHEN lower(form) <> _form THEN 0.8 ELSE 1 END * {decay}, 7) AS s")
    aligned = Ev.align(hits, ["qid"], "score", "rank")
    assert aligned.columns == ["qid", "id", "ticker", "form", "fy", "score", "rank"]
    got = {r["id"]: r["s"] for r in aligned.select("id", F.round("score", 7).alias("s")).collect()}
    assert got == {r["id"]: r["s"] for r in want.collect()} and len(got) == 400 and len(set(got.values())) > 6
    plan = aligned._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("+- Sort ") == 1


def test_every_kind_of_call_to_python_gets_bounded_batches(spark):
    """Rows as Arrow tables (term counts, evidence), columns one by one (cuts of long texts) and as an iterator (packing of chunks)."""
    import pandas as pd
    import pyarrow as pa

    had = spark.conf.get(BATCH_BYTES)
    wide = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("word "), 2_000).alias("t"), F.array_repeat(F.repeat(F.lit("x"), 100), 100).alias("a"))

    def rows(batches):
        for rb in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rb.num_rows])], names=["n"])

    @F.pandas_udf("int")
    def each(s: pd.Series) -> pd.Series:
        return pd.Series([len(s)] * len(s))

    def listed(batches):
        for s in batches:
            yield pd.Series([len(s)] * len(s))

    listed.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    spark.conf.set(BATCH_BYTES, "123m")
    try:
        bound_batches(spark, True)
        made = {"table": wide.select("a").mapInArrow(rows, "n long"), "column": wide.select(each("t").alias("n")), "iterator": wide.select(F.pandas_udf(listed, "int")("a").alias("n"))}
        for name, df in made.items():
            assert df.agg(F.max("n")).first()[0] < 500, name
    finally:
        bound_batches(spark, False)
        spark.conf.set(BATCH_BYTES, had)


def test_bound_on_batches_holds_when_the_setting_changed_meanwhile(spark):
    """Each query is bounded, also after its caller has set something else; a newer setting is not taken back to an older one."""
    session = spark.newSession()
    at_first = session.conf.get(BATCH_BYTES, None)
    bound_batches(session, True)
    bound_batches(session, True)
    bound_batches(session, False)
    assert session.conf.get(BATCH_BYTES, None) == at_first
    bound_batches(session, True)
    session.conf.set(BATCH_BYTES, "99m")
    bound_batches(session, True)
    assert session.conf.get(BATCH_BYTES) == SETTINGS[BATCH_BYTES]
    session.conf.set(BATCH_BYTES, "55m")
    for _ in range(2):
        bound_batches(session, False)
        assert session.conf.get(BATCH_BYTES) == "55m"
