"""The pipeline against its rules by brute force, on the smallest tables and on odd rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm import _scratch
from siltstone.llm.decontamination import words_of
from siltstone.llm.queries import vocabulary_path
from siltstone.llm.toxicity import toxicity
from tests.llm.test_simhash_similar import by_hand

SF = "/root/testdata/sf0.001"


def contaminated(text, items):
    """At least one word in twenty lies in an occurrence of 13 consecutive words of an item."""
    w = words_of((text or "").encode())
    hit = [False] * len(w)
    for g in {tuple(i[j : j + min(13, len(i))]) for i in items if i for j in range(max(1, len(i) - 12))}:
        for j in range(len(w) - len(g) + 1):
            if tuple(w[j : j + len(g)]) == g:
                hit[j : j + len(g)] = [True] * len(g)
    return sum(hit) > 0 and 20 * sum(hit) >= len(w)


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    (_, tox), (_, near), (_, clean), (_, pii), (_, bpe) = corpus_pipeline.STAGES
    a = tox(spark, docs, SF).persist()
    assert {r.doc_id for r in a.collect()} == {r.doc_id for r in toxicity(docs, labels).where("predicted = 0").collect()}
    # one document of each group of similar ones, groups by all pairs
    b = near(spark, a, SF).persist()
    rows = sorted((r.doc_id, r.text, "") for r in a.collect())
    assert sorted(r.doc_id for r in b.collect()) == sorted({rows[x][0] for x in by_hand(rows)})
    c = clean(spark, b, SF).persist()
    items = [words_of((r.text or "").encode()) for r in bench.collect()]
    assert {r.doc_id for r in c.collect()} == {r.doc_id for r in b.collect() if not contaminated(r.text, items)}
    d = pii(spark, c, SF).persist()
    assert d.columns == c.columns == b.columns == a.columns == columns and d.count() == c.count()
    assert all(r.n_chars == len(r.text) for r in d.collect()) and d.join(c.select("doc_id", F.col("text").alias("old")), "doc_id").where("text <> old").count() > 0
    e = bpe(spark, d, SF)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    texts = {r.doc_id: r.text for r in d.collect()}
    for r in e.collect():
        assert r.text == texts[r.doc_id] and list(r.ids) == t.encode(texts[r.doc_id], add_special_tokens=False).ids
    assert corpus_pipeline.run(spark, SF).count() == d.count()


ODD = [
    (1, "a plain text of several words here", "en", "s", 3), (1, "a plain text of several words here", "en", "s", 3), (None, "a plain text of several words here", None, None, None),
    (2, None, "en", "s", None), (3, "", "en", None, 0), (None, None, None, None, None), (4, "word " * 60_000 + "end", "en", "s", 9), (5, "mail me at some.one@mail.example.org or 10.1.2.3", "en", "s", 5), (5, "another text under the same id, quite unlike", "de", "s", 1),
]


@pytest.fixture
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(("block", "row", "said", "root", "node", "ids", "item", "hash", "_entities", "found", "score", "key"))})


def test_odd_rows_go_through_all_stages(spark, odd):
    out = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = _scratch.persist(stage(spark, out, SF), name)
        assert out.schema.simpleString() == odd.schema.simpleString(), name
    got = sorted(((r.doc_id, (r.text or "")[:10]) for r in out.collect()), key=repr)
    # repeated rows and texts without words are one each, the smallest id stays
    assert got == sorted([(1, "a plain te"), (2, ""), (4, "word word "), (5, "mail me at"), (5, "another te")], key=repr)
    assert [r.key for r in out.collect()] == [11] * 5
    coded = corpus_pipeline.STAGES[-1][1](spark, out, SF).collect()
    assert sorted((r.doc_id, r.text[:10]) for r in coded) == [(i, t) for i, t in sorted(got)] and {len(r.ids) for r in coded if r.doc_id == 2} == {0}


def test_empty_table(spark, odd):
    out = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
        assert out.count() == 0


def test_scratch_data_goes_with_the_stages(spark):
    """What a run leaves is the last stage's; another run takes nothing from it."""
    before = {m[0] for m in _scratch._MADE.get(id(spark), [])}
    first = corpus_pipeline.run(spark, SF)
    left = {m[0] for m in _scratch._MADE[id(spark)]} - before
    second = corpus_pipeline.run(spark, SF)
    assert len(left) <= 4 and first.count() == second.count() > 0


def test_bpe_decodes_in_the_worker_that_encodes(spark):
    """The last stage has one Python worker a task, with the rows of the two operators chained."""
    import corpus_pipeline as C
    from siltstone.llm import bpe
    from siltstone.llm.queries import vocabulary_path

    docs = spark.createDataFrame([(1, "One word, два слова 1234  \n"), (2, None), (None, ""), (4, "x" * 3000 + " ☃")], "doc_id long, text string")
    out = C.bpe(spark, docs, "")
    want = bpe.decode_documents(bpe.encode_documents(docs, vocabulary_path()), vocabulary_path())
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect()))
    top = lambda df: [x for x in df._jdf.queryExecution().sparkPlan().toString().splitlines() if "MapInArrow" in x and "text" in x]
    nodes = lambda df: df._jdf.queryExecution().sparkPlan().toString().count("MapInArrow")
    assert nodes(out) == nodes(want) - 1 and len(top(out)) == 1
