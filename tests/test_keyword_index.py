"""The stored keyword index against search.bm25() over texts, and its upkeep against a full build."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import keyword_index as K
from siltstone.operators.search import bm25
from siltstone.sources.snapshots import SnapshotStore

SCHEMA = "id string, body string, lang string, at long"


def corpus(n=700, seed=1):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(f"d{i}", " ".join(r.choices(words, weights, k=r.randint(0, 60))), r.choice(["en", "de", None]), 1) for i in range(n)]
    return [*rows, ("none", None, "en", 1), ("empty", "", "de", 1), ("long", "w1 " * 5000 + "w299 rare", "en", 1), ("é/ü 1", "w5 w6 rare", "de", 1)]


def asked(spark, seed=2):
    r = random.Random(seed)
    rows = [(i, " ".join(f"w{r.randrange(300)}" for _ in range(r.randint(1, 6)))) for i in range(25)]
    return spark.createDataFrame([*rows, (90, None), (91, "unknown"), (92, "w0 w0 w0 w1"), (93, "rare"), (94, "W299, Rare!")], "q int, text string")


def hits(df):
    return sorted((r["qid"], r["rank"], r["doc"], round(r["score"], 7)) for r in df.collect())


SMALL = {"span": 128, "block": 16}


@pytest.mark.parametrize("parts", [1, 4])
def test_same_answers_as_over_texts(spark, tmp_path, parts):
    docs, q = spark.createDataFrame(corpus(), SCHEMA).repartition(3), asked(spark)
    store = K.build(docs, str(tmp_path / "i"), "id", "body", ["lang", "at"], parts, **SMALL)
    for k in (1, 7):
        assert hits(K.search(store, q, "q", "text", k)) == hits(bm25(docs, q, "id", "body", "q", "text", k))
    english = docs.where("lang = 'en'")
    want = hits(bm25(english, q, "id", "body", "q", "text", 5))
    assert len(want) > 60 and hits(K.search(store, q, "q", "text", 5, F.col("lang") == "en")) == want
    assert hits(K.search(store, q, "q", "text", 5, F.col("lang") == "en", listed=10)) == want
    assert K.search(store, q.limit(0), "q", "text").count() == 0
    assert K.search(store, q, "q", "text", 5, F.col("lang") == "xx").count() == 0


def test_a_question_reads_its_terms_only(spark, tmp_path):
    """The scan is told the terms; blocks whose bound is below the k-th score stay closed."""
    docs = spark.createDataFrame([(f"d{i:05}", "common " * (1 + 40 * (i == 77)) + ("other " * (i % 50)) + f"own{i}", "en", 1) for i in range(2000)], SCHEMA)
    store = K.build(docs, str(tmp_path / "i"), "id", "body", parts=1, **SMALL)
    read = K.postings_of(store, ["common", "own7"])
    plan = read._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(EqualTo(term,common),EqualTo(term,own7))" in plan.replace("IsNotNull(term), ", "")
    assert {r.term for r in read.select("term").distinct().collect()} == {"common", "own7"}
    blocks = store.read("postings").where("term = 'common'")
    first = blocks.where("range = 0").toArrow().sort_by("block")
    words = first.column("term").combine_chunks().unique()
    walk = K.Walk(first, words, np.array([1.0]), 25.0, 1.5, 0.75, 128)
    numbers, scores = walk.best(np.array([0]), 1, 1e-300)
    assert numbers.tolist() == [77] and walk.opened < first.num_rows


@pytest.mark.parametrize("seed", range(6))
def test_walk_by_enumeration(seed):
    rng = np.random.default_rng(seed)
    import pyarrow as pa

    present = rng.random((256, 12)) < rng.random(12)
    number, term = np.nonzero(present)
    tf, length = rng.integers(1, 9, len(number)), rng.integers(5, 90, 256)
    words = pa.array([f"t{i}" for i in range(12)])
    t = pa.Table.from_batches([K.blocks_of(0, 3, 8, number + 768, length[number], words.take(pa.array(term)), tf)])
    idf = rng.random(12) * 5
    walk = K.Walk(t, words, idf, 40.0, 1.5, 0.75, 256)
    for _ in range(20):
        own = rng.choice(12, rng.integers(1, 6), replace=False)
        total = np.zeros(256)
        for n, w, f in zip(number, term, tf, strict=True):
            if w in own:
                total[n] += idf[w] * walk.weigh(float(f), float(length[n]))
        k = int(rng.integers(1, 9))
        numbers, scores = walk.best(np.sort(own), k, 1e-300)
        want = sorted(((-round(s, 9), i + 768) for i, s in enumerate(total) if s > 0))[:k]
        got = sorted((-round(s, 9), n) for n, s in zip(numbers.tolist(), scores.tolist(), strict=True))[:k]
        assert np.allclose(np.array(got), np.array(want))


def same_as_built(spark, store, docs, path):
    full = K.build(docs, path, "id", "body", ["lang", "at"], 16, **SMALL)
    for name, drop in (("docs", []), ("sizes", []), ("postings", [])):
        a, b = (sorted(map(tuple, s.read(name).drop(*drop).collect()), key=repr) for s in (store, full))
        assert a == b, name


def test_upkeep_equals_a_full_build(spark, tmp_path):
    rows = corpus(300)
    docs = spark.createDataFrame(rows, SCHEMA)
    store = K.build(docs, str(tmp_path / "i"), "id", "body", ["lang", "at"], 16, **SMALL)
    # an edit, an addition, two that vanish, and one with an older time, which stays
    changed = [r for r in rows if r[0] not in ("d7", "none")]
    changed = [("d3", "quite new words w1", "de", 2) if r[0] == "d3" else r for r in changed] + [("new", "w2 rare", None, 1)]
    now = spark.createDataFrame(changed, SCHEMA)
    before = store.version()
    written = K.sync(store, now, "id", "body", "at")
    part = lambda *ids: {r[0] for r in spark.createDataFrame([(i,) for i in ids], "i string").select(K.part_of(F.col("i"), 16).cast("string")).collect()}
    touched = part("d3", "d7", "none", "new")
    assert store.version() == before + 1 and set(written) <= touched and set(K.rewritten(store, store.version())) == touched and len(touched) <= 4
    same_as_built(spark, store, now, str(tmp_path / "f"))
    q = asked(spark)
    assert hits(K.search(store, q, "q", "text", 5)) == hits(bm25(now, q, "id", "body", "q", "text", 5))
    assert K.sync(store, now, "id", "body", "at") == [] and store.version() == before + 1
    # all of a part's documents vanish
    gone = now.where(K.part_of(F.col("id"), 16) == int(sorted(touched)[0]))
    K.upsert(store, now.limit(0), "id", "body", gone.select("id"))
    left = now.join(gone, "id", "left_anti")
    same_as_built(spark, store, left, str(tmp_path / "g"))
    assert sorted(touched)[0] not in store.parts("postings")
    K.upsert(store, spark.createDataFrame([], SCHEMA), "id", "body", left.select("id"))
    assert store.read("docs").count() == 0 and K.search(store, q, "q", "text").count() == 0


def test_ids_have_to_be_distinct(spark, tmp_path):
    for ids in (["a", "a"], ["a", None]):
        with pytest.raises(Exception, match="distinct|not null"):
            K.build(spark.createDataFrame([(i, "x", "en", 1) for i in ids], SCHEMA), str(tmp_path / "i"), "id", "body", parts=1)
    assert SnapshotStore(spark, str(tmp_path / "i")).version() == 0


def test_a_part_is_the_work_of_many_tasks(spark, tmp_path, monkeypatch):
    """one part is written by many tasks, numbered without gaps and sorted by term over its files."""
    monkeypatch.setattr(K, "TASK_DOCS", 60)
    rows = corpus()
    docs, q = spark.createDataFrame(rows, SCHEMA).repartition(3), asked(spark)
    then = docs.where("id NOT LIKE '%7'").withColumn("body", F.when(F.col("id") == "d3", "older").otherwise(F.col("body"))).withColumn("at", F.lit(0))
    store = K.build(then, str(tmp_path / "i"), "id", "body", ["lang", "at"], 1, **SMALL)
    K.sync(store, docs, "id", "body", "at")
    ids = sorted(r[0] for r in rows)
    assert [(r["number"], r["doc"]) for r in store.read("docs").orderBy("number").collect()] == list(enumerate(ids))
    spans = store.read("postings").groupBy(F.input_file_name()).agg(F.min(F.struct("term", "range")).alias("a"), F.max(F.struct("term", "range")).alias("z")).orderBy("a").collect()
    assert len(spans) > 3 and all(tuple(x["z"]) <= tuple(y["a"]) for x, y in zip(spans, spans[1:], strict=False))
    assert hits(K.search(store, q, "q", "text", 5)) == hits(bm25(docs, q, "id", "body", "q", "text", 5))
    english = hits(bm25(docs.where("lang = 'en'"), q, "id", "body", "q", "text", 5))
    assert hits(K.search(store, q, "q", "text", 5, F.col("lang") == "en")) == english
