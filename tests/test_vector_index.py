"""The stored vector index against a scan of all vectors, its recall and the bytes it reads, and its upkeep."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import vector_index as V
from siltstone.operators.search import dense

SCHEMA = "id long, e array<float>, kind string"


def clustered(n=4000, d=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, d))
    x = centres[rng.integers(0, 40, n)] + rng.normal(scale=0.35, size=(n, d))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    rows = [(i, x[i].astype(np.float32).tolist(), "ab"[i % 2]) for i in range(n)]
    return rows + [(n + i, rows[5][1], "a") for i in range(300)]  # many copies


def hits(df):
    return sorted((r["qid"], r["rank"], r["doc"], round(r["score"], 6)) for r in df.collect())


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    df = spark.createDataFrame(clustered(), SCHEMA).repartition(3)
    return df, V.build(df, str(tmp_path_factory.mktemp("vectors")), "id", "e", ["kind"])


def test_exact_and_recall(spark, built):
    df, store = built
    asked = df.where("id % 50 = 0")
    want = hits(dense(df, asked, "id", "e", "id", "e", 10))
    assert hits(V.search(store, asked, "id", "e", 10, exact=True)) == want
    assert hits(V.search(store, asked, "id", "e", 10, probes=1, exact=True, sent_bytes=5000)) == want
    best = {(q, d) for q, _, d, _ in want}
    for recall in V.RECALLS:
        found = {(q, d) for q, _, d, _ in hits(V.search(store, asked, "id", "e", 10, recall))}
        assert len(best & found) >= (recall - 0.03) * len(best)
    # most cells stay closed for one question
    probes = store.properties()["probes"]["0.95"]
    cells = len(store.properties()["centroids"])
    assert probes <= cells // 4
    q = np.array([asked.where("id = 100").first()["e"]])
    own = V.ranked_cells(q, np.array(store.properties()["centroids"]), probes)[0].tolist()
    assert V.bytes_read(store, own) < 0.35 * V.bytes_read(store, list(range(cells)))
    plan = store.read("vectors", own).inputFiles()
    assert plan and all(f"__part={c}" in "".join(plan) for c in own if str(c) in store.parts("vectors"))


def test_filter_comes_before_the_choice(spark, built):
    df, store = built
    asked = df.where("id % 100 = 0")
    want = hits(dense(df.where("kind = 'b'"), asked, "id", "e", "id", "e", 7))
    assert hits(V.search(store, asked, "id", "e", 7, exact=True, where=F.col("kind") == "b")) == want
    assert V.search(store, asked.limit(0), "id", "e").count() == 0
    assert V.search(store, asked, "id", "e", where=F.col("kind") == "c", exact=True).count() == 0


def test_upkeep(spark, tmp_path):
    rows = clustered(500, seed=3)[:500]
    df = spark.createDataFrame(rows, SCHEMA)
    store = V.build(df, str(tmp_path / "i"), "id", "e", ["kind"], cells=20)
    before = store.version()
    edited = [(7, rows[300][1], "z"), (9000, rows[301][1], "z")]
    touched = V.upsert(store, spark.createDataFrame(edited, SCHEMA), "id", "e", spark.createDataFrame([(11,), (12345,)], "id long"))
    assert store.version() == before + 1 and 0 < len(touched) <= 4
    now, then = store.parts("vectors"), store.parts("vectors", before)
    assert {p for p in now.keys() | then.keys() if now.get(p) != then.get(p)} <= {str(c) for c in touched}
    left = [r for r in rows if r[0] not in (7, 11)] + edited
    same = spark.createDataFrame(left, SCHEMA)
    assert sorted((r.id, r.kind) for r in store.read("vectors").collect()) == sorted((r[0], r[2]) for r in left)
    asked = same.where("id % 20 = 0")
    assert hits(V.search(store, asked, "id", "e", 5, probes=2, exact=True)) == hits(dense(same, asked, "id", "e", "id", "e", 5))
    sizes = {r.cell: r.n for r in store.read("cells").collect()}
    assert sizes == {r.cell: r["count"] for r in store.read("vectors").groupBy("cell").count().collect()}
    with pytest.raises(Exception, match="not a vector of the index"):
        V.upsert(store, spark.createDataFrame([(1, [1.0], "z")], SCHEMA), "id", "e")


def test_small_tables(spark, tmp_path):
    store = V.build(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"), "id", "e")
    assert V.search(store, spark.createDataFrame([(1, [1.0, 2.0])], "q long, v array<float>"), "q", "v").count() == 0
    one = V.build(spark.createDataFrame([(1, [1.0, 0.0], "a")], SCHEMA), str(tmp_path / "o"), "id", "e")
    assert hits(V.search(one, spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "q long, v array<float>"), "q", "v")) == [(1, 1, 1, 1.0)]
