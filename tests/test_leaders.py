"""What tasks of keyword and vector search send: the k best of each question, whatever the number of documents and questions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.operators import search as S


@pytest.mark.parametrize(("seed", "names"), [(1, False), (2, True)])
def test_leaders_by_sorting_all(seed, names):
    rng = np.random.default_rng(seed)
    best, rows = S.Leaders(70, 3), []
    best_rows = 0
    for a in range(0, 4000, 100):
        docs = [f"é{i % 977}-{i}" if names else i - 2000 for i in range(a, a + 100)]
        scores = np.round(rng.random((70, 100)), 1)  # nearly all are ties
        ok = rng.random((70, 100)) < 0.6
        best.add(0, scores, pa.array(docs), ok)
        best_rows = max(best_rows, best.rows)
        rows += [(q, -scores[q, j], docs[j]) for q, j in zip(*np.nonzero(ok), strict=True)]
    got = pa.Table.from_batches(best.batches(pa.array(range(70)))).to_pylist()
    key = (lambda r: (r[0], r[1], r[2].encode())) if names else (lambda r: r)
    want = {}
    for q, s, d in sorted(rows, key=key):
        want.setdefault(int(q), []).append((d, -s))
    assert {q: [(r["doc"], r["score"]) for r in got if r["qid"] == q] for q in want} == {q: v[:3] for q, v in want.items()}
    assert len(got) == 210 and best_rows <= 2 * 210 + (1 << 16) + 70 * 100


def sent(df):
    """Rows that leave the tasks that score, before the final choice."""
    plan = df._jdf.queryExecution().analyzed()
    while "MapInArrow" not in plan.getClass().getSimpleName() and "FlatMapCoGroups" not in plan.getClass().getSimpleName():
        plan = plan.children().head()
    from pyspark.sql import DataFrame

    return DataFrame(df.sparkSession._jvm.org.apache.spark.sql.classic.Dataset.ofRows(df.sparkSession._jsparkSession, plan), df.sparkSession).count()


def test_rows_sent(spark):
    r = random.Random(1)
    docs = spark.createDataFrame([(i, " ".join(r.choices("abcdefgh", k=5)).replace("a", "common")) for i in range(3000)], "d long, t string").withColumn("t", F.concat("t", F.lit(" everywhere"))).repartition(2)
    asked = spark.createDataFrame([(i, "everywhere common") for i in range(3000)], "q int, t string")
    found = S.bm25(docs, asked, "d", "t", "q", "t", 4)
    assert sent(found) <= 2 * 3000 * 4 and found.count() == 3000 * 4
    vectors = spark.createDataFrame([(i, [r.random(), r.random()]) for i in range(3000)], "d long, v array<double>").repartition(2)
    near = S.dense(vectors, vectors.where("d < 700"), "d", "v", "d", "v", 4)
    assert sent(near) <= 2 * 700 * 4


def test_queries_in_blocks_give_the_same(spark):
    r = random.Random(2)
    rows = [(i, [float(r.randint(-2, 2)) for _ in range(4)]) for i in range(300)] + [(None, [1.0, 0.0, 0.0, 0.0]), (400, None)]
    vectors = spark.createDataFrame(rows, "d long, v array<double>")
    asked = vectors.where("d % 3 = 0 or d = 400").select(F.col("d").cast("string").alias("q"), "v")
    once = sorted(map(tuple, S.dense(vectors, asked, "d", "v", "q", "v", 5).collect()), key=repr)
    blocks = sorted(map(tuple, S.dense(vectors, asked, "d", "v", "q", "v", 5, sent_bytes=1000).collect()), key=repr)
    assert once == blocks and len(once) == 500
    assert S.dense(vectors, asked.limit(0), "d", "v", "q", "v").count() == 0
