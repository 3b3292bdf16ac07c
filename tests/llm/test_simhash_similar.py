"""The pipeline's near-duplicates against exact Jaccard similarities of five-word shingles."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm import _scratch, simhash_similar
from siltstone.llm.simhash import near_duplicates

SCHEMA = "doc_id long, text string, lang string"


def by_hand(rows):
    """Rows' sets and the smallest row each reaches by pairs of at least 0.8."""
    sets = []
    for _, t, _ in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    pairs = [(i, j) for i, j in combinations(range(len(rows)), 2) if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    while any(label[i] != label[j] for i, j in pairs):
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return label


def planted(seed=3):
    r = random.Random(seed)
    text = lambda n: [f"w{r.randrange(5000)}" for _ in range(n)]
    rows = []
    for i in range(60):
        base = text(200)
        rows.append((10 * i, " ".join(base), "en"))
        for n in range(1, 4):  # 1 to 6 words replaced: similarities of about 0.95 to 0.74
            copy = list(base)
            for at in r.sample(range(0, 200, 5), 2 * n - i % 2):
                copy[at] = "new"
            rows.append((10 * i + n, " ".join(copy).upper() if n == 1 else "\n".join(copy), "en"))
    return rows


def test_planted_near_copies_go(spark):
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA)
    want = {rows[x][0] for x in by_hand(rows)}
    kept = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()]
    assert len(kept) == len(set(kept)) and set(kept) == want
    assert near_duplicates(df).select("root").distinct().count() > len(want) + 60  # three words and three bits leave most


@pytest.mark.parametrize("size", [512, 8])
def test_odd_rows_and_large_groups(spark, monkeypatch, size):
    monkeypatch.setattr(simhash_similar, "SLICE", size)
    monkeypatch.setattr(simhash_similar, "SET_SLICE", size * 100)
    monkeypatch.setattr(simhash_similar, "STEP", size * 10)
    base = [f"v{i}" for i in range(150)]
    rows = [(1000 + i, " ".join([*base[:i], "new", *base[i + 1 :]]), "x") for i in range(0, 150, 3)]
    rows += [(1, None, "x"), (2, "", "x"), (None, "  ", "x"), (3, "two words", "x"), (3, "Two  words", "x"), (3, "others", "x"), (None, "alone without id", "x"), (4, "two words", "x"), (2000, None, "x")]
    got = simhash_similar.keep_one_of_similar(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "lang"]
    assert sorted((r.doc_id or 0, " ".join((r.text or "").lower().split())) for r in got.collect()) == [(0, "alone without id"), (1, ""), (3, "others"), (3, "two words"), (1000, " ".join(["new", *base[1:]]))]


def test_empty_table(spark):
    assert simhash_similar.keep_one_of_similar(spark.createDataFrame([], SCHEMA)).count() == 0


def test_any_column_names(spark):
    rows = [(1, "a b c d e f", 1, 2, "x"), (2, "A b c d e f", 3, 4, "y"), (3, "others", 5, 6, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, block int, said int, node string").withColumn("root", F.lit(None).cast("array<int>"))
    got = simhash_similar.keep_one_of_similar(df)
    assert got.schema == df.schema and sorted(tuple(r)[:5] for r in got.collect()) == [rows[0], rows[2]]


def test_rows_in_blocks_keep_their_order_and_size(spark):
    docs = spark.createDataFrame([(i, "t" * (i % 7 * 10) if i % 5 else None) for i in range(200)], "doc_id long, text string").coalesce(1)
    blocks = _scratch.pack_rows(docs, "text", 500)
    got = [r for b in sorted(blocks.collect(), key=lambda b: b.block) for r in _scratch.rows_of(b.body).to_pylist()]
    assert got == [r.asDict() for r in docs.collect()]
    assert all(sum(64 + len(r["text"] or "") for r in _scratch.rows_of(b.body).to_pylist()) <= 500 for b in blocks.collect())


def test_recall_of_the_tables():
    """Of pairs right at the threshold, found and passed by the filter: at least nine in ten; of closer ones nearly all."""
    r = np.random.default_rng(8)
    bits, tables = simhash_similar.table_shape(200_000)
    chosen = np.stack([np.random.default_rng(i).permutation(256)[:bits] for i in range(tables)])
    for changed, least in ((0.111, 0.9), (0.08, 0.98), (0.04, 0.999)):
        h = r.integers(0, 2**64, (400, 300), np.uint64)
        other = h.copy()
        n = round(300 * changed)
        other[:, :n] = r.integers(0, 2**64, (400, n), np.uint64)
        bounds = np.arange(0, 300 * 401, 300)
        a, b = (simhash_similar.wide_prints(x.ravel(), bounds) for x in (h, other))
        differ = np.unpackbits((a ^ b).view(np.uint8), axis=1, bitorder="little")
        found = (~differ[:, chosen].any(axis=2)).any(axis=1) & (differ[:, :128].sum(axis=1) <= simhash_similar.RADIUS)
        assert found.mean() >= least, (changed, found.mean())
