"""Window dedup over words and bytes, and near-duplicates, against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltstone.llm import _repeats, embedding_dedup, simhash, suffix_array
from siltstone.llm.simhash import near_duplicates
from siltstone.llm.substring_dedup import SuffixTree, dedup_substrings
from siltstone.llm.suffix_array import dedup_bytes, deep_shallow_sort


def corpus(seed=1):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["é", "日本", "\x1c"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = [text(40), text(13), text(12), "same " * 60]
    rows = []
    for i in range(120):
        parts = [text(r.randint(0, 40))] + [r.choice(shared) for _ in range(r.randint(0, 2))] + [text(r.randint(0, 30))]
        rows.append((i, r.choice([" ", "\n", "\t "]).join(parts), "en"))
    rows += [(200, None, "x"), (201, "", "x"), (202, "   ", None), (203, shared[0], "x"), (203, shared[0], "x"), (None, shared[0], "x"), (None, None, None), (204, "long " * 3000 + text(50), "x"), (205, rows[5][1], "x")]
    return rows


SCHEMA = "doc_id long, text string, n_words string"


def words_by_hand(rows, w):
    key = lambda i: -1 if i is None else i
    first = {}
    for i, t, _ in rows:
        x = (t or "").encode().split()
        for j in range(len(x) - w + 1):
            g = tuple(x[j : j + w])
            first[g] = min(first.get(g, 10**9), key(i))
    out = []
    for i, t, _ in rows:
        x = (t or "").encode().split()
        gone = [False] * len(x)
        for j in range(len(x) - w + 1):
            if first[tuple(x[j : j + w])] < key(i):
                gone[j : j + w] = [True] * w
        out.append((i, len(x), sum(gone), b" ".join(a for a, g in zip(x, gone, strict=True) if not g).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 10, 1 << 22])
def test_words(spark, block):
    rows = corpus()
    got = dedup_substrings(spark.createDataFrame(rows, SCHEMA).repartition(3), block_bytes=block).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=repr) == words_by_hand(rows, 13)
    assert all(sum(s.end - s.start for s in r.removed_spans) == r.n_removed for r in got)


@pytest.mark.parametrize("bound", [40, 400, 4000])
def test_hot_prefixes_are_split(spark, monkeypatch, bound):
    """With so small a bound all prefixes are hot; at 40 bytes single windows are as well."""
    import functools

    monkeypatch.setattr(_repeats, "make_plan", functools.partial(bounded_plan, bound))
    rows = corpus(6)
    got = dedup_substrings(spark.createDataFrame(rows, SCHEMA).repartition(3), block_bytes=1 << 11).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=repr) == words_by_hand(rows, 13)
    test_bytes(spark, 1 << 11, 60)


def bounded_plan(bound, rule, found, original=_repeats.make_plan):
    with pytest.MonkeyPatch.context() as m:
        m.setattr(_repeats, "GROUP_BYTES", bound)
        plan = original(rule, found)
    assert len(plan.hot) and (bound > 40 or plan.best)
    return plan


@pytest.mark.parametrize(("block", "window"), [(1 << 10, 60), (1 << 22, 400)])
def test_bytes(spark, block, window):
    rows = corpus(2)
    docs = [(i, (t or "").encode()) for i, t, _ in rows]
    count = {}
    for _, t in docs:
        for j in range(len(t) - window + 1):
            count[t[j : j + window]] = count.get(t[j : j + window], 0) + 1
    want = []
    for i, t in docs:
        gone = np.zeros(len(t), bool)
        for j in range(len(t) - window + 1):
            if count[t[j : j + window]] > 1:
                gone[j : j + window] = True
        want.append((i, len(t), int(gone.sum()), bytes(np.frombuffer(t, np.uint8)[~gone])))
    got = dedup_bytes(spark.createDataFrame(rows, SCHEMA).repartition(3), window=window, block_bytes=block).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("f", [dedup_substrings, dedup_bytes, near_duplicates])
def test_empty_table(spark, f):
    assert f(spark.createDataFrame([], SCHEMA)).count() == 0


def test_deep_shallow_order():
    r = random.Random(3)
    rows = [bytes(r.choice(b"ab\0") for _ in range(r.choice([0, 5, 40, 90]))) for _ in range(300)] + [b"x" * 80] * 70
    order, share = deep_shallow_sort(rows, 80)
    padded = [x[:80].ljust(80, b"\0") for x in rows]
    got = [padded[i] for i in order]
    assert got == sorted(padded)
    for a, b, n in zip(got[:-1], got[1:], share, strict=True):
        assert a[:n] == b[:n] and (n == 80 or a[n] != b[n])


def test_multikey_quicksort_groups():
    w = np.random.default_rng(1).integers(0, 3, (500, 4)).astype(np.uint64)
    groups = suffix_array.multikey_quicksort(w)
    flat = [tuple(w[g[0]]) for g in groups]
    assert flat == sorted(set(map(tuple, w.tolist()))) and sum(map(len, groups)) == 500


def test_suffix_tree_nodes():
    rows = np.random.default_rng(2).integers(0, 2, (64, 5))
    tree = SuffixTree(rows)
    for d in range(6):
        same = tree.nodes(d)
        for i in range(64):
            for j in range(64):
                assert (same[i] == same[j]) == (rows[i, :d] == rows[j, :d]).all()


def print_by_hand(t):
    w = (t or "").encode().lower().split()
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def test_near_duplicates(spark):
    rows = corpus(4) + [(300 + i, corpus(4)[7][1] + " x" * (i % 3), "c") for i in range(40)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = [print_by_hand(t) for _, t, _ in rows]
    assert sorted(r.fingerprint for r in got) == sorted(f"{p:016x}" for p in prints)
    label = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 3:
                    label[i] = label[j] = min(label[i], label[j])
    ids = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            ids[label[i]] = min(ids.get(label[i], 10**9), d)
    want = sorted(((d, ids.get(label[i])) for i, (d, _, _) in enumerate(rows)), key=repr)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == want


@pytest.mark.parametrize("n", [1, 20, 70, 300])
def test_bit_sliced_comparison(n):
    r = np.random.default_rng(n)
    base = r.integers(0, 2**63, max(1, n // 8)).astype(np.uint64)
    fp = base[r.integers(0, len(base), n)] ^ (np.uint64(1) << r.integers(0, 64, n).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, n).astype(np.uint64))
    want = {(i, j) for i in range(n) for j in range(n) if int(fp[i] ^ fp[j]).bit_count() <= 3}
    assert set(zip(*map(np.ndarray.tolist, simhash.near_queries(fp, fp, 3)), strict=True)) == want
    group = np.sort(r.integers(0, max(1, n // 10), n))
    i, j = simhash.near_neighbours(fp, group, 3)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a, b in want if a < b and group[a] == group[b]}


def test_bit_sliced_comparison_of_wide_prints():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**64, (6, 2), np.uint64)
    fp = base[r.integers(0, 6, 90)]
    for _ in range(25):
        fp[np.arange(90), r.integers(0, 2, 90)] ^= np.uint64(1) << r.integers(0, 64, 90).astype(np.uint64)
    far = lambda a, b: sum(int(x).bit_count() for x in a ^ b)
    want = {(i, j) for i in range(90) for j in range(90) if far(fp[i], fp[j]) <= 30}
    assert 90 < len(want) < 8100 and set(zip(*map(np.ndarray.tolist, simhash.near_queries(fp, fp, 30)), strict=True)) == want
    i, j = simhash.near_neighbours(fp[:30], np.zeros(30, int), 30)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a, b in want if a < b < 30}


def test_large_groups_are_cut_into_slices(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 16)
    rows = [(i, " ".join(["t"] * 200 + [f"u{i}"]), "x") for i in range(90)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert got.select("component_id").distinct().count() == 1


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SLICE", 8)
    r = np.random.default_rng(5)
    base = r.normal(size=(40, 16))
    v = np.concatenate([base, base[:20] + r.normal(size=(20, 16)) * 0.05, base[:1] + r.normal(size=(30, 16)) * 0.1, base[3:4] * 2, base[3:4]])
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)] + [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, [1.0], 1), (504, [None] * 16, 1), (None, base[5].tolist(), 1)]
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")).collect()}
    all_ = np.array([*v, base[5]])
    u = all_ / np.linalg.norm(all_, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    found = sum(got[i].n_links for i in range(len(v)))
    assert found >= 0.97 * near[:-1].sum() and all(got[i].n_links <= near[i].sum() for i in range(len(v)))
    assert [(got[i].n_links, got[i].component_id) for i in range(500, 505)] == [(0, i) for i in range(500, 505)]
    assert got[None].n_links >= 1 and got[None].component_id == 5


def test_vectors_of_any_size_and_length(spark):
    """Very large and small components, and several lengths: only direction and length count."""
    rows = [(1, [1e200, 0.0]), (2, [1e200, 0.0]), (3, [1e-200, 1e-210]), (4, [5e-324, 0.0]), (5, [0.0, 1e308]), (6, [1.0]), (7, [2.0]), (8, [-3.0]), (9, [1.0, 0.0, 0.0]), (10, [2.0, 0.1, 0.0]), (11, []), (12, [float("inf"), 0.0]), (13, [1.7e308, 1.7e308])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {**dict.fromkeys((1, 2, 3, 4), (3, 1)), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (1, 9), 10: (1, 9), 11: (0, 11), 12: (0, 12), 13: (0, 13)}
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_extra_columns_may_clash(spark):
    df = spark.createDataFrame([(1, "a b c", 1, 2)], "doc_id long, text string, block int, fp int").withColumn("said", F.lit(1))
    assert dedup_substrings(df).count() == dedup_bytes(df).count() == near_duplicates(df).count() == 1
