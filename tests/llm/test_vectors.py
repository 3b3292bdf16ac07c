"""Hard negatives and vector codes against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import hard_negatives, vector_codes
from siltstone.llm.hard_negatives import Pivots, lower, mine_hard_negatives, upper
from siltstone.llm.vector_codes import Codebooks, assign, compress_vectors, pack_bounds, split_parts, unpack_bounds, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int, score string, d int"


def vectors(n, d, seed, labels=4, copies=0):
    """Clustered vectors with odd rows: nulls, not finite ones, zeros, repeated rows, null ids and labels, a rare length."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    x = (centres[rng.integers(0, 6, n)] + rng.normal(scale=0.5, size=(n, d))) / 4
    rows = [(i, x[i].astype(np.float32).tolist(), int(rng.integers(0, labels)), "s", 1) for i in range(n)]
    rows += [(n + i, rows[3][1], i % labels, "s", 1) for i in range(copies)]
    one = rows[5][1]
    rows += [(10_001, None, 1, "s", 1), (10_002, [*one[:-1], None], 1, "s", 1), (10_003, [*one[:-1], float("nan")], 2, "s", 1), (10_004, [*one[:-1], float("inf")], 2, "s", 1)]
    rows += [(10_005, [0.0] * d, 1, "s", 1), (10_006, one, None, "s", 1), (None, one, 1, "s", 1), (None, one, 1, "s", 1), (20, one, 2, "s", 1), (20, one, 2, "s", 1)]
    rows += [(10_010, one[:3], 1, "s", 1), (10_020, one[:3], 2, "s", 1), (10_030, [1.0, 2.0, 3.0], 1, "s", 1), (10_040, [], 1, "s", 1)]
    random.Random(seed).shuffle(rows)
    return rows


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def negatives_by_hand(rows, step, k=5):
    key = lambda i: -(2**63) if i is None else i
    good = [(i, [math.floor(256 * x) for x in v], y) for i, v, y, *_ in rows if y is not None and sound(v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for n, (i, v, y) in enumerate(good):
        if i is None or i % step:
            continue
        other = sorted((-dot(v, w), key(j), j, z) for m, (j, w, z) in enumerate(good) if m != n and len(w) == len(v))
        for ps, _, p, _ in [o for o in other if o[3] == y][:k]:
            fit = [o for o in other if o[3] != y and 80 * -ps <= 100 * -o[0] <= 100 * -ps][:k]
            out += [(i, p, r, o[2], -ps, -o[0]) for r, o in enumerate(fit, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block", "group", "wave", "slice_bytes"), [(1024, 256, 64, 16 << 20), (16, 3, 2, 4000)])
def test_hard_negatives(spark, monkeypatch, block, group, wave, slice_bytes):
    for name, value in (("BLOCK", block), ("GROUP", group), ("WAVE", wave), ("SLICE_BYTES", slice_bytes)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(400, 8, 1, copies=60)
    got = mine_hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 10 == 0)
    want = negatives_by_hand(rows, 10)
    assert len(want) > 300 and sorted(map(tuple, got.collect()), key=repr) == want


def test_hard_negatives_labels_of_any_type_and_empty_tables(spark):
    rows = vectors(80, 6, 2)
    text = spark.createDataFrame(rows, SCHEMA).withColumn("label", F.concat(F.lit("label "), "label"))
    assert sorted(map(tuple, mine_hard_negatives(text, F.col("vec_id") % 10 == 0).collect()), key=repr) == negatives_by_hand(rows, 10)
    assert mine_hard_negatives(text.limit(0), F.lit(True)).count() == 0
    assert mine_hard_negatives(text, F.col("vec_id") < 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 1)], "vec_id long, embedding array<double>, label int")
    assert mine_hard_negatives(one, F.lit(True)).count() == 0
    with pytest.raises(ValueError, match="exact range"):
        mine_hard_negatives(spark.createDataFrame([(0, [1e9, 2.0], 1)], one.schema), F.lit(True))


@pytest.mark.parametrize("seed", range(5))
def test_brackets_hold_every_score(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(scale=rng.choice([3, 300, 3e6]), size=(300, 5)))
    most = float((x * x).sum(axis=1).max())
    pivots = Pivots(list(x[:40]), most, 8)
    far, asked, size = pivots.of_rows(x), pivots.of_anchors(x), (x * x).sum(axis=1)
    score = x @ x.T
    gap = np.abs(asked[:, None] - far).max(axis=2)
    reach = (asked[:, None] + far).min(axis=2)
    assert (upper(most, size[:, None], gap) >= score).all() and (lower(most, size[:, None], reach) <= score).all()
    # and are of use: what is near a pivot is told from what is far
    assert (upper(most, size[:, None], gap) < score.max()).mean() > 0.05


def codes_by_hand(rows, parts, k, rounds, scale=256):
    good = [(i, [math.floor(scale * x) for x in v], y, v) for i, v, y, *_ in rows if sound(v)]
    sizes = [len(v) for _, v, *_ in good if v and len(v) % parts == 0]
    d = min(set(sizes), key=lambda s: (-sizes.count(s), s))
    fit = [g for g in good if len(g[1]) == d]
    w = d // parts
    cut = lambda v, p: tuple(v[p * w : p * w + w])
    first = sorted(fit, key=lambda g: (g[0] is None, g[0] or 0, g[3]))[:k]
    books = [[cut(g[1], p) for g in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, v: min((far(cut(v, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = {}
            for g in fit:
                own.setdefault(nearest(p, g[1])[1], []).append(cut(g[1], p))
            new.append([tuple(sum(c) // len(own[e]) for c in zip(*own[e], strict=True)) if e in own else c for e, c in enumerate(books[p])])
        books = new
    out = []
    for i, v, y, _ in good:
        if len(v) != d:
            out.append((i, None, None, y))
            continue
        best = [nearest(p, v) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(s for s, _ in best), y))
    total = {}
    for _, _, e, y in out:
        if e is not None:
            total[y] = total.get(y, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, total.get(y)) for i, c, e, y in out), key=repr), digest


@pytest.mark.parametrize(("parts", "k", "rounds", "block"), [(4, 16, 2, 2048), (2, 200, 3, 32), (8, 1, 1, 7), (4, 16, 0, 64)])
def test_codes(spark, monkeypatch, parts, k, rounds, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rows = vectors(300, 8, 3, copies=40)
    coded, books = compress_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), parts=parts, entries=k, rounds=rounds)
    want, digest = codes_by_hand(rows, parts, k, rounds)
    got = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in with_label_error(coded).collect()), key=repr)
    assert books.sha256() == digest and got == want


def test_codes_of_small_and_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    coded, books = compress_vectors(empty)
    assert with_label_error(coded).count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
    short = spark.createDataFrame([(1, [1.0, 2.0], 3), (2, None, 3)], "vec_id long, embedding array<double>, label int")
    assert [tuple(r) for r in with_label_error(compress_vectors(short)[0]).collect()] == [(1, 3, None, None, None)]
    few = spark.createDataFrame([(2, [1.0, 2.0], None), (1, [1.0, 2.0], None), (None, [5.0, 2.0], None)], short.schema)
    assert sorted((r.code, r.error, r.label_error) for r in with_label_error(compress_vectors(few, parts=2)[0]).collect()) == [("0000", 0, 0), ("0000", 0, 0), ("0200", 0, 0)]
    with pytest.raises(ValueError, match="64 bits"):
        compress_vectors(spark.createDataFrame([(1, [1e6, 2.0], 3)], short.schema), parts=2)


@pytest.mark.parametrize("seed", range(4))
def test_pruning_computes_less_and_finds_the_same(seed):
    """Bounds through two moves of the entries, with ties (few values) and repeated entries; each assignment as by all distances."""
    rng = np.random.default_rng(seed)
    x = split_parts(np.floor(rng.normal(scale=[2, 40, 60, 80][seed], size=(500, 8))), 2)
    books = Codebooks(x[:, :32].copy())
    books.entries[:, 7] = books.entries[:, 3]
    books = Codebooks(books.entries)
    known, computed = None, []
    for _ in range(4):
        code, high, low, _, n = assign(x, books, known)
        computed.append(n)
        d = ((x[:, :, None] - books.entries[:, None]) ** 2).sum(axis=3)
        assert (code == d.argmin(axis=2)).all()
        root = np.sqrt(d)
        packed = unpack_bounds(*pack_bounds(high, low), 2, 500)
        assert (packed[0] >= np.take_along_axis(root, code[:, :, None], 2)[:, :, 0]).all() and (packed[1].transpose(0, 2, 1) <= root + 1e-12).all()
        known = (code.astype(np.uint8), *packed)
        sums = np.zeros_like(books.entries)
        for p in range(2):
            np.add.at(sums[p], code[p], x[p])
            count = np.bincount(code[p], minlength=32)
            sums[p] = np.where(count[:, None] > 0, sums[p] // np.maximum(count, 1)[:, None], books.entries[p])
        books = books.after(sums)
    if seed:  # with the coarsest values nearly all is a tie
        assert computed[0] < 2 * 500 * 32 and max(computed[1:]) < computed[0]
