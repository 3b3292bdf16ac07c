"""The quality classifier: held-out accuracy, and scores against a second reading."""

import random
import zlib

import numpy as np

from siltstone.llm import _hashing as H
from siltstone.llm import quality as Q

SCHEMA = "doc_id long, text string, score string"
ODD = [(901, None, "x"), (902, "", "x"), (903, "   \n", "x"), (None, "a b", "x"), (None, None, None), (904, "long " * 150_000, "x"), (905, "日本 é\x00　b", "x")]


def corpus(n=500):
    r = random.Random(3)
    words = ["the", "of", "river", "stone", "light", "were", "old", "city", "über", "née"]
    rows, labels = [], []
    for i in range(n):
        t = [r.choice(words) for _ in range(r.randint(5, 60))]
        bad = r.random() < 0.25
        if bad:
            kind = r.randrange(3)
            t = [w + r.choice(["###", "%%%"]) for w in t] if kind == 0 else [w.upper() + "!!" for w in t] if kind == 1 else [r.choice("abcdefgh") * 5] * 30
        rows.append((i, " ".join(t), None))
        labels.append((i, int(not bad)))
    return rows, labels


def test_held_out(spark):
    rows, labels = corpus()
    both = [*labels, (None, 1), (3, None), (5, dict(labels)[5])]
    out = Q.quality(spark.createDataFrame(rows + ODD + rows[:2], SCHEMA), spark.createDataFrame(both, "doc_id long, quality int")).collect()
    truth = dict(labels)
    assert len(out) == len(rows) + len(ODD) + 2 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None) and not any(r.held_out for r in out if r.doc_id is None)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, SCHEMA)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (sorted((r.doc_id, r.score) for r in Q.quality(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()) for x in (labels, turned))
    assert a == b


def by_hand(text):
    """Hashes of the pieces of a text, word by word."""
    word = lambda s: int(H.of_spans(H.running(H.mix(np.array([ord(c) for c in s], np.uint64) + np.uint64(0x9E37))), np.array([0]), np.array([len(s)]))[0])
    gram = lambda s: int(H.of_grams(H.mix(np.array([ord(c) for c in s], np.uint64) + np.uint64(0x9E37)), len(s))[0]) ^ (len(s) * 0x9E3779B1)
    out, last = [int(Q.END)], None
    for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" "):
        if not w:
            continue
        out.append(word(w))
        if w == last:
            out.append(int(Q.AGAIN))
        last = w
        padded = f" {w} "
        out += [gram(padded[i : i + n]) for n in Q.GRAMS for i in range(len(padded) - n + 1)]
    return out


def test_scores_against_a_second_reading(spark, monkeypatch):
    texts = [t for _, t, _ in corpus(60)[0]] + ["", None, "a a a　b  b\n\n b", "é\x00é é\x00é", "x", "\U0001f600 ok ok ok", "one two " * 40]
    table = np.random.default_rng(1).normal(size=1 << Q.BITS)
    model = Q.Model(table, 0.25)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in Q.score_documents(df, model).collect()}
    for i, t in enumerate(texts):
        z = np.mean([table[h >> (64 - Q.BITS)] for h in by_hand(t or "")]) + 0.25
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-9
    (at, share), = Q.shares([texts[-1].encode()])
    places, n = np.unique([h >> (64 - Q.BITS) for h in by_hand(texts[-1])], return_counts=True)
    assert at.tolist() == places.tolist() and np.allclose(share, n / n.sum())


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(Q, "STRETCH", 50)
    text = ("word éé " * 30 + "ü" * 200 + " end").encode()
    parts = Q.stretches(text)
    assert b"".join(parts) == text and all(len(p) <= 50 and p.decode() for p in parts) and len(parts) > 8
    table = np.random.default_rng(2).normal(size=1 << Q.BITS)
    whole, n = Q.totals([text, b"a b"], table)
    alone = [Q.totals([text], table), Q.totals([b"a b"], table)]
    assert np.allclose(whole, [a[0][0] for a in alone]) and n.tolist() == [a[1][0] for a in alone]
    words = ("word éé " * 30).encode()
    monkeypatch.setattr(Q, "STRETCH", 1 << 19)
    one = Q.totals([words], table)
    monkeypatch.setattr(Q, "STRETCH", 50)
    assert np.allclose(one[0], Q.totals([words], table)[0])


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    for labels in ([], [(902, 1)]):
        assert Q.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).count() == len(ODD)
    assert Q.quality(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int")).count() == 0
