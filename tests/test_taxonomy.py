"""References, reach and neighbourhoods held against walks over Python sets."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.operators import taxonomy as Tx


@pytest.mark.parametrize(
    ("base", "href", "want"),
    [("/a/b/c.xml", "d.xsd#x", "/a/b/d.xsd"), ("/a/b/c.xml", "../../d.xsd", "/d.xsd"), ("/a/c.xml", "./e/../d.xsd", "/a/d.xsd"), ("c.xml", "../d.xsd", "../d.xsd"), ("/a/c.xml", "http://h/x/../y.xsd#z", "http://h/y.xsd"), ("s3://b/a/c.xml", "../d.xsd", "s3://b/d.xsd"), ("/a/c.xml", "/d/e.xsd", "/d/e.xsd"), ("/a/c.xml", "#here", None), ("/a/c.xml", None, None), (None, "d.xsd", None)],
)
def test_resolved(spark, base, href, want):
    df = spark.createDataFrame([(base, href)], "b string, h string")
    assert df.select(Tx.resolved(F.col("b"), F.col("h"))).first()[0] == want


def test_reach_by_rounds(spark):
    r = random.Random(5)
    links = [(f"f{r.randint(0, 30)}", f"f{r.randint(0, 30)}") for _ in range(45)] + [("f0", "gone"), ("f1", "f1"), (None, "f2"), ("f2", None)]
    entries = ["f0", "f1", "f5", "f5", "alone", None]
    nexts = defaultdict(set)
    for a, b in links:
        if a and b:
            nexts[a].add(b)
    want = set()
    for e in {x for x in entries if x}:
        depth, edge, n = {e: 0}, {e}, 0
        while edge:
            n, edge = n + 1, {b for a in edge for b in nexts[a]} - depth.keys()
            depth |= dict.fromkeys(edge, n)
        want |= {(e, f, d) for f, d in depth.items()}
    refs = spark.createDataFrame([(a, b, "import") for a, b in links], "source string, target string, kind string").where("source IS NOT NULL AND target IS NOT NULL")
    got = Tx.reach(refs, spark.createDataFrame([(e, "clash") for e in entries], "file string, entry string"))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert Tx.reach(refs, spark.createDataFrame([], "file string")).count() == 0


def test_neighbourhood_stays_within_a_network(spark):
    r = random.Random(6)
    arcs = [(r.choice(["presentation", "calculation", "label"]), r.choice(["x", "y", None]), f"c{r.randint(0, 14)}", f"c{r.randint(0, 14)}") for _ in range(60)] + [("presentation", "x", None, "c1"), ("presentation", "x", "c1", None)]
    nets = defaultdict(set)
    for kind, role, a, b in arcs:
        if kind != "label" and a and b and a != b:
            nets[kind, role].add((a, b))
    starts = ["c0", "c1", "c2", "c2", None, "none"]
    want = {}
    for e in nets.values():
        for c in {s for s in starts if s}:
            for relation, pairs in (("child", e), ("parent", {(b, a) for a, b in e})):
                edge = {c}
                for d in (1, 2, 3):
                    edge = {b for a, b in pairs if a in edge}
                    for x in edge:
                        want[c, relation, x] = min(d, want.get((c, relation, x), 9))
            for p in {a for a, b in e if b == c}:
                want |= {(c, "sibling", b): 1 for a, b in e if a == p}
    want = {k: d for k, d in want.items() if k[0] != k[2]}
    df = spark.createDataFrame(arcs, "kind string, linkrole string, from_concept string, to_concept string")
    asked = spark.createDataFrame([(s,) for s in starts], "concept string")
    got = Tx.neighbourhood(df, asked, 3).collect()
    assert {tuple(g)[:3]: g["distance"] for g in got} == want and len(got) == len(want)
    only = Tx.neighbourhood(df, asked, 1, roles=["x"]).select("concept", "related").distinct().count()
    assert 0 < only < len(want)


def test_declared_by_the_nearest_file(spark):
    reached = spark.createDataFrame([("i", "i", 0), ("i", "near", 1), ("i", "far", 2)], "entry string, file string, depth int")
    declared = spark.createDataFrame([("far", "n:A", "t2", None, None, False), ("near", "n:A", "t1", "instant", "debit", False), ("else", "n:B", "t3", None, None, False)], "file string, concept string, type string, period_type string, balance string, abstract boolean")
    facts = spark.createDataFrame([("i", "n:A", 1), ("i", "n:A", 1), ("i", "n:B", 2), (None, "n:A", 3), ("j", "n:A", 4)], "f string, q string, v int")
    got = sorted((r["v"], r["declared_type"], r["declared_period"], r["declared_balance"]) for r in Tx.with_declared(facts, "f", "q", reached, declared).collect())
    assert got == [(1, "t1", "instant", "debit")] * 2 + [(2, None, None, None), (3, None, None, None), (4, None, None, None)]
