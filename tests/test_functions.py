"""Edge cases of functions and operators, on literals."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.functions import fiscal, nested, numeric
from siltstone.functions import text as X
from siltstone.operators import chunking as C
from siltstone.operators import entities as E
from siltstone.operators import evidence as Ev
from siltstone.operators import facts as Fx
from siltstone.operators import html_blocks as Hb
from siltstone.operators import search as S
from siltstone.operators import windows as W


def values(spark, f, inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_human_numbers(spark):
    assert values(spark, numeric.human_number, ["(565)", "$2,825", "442.000 M", "12 K", "abc", None, ""]) == [-565, 2825, 4.42e8, 12000, None, None, None]


def test_float_maybe_guards_suffixes(spark):
    assert values(spark, numeric.float_maybe, ["12d", "1,234.5", "25%", None]) == [None, 1234.5, 25.0, None]


def test_durations_need_a_digit(spark):
    assert values(spark, numeric.iso_durations, ["P1Y6M", "S&P 500", None]) == [[545], [], []]


def test_fiscal_quarters(spark):
    got = values(spark, lambda c: fiscal.fiscal_quarter(c, F.lit("09-30")), ["2023-10-31", "2023-12-31", "2024-09-30", "2023-10-01", None])
    assert got == ["Q1", "Q1", "Q4", "Q4", None]


def test_organisations(spark):
    assert values(spark, X.normalize_org, ["Apple Inc.", "Microsoft Corporation", "Google", "Facebook", None]) == ["APPLE", "MICROSOFT", "ALPHABET INC", "META PLATFORMS INC", None]


def test_headings(spark):
    assert values(spark, X.is_probable_heading, ["NOTE 5 text, here.", "RISK FACTORS", "Item 7A. Market, risk.", "Revenue grew, by 5.", "Liquidity"]) == [True, True, True, False, True]


def test_merge_spans(spark):
    df = spark.sql("SELECT array(struct(5 AS start, 9 AS `end`), struct(1 AS start, 3 AS `end`), struct(2 AS start, 4 AS `end`)) AS s")
    assert [tuple(x) for x in df.select(nested.merge_spans(F.col("s"))).first()[0]] == [(1, 4), (5, 9)]


def test_dims_signature(spark):
    df = spark.sql("SELECT map('b', '2', 'a', '1') AS m, cast(null AS map<string,string>) AS n")
    assert tuple(df.select(nested.dims_signature("m"), nested.dims_signature("n")).first()) == ("a=1|b=2", "")


def test_sections_follow_headings(spark):
    heads = [None, None, "A", "A", None, "B"]
    df = spark.createDataFrame([(1, i, h) for i, h in enumerate(heads)], "d int, i int, h string")
    assert [r.section for r in W.sections(df, ["d"], ["i"], "h").orderBy("i").collect()] == [0, 0, 0, 0, 1, 1]


@pytest.mark.parametrize(("text", "want"), [("Apple Inc. (AAPL) rose", ["AAPL"]), ("Ticker: MSFT is", ["MSFT"]), ("THE company AND", []), ("CEO of the (LLC) (SEC)", []), ("the stock price rose", ["PRICE"])])
def test_tickers(spark, text, want):
    (found,) = values(spark, E.tickers, [text])
    assert [t["text"] for t in found] == want and all(text[t["start"] : t["end"]].upper() == t["text"] for t in found)


def test_tickers_strict(spark):
    assert values(spark, lambda c: E.tickers(c, strict=True), ["the stock price rose", None]) == [[], []]


def test_metrics(spark):
    text = "EBITDA and EPS, EBITDA; P/E, ROE EV/EBITDA SG&A"
    (found,) = values(spark, E.fin_metrics, [text])
    assert [m["text"] for m in found] == ["EBITDA", "EPS", "P/E", "ROE", "EV/EBITDA", "SG&A"] and all(text[m["start"] : m["end"]] == m["text"] for m in found)


def test_entities_keep_the_most_confident(spark):
    df = spark.createDataFrame([(1, [("a", "ORG", 5, 6, 0.9, "A"), ("a", "ORG", 1, 2, 0.95, "A"), ("a", "GPE", 0, 1, 0.5, "A")])], "i int, e array<struct<text:string,label:string,start:int,end:int,confidence:double,normalized:string>>")
    got = E.dedup_entities(df, "e").first().e
    assert [(x.label, x.confidence) for x in got] == [("GPE", 0.5), ("ORG", 0.95)]


def test_subgraph_depth(spark):
    edges = spark.createDataFrame([("A", "B", 1), ("C", "D", 1)], "source string, target string, weight int")
    nodes, found = E.subgraph(edges, spark.createDataFrame([("A",)], "node string"), 1)
    assert sorted(r.node for r in nodes.collect()) == ["A", "B"] and found.count() == 1


def test_html_blocks():
    page = "<html><script>x</script><h1>Item 1A. Risk</h1><div><p>One &amp; two<p>Three words here<li>item one</div><p>Three words here</p></html>"
    got = Hb.blocks(page)
    assert [(b["tag"], b["text"]) for b in got] == [("h1", "Item 1A. Risk"), ("p", "One & two"), ("p", "Three words here"), ("li", "item one")]
    assert got[1]["item"] == "1A"


def test_html_tables():
    assert Hb.tables("<table><tr><td>a<td>b<tr><td>c</td></tr></table>") == [[["a", "b"], ["c"]]]
    assert Hb.blocks("") == [] and Hb.tables(None) == []


@pytest.mark.parametrize("tag", ["div", "section", "table><tr><td", "li", "p", "span"])
def test_deep_pages_do_not_recurse(tag):
    names = [t.strip("<") for t in tag.split(">")]
    page = "".join(f"<{n}>" for n in names) * 5000 + "the innermost text" + "".join(f"</{n}>" for n in reversed(names)) * 5000
    got = Hb.blocks(page)
    assert [b["text"] for b in got][-1:] == (["the innermost text"] if names[0] != "span" else [])
    assert len(Hb.tables(page)) == (5000 if names[0] == "table" else 0)


def test_page_numbers():
    lines = "".join(f"<p>line {c} of text</p>" for c in "abcdefghij")
    got = {b["text"]: b["page_no"] for b in Hb.blocks(f"<div>Page 7 of 9</div>{lines}<section id='page-3'><p>inside it</p></section>")}
    assert [got[f"line {c} of text"] for c in "abcdefghij"] == [7] * 8 + [None, None] and got["inside it"] == 3


def test_file_names(spark):
    names = ["US_aapl_2023_10-k_0000320193-23-000106_aapl-20230930_20230930.htm", "US_BRK.B_2022_10-Q_acc 0000320193-23-000106 x.html", "US_x_2022_10-K_odd.name.txt", "other.txt", None]
    got = [tuple(r) for r in values(spark, X.meta_from_filename, names)]
    assert got[:3] == [("AAPL", 2023, "10-K", "0000320193-23-000106", "20230930", "htm"), ("BRK.B", 2022, "10-Q", "0000320193-23-000106", None, "html"), ("X", 2022, "10-K", "odd.name", None, "txt")]
    assert got[3:] == [(None,) * 6] * 2


def test_cross_encoder_scores(spark):
    import numpy as np

    seen = []
    f = S.cross_encoder(lambda pairs: np.array([[0.0, float(len(t))] for _, t in pairs]), 2)
    df = spark.createDataFrame([("q", "a"), ("q", "abc"), ("q", None)], "q string, t string")
    got = sorted(r[0] for r in df.select(f("q", "t")).collect())
    assert got == pytest.approx([1 / (1 + np.exp(-n)) for n in (0, 1, 3)]) and not seen
    assert list(S.model_scores(np.array([[2.0], [-1.0]]))) == [2.0, -1.0]


def test_targets(spark):
    rows = lambda c: [tuple(r) for r in Fx.extraction_targets(spark, c).collect()]
    assert rows(None) == rows({}) == [("value", "numeric", None, None)]
    assert rows({"targets": ["a", {"name": "b", "type": "text", "pattern": "x"}]}) == rows([{"target": "a"}, {"target": "b", "kind": "text", "pattern": "x"}]) == [("a", "numeric", None, None), ("b", "text", "x", None)]


def test_numbers_skip_legal_references(spark):
    text = "Item 7 under Rule 12b-2 paid $5 million, 5 more on 2024-01-31; 3 m in six months; Section 12(b), § 4.1, 1,250.5 usd x:ClassAMember"
    got, none, empty = values(spark, numeric.number_tokens, [text, None, ""])
    assert [n["value"] for n in got] == [5e6, 5.0, 2024.0, 1.0, 31.0, 3.0, 1250.5] and none == empty == []
    first, three = got[0], got[5]
    assert (first["raw"], first["base_value"], first["unit_token"], first["scale_used"], first["currency"]) == ("$5 million", 5.0, "million", "million", "USD")
    assert first["near_date"] and (three["unit_token"], three["scale_used"]) == ("m", None) and got[6]["near_xbrl_qname"] and first["window"] == text[0 : text.index(", 5 more") + 30]
    assert values(spark, lambda c: numeric.number_tokens(c, legacy=True), ["5 more"])[0][0]["value"] == 5e6


@given(st.text(alphabet="ab .?!", max_size=9000))
@settings(max_examples=50, deadline=None)
def test_cut_long_keeps_all_letters(s):
    assert "".join("".join(C.cut_long(s)).split()) == "".join(s.split())


@given(st.lists(st.text(alphabet="abc ", min_size=1, max_size=400).map(str.strip).filter(bool), max_size=40))
@settings(max_examples=50, deadline=None)
def test_every_unit_is_packed_once(units):
    chunks = C.pack_units(units, None, max_tokens=60, max_chars=200, overlap=0)
    assert " ".join(" ".join(chunks).split()) == " ".join(" ".join(units).split())


def test_overlap_and_heading():
    chunks = C.pack_units(["a " * 80, "b " * 80], "H", max_tokens=50, overlap=2)
    assert all(c.startswith("H\n") for c in chunks) and chunks[1].split("\n")[1] == "a a"


def test_packing_respects_the_budget():
    hits = [{"id": i, "heading": "h" if i % 2 else None, "content": f"word{i} " * 50, "score": 1 - i / 10} for i in range(8)]
    got = Ev.pack(hits, 300, 8)
    assert sum(Ev.tokens(r["content"]) for r in got) <= 300 and len({r["id"] for r in got}) == len(got)
    assert Ev.pack([], 100, 5) == []


def test_bm25_statistics_follow_the_filter(spark):
    docs = spark.createDataFrame([(1, "cat dog"), (2, "cat"), (3, "fish fish"), (4, None)], "d int, t string")
    q = spark.createDataFrame([(9, "cat cat")], "q int, x string")
    all_ = S.bm25(docs, q, "d", "t", "q", "x").collect()
    some = S.bm25(docs.where("d < 3"), q, "d", "t", "q", "x").collect()
    assert {r.doc for r in all_} == {r.doc for r in some} == {1, 2} and all_[0].score != some[0].score


def test_bm25_listed_and_joined_agree(spark):
    import random

    r = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["the", "50%"]
    docs = spark.createDataFrame([(i, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in range(300)] + [(900, None), (901, "")], "d int, t string")
    q = spark.createDataFrame([(f"q{i}", " ".join(r.choice(words) for _ in range(4))) for i in range(30)] + [("none", None), ("stop", "the")], "q string, x string")
    got = [sorted((x.qid, x.rank, x.doc, round(x.score, 8)) for x in S.bm25(docs, q, "d", "t", "q", "x", 7, listed=n).collect()) for n in (10_000, 5)]
    assert got[0] == got[1] and len(got[0]) == 210
    assert S.bm25(docs.limit(0), q, "d", "t", "q", "x").count() == S.bm25(docs, q.limit(0), "d", "t", "q", "x").count() == 0


def test_surfaces_by_automaton(spark):
    import random

    r = random.Random(5)
    texts = [(i, "".join(r.choice("abC é") for _ in range(r.randint(0, 30)))) for i in range(200)] + [(900, None), (901, "")]
    surfaces = [(i, "".join(r.choice("aBcÉ ") for _ in range(r.randint(1, 4)))) for i in range(60)] + [(60, None), (61, "ab"), (62, "ab"), (63, "")]
    want = sorted((i, j) for i, t in texts if t is not None for j, s in surfaces if s is not None and s.lower() in t.lower())
    from siltstone.operators.joins import surface_hits

    for rows in (1000, 7):
        got = surface_hits(spark.createDataFrame(texts, "i int, t string"), "t", spark.createDataFrame(surfaces, "j int, s string"), "s", rows)
        assert sorted((x.i, x.j) for x in got.collect()) == want


def test_dense_ties_go_to_the_smaller_id(spark):
    v = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(5)], "i int, v array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "q int, w array<float>")
    assert [r.doc for r in S.dense(v, q, "i", "v", "q", "w", 2).orderBy("rank").collect()] == [0, 1]


def test_snippet():
    t = "x " * 400 + "needle " + "y " * 400
    assert "needle" in S.snippet_of(t, "needle") and S.snippet_of("short", "q") == "short"
