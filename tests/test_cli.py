"""The command line, end to end on a few pages."""

import pytest

from siltstone import cli
from siltstone.sources import files


def test_pages_to_answers(spark, tmp_path, capsys):
    page = "<h1>Item 1A. Risk Factors</h1><p>Revenue of the harbour grew to $5 million in 2023, more than in the year before.</p><p>Cash was kept in several banks across the whole region.</p>"
    spark.createDataFrame([(i, page.replace("harbour", f"harbour number{i}")) for i in range(3)], "page_id long, html string").write.parquet(f"{tmp_path}/pages")
    cli.main(["parse", "--input", f"{tmp_path}/pages", "--output", f"{tmp_path}/rows", "--format", "jsonl"], spark)
    assert spark.read.json(f"{tmp_path}/rows").count() == 9
    cli.main(["run", "--stages", "parse,clean,chunk,index", "--input", f"{tmp_path}/pages", "--output", f"{tmp_path}/index"], spark)
    cli.main(["query", "--index", f"{tmp_path}/index", "--question", "revenue of number1", "--topk", "2"], spark)
    lines = capsys.readouterr().out.strip().split("\n")
    assert len(lines) == 2 and lines[0].startswith("1. [") and "number1" in lines[0]
    for leg in ("bm25", "dense"):
        cli.main([leg, "--index", f"{tmp_path}/index", "--question", "revenue of number2", "--topk", "1"], spark)
        assert "number2" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["query", "--index", f"{tmp_path}/index"], spark)


def test_ingest(spark, tmp_path):
    xml = '<xbrl xmlns:us-gaap="http://g"><context id="c1"><entity><identifier>7</identifier></entity><period><instant>2024-12-31</instant></period></context><unit id="u"><measure>iso4217:USD</measure></unit><us-gaap:Assets contextRef="c1" unitRef="u" decimals="-3">12</us-gaap:Assets></xbrl>'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "filing-1.xml").write_text(xml)
    loc = '<link:loc xlink:label="a" xlink:href="x.xsd#us-gaap_Assets"/><link:loc xlink:label="b" xlink:href="x.xsd#us-gaap_Cash"/>'
    head = '<link:linkbase xmlns:link="http://l" xmlns:xlink="http://www.w3.org/1999/xlink">'
    for end, link, rest in (("lab", "label", '<link:label xlink:label="l" xlink:role="r" xml:lang="en">All</link:label><link:labelArc xlink:from="a" xlink:to="l"/>'), ("cal", "calculation", '<link:calculationArc xlink:from="a" xlink:to="b" weight="1" order="2"/>'), ("pre", "presentation", '<link:presentationArc xlink:from="a" xlink:to="b" order="3" preferredLabel="p"/>'), ("def", "definition", '<link:definitionArc xlink:from="b" xlink:to="a" xlink:arcrole="all"/>')):
        (tmp_path / "in" / f"filing-1_{end}.xml").write_text(f"{head}<link:{link}Link>{loc}{rest}</link:{link}Link></link:linkbase>")
    (tmp_path / "in" / "cut.xml").write_text(xml[:-20])
    cli.main(["ingest", "--input", f"{tmp_path}/in", "--store", f"{tmp_path}/store", "--rejects", f"{tmp_path}/rejects"], spark)
    (fact,) = files.load_store(spark, f"{tmp_path}/store")["facts"].collect()
    assert (fact.filing_id, fact.qname, fact.value_raw, fact.is_numeric) == ("filing-1", "us-gaap:Assets", "12", True)
    store = files.load_store(spark, f"{tmp_path}/store")
    assert store["units"].count() == store["contexts"].count() == 1
    a, b = "us-gaap:Assets", "us-gaap:Cash"
    want = {"labels": ("filing-1", a, "r", "en", "All"), "calc_edges": ("filing-1", a, b, 1.0, 2.0), "pre_edges": ("filing-1", a, b, 3.0, "p"), "def_edges": ("filing-1", b, a, "all", 0.0)}
    assert {name: [tuple(r) for r in store[name].collect()] for name in want} == {name: [row] for name, row in want.items()}
    (bad,) = spark.read.json(f"{tmp_path}/rejects").collect()
    assert bad.path.endswith("cut.xml") and bad.error == "not well-formed"
