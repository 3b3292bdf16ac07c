"""Instances and linkbases held against a second reading by the standard library."""

from __future__ import annotations

import random
import re
import xml.etree.ElementTree as ET

from siltstone.operators import xml_files as M

_XLINK = "{http://www.w3.org/1999/xlink}"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def parse_instance(xml: str) -> list[dict]:
    """Facts of an instance with context and unit; nil ones are skipped; no facts if it is no XML."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    prefixes = dict(re.findall(r'xmlns:([\w.-]+)="([^"]+)"', xml))
    prefix_of = {uri: p for p, uri in prefixes.items()}
    contexts, units, out = {}, {}, []
    for e in root:
        if _local(e.tag) == "context":
            got = {"entity": None, "period_start": None, "period_end": None, "instant": None, "dimensions": {}}
            for x in e.iter():
                name, value = _local(x.tag), (x.text or "").strip()
                if name == "identifier":
                    got["entity"] = value
                elif name in {"startDate", "endDate", "instant"}:
                    got[{"startDate": "period_start", "endDate": "period_end", "instant": "instant"}[name]] = value
                elif name == "explicitMember":
                    got["dimensions"][x.get("dimension", "")] = value
            contexts[e.get("id")] = got
        elif _local(e.tag) == "unit":
            top = [(m.text or "").strip() for m in e.iter() if _local(m.tag) == "measure"]
            div = [x for x in e.iter() if _local(x.tag) == "divide"]
            if div:
                side = lambda n: "*".join((m.text or "").strip() for x in div[0] if _local(x.tag) == n for m in x.iter() if _local(m.tag) == "measure")
                units[e.get("id")] = f"{side('unitNumerator')}/{side('unitDenominator')}"
            else:
                units[e.get("id")] = "*".join(top)
    for e in root:
        if e.get("contextRef") is None or e.get("{http://www.w3.org/2001/XMLSchema-instance}nil") == "true":
            continue
        uri, _, name = e.tag[1:].partition("}")
        c = contexts.get(e.get("contextRef"), {"entity": None, "period_start": None, "period_end": None, "instant": None, "dimensions": {}})
        out.append({"ord": len(out), "qname": f"{prefix_of.get(uri, 'ns')}:{name}", "value": "".join(e.itertext()).strip(), "context_id": e.get("contextRef"), "unit_id": e.get("unitRef"), "decimals": e.get("decimals"), **c, "unit": units.get(e.get("unitRef"))})
    return out


def parse_linkbase(xml: str) -> list[dict]:
    """Label, calculation, presentation and definition arcs with both ends resolved; others are dropped."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    out = []
    for link in root.iter():
        kind = {"labelLink": "label", "calculationLink": "calculation", "presentationLink": "presentation", "definitionLink": "definition"}.get(_local(link.tag))
        if not kind:
            continue
        where, texts = {}, {}
        for e in link:
            if _local(e.tag) == "loc":
                where[e.get(f"{_XLINK}label")] = (e.get(f"{_XLINK}href") or "").rsplit("#", 1)[-1].replace("_", ":", 1)
            elif _local(e.tag) == "label":
                texts.setdefault(e.get(f"{_XLINK}label"), []).append(((e.text or "").strip(), e.get("{http://www.w3.org/XML/1998/namespace}lang"), e.get(f"{_XLINK}role")))
        for e in link:
            if not _local(e.tag).endswith("Arc"):
                continue
            a, b = e.get(f"{_XLINK}from"), e.get(f"{_XLINK}to")
            row = {"kind": kind, "linkrole": link.get(f"{_XLINK}role"), "from_label": a, "to_label": b, "from_concept": where.get(a), "to_concept": where.get(b), "arcrole": e.get(f"{_XLINK}arcrole"), "ord": float(e.get("order") or 0), "weight": float(e.get("weight")) if e.get("weight") else None, "preferred_label": e.get("preferredLabel"), "text": None, "lang": None, "role": None}
            if kind == "label":
                out += [row | {"text": t, "lang": lang, "role": role} for t, lang, role in texts.get(b, ()) if a in where]
            elif a in where and b in where:
                out.append(row)
    return out


HEAD = '<xbrl xmlns="http://i" xmlns:us-gaap="http://g" xmlns:x="http://x" xmlns:xbrldi="http://d" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">'


def made_instance(r: random.Random) -> str:
    """Contexts, units and facts in any order, with comments, CDATA, entities, repeated ids and references to nothing."""
    out = []
    for _ in range(r.randint(0, 6)):
        period = r.choice(["<instant>2024-12-31</instant>", "<startDate> 2023-01-01</startDate><endDate>2023-12-31 </endDate>"])
        members = "".join(f'<xbrldi:explicitMember dimension="a:{r.choice("PQR")}">m:{r.randint(0, 3)}</xbrldi:explicitMember>' for _ in range(r.randint(0, 3)))
        where = r.choice(["<entity><identifier scheme='s'>9</identifier><segment>{}</segment></entity>{}", "<entity><identifier>8</identifier></entity><scenario>{}</scenario>{}"])
        out.append(f'<context id="c{r.randint(0, 4)}">{where.format(members, f"<period>{period}</period>")}</context>')
    for _ in range(r.randint(0, 3)):
        out.append(f'<unit id="u{r.randint(0, 2)}">' + r.choice(["<measure>iso4217:USD</measure>", "<measure>a</measure><measure>b</measure>", "<divide><unitNumerator><measure>iso4217:USD</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide>"]) + "</unit>")
    for _ in range(r.randint(0, 12)):
        name = r.choice(["us-gaap:Assets", "us-gaap:Debt", "x:E-1.b"])
        value = r.choice(["5", " 1,000 ", "", "a &lt;p&gt; &amp; b", "<![CDATA[<p class='q'>1 & 2 &amp; 3</p><!-- no --> </us-gaap:Assets>]]>", "x<![CDATA[<b>]]>y<![CDATA[]]>", "ü €", "a<!-- <us-gaap:No contextRef='c0'> -->"])
        attributes = f' contextRef="c{r.randint(0, 5)}"' + r.choice(["", ' unitRef="u0"', '\n unitRef = "u2" decimals="-3"', ' decimals="a > b"', ' xsi:nil="true"', ' xsi:nil="false"'])
        out.append(f"<{name}{attributes}>{value}</{name} >" if r.random() < 0.8 else f"<{name}{attributes}/>")
    r.shuffle(out)
    return "<?xml version='1.0'?>" * (r.random() < 0.5) + HEAD + "\n".join(out) + "<!-- <context id='c0'/> --></xbrl>"


def made_linkbase(r: random.Random) -> str:
    out = []
    for kind in r.choices(["label", "calculation", "presentation", "definition", "footnote"], k=r.randint(0, 4)):
        inner = [f'<link:loc xlink:label="l{r.randint(0, 4)}" xlink:href="a_b.xsd#us-gaap_{r.choice(["A", "B_c", "D"])}"/>' for _ in range(r.randint(0, 6))]
        inner += [f'<link:label xlink:label="t{r.randint(0, 2)}" xml:lang="en" xlink:role="r{r.randint(0, 2)}"> T{r.randint(0, 9)} &amp; </link:label>' for _ in range(r.randint(0, 4))]
        to = "t" if kind == "label" else "l"
        inner += [f'<link:{kind}Arc xlink:from="l{r.randint(0, 5)}" xlink:to="{to}{r.randint(0, 5)}" xlink:arcrole="s"{r.choice(["", " order=\'1.5\' weight=\'-1\'", " preferredLabel=\'p\'"])}/>' for _ in range(r.randint(0, 8))]
        r.shuffle(inner)
        out.append(f'<link:{kind}Link xlink:role="http://r/{kind}">' + "".join(inner) + f"</link:{kind}Link>")
    return '<link:linkbase xmlns:link="http://l" xmlns:xlink="http://www.w3.org/1999/xlink">' + "".join(out) + "</link:linkbase>"


def table_of(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "id long, x string, ord string, kind string")


def as_rows(found, columns):
    return sorted((repr(tuple(sorted(v.items()) if isinstance(v, dict) else v for v in (f[c] for c in columns))) for f in found))


def test_facts_are_those_of_a_second_reading(spark):
    texts = [made_instance(random.Random(i)) for i in range(120)]
    got = M.facts(table_of(spark, texts), "id", "x")
    want = [{"id": i} | f for i, t in enumerate(texts) for f in parse_instance(t)]
    assert len(want) > 300 and as_rows(got.collect(), got.columns) == as_rows(want, got.columns)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_arcs_are_those_of_a_second_reading(spark):
    texts = [made_linkbase(random.Random(i)) for i in range(150)]
    got = M.arcs(table_of(spark, texts), "id", "x")
    want = [{"id": i} | f for i, t in enumerate(texts) for f in parse_linkbase(t)]
    assert len(want) > 100 and as_rows(got.collect(), got.columns) == as_rows(want, got.columns)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_unreadable_files_are_named(spark):
    good = made_instance(random.Random(3))
    texts = [good, None, "", "  \n", "no xml", "<not xml", good[:-9], "<a><b></a></b>", "<a/>", good]
    rows = {r["id"]: r["error"] for r in M.unreadable(table_of(spark, texts), "id", "x").collect()}
    assert rows == {1: "no text", 2: "empty", 3: "empty", 4: "no element", 5: "not well-formed", 6: "not well-formed", 7: "not well-formed"}
    read = {r["id"] for r in M.facts(table_of(spark, texts), "id", "x").collect()}
    assert read == {0, 9} and M.arcs(table_of(spark, texts), "id", "x").count() == 0
    assert M.facts(table_of(spark, []), "id", "x").count() == M.unreadable(table_of(spark, []), "id", "x").count() == 0


def test_a_long_instance(spark):
    facts = "".join(f'<us-gaap:F{i % 7} contextRef="c{i % 900}" unitRef="u">{i}</us-gaap:F{i % 7}>' for i in range(6000))
    contexts = "".join(f'<context id="c{i}"><entity><identifier>{i}</identifier></entity><period><instant>2024-01-01</instant></period></context>' for i in range(900))
    got = M.facts(table_of(spark, [HEAD + facts + contexts + "</xbrl>"]), "id", "x").selectExpr("count(*) AS n", "count_if(int(value) % 900 = int(entity)) AS right", "count(distinct ord) AS ords").first()
    assert tuple(got) == (6000, 6000, 6000)
