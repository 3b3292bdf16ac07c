"""XML by Spark's own reader: instances to facts, linkbases to arcs, files that cannot be read.

Elements of a filing have any name, and from_xml() wants names. So each start tag becomes
<e element="its name" ...>, each end tag </e>, and one schema of nested e reads any file,
in order. A file is read as a whole in its row; contexts, units and locators are looked up
there, so nothing is shuffled. The look-up is quadratic in the elements of one instance
or link, and does not grow with the number of files.

A null, blank or malformed text gives no facts and no arcs, but a row of unreadable().
A fact with elements inside, which is no valid one, has its last piece of text as value. Repeated ids: the last one holds. Prefixes are those that the file writes;
a fact without any has the prefix ns. Columns of files other than the key are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.session import spread

READING = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
FACT_COLUMNS = ["ord", "qname", "value", "context_id", "unit_id", "decimals", "entity", "period_start", "period_end", "instant", "dimensions", "unit"]
INSTANCE_ATTRIBUTES = ["id", "contextRef", "unitRef", "decimals", "nil", "dimension"]
LINK_ATTRIBUTES = ["label", "href", "from", "to", "arcrole", "role", "lang", "order", "weight", "preferredLabel"]
LINK_KINDS = {"labelLink": "label", "calculationLink": "calculation", "presentationLink": "presentation", "definitionLink": "definition"}


def nested_schema(attributes: list[str], depth: int) -> str:
    """Fields of an element: its name, the given attributes, its text, and `depth` levels of elements below."""
    own = ", ".join(f"`_{a}` string" for a in ["element", *attributes]) + ", _VALUE string"
    return own + (f", e array<struct<{nested_schema(attributes, depth - 1)}>>" if depth else "")


def without_cdata(xml: Column) -> Column:
    """CDATA sections as escaped text."""
    escaped = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    inside = lambda p: F.substring_index(p, "]]>", 1)
    part = lambda p, i: F.when(i == 0, p).otherwise(F.concat(escaped(inside(p)), F.substr(p, F.length(inside(p)) + 4)))
    return F.when(F.contains(xml, F.lit("<![CDATA[")), F.array_join(F.transform(F.split(xml, r"<!\[CDATA\["), part), "")).otherwise(xml)


def tree(xml: Column, attributes: list[str], depth: int) -> Column:
    """The root's elements as nested structs; null if the text is no XML."""
    plain = F.regexp_replace(without_cdata(xml), r"(?s)<!--.*?-->", "")
    alike = F.regexp_replace(F.regexp_replace(plain, r"</[^>]+>", "</e>"), r"<([^\s<>/!?]+)", r'<e element="$1"')
    return F.from_xml(alike, f"{nested_schema(attributes, depth)}, _bad string", READING)


def well_formed(xml: Column) -> Column:
    """Whether a text is XML with elements that match; null for null."""
    read = F.from_xml(xml, "_none string, _bad string", READING)
    return xml.rlike(r"^\s*<") & read["_bad"].isNull()


def local(name: Column) -> Column:
    return F.substring_index(name, ":", -1)


def named(elements: Column, *names: str) -> Column:
    """Those of an array of elements that have one of the names, whatever their prefix."""
    return F.coalesce(F.filter(elements, lambda e: local(e["_element"]).isin(*names)), F.array())


def below(elements: Column) -> Column:
    """All elements one level below those of an array."""
    return F.flatten(F.transform(elements, lambda e: F.coalesce(e["e"], F.array())))


def texts(elements: Column) -> Column:
    return F.transform(elements, lambda e: F.coalesce(e["_VALUE"], F.lit("")))


def by_key(entries: Column) -> Column:
    """A map of structs (k, v): the last of a repeated key, none of a null one."""
    known = F.filter(entries, lambda x: x["k"].isNotNull())
    keys = F.array_distinct(F.transform(known, lambda x: x["k"]))
    last = F.transform(keys, lambda k: F.element_at(F.filter(known, lambda x: x["k"] == k), -1))
    return F.map_from_entries(F.when(F.size(keys) == F.size(known), known).otherwise(last))


def context_of(c: Column) -> Column:
    """Entity, period and dimensions of a context."""
    inner = F.coalesce(c["e"], F.array())
    second = below(inner)
    entries = lambda members: F.transform(named(members, "explicitMember"), lambda m: F.struct(F.coalesce(m["_dimension"], F.lit("")).alias("k"), F.coalesce(m["_VALUE"], F.lit("")).alias("v")))
    one = lambda name: F.try_element_at(texts(named(second, name)), F.lit(-1))
    dimensions = by_key(F.concat(entries(below(second)), entries(second)))
    return F.struct(one("identifier").alias("entity"), one("startDate").alias("period_start"), one("endDate").alias("period_end"), one("instant").alias("instant"), dimensions.alias("dimensions"))


def unit_of(u: Column) -> Column:
    """Measures of a unit, a quotient with a slash."""
    divide = F.try_element_at(named(u["e"], "divide"), F.lit(1))
    side = lambda n: F.array_join(texts(named(below(named(divide["e"], n)), "measure")), "*")
    return F.when(divide.isNotNull(), F.concat(side("unitNumerator"), F.lit("/"), side("unitDenominator"))).otherwise(F.array_join(texts(named(u["e"], "measure")), "*"))


def facts(files: DataFrame, key: str, xml: str) -> DataFrame:
    """Facts of instances with context and unit, in order; nil ones are skipped."""
    read = spread(files.select(key, xml)).where(well_formed(F.col(xml))).select(key, tree(F.col(xml), INSTANCE_ATTRIBUTES, 4)["e"].alias("e"))
    looked_up = read.select(
        key,
        F.filter("e", lambda x: x["_contextRef"].isNotNull() & ~F.coalesce(x["_nil"] == "true", F.lit(False))).alias("f"),
        by_key(F.transform(named(F.col("e"), "context"), lambda c: F.struct(c["_id"].alias("k"), context_of(c).alias("v")))).alias("contexts"),
        by_key(F.transform(named(F.col("e"), "unit"), lambda u: F.struct(u["_id"].alias("k"), unit_of(u).alias("v")))).alias("units"),
    )

    def fact(x: Column, i: Column) -> Column:
        return F.struct(
            i.alias("ord"),
            F.when(x["_element"].contains(":"), x["_element"]).otherwise(F.concat(F.lit("ns:"), x["_element"])).alias("qname"),
            F.coalesce(x["_VALUE"], F.lit("")).alias("value"),
            x["_contextRef"].alias("context_id"),
            x["_unitRef"].alias("unit_id"),
            x["_decimals"].alias("decimals"),
            F.try_element_at(F.col("contexts"), x["_contextRef"]).alias("c"),
            F.try_element_at(F.col("units"), x["_unitRef"]).alias("unit"),
        )

    rows = looked_up.select(key, F.explode(F.transform("f", fact)).alias("f")).select(key, "f.*").select("*", "c.*")
    return rows.withColumn("dimensions", F.coalesce("dimensions", F.create_map().cast("map<string,string>"))).select(key, *FACT_COLUMNS)


def arcs(files: DataFrame, key: str, xml: str) -> DataFrame:
    """Label, calculation, presentation and definition arcs with both ends resolved; others are dropped."""
    read = spread(files.select(key, xml)).where(well_formed(F.col(xml))).select(key, F.explode(tree(F.col(xml), LINK_ATTRIBUTES, 2)["e"]).alias("link"))
    kind = F.create_map(*(F.lit(x) for pair in LINK_KINDS.items() for x in pair))
    links = read.withColumn("kind", F.try_element_at(kind, local(F.col("link._element")))).where("kind IS NOT NULL")
    concept = lambda x: F.regexp_replace(F.substring_index(F.coalesce(x["_href"], F.lit("")), "#", -1), "^([^_]*)_", "$1:")
    resolved = links.select(
        key,
        "kind",
        F.col("link._role").alias("linkrole"),
        F.filter("link.e", lambda x: x["_element"].endswith("Arc")).alias("arc"),
        F.transform(named(F.col("link.e"), "label"), lambda x: F.struct(x["_label"].alias("label"), F.coalesce(x["_VALUE"], F.lit("")).alias("text"), x["_lang"].alias("lang"), x["_role"].alias("role"))).alias("texts"),
        by_key(F.transform(named(F.col("link.e"), "loc"), lambda x: F.struct(x["_label"].alias("k"), concept(x).alias("v")))).alias("where"),
    )

    def ends(a: Column) -> Column:
        label = F.col("kind") == "label"
        found = F.when(label, F.filter("texts", lambda t: t["label"] == a["_to"])).otherwise(F.array(F.struct(*(F.lit(None).cast("string").alias(n) for n in ("label", "text", "lang", "role")))))
        return F.struct(a.alias("a"), F.try_element_at(F.col("where"), a["_from"]).alias("from_concept"), F.try_element_at(F.col("where"), a["_to"]).alias("to_concept"), found.alias("found"))

    rows = resolved.select(key, "kind", "linkrole", F.explode(F.transform("arc", ends)).alias("r")).where("r.from_concept IS NOT NULL AND (kind = 'label' OR r.to_concept IS NOT NULL)")
    a = lambda n: F.col(f"r.a._{n}")
    return rows.select(
        key, "kind", "linkrole", a("from").alias("from_label"), a("to").alias("to_label"), "r.from_concept", "r.to_concept", a("arcrole").alias("arcrole"),
        F.coalesce(a("order").try_cast("double"), F.lit(0.0)).alias("ord"), a("weight").try_cast("double").alias("weight"), a("preferredLabel").alias("preferred_label"), F.explode("r.found").alias("t"),
    ).select("*", "t.text", "t.lang", "t.role").drop("t")


def unreadable(files: DataFrame, key: str, xml: str) -> DataFrame:
    """Files that give neither facts nor arcs for what they are: key, error and the beginning of the text."""
    x = F.col(xml)
    error = F.when(x.isNull(), "no text").when(x.rlike(r"^\s*$"), "empty").when(~x.rlike(r"^\s*<"), "no element").when(~well_formed(x), "not well-formed").when(tree(x, [], 0)["_bad"].isNotNull(), "not read")
    return spread(files.select(key, xml)).select(key, error.alias("error"), F.substring(x, 1, 80).alias("beginning")).where("error IS NOT NULL")
