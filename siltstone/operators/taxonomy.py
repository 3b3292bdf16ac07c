"""Taxonomies over files, and the neighbourhood of concepts in their networks.

Files name each other by schemaRef, linkbaseRef, import and include; what an instance
rests on is what it reaches over them, cycles included. Networks are the arcs of
xml_files.arcs(). All steps are joins on file or concept; nothing is collected.

Null names and files that cannot be read take no part; references to files that are not
there stay in references() and reach them, and lead no further. Rows that repeat count
once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators import xml_files as X
from siltstone.session import written

REFERENCES = ["schemaRef", "linkbaseRef", "roleRef", "arcroleRef", "import", "include"]
CONCEPT_ATTRIBUTES = ["id", "name", "type", "substitutionGroup", "periodType", "balance", "abstract"]
PARENT_CHILD = ["presentation", "calculation", "definition"]


def resolved(base: Column, href: Column) -> Column:
    """A reference as its file means it: without a fragment, from the file's folder on, `.` and `..` taken out."""
    bare = F.substring_index(href, "#", 1)
    whole = F.when(bare.rlike(r"^[A-Za-z][\w+.-]*:|^/"), bare).otherwise(F.concat(F.regexp_extract(base, r"^(.*/)?", 0), bare))
    scheme = F.regexp_extract(whole, r"^([A-Za-z][\w+.-]*:/*)?", 0)
    parts = F.split(F.substr(whole, F.length(scheme) + 1), "/")
    up = lambda done, p: F.when(p == ".", done).when((p == "..") & (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)) != ".."), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(p)))
    return F.when(bare != "", F.concat(scheme, F.array_join(F.aggregate(parts, F.array().cast("array<string>"), up), "/")))


def elements(files: DataFrame, key: str, xml: str, attributes: list[str], depth: int) -> DataFrame:
    """(key, element) of all elements down to a depth below the root."""
    read = files.select(key, xml).where(X.well_formed(F.col(xml))).select(key, X.tree(F.col(xml), attributes, depth)["e"].alias("level"))
    own = lambda c: F.transform(c, lambda x: F.struct(X.local(x["_element"]).alias("element"), *(x[f"_{a}"].alias(a) for a in attributes)))
    levels = [F.col("level")]
    for _ in range(depth - 1):
        levels.append(X.below(levels[-1]))
    return read.select(key, F.explode(reduce(F.concat, [own(F.coalesce(c, F.array())) for c in levels])).alias("x")).select(key, "x.*")


def references(files: DataFrame, key: str, xml: str) -> DataFrame:
    """source, target and kind: which file names which. key: a file's path or address."""
    found = elements(files, key, xml, ["href", "schemaLocation"], 3).where(F.col("element").isin(REFERENCES))
    target = resolved(F.col(key), F.coalesce("href", "schemaLocation"))
    return found.select(F.col(key).alias("source"), target.alias("target"), F.col("element").alias("kind")).where("source IS NOT NULL AND target IS NOT NULL").distinct()


def reach(references: DataFrame, entries: DataFrame) -> DataFrame:
    """Entry, file and depth: all files that an entry rests on, itself (0) included, each with the least depth.

    A join a round, until no entry reaches a new file; rounds are as many as the longest
    way. Each round reads only what the last one found, and is written to the shared folder.
    entries: a column file.
    """
    links = references.select(F.col("source").alias("file"), F.col("target").alias("next")).distinct()
    new = entries.select(F.col("file").alias("entry"), "file").where("file IS NOT NULL").distinct().withColumn("depth", F.lit(0))
    rounds = [new := written(new, "reach")]
    while not new.isEmpty():
        seen = reduce(DataFrame.unionByName, rounds)
        ahead = new.join(links, "file").select("entry", F.col("next").alias("file")).distinct()
        rounds.append(new := written(ahead.join(seen, ["entry", "file"], "left_anti").withColumn("depth", F.lit(len(rounds))), "reach"))
    return reduce(DataFrame.unionByName, rounds[:-1] or rounds)


def concepts(files: DataFrame, key: str, xml: str) -> DataFrame:
    """file, concept, type, period_type, balance, abstract: elements that schemas declare with an id, named as locators name them."""
    found = elements(files, key, xml, CONCEPT_ATTRIBUTES, 1).where("element = 'element' AND id IS NOT NULL")
    return found.select(F.col(key).alias("file"), F.regexp_replace("id", "^([^_]*)_", "$1:").alias("concept"), "type", F.col("periodType").alias("period_type"), "balance", (F.coalesce("abstract", F.lit("false")) == "true").alias("abstract")).distinct()


def with_declared(facts: DataFrame, entry: str, concept: str, reached: DataFrame, declared: DataFrame) -> DataFrame:
    """Facts with type, period_type and balance of their concept, as the nearest file that their entry reaches declares it; null if none does.

    Only concepts that an entry has facts of are looked up, in the files that declare them.
    """
    pairs = facts.select(F.col(entry).alias("entry"), F.col(concept).alias("concept")).distinct()
    where = pairs.join(declared, "concept").join(reached, ["entry", "file"]).groupBy(F.col("entry").alias("_entry"), F.col("concept").alias("_concept"))
    nearest = where.agg(F.min(F.struct("depth", "file", "type", "period_type", "balance")).alias("_d"))
    joined = facts.join(nearest, (F.col(entry) == F.col("_entry")) & (F.col(concept) == F.col("_concept")), "left")
    return joined.withColumns({"declared_type": F.col("_d.type"), "declared_period": F.col("_d.period_type"), "declared_balance": F.col("_d.balance")}).drop("_entry", "_concept", "_d")


def neighbourhood(arcs: DataFrame, starts: DataFrame, depth: int = 1, roles: list[str] | None = None) -> DataFrame:
    """Concept, relation, related, distance: descendants (child) and ancestors (parent) up to a depth, and siblings.

    arcs: kind, linkrole, from_concept and to_concept; starts: a column concept. A way
    stays within one network (kind and linkrole); distance is the least over all networks,
    and siblings have one parent in one network. Starts only are expanded, so rows are as
    many as what lies around the starts. Links are made once, in the shared folder. roles: the linkroles that count; all if None.
    """
    kept = arcs.where(F.col("kind").isin(PARENT_CHILD) & F.col("from_concept").isNotNull() & F.col("to_concept").isNotNull())
    if roles is not None:
        kept = kept.where(F.col("linkrole").isin(roles))
    net = F.concat_ws("|", "kind", F.coalesce("linkrole", F.lit(""))).alias("net")
    links = written(kept.select(net, F.col("from_concept").alias("above"), F.col("to_concept").alias("below")).where("above <> below").distinct(), "links")
    asked = starts.select("concept").where("concept IS NOT NULL").distinct()

    def walk(here: str, there: str, relation: str) -> list[DataFrame]:
        steps, at = [], asked.join(links, F.col("concept") == F.col(here)).select("concept", "net", F.col(there).alias("related"))
        for d in range(1, depth + 1):
            steps.append(at.select("concept", F.lit(relation).alias("relation"), "related", F.lit(d).alias("distance")))
            if d < depth:
                ahead = links.select("net", F.col(here).alias("related"), F.col(there).alias("_next"))
                at = at.join(ahead, ["net", "related"]).select("concept", "net", F.col("_next").alias("related")).distinct()
        return steps

    parents = asked.join(links, F.col("concept") == F.col("below")).select("concept", "net", "above")
    siblings = parents.join(links, ["net", "above"]).select("concept", F.lit("sibling").alias("relation"), F.col("below").alias("related"), F.lit(1).alias("distance"))
    every = reduce(DataFrame.unionByName, [*walk("above", "below", "child"), *walk("below", "above", "parent"), siblings])
    return every.where("concept <> related").groupBy("concept", "relation", "related").agg(F.min("distance").alias("distance"))
