"""Joins of facts, labels, contents and ids."""

from __future__ import annotations

from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W
from pyspark.sql.pandas.types import to_arrow_schema


def ranked_labels(labels: DataFrame, keys: list[str], role: str, lang: str, preferred: str | None = None) -> DataFrame:
    """The label of each key: preferred role first, then language, then role."""
    first = F.when(F.col(role) == preferred, 0).otherwise(1) if preferred else F.lit(0)
    w = W.Window.partitionBy(*keys).orderBy(first, F.coalesce(lang, F.lit("")), role)
    return labels.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def fact_star(facts: DataFrame, contexts: DataFrame, units: DataFrame, labels: DataFrame, context_key: list[str], unit_key: list[str], label_key: list[str]) -> DataFrame:
    """Facts with context, unit and one label each; nothing that is missing drops a fact. labels: one row a key."""
    return facts.join(contexts, context_key, "left").join(units, unit_key, "left").join(labels, label_key, "left")


def fetch_content(ids: DataFrame, contents: DataFrame, key: str, order: str, texts: list[str]) -> DataFrame:
    """For each id the first row's first text that is not blank."""
    text = F.coalesce(*(F.nullif(F.trim(F.col(t)), F.lit("")) for t in texts))
    found = contents.join(ids.select(key).distinct(), key, "left_semi").withColumn("content", text).where("content IS NOT NULL")
    first = found.groupBy(key).agg(F.min_by("content", order).alias("content"))
    return ids.join(first, key, "left")


def missing_source(meta: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """J09."""
    return meta.join(chunks, key, "left_anti")


def valid_citations(citations: DataFrame, packed: DataFrame, key: str, quote: str, size: int = 240) -> DataFrame:
    """Of packed records and with a quote, which is cut to size with an ellipsis."""
    q = F.trim(F.col(quote))
    cut = F.when(F.length(q) > size, F.concat(F.substring(q, 1, size), F.lit(" ..."))).otherwise(q)
    return citations.where(F.coalesce(q != "", F.lit(False))).join(packed, key, "left_semi").withColumn(quote, cut)


def alias_lookup(names: DataFrame, registry: DataFrame, name: str, variants: str, value: str, order: str) -> DataFrame:
    """Value of the last registry row with a variant equal to the name; registry has an array of variants."""
    flat = registry.select(F.explode(variants).alias("_v"), F.col(value).alias("_value"), F.col(order).alias("_o"))
    last = flat.groupBy("_v").agg(F.max_by("_value", "_o").alias(value))
    return names.join(last, F.upper(F.trim(F.col(name))) == F.col("_v"), "left").drop("_v")


def backfill(rows: DataFrame, facts: DataFrame, keys: list[str], value: str, order: str, force: bool = False) -> DataFrame:
    """First value in order that is not blank, where a row has none, or everywhere if forced."""
    given = F.nullif(F.trim(F.col(value).cast("string")), F.lit(""))
    first = facts.where(given.isNotNull()).groupBy(*keys).agg(F.min_by(value, order).alias("_fill"))
    own = F.nullif(F.trim(F.col(value).cast("string")), F.lit(""))
    new = F.coalesce("_fill", own) if force else F.coalesce(own, F.col("_fill"))
    return rows.join(first, keys, "left").withColumn(value, new).drop("_fill")


def fill_from(rows: DataFrame, meta: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Given columns of rows, where they are null those of meta; meta has one row a key."""
    other = meta.select(*keys, *[F.col(c).alias(f"_meta_{c}") for c in columns])
    return rows.join(other, keys, "left").withColumns({c: F.coalesce(c, f"_meta_{c}") for c in columns}).drop(*[f"_meta_{c}" for c in columns])


def modal(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Commonest value of each key, of equally common ones the first in order."""
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(order).alias("_f"))
    return n.groupBy(*keys).agg(F.min_by(value, F.struct((-F.col("_n")).alias("n"), "_f")).alias(value))


def in_blocks(vocabulary: DataFrame, rows: int = 10_000) -> list[DataFrame]:
    """A stated vocabulary as tables of at most that many rows, each small enough to broadcast."""
    spark, out, held = vocabulary.sparkSession, [], []
    for r in vocabulary.toLocalIterator():
        held.append(tuple(r))
        if len(held) == rows:
            out.append(spark.createDataFrame(held, vocabulary.schema))
            held = []
    if held or not out:
        out.append(spark.createDataFrame(held, vocabulary.schema))
    return out


def match_vocabulary(texts: DataFrame, vocabulary: DataFrame, on: Column) -> DataFrame:
    """Rows of texts with each vocabulary row for which `on` holds; texts stay where they are, the vocabulary comes in blocks."""
    return reduce(DataFrame.unionByName, [texts.join(F.broadcast(b), on) for b in in_blocks(vocabulary)])


def surface_hits(texts: DataFrame, text: str, surfaces: DataFrame, surface: str, rows: int = 200_000) -> DataFrame:
    """Texts with each surface form that they contain, in any case.

    An automaton of all surfaces finds them in one reading of a text, however many there
    are; a vocabulary of more than `rows` comes in several. An empty surface is in every text.
    """
    fields = [*texts.schema.fields, *surfaces.schema.fields]
    schema = T.StructType(fields)
    lowered = surfaces.where(F.col(surface).isNotNull()).withColumn("_l", F.lower(surface))
    asked = texts.where(F.col(text).isNotNull()).withColumn("_l", F.lower(text))
    arrow = to_arrow_schema(surfaces.schema)

    def finder(listed: list[Row]):
        places: dict[str, list[int]] = {}
        for i, r in enumerate(listed):
            places.setdefault(r["_l"], []).append(i)
        columns = [pa.array([r[i] for r in listed], f.type) for i, f in enumerate(arrow)]

        def run(batches):
            automaton = ahocorasick.Automaton()
            for s, at in places.items():
                if s:
                    automaton.add_word(s, at)
            automaton.make_automaton()
            for rb in batches:
                row, found = [], []
                for n, t in enumerate(rb.column(rb.num_columns - 1).to_pylist()):
                    seen = {i for _, at in automaton.iter(t) for i in at} if len(automaton) else set()
                    seen.update(places.get("", ()))
                    row += [n] * len(seen)
                    found += sorted(seen)
                at, which = pa.array(row, pa.int64()), pa.array(found, pa.int64())
                yield pa.RecordBatch.from_arrays([*(c.take(at) for c in rb.columns[:-1]), *(c.take(which) for c in columns)], names=schema.fieldNames())

        return run

    out, held = [], []
    for r in lowered.toLocalIterator():  # a stated vocabulary
        held.append(r)
        if len(held) == rows:
            out.append(asked.mapInArrow(finder(held), schema))
            held = []
    return reduce(DataFrame.unionByName if len(set(schema.fieldNames())) == len(fields) else DataFrame.union, [*out, asked.mapInArrow(finder(held), schema)])


def fuse_lists(a: DataFrame, b: DataFrame, key: list[str], k: float = 60.0, weights: tuple[float, float] = (2.0, 2.0)) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists with a column rank; a row for every id of either.

    Ties: the first list's rank, then the second's, then the key.
    """
    both = a.select(*key, F.col("rank").alias("rank_a")).join(b.select(*key, F.col("rank").alias("rank_b")), key, "full")
    part = lambda r, w: F.coalesce(F.lit(float(w)) / (F.lit(float(k)) + F.col(r)), F.lit(0.0))
    return both.withColumn("rrf", part("rank_a", weights[0]) + part("rank_b", weights[1]))


def fused_order() -> list[Column]:
    return [F.desc("rrf"), F.asc_nulls_last("rank_a"), F.asc_nulls_last("rank_b")]


def resolve_arcs(arcs: DataFrame, locators: DataFrame, role: str = "linkrole") -> DataFrame:
    """Ends of arcs from locator labels to concepts; arcs with an end that is unknown are dropped. locators: linkrole, label, concept."""
    one = locators.select(role, F.col("label").alias("from_label"), F.col("concept").alias("from_concept"))
    two = locators.select(role, F.col("label").alias("to_label"), F.col("concept").alias("to_concept"))
    return arcs.join(one, [role, "from_label"]).join(two, [role, "to_label"])
