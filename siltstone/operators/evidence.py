"""Packing of evidence within a token budget, and what goes around it."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W
from pyspark.sql.pandas.types import to_arrow_schema

from siltstone.functions.numeric import year_decay
from siltstone.functions.text import EVIDENCE_END, EVIDENCE_STOPWORDS
from siltstone.operators.aggregates import keep_first
from siltstone.operators.joins import modal

SAFEGUARD, LAMBDA, LEAST_LEFT, PER_HEADING, SIGNATURE_WORDS, HEAD = 0.30, 0.65, 50, 3, 80, 20
_SENTENCE = re.compile(EVIDENCE_END)
_WIDE = re.compile("[一-鿿]")


def anchors(hits: DataFrame, by: list[str], rank: str, column: str, head: int = HEAD) -> DataFrame:
    """Commonest value, in lower case, among the first hits."""
    top = hits.where(F.col(rank) <= head).withColumn(column, F.lower(F.col(column).cast("string")))
    return modal(top, by, column, rank)


def commonest(listed: Column, column: str) -> Column:
    """Commonest value of a field of a list of (rank, fields), of equally common ones the first by rank; nulls do not count."""
    known = F.filter(listed, lambda x: x[column].isNotNull())
    values = F.array_distinct(F.transform(known, lambda x: x[column]))

    def weighed(v: Column) -> Column:
        ranks = F.transform(F.filter(known, lambda x: x[column] == v), lambda x: x["rank"])
        return F.struct((-F.size(ranks)).alias("n"), F.array_min(ranks).alias("f"), v.alias("v"))

    return F.array_min(F.transform(values, weighed))["v"]


def align(hits: DataFrame, by: list[str], score: str, rank: str, coverage: bool = False) -> DataFrame:
    """Scores of hits with another ticker, form or year than the anchor are lowered; hits: ticker, form, fy.

    Anchors are those of anchors(), found over the hits as they are sorted once: a question's
    first row settles them and all its rows read them. A null question has none.
    """
    rate, ticker, form = (0.2, 0.8, 0.9) if coverage else (0.6, 0.5, 0.8)
    columns = ("ticker", "form", "fy")
    w = W.Window.partitionBy(*by)
    head = F.struct(F.col(rank).alias("rank"), *(F.lower(F.col(c).cast("string")).alias(c) for c in columns))
    settles = reduce(and_, (F.col(c).isNotNull() for c in by), F.col(rank) == F.min(rank).over(w))
    listed = hits.withColumns({"_head": F.collect_list(F.when(F.col(rank) <= HEAD, head)).over(w), "_settles": settles})
    found = listed.withColumn("_found", F.when(F.col("_settles"), F.struct(*(commonest(F.col("_head"), c).alias(c) for c in columns)))).drop("_head", "_settles")
    out = found.withColumn("_anchor", F.max("_found").over(w)).drop("_found")
    anchor = lambda c: F.col("_anchor")[c]
    other = lambda c, x: F.when(F.coalesce((F.lower(c) != anchor(c)) & (F.col(c) != ""), F.lit(False)), x).otherwise(1.0)
    gap = F.coalesce(F.abs(F.col("fy").cast("string").try_cast("int") - anchor("fy").try_cast("int")), F.lit(0))
    return out.withColumn(score, F.col(score) * other("ticker", ticker) * other("form", form) * year_decay(gap, rate)).drop("_anchor")


def signature(text: str, *salt: str) -> Column:
    """SHA-1 of the salt and the first words."""
    words = F.array_join(F.slice(F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != ""), 1, SIGNATURE_WORDS), " ")
    return F.sha1(F.concat_ws("|", *(F.coalesce(F.col(s).cast("string"), F.lit("")) for s in salt), words))


def cap_signatures(hits: DataFrame, by: list[str], sig: str, score: str, order: str, coverage: bool = False) -> DataFrame:
    """At most 2 of a signature, 10 for coverage, the best ones."""
    return keep_first(hits, [*by, sig], [F.desc(score), order], 10 if coverage else 2)


def accept_if_it_fits(df: DataFrame, by: list[str], order: list[str], size: str, budget: int, columns: list[str]) -> DataFrame:
    """Rows of each group in order, each accepted if it still fits: one that does not is passed by, and a smaller one after it may fit.

    A fold over the group's list with what is used and what is chosen; groups are the hits
    of a question. Rows with a null size are passed by.
    """
    listed = F.array_sort(F.collect_list(F.struct(*order, F.col(size).cast("long").alias("_n"), F.struct(*columns).alias("_row"))))
    kind = dict(df.select(F.struct(*columns).alias("r")).dtypes)["r"]
    start = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast(f"array<{kind}>").alias("chosen"))
    step = lambda s, x: F.when(s["used"] + x["_n"] <= budget, F.struct((s["used"] + x["_n"]).alias("used"), F.array_append(s["chosen"], x["_row"]).alias("chosen"))).otherwise(s)
    folded = df.groupBy(*by).agg(F.aggregate(listed, start, step)["chosen"].alias("_chosen"))
    return folded.select(*by, F.explode("_chosen").alias("_row")).select(*by, "_row.*")


def tokens(s: str) -> int:
    """a token each for CJK letters, else one for four letters."""
    wide = 0 if s.isascii() else len(_WIDE.findall(s))
    return max(1, wide + (len(s) - wide) // 4)


def words(s: str) -> set[str]:
    return set(re.findall(r"[\w一-鿿]+", s.lower())) - set(EVIDENCE_STOPWORDS)


def cut_to(s: str, budget: int) -> str:
    """Whole sentences that fit the budget."""
    out = ""
    for part in _SENTENCE.split(s):
        new = f"{out} {part}" if out else part
        if tokens(new) > budget:
            break
        out = new
    return out


def jaccard(a: set[str], b: set[str]) -> float:
    return len(a & b) / len(a | b) if a | b else 0.0


def pack(hits: list[dict], budget: int, k: int, coverage: bool = False, lam: float = LAMBDA) -> list[dict]:
    """Hits (id, heading, content, score), best first, chosen within the budget.

    A share of the budget first goes to the best hit of each heading, of those without
    one a third of that. For coverage up to three more of each chosen heading follow.
    The rest is filled by relevance and novelty; the last may be cut to whole sentences.
    """
    order = sorted(hits, key=lambda r: (-r["score"], r["id"]))
    groups: dict[str, list[dict]] = {}
    for r in order:
        groups.setdefault(r["heading"] or "", []).append(r)
    chosen: list[dict] = []
    used, limit = 0, int(budget * SAFEGUARD)

    def take(r: dict) -> None:
        nonlocal used
        chosen.append(r)
        used += tokens(r["content"])

    for heading, rows in sorted(groups.items(), key=lambda g: (-g[1][0]["score"], g[0])):
        n = tokens(rows[0]["content"])
        if len(chosen) < k and used + n <= (limit if heading else limit // 3):
            take(rows[0])
    if coverage:
        for first in list(chosen):
            more = [r for r in groups[first["heading"] or ""] if r is not first][: PER_HEADING - 1]
            for r in more:
                if len(chosen) < k and used + tokens(r["content"]) <= budget:
                    take(r)
    ids = {r["id"] for r in chosen}
    rest = [r for r in order if r["id"] not in ids] if len(chosen) < k else []
    own = [words(r["content"]) for r in rest]
    sets = [words(r["content"]) for r in chosen] if rest else []
    #: how much of each hit is known already, by the set that is most like it
    like = [max((jaccard(w, s) for s in sets), default=0.0) for w in own]
    while rest and len(chosen) < k:
        at = max(range(len(rest)), key=lambda i: (lam * rest[i]["score"] - (1 - lam) * like[i], rest[i]["id"]))
        best, new = rest.pop(at), own.pop(at)
        like.pop(at)
        if used + tokens(best["content"]) <= budget:
            take(best)
        elif budget - used <= LEAST_LEFT:
            break
        else:
            short = cut_to(best["content"], budget - used)
            if not short or coverage:
                continue
            take(best | {"content": short})
            new = words(short)
        like = [max(x, jaccard(w, new)) for x, w in zip(like, own, strict=True)]
    return chosen


def pack_evidence(hits: DataFrame, query_id: str, budget: int = 2400, k: int = 8, coverage: bool = False) -> DataFrame:
    """Packed hits of each query with pos. hits: query_id, id, heading, content, score; a few hundred a query, as the ranking before leaves them.

    Hits of a query become one row, and Python takes many queries at a time.
    """

    kinds = {"id": hits.schema["id"].dataType, query_id: hits.schema[query_id].dataType}
    schema = T.StructType([T.StructField(query_id, kinds[query_id]), T.StructField("pos", T.IntegerType()), T.StructField("id", kinds["id"]), T.StructField("heading", T.StringType()), T.StructField("content", T.StringType()), T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            out: list[tuple] = []
            for q, listed in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                rows = [r | {"content": r["content"] or "", "score": math.nan if r["score"] is None else r["score"]} for r in listed]
                out += [(q, i, r["id"], r["heading"], r["content"], r["score"]) for i, r in enumerate(pack(rows, budget, k, coverage))]
            columns = zip(*out, strict=True) if out else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    listed = hits.groupBy(query_id).agg(F.collect_list(F.struct("id", "heading", "content", F.col("score").cast("double").alias("score"))).alias("_hits"))
    return listed.mapInArrow(run, schema)


def evidence_block(packed: DataFrame, query_id: str) -> DataFrame:
    """[id] and text of the packed hits, in order."""
    part = F.concat(F.lit("["), F.col("id").cast("string"), F.lit("]\n"), F.col("content"))
    return packed.groupBy(query_id).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", part.alias("p")))), lambda x: x["p"]), "\n\n").alias("block"))


def running_budget(hits: DataFrame, by: list[str], order: list[Column | str], size: str, budget: int) -> DataFrame:
    """Prefix of hits that fits a budget; unlike pack() it stops at the first that does not."""
    w = W.Window.partitionBy(*by).orderBy(*order).rowsBetween(W.Window.unboundedPreceding, 0)
    return hits.withColumn("used", F.sum(size).over(w)).where(F.col("used") <= budget)


def salvage_json(answer: str) -> dict | None:
    """The outermost object of a model's answer."""
    import json

    m = re.search(r"\{.*\}", answer or "", re.S)
    try:
        return json.loads(m[0]) if m else None
    except ValueError:
        return None
