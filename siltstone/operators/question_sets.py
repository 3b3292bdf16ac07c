"""Hybrid search for many questions: what questions share is found once, and met once.

Of keyword search, questions with the same frequent terms share a list of documents; of
vector search, those with the same vector do. A question's own are only the documents with
one of its rare terms. Lists are fused and scored again where the questions of a group meet
them, a bounded number at once, so that no row is made for a question and a candidate.
Results are those of hybrid() over bm25() and dense().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import bm25_tokens, word_set
from siltstone.operators import search
from siltstone.operators.windows import top_k
from siltstone.session import written

AT_ONCE = 1 << 19  # candidates of all questions that meet their lists at once


def hybrid_of_many(contents: DataFrame, queries: DataFrame, doc_id: str, text: str, vector: str, query_id: str, query: str, query_vector: str, hits: int = 200, candidates: int = 256, k: int = 8, rrf_k: float = 60.0, weights: tuple[float, float] = (2.0, 2.0), ce_weight: float = 0.5, at_once: int = AT_ONCE) -> DataFrame:
    """Qid, doc, rank, rrf, ce, final_score of the k best; contents has one row an id, queries one a question. hits: of each leg."""
    asked = written(queries.select(F.col(query_id).alias("qid"), F.col(query).alias("query"), F.col(query_vector).alias("v")).where("qid IS NOT NULL"), "questions")
    terms = asked.select("qid", F.explode(F.array_distinct(bm25_tokens("query"))).alias("term"))
    sets, by_set, own = search.bm25_parts(contents, terms, doc_id, text, hits)
    alike, by_vector = search.dense_parts(contents, asked, doc_id, vector, "qid", "v", hits)
    texts = contents.select(F.col(doc_id).alias("doc"), word_set(text).alias("words"))
    words = asked.select("qid", word_set("query").alias("asked"))
    first = top_k(own, ["qid"], [F.desc(F.round("score", 9)), "doc"], hits).join(texts, "doc").join(words, "qid")
    owned = first.withColumn("ce", search.lexical_overlap("asked", "words")).groupBy("qid").agg(F.collect_list(F.struct("doc", "score", "ce")).alias("own"))
    doc_type = texts.schema["doc"].dataType.simpleString()
    none = lambda t: F.array().cast(t)
    joined = words.join(sets, "qid", "left").join(alike, "qid", "left").join(owned, "qid", "left")
    questions = written(joined.select("qid", "asked", F.coalesce("set", none("array<string>")).alias("set"), "rep", F.coalesce("own", none(f"array<struct<doc:{doc_type},score:double,ce:double>>")).alias("own")), "asked")
    size = F.lit(2 * hits) + F.size("own")
    groups = written(questions.groupBy(F.col("set").alias("_set"), F.col("rep").alias("_rep")).agg(F.min("qid").alias("gid"), F.ceil(F.sum(size) / at_once).cast("int").alias("blocks")), "groups")
    placed = questions.join(groups, (F.col("set") == F.col("_set")) & F.col("rep").eqNullSafe(F.col("_rep"))).select("gid", F.pmod(F.xxhash64("qid"), F.col("blocks")).cast("int").alias("block"), "qid", "asked", "own")
    keyed = groups.join(by_set, F.col("_set") == F.col("set")).select("gid", "blocks", F.explode("best").alias("x")).select("gid", "blocks", "x.doc", "x.score", F.lit(None).cast("int").alias("rank"))
    near = groups.join(by_vector, F.col("_rep") == F.col("rep")).select("gid", "blocks", "doc", F.lit(None).cast("double").alias("score"), "rank")
    listed = keyed.unionByName(near).groupBy("gid", "blocks", "doc").agg(F.max("score").alias("score"), F.max("rank").alias("rank")).join(texts, "doc")
    lists = listed.select(F.col("gid").alias("of"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), "doc", "score", "rank", "words")
    schema = f"qid {words.schema['qid'].dataType.simpleString()}, doc {doc_type}, rank int, rrf double, ce double, final_score double"
    places = fused_places(hits, rrf_k, weights)

    def meet(q: pa.Table, shared: pa.Table) -> pa.Table:
        return fused(q, shared, places, hits, candidates, k, rrf_k, weights, ce_weight)

    return placed.groupBy("gid", "block").cogroup(lists.groupBy("of", "part")).applyInArrow(meet, schema)


def rrf(a: np.ndarray, b: np.ndarray, k: float, weights: tuple[float, float]) -> np.ndarray:
    """Reciprocal ranks of both lists; rank 0: not in the list."""
    part = lambda r, w: np.where(r > 0, w / (k + r), 0.0)
    return part(a, weights[0]) + part(b, weights[1])


def fused_places(hits: int, k: float, weights: tuple[float, float]) -> np.ndarray:
    """Place of each pair of ranks in the order of fused lists, by both ranks."""
    a, b = (x.ravel() for x in np.indices((hits + 1, hits + 1)))
    last = lambda r: np.where(r > 0, r, hits + 1)
    out = np.empty(len(a), np.int64)
    out[np.lexsort((last(b), last(a), -rrf(a, b, k, weights)))] = np.arange(len(a))
    return out.reshape(hits + 1, hits + 1)


def positions(rows: np.ndarray, n: int) -> np.ndarray:
    """Position within its row, from 1, of each of the sorted rows."""
    return np.arange(1, len(rows) + 1) - np.searchsorted(rows, np.arange(n))[rows]


def overlaps(asked: pa.Array, words: pa.Array) -> np.ndarray:
    """Share of each question's words, which are distinct, that each text has; as lexical_overlap()."""
    row, flat = search._flat(asked)
    vocabulary = flat.unique()
    at, listed = search._flat(words)
    found = pc.index_in(listed, value_set=vocabulary)
    known = found.is_valid().to_numpy(zero_copy_only=False)
    used, place = np.unique(found.drop_null().to_numpy(zero_copy_only=False), return_inverse=True)
    has = np.zeros((len(used), len(words)), np.int32)
    has[place, at[known]] = 1
    word = pc.index_in(flat, value_set=vocabulary).to_numpy(zero_copy_only=False)
    order = np.argsort(word, kind="stable")
    row_of, word = row[order], word[order]
    out = np.zeros((len(asked), len(words)), np.int32)
    for i, (a, b) in enumerate(zip(np.searchsorted(word, used), np.searchsorted(word, used, "right"), strict=True)):
        out[row_of[a:b]] += has[i]
    return out / np.maximum(np.bincount(row, minlength=len(asked)), 1)[:, None]


def fused(q: pa.Table, shared: pa.Table, places: np.ndarray, hits: int, candidates: int, k: int, rrf_k: float, weights: tuple[float, float], ce_weight: float) -> pa.Table:
    """The k best of questions (qid, asked, own) that share their lists (doc, score or null, rank or null, words)."""
    n, each = q.num_rows, np.arange(q.num_rows)[:, None]
    own_row, own = search._flat(q.column("own").combine_chunks())
    docs = shared.column("doc").combine_chunks()
    every = pa.concat_arrays([docs, pc.struct_field(own, 0).cast(docs.type)])
    known = every.unique()
    known = known.take(pc.sort_indices(known))
    size = max(len(known), 1)
    code = pc.index_in(every, value_set=known).to_numpy(zero_copy_only=False).astype(np.int64)
    at, own_at = code[: len(docs)], code[len(docs) :]
    own_score, own_ce = (pc.struct_field(own, i).to_numpy(zero_copy_only=False) for i in (1, 2))
    own_key = own_row * size + own_at

    score = shared.column("score").to_numpy()
    by_set = np.flatnonzero(~np.isnan(score.astype(np.float64)))
    own_score, score = np.round(own_score, 9), np.round(score[by_set].astype(np.float64), 9)
    levels = np.unique(np.concatenate([own_score, score]))
    level = lambda s: len(levels) - 1 - np.searchsorted(levels, s)
    set_key = (each * size + at[by_set]).ravel()
    new = ~np.isin(set_key, own_key)
    width = max(len(levels), 1) * size
    packed = np.sort(np.concatenate([own_row * width + level(own_score) * size + own_at, (each * width + level(score) * size + at[by_set]).ravel()[new]]))
    row = packed // width
    rank_a = positions(row, n)
    key_a = (row * size + packed % size)[rank_a <= hits]
    rank_a = rank_a[rank_a <= hits]

    near = shared.column("rank").to_numpy().astype(np.float64)
    by_vector = np.flatnonzero(~np.isnan(near))
    key_b = (each * size + at[by_vector]).ravel()
    both = np.union1d(key_a, key_b)
    a, b = np.zeros(len(both), np.int64), np.zeros(len(both), np.int64)
    a[np.searchsorted(both, key_a)] = rank_a
    b[np.searchsorted(both, key_b)] = np.tile(near[by_vector].astype(np.int64), n)

    order = np.argsort(both // size * places.size + places[a, b])
    key, a, b = both[order], a[order], b[order]
    r = positions(key // size, n)
    key, a, b, r = (x[r <= candidates] for x in (key, a, b, r))
    row, doc = key // size, key % size

    place = np.zeros(size, np.int64)
    place[at] = np.arange(len(at))
    ce = overlaps(q.column("asked").combine_chunks(), shared.column("words").combine_chunks())[row, place[doc]] if len(at) else np.zeros(len(key))
    if len(own_key):
        order = np.argsort(own_key)
        i = np.minimum(np.searchsorted(own_key, key, sorter=order), len(own_key) - 1)
        ce = np.where(own_key[order[i]] == key, own_ce[order[i]], ce)
    lo, hi = np.full(n, np.inf), np.full(n, -np.inf)
    if len(row):
        there, first = np.unique(row, return_index=True)
        lo[there], hi[there] = np.minimum.reduceat(ce, first), np.maximum.reduceat(ce, first)
    flat = ~(hi > lo)[row]
    norm = np.where(flat, ce, (ce - lo[row]) / np.where(flat, 1.0, hi[row] - lo[row]))
    score = rrf(a, b, rrf_k, weights)
    final = score * (1 - ce_weight) + norm * ce_weight
    table, where = np.full((n, candidates), -np.inf), np.zeros((n, candidates), np.int64)
    table[row, r - 1], where[row, r - 1] = np.round(final, 9), np.arange(len(row))
    best = np.argsort(-table, axis=1, kind="stable")[:, :k]
    i, j = np.nonzero(np.take_along_axis(table, best, 1) > -np.inf)
    taken = where[i, best[i, j]]
    return pa.table({"qid": q.column("qid").combine_chunks().take(pa.array(i)), "doc": known.take(pa.array(doc[taken])), "rank": pa.array((j + 1).astype(np.int32)), "rrf": score[taken], "ce": ce[taken], "final_score": final[taken]})
