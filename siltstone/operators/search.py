"""Keyword, vector and hybrid search over batches of queries.

A single question is a table of one row. Statistics of keyword search are those of
the documents that are left after the filter. Queries are a stated set: their terms and
vectors go to the tasks, up to a stated number, beyond which they are joined.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from siltstone.functions.numeric import bm25_idf, bm25_tf
from siltstone.functions.text import BM25_STOPWORDS, TOKEN, bm25_tokens, word_set
from siltstone.operators.joins import fuse_lists, fused_order, match_vocabulary, surface_hits
from siltstone.operators.windows import ranked, top_k
from siltstone.session import written

_TOKEN = re.compile(TOKEN)


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row of each item of an array column without nulls, and the items."""
    n = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(n)), n), column.flatten()


def term_frequencies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, length, term, tf). Terms are counted where their document is; nothing is shuffled."""
    tokens = docs.select(F.col(doc_id).alias("doc"), bm25_tokens(text).alias("t"))

    def count(batches):
        for rb in batches:
            row, flat = _flat(rb.column(1))
            coded = flat.dictionary_encode()
            size = max(len(coded.dictionary), 1)
            pair, tf = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            at = pair // size
            length = np.bincount(row, minlength=rb.num_rows).astype(np.int32)
            yield pa.RecordBatch.from_arrays([rb.column(0).take(pa.array(at)), pa.array(length[at]), coded.dictionary.take(pa.array(pair % size)), pa.array(tf)], names=["doc", "length", "term", "tf"])

    return tokens.mapInArrow(count, f"doc {tokens.schema['doc'].dataType.simpleString()}, length int, term string, tf long")


LISTED = 500_000  # pairs of question and term that travel to the tasks
HELD = 1 << 20  # best documents of all questions that a task holds
RARE = 4  # times k: documents that a term may be in to be looked at for each question
SALTS = 32


def bm25(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query: str, k: int = 10, k1: float = 1.5, b: float = 0.75, listed: int = LISTED) -> DataFrame:
    """Qid, doc, score, rank of the k best documents of each query with a score above 0.

    Repeated query terms count once; ties go to the smaller document id. Texts are read
    and split once: what is kept of a document is its length and the query terms in it,
    and lengths and document frequencies come from that. Each task then scores its
    documents, a bounded number of terms and askers at once, and sends the k best of each query only. A set of queries with more than
    `listed` terms, or more than HELD best documents in all, is joined instead, like any table.
    """
    terms = queries.select(F.col(query_id).alias("qid"), F.explode(F.array_distinct(bm25_tokens(query))).alias("term"))
    pairs = terms.limit(listed + 1).toArrow()
    if pairs.num_rows > listed or len(pairs.column("qid").unique()) * k > HELD:
        return _bm25_joined(docs, terms, doc_id, text, k, k1, b)
    spark = docs.sparkSession
    words = pairs.column("term").combine_chunks().unique()
    tokens = docs.select(F.col(doc_id).alias("doc"), bm25_tokens(text).alias("t"))
    doc_type = tokens.schema["doc"].dataType.simpleString()

    def narrow(batches):
        for rb in batches:
            row, flat = _flat(rb.column(1))
            ids = pc.index_in(flat, value_set=words)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            kept = ids.drop_null().cast(pa.int32())
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[known], minlength=rb.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([rb.column(0), pc.list_value_length(rb.column(1)), pa.ListArray.from_arrays(pa.array(ends), kept)], names=["doc", "length", "ids"])

    kept = written(tokens.mapInArrow(narrow, f"doc {doc_type}, length int, ids array<int>"), "terms")
    total = kept.agg(F.count("*").alias("n"), F.avg("length").alias("avg_len")).first()
    # one number for each listed term
    df = np.zeros(len(words))
    for r in kept.select(F.explode(F.array_distinct("ids")).alias("i")).groupBy("i").count().collect():
        df[r["i"]] = r["count"]
    average = total["avg_len"] or 0.0
    idf = np.log((total["n"] - df + 0.5) / (df + 0.5) + 1)
    qids = pairs.column("qid").combine_chunks().unique()
    of_query = pc.index_in(pairs.column("qid").combine_chunks(), value_set=qids).to_numpy(zero_copy_only=False)
    of_term = pc.index_in(pairs.column("term").combine_chunks(), value_set=words).to_numpy(zero_copy_only=False)
    order = np.argsort(of_term, kind="stable")
    asking, first = of_query[order].astype(np.int64), np.searchsorted(of_term[order], np.arange(len(words) + 1))
    askers = np.diff(first)

    def score(batches):
        best = Leaders(len(qids), k)
        for whole in batches:
            row, flat = _flat(whole.column(2))
            for rb in portions(whole, np.bincount(row, askers[flat.to_numpy(zero_copy_only=False)], whole.num_rows), PAIRS):
                row, flat = _flat(rb.column(2))
                if not len(row):
                    continue
                pair, tf = np.unique(row * len(words) + flat.to_numpy(zero_copy_only=False), return_counts=True)
                at, term = pair // len(words), pair % len(words)
                length = rb.column(1).to_numpy()[at]
                w = idf[term] * (tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / (average + 1e-9)) + 1e-12))
                n = askers[term]
                ends = np.cumsum(n)
                place = np.repeat(first[term] - ends + n, n) + np.arange(ends[-1])
                who, doc, w = asking[place], np.repeat(at, n), np.repeat(w, n)
                order = np.argsort(who, kind="stable")
                who, doc, w = who[order], doc[order], w[order]
                cut = np.searchsorted(who, np.arange(0, len(qids) + CHUNK, CHUNK))
                for q, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                    if j > i:
                        size = min(CHUNK, len(qids) - q * CHUNK)
                        sums = np.bincount((who[i:j] - q * CHUNK) * rb.num_rows + doc[i:j], w[i:j], size * rb.num_rows).reshape(size, rb.num_rows)
                        best.add(q * CHUNK, sums, rb.column(0), sums > 0)
        yield from best.batches(qids)

    schema = f"qid {terms.schema['qid'].dataType.simpleString()}, doc {doc_type}, score double"
    return top_k(kept.mapInArrow(score, schema), ["qid"], [F.desc(F.round("score", 9)), "doc"], k) if len(words) else top_k(spark.createDataFrame([], schema), ["qid"], ["doc"], k)


CHUNK = 2048  # of documents, and of questions, that are scored at once
PAIRS = 1 << 20  # of a document's terms and the questions that ask for them, that are scored at once


def portions(rows: pa.RecordBatch, pairs: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows: at most CHUNK, and of no more than `most` pairs in all, unless a single row has more."""
    ends, a = np.cumsum(pairs), 0
    while a < rows.num_rows:
        fit = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")) - a
        yield rows.slice(a, n := min(max(fit, 1), CHUNK))
        a += n


class Leaders:
    """The k best of each question through all that a task sees: largest score to nine places, then smallest document."""

    def __init__(self, n: int, k: int) -> None:
        self.n, self.k, self.least, self.held, self.rows = n, k, np.full(n, -np.inf), [], 0

    def add(self, first: int, scores: np.ndarray, docs: pa.Array, ok: np.ndarray | None = None) -> None:
        """scores: questions from `first` on by documents; ok: which of them count."""
        shown = np.round(scores, 9)
        if ok is not None:
            shown = np.where(ok, shown, -np.inf)
        edge = np.maximum(kth(shown, self.k), self.least[first : first + len(shown), None])
        q, d = np.nonzero((shown >= edge) & (shown > -np.inf))
        if len(q):
            self.held.append(pa.table({"q": pa.array((q + first).astype(np.int32)), "shown": shown[q, d], "doc": docs.take(pa.array(d)), "score": scores[q, d]}))
            self.rows += len(q)
        if self.rows > 2 * self.n * self.k + (1 << 16):
            self.settle()

    def settle(self) -> pa.Table | None:
        if not self.held:
            return None
        t = pa.concat_tables(self.held).combine_chunks()
        t = t.take(pc.sort_indices(t, sort_keys=[("q", "ascending"), ("shown", "descending"), ("doc", "ascending")], null_placement="at_start"))
        q = t.column("q").to_numpy()
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        full = rank == self.k - 1
        self.least[q[full]] = t.column("shown").to_numpy()[full]
        t = t.filter(pa.array(rank < self.k))
        self.held, self.rows = [t], t.num_rows
        return t

    def batches(self, qids: pa.Array):
        t = self.settle()
        if t is not None:
            out = pa.table({"qid": qids.take(t.column("q").combine_chunks()), "doc": t.column("doc"), "score": t.column("score")})
            yield from out.combine_chunks().to_batches(max_chunksize=1 << 16)


def kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, as a column; the least where there are fewer."""
    if scores.shape[1] <= k:
        return scores.min(axis=1, keepdims=True)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k][:, None]


def bm25_parts(docs: DataFrame, terms: DataFrame, doc_id: str, text: str, k: int, k1: float = 1.5, b: float = 0.75) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What bm25() of any number of queries, as their terms (qid, term), comes from: only occurrences of query terms are counted, and joined with the queries that ask for them.

    A query's documents are those that hold one of its rare terms, with their scores (qid, doc, score), and of
    all others the k best by its frequent terms alone, which are found once for each set of frequent terms
    (set, best), however many queries (qid, set) share it. So a frequent term is not joined with every query.
    """
    wanted = terms.select("term").distinct()
    tokens = docs.select(F.col(doc_id).alias("doc"), bm25_tokens(text).alias("t")).withColumn("length", F.size("t"))
    total = tokens.agg(F.count("*").alias("n"), F.avg("length").alias("avg_len"))
    tf = written(tokens.select("doc", "length", F.explode("t").alias("term")).join(wanted, "term").groupBy("doc", "length", "term").agg(F.count("*").alias("tf")), "terms")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    weights = df.join(F.broadcast(total)).withColumn("idf", bm25_idf(F.col("n"), F.col("df")))
    weighed = tf.join(weights, "term").withColumn("w", F.col("idf") * bm25_tf(F.col("tf"), F.col("length"), F.col("avg_len"), k1, b))
    hits = written(weighed.select("term", "doc", "w", (F.col("df") <= RARE * k).alias("rare")), "weights")
    frequent = hits.where("NOT rare")
    asked = written(terms.join(frequent.select("term").distinct(), "term").groupBy("qid").agg(F.array_sort(F.collect_set("term")).alias("set")), "asked")
    of_set = asked.select("set").distinct().select("set", F.explode("set").alias("term")).join(frequent, "term").groupBy("set", "doc").agg(F.sum("w").alias("score"))
    best = top_k(of_set, ["set"], [F.desc(F.round("score", 9)), "doc"], k).groupBy("set").agg(F.collect_list(F.struct("doc", "score")).alias("best"))
    by_term = terms.join(hits.where("rare"), "term").groupBy("qid", "doc").agg(F.sum("w").alias("w"))
    more = by_term.join(asked, "qid").select("qid", "doc", F.explode("set").alias("term")).join(frequent, ["doc", "term"]).select("qid", "doc", "w")
    whole = by_term.unionByName(more).groupBy("qid", "doc").agg(F.sum("w").alias("score"))
    return asked, best, whole


def _bm25_joined(docs: DataFrame, terms: DataFrame, doc_id: str, text: str, k: int, k1: float, b: float) -> DataFrame:
    """bm25() for any number of queries, from its parts."""
    asked, best, whole = bm25_parts(docs, terms, doc_id, text, k, k1, b)
    salted = best.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    by_set = asked.withColumn("_salt", F.pmod(F.xxhash64("qid"), F.lit(SALTS)).cast("int")).join(salted, ["set", "_salt"]).select("qid", F.explode("best").alias("x")).select("qid", "x.*")
    scored = whole.unionByName(by_set).groupBy("qid", "doc").agg(F.max("score").alias("score")).where("score > 0")
    return top_k(scored, ["qid"], [F.desc(F.round("score", 9)), "doc"], k)


def snippet_of(text: str, query: str, window: int = 40, size: int = 500) -> str:
    """The first stretch of 2 * window words with the most query words, cut to size; short texts whole."""
    if len(text) <= size:
        return text
    terms = {t for t in _TOKEN.findall(query.lower()) if len(t) >= 2 and t not in BM25_STOPWORDS}
    words = text.split()
    hit = np.fromiter((bool(terms & set(_TOKEN.findall(w.lower()))) for w in words), np.int64, len(words))
    total = np.concatenate([[0], np.cumsum(hit)])
    first = np.arange(max(1, len(words) - 2 * window + 1))
    best = int(np.argmax(total[np.minimum(first + 2 * window, len(words))] - total[first]))
    return " ".join(words[best : best + 2 * window])[:size]


def best_snippet(text: str, query: str, window: int = 40, size: int = 500) -> Column:
    """W11 as a column; null texts give null."""

    @F.pandas_udf(T.StringType())
    def cut(t: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else snippet_of(x, y or "", window, size) for x, y in zip(t, q, strict=True)])

    return cut(F.col(text), F.col(query))


SENT_BYTES = 64 << 20  # of query vectors that travel to all tasks, and of vectors that meet a block of queries


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of arrays of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def dense(vectors: DataFrame, queries: DataFrame, vec_id: str, vector: str, query_id: str, query_vector: str, k: int = 10, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """Qid, doc, score, rank of the k vectors with the largest inner product; filters come before.

    Query vectors of up to sent_bytes in all, which are counted first, are sent to the vectors;
    beyond, or if their best are more than HELD in all, both are dealt into blocks of about
    that size, and each pair of blocks meets once; of equal vectors only the k first can be
    among the best, so no more meet. Either way a task sends the k best of each of its queries only.
    """
    spark = vectors.sparkSession
    q = queries.select(F.col(query_id).alias("qid"), F.col(query_vector).alias("v")).where("v IS NOT NULL")
    near = vectors.select(F.col(vec_id).alias("doc"), F.col(vector).alias("v")).where("v IS NOT NULL")
    schema = f"qid {q.schema['qid'].dataType.simpleString()}, doc {near.schema['doc'].dataType.simpleString()}, score double"
    order = [F.desc(F.round("score", 9)), "doc"]
    size, asking = (x or 0 for x in q.agg(F.sum(8 * F.size("v")), F.count("*")).first())

    def best_of(qids: pa.Array, asked: np.ndarray, batches):
        best = Leaders(len(qids), k)
        for whole in batches:
            for a in range(0, whole.num_rows, CHUNK):
                rb = whole.slice(a, CHUNK)
                v = matrix(rb.column(1))
                for i in range(0, len(asked), CHUNK):
                    best.add(i, asked[i : i + CHUNK] @ v.T, rb.column(0))
        yield from best.batches(qids)

    if not size:
        return top_k(spark.createDataFrame([], schema), ["qid"], ["doc"], k)
    if size <= sent_bytes and asking * k <= HELD:
        t = q.toArrow()  # at most sent_bytes
        shared = spark.sparkContext.broadcast((t.column("qid").combine_chunks(), matrix(t.column("v").combine_chunks())))
        return top_k(near.mapInArrow(lambda batches: best_of(*shared.value, batches), schema), ["qid"], order, k)
    near = written(top_k(near, ["v"], ["doc"], k).select("doc", "v"), "vectors")
    blocks = max(-(-size // sent_bytes), -(-asking * k // HELD))
    slices = max(1, -(-(near.agg(F.sum(8 * F.size("v"))).first()[0] or 0) // sent_bytes))
    deal = lambda df, own, n, other, m: df.withColumns({own: F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int"), other: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))})

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        rows = b.select(["doc", "v"]).combine_chunks().to_batches() if len(a) else []
        out = list(best_of(a.column("qid").combine_chunks(), matrix(a.column("v").combine_chunks()), rows)) if len(a) else []
        empty = pa.table({"qid": a.column("qid").slice(0, 0), "doc": b.column("doc").slice(0, 0), "score": pa.array([], pa.float64())})
        return pa.Table.from_batches(out) if out else empty

    sides = deal(q, "_block", blocks, "_slice", slices).groupBy("_block", "_slice"), deal(near, "_slice", slices, "_block", blocks).groupBy("_block", "_slice")
    return top_k(sides[0].cogroup(sides[1]).applyInArrow(meet, schema), ["qid"], order, k)


def dense_parts(vectors: DataFrame, queries: DataFrame, vec_id: str, vector: str, query_id: str, query_vector: str, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """What dense() of many queries comes from: queries (qid, rep) that stand for all with an equal vector, and their best (rep, doc, score, rank), found once."""
    q = queries.select(F.col(query_id).alias("qid"), F.col(query_vector).alias("v")).where("v IS NOT NULL")
    reps = written(q.groupBy("v").agg(F.min("qid").alias("rep")), "vectors")
    return q.join(reps, "v").select("qid", "rep"), dense(vectors, reps, vec_id, vector, "rep", "v", k).withColumnRenamed("qid", "rep")


def normalised(by: list[str], score: str, kind: str = "minmax", constant: float | None = 0.5) -> Column:
    """Min-max (a constant list gives `constant`, or stays if None) or z-score within each list."""
    w = W.Window.partitionBy(*by)
    s = F.col(score)
    if kind == "zscore":
        return (s - F.avg(score).over(w)) / (F.stddev_pop(score).over(w) + 1e-12)
    lo, hi = F.min(score).over(w), F.max(score).over(w)
    flat = F.lit(constant) if constant is not None else s
    return F.when(hi > lo, (s - lo) / (hi - lo)).otherwise(flat)


def fuse_scores(df: DataFrame, by: list[str], dense_score: str, ce_score: str | None, mode: str = "linear", alpha: float = 0.5, kind: str = "minmax") -> DataFrame:
    """Adds fused: normalised dense, normalised cross-encoder, or their mix."""
    d = normalised(by, dense_score, kind)
    if mode == "dense" or ce_score is None:
        return df.withColumn("fused", d)
    c = normalised(by, ce_score, kind)
    return df.withColumn("fused", c if mode == "ce" else alpha * c + (1 - alpha) * d)


def lexical_overlap(query: str, text: str) -> Column:
    """Stands in for a cross-encoder: share of the query's words in the text; columns are word sets."""
    return F.when(F.size(query) > 0, F.size(F.array_intersect(query, text)) / F.size(query)).otherwise(0.0)


def model_scores(logits: np.ndarray) -> np.ndarray:
    """One logit as it is; of several the softmax of the second."""
    z = np.asarray(logits, np.float64)
    z = z.reshape(len(z), -1)
    if z.shape[1] == 1:
        return z[:, 0]
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e[:, 1] / e.sum(axis=1)


def cross_encoder(model: Callable[[list[tuple[str, str]]], np.ndarray], batch: int = 16) -> Callable[[str, str], Column]:
    """A scorer for hybrid() from a model that gives a row of logits for each (query, text); it sees `batch` pairs at a time."""

    @F.pandas_udf(T.DoubleType())
    def score(q: pd.Series, t: pd.Series) -> pd.Series:
        pairs = list(zip(q.fillna(""), t.fillna(""), strict=True))
        out = [model_scores(model(pairs[a : a + batch])) for a in range(0, len(pairs), batch)]
        return pd.Series(np.concatenate(out) if out else np.empty(0))

    return lambda query, text: score(F.col(query), F.col(text))


def format_hits(hits: DataFrame, rank: str, score: str, doc: str, heading: str, text: str, width: int = 160) -> DataFrame:
    """Adds line, a hit as one reads it: rank, score, id, heading and the beginning of the text."""
    head = F.when(F.coalesce(F.trim(heading), F.lit("")) != "", F.concat(F.lit(" | "), F.trim(heading))).otherwise("")
    short = F.substring(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), 1, width)
    return hits.withColumn("line", F.concat(F.col(rank).cast("string"), F.lit(". ["), F.format_string("%.4f", F.col(score)), F.lit("] "), F.col(doc).cast("string"), head, F.lit(" | "), short))


def hybrid(bm25_hits: DataFrame, dense_hits: DataFrame, contents: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query: str, candidates: int = 256, k: int = 8, rrf_k: float = 60.0, weights: tuple[float, float] = (2.0, 2.0), ce_weight: float = 0.5, score: Callable[[str, str], Column] = lexical_overlap, prepare: Callable[[str], Column] | None = word_set, strict: Column | None = None) -> DataFrame:
    """Both lists fused by rank, contents fetched, scored again and mixed: rrf * (1 - w) + min-max(score) * w.

    prepare: what score() wants to see of a text or query, made once for each and not for
    each pair; None for the text itself, as a cross-encoder wants it. strict: a filter over
    contents (P04) that hits of both lists must pass before they are fused; those left
    move up in rank.
    """
    if strict is not None:
        hit = bm25_hits.select("doc").unionByName(dense_hits.select("doc")).distinct()
        passed = contents.where(strict).select(F.col(doc_id).alias("doc")).join(hit, "doc", "left_semi").distinct()
        bm25_hits, dense_hits = (ranked(h.join(passed, "doc", "left_semi"), ["qid"], ["rank", "doc"]) for h in (bm25_hits, dense_hits))
    fused = ranked(fuse_lists(bm25_hits, dense_hits, ["qid", "doc"], rrf_k, weights), ["qid"], [*fused_order(), "doc"], "_r").where(F.col("_r") <= candidates)
    shown = prepare or F.col
    found = contents.join(fused.select(F.col("doc").alias(doc_id)).distinct(), doc_id, "left_semi")
    texts = found.select(F.col(doc_id).alias("doc"), shown(text).alias("_text"))
    asked = queries.select(F.col(query_id).alias("qid"), shown(query).alias("_query"))
    pairs = fused.join(texts, "doc").join(asked, "qid").withColumn("ce", score("_query", "_text"))
    mixed = pairs.withColumn("ce_norm", normalised(["qid"], "ce", "minmax", None)).withColumn("final_score", F.col("rrf") * (1 - ce_weight) + F.col("ce_norm") * ce_weight)
    best = top_k(mixed, ["qid"], [F.desc(F.round("final_score", 9)), F.col("_r")], k)
    return best.select("qid", "doc", "rank", "rrf", "ce", "final_score")


#: Intents of a query that the rule reranker knows, and a row of three years.
YOY = r"\b(yoy|year[- ]over[- ]year|compared to 20\d{2}|increased? \d+%|decreased? \d+%)\b"
FX = r"\b(foreign exchange|fx|currency|currencies|u\.s\. dollar|usd)\b"
MARGIN = r"\bgross margin( percentage| %)\b"
RESEARCH = r"\b(r&d|research and development)\b"
THREE_YEARS = r"\b20\d{2}\b.*\b20\d{2}\b.*\b20\d{2}\b"


def rule_score(query: str, heading: str, content: str, concepts: str, labels: str | None = None) -> Column:
    """Bonus of the rules, -0.2 at least. labels: main labels of the concepts, which count if the heading has one."""
    q, h, t = (F.lower(F.coalesce(F.col(c), F.lit(""))) for c in (query, heading, content))
    points = lambda ok, x: F.when(F.coalesce(ok, F.lit(False)), x).otherwise(0.0)
    named = F.exists(labels, lambda x: F.coalesce((x != "") & F.contains(h, F.lower(x)), F.lit(False))) if labels else F.lit(False)
    total = (
        points(F.size(concepts) > 0, 0.15)
        + points(named, 0.05)
        + points(q.rlike(YOY) & (t.contains("compared to") | t.rlike(THREE_YEARS)), 0.08)
        + points(q.rlike(FX) & t.rlike("foreign|currency|u\\.s\\. dollar|usd"), 0.08)
        + points(q.rlike(MARGIN) & (h.contains("gross margin") | t.contains("%")), 0.08)
        + points(q.rlike(RESEARCH) & (h.contains("operating expenses") | t.contains("research and development")), 0.08)
        + points(h.rlike("signature|cover|table of contents|index"), -0.15)
    )
    return F.greatest(F.lit(-0.2), total)


def rule_rerank(df: DataFrame, by: list[str], dense_score: str, sparse_score: str, rule: Column) -> DataFrame:
    """0.6 dense + 0.3 sparse, both min-max, + rule."""
    return df.withColumn("score", 0.6 * normalised(by, dense_score, "minmax", 0.0) + 0.3 * normalised(by, sparse_score, "minmax", 0.0) + rule)


def expand_query(queries: DataFrame, query_id: str, query: str, surfaces: DataFrame, relations: DataFrame) -> DataFrame:
    """Qid and terms: surfaces of hit concepts and of related ones, and years of the query. surfaces: concept, surface; relations: concept, related.

    What a concept brings is settled once for each concept, before queries come in: related
    concepts without a surface add nothing, however many there are.
    """
    hits = surface_hits(queries.select(F.col(query_id).alias("qid"), F.col(query).alias("q")), "q", surfaces, "surface").select("qid", "concept").distinct()
    own = surfaces.select("concept", F.col("surface").alias("term"))
    near = relations.select(F.col("concept").alias("_from"), F.col("related").alias("concept")).join(own, "concept").select(F.col("_from").alias("concept"), "term")
    brought = own.unionByName(near).where("term IS NOT NULL").groupBy("concept").agg(F.collect_set("term").alias("_terms"))
    terms = hits.join(brought, "concept").select("qid", F.explode("_terms").alias("term"))
    years = queries.select(F.col(query_id).alias("qid"), F.explode(F.regexp_extract_all(query, F.lit(r"\b(20\d{2})\b"), 1)).alias("term"))
    return terms.unionByName(years).groupBy("qid").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def pattern_expansion(queries: DataFrame, query_id: str, query: str, patterns: DataFrame) -> DataFrame:
    """Terms of the patterns (pattern, term) that match the query."""
    hit = match_vocabulary(queries, patterns, F.call_function("rlike", F.lower(F.col(query)), F.col("pattern")))
    return hit.groupBy(F.col(query_id).alias("qid")).agg(F.sort_array(F.collect_set("term")).alias("terms"))


def entity_boost(score: str, orgs: tuple[str, str], places: tuple[str, str], tickers: tuple[str, str]) -> Column:
    """Times 1 plus .15, .05 and .10 for shared organisations, places and tickers; pairs of array columns."""
    part = lambda pair, x: F.when(F.coalesce(F.arrays_overlap(*pair), F.lit(False)), x).otherwise(0.0)
    return F.col(score) * (1 + part(orgs, 0.15) + part(places, 0.05) + part(tickers, 0.10))


def prior_boost(score: str, tag: str, other_years: str, labels: str) -> Column:
    """Section, other years and entities."""
    t = F.lower(F.coalesce(F.col(tag), F.lit("")))
    by_tag = F.when(t == "risk_factors", 1.20).when(t == "fwd_statements", 0.92).when(t.contains("md&a"), 0.85).otherwise(1.0)
    return F.col(score) * by_tag * F.when(F.coalesce(F.col(other_years), F.lit(False)), 0.90).otherwise(1.0) * F.when(F.coalesce(F.size(labels), F.lit(0)) > 0, 1.03).otherwise(1.0)


def hashed_embedding(texts: list[str], size: int) -> np.ndarray:
    """Hashed words with signs, of unit length (zero without words); stands in for a model."""
    out = np.zeros((len(texts), size))
    for i, t in enumerate(texts):
        for w in _TOKEN.findall(t.lower()):
            if len(w) >= 2 and w not in BM25_STOPWORDS:
                h = zlib.crc32(w.encode())
                out[i, h % size] += 1 if h >> 16 & 1 else -1
    n = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, n, out=out, where=n > 0).astype(np.float32)


def embed_texts(df: DataFrame, text: str, size: int = 64, encoder: Callable[[list[str], int], np.ndarray] = hashed_embedding, item: T.DataType | None = None) -> DataFrame:
    """Adds embedding, of unit length; the encoder takes texts in batches. item: what components are stored as, float if None."""

    @F.pandas_udf(T.ArrayType(item or T.FloatType()))
    def embed(s: pd.Series) -> pd.Series:
        return pd.Series(list(encoder([t or "" for t in s], size)))

    return df.withColumn("embedding", embed(F.col(text)))
