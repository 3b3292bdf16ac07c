"""A stored inverted index for keyword search (R03, S26, S27), kept up to date by parts.

Documents are dealt to parts by a hash of their id and numbered within them. Postings of a
term are stored in blocks: all in one range of numbers, in order, with the block's largest
frequency and least length, from which an upper bound of its scores follows whatever the
statistics are. A part's file is sorted by term, so a question reads its terms' postings and
lengths of documents, and no text.

Answers are those of search.bm25() over the same documents. A filter on stored columns comes
before statistics: documents that pass it are counted, and postings thinned by it, before
frequencies are taken. The walk goes range by range. Of each range the sum of its blocks'
bounds says what a question can find there at best; the most promising range of each question
is walked first, and gives the score that others have to reach. Within a range the same
holds for its cells: blocks are opened only where the bound reaches the score of
the k-th best so far.

Ids have to be distinct and not null. A null text has no words but counts as a document.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.numeric import bm25_idf, bm25_tf
from siltstone.functions.text import bm25_tokens
from siltstone.operators.windows import top_k
from siltstone.session import written
from siltstone.sources.snapshots import SnapshotStore

RANGE = 8192  # numbers that are walked at once
CELLS = 128  # of a range
BLOCK = 128  # postings
PART_DOCS = 1 << 18
TASK_DOCS = 2048  # documents of a task, whatever the number of parts
LISTED = 500_000  # pairs of question and term that travel to the tasks
POSTINGS = "part int, range int, term string, block int, n int, first int, last int, most_tf int, least_length int, numbers binary, tfs binary, lengths binary"
_POSTED = [("part", pa.int32()), ("range", pa.int32()), ("term", pa.string()), ("block", pa.int32()), ("n", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("most_tf", pa.int32()), ("least_length", pa.int32()), ("numbers", pa.binary()), ("tfs", pa.binary()), ("lengths", pa.binary())]


def part_of(doc: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(doc.cast("string")), F.lit(parts)).cast("int")


def tasks_for(n: int) -> int:
    return max(1, -(-n // TASK_DOCS))


def counted(docs: DataFrame, doc_id: str, text: str, meta: list[str], parts: int) -> DataFrame:
    """part, doc, length, terms, tfs and the columns of meta: terms of a document with their frequencies, once each."""
    tokens = docs.select(F.col(doc_id).alias("doc"), *meta, bm25_tokens(text).alias("t"))
    fields = [tokens.schema[c] for c in ("doc", *meta)]

    def count(batches):
        for rb in batches:
            flat = rb.column(rb.num_columns - 1)
            n = pc.list_value_length(flat).to_numpy(zero_copy_only=False)
            row, coded = np.repeat(np.arange(len(n)), n), flat.flatten().dictionary_encode()
            size = max(len(coded.dictionary), 1)
            pair, tf = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(pair // size, minlength=len(n)))]).astype(np.int32))
            terms = coded.dictionary.take(pa.array(pair % size))
            lists = [pa.ListArray.from_arrays(ends, terms), pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([*(rb.column(i) for i in range(len(fields))), pa.array(n.astype(np.int32)), *lists], names=[*(f.name for f in fields), "length", "terms", "tfs"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return tokens.mapInArrow(count, f"{schema}, length int, terms array<string>, tfs array<int>").withColumn("part", part_of(F.col("doc"), parts))


def blocks_of(part: int, rng: int, most: int, numbers: np.ndarray, lengths: np.ndarray, terms: pa.Array, tfs: np.ndarray) -> pa.RecordBatch:
    """Postings (number, length, term, tf) of a range as blocks of at most `most`, by term and number."""
    coded = terms.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((numbers, code))
    code, numbers, lengths, tfs = code[order], numbers[order].astype(np.int32), lengths[order].astype(np.int32), tfs[order].astype(np.int32)
    head = np.flatnonzero(np.diff(code, prepend=-1))
    size = np.diff(head, append=len(code))
    per = -(-size // most)
    nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    a = np.repeat(head, per) + nth * most
    z = np.minimum(a + most, np.repeat(head + size, per))
    cut = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(a.tolist(), z.tolist(), strict=True)], pa.binary())
    n = len(a)
    columns = [np.full(n, part, np.int32), np.full(n, rng, np.int32), coded.dictionary.take(pa.array(code[a])), nth.astype(np.int32), (z - a).astype(np.int32), numbers[a], numbers[z - 1], np.maximum.reduceat(tfs, a) if n else tfs, np.minimum.reduceat(lengths, a) if n else lengths]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns] + [cut(numbers), cut(tfs), cut(lengths)], names=[name for name, _ in _POSTED])


def _write(store: SnapshotStore, rows: DataFrame, about: dict, replaced: list[int] | None) -> list[str]:
    """Documents and postings of counted rows, in one commit; `replaced` parts go even if no row is left in them, all if it is None.

    A part is the work of many tasks: rows are dealt by ranges of part and id, numbered within
    each, and moved up by what the ranges before hold; postings by ranges of part and term.
    """
    meta, span, most, spark = about["meta"], about["range"], about["block"], rows.sparkSession
    fields = [rows.schema[c] for c in ("doc", *meta)]
    names = [f.name for f in fields]
    rows = written(rows.select("part", *names, "length", "terms", "tfs"), "rows")
    width = tasks_for(rows.count())
    dealt = rows.repartitionByRange(width, "part", "doc").sortWithinPartitions("part", "doc")
    shown = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def number(batches):
        part, last, at, share = -1, None, 0, TaskContext.get().partitionId()
        for rb in batches:
            own = rb.column(0).to_numpy()
            ids = rb.column(1)
            if ids.null_count:
                raise ValueError("an index needs ids that are not null")
            new = np.zeros(len(own), np.int32)
            for i, (p, d) in enumerate(zip(own.tolist(), ids.to_pylist(), strict=True)):
                if p != part:
                    part, at = p, 0
                elif d == last:
                    raise ValueError(f"an index needs distinct ids; {d!r} is there twice")
                new[i], at, last = at, at + 1, d
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(new), pa.array(np.full(len(own), share, np.int32))], names=[*rb.schema.names, "number", "share"])

    shares = written(dealt.mapInArrow(number, f"part int, {shown}, length int, terms array<string>, tfs array<int>, number int, share int"), "numbered")
    starts, held = [], {}
    for r in shares.groupBy("part", "share").count().orderBy("part", "share").collect():  # a number for each task, and for each part once more
        starts.append((r["part"], r["share"], held.get(r["part"], 0)))
        held[r["part"]] = held.get(r["part"], 0) + r["count"]
    known = F.broadcast(spark.createDataFrame(starts, "part int, share int, start int"))
    numbered = shares.join(known, ["part", "share"]).withColumn("number", F.col("number") + F.col("start")).drop("share", "start")

    def post(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        lists = t.column("terms").combine_chunks()
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(n)), n)
        tfs = t.column("tfs").combine_chunks().flatten().to_numpy()
        out = blocks_of(t.column("part")[0].as_py(), t.column("range")[0].as_py(), most, t.column("number").to_numpy()[row], t.column("length").to_numpy()[row], lists.flatten(), tfs)
        return pa.Table.from_batches([out])

    ranged = numbered.select("part", F.floor(F.col("number") / span).cast("int").alias("range"), "number", "length", "terms", "tfs")
    postings = written(ranged.repartition(width, "part", "range").groupBy("part", "range").applyInArrow(post, POSTINGS), "posted")
    by_term = ["part", "term", "range", "block"]
    with store.transaction() as tx:
        if replaced is None:
            tx.next["tables"] = {}
        tx.properties |= about
        new = tx.replace("docs", numbered.select("part", "number", "doc", "length", *meta), "part", replaced)
        tx.replace("postings", postings.repartitionByRange(width, *by_term).sortWithinPartitions(*by_term), "part", replaced)
        sizes = numbered.groupBy("part").agg(F.count("*").alias("n"), F.sum("length").alias("words"))
        tx.replace("sizes", sizes, "part", replaced)
    return new


def build(docs: DataFrame, path: str, doc_id: str, text: str, meta: list[str] | None = None, parts: int | None = None, span: int = RANGE, block: int = BLOCK) -> SnapshotStore:
    """An index of docs at path; meta: columns to filter by. parts: as many as keep PART_DOCS documents each, if not given. span: numbers of a range; block: postings of a block."""
    store = SnapshotStore(docs.sparkSession, path)
    parts = parts or max(1, -(-docs.count() // PART_DOCS))
    _write(store, counted(docs, doc_id, text, meta or [], parts), {"parts": parts, "meta": meta or [], "range": span, "block": block}, None)
    return store


def upsert(store: SnapshotStore, docs: DataFrame, doc_id: str, text: str, gone: DataFrame | None = None) -> list[str]:
    """Adds or replaces documents and drops those whose ids are in gone (one column); only parts that hold any of them are written again.

    The other documents of these parts are taken from their postings, not from texts. Returns
    the parts that were written.
    """
    about = store.properties()
    parts, meta = about["parts"], about["meta"]
    new = written(counted(docs, doc_id, text, meta, parts), "counted")
    out = new.select("doc", "part")
    if gone is not None:
        dropped = gone.select(F.col(gone.columns[0]).alias("doc")).distinct()
        out = out.unionByName(dropped.withColumn("part", part_of(F.col("doc"), parts)))
    out = written(out.distinct(), "changed")
    touched = sorted(r["part"] for r in out.select("part").distinct().collect())  # at most one number for each part
    if not touched:
        return []
    kept = store.read("docs", touched).join(out.select("doc"), "doc", "left_anti")

    def turned(t: pa.Table) -> pa.Table:
        """Postings of a range as terms and frequencies of each document."""
        t = t.combine_chunks()
        flat = lambda c: np.frombuffer(b"".join(t.column(c).to_pylist()), np.int32)
        numbers, tfs = flat("numbers"), flat("tfs")
        order = np.argsort(numbers, kind="stable")
        numbers = numbers[order]
        head = np.flatnonzero(np.diff(numbers, prepend=-1))
        ends = pa.array(np.append(head, len(numbers)).astype(np.int32))
        row = np.repeat(np.arange(t.num_rows), t.column("n").to_numpy())[order]
        lists = [pa.ListArray.from_arrays(ends, t.column("term").combine_chunks().take(pa.array(row))), pa.ListArray.from_arrays(ends, pa.array(tfs[order]))]
        return pa.table([pa.array(np.full(len(head), t.column("part")[0].as_py(), np.int32)), pa.array(numbers[head]), *lists], names=["part", "number", "terms", "tfs"])

    blocks = store.read("postings", touched).select("part", "range", "n", "term", "numbers", "tfs")
    width = tasks_for(store.read("sizes", touched).agg(F.sum("n")).first()[0] or 0)
    listed = blocks.repartition(width, "part", "range").groupBy("part", "range").applyInArrow(turned, "part int, number int, terms array<string>, tfs array<int>")
    none = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    old = kept.join(listed, ["part", "number"], "left").select("doc", *meta, "length", none("terms", "string"), none("tfs", "int"), "part")
    columns = ["doc", *meta, "length", "terms", "tfs", "part"]
    return _write(store, new.select(*columns).unionByName(old.select(*columns)), about, touched)


def sync(store: SnapshotStore, docs: DataFrame, doc_id: str, text: str, modified: str) -> list[str]:
    """The index made equal to docs: new documents and those with a later time than stored are written, vanished ones go. `modified` has to be a column of meta."""
    if modified not in store.properties()["meta"]:
        raise ValueError(f"{modified!r} is not stored")
    have = store.read("docs").select(F.col("doc").alias("_doc"), F.col(modified).alias("_then"))
    newer = docs.join(have, F.col(doc_id) == F.col("_doc"), "left").where(F.col("_then").isNull() | (F.col(modified) > F.col("_then"))).drop("_doc", "_then")
    gone = have.join(docs.select(F.col(doc_id).alias("_doc")), "_doc", "left_anti").select("_doc")
    return upsert(store, newer, doc_id, text, gone)


class Questions:
    """Distinct terms of a stated set of questions, and which question asks for which."""

    def __init__(self, pairs: pa.Table) -> None:
        qid, term = (pairs.column(c).combine_chunks() for c in ("qid", "term"))
        self.qids, self.words = qid.unique(), term.unique()
        of_query = pc.index_in(qid, value_set=self.qids).to_numpy(zero_copy_only=False).astype(np.int64)
        of_term = pc.index_in(term, value_set=self.words).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(of_query, kind="stable")
        self.terms = of_term[order]
        self.first = np.searchsorted(of_query[order], np.arange(len(self.qids) + 1))

    def of(self, q: int) -> np.ndarray:
        return self.terms[self.first[q] : self.first[q + 1]]


class Walk:
    """The blocks of one range, opened where they are needed."""

    def __init__(self, t: pa.Table, words: pa.Array, idf: np.ndarray, average: float, k1: float, b: float, span: int = RANGE) -> None:
        self.span, self.cell = span, max(1, span // CELLS)
        self.term = pc.index_in(t.column("term").combine_chunks(), value_set=words).to_numpy(zero_copy_only=False)
        self.own = np.unique(self.term)
        self.row = np.searchsorted(self.own, self.term)
        base = int(t.column("range")[0].as_py()) * span
        self.lo, self.hi = (t.column(c).to_numpy() - base for c in ("first", "last"))
        self.idf, self.base, self.opened = idf, base, 0
        self.weigh = lambda tf, length: tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / (average + 1e-9)) + 1e-12)
        self.raw = [t.column(c) for c in ("numbers", "tfs", "lengths")]
        best = idf[self.term] * self.weigh(t.column("most_tf").to_numpy().astype(float), t.column("least_length").to_numpy().astype(float))
        #: Upper bound of the score of each term in each cell.
        self.bound = np.zeros((len(self.own), -(-span // self.cell)))
        for i, (r, x) in enumerate(zip(self.row, best, strict=True)):
            cells = self.bound[r, self.lo[i] // self.cell : self.hi[i] // self.cell + 1]
            np.maximum(cells, x, out=cells)
        self.blocks = [np.flatnonzero(self.row == r) for r in range(len(self.own))]
        self.seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def rows_of(self, terms: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.own, terms), len(self.own) - 1)
        return at[self.own[at] == terms]

    def open(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.seen:
            numbers, tf, length = (np.frombuffer(c[i].as_py(), np.int32) for c in self.raw)
            self.seen[i] = numbers - self.base, self.idf[self.term[i]] * self.weigh(tf.astype(float), length.astype(float))
            self.opened += 1
        return self.seen[i]

    def best(self, terms: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the k best documents, and those that equal the last, of `least` or more; to nine places."""
        rows = self.rows_of(terms)
        upper = self.bound[rows].sum(axis=0) * (1 + 1e-12) + 1e-9
        order = np.argsort(-upper, kind="stable")
        numbers, scores = np.empty(0, np.int64), np.empty(0)
        at = 0
        while at < len(order):
            # the most promising cells first; more of them at a time as they get less so
            some = order[at : at + max(4, at)]
            at += len(some)
            some = some[(upper[some] >= least) & (upper[some] > 1e-9)]
            if not len(some):
                break
            wanted = np.zeros(len(upper), bool)
            wanted[some] = True
            passed = np.concatenate([[0], np.cumsum(wanted)])
            total = np.zeros(len(upper) * self.cell)
            for r in rows:
                for i in self.blocks[r]:
                    if passed[self.hi[i] // self.cell + 1] > passed[self.lo[i] // self.cell]:
                        where, w = self.open(int(i))
                        total[where] += w
            total *= np.repeat(wanted, self.cell)
            found = np.flatnonzero(total > 0)
            numbers, scores = np.concatenate([numbers, found]), np.concatenate([scores, total[found]])
            shown = np.round(scores, 9)
            if len(scores) >= k:
                least = max(least, float(np.partition(shown, len(shown) - k)[len(shown) - k]))
            keep = shown >= least
            numbers, scores = numbers[keep], scores[keep]
        return numbers + self.base, scores


def _passing(docs: DataFrame, span: int) -> DataFrame:
    """part, range and a bit for each number of the range, set where docs have it."""

    def pack(batches):
        for rb in batches:
            bits = []
            for rng, numbers in zip(rb.column(1).to_pylist(), rb.column(2), strict=True):
                there = np.zeros(span, np.uint8)
                there[numbers.values.to_numpy(zero_copy_only=False) - rng * span] = 1
                bits.append(np.packbits(there, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(bits, pa.binary())], names=["part", "range", "allowed"])

    listed = docs.groupBy("part", F.floor(F.col("number") / span).cast("int").alias("range")).agg(F.collect_list("number").alias("numbers"))
    return listed.mapInArrow(pack, "part int, range int, allowed binary")


def _thinned(blocks: DataFrame, allowed: DataFrame, span: int) -> DataFrame:
    """Blocks without the postings of documents that are not allowed (part, range, a bit for each of its numbers), bounds made anew."""
    joined = blocks.join(allowed, ["part", "range"])

    def run(batches):
        for rb in batches:
            rows = []
            for b in rb.to_pylist():
                numbers, tfs, lengths = (np.frombuffer(b[c], np.int32) for c in ("numbers", "tfs", "lengths"))
                ok = np.unpackbits(np.frombuffer(b["allowed"], np.uint8), bitorder="little")[numbers - b["range"] * span] == 1
                if ok.any():
                    n, tf, ln = numbers[ok], tfs[ok], lengths[ok]
                    rows.append((b["part"], b["range"], b["term"], b["block"], len(n), n[0], n[-1], tf.max(), ln.min(), n.tobytes(), tf.tobytes(), ln.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True) if rows else [()] * len(_POSTED), _POSTED, strict=True)], names=[name for name, _ in _POSTED])

    return joined.mapInArrow(run, POSTINGS)


def postings_of(store: SnapshotStore, words: list[str]) -> DataFrame:
    """Postings of some terms. Up to 64 are told to the scan one by one, which then skips what its statistics rule out."""
    blocks, term = store.read("postings"), F.col("term")
    if not words:
        return blocks.limit(0)
    if len(words) <= 64:
        wanted = F.lit(False)
        for w in words:
            wanted = wanted | (term == w)
        return blocks.where(wanted)
    spark = store.spark
    return blocks.join(spark.createDataFrame([(w,) for w in words], "term string"), "term", "left_semi")


def search(store: SnapshotStore, questions: DataFrame, query_id: str, query: str, k: int = 10, where: Column | None = None, k1: float = 1.5, b: float = 0.75, listed: int = LISTED) -> DataFrame:
    """R03 over the stored index: qid, doc, score, rank, as search.bm25() gives them for the documents that pass `where`."""
    spark = questions.sparkSession
    terms = questions.select(F.col(query_id).alias("qid"), F.explode(F.array_distinct(bm25_tokens(query))).alias("term"))
    docs, span = store.read("docs"), store.properties()["range"]
    doc_type = docs.schema["doc"].dataType.simpleString()
    qid_type = terms.schema["qid"].dataType.simpleString()
    sizes = store.read("sizes").agg(F.sum("n").alias("n"), F.sum("words").alias("words")) if where is None else docs.where(where).agg(F.count("*").alias("n"), F.sum("length").alias("words"))
    total = sizes.first()
    n, average = total["n"] or 0, (total["words"] or 0) / max(total["n"] or 0, 1)
    pairs = terms.limit(listed + 1).toArrow()
    many = pairs.num_rows > listed
    asked = None if many else Questions(pairs)
    blocks = store.read("postings").join(terms.select("term").distinct(), "term", "left_semi") if many else postings_of(store, asked.words.to_pylist())
    if where is not None:
        blocks = _thinned(blocks, _passing(docs.where(where), span), span)
    blocks = written(blocks.select(*(name for name, _ in _POSTED)), "blocks")
    df = blocks.groupBy("term").agg(F.sum("n").alias("df"))
    named = docs.select("part", "number", "doc")
    if many:
        return _joined(blocks, df, terms, named, n, average, k, k1, b)
    if not len(asked.words):
        return top_k(spark.createDataFrame([], f"qid {qid_type}, doc {doc_type}, score double"), ["qid"], ["doc"], k)
    known = {r["term"]: r["df"] for r in df.collect()}  # one number for each listed term
    count = np.array([known.get(w, 0) for w in asked.words.to_pylist()], float)
    idf = np.log((n - count + 0.5) / (count + 0.5) + 1)
    shared = spark.sparkContext.broadcast((asked, idf))
    by_range = blocks.repartition(tasks_for(n), "part", "range").groupBy("part", "range")
    schema = "q int, part int, number int, score double"

    def promise(t: pa.Table) -> pa.Table:
        asked, idf = shared.value
        walk = Walk(t, asked.words, idf, average, k1, b, span)
        most = [float(walk.bound[walk.rows_of(asked.of(q))].sum(axis=0).max(initial=0)) for q in range(len(asked.qids))]
        at = np.flatnonzero(most)
        return pa.table({"q": pa.array(at.astype(np.int32)), "part": t.column("part").slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(at), np.int64))), "range": pa.array(np.full(len(at), t.column("range")[0].as_py(), np.int32)), "most": pa.array(np.array(most)[at])})

    def walked(least: np.ndarray, goes):
        told = spark.sparkContext.broadcast(least)

        def run(t: pa.Table) -> pa.Table:
            asked, idf = shared.value
            part, rng = t.column("part")[0].as_py(), t.column("range")[0].as_py()
            walk, out = None, []
            for q in goes(part, rng, len(asked.qids)):
                walk = walk or Walk(t, asked.words, idf, average, k1, b, span)
                numbers, scores = walk.best(asked.of(q), k, float(told.value[q]))
                out.append((np.full(len(numbers), q, np.int32), numbers.astype(np.int32), scores))
            q, number, score = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0))
            return pa.table({"q": q, "part": np.full(len(q), part, np.int32), "number": number, "score": score})

        return by_range.applyInArrow(run, schema)

    hopes = by_range.applyInArrow(promise, "q int, part int, range int, most double")
    first = hopes.groupBy("q").agg(F.max_by(F.struct("part", "range"), F.struct("most", -F.col("part"), -F.col("range"))).alias("at")).select("q", "at.*").collect()  # one row a question
    start: dict[tuple[int, int], list[int]] = {}
    for r in first:
        start.setdefault((r["part"], r["range"]), []).append(r["q"])
    nothing = np.full(len(asked.qids), 1e-300)
    begun = written(walked(nothing, lambda part, rng, _: start.get((part, rng), [])), "first")
    kth = begun.groupBy("q").agg(F.sort_array(F.collect_list(F.round("score", 9)), False).alias("s")).select("q", F.get("s", F.lit(k - 1)).alias("least")).where("least IS NOT NULL")
    least = nothing.copy()
    for r in kth.collect():  # one number a question
        least[r["q"]] = max(r["least"], 1e-300)
    rest = walked(least, lambda part, rng, n: sorted(set(range(n)) - set(start.get((part, rng), []))))
    qids = spark.createDataFrame(pa.table({"q": pa.array(np.arange(len(asked.qids), dtype=np.int32)), "qid": asked.qids}).to_pandas(), f"q int, qid {qid_type}")
    both = begun.unionByName(rest).join(named, ["part", "number"]).join(qids, "q")
    return top_k(both.select("qid", "doc", "score"), ["qid"], [F.desc(F.round("score", 9)), "doc"], k)


def _joined(blocks: DataFrame, df: DataFrame, terms: DataFrame, named: DataFrame, n: int, average: float, k: int, k1: float, b: float) -> DataFrame:
    """search() for any number of questions: postings are joined with the questions that ask for them."""

    def run(batches):
        for rb in batches:
            size = rb.column("n").to_numpy()
            at = pa.array(np.repeat(np.arange(len(size)), size))
            flat = lambda c: pa.array(np.frombuffer(b"".join(rb.column(c).to_pylist()), np.int32))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([rb.column("part").take(at), rb.column("term").take(at), flat("numbers"), flat("tfs"), flat("lengths")], names=["part", "term", "number", "tf", "length"])

    hits = blocks.mapInArrow(run, "part int, term string, number int, tf int, length int").join(df, "term")
    weighed = hits.withColumn("w", bm25_idf(F.lit(n), F.col("df")) * bm25_tf(F.col("tf"), F.col("length"), F.lit(average), k1, b))
    scored = weighed.join(terms, "term").groupBy("qid", "part", "number").agg(F.sum("w").alias("score")).where("score > 0").join(named, ["part", "number"])
    return top_k(scored.select("qid", "doc", "score"), ["qid"], [F.desc(F.round("score", 9)), "doc"], k)


def rewritten(store: SnapshotStore, version: int) -> Iterable[str]:
    """Parts of postings whose files differ between a version and the one before."""
    now, before = store.parts("postings", version), store.parts("postings", version - 1)
    return sorted(p for p in now.keys() | before.keys() if now.get(p) != before.get(p))
