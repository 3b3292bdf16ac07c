"""Benchmark decontamination by winnowing.

Of the k-grams of words in each sliding window the one with the least hash is kept,
in benchmark items and in documents alike. Where a document's kept k-gram is one of an
item, the match is extended to both sides: to every window of k + w - 1 words that holds
it and is one of an item, word by word. Two texts that share so many words share a kept
k-gram, so no shared span of that length is missed; longer spans are the union of their
windows. An item shorter than that is one k-gram of its own length. A window is looked up
among the distinct windows of all items, so that a long run of one word on both sides
takes time in proportion to its length.

Fingerprints of documents and of items are joined by length and hash. While all texts of
the benchmark together are at most `index_bytes`, which is summed up first, its side of
the join is an index that is broadcast: documents are read once and not moved. A larger
benchmark is never gathered in one place: documents are written in blocks, each block's
distinct fingerprints meet those of the items in a shuffled join, and each block is sent
the items it shares a fingerprint with, to which its matches are extended.

Results for odd input: a null text has no words and no hit; an item without words is
ignored; rows of the benchmark with one id are one item; an item with a null id marks
words but is not listed; a null document id stays null; repeated rows each get a
result; an empty table gives no rows, an empty benchmark no hits. Columns besides id
and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _hashing as H
from siltstone.llm._scratch import chunks, ids_column, pack, pack_rows, persist, rows_of, small_batches, trimmed, unpack, with_replies

U = np.uint64
WINDOW = 13
K = 5
INDEX_BYTES = 16 << 20
BLOCK_BYTES = 1 << 20
#: Lower case for A-Z, and a blank for ASCII that is neither a letter nor a digit.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>, contaminated boolean"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


class Words:
    """Words of several texts, their hashes, and the first word of each text."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts = texts
        buf = b" \n ".join([t.translate(_WORD) for t in texts])
        arr = np.frombuffer(buf, np.uint8)
        at, to = H.word_spans(arr)
        ends = np.cumsum(np.fromiter((len(t) + 3 for t in texts), np.int64, len(texts)))
        self.text = np.searchsorted(ends, at, "right")
        self.start = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.hash = H.word_symbols(arr, at, to)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of k-grams within one text, and their hashes."""
        g = H.of_grams(self.hash, k) | U(1)
        p = np.flatnonzero(self.text[: len(g)] == self.text[k - 1 : k - 1 + len(g)])
        return p, g[p]

    def kept(self, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the k-grams that winnowing keeps."""
        g = H.of_grams(self.hash, k) | U(1)
        n = max(len(self.text) - window + 1, 0)
        valid = np.zeros(len(g), bool)
        valid[:n] = self.text[:n] == self.text[window - 1 : window - 1 + n]
        p = H.winnow(g, valid, window - k + 1)
        return p, g[p]


class Index:
    """Of some benchmark items by length of window: kept fingerprints, and the distinct windows with their items."""

    def __init__(self, ids: list[str | None], texts: list[bytes], window: int, k: int) -> None:
        self.window, self.k, self.ids = window, k, ids
        items = [words_of(t) for t in texts]
        self.word_ids: dict[bytes, int] = {}
        for words in items:
            for w in words:
                self.word_ids.setdefault(w, len(self.word_ids))
        self.tables: dict[int, Windows] = {}
        sizes = {len(w) for w in items if 0 < len(w) < window}
        for size in sorted(sizes | {window}):
            own = [i for i, w in enumerate(items) if (len(w) == size if size < window else len(w) >= window)]
            if own:
                flat = np.array([self.word_ids[w] for i in own for w in items[i]], np.int64)
                self.tables[size] = Windows(Words([texts[i] for i in own]), np.array(own), flat, size, window, k)


class Windows:
    """Windows of `size` words of the items in `own`. words: numbers of their words."""

    def __init__(self, text: Words, own: np.ndarray, words: np.ndarray, size: int, window: int, k: int) -> None:
        self.size, self.words = size, words
        self.prints = np.unique(text.grams(size)[1] if size < window else text.kept(k, window)[1])
        p, h = text.grams(size)
        item = own[text.text[p]]
        order = np.lexsort((p, h))
        p, h, item = p[order], h[order], item[order]
        new = np.diff(h, prepend=h[:1] - U(1)) != 0
        #: Hash of each distinct window, and where it stands first.
        self.hashes, self.at = h[new], p[new]
        group = np.cumsum(new) - 1
        # windows of one hash that are not the same words: none, in all likelihood; they are listed apart
        odd = ~self.same(words, p, self.at[group])
        self.odd = [(int(h[i]), int(p[i]), int(item[i])) for i in np.flatnonzero(odd)]
        pair = np.unique(group[~odd] * (int(own.max()) + 1) + item[~odd])
        self.items = pair % (int(own.max()) + 1)
        self.first = np.searchsorted(pair // (int(own.max()) + 1), np.arange(len(self.hashes) + 1))

    def same(self, words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the windows at `a` of words are those at `b` of the items, word by word."""
        out = np.ones(len(a), bool)
        for j in range(self.size):
            out &= words[a + j] == self.words[b + j]
        return out


def broadcast_index(items: DataFrame, window: int, k: int, index_bytes: int) -> Broadcast | None:
    """The index of all items (id, text), if their texts are together at most index_bytes."""
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    if total > index_bytes:
        return None
    rows = [(r["id"], (r["text"] or "").encode()) for r in items.select("id", "text").collect()]
    return items.sparkSession.sparkContext.broadcast(Index([i for i, _ in rows], [t for _, t in rows], window, k))


def join_fingerprints(blocks: DataFrame, texts_of: Callable[[dict], list[bytes]], columns: list[str], items: DataFrame, window: int, k: int) -> DataFrame:
    """blocks, each with the items (id, text) that share a fingerprint with it, in `said`."""
    numbered = persist(items.withColumn("item", F.monotonically_increasing_id()), "items")

    def of_items(batches):
        for rb in batches:
            for item, text in zip(rb.column("item").to_pylist(), rb.column("text").cast(pa.binary()).to_pylist(), strict=True):
                index = Index([None], [text or b""], window, k)
                for size, table in index.tables.items():
                    u = table.prints
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), size, np.int32)), pa.array(u.view(np.int64)), pa.array(np.full(len(u), item, np.int64))], names=["size", "hash", "item"])

    prints = persist(numbered.select("item", "text").mapInArrow(trimmed(of_items), "size int, hash long, item long"), "prints")
    sizes = sorted(r["size"] for r in prints.select("size").distinct().collect())  # at most `window`

    def of_blocks(batches):
        for rb in batches:
            for row in rb.to_pylist():
                docs = Words(texts_of(row))
                for size in sizes:
                    _, h = docs.grams(size) if size < window else docs.kept(k, window)
                    u = np.unique(h)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), size, np.int32)), pa.array(u.view(np.int64)), pa.array(np.full(len(u), row["block"], np.int64))], names=["size", "hash", "block"])

    asked = blocks.select("block", *columns).mapInArrow(trimmed(of_blocks), "size int, hash long, block long")
    met = asked.join(prints, ["size", "hash"]).select("block", "item").distinct()
    return with_replies(blocks.select("block", *columns), met.join(numbered, "item").select("block", "id", "text"))


def index_of(said: list[dict] | None, window: int, k: int) -> Index | None:
    return Index([x["id"] for x in said], [(x["text"] or "").encode() for x in said], window, k) if said else None


def find_hits(index: Index, docs: Words, hits: dict[int, np.ndarray], items: dict[int, set[str]]) -> None:
    """Mark hit words in hits and list items, by document."""
    for size, table in index.tables.items():
        short = size < index.window
        p, h = docs.grams(size) if short else docs.kept(index.k, index.window)
        met = p[table.prints[np.minimum(np.searchsorted(table.prints, h), len(table.prints) - 1)] == h]
        if not len(met):
            continue
        # the windows around a shared fingerprint that stay in its document
        reach = 0 if short else index.window - index.k
        near = np.zeros(len(docs.text) + 1, np.int64)
        np.add.at(near, np.maximum(met - reach, 0), 1)
        np.add.at(near, met + 1, -1)
        q, g = docs.grams(size)
        ok = np.cumsum(near)[q] > 0
        q, g = q[ok], g[ok]
        at = np.minimum(np.searchsorted(table.hashes, g), len(table.hashes) - 1)
        ok = table.hashes[at] == g
        q, at, g = q[ok], at[ok], g[ok]
        for d in np.unique(docs.text[q]).tolist():
            a, z = int(docs.start[d]), int(docs.start[d + 1])
            own = slice(*np.searchsorted(q, [a, z]))
            words = np.array([index.word_ids.get(w, -1) for w in words_of(docs.texts[d])], np.int64)
            ok = table.same(words, q[own] - a, table.at[at[own]])
            starts = (q[own] - a)[ok]
            found = set()
            for c in np.unique(at[own][ok]).tolist():
                found.update(table.items[table.first[c] : table.first[c + 1]].tolist())
            for x, first, i in table.odd:
                same = (g[own] == U(x)) & table.same(words, q[own] - a, np.full(len(q[own]), first))
                starts = np.concatenate([starts, (q[own] - a)[same]])
                found |= {i} if same.any() else set()
            if not len(starts):
                continue
            edge = np.zeros(z - a + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + size, -1)
            mark = hits.setdefault(d, np.zeros(z - a, bool))
            mark |= np.cumsum(edge[:-1]) > 0
            items.setdefault(d, set()).update(index.ids[i] for i in found if index.ids[i] is not None)


def judge_texts(index: Index | None, texts: list[bytes]) -> tuple[np.ndarray, dict[int, np.ndarray], dict[int, set[str]]]:
    """Number of words of each text; by text with hits, the marks and the items."""
    docs = Words(texts)
    hits: dict[int, np.ndarray] = {}
    items: dict[int, set[str]] = {}
    if index:
        find_hits(index, docs, hits, items)
    return np.diff(docs.start), hits, items


def is_contaminated(n_hit: int, n_words: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, k: int = K, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, items with occurring windows, spans of hit words (end exclusive), contaminated (at least one word in twenty is hit)."""
    small_batches(docs.sparkSession)
    listed = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    index = broadcast_index(listed, window, k, index_bytes)

    def judged(ids: np.ndarray, texts: list[bytes], own: Index | None) -> pa.RecordBatch:
        n, hits, items = judge_texts(own, texts)
        n_hit = [int(hits[d].sum()) if d in hits else 0 for d in range(len(ids))]
        spans = [[] for _ in ids]
        for d, m in hits.items():
            edge = np.flatnonzero(np.diff(np.concatenate([[0], m.astype(np.int8), [0]]))).tolist()
            spans[d] = [{"start": s, "end": e} for s, e in zip(edge[::2], edge[1::2], strict=True)]
        return pa.RecordBatch.from_arrays(
            [ids_column(ids), pa.array(n.astype(np.int64)), pa.array(n_hit, pa.int64()), pa.array([sorted(items.get(d, ())) for d in range(len(ids))], pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array([is_contaminated(x, int(y)) for x, y in zip(n_hit, n, strict=True)])],
            names=["doc_id", "n_words", "n_hit", "items", "spans", "contaminated"],
        )

    if index is not None:

        def run(batches):
            for ids, texts in chunks(batches, 1 << 20):
                yield judged(ids, texts, index.value)

        return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(trimmed(run), SCHEMA)

    def run_blocks(batches):
        for rb in batches:
            for row in rb.to_pylist():
                yield judged(*unpack(row["ids"], row["lens"], row["body"]), index_of(row["said"], window, k))

    columns = ["ids", "lens", "body"]
    return join_fingerprints(pack(docs, id_col, text_col, BLOCK_BYTES), lambda row: unpack(*(row[c] for c in columns))[1], columns, listed, window, k).mapInArrow(trimmed(run_blocks), SCHEMA)


def filter_rows(docs: DataFrame, text_col: str, keep: Callable[[list[bytes]], np.ndarray], step_bytes: int = 1 << 19) -> DataFrame:
    """Rows of docs, all columns as they are, whose texts `keep` says yes to; it sees about step_bytes of text at a time."""
    at = docs.columns.index(text_col)
    small_batches(docs.sparkSession)

    def run(batches):
        for rb in batches:
            size = pc.fill_null(pc.binary_length(rb.column(at)), 0).to_numpy(zero_copy_only=False)
            step = np.cumsum(size + 16) // step_bytes
            cut = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), rb.num_rows]
            for a, z in zip(cut[:-1], cut[1:], strict=True):
                part = rb.slice(a, z - a)
                texts = [t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()]
                yield part.filter(pa.array(keep(texts)))

    return docs.mapInArrow(trimmed(run), docs.schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, k: int = K, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Rows of docs that are not contaminated, with all their columns."""
    listed = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    index = broadcast_index(listed, window, k, index_bytes)
    at = docs.columns.index(text_col)

    def keep(texts: list[bytes], own: Index | None) -> np.ndarray:
        n, hits, _ = judge_texts(own, texts)
        out = np.ones(len(texts), bool)
        for d, m in hits.items():
            out[d] = not is_contaminated(int(m.sum()), int(n[d]))
        return out

    if index is not None:
        return filter_rows(docs, text_col, lambda texts: keep(texts, index.value))

    def texts_in(rows: pa.Table) -> list[bytes]:
        return [t or b"" for t in rows.column(at).cast(pa.binary()).to_pylist()]

    def run(batches):
        for rb in batches:
            for row in rb.to_pylist():
                rows = rows_of(row["body"])
                yield from rows.filter(pa.array(keep(texts_in(rows), index_of(row["said"], window, k)))).to_batches()

    joined = join_fingerprints(pack_rows(docs, text_col, BLOCK_BYTES), lambda row: texts_in(rows_of(row["body"])), ["body"], listed, window, k)
    return joined.mapInArrow(trimmed(run), docs.schema)
