"""Substring dedup with prefix-partitioned suffix trees over words.

Suffixes start at anchors (see `_repeats`). Prefixes of one word, or of two, three
and more where shorter ones are too frequent, split them into groups that fit a
task's memory. Each group builds its suffix tree; its internal nodes that are deep
enough are repeats, as long as their leaves share words. The node that a suffix
crosses at the depth of what a window has to the right of its anchor, with the like
node of the reversed words to the left, stands for all places of that window.

Results for odd input: a null text has no words; a null id counts as the smallest
and stays null; rows with the same id never remove words from each other, rows
that repeat a whole row each get a result; an empty table gives no rows. Columns
besides id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm._repeats import Block, Rule, remove_repeats
from siltstone.llm._scratch import BLOCK_BYTES, ids_column

SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string, removed_spans array<struct<start:long,end:long>>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class SuffixTree:
    """Suffix tree of the rows of a matrix of symbols, each row a suffix.

    Suffixes are put in order; where neighbours part is the depth of the lowest node above
    both. From that the internal nodes follow in one pass with a stack: each has a depth,
    the depth of its parent, and the leaves below it, which are a run. A node is a repeat
    of its depth in symbols, the longest that all its leaves share.
    """

    def __init__(self, rows: np.ndarray, least: int = 0) -> None:
        """least: shallower nodes are not kept, as no window is decided by them."""
        n, width = rows.shape
        as_bytes = np.ascontiguousarray((rows.astype(np.int64) + 1).astype(">u4")).view(f"V{4 * width}").ravel() if width else np.zeros(n, "V1")
        self.leaves = np.argsort(as_bytes, kind="stable")
        ordered = rows[self.leaves]
        differ = ordered[1:] != ordered[:-1]
        parting = np.where(differ.any(axis=1), differ.argmax(axis=1), width) if width else np.zeros(max(n - 1, 0), np.int64)
        found: list[tuple[int, int, int, int]] = []
        path: list[tuple[int, int]] = []  # depth and first leaf of the open nodes, from the root down
        for leaf, d in enumerate([*parting.tolist(), -1]):
            first = leaf
            while path and path[-1][0] > d:
                depth, first = path.pop()
                found.append((depth, max(d, path[-1][0] if path else -1), first, leaf + 1))
            if d >= least and (not path or path[-1][0] < d):
                path.append((d, first))
        self.depth, self.above, self.first, self.end = np.array(found, np.int64).reshape(-1, 4).T

    def nodes(self, d: int) -> np.ndarray:
        """For each row the number of the node that its path crosses at depth d, its own number if it shares so much with none."""
        n = len(self.leaves)
        of_leaf = np.arange(n, 2 * n)
        crossed = np.flatnonzero((self.depth >= d) & (self.above < d))
        size = self.end[crossed] - self.first[crossed]
        ends = np.cumsum(size)
        places = np.repeat(self.first[crossed] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        of_leaf[places] = np.repeat(np.arange(len(crossed)), size)
        out = np.empty(n, np.int64)
        out[self.leaves] = of_leaf
        return out


def word_classes(window: int, k: int):
    slack = window - k

    def classes(content: list[bytes], left: np.ndarray, right: np.ndarray, lo: int = 0, hi: int = slack):
        codes: dict[bytes, int] = {}
        rows = np.full((len(content), hi + window - lo), -1, np.int32)
        for i, (c, n) in enumerate(zip(content, left.tolist(), strict=True)):
            words = [codes.setdefault(w, len(codes)) for w in c.split(b" ")]
            rows[i, hi - n : hi - n + len(words)] = words
        ahead, back = SuffixTree(rows[:, hi:], window - hi), SuffixTree(rows[:, :hi][:, ::-1])
        for shift in range(lo, hi + 1):
            ok = np.flatnonzero((left >= shift) & (right >= window - shift))
            yield ok, back.nodes(shift)[ok] * 2 * len(rows) + ahead.nodes(window - shift)[ok]

    return classes


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _finish(b: Block, removed: np.ndarray):
    n, lost, kept, spans = [], [], [], []
    for text, a, z in zip(b.texts, b.start[:-1].tolist(), b.start[1:].tolist(), strict=True):
        m = removed[a:z]
        gone = int(m.sum())
        n.append(z - a)
        lost.append(gone)
        if gone:
            words = text.split(b" ")
            kept.append(b" ".join([w for w, x in zip(words, m.tolist(), strict=True) if not x]) if gone < z - a else b"")
            spans.append([{"start": s, "end": e} for s, e in zip(*(x.tolist() for x in runs(m)), strict=True)])
        else:
            kept.append(text)
            spans.append([])
    yield pa.RecordBatch.from_arrays([ids_column(b.ids), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, SPANS)], names=["doc_id", "n_words", "n_removed", "kept_text", "removed_spans"])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Remove each word covered by a window of words that also starts in a document with a smaller id.

    Returns doc_id, n_words, n_removed, kept_text (words joined by one space) and
    removed_spans (runs of word positions, end exclusive), a row for each row of docs.
    """
    rule = Rule(words=True, window=window, k=(window + 1) // 2, first=True)
    return remove_repeats(docs, id_col, text_col, rule, word_classes(window, rule.k), _finish, SCHEMA, block_bytes)
