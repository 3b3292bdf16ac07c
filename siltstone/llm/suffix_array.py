"""Suffix-array dedup over bytes with deep-shallow sorting.

Suffixes start at anchors (see `_repeats`). Multikey quicksort, eight bytes a
character, orders them to a shallow depth; each group that is still equal there
goes into a blind trie, which compares a suffix with one leaf only and yields the
rest of the order with the bytes that neighbours share.

Results for odd input: a null text has no bytes; a null id stays null; repeated
rows are repeats of each other like any documents; an empty table gives no rows.
Columns besides id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm._repeats import Block, Rule, remove_repeats
from siltstone.llm._scratch import BLOCK_BYTES, ids_column
from siltstone.llm.substring_dedup import SPANS, runs

SCHEMA = "doc_id long, n_bytes long, n_removed long, kept binary, removed_spans array<struct<start:long,end:long>>"
SHALLOW = 4  # characters of eight bytes
SMALL = 48  # ranges below are sorted directly


def multikey_quicksort(words: np.ndarray) -> list[np.ndarray]:
    """Rows of a matrix in order, as groups of rows that are equal in all columns."""
    out: list[np.ndarray] = []
    stack = [(np.arange(len(words)), 0)]
    while stack:
        rows, depth = stack.pop()
        if not len(rows):
            continue
        if depth == words.shape[1] or len(rows) == 1:
            out.append(rows)
            continue
        if len(rows) <= SMALL:
            keys = words[rows, depth:].tolist()
            order = sorted(range(len(rows)), key=keys.__getitem__)
            first = 0
            for i in range(1, len(order) + 1):
                if i == len(order) or keys[order[i]] != keys[order[first]]:
                    out.append(rows[order[first:i]])
                    first = i
            continue
        column = words[rows, depth]
        some = np.sort(column[:: max(1, len(column) // 64)])
        pivot = some[len(some) // 2]
        stack.append((rows[column > pivot], depth))
        stack.append((rows[column == pivot], depth + 1))
        stack.append((rows[column < pivot], depth))
    return out


class BlindTrie:
    """Binary trie over whole numbers of one width that keeps only where paths part."""

    def __init__(self, value: int) -> None:
        self.root: list | int = 0
        self.values = [value]
        self.twins: dict[int, list[int]] = {}

    def insert(self, value: int) -> None:
        node = self.root
        while isinstance(node, list):
            node = node[2] if value >> node[0] & 1 else node[1]
        part = (value ^ self.values[node]).bit_length() - 1
        leaf = len(self.values)
        self.values.append(value)
        if part < 0:
            self.twins.setdefault(node, []).append(leaf)
            return
        parent, node = None, self.root
        while isinstance(node, list) and node[0] > part:
            parent, node = node, node[2] if value >> node[0] & 1 else node[1]
        new = [part, node, leaf] if value >> part & 1 else [part, leaf, node]
        if parent is None:
            self.root = new
        else:
            parent[2 if value >> parent[0] & 1 else 1] = new

    def order(self) -> tuple[list[int], list[int]]:
        """Leaves in order, and the bit at which each parts from the one before it (-1: equal)."""
        leaves, parts, stack = [], [], [(self.root, 0)]
        while stack:
            node, bit = stack.pop()
            if isinstance(node, list):
                stack += [(node[2], node[0]), (node[1], bit)]
            else:
                equal = self.twins.get(node, [])
                leaves += [node, *equal]
                parts += [bit] + [-1] * len(equal)
        return leaves, parts[1:]


def deep_shallow_sort(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows padded with zero bytes to width, and how many bytes neighbours share."""
    padded = max(8, -(-width // 8) * 8)
    flat = b"".join([r[:width].ljust(padded, b"\0") for r in rows])
    words = np.frombuffer(flat, ">u8").reshape(len(rows), padded // 8)
    shallow = words[:, : min(SHALLOW, words.shape[1])].astype(np.uint64)
    order: list[int] = []
    share: list[int] = []
    last = None
    for group in multikey_quicksort(shallow):
        g = group.tolist()
        if last is not None:
            share.append(_shared(shallow[last], shallow[g[0]]))
        if len(g) > 1:
            values = [int.from_bytes(flat[i * padded : (i + 1) * padded], "big") for i in g]
            trie = BlindTrie(values[0])
            for v in values[1:]:
                trie.insert(v)
            leaves, parts = trie.order()
            order += [g[i] for i in leaves]
            share += [(8 * padded - 1 - p) >> 3 for p in parts]
        else:
            order += g
        last = g[0]
    return np.array(order, np.int64), np.minimum(np.array(share, np.int64), width)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    i = int((a != b).argmax())
    return 8 * i + ((64 - int(a[i] ^ b[i]).bit_length()) >> 3)


def byte_classes(window: int, k: int):
    slack = window - k

    def classes(content: list[bytes], left: np.ndarray, right: np.ndarray, lo: int = 0, hi: int = slack):
        n = left.tolist()
        order_r, share_r = deep_shallow_sort([c[i : i + window - lo] for c, i in zip(content, n, strict=True)], window - lo)
        order_l, share_l = deep_shallow_sort([c[:i][::-1] for c, i in zip(content, n, strict=True)], hi)
        cls_l, cls_r = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        for shift in range(lo, hi + 1):
            ok = np.flatnonzero((left >= shift) & (right >= window - shift))
            cls_l[order_l] = np.concatenate([[0], np.cumsum(share_l < shift)])
            cls_r[order_r] = np.concatenate([[0], np.cumsum(share_r < window - shift)])
            yield ok, cls_l[ok] * len(n) + cls_r[ok]

    return classes


def _finish(b: Block, removed: np.ndarray):
    n, lost, kept, spans = [], [], [], []
    for text, a, z in zip(b.texts, b.start[:-1].tolist(), b.start[1:].tolist(), strict=True):
        m = removed[a:z]
        gone = int(m.sum())
        n.append(z - a)
        lost.append(gone)
        kept.append(np.frombuffer(text, np.uint8)[~m].tobytes() if gone else text)
        spans.append([{"start": s, "end": e} for s, e in zip(*(x.tolist() for x in runs(m)), strict=True)] if gone else [])
    yield pa.RecordBatch.from_arrays([ids_column(b.ids), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, SPANS)], names=["doc_id", "n_bytes", "n_removed", "kept", "removed_spans"])


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 400, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Remove each byte covered by a string of `window` bytes that also starts anywhere else.

    Returns doc_id, n_bytes, n_removed, kept (the remaining bytes) and removed_spans
    (maximal runs of byte positions, end exclusive), a row for each row of docs.
    """
    rule = Rule(words=False, window=window, k=max(1, window * 8 // 25), first=False)
    return remove_repeats(docs, id_col, text_col, rule, byte_classes(window, rule.k), _finish, SCHEMA, block_bytes)
