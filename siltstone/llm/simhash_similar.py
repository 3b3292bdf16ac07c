"""SimHash near-dedup at a similarity of word shingles: wide fingerprints, bit-sliced comparison, exact check.

The operator of `simhash` for pairs that differ in more bits than pieces of a fingerprint
can find. Of each set of distinct shingles a fingerprint of 256 bits is made, in which two
sets at a Jaccard similarity of 0.8 differ in about 15 % of the bits. Sets that agree in
the bits of one of several tables meet in a bucket, where their first 128 bits are
compared as bit planes with carry-save counters and given up once past the radius. What
is left as near holds candidate groups together; in these the exact similarity of the
shingle sets decides which sets are linked. Equal sets are one node from the start.

The number of bits of a table grows with the logarithm of the number of sets, so that
about 64 strangers (a word of a plane) meet in a bucket; the number of tables follows
from it. The filter passes 99 % of the pairs at the threshold, the tables find about 96 %
of them (see README); pairs of 0.85 and more are practically all found.

In a candidate group a set that has been reached is compared only with those not reached
yet: a large group of near copies takes about one comparison a copy.

Results for odd input: a null or empty text has no shingles, and all of these are one
node; a text shorter than a shingle is one shingle; null and repeated ids are told apart
by their place, so each row counts by itself; an empty table gives no rows. Rows travel
whole, inside blocks, so no name of a column can clash.
"""

from __future__ import annotations

from math import ceil, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _hashing as H
from siltstone.llm._components import connected_components, link_within_groups, split_groups
from siltstone.llm._scratch import discard, pack_rows, persist, rows_of, trimmed, with_replies
from siltstone.llm.simhash import link as near_by_bits
from siltstone.llm.simhash import majority

U = np.uint64
WORDS = 4  # of 64 bits in a fingerprint; the first two are compared
RADIUS = 30
AGREE = 0.8485  # share of bits that sets at a Jaccard similarity of 0.8 have in common
MISS = 0.01  # of pairs at the threshold, were all bits independent
SLICE = 2048
SET_SLICE = 1 << 19  # shingles of a candidate group that are compared at once
FEW_SETS = 256  # rows of sets, whole groups at least, that a task holds
STEP = 1 << 20
SPREAD = np.random.default_rng(42).integers(0, 2**64, WORDS, U)
PRINTS = [f"f{i}" for i in range(WORDS)]


def table_shape(n: int) -> tuple[int, int]:
    """Bits of a table and number of tables for n sets."""
    bits = max(16, ceil(log2(max(n, 2))) - 6)
    return bits, ceil(log(MISS) / log(1 - AGREE**bits))


def shingle_sets(texts: list[bytes], shingle: int = 5, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each text's distinct shingles, in order, and where each text's end (len(texts) + 1 bounds)."""
    rows = [b" ".join(t.lower().split()) for t in texts]
    buf = b"\n".join(rows) + b"\n"
    at, to = H.word_spans(np.frombuffer(buf, np.uint8))
    ends = np.cumsum(np.fromiter((len(r) + 1 for r in rows), np.int64, len(rows)))
    doc = np.searchsorted(ends, at, "right")
    n_words = np.bincount(doc, minlength=len(rows))
    first = np.concatenate([[0], np.cumsum(n_words)])[:-1]
    short = np.flatnonzero((n_words > 0) & (n_words < shingle))
    i = np.flatnonzero(doc[: len(doc) - shingle + 1] == doc[shingle - 1 :]) if len(doc) >= shingle else np.empty(0, np.int64)
    begin = np.concatenate([at[i], at[first[short]]])
    stop = np.concatenate([to[i + shingle - 1], to[first[short] + n_words[short] - 1]])
    owner = np.concatenate([doc[i], short])
    h = H.xxh64(buf, begin, stop - begin, seed) if len(owner) else np.empty(0, U)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    return h[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(rows)))]).astype(np.int64)


def nodes_of(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A number for each set, 0 for the empty one."""
    out = np.zeros(len(bounds) - 1, U)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = H.mix(np.add.reduceat(H.mix(h + U(1)), bounds[full]))
    return out


def wide_prints(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """WORDS words of fingerprint for each set; the empty one has zeros."""
    out = np.zeros((len(bounds) - 1, WORDS), U)
    full = np.flatnonzero(np.diff(bounds))
    for w in range(WORDS if len(full) else 0):
        out[full, w] = majority(H.mix(h ^ SPREAD[w]), bounds[full])
    return out


def linked(h: np.ndarray, bounds: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all sets which a chain of pairs of at least this similarity connects."""
    ids = np.unique(h, return_inverse=True)[1]
    size = np.diff(bounds)
    seen = np.zeros(len(h) and int(ids.max()) + 1, bool)
    left = np.arange(len(size))
    i_all, j_all = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = left[np.minimum(size[left], size[x]) >= similarity * np.maximum(size[left], size[x]) - 1e-9]
            if not len(near):
                continue
            mine = ids[bounds[x] : bounds[x + 1]]
            seen[mine] = True
            start = np.concatenate([[0], np.cumsum(size[near])])
            at = np.arange(start[-1]) + np.repeat(bounds[near] - start[:-1], size[near])
            both = np.add.reduceat(seen[ids[at]].astype(np.int64), start[:-1])
            seen[mine] = False
            found = near[both >= similarity * (size[near] + size[x] - both) - 1e-9]
            queue.extend(found.tolist())
            i_all.append(np.full(len(found), x))
            j_all.append(found)
            left = left[~np.isin(left, found)]
    return np.concatenate(i_all), np.concatenate(j_all)


def link_sets(similarity: float):
    def run(t: pa.Table, starts: np.ndarray):
        sets = [np.frombuffer(b, U) for b in t.column("hashes").to_pylist()]
        i_all, j_all = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in zip(starts, [*starts[1:], t.num_rows], strict=True):
            bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets[a:b]])]).astype(np.int64)
            i, j = linked(np.concatenate(sets[a:b]), bounds, similarity)
            i_all.append(i + a)
            j_all.append(j + a)
        return np.concatenate(i_all), np.concatenate(j_all)

    return run


def _slices(body: bytes, text_at: int):
    """First row, rows and their texts, of about STEP bytes."""
    rows, first, size, texts = rows_of(body), 0, 0, []
    for n, t in enumerate(rows.column(text_at).cast(pa.binary()).to_pylist(), 1):
        texts.append(t or b"")
        size += len(texts[-1])
        if size >= STEP or n == rows.num_rows:
            yield rows.slice(first, n - first), first, texts
            first, size, texts = n, 0, []


def similar_rows(blocks: DataFrame, id_at: int, text_at: int, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """block, row, id, node (of its shingle set) and root, for each row of blocks of rows; chains of similar texts have one root."""

    def sign(batches):
        for rb in batches:
            for block, body in zip(rb.column("block").to_pylist(), rb.column("body").to_pylist(), strict=True):
                for rows, first, texts in _slices(body, text_at):
                    h, bounds = shingle_sets(texts, shingle)
                    prints = wide_prints(h, bounds).view(np.int64)
                    n = len(texts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, block)), pa.array(np.arange(first, first + n, dtype=np.int32)), rows.column(id_at).combine_chunks().cast(pa.int64()), pa.array(nodes_of(h, bounds).view(np.int64)), pa.array(np.diff(bounds)), *(pa.array(np.ascontiguousarray(prints[:, w])) for w in range(WORDS))],
                        names=["block", "row", "id", "node", "size", *PRINTS],
                    )

    signed = persist(blocks.select("block", "body").mapInArrow(trimmed(sign), "block long, row int, id long, node long, size long, " + ", ".join(f"{f} long" for f in PRINTS)), "signed")
    sets = persist(signed.where("node <> 0").groupBy("node").agg(F.min(F.struct("block", "row")).alias("at"), F.first("size").alias("size"), *(F.first(f).alias(f) for f in PRINTS)), "sets")
    bits, tables = table_shape(sets.count())
    rng = np.random.default_rng(42)
    chosen = np.stack([rng.permutation(64 * WORDS)[:bits] for _ in range(tables)])
    worth = np.int64(1) << np.arange(bits, dtype=np.int64)

    def buckets(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, 2048):
                rb = whole.slice(a, 2048)
                prints = np.stack([rb.column(f).to_numpy() for f in PRINTS], axis=1).astype("<i8")
                bit = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8).reshape(rb.num_rows, -1), axis=1, bitorder="little")
                key = bit[:, chosen].astype(np.int64) @ worth + (np.arange(tables, dtype=np.int64) << bits)
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), *(pa.array(np.repeat(rb.column(c).to_numpy(), tables)) for c in ("node", *PRINTS[:2]))], names=["g", "node", *PRINTS[:2]])

    met = sets.select("node", *PRINTS).mapInArrow(trimmed(buckets), "g long, node long, f0 long, f1 long")
    near = link_within_groups(split_groups(met, "g", F.xxhash64("node"), SLICE), ["g", "lo", "hi"], near_by_bits(RADIUS, tuple(PRINTS[:2])), "node")
    groups = persist(connected_components(near, "a", "b").withColumnRenamed("root", "g"), "groups")
    asked = persist(groups.join(sets.select("node", "at", "size"), "node").select("node", "g", "size", F.col("at.block").alias("block"), F.col("at.row").alias("row")), "asked")

    def collect(batches):
        for rb in batches:
            for body, said in zip(rb.column("body").to_pylist(), rb.column("said").to_pylist(), strict=True):
                if not said:
                    continue
                wanted = {x["row"]: x for x in said}
                for _, first, texts in _slices(body, text_at):
                    mine = [i for i in range(len(texts)) if first + i in wanted]
                    if mine:
                        h, bounds = shingle_sets([texts[i] for i in mine], shingle)
                        ask = [wanted[first + i] for i in mine]
                        yield pa.RecordBatch.from_arrays([pa.array([x["node"] for x in ask], pa.int64()), pa.array([x["g"] for x in ask], pa.int64()), pa.array([x["size"] for x in ask], pa.int64()), pa.array([h[a:z].tobytes() for a, z in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], names=["node", "g", "size", "hashes"])

    held = with_replies(blocks.select("block", "body"), asked).mapInArrow(trimmed(collect), "node long, g long, size long, hashes binary")
    held = persist(held, "hashes")
    edges = link_within_groups(split_groups(held, "g", F.xxhash64("node"), SET_SLICE, F.col("size")), ["g", "lo", "hi"], link_sets(similarity), "node", FEW_SETS)
    roots = connected_components(edges, "a", "b").withColumnRenamed("node", "_node")
    out = persist(signed.select("block", "row", "id", "node").join(roots, F.col("node") == F.col("_node"), "left").select("block", "row", "id", "node", F.coalesce("root", "node").alias("root")), "similar")
    discard(signed, sets, groups, asked, held)
    return out


def keep_one_of_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Rows of docs, all columns, one for each group of similar documents: that with the smallest id (a null id only if all are), of rows with one id that with the smallest node.

    Texts are written once, to blocks; what goes back to a block is which of its rows stay.
    """
    blocks = pack_rows(docs, text_col)
    found = similar_rows(blocks, docs.columns.index(id_col), docs.columns.index(text_col), shingle, similarity)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "node", "block", "row")).alias("b"))
    kept = persist(best.select(F.col("b.block").alias("block"), F.col("b.row").alias("row")), "kept")
    discard(found)

    def run(batches):
        for rb in batches:
            for body, said in zip(rb.column("body").to_pylist(), rb.column("said").to_pylist(), strict=True):
                if said:
                    yield from rows_of(body).take(sorted(x["row"] for x in said)).to_batches()

    return with_replies(blocks.select("block", "body"), kept).mapInArrow(trimmed(run), docs.schema)
