"""SimHash near-dedup with bit-sliced comparison.

Fingerprints of 64 bits are compared as bit planes: a word holds one bit of 64
fingerprints, a carry-save counter adds up where planes differ, and words whose
fingerprints have all passed the radius are abandoned. Which fingerprints meet:
cut into radius + 2 pieces, two that differ in at most `radius` bits agree in two
pieces at least, so each pair of pieces gives a table of buckets. Distinct
fingerprints meet once per bucket; large buckets are cut into pairs of slices.

Results for odd input: a null or empty text has fingerprint zero and is linked like
any other; a null id stays null and never names a component unless all ids in it
are null; repeated rows each get a result; an empty table gives no rows. Columns
besides id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _hashing as H
from siltstone.llm._components import connected_components, link_within_groups, split_groups
from siltstone.llm._scratch import chunks, ids_column, persist, small_batches, trimmed

U = np.uint64
ALL = U(2**64 - 1)
SLICE = 2048
FEW = 32  # groups up to this size are compared by shifting planes


def fingerprints(texts: list[bytes], shingle: int = 3, seed: int = 42) -> np.ndarray:
    """A fingerprint for each text; bit b is set if it is in over half of the shingles' XXH64."""
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
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    h = H.xxh64(buf, begin[order], (stop - begin)[order], seed)
    out = np.zeros(len(rows), U)
    if len(h):
        head = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[head]] = majority(h, head)
    return out


def majority(h: np.ndarray, head: np.ndarray) -> np.ndarray:
    """For each run of hashes, which begin at head, the bits that over half of them have."""
    # bytes count up to 255, so runs are summed in pieces of that many hashes
    size = np.diff(head, append=len(h))
    pieces = -(-size // 255)
    piece_of = np.concatenate([[0], np.cumsum(pieces)])[:-1]
    within = np.arange(pieces.sum()) - np.repeat(piece_of, pieces)
    start = np.repeat(head, pieces) + within * 255
    count = np.empty((len(head), 64), np.int64)
    for s in range(8):
        part = np.add.reduceat((h >> U(s)) & U(0x0101010101010101), start)
        count[:, s::8] = np.add.reduceat(part.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), piece_of)
    bits = (2 * count > size[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def planes_of(fp: np.ndarray) -> np.ndarray:
    """A row of words for each bit: bit i of row b is bit b of fingerprint i. fp: words, or a row of words each."""
    words = fp.reshape(len(fp), -1)
    n, width = -(-max(len(words), 1) // 64) * 64, words.shape[1] if len(words) else 1
    padded = np.zeros((n, width), "<u8")
    padded[: len(words)] = words
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8 * width), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8").astype(U)


def far_apart(differ, n: int, out: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Add up planes of differing bits; words whose bits are all out are abandoned.

    differ(b, live): plane b of the words `live`. out: bits out from the start.
    Returns the words left and, of each, the bits out.
    """
    counters = max(1, int(radius).bit_length())
    live = np.flatnonzero(out != ALL)
    out = out[live]
    # started so that the counter runs over with difference radius + 1
    init = 2**counters - 1 - radius
    c = [np.full(len(live), ALL if init >> k & 1 else U(0), U) for k in range(counters)]
    for b in range(n):
        carry = differ(b, live)
        for k in range(counters):
            c[k], carry = c[k] ^ carry, c[k] & carry
        out = out | carry
        if b % 8 == 7:
            keep = out != ALL
            if not keep.any():
                return live[:0], out[:0]
            if keep.mean() < 0.7:
                live, out, c = live[keep], out[keep], [x[keep] for x in c]
    return live, out


def bits_at(live: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Positions of the bits that are not out."""
    w, b = np.nonzero(np.unpackbits((~out).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return live[w] * 64 + b


def near_neighbours(fp: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in groups of at most FEW rows, given in order: planes against themselves, shifted."""
    p = planes_of(fp)
    longest = int(np.bincount(group).max()) if len(group) else 0
    i_all, j_all = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    nxt = np.concatenate([p[:, 1:], np.zeros((len(p), 1), U)], axis=1)
    for d in range(1, longest):
        same = np.zeros(p.shape[1] * 64, bool)
        same[: len(group) - d] = group[d:] == group[:-d]
        out = ~np.packbits(same, bitorder="little").view("<u8").astype(U)
        shift, back = U(d), U(64 - d)
        live, left = far_apart(lambda b, w: p[b][w] ^ ((p[b][w] >> shift) | (nxt[b][w] << back)), len(p), out, radius)  # noqa: B023
        i = bits_at(live, left)
        i_all.append(i)
        j_all.append(i + d)
    return np.concatenate(i_all), np.concatenate(j_all)


def near_queries(queries: np.ndarray, fp: np.ndarray, radius: int, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """All (query, fingerprint) within the radius: planes against each query."""
    p = planes_of(fp)
    words = p.shape[1]
    tail = np.zeros(words * 64, bool)
    tail[len(fp) :] = True
    tail_out = np.packbits(tail, bitorder="little").view("<u8").astype(U)
    q_all, f_all = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for a in range(0, len(queries), step):
        q = queries[a : a + step]
        bits = np.unpackbits(np.ascontiguousarray(q).astype("<u8").view(np.uint8).reshape(len(q), -1), axis=1, bitorder="little")
        flip = np.where(bits.T, ALL, U(0))
        live, left = far_apart(lambda b, w: p[b][w % words] ^ flip[b][w // words], len(p), np.tile(tail_out, len(q)), radius)  # noqa: B023
        at = bits_at(live, left)
        q_all.append(a + at // (words * 64))
        f_all.append(at % (words * 64))
    return np.concatenate(q_all), np.concatenate(f_all)


def link(radius: int, columns: tuple[str, ...] = ("fp",)):
    def run(t: pa.Table, starts: np.ndarray):
        fp = np.stack([t.column(c).to_numpy().view(U) for c in columns], axis=1)
        lo, hi, side = (t.column(c).to_numpy() for c in ("lo", "hi", "side"))
        size = np.diff(starts, append=t.num_rows)
        group = np.repeat(np.arange(len(starts)), size)
        small = ((size <= FEW) & (lo[starts] == hi[starts]))[group]
        at = np.flatnonzero(small)
        i, j = near_neighbours(fp[at], group[at], radius)
        i_all, j_all = [at[i]], [at[j]]
        for g in np.flatnonzero((size > FEW) | (lo[starts] != hi[starts])):
            rows = np.arange(starts[g], starts[g] + size[g])
            if lo[rows[0]] == hi[rows[0]]:
                a = b = rows
            else:
                a, b = rows[side[rows] == lo[rows[0]]], rows[side[rows] == hi[rows[0]]]
            q, f = near_queries(fp[a], fp[b], radius)
            i_all.append(a[q])
            j_all.append(b[f])
        return np.concatenate(i_all), np.concatenate(j_all)

    return run


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a long, for each row of docs."""
    small_batches(docs.sparkSession)

    def run(batches):
        for ids, texts in chunks(batches, 1 << 20):
            yield pa.RecordBatch.from_arrays([ids_column(ids), pa.array(fingerprints(texts, shingle).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(trimmed(run), "doc_id long, fp long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, shingle: int = 3) -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits), component_id and root, a row for each row of docs.

    component_id is the smallest id that can be reached by fingerprints that differ in
    at most `radius` bits; root names the component by its smallest fingerprint.
    """
    prints = persist(fingerprint_documents(docs, id_col, text_col, shingle), "fingerprints")
    distinct = persist(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    pieces = radius + 2
    cuts = [64 * i // pieces for i in range(pieces + 1)]
    mask = lambda i: ((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    keys = [F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(signed(mask(i) | mask(j))))) for n, (i, j) in enumerate(combinations(range(pieces), 2))]
    buckets = distinct.select("fp", F.explode(F.array(*keys)).alias("g"))
    dealt = split_groups(buckets, "g", F.xxhash64("fp"), SLICE, single=False)
    edges = link_within_groups(dealt, ["g", "lo", "hi"], link(radius), "fp")
    roots = connected_components(edges, "a", "b")
    named = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    component = persist(named.join(low, "root").select("fp", "component_id", "root"), "components")
    return prints.join(component, "fp").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")
