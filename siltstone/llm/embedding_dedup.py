"""Embedding near-dedup by Euclidean p-stable hashing.

For vectors of length one, a cosine of c is a distance of sqrt(2 - 2c). Each table
buckets vectors by quantised projections on normal directions, which close vectors
share more often than far ones. Vectors that meet in a bucket are compared by exact
cosine. The number of projections grows with the logarithm of the number of distinct
vectors, so that strangers seldom meet; the number of tables follows from it and from
the recall asked for at the threshold itself (closer pairs are found more surely).

A bucket only gives links that hold its members together. Pairs are counted afterwards
within components, block by block, so a dense group neither sends all its pairs nor
counts one twice, and pairs that no bucket held but a chain of links does are counted.

Vectors are scaled by their largest component first, so that very large and very small
ones keep their direction. Those of one length are compared, with directions of their own.

Results for odd input: a vector that is null, zero, or holds a null or a number that is
not finite links with nothing; it is its own component. Vectors of different lengths do
not link. A null id stays null and names no component. Repeated rows count as further
vectors. An empty table gives no rows. Columns besides id and vector are not read, so
their names cannot clash.
"""

from __future__ import annotations

from functools import lru_cache
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm._components import connected_components, group_starts, link_within_groups, split_groups, whole_groups
from siltstone.llm._hashing import mix
from siltstone.llm._scratch import persist

WIDTH = 2.0
RECALL = 0.97  # of pairs right at the threshold
SLICE = 1024
FEW = 16


def agreement(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection is the same for two vectors at a distance."""
    r = width / distance
    return erf(r / sqrt(2)) - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def table_shape(n: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Projections of a table and number of tables for n distinct vectors."""
    k = max(4, ceil(log(max(n, 2)) / -log(agreement(sqrt(2)))))
    return k, ceil(log(1 - recall) / log(1 - agreement(sqrt(2 - 2 * threshold)) ** k))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit vectors of a column of arrays of one length, scaled by their largest component first."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = a.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(len(a), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


DIMS = 4096  # of directions that are held at once


@lru_cache(maxsize=8)
def _directions(seed: int, size: int, first: int, n: int) -> np.ndarray:
    """Rows first to first + DIMS of n normal directions for vectors of a length."""
    return np.random.default_rng([seed, size, first]).normal(size=(min(DIMS, size - first), n))


def _project(v: np.ndarray, seed: int, n: int) -> np.ndarray:
    return sum((v[:, a : a + DIMS] @ _directions(seed, v.shape[1], a, n) for a in range(0, v.shape[1], DIMS)), np.zeros((len(v), n)))


def _by_length(t: pa.Table) -> list[tuple[int, pa.Table]]:
    """Runs of rows with vectors of one length, with their first row."""
    d = t.column("d").to_numpy()
    cut = np.flatnonzero(np.diff(d, prepend=-1, append=-1))
    return [(int(a), t.slice(a, z - a)) for a, z in zip(cut[:-1], cut[1:], strict=True)]


def _link(threshold: float):
    def same_length(t: pa.Table, starts: np.ndarray):
        v = _matrix(t.column("vector"))
        lo, hi, side = (t.column(c).to_numpy() for c in ("lo", "hi", "side"))
        size = np.diff(starts, append=t.num_rows)
        group = np.repeat(np.arange(len(starts)), size)
        small = ((size <= FEW) & (lo[starts] == hi[starts]))[group]
        at = np.flatnonzero(small)
        i_all, j_all = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for d in range(1, FEW):
            i = np.flatnonzero(group[at][d:] == group[at][:-d]) if len(at) > d else np.empty(0, np.int64)
            i, j = at[i], at[i + d]
            near = np.einsum("ij,ij->i", v[i], v[j]) >= threshold
            i_all.append(i[near])
            j_all.append(j[near])
        for g in np.flatnonzero((size > FEW) | (lo[starts] != hi[starts])):
            a, b = _sides(np.arange(starts[g], starts[g] + size[g]), lo, hi, side)
            x, y = np.nonzero(v[a] @ v[b].T >= threshold)
            i_all.append(a[x])
            j_all.append(b[y])
        return np.concatenate(i_all), np.concatenate(j_all)

    def run(t: pa.Table, starts: np.ndarray):
        i_all, j_all = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for first, part in _by_length(t):
            own = starts[(starts >= first) & (starts < first + part.num_rows)] - first
            i, j = same_length(part, own)
            i_all.append(i + first)
            j_all.append(j + first)
        return np.concatenate(i_all), np.concatenate(j_all)

    return run


def _sides(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if lo[rows[0]] == hi[rows[0]]:
        return rows, rows
    return rows[side[rows] == lo[rows[0]]], rows[side[rows] == hi[rows[0]]]


def _count(threshold: float):
    """(node, links): how many vectors of other nodes in the same block each node links with."""

    def run(batches):
        for whole in whole_groups(batches, ["d", "root", "lo", "hi"], 20_000):
            for _, t in _by_length(whole):
                v, n, node = _matrix(t.column("vector")), t.column("n").to_numpy(), t.column("node").to_numpy()
                lo, hi, side = (t.column(c).to_numpy() for c in ("lo", "hi", "side"))
                starts = group_starts(t, ["root", "lo", "hi"])
                links = np.zeros(t.num_rows, np.int64)
                for s, size in zip(starts, np.diff(starts, append=t.num_rows), strict=True):
                    a, b = _sides(np.arange(s, s + size), lo, hi, side)
                    near = v[a] @ v[b].T >= threshold
                    if a is b:
                        np.fill_diagonal(near, False)
                        links[a] += near @ n[b]
                    else:
                        links[a] += near @ n[b]
                        links[b] += n[a] @ near
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links)], names=["node", "links"])

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, recall: float = RECALL, seed: int = 42) -> DataFrame:
    """vec_id, n_links (other vectors linked directly) and component_id (smallest id reachable), a row for each row of vectors."""
    given = vectors.select(vector_col).schema[0].dataType.simpleString()
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>" if given == "array<float>" else "array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(finite, F.lit(False)))
    good = rows.where("sound")
    distinct = persist(good.groupBy("vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("low")).withColumns({"node": F.monotonically_increasing_id(), "d": F.size("vector")}), "vectors")
    k, tables = table_shape(distinct.count(), threshold, recall)
    rng = np.random.default_rng(seed)
    shift = rng.uniform(0, WIDTH, tables * k)
    odd = rng.integers(0, 2**63, tables * k).astype(np.uint64) | np.uint64(1)

    def buckets(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, 512):
                some = pa.Table.from_batches([whole.slice(a, 512)]).sort_by("d")
                for _, t in _by_length(some):
                    q = np.floor((_project(_matrix(t.column("vector")), seed, tables * k) + shift) / WIDTH).astype(np.int64).view(np.uint64) * odd
                    own = np.arange(tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t.column("d")[0].as_py())
                    key = mix(q.reshape(-1, tables, k).sum(axis=2, dtype=np.uint64) + own)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(t.column("node").to_numpy(), tables)), pa.array(key.view(np.int64).ravel())], names=["node", "g"])

    bucketed = distinct.select("node", "vector", "d").mapInArrow(buckets, "node long, g long")
    met = split_groups(bucketed, "g", F.xxhash64("node"), SLICE, single=False).join(distinct.select("node", "vector", "d"), "node")
    edges = link_within_groups(met, ["d", "g", "lo", "hi"], _link(threshold), "node", 20_000)
    roots = persist(connected_components(edges, "a", "b"), "roots")
    members = distinct.join(roots, "node")
    blocks = split_groups(members.select("node", "root", "n", "vector", "d"), "root", F.xxhash64("node"), SLICE)
    counted = blocks.repartition("d", "root", "lo", "hi").sortWithinPartitions("d", "root", "lo", "hi").mapInArrow(_count(threshold), "node long, links long")
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    named = distinct.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    found = named.join(low, "root").join(links, "node", "left").select("vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    linked = good.join(persist(found, "found"), "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone)
