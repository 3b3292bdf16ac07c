"""Hard negatives by a pivot table.

Vectors become integers. With M the largest norm, a row x gets a further component
sqrt(M^2 - |x|^2) and an anchor q gets 0, so that |q' - x'|^2 = M^2 + |q|^2 - 2<q, x>:
a large inner product is a small Euclidean distance. The distances of every row to a few
pivots are stored with it. By the triangle inequality they bracket its distance to an
anchor, and so its score, without reading its components; rows, blocks of rows and whole
slices whose bracket lies outside what an anchor still looks for are passed by, and the
scores of the others are computed exactly.

Rows are dealt by range of length, label, nearest pivot and distance to it into slices of
bounded size, and anchors into waves; a task holds one slice and one wave. It sends at
most the best few of each anchor. So anchors meet all rows in blocks, and what is moved is
rows times waves plus anchors times slices. Pivots come from a sample of `sample` rows; they
decide what is passed by, never what is found.

Results for odd input: a row with a null label, a null vector, or a null or not finite
component takes no part. Vectors of different lengths are not compared; empty ones have
the score 0. A null id is never an anchor unless `anchor` says so, and comes before others
at ties. Repeated rows are rows of their own: each is found, and each asks if it is an
anchor. A positive score below zero has no negatives. An empty table, or one without
anchors, gives no rows. Vectors so long that scores could leave the exact range of a
double raise ValueError. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from siltstone.llm._scratch import NULL_ID, persist, shuffle_width, trimmed

PIVOTS = 8
SAMPLE = 512
BLOCK = 1024  # rows
GROUP = 256  # anchors
WAVE = 64  # groups of anchors that a task holds
SLICE_BYTES = 16 << 20
BLOCKS = "slice int, block long, d int, n int, ids binary, labels binary, asks binary, x binary, far binary, lo array<double>, hi array<double>"
GROUPS = "grp long, d int, n int, ids binary, labels binary, nodes binary, x binary, far binary, lo array<double>, hi array<double>, size double, least binary, floor double"
PAIRS = "node long, grp long, at int, anchor long, id long, score long"


def numbered_labels(rows: DataFrame, label: str) -> DataFrame:
    """rows with the label as a long: itself if it is an integer, else a number of its own for each."""
    if rows.schema[label].dataType.typeName() in ("byte", "short", "integer", "long"):
        return rows.withColumn(label, F.col(label).cast("long"))
    names = persist(rows.select(F.col(label).alias("_l")).distinct().withColumn("_n", F.monotonically_increasing_id()), "labels")
    return rows.join(names, F.col(label) == F.col("_l")).withColumn(label, F.col("_n")).drop("_l", "_n")


def integers(column: pa.Array, d: int, scale: int) -> np.ndarray:
    """floor(scale * x) of a column of arrays of length d, as doubles, which hold them exactly."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).reshape(len(column), d)


class Pivots:
    """Points of the augmented space; for vectors of a length their components are cut or repeated."""

    def __init__(self, rows: list[np.ndarray], most: float, n: int) -> None:
        self.most = most
        d = max((len(r) for r in rows), default=0)
        points = np.array([np.resize(r, d) if len(r) else np.zeros(d) for r in rows]).reshape(len(rows), d)
        whole = np.hstack([points, np.sqrt(np.maximum(most - (points * points).sum(axis=1), 0))[:, None]])
        chosen: list[int] = []
        near = np.full(len(rows), np.inf)
        while len(chosen) < min(n, len(rows)):
            # the point that is farthest from those chosen
            i = int(near.argmax()) if chosen else 0
            chosen.append(i)
            near = np.minimum(near, ((whole - whole[i]) ** 2).sum(axis=1))
        self.points = whole[chosen]

    def _parts(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        return np.array([np.resize(p[:-1], d) if len(p) > 1 else np.zeros(d) for p in self.points]).reshape(len(self.points), d), self.points[:, -1]

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        """Distances of rows, augmented, to the pivots."""
        p, last = self._parts(x.shape[1])
        rest = np.sqrt(np.maximum(self.most - (x * x).sum(axis=1), 0))
        return np.sqrt(np.maximum(self.most + (p * p).sum(axis=1) + last * last - 2 * (x @ p.T + rest[:, None] * last), 0))

    def of_anchors(self, q: np.ndarray) -> np.ndarray:
        p, last = self._parts(q.shape[1])
        return np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] + (p * p).sum(axis=1) + last * last - 2 * q @ p.T, 0))


def slack(most: float) -> float:
    """More than what rounding adds to a bracket of scores."""
    return 1e-9 * most + 1e-6


def upper(most: float, size: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Largest score of an anchor (size: |q|^2) with what is at least `gap` away."""
    return (most + size - gap * gap) / 2 + slack(most)


def lower(most: float, size: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Least score of an anchor with what is at most `reach` away."""
    return (most + size - reach * reach) / 2 - slack(most)


class Best:
    """The k best of each anchor (or question of one): largest score, then smallest id."""

    def __init__(self, n: int, k: int, least: np.ndarray) -> None:
        self.n, self.k, self.least = n, k, least.astype(np.float64)
        self.row, self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.least[row]
        if not good.any():
            return
        row, score, ids = (np.concatenate([a, b[good]]) for a, b in ((self.row, row), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        first = np.searchsorted(row, np.arange(self.n))
        rank = np.arange(len(row)) - first[row]
        keep = rank < self.k
        self.row, self.score, self.id = row[keep], score[keep], ids[keep]
        full = np.flatnonzero(rank == self.k - 1)
        self.least[row[full]] = np.maximum(self.least[row[full]], score[full])


def _array(raw: bytes, kind, *shape: int) -> np.ndarray:
    return np.frombuffer(raw, kind).reshape(*shape) if shape else np.frombuffer(raw, kind)


def _sound(vector: Column) -> Column:
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def sampled(rows: DataFrame, n: int, most: int) -> list:
    """Rows with the least hashes, about `most` of n. Tasks send a few times as many in all, however many tasks there are."""
    share = min(1.0, 4 * most / max(n, 1))
    hashed = rows.select("v", F.xxhash64("v", "id").alias("h"))
    some = hashed.where(F.col("h") <= F.lit(min(2**63 - 1, -(2**63) + int(share * 2**64)))).orderBy("h", "v").limit(most).collect()
    # rows that are all alike may have no hash in the share
    return some or rows.select("v").limit(most).collect()


def pivot_table(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int, n_pivots: int = PIVOTS, sample: int = SAMPLE) -> tuple[DataFrame, Pivots]:
    """Blocks of rows with their distances to the pivots, written; the pivots."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("asks"))
    rows = numbered_labels(rows.where(F.col("label").isNotNull() & _sound(F.col("v"))), "label").withColumn("d", F.size("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.floor(x * scale).cast("double") * F.floor(x * scale).cast("double"))
    most, n, total = rows.agg(F.max(norm), F.count("*"), F.sum(F.col("d") + 8)).first()
    if most is not None and most >= 2**52:
        raise ValueError("scores of these vectors would leave the exact range of a double")
    some = sampled(rows, n, sample)
    pivots = Pivots([np.floor(np.array(r["v"], np.float64) * scale) for r in some], most or 0.0, n_pivots)
    shared = spark.sparkContext.broadcast(pivots)
    slices = int(max(1, -(-(total or 0) * 8 // SLICE_BYTES), min(shuffle_width(spark), -(-n // (2 * BLOCK)))))

    def measure(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, BLOCK):
                some = pa.Table.from_batches([whole.slice(a, BLOCK)]).sort_by("d").combine_chunks()
                d = some.column("d").to_numpy()
                cut = np.flatnonzero(np.diff(d, prepend=-1, append=-1))
                for i, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    t = some.slice(i, z - i)
                    x = integers(t.column("v").combine_chunks(), int(d[i]), scale)
                    far = shared.value.of_rows(x)
                    near = far.argmin(axis=1)
                    as_bytes = lambda m: pa.array([r.tobytes() for r in m], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [t.column("id").combine_chunks(), t.column("label").combine_chunks(), t.column("asks").combine_chunks(), t.column("d").combine_chunks(), as_bytes(x.astype(np.int32)), as_bytes(far), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(near)), near])],
                        names=["id", "label", "asks", "d", "x", "far", "cell", "away"],
                    )

    def blocks(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for whole in batches:
            d = whole.column("d").to_numpy()
            for i, z in _runs(d, BLOCK):
                t = whole.slice(i, z - i)
                far = _array(b"".join(t.column("far").to_pylist()), np.float64, z - i, -1)
                ids = t.column("id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                row = [part, part << 24 | seq, int(d[i]), z - i, ids.tobytes(), t.column("label").to_numpy().tobytes(), t.column("asks").to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(), b"".join(t.column("x").to_pylist()), far.tobytes(), far.min(axis=0).tolist(), far.max(axis=0).tolist()]
                yield _batch(BLOCKS, [row])
                seq += 1

    measured = rows.select("id", "label", "asks", "d", "v").mapInArrow(trimmed(measure), "id long, label long, asks boolean, d int, x binary, far binary, cell int, away double")
    order = ["d", "label", "cell", "away", "id", "_n"]
    dealt = measured.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(slices, *order).sortWithinPartitions(*order)
    return persist(dealt.mapInArrow(trimmed(blocks), BLOCKS), "pivots"), pivots


def _runs(d: np.ndarray, most: int):
    """Ranges of equal d, of at most `most` rows."""
    cut = np.flatnonzero(np.diff(d, prepend=-1, append=-1)).tolist()
    for a, z in zip(cut[:-1], cut[1:], strict=True):
        for i in range(a, z, most):
            yield i, min(i + most, z)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}


def _batch(schema: str, rows: list) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _TYPES[kind]) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def anchor_groups(blocks: DataFrame, pivots: Pivots, k: int) -> DataFrame:
    """Anchors in groups, each with the k-th best score of its label in its own block, below which it need not look."""
    shared = blocks.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def group(d: int):
            nonlocal seq
            ids, labels, nodes, x, least = (np.concatenate(c) for c in zip(*held.pop(d), strict=True))
            far = shared.value.of_anchors(x)
            size = (x * x).sum(axis=1)
            row = [part << 32 | seq, d, len(ids), ids.tobytes(), labels.tobytes(), nodes.tobytes(), x.astype(np.int32).tobytes(), far.tobytes(), far.min(axis=0).tolist(), far.max(axis=0).tolist(), float(size.max()), least.tobytes(), float(least.min())]
            seq += 1
            return _batch(GROUPS, [row])

        for rb in batches:
            for b in rb.to_pylist():
                asks = np.flatnonzero(_array(b["asks"], np.uint8))
                if not len(asks):
                    continue
                ids, labels = _array(b["ids"], np.int64), _array(b["labels"], np.int64)
                x = _array(b["x"], np.int32, b["n"], b["d"]).astype(np.float64)
                for at in range(0, len(asks), GROUP):
                    own = asks[at : at + GROUP]
                    score = np.where((labels[own][:, None] == labels) & (own[:, None] != np.arange(b["n"])), x[own] @ x.T, -np.inf)
                    least = np.partition(score, b["n"] - k, axis=1)[:, b["n"] - k] if b["n"] > k else np.full(len(own), -np.inf)
                    held.setdefault(b["d"], []).append((ids[own], labels[own], (b["block"] << 16) + own, x[own], least))
                    if sum(len(h[0]) for h in held[b["d"]]) >= GROUP:
                        yield group(b["d"])
        for d in list(held):
            yield group(d)

    return persist(blocks.mapInArrow(trimmed(run), GROUPS), "anchors")


def meet(groups: DataFrame, blocks: DataFrame, slices: int, most: float, search, schema: str) -> DataFrame:
    """search(wave of groups, blocks of a slice) for each wave and slice whose bracket reaches a floor of the wave.

    groups: with lo, hi, size and floor, the least score that one of their anchors looks for.
    """
    waves = max(1, -(-groups.count() // WAVE))
    bounds = blocks.groupBy("slice", "d").agg(*(f(F.get(F.col(c), F.lit(i))).alias(f"{c}{i}") for c, f in (("lo", F.min), ("hi", F.max)) for i in range(PIVOTS)))
    sides = bounds.select("slice", "d", *(F.array(*(F.col(f"{c}{i}") for i in range(PIVOTS))).alias(f"_{c}") for c in ("lo", "hi")))
    asked = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).join(F.broadcast(sides), ["slice", "d"])
    beyond = F.zip_with(F.col("lo"), F.col("_hi"), lambda a, b: a - b)
    before = F.zip_with(F.col("_lo"), F.col("hi"), lambda a, b: a - b)
    # pivots that a small table lacks are null and say nothing
    gap = F.aggregate(F.concat(beyond, before), F.lit(0.0), lambda m, g: F.greatest(m, F.coalesce(g, F.lit(0.0))))
    asked = asked.where((F.lit(most) + F.col("size") - gap * gap) / 2 + slack(most) >= F.col("floor")).drop("_lo", "_hi")
    asked = asked.withColumn("wave", F.pmod(F.xxhash64("grp"), F.lit(waves)).cast("int"))
    rows = blocks.withColumn("wave", F.explode(F.sequence(F.lit(0), F.lit(waves - 1))))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return search(a.to_pylist(), b)

    return asked.groupBy("slice", "wave").cogroup(rows.groupBy("slice", "wave")).applyInArrow(trimmed_pair(run), schema)


def trimmed_pair(f):
    give = trimmed(lambda t: t)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out = f(a, b)
        give(out)
        return out

    return run


def survivors(group: dict, block: dict, most: float, low: np.ndarray, high: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of anchor and row of a block whose bracket of scores meets [low, high] of the anchor."""
    q = _array(group["far"], np.float64, group["n"], -1)
    size = (_array(group["x"], np.int32, group["n"], group["d"]).astype(np.float64) ** 2).sum(axis=1)
    gap = np.maximum(np.maximum(q - np.array(block["hi"]), np.array(block["lo"]) - q), 0).max(axis=1)
    rows = np.flatnonzero(upper(most, size, gap) >= low)
    if not len(rows):
        return rows, rows
    far = _array(block["far"], np.float64, block["n"], -1)
    near, reach = np.zeros((len(rows), block["n"])), np.full((len(rows), block["n"]), np.inf)
    for p in range(q.shape[1]):
        np.maximum(near, np.abs(q[rows, p][:, None] - far[:, p]), out=near)
        if high is not None:
            np.minimum(reach, q[rows, p][:, None] + far[:, p], out=reach)
    ok = upper(most, size[rows][:, None], near) >= low[rows][:, None]
    if high is not None:
        ok &= lower(most, size[rows][:, None], reach) <= high[rows][:, None]
    i, j = np.nonzero(ok)
    return rows[i], j


def exact(group: dict, block: dict, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Scores of pairs. Where most pairs of the rows concerned are asked for, by one product."""
    q, x = (_array(t["x"], np.int32, t["n"], t["d"]).astype(np.float64) for t in (group, block))
    a, z = np.unique(i), np.unique(j)
    if 4 * len(i) >= len(a) * len(z):
        return (q[a] @ x[z].T)[np.searchsorted(a, i), np.searchsorted(z, j)].astype(np.int64)
    return np.concatenate([np.einsum("ij,ij->i", q[i[s : s + 65536]], x[j[s : s + 65536]]) for s in range(0, len(i), 65536)]).astype(np.int64)


def _blocks(t: pa.Table):
    for rb in t.to_batches(max_chunksize=1):
        yield rb.to_pylist()[0]


def mine_hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchor: which rows ask. Of each, the `positives` best other rows of its label; for each of
    these the `negatives` best rows of other labels with a score from low to high percent of
    the positive's.
    """
    blocks, pivots = pivot_table(vectors, id_col, vector_col, label_col, anchor, scale)
    slices = (blocks.agg(F.max("slice")).first()[0] or 0) + 1
    most = pivots.most
    groups = anchor_groups(blocks, pivots, positives)

    def same_label(asked: list[dict], rows: pa.Table) -> pa.Table:
        state = [Best(g["n"], positives, _array(g["least"], np.float64)) for g in asked]
        for b in _blocks(rows):
            labels, ids = _array(b["labels"], np.int64), _array(b["ids"], np.int64)
            for g, best in zip(asked, state, strict=True):
                if g["d"] != b["d"]:
                    continue
                own = _array(g["labels"], np.int64)
                wanted = np.isin(own, labels)
                if not wanted.any():
                    continue
                i, j = survivors(g, b, most, np.where(wanted, best.least, np.inf))
                ok = (own[i] == labels[j]) & (_array(g["nodes"], np.int64)[i] != (b["block"] << 16) + j)
                i, j = i[ok], j[ok]
                if len(i):
                    best.add(i, exact(g, b, i, j), ids[j])
        out = [_found(g, s.row, s.id, s.score) for g, s in zip(asked, state, strict=True)]
        return pa.Table.from_batches(out) if out else _batch(PAIRS, []).schema.empty_table()

    found = meet(groups, blocks, slices, most, same_label, PAIRS)
    best = W.Window.partitionBy("node").orderBy(F.desc("score"), "id")
    positive = persist(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives), "positives")
    asked = positive.groupBy("grp").agg(F.collect_list(F.struct("at", "rank", "id", "score")).alias("pos"), F.min(F.ceil(F.col("score") * low / 100)).cast("double").alias("_f"))
    second = persist(groups.join(asked, "grp").withColumn("floor", F.col("_f") - 1).drop("_f"), "asked")

    def other_label(asked: list[dict], rows: pa.Table) -> pa.Table:
        state = []
        for g in asked:
            pos = sorted((p["at"], p["rank"], p["id"], p["score"]) for p in g["pos"])
            at, rank, _, score = (np.array(c, np.int64) for c in zip(*pos, strict=True))
            at_least, at_most = np.full(g["n"], np.inf), np.full(g["n"], -np.inf)
            np.minimum.at(at_least, at, np.ceil(score * low / 100) - 1)
            np.maximum.at(at_most, at, np.floor(score * high / 100) + 1)
            first = np.searchsorted(at, np.arange(g["n"] + 1))
            state.append((at, rank, score, first, at_least, at_most, Best(len(at), negatives, np.full(len(at), -np.inf))))
        for b in _blocks(rows):
            labels, ids = _array(b["labels"], np.int64), _array(b["ids"], np.int64)
            for g, (_, _, score, first, at_least, at_most, best) in zip(asked, state, strict=True):
                if g["d"] != b["d"]:
                    continue
                i, j = survivors(g, b, most, at_least, at_most)
                ok = _array(g["labels"], np.int64)[i] != labels[j]
                i, j = i[ok], j[ok]
                if not len(i):
                    continue
                s = exact(g, b, i, j)
                # each pair once for every positive of its anchor
                n = first[i + 1] - first[i]
                ends = np.cumsum(n)
                question = np.repeat(first[i] - ends + n, n) + np.arange(ends[-1])
                s, j = np.repeat(s, n), np.repeat(j, n)
                ok = (100 * s >= low * score[question]) & (100 * s <= high * score[question])
                best.add(question[ok], s[ok], ids[j[ok]])
        out = [_found(g, at[s.row], s.id, s.score, rank[s.row]) for g, (at, rank, *_, s) in zip(asked, state, strict=True)]
        return pa.Table.from_batches(out) if out else _batch(f"{PAIRS}, pos int", []).schema.empty_table()

    hits = meet(second, blocks, slices, most, other_label, f"{PAIRS}, pos int")
    best = W.Window.partitionBy("node", "pos").orderBy(F.desc("score"), "id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    with_positive = ranked.join(positive.select("node", F.col("rank").alias("pos"), F.col("id").alias("positive"), F.col("score").alias("positive_score")), ["node", "pos"])
    shown = lambda c, name: F.when(F.col(c) != NULL_ID, F.col(c)).alias(name)
    return with_positive.select(shown("anchor", "anchor_id"), shown("positive", "positive_id"), F.col("rank").cast("int").alias("rank"), shown("id", "negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _found(g: dict, at: np.ndarray, ids: np.ndarray, score: np.ndarray, pos: np.ndarray | None = None) -> pa.RecordBatch:
    columns = [pa.array(_array(g["nodes"], np.int64)[at]), pa.array(np.full(len(at), g["grp"], np.int64)), pa.array(at.astype(np.int32)), pa.array(_array(g["ids"], np.int64)[at]), pa.array(ids), pa.array(score)]
    names = [c.split()[0] for c in PAIRS.split(", ")]
    if pos is not None:
        columns.append(pa.array(pos.astype(np.int32)))
        names.append("pos")
    return pa.RecordBatch.from_arrays(columns, names=names)
