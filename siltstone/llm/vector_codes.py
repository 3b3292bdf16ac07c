"""Product codes of vectors by Elkan's form of Lloyd's method.

Vectors become integers and are cut into equal parts. Each part has a codebook, whose
entries start as that part of the first vectors. Each round assigns every part to its
nearest entry and moves every entry to the floored mean of its parts.

What is known of a part is kept between rounds beside its vector, in blocks in the shared
folder: its entry, an upper bound of the distance to it, and a lower bound of the distance
to every entry. When entries move, bounds are shifted by how far. An entry is passed by
only if the triangle inequality says strictly that another is nearer: its lower bound, or
half its distance from the part's own entry, is above the upper bound. All else is decided
by integer squared distances, ties for the lower index. Upper bounds are rounded up and
lower bounds down, so rounding never passes an entry by. A lower bound takes a byte, in
64ths of the upper bound at the time.

Only sums and counts of each entry's parts reach the driver, and the codebooks the tasks.
The state takes about 1.1 KB a vector for 16 parts of 64 entries; that of a round is deleted
once the next is written.

Results for odd input: a row whose vector is null or holds a null or a number that is not
finite is dropped. Vectors of another length than the commonest that is divisible by the
number of parts (the shorter at ties) are not coded: code and error are null. With fewer
kept rows than entries the codebooks are smaller. Null ids come after all others in the
choice of first entries, ties of ids are settled by the vector. Repeated rows are rows of
their own. Null labels are one label; the label's error leaves rows without a code out.
An empty table gives no rows and empty codebooks. A component of 2^24 or more after scaling
raises ValueError, as sums could leave 64 bits. Columns besides id, vector and label are
not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm._scratch import discard, persist, small_batches, trimmed

PARTS, ENTRIES, ROUNDS = 16, 64, 2
BLOCK = 2048
STEPS = 64  # of a lower bound in an upper bound
UP = 1 + 1e-9  # more than rounding takes off a distance


def split_parts(x: np.ndarray, parts: int) -> np.ndarray:
    """part, row, component."""
    return np.ascontiguousarray(x.reshape(len(x), parts, -1).transpose(1, 0, 2)).astype(np.int64)


class Codebooks:
    """entries[part, entry, component], and what pruning needs: half distances between entries and to the nearest other."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray | None = None) -> None:
        self.entries = entries
        between = np.sqrt(((entries[:, :, None, :] - entries[:, None, :, :]) ** 2).sum(axis=3).astype(np.float64))
        self.half = between / 2 / UP
        apart = self.half.copy()
        n = entries.shape[1]
        apart[:, np.arange(n), np.arange(n)] = np.inf
        self.nearest = apart.min(axis=2) if n > 1 else np.full(entries.shape[:2], np.inf)
        #: How far each entry has moved, rounded up.
        self.moved = np.zeros(entries.shape[:2]) if moved is None else moved

    def after(self, entries: np.ndarray) -> Codebooks:
        return Codebooks(entries, np.sqrt(((entries - self.entries) ** 2).sum(axis=2).astype(np.float64)) * UP)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def assign(x: np.ndarray, books: Codebooks, known: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Entry, upper bound, lower bounds and exact squared distance (-1: not computed) of each part, and how many distances were computed.

    x: part, row, component. known: entries, upper and lower bounds of the round before.
    """
    parts, n, _ = x.shape
    k = books.entries.shape[1]
    code, high, low, square, computed = np.zeros((parts, n), np.int64), np.zeros((parts, n)), np.zeros((parts, k, n)), np.full((parts, n), -1, np.int64), 0
    for p in range(parts):
        entries, half = books.entries[p], books.half[p]
        if known is None:
            own, bounds, rows = np.zeros(n, np.int64), low[p], np.arange(n)
            upto = np.zeros(n)
        else:
            own = known[0][p].astype(np.int64)
            upto = known[1][p] + books.moved[p][own]
            bounds = np.maximum(known[2][p] / UP - books.moved[p][:, None], 0)
            rows = np.flatnonzero(upto >= books.nearest[p][own])
        best = np.full(n, -1, np.int64)
        best[rows] = ((x[p, rows] - entries[own[rows]]) ** 2).sum(axis=1)
        root = np.sqrt(best[rows].astype(np.float64))
        upto[rows], bounds[own[rows], rows] = root * UP, root / UP
        computed += len(rows)
        for j in range(k):
            if not len(rows):
                break
            u = upto[rows]
            near = rows[(own[rows] != j) & (bounds[j, rows] <= u) & (half[own[rows], j] <= u)]
            if not len(near):
                continue
            d = ((x[p, near] - entries[j]) ** 2).sum(axis=1)
            computed += len(near)
            root = np.sqrt(d.astype(np.float64))
            bounds[j, near] = root / UP
            better = (d < best[near]) | ((d == best[near]) & (j < own[near]))
            at = near[better]
            own[at], best[at], upto[at] = j, d[better], root[better] * UP
        # an entry that was passed by is at least as far as the triangle inequality says
        np.maximum(bounds, (2 * half[:, own] - upto) / UP, out=bounds)
        bounds[own, np.arange(n)] = 0
        code[p], high[p], low[p], square[p] = own, upto, bounds, best
    return code, high, low, square, computed


def pack_bounds(high: np.ndarray, low: np.ndarray) -> tuple[bytes, bytes]:
    """Upper bounds as they are; lower bounds in 64ths of them, rounded down. For a bound of 0 the unit is that of 1."""
    unit = np.maximum(high, 1)[:, None, :] / STEPS
    return high.tobytes(), np.minimum(np.floor(low / unit), 255).astype(np.uint8).tobytes()


def unpack_bounds(high: bytes, low: bytes, parts: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(high, np.float64).reshape(parts, n).copy()
    return h, np.frombuffer(low, np.uint8).reshape(parts, -1, n) * (np.maximum(h, 1)[:, None, :] / STEPS)


def _blocks(rows: DataFrame, parts: int, scale: int) -> DataFrame:
    """Rows of ids, labels and integer vectors, BLOCK at a time."""

    def run(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, BLOCK):
                rb = whole.slice(a, BLOCK)
                flat = rb.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = np.floor(flat * scale).astype(np.int32)
                one = lambda c: pa.ListArray.from_arrays(pa.array([0, rb.num_rows], pa.int32()), c)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array([rb.num_rows], pa.int32()), one(rb.column(0)), one(rb.column(1)), pa.array([x.tobytes()], pa.binary())], names=["n", "ids", "labels", "x"])

    label = rows.schema["label"].dataType.simpleString()
    return persist(rows.select("id", "label", "v").mapInArrow(trimmed(run), f"n int, ids array<long>, labels array<{label}>, x binary"), "vectors")


def first_entries(rows: DataFrame, d: int, parts: int, entries: int, scale: int) -> np.ndarray:
    """Codebooks of the parts of the rows with the smallest ids."""
    first = rows.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    x = np.floor(np.array([r["v"] for r in first], np.float64).reshape(len(first), d) * scale).astype(np.int64)
    return split_parts(x, parts) if d else np.zeros((parts, 0, 0), np.int64)


def moved_entries(state: DataFrame, books: Codebooks) -> np.ndarray:
    """Floored means of the parts of each entry; entries without parts stay."""
    parts, k, w = books.entries.shape

    def run(batches):
        total, count = np.zeros((parts, k, w), np.int64), np.zeros((parts, k), np.int64)
        for rb in batches:
            for n, raw, code in zip(*(rb.column(c).to_pylist() for c in ("n", "x", "code")), strict=True):
                x = split_parts(np.frombuffer(raw, np.int32).reshape(n, -1), parts)
                own = np.frombuffer(code, np.uint8).reshape(parts, n).astype(np.int64)
                for p in range(parts):
                    count[p] += np.bincount(own[p], minlength=k)
                    np.add.at(total[p], own[p], x[p])
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array((p * k + e).astype(np.int32)), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))], names=["e", "n", "sums"])

    sent = state.select("n", "x", "code").mapInArrow(trimmed(run), "e int, n long, sums array<long>")
    # a row for each component of each entry, whatever the number of vectors
    sums = sent.select("e", "n", F.posexplode("sums").alias("i", "s")).groupBy("e", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    out = books.entries.reshape(parts * k, w).copy()
    for r in sums:
        out[r["e"], r["i"]] = r["s"] // r["n"]
    return out.reshape(parts, k, w)


def assigned(state: DataFrame, books: Codebooks, parts: int, last: bool) -> DataFrame:
    """The next state; of the last only codes and errors of rows."""
    shared = state.sparkSession.sparkContext.broadcast(books)
    known = "code" in state.columns
    label = state.schema["labels"].dataType.elementType.simpleString()

    def run(batches):
        for whole in batches:
            for at in range(whole.num_rows):
                rb = whole.slice(at, 1)
                n = rb.column("n")[0].as_py()
                x = split_parts(np.frombuffer(rb.column("x")[0].as_py(), np.int32).reshape(n, -1), parts)
                old = None
                if known:
                    old = (np.frombuffer(rb.column("code")[0].as_py(), np.uint8).reshape(parts, n), *unpack_bounds(rb.column("high")[0].as_py(), rb.column("low")[0].as_py(), parts, n))
                code, high, low, square, _ = assign(x, shared.value, old)
                codes = code.astype(np.uint8)
                if not last:
                    columns = [rb.column(c) for c in ("n", "ids", "labels", "x")] + [pa.array([b], pa.binary()) for b in (codes.tobytes(), *pack_bounds(high, low))]
                    yield pa.RecordBatch.from_arrays(columns, names=["n", "ids", "labels", "x", "code", "high", "low"])
                    continue
                own = np.take_along_axis(shared.value.entries, code[:, :, None], axis=1)
                error = ((x - own) ** 2).sum(axis=(0, 2))
                text = pa.array([r.tobytes().hex() for r in np.ascontiguousarray(codes.T)], pa.string())
                yield pa.RecordBatch.from_arrays([rb.column("ids").flatten(), rb.column("labels").flatten(), text, pa.array(error)], names=["vec_id", "label", "code", "error"])

    if last:
        return persist(state.mapInArrow(trimmed(run), f"vec_id long, label {label}, code string, error long"), "codes")
    return persist(state.mapInArrow(trimmed(run), f"n int, ids array<long>, labels array<{label}>, x binary, code binary, high binary, low binary"), "state")


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = 256) -> tuple[DataFrame, Codebooks]:
    """vec_id, label, code and error of each kept row, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index takes a byte")
    small_batches(vectors.sparkSession)
    v = F.col("v")
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")).where(v.isNotNull() & finite)
    sizes = rows.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("n"), F.max(F.array_max(F.transform(v, lambda x: F.abs(F.floor(x * scale))))).alias("most"))
    common = sizes.where((F.col("d") > 0) & (F.col("d") % parts == 0)).orderBy(F.desc("n"), "d").first()
    d = common["d"] if common else 0
    if common and common["most"] >= 1 << 24:
        raise ValueError("components of these vectors would let sums leave 64 bits")
    fit = rows.where(F.size(v) == d) if d else rows.limit(0)
    books = Codebooks(first_entries(fit, d, parts, entries, scale))
    state = _blocks(fit, parts, scale)
    for _ in range(rounds):
        after = assigned(state, books, parts, False)
        discard(state)
        state, books = after, books.after(moved_entries(after, books))
    coded = assigned(state, books, parts, True)
    discard(state)
    if d:
        return coded.unionByName(rows.where(F.size(v) != d).select(F.col("id").alias("vec_id"), "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))), books
    return rows.select(F.col("id").alias("vec_id"), "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error: error summed over rows of equal label, nulls together."""
    total = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(total, F.expr("label <=> _label")).drop("_label")
