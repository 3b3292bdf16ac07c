"""A stored vector index of cells (R02, R04, S26), each a partition that a search can leave out.

Centroids are fitted on a bounded sample; every vector is stored in the cell of its nearest
one, beside the cell's size and radius. A search ranks cells for each question and reads the
first `probes` of them, from which exact scores are taken. The number of probes follows from
a recall that the build has measured on questions of its own. With exact=True a further
pass reads every cell that could still hold one of the k best: a score in a cell is at
most that of its centroid plus the question's length times the radius.

Vectors that are null or of another length than the first centroid's are refused at the
build. Ids have to be distinct. New, changed and vanished vectors are written by cell:
only cells that hold any of them are written again, centroids stay.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.search import CHUNK, SENT_BYTES, Leaders, dense, matrix
from siltstone.operators.windows import top_k
from siltstone.session import written
from siltstone.sources.snapshots import SnapshotStore

SAMPLE = 20_000
MOST_CELLS = 4096
PROBED = 256  # questions that recall is measured with
RECALLS = (0.9, 0.95, 0.99)


def fit_centroids(x: np.ndarray, cells: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Lloyd's rounds from random rows; a cell that gets empty takes the row that is farthest from its own centroid."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(rounds):
        own, away = nearest(x, centroids)
        n = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
        empty = np.flatnonzero(n == 0)
        centroids[empty] = x[np.argsort(-away)[: len(empty)]]
    return centroids


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row, and the distance to it."""
    own, away = np.empty(len(x), np.int64), np.empty(len(x))
    for a in range(0, len(x), CHUNK):
        part = x[a : a + CHUNK]
        d = (centroids * centroids).sum(axis=1) - 2 * part @ centroids.T
        own[a : a + CHUNK] = d.argmin(axis=1)
        away[a : a + CHUNK] = np.sqrt(((part - centroids[own[a : a + CHUNK]]) ** 2).sum(axis=1))
    return own, away


def _placed(vectors: DataFrame, vec_id: str, vector: str, meta: list[str], centroids: np.ndarray) -> DataFrame:
    """id, v, meta, cell and distance to the centroid of each vector."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<float>").alias("v"), *meta)
    wrong = F.raise_error(F.concat(F.lit("not a vector of the index: id "), F.col("id").cast("string")))
    rows = rows.withColumn("v", F.when(F.coalesce((F.size("v") == centroids.shape[1]) & F.forall("v", lambda x: x.isNotNull()), F.lit(False)), F.col("v")).otherwise(wrong))
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        for rb in batches:
            own, away = nearest(matrix(rb.column(1)), shared.value)
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(own.astype(np.int32)), pa.array(away)], names=[*rb.schema.names, "cell", "away"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, cell int, away double")


def _write(store: SnapshotStore, placed: DataFrame, about: dict, touched: list[int] | None) -> None:
    rows = written(placed, "placed")
    sizes = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    with store.transaction() as tx:
        if touched is None:
            tx.next["tables"] = {}
        tx.properties |= about
        # a cell with many copies is written by several tasks
        tx.replace("vectors", rows.drop("away").hint("rebalance", "cell").sortWithinPartitions("cell", "id"), "cell", touched)
        tx.replace("distances", rows.select("id", "cell", "away").hint("rebalance", "cell"), "cell", touched)
        tx.replace("cells", sizes.coalesce(1), "cell", touched)


def build(vectors: DataFrame, path: str, vec_id: str, vector: str, meta: list[str] | None = None, cells: int | None = None, sample: int = SAMPLE, k: int = 10) -> SnapshotStore:
    """An index at path, with the recall of k neighbours measured; cells: about the square root of the number of vectors, if not given."""
    store = SnapshotStore(vectors.sparkSession, path)
    some = vectors.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<float>").alias("v"), F.xxhash64(vec_id).alias("h"))
    rows = some.orderBy("h").limit(sample).select("v").toArrow()  # the bounded sample
    x = matrix(rows.column("v").combine_chunks()) if rows.num_rows else np.zeros((0, 0))
    cells = cells or min(MOST_CELLS, max(1, ceil(sqrt(vectors.count()))))
    centroids = fit_centroids(x, cells) if len(x) else np.zeros((1, 0))
    about = {"meta": meta or [], "centroids": centroids.tolist(), "probes": {}}
    _write(store, _placed(vectors, vec_id, vector, meta or [], centroids), about, None)
    measured = measure(store, k)
    with store.transaction() as tx:
        tx.properties["probes"] = measured
    return store


def measure(store: SnapshotStore, k: int) -> dict[str, int]:
    """For each of RECALLS the probes with which questions of the index's own find that share of their k best others."""
    vectors, centroids = store.read("vectors"), np.array(store.properties()["centroids"])
    asked = vectors.select(F.col("id").alias("qid"), F.col("v").alias("qv"), F.xxhash64("id").alias("h")).orderBy("h").limit(PROBED).select("qid", "qv")
    exact = dense(vectors, asked, "id", "v", "qid", "qv", k + 1).where("qid <> doc")
    home = exact.join(vectors.select(F.col("id").alias("doc"), "cell"), "doc").select("qid", "cell").join(asked, "qid").select("cell", "qv").toArrow()  # k rows a question
    if not home.num_rows:
        return {str(r): len(centroids) for r in RECALLS}
    scores = matrix(home.column("qv").combine_chunks()) @ centroids.T
    cell = home.column("cell").to_numpy()
    rank = (scores > scores[np.arange(len(cell)), cell][:, None]).sum(axis=1)
    return {str(r): int(np.sort(rank)[ceil(r * len(rank)) - 1]) + 1 for r in RECALLS}


def ranked_cells(q: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """Cells of each question, best first."""
    return np.argsort(-(q @ centroids.T), axis=1, kind="stable")[:, :probes]


def _scan(store: SnapshotStore, qids: pa.Array, q: np.ndarray, wanted: np.ndarray, k: int, where: Column | None, qid_type: str) -> DataFrame:
    """The k best of each task for each question in the cells it wants (question by cell); other cells are not opened."""
    rows = store.read("vectors", np.flatnonzero(wanted.any(axis=0)).tolist())
    rows = (rows if where is None else rows.where(where)).select(F.col("id").alias("doc"), "v", "cell")
    shared = store.spark.sparkContext.broadcast((qids, q, wanted))

    def run(batches):
        qids, q, wanted = shared.value
        best = Leaders(len(qids), k)
        for whole in batches:
            for a in range(0, whole.num_rows, CHUNK):
                rb = whole.slice(a, CHUNK)
                cell = rb.column(2).to_numpy()
                v = matrix(rb.column(1))
                for i in range(0, len(q), CHUNK):
                    ok = wanted[i : i + CHUNK][:, cell]
                    if ok.any():
                        best.add(i, q[i : i + CHUNK] @ v.T, rb.column(0), ok)
        yield from best.batches(qids)

    return rows.mapInArrow(run, f"qid {qid_type}, doc {rows.schema['doc'].dataType.simpleString()}, score double")


def search(store: SnapshotStore, queries: DataFrame, query_id: str, query_vector: str, k: int = 10, recall: float = 0.95, probes: int | None = None, exact: bool = False, where: Column | None = None, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """R04 over the stored index: qid, doc, score, rank. where: a filter on stored columns, before the choice of the best.

    Questions, with a mark for each cell, go to the tasks; sets beyond sent_bytes go one block
    after the other.
    """
    about = store.properties()
    centroids = np.array(about["centroids"])
    # numbers of a cell: at most MOST_CELLS rows
    sizes = {r["cell"]: r["radius"] for r in store.read("cells").select("cell", "radius").collect()}
    radius = np.array([sizes.get(c, -np.inf) for c in range(len(centroids))])
    probes = probes or about["probes"].get(str(recall)) or len(centroids)
    asked = queries.select(F.col(query_id).alias("qid"), F.col(query_vector).cast("array<double>").alias("v")).where(F.size("v") == centroids.shape[1])
    qid_type = asked.schema["qid"].dataType.simpleString()
    n = asked.count()
    blocks = max(1, -(-n * (8 * centroids.shape[1] + len(centroids)) // sent_bytes))
    asked = asked.withColumn("_b", F.pmod(F.xxhash64("qid", "v"), F.lit(blocks)))
    found = []
    for b in range(blocks):
        t = asked.where(F.col("_b") == b).select("qid", "v").toArrow()  # about sent_bytes
        if not t.num_rows:
            continue
        qids, q = t.column("qid").combine_chunks(), matrix(t.column("v").combine_chunks())
        first = np.zeros((len(q), len(centroids)), bool)
        np.put_along_axis(first, ranked_cells(q, centroids, probes), True, axis=1)
        hits = _scan(store, qids, q, first, k, where, qid_type)
        if exact:
            hits = written(hits, "hits")
            kth = top_k(hits, ["qid"], [F.desc(F.round("score", 9)), "doc"], k).where(F.col("rank") == k).select("qid", "score").collect()  # one row a question
            least = {r["qid"]: r["score"] for r in kth}
            floor = np.array([least.get(x, -np.inf) for x in qids.to_pylist()])
            bound = q @ centroids.T + np.sqrt((q * q).sum(axis=1))[:, None] * radius
            more = (bound * (1 + 1e-9 * np.sign(bound)) + 1e-9 >= floor[:, None]) & ~first & (radius >= 0)
            if more.any():
                hits = hits.unionByName(_scan(store, qids, q, more, k, where, qid_type))
        found.append(hits)
    if not found:
        return top_k(store.spark.createDataFrame([], f"qid {qid_type}, doc {store.read('vectors').schema['id'].dataType.simpleString()}, score double"), ["qid"], ["doc"], k)
    out = found[0]
    for hits in found[1:]:
        out = out.unionByName(hits)
    return top_k(out, ["qid"], [F.desc(F.round("score", 9)), "doc"], k)


def upsert(store: SnapshotStore, vectors: DataFrame, vec_id: str, vector: str, gone: DataFrame | None = None) -> list[int]:
    """Adds or replaces vectors and drops ids of gone (one column); the cells that were written again."""
    about = store.properties()
    new = written(_placed(vectors, vec_id, vector, about["meta"], np.array(about["centroids"])), "new")
    ids = new.select("id")
    if gone is not None:
        ids = ids.unionByName(gone.select(F.col(gone.columns[0]).alias("id")))
    ids = written(ids.distinct(), "ids")
    before = store.read("distances").join(ids, "id", "left_semi").select("cell")
    touched = sorted(r["cell"] for r in before.unionByName(new.select("cell")).distinct().collect())  # at most MOST_CELLS
    if not touched:
        return []
    kept = store.read("vectors", touched).join(ids, "id", "left_anti").join(store.read("distances", touched).select("id", "away"), "id")
    _write(store, new.unionByName(kept.select(*new.columns)), {}, touched)
    return touched


def bytes_read(store: SnapshotStore, cells: list[int]) -> int:
    """Bytes of the files of some cells."""
    parts = store.parts("vectors")
    return sum(store.files.fs.getContentSummary(store.files.path(f"{store.base}/{p}")).getLength() for c in cells for p in parts.get(str(c), []))
