"""Scratch space that all executors share, and text packed into blocks.

A block is one row holding a few MB of whole texts, compressed. Blocks are
written once to a table bucketed by block id, so that what other tasks find out
about a block can be joined back to it without moving the text again.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import contextmanager
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id inside the operators: it sorts before all others.
NULL_ID = -(2**63)
BLOCK_BYTES = 4 << 20
BLOCK_SCHEMA = "block long, n_docs int, n_bytes long, ids binary, lens binary, body binary"
_MADE: dict[int, list[tuple[str, str | None, str | None]]] = {}
_OWNER: list[str | None] = [None]


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset: a temporary one if Spark runs in one process, as in tests, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, what: str, table: str | None = None) -> str:
    path = f"{shared_dir(spark)}/siltstone-{uuid.uuid4().hex}/{what}"
    _MADE.setdefault(id(spark), []).append((path.rsplit("/", 1)[0], table, _OWNER[-1]))
    return path


def persist(df: DataFrame, what: str) -> DataFrame:
    """Write and read again: cuts the lineage and survives the loss of executors."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path.rsplit("/", 1)[0]
    return out


@contextmanager
def owned_by(owner: str):
    """What is made inside belongs to owner."""
    _OWNER.append(owner)
    try:
        yield
    finally:
        _OWNER.pop()


def _delete(spark: SparkSession, chosen) -> None:
    made = _MADE.get(id(spark), [])
    gone = [m for m in made if chosen(m)]
    _MADE[id(spark)] = [m for m in made if m not in gone]
    jvm = spark.sparkContext._jvm
    for path, table, _ in gone:
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(*frames: DataFrame) -> None:
    """Delete what persist() or a block table wrote; nothing may read it any more."""
    for df in frames:
        path = getattr(df, "_scratch", None)
        if path:
            _delete(df.sparkSession, lambda m: m[0] == path)  # noqa: B023


def release_owned(spark: SparkSession, owner: str) -> None:
    """Delete what belongs to owner; no frame that reads it may be needed any more."""
    _delete(spark, lambda m: m[2] == owner)


def release(spark: SparkSession) -> None:
    """Delete all scratch tables and folders made for this session; call when results are written."""
    _delete(spark, lambda m: True)


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, which else holds 10,000 whole texts. A smaller bound that is set stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    have = str(spark.conf.get(key, None) or "").lower()
    if not have or have in ("-1", "2147483647b", "67108864b", "67108864", "64m", "64mb"):
        spark.conf.set(key, str(4 << 20))


@lru_cache(maxsize=1)
def _libc():
    libc = ctypes.CDLL(None)
    return libc if hasattr(libc, "malloc_trim") else None


def trimmed(f):
    """f over batches or a table; then memory that is free goes back to the system, which a worker that waits would keep."""

    def give_back() -> None:
        pa.default_memory_pool().release_unused()
        if _libc():
            _libc().malloc_trim(0)

    @wraps(f)
    def run(data):
        if isinstance(data, pa.Table):
            out = f(data)
            give_back()
            return out
        return over(data)

    def over(batches):
        yield from f(batches)
        give_back()

    return run


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def compress(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def columns_of(batch: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    """Ids as int64 (null: NULL_ID) and texts as bytes (null: empty) of a batch with two columns."""
    ids = batch.column(0).cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
    return ids, [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]


def ids_column(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, mask=ids == NULL_ID)


def chunks(batches, block_bytes: int):
    """Ids and texts of consecutive rows, as many as fit in block_bytes, a row at least."""
    ids: list[int] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for i, t in zip(*columns_of(batch), strict=True):
            if ids and size + len(t) > block_bytes:
                yield np.array(ids, np.int64), texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t) + 16
    if ids:
        yield np.array(ids, np.int64), texts


def pack(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write docs as a table of blocks, bucketed by block, and return it."""
    spark = docs.sparkSession
    small_batches(spark)

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        for seq, (ids, texts) in enumerate(chunks(batches, block_bytes)):
            lens = np.fromiter(map(len, texts), np.int64, len(texts))
            row = (first + seq, len(ids), int(lens.sum()), ids.tobytes(), lens.tobytes(), compress(b"".join(texts)))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])

    packed = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(trimmed(run), BLOCK_SCHEMA)
    return bucketed(packed)


def bucketed(blocks: DataFrame) -> DataFrame:
    """Blocks, written to a table that is bucketed by block."""
    spark = blocks.sparkSession
    table = f"siltstone_blocks_{uuid.uuid4().hex}"
    path = scratch_path(spark, "blocks", table)
    blocks.write.bucketBy(shuffle_width(spark), "block").option("path", path).option("compression", "none").saveAsTable(table)
    out = spark.table(table)
    out._scratch = path.rsplit("/", 1)[0]
    return out


def pack_rows(docs: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks (block, n_docs, body) of whole rows of docs, all columns whatever their names; see rows_of."""
    at = docs.columns.index(text_col)
    small_batches(docs.sparkSession)

    def run(batches):
        first, seq = TaskContext.get().partitionId() << 32, 0
        for rows in steps(batches, at, block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as w:
                w.write_table(rows)
            yield pa.RecordBatch.from_arrays([pa.array([first + seq]), pa.array([rows.num_rows], pa.int32()), pa.array([compress(sink.getvalue().to_pybytes())], pa.binary())], names=["block", "n_docs", "body"])
            seq += 1

    return bucketed(docs.mapInArrow(trimmed(run), "block long, n_docs int, body binary"))


def steps(batches, at: int, step_bytes: int):
    """Tables of consecutive rows, of about step_bytes in column `at`."""
    held, size = [], 0
    for rb in batches:
        n = pc.fill_null(pc.binary_length(rb.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
        a = 0
        upto = np.cumsum(n)
        while a < rb.num_rows:
            z = max(int(np.searchsorted(upto, (upto[a - 1] if a else 0) + step_bytes - size, "right")), a + (not held))
            if z > a:
                held.append(rb.slice(a, z - a))
                size += int(n[a:z].sum())
            a = z
            if a < rb.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def rows_of(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(expand(body)).read_all()


def unpack(ids: bytes, lens: bytes, body: bytes) -> tuple[np.ndarray, list[bytes]]:
    data, at, texts = expand(body), 0, []
    for n in np.frombuffer(lens, np.int64).tolist():
        texts.append(data[at : at + n])
        at += n
    return np.frombuffer(ids, np.int64), texts


def with_replies(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """Blocks with all that was said about each: a list of structs, null if nothing. Only replies are moved."""
    said = replies.groupBy("block").agg(F.collect_list(F.struct(*[c for c in replies.columns if c != "block"])).alias("said"))
    return blocks.join(said.hint("shuffle_hash"), "block", "left")
