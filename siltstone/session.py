"""A Spark session with the settings that the engine is written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "2m",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """On a cluster leave master unset and size shuffle partitions there; AQE joins small ones."""
    b = SparkSession.builder.appName("siltstone")
    if master:
        b = b.master(master)
    for k, v in (SETTINGS | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES_BEFORE = "spark.siltstone.maxBytesPerBatch.before"  # empty: the session had none


def bound_batches(spark: SparkSession, on: bool) -> None:
    """Batches to Python workers of 2 MB at most in a session that was made elsewhere, as rows may be large texts; off: as the session had it, or has set it since."""
    now, before = spark.conf.get(BATCH_BYTES, None), spark.conf.get(BATCH_BYTES_BEFORE, None)
    if on and now != SETTINGS[BATCH_BYTES]:
        spark.conf.set(BATCH_BYTES_BEFORE, now or "")
        spark.conf.set(BATCH_BYTES, SETTINGS[BATCH_BYTES])
    elif not on and before is not None:
        spark.conf.unset(BATCH_BYTES_BEFORE)
        if now == SETTINGS[BATCH_BYTES]:
            spark.conf.set(BATCH_BYTES, before) if before else spark.conf.unset(BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset: a temporary one if Spark runs in one process, as in tests, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


_WRITTEN: dict[int, list[str]] = {}


def written(df: DataFrame, what: str) -> DataFrame:
    """df, written to the shared folder and read again: several readers, one computation, which survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/siltstone-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{what}")
    _WRITTEN.setdefault(id(spark), []).append(path)
    return spark.read.schema(df.schema).parquet(f"{path}/{what}")


def spread(df: DataFrame) -> DataFrame:
    """df dealt out evenly to as many tasks as a shuffle has, for work that is costly by the row: a small file, such as a table of short columns, is else read by one task, which then does all of it."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def release_written(spark: SparkSession) -> None:
    """Delete what written() has left; call when no result that reads it is needed any more."""
    for path in _WRITTEN.pop(id(spark), []):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
