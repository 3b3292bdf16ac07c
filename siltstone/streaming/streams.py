"""Structured Streaming: the stateless stages on arriving files, and windows over events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving_jsonl(spark: SparkSession, path: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    """S20 as a stream: files that come to a folder; the checkpoint remembers which were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(path)


def run_stage(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Apply a stage to each micro-batch and append its result; a batch that is run again replaces its own folder."""

    def each(df: DataFrame, batch: int) -> None:
        stage(df).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def windowed_timeline(events: DataFrame, ts: str, label: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """A09 over event time: mentions of each label in each window; later events than the watermark are dropped."""
    w = F.window(ts, window)
    return events.withWatermark(ts, late).groupBy(w, label).agg(F.count("*").alias("mentions")).select(F.col("window.start").alias("window_start"), label, "mentions")
