"""Incremental runs with Structured Streaming: what is there is taken in micro-batches, then the query ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litloom.sources.sink import Table


def files(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Take all that is available, batch by batch, and stop; a rerun with the same checkpoint takes only what is new."""
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(each).start()
    query.awaitTermination()


def upsert_stream(stream: DataFrame, table: Table, checkpoint: str, order: str | None = None) -> None:
    """Each micro-batch replaces the rows of its ids; a repeated batch leaves the table as it is."""
    run_available(stream, checkpoint, lambda batch, _: table.upsert(batch, order))


def request_rate(events: DataFrame, when: str, window: str = "10 seconds", slide: str | None = None, late: str = "1 minute") -> DataFrame:
    """Requests by window. A timestamp without zone is read as UTC, as a watermark needs an instant."""
    rows = events.withColumn("_at", F.col(when).cast("timestamp")).withWatermark("_at", late)
    span = F.window("_at", window, slide) if slide else F.window("_at", window)
    return rows.groupBy(span).agg(F.count("*").alias("requests")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "requests")
