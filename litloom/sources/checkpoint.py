"""What a run leaves for the next one: keys done, keys dropped with stage and reason, and the high-watermark of each source."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Checkpoint:
    """Three folders of small Parquet files that only grow: each call writes its own file, so runs side by side don't meet."""

    KEYS, DEAD, MARKS = "key string", "key string, stage string, reason string", "source string, high timestamp"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _load(self, name: str, schema: str) -> DataFrame:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        there = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}/*") if there else self.spark.createDataFrame([], schema)

    def _append(self, rows: DataFrame, name: str) -> None:
        rows.write.parquet(f"{self.folder}/{name}/{uuid.uuid4().hex}")

    def done(self) -> DataFrame:
        """(key) of all that is done."""
        return self._load("done", self.KEYS).filter("trim(key) <> ''").distinct()

    def add(self, keys: DataFrame, key: str) -> None:
        """Call this after the rows of these keys are written, never before."""
        self._append(keys.select(F.trim(F.col(key)).alias("key")).filter("key <> ''").distinct(), "done")

    def dropped(self) -> DataFrame:
        """(key, stage, reason); a key that was dropped in several runs is there several times."""
        return self._load("dropped", self.DEAD)

    def log(self, dead: DataFrame) -> None:
        self._append(dead.select("key", "stage", "reason"), "dropped")

    def final(self, stages: list[str]) -> DataFrame:
        """(key) dropped at stages where trying again gives the same: these count as done."""
        return self.dropped().filter(F.col("stage").isin(stages)).select("key").distinct()

    def high(self, source: str) -> Column:
        """The latest time that a finished run has seen of a source, null before the first."""
        return F.lit(self._load("marks", self.MARKS).filter(F.col("source") == source).agg(F.max("high")).first()[0]).cast("timestamp")

    def advance(self, source: str, high: DataFrame) -> None:
        """high: one row and column, the greatest time among all rows scanned, left-out ones included. Not after a run that was cut short."""
        self._append(high.select(F.lit(source).alias("source"), F.col(high.columns[0]).cast("timestamp").alias("high")), "marks")
