"""Writing points to a service in batches: first of each id, paced, retried, with the schema until the first success."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterable, Iterator
from typing import Any, Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


class Client(Protocol):
    def write(self, columns: dict[str, list], schema: dict[str, Any] | None) -> None: ...


def retryable(error: Exception) -> bool:
    """Whether trying again may help: too many requests, conflicts, server errors, timeouts, broken connections."""
    text = f"{type(error).__name__} {error}".lower()
    return any(s in text for s in ("429", "408", "409", "500", "502", "503", "504", "too many requests", "timeout", "timed out", "connection", "ssl"))


def columns_of(rows: list[dict]) -> dict[str, list]:
    """Rows turned to columns: the union of their keys, in order, absent values null."""
    return {k: [r.get(k) for r in rows] for k in sorted({k for r in rows for k in r})}


class BatchWriter:
    def __init__(self, client: Client, schema: dict[str, Any] | None = None, batch: int = 500, attempts: int = 5, interval: float = 0.0, dry_run: bool = False, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.client, self.schema, self.batch, self.attempts, self.interval, self.dry_run = client, schema, batch, attempts, interval, dry_run
        self.sleep, self.clock, self.last, self.written = sleep, clock, None, 0
        self.seen: set = set()

    def write(self, rows: Iterable[dict], key: str = "id") -> int:
        """The number of rows written, batch by batch as they come. In a dry run all rows count and none is sent; rows with an empty id are never merged."""
        if self.dry_run:
            return sum(1 for _ in rows)
        held: list[dict] = []
        n = 0
        for r in rows:
            if r.get(key):
                if r[key] in self.seen:
                    continue
                self.seen.add(r[key])
            held.append(r)
            if len(held) == self.batch:
                self._send(columns_of(held))
                n, held = n + len(held), []
        if held:
            self._send(columns_of(held))
        n += len(held)
        self.seen.clear()
        self.written += n
        return n

    def _send(self, columns: dict[str, list]) -> None:
        if self.last is not None and self.interval > 0:
            self.sleep(max(0.0, self.last + self.interval - self.clock()))
        for n in range(1, self.attempts + 1):
            try:
                self.client.write(columns, self.schema)
                self.schema, self.last = None, self.clock()
                return
            except Exception as e:
                if "413" in str(e):
                    raise ValueError("the batch is too large for the service") from e
                if n == self.attempts or not retryable(e):
                    raise
                self.sleep(min(10.0, 2.0 ** (n - 1) + random.uniform(0, 0.5)))


def write_frame(rows: DataFrame, connect: Callable[[], BatchWriter], key: str = "id", order: str | None = None, writers: int | None = None) -> DataFrame:
    """Send rows from the executors, one writer for each partition, and return the rows written by each.

    Rows are spread by key, so equal ids meet in one writer; within it the first in order holds. The result is lazy: the
    rows are sent when it is read, and a task that is tried again sends its batches again, which an upsert absorbs.
    """
    own = rows.repartition(writers, key) if writers else rows.repartition(key)
    own = own.sortWithinPartitions(order) if order else own

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        # batches are sent as they come: of a partition only one batch and the ids are held
        n = connect().write((r for batch in batches for r in batch.to_dict("records")), key)
        yield pd.DataFrame({"written": [n]})

    return own.mapInPandas(run, "written long")


class RateLimiter:
    """At most `most` requests in any `window` seconds."""

    def __init__(self, most: int, window: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.most, self.window, self.clock, self.sleep, self.times = most, window, clock, sleep, []

    def acquire(self) -> None:
        while True:
            now = self.clock()
            self.times = [t for t in self.times if t > now - self.window]
            if len(self.times) < self.most:
                self.times.append(now)
                return
            self.sleep(self.times[0] + self.window - now)


def progress(rows: DataFrame, reason: str) -> DataFrame:
    """Counts of a run: rows, skipped by reason, share skipped."""
    total = rows.groupBy(F.coalesce(F.col(reason), F.lit("")).alias("reason")).agg(F.count("*").alias("n"))
    return total.withColumn("skipped", F.col("reason") != "")


__all__ = ["BatchWriter", "Client", "RateLimiter", "Row", "columns_of", "progress", "retryable", "write_frame"]
