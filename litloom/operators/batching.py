"""Greedy request batches: filled in order until the next text would go over the count or the token budget."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def greedy(tokens: list[int], most: int, budget: int) -> list[int]:
    """The batch number of each text."""
    out, batch, count, used = [], 0, 0, 0
    for t in tokens:
        if count and (count >= most or used + t > budget):
            batch, count, used = batch + 1, 0, 0
        out.append(batch)
        count, used = count + 1, used + t
    return out


def greedy_batches(rows: DataFrame, key: str, tokens: str, most: int = 64, budget: int = 24_000, block: int = 10_000) -> DataFrame:
    """(key, block_no, batch_no): batches within blocks of `block` successive keys, each of which is one task's work."""

    def run(part: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(part))
        held = held.sort_values(["block_no", "id"])
        held["batch_no"] = [n for _, own in held.groupby("block_no", sort=True) for n in greedy(own["t"].tolist(), most, budget)]
        yield held[["id", "block_no", "batch_no"]]

    own = rows.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.floor(F.col(key) / block).cast("long").alias("block_no"), F.coalesce(F.col(tokens), F.lit(0)).cast("long").alias("t"))
    return own.groupBy("block_no").applyInPandas(lambda pdf: next(run(iter([pdf]))), "id long, block_no long, batch_no long").withColumnRenamed("id", key)
