"""Mixing sources to target weights by min-cost flow.

Equal texts are one class, whose sources are its membership pattern. Patterns route tokens to source quotas: the k-th
use of a pattern's texts costs (k-1) squared per token, so repetition is spread as evenly as it can be. The flow of a
pattern is a stretch of its texts laid end to end in a seeded order, as often as needed; each source takes its part
of the stretch, so a text is used by a source at most as often as that source allows.
"""

from __future__ import annotations

import base64
import os
from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from litloom.runtime import materialize

TOKENIZERS = "/opt/tokenizers"
SLOT_TEXTS = 50_000  # texts of one pattern that a window sorts at once
MOST_PATTERNS = 65_536  # patterns whose flow the driver solves; 16 sources can't have more


def _encoding(folder: str, name: str):
    import tiktoken

    # the pattern that goes with the vocabulary. Fixed value.
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    with open(os.path.join(folder, name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(spark: SparkSession, folder: str = TOKENIZERS, name: str = "byte_bpe_50k.tiktoken"):
    """A column function: the number of tokens of a text in a public vocabulary. The driver's file is sent to all executors."""
    spark.sparkContext.addFile(os.path.join(folder, name))

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        global _ENCODING
        if globals().get("_ENCODING") is None or _ENCODING.name != name:
            from pyspark import SparkFiles

            _ENCODING = _encoding(SparkFiles.getRootDirectory(), name)
        return pd.Series([len(_ENCODING.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count


class Flow:
    """Successive cheapest paths; capacities are token counts, the graph has a node for each pattern and source."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to, self.left, self.cost = [], [], []

    def edge(self, a: int, b: int, capacity: int, cost: int = 0) -> int:
        for x, y, c, w in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.left.append(c)
            self.cost.append(w)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> int:
        total = 0
        while True:
            far, by, queue, waiting = {source: 0}, {}, deque([source]), {source}
            while queue:
                x = queue.popleft()
                waiting.discard(x)
                for e in self.out[x]:
                    d = far[x] + self.cost[e]
                    if self.left[e] > 0 and d < far.get(self.to[e], 1 << 60):
                        far[self.to[e]], by[self.to[e]] = d, e
                        if self.to[e] not in waiting:
                            queue.append(self.to[e])
                            waiting.add(self.to[e])
            if sink not in far:
                return total
            path, x = [], sink
            while x != source:
                path.append(by[x])
                x = self.to[by[x] ^ 1]
            push = min(self.left[e] for e in path)
            for e in path:
                self.left[e] -= push
                self.left[e ^ 1] += push
            total += push


def route(patterns: dict[tuple[str, ...], int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[tuple[tuple[str, ...], str], int]:
    """Tokens of each pattern for each source. total: the mixture's size; by default all distinct tokens, or as many as the quotas allow."""
    sources = sorted(targets)

    def solve(size: int) -> tuple[int, dict]:
        flow = Flow(2 + len(patterns) + len(sources))
        at = {s: 2 + len(patterns) + i for i, s in enumerate(sources)}
        edges = {}
        for i, (pattern, tokens) in enumerate(sorted(patterns.items())):
            for k in range(max((targets[s][1] for s in pattern if s in targets), default=0)):
                flow.edge(0, 2 + i, tokens, k * k)
            for s in pattern:
                if s in targets:
                    edges[pattern, s] = flow.edge(2 + i, at[s], tokens * targets[s][1])
        for s in sources:
            flow.edge(at[s], 1, int(size * targets[s][0]))
        return flow.run(0, 1), {k: flow.left[e ^ 1] for k, e in edges.items()}

    wanted = lambda size: sum(int(size * targets[s][0]) for s in sources)
    size = total if total is not None else sum(patterns.values())
    got, parts = solve(size)
    if got < wanted(size):  # the largest size at which every source reaches its share
        low, high = 0, size
        while high - low > max(1, size // 100_000):
            middle = (low + high) // 2
            if solve(middle)[0] == wanted(middle):
                low = middle
            else:
                high = middle
        parts = solve(low)[1]
    return {k: v for k, v in parts.items() if v > 0}


def source_name(c: str) -> Column:
    """One spelling for each source."""
    return F.regexp_replace(F.trim(F.lower(F.col(c))), r"[\s-]+", "_")


def classes(documents: DataFrame, key: str, text: str, source: str, names: list[str], tokens) -> DataFrame:
    """(h, h2, n, pattern, tokens, docs): texts, the sources that have them, and one document for each of these."""
    rows = documents.filter(F.length(text) > 0).select(F.col(key).alias("id"), source_name(source).alias("source"), text, F.xxhash64(text).alias("h"), F.hash(text).alias("h2"), F.length(text).alias("n"))
    rows = rows.filter(F.col("source").isin(names))
    # a copied text is reduced to one row for each worker and source before the shuffle
    one = rows.groupBy("h", "h2", "n", "source").agg(F.min("id").alias("id"))
    own = one.groupBy("h", "h2", "n").agg(F.sort_array(F.collect_set("source")).alias("pattern"), F.map_from_entries(F.collect_list(F.struct("source", "id"))).alias("docs"), F.min("id").alias("id"))
    counted = rows.join(own.select("id", F.lit(True).alias("first")), "id", "left_semi").select("id", tokens(F.col(text)).alias("tokens"))
    return own.join(counted, "id").filter("tokens > 0").select(F.xxhash64("h", "h2", "n").alias("h"), "id", "pattern", "docs", "tokens")


def mixture(documents: DataFrame, targets: DataFrame, key: str, text: str, source: str, total: int | None = None, seed: int = 42, tokens=None) -> DataFrame:
    """(doc_id, source, uses, tokens): how often each chosen document is used for its source.

    targets (source, target_share, max_repeats) has one row for each source. Empty texts, and documents of no target
    source, are left out; equal texts count once, whichever documents they are in. The order of choice is a hash of the seed.
    """
    spark = documents.sparkSession
    wanted = {r.source: (float(r.target_share), int(r.max_repeats)) for r in targets.filter("target_share > 0 and max_repeats > 0").collect()}
    tokens = tokens or token_counts(spark)
    all_ = materialize(classes(documents, key, text, source, sorted(wanted), tokens), "classes")
    told = {tuple(r.pattern): (r.tokens, r.texts) for r in all_.groupBy("pattern").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("texts")).limit(MOST_PATTERNS + 1).collect()}
    if len(told) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns: merge sources")
    sizes = {p: tokens for p, (tokens, _) in told.items()}
    # slots are equal parts of the seeded order, so many that none has more than some SLOT_TEXTS texts of a pattern
    slots = max(64, -(-max((texts for _, texts in told.values()), default=0) // SLOT_TEXTS))
    placed = all_.withColumn("order", F.xxhash64(F.lit(seed), "h")).withColumn("slot", F.floor((F.shiftright("order", 32) + F.lit(1 << 31)) * F.lit(slots) / F.lit(1 << 32)).cast("int"))
    flow = route(sizes, wanted, total)
    stretches = []
    for p in sizes:
        at = 0
        for s in p:
            if part := flow.get((p, s), 0):
                stretches.append((list(p), s, at, at + part, sizes[p]))
                at += part
    # where each slot begins: sums over slots, of which a pattern has few, then within each slot
    sums = placed.groupBy("pattern", "slot").agg(F.sum("tokens").alias("own"))
    before = sums.select("pattern", "slot", (F.sum("own").over(Window.partitionBy("pattern").orderBy("slot")) - F.col("own")).alias("base"))
    parts = spark.createDataFrame(stretches, "pattern array<string>, source string, low long, high long, size long")
    line = placed.join(before, ["pattern", "slot"]).withColumn("at", F.col("base") + F.sum("tokens").over(Window.partitionBy("pattern", "slot").orderBy("order", "id")) - F.col("tokens"))
    # at most one row for each of MOST_PATTERNS patterns and each of its sources
    met = line.join(F.broadcast(parts), "pattern")
    # the copies of a text start at `at`, at + size, at + 2 size ...: how many of these lie in low <= x < high
    upto = lambda x: F.ceil(F.greatest(F.col(x) - F.col("at"), F.lit(0)) / F.col("size"))
    used = met.withColumn("uses", (upto("high") - upto("low")).cast("int")).filter("uses > 0")
    return used.select(F.element_at("docs", F.col("source")).alias("doc_id"), "source", "uses", "tokens")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """By source: the share it should have and has, its tokens, documents, and the most uses of one document."""
    own = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("tokens"), F.count("*").alias("documents"), F.max("uses").alias("most_uses"))
    total = own.agg(F.sum("tokens")).first()[0] or 1
    return targets.join(own, "source", "left").select("source", "target_share", (F.coalesce("tokens", F.lit(0)) / F.lit(total)).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats")
