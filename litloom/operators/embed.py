"""Embedding as a map over Arrow batches with a pluggable provider, and the health of its routes."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from litloom.sources.writer import RateLimiter, retryable

Provider = Callable[[list[str]], list[list[float]]]


def hash_embedding(size: int = 64) -> Provider:
    """A deterministic provider without a network: signed hashes of words, scaled to length one."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = np.zeros(size)
            for w in (t or "").split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                v[h % size] += 1 if h >> 63 else -1
            out.append((v / (np.linalg.norm(v) or 1.0)).tolist())
        return out

    return embed


def asked(provider: Provider, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> Provider:
    """The provider, asked again after a growing pause where that may help: after too many requests, server errors and broken connections.

    An error may say how long to wait (retry_after, seconds). Other errors are raised at once.
    """

    def ask(texts: list[str]) -> list[list[float]]:
        for n in range(1, attempts + 1):
            try:
                return provider(texts)
            except Exception as e:
                if n == attempts or not retryable(e):
                    raise
                limited = "429" in str(e) or "too many requests" in str(e).lower()
                grow = 2.0 ** (n - 1)
                told = getattr(e, "retry_after", None)
                sleep(max(0.0, float(told)) if told is not None else min(2 * grow, 30.0) if limited else min(grow, 8.0))
        raise AssertionError

    return ask


def embedded(rows: DataFrame, text: str, vector: str, provider: Provider, batch: int = 64, attempts: int = 3) -> DataFrame:
    """rows with a vector for each text, in requests of `batch`, asked as in asked(); a request that fails for good fails the task."""
    ask = asked(provider, attempts)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found: list[list[float]] = []
            for at in range(0, len(part), batch):
                found += ask(part[text].iloc[at : at + batch].fillna("").tolist())
            yield part.assign(**{vector: found})

    from pyspark.sql import types as T

    schema = T.StructType([f for f in rows.schema.fields if f.name != vector] + [T.StructField(vector, T.ArrayType(T.FloatType()))])
    return rows.drop(vector).mapInPandas(run, schema)


@dataclass
class Routes:
    """Which key and model to ask next: the healthiest, then the preferred model, then in turn; failing ones rest."""

    models: list[str]
    rest: float = 30.0
    score: list[int] = field(default_factory=list)
    failures: list[int] = field(default_factory=list)
    until: list[float] = field(default_factory=list)
    turn: int = 0

    def __post_init__(self):
        n = len(self.models)
        self.score, self.failures, self.until = [0] * n, [0] * n, [0.0] * n

    def pick(self, now: float) -> int | None:
        awake = [i for i in range(len(self.models)) if self.until[i] <= now]
        if not awake:
            return None
        rank = {m: k for k, m in enumerate(dict.fromkeys(self.models))}
        best = min((self.score[i], rank[self.models[i]]) for i in awake)
        tied = [i for i in awake if (self.score[i], rank[self.models[i]]) == best]
        self.turn += 1
        return tied[self.turn % len(tied)]

    def succeeded(self, i: int) -> None:
        self.score[i], self.failures[i] = max(0, self.score[i] - 1), 0

    def failed(self, i: int, now: float, server: bool = False, limited: bool = False) -> None:
        self.score[i] += 2 if server else 1
        self.failures[i] = self.failures[i] + 1 if server else 0
        if limited or self.failures[i] >= 2:
            self.until[i] = now + self.rest


def routed(providers: list[Provider], models: list[str], rest: float = 30.0, per_second: int = 0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Provider:
    """One provider over several routes: each request goes to the route that Routes picks, and from a failing route to the next.

    per_second: at most so many requests in any second, 0 for no limit. Each task has its own routes and its own limit.
    """
    routes = Routes(models, rest)
    limiter = RateLimiter(per_second, 1.0, clock, sleep) if per_second else None

    def ask(texts: list[str]) -> list[list[float]]:
        error: Exception | None = None
        for _ in range(2 * len(providers)):
            i = routes.pick(clock())
            if i is None:
                sleep(max(0.0, min(routes.until) - clock()))
                i = routes.pick(clock())
            if i is None:
                break
            if limiter:
                limiter.acquire()
            try:
                found = providers[i](texts)
            except Exception as e:
                text, error = str(e).lower(), e
                if not retryable(e):
                    raise
                routes.failed(i, clock(), server=any(c in text for c in ("500", "502", "503", "504")), limited="429" in text or "too many requests" in text)
            else:
                routes.succeeded(i)
                return found
        raise error or RuntimeError("no route is awake")

    return ask
