"""Every knob in one place, read from the environment where it is set."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

_TRUE = {"1", "true", "yes", "y", "on"}


@dataclass(frozen=True)
class Config:
    chunk_size: int = 2048
    chunk_overlap: int = 256
    words_per_token: float = 0.75
    vector_size: int = 1024
    sink_batch: int = 500
    sink_attempts: int = 5
    sink_min_interval: float = 0.0
    shards: int = 1
    embed_batch: int = 64
    embed_token_budget: int = 24_000
    min_year: int = 2015
    min_abstract: int = 50
    only_target_types: bool = True
    need_title: bool = True
    need_abstract: bool = True
    need_pmid: bool = False
    need_open_access: bool = False
    need_commercial: bool = True
    lean_payload: bool = False
    dry_run: bool = False

    @property
    def chunk_words(self) -> int:
        return max(1, int(self.chunk_size * self.words_per_token))

    @property
    def stride_words(self) -> int:
        return max(1, self.chunk_words - min(int(self.chunk_overlap * self.words_per_token), self.chunk_words - 1))

    @classmethod
    def of(cls, env: Mapping[str, str] = os.environ, prefix: str = "LITLOOM_") -> Config:
        """Values of LITLOOM_<NAME>; one that can't be read leaves the default."""
        found = {}
        for f in fields(cls):
            raw = env.get(prefix + f.name.upper())
            if raw is not None and raw.strip():
                kind = type(f.default)
                try:
                    found[f.name] = raw.strip().lower() in _TRUE if kind is bool else kind(raw.strip())
                except ValueError:
                    continue
        return cls(**found)


def listed(c: Column) -> Column:
    """A comma-separated setting as its distinct entries, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != ""))
