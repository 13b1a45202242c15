"""Splitting oversized items at natural boundaries by dynamic programming.

A piece repeats the last `overlap` characters of the one before and is at most `limit` long, so consecutive cuts are
at most limit - overlap apart. Over the boundary positions of a text, the program minimises the sum of cut penalties
(paragraph, line, sentence, clause, word, none) and of the squared deviation from equal pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Boundary kinds, the best first: a cut falls behind the match. Then the penalty of a cut there.
KINDS = (
    (re.compile(r"\n[ \t]*\n\s*"), 0.0),
    (re.compile(r"\n\s*"), 0.05),
    (re.compile(r"[.!?。！？][\"')\]»”’]*\s+"), 0.1),
    (re.compile(r"[;:,)\]]\s+"), 0.6),
    (re.compile(r"\s+"), 1.0),
)
INSIDE = 10.0
PIECE = 0.5
GRID = 32  # inside a stretch without any boundary, longer than the room, cuts fall on parts of the room


def boundaries(text: str, room: int, kinds: int = len(KINDS)) -> tuple[np.ndarray, np.ndarray]:
    """All positions where a cut of the first `kinds` kinds may fall, and their penalties; with all kinds, also a grid inside stretches without any."""
    n = len(text)
    best: dict[int, float] = {n: 0.0}
    for pattern, penalty in KINDS[:kinds]:
        for m in pattern.finditer(text):
            if 0 < m.end() < n:
                best.setdefault(m.end(), penalty)
    if kinds == len(KINDS):
        at = sorted({0, *best})
        for a, b in zip(at, at[1:], strict=False):
            if b - a > room:
                for p in range(a + max(1, room // GRID), b, max(1, room // GRID)):
                    best.setdefault(p, INSIDE)
    at = np.array(sorted(best), np.int64)
    return at, np.array([best[p] for p in at.tolist()])


def _program(n: int, limit: int, overlap: int, balance: float, at: np.ndarray, penalty: np.ndarray) -> tuple[float, list[int]]:
    """The least cost over these positions, infinite if there is no way, and its cuts."""
    room = limit - overlap
    target = (n - overlap) / -(-(n - overlap) // room)
    cost, back = np.full(len(at), np.inf), np.full(len(at), -1, np.int64)
    low = np.searchsorted(at, at - room)
    for i in range(len(at)):
        p = int(at[i])
        own = 0.0 if p == n else penalty[i]
        if p <= limit:
            cost[i] = own + PIECE + balance * ((p - overlap) / target - 1) ** 2
        a = int(low[i])
        if a < i:
            whole = cost[a:i] + own + PIECE + balance * ((p - at[a:i]) / target - 1) ** 2
            whole[at[a:i] <= overlap] = np.inf  # a piece must go on beyond the text that it repeats
            k = int(np.argmin(whole))
            if whole[k] < cost[i]:
                cost[i], back[i] = whole[k], a + k
    if not np.isfinite(cost[-1]):
        return np.inf, []
    ends, i = [], len(at) - 1
    while i >= 0:
        ends.append(int(at[i]))
        i = int(back[i])
    return float(cost[-1]), ends[::-1]


def cuts(text: str, limit: int, overlap: int, balance: float = 1.0) -> list[int]:
    """The ends of the pieces of least cost; the last is len(text).

    The program is run over the better kinds of boundaries first. A poorer kind is let in only if some way with one cut of it
    could still cost less: its penalty and the fewest pieces there can be, against the least cost so far. So what is left
    out can't be in the result, which is the least over all boundaries.
    """
    n, room = len(text), limit - overlap
    if n <= limit:
        return [n]
    fewest = PIECE * -(-(n - overlap) // room)
    best, ends = np.inf, []
    for kinds in range(3, len(KINDS) + 1):
        worst = KINDS[kinds - 1][1] if kinds > 3 else 0.0
        if fewest + worst >= best:
            break
        at, penalty = boundaries(text, room, kinds)
        best, ends = _program(n, limit, overlap, balance, at, penalty)
    return ends


def pieces(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    ends = cuts(text, limit, overlap)
    return [(0 if k == 0 else ends[k - 1] - overlap, e) for k, e in enumerate(ends)]


PIECES = "item_kind string, record_no long, section_pos int, piece_no int, pieces int, char_start int, char_end int, piece string"


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["item_kind", "record_no", "section_pos", "piece_no", "pieces", "char_start", "char_end", "piece"]
    for batch in batches:
        out = []
        for kind, record, pos, text, limit, overlap in batch.itertuples(index=False):
            spans = pieces(text, limit, overlap)
            out += [(kind, record, pos, k, len(spans), a, b, text[a:b]) for k, (a, b) in enumerate(spans)]
        yield pd.DataFrame(out, columns=columns)


def split_oversized(items: DataFrame, limits: DataFrame) -> DataFrame:
    """The ordered pieces of each item (item_kind, record_no, section_pos, text) longer than its kind's max_chars.

    limits (item_kind, max_chars, overlap_chars) has one row for each kind; an overlap of the limit or more is cut to
    half the limit, a null one is 0. Null texts and kinds without a limit are no case. Texts within the limit give no
    piece. Concatenating the first piece with the others less their first overlap_chars gives the text again.
    """
    kinds = limits.filter("max_chars > 0").select(F.col("item_kind").alias("kind"), F.col("max_chars").cast("int").alias("max_chars"), F.coalesce(F.when(F.col("overlap_chars") < F.col("max_chars"), F.greatest("overlap_chars", F.lit(0))).otherwise(F.floor(F.col("max_chars") / 2)), F.lit(0)).cast("int").alias("overlap_chars"))
    # the limits are one row for each kind of item: a table of fixed size
    over = items.join(F.broadcast(kinds), F.col("item_kind") == F.col("kind")).filter(F.length("text") > F.col("max_chars"))
    return over.select("item_kind", "record_no", "section_pos", "text", "max_chars", "overlap_chars").mapInPandas(_split, PIECES)
