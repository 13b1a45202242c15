"""Template residue, filler and error pages: character n-gram models and likelihood-ratio windows.

Four models of characters are fitted: unfilled placeholders, filler, error and access notices, and natural prose; the
first three on wordings put together by rules (seeds.py), the last on all documents. What the models find in the documents
with certainty joins the models of residue, what they doubt is left out of prose, and all are fitted again. Tasks count the
n-grams of all texts once, in tables of a fixed size; each further fit is a pass that counts only what has to leave prose
or join residue. The log-likelihood ratio of each character against prose, less a fixed cost a character, is summed along a text;
every stretch whose sum is highest above where it began is a window, whatever its length, and is residue if its sum
exceeds a threshold. Documents are excluded by the share of the text that windows cover.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm import seeds
from litloom.runtime import spread

BITS = 21
KINDS = ("placeholder", "filler", "notice")
#: What a character costs a window, by kind: without it every text would end up one window.
COST = np.array([0.3, 0.3, 0.3])
BREAK, GAP = 0, 4  # so many breaks stand between texts, so that no context reaches into another

#: Signs that open or close slots. In the first fit natural use of them is known from seeded prose only.
_SIGN = np.zeros(256, bool)
_SIGN[list(b"{}[]<>$#@_&|~^%*\\`")] = True

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("0") : ord("9") + 1] = ord("9")
_CLASS[[9, 10, 11, 12, 13, 32]] = ord(" ")


def encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as bytes with breaks before each and after the last; runs of digits are one 9, runs of blanks one blank. Also the byte each came from."""
    raw = np.frombuffer(bytes(GAP) + bytes(GAP).join(t.replace("\0", " ").encode("utf-8", "replace") for t in texts) + bytes(GAP), np.uint8)
    b = _CLASS[raw]
    again = (b[1:] == b[:-1]) & ((b[1:] == ord("9")) | (b[1:] == ord(" ")))
    at = np.flatnonzero(np.r_[True, ~again])
    return b[at], at


def _mix(v: np.ndarray, k: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (v * np.uint32(k)) >> np.uint32(32 - BITS)


def _five(four: np.ndarray, first: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix((four * np.uint32(0x85EBCA6B)) ^ (four >> np.uint32(15)) ^ (first * np.uint32(0x9E3779B1)), 0xC2B2AE35)


def _fours(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last four bytes at each byte as one number, and the byte before them."""
    x = np.r_[np.zeros(4, np.uint8), b].astype(np.uint32)
    n = len(b)
    return x[4:] | (x[3 : 3 + n] << 8) | (x[2 : 2 + n] << 16) | (x[1 : 1 + n] << 24), x[:n]


def _codes(b: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The last five bytes at the bytes marked in `where` as one number. The stream begins with breaks, which aren't marked."""
    at = np.flatnonzero(where)
    return sum((b[at - i].astype(np.int64) << (8 * i) for i in range(1, 5)), b[at].astype(np.int64))


SIZES = (5, 4, 3, 2)


def _slots(code: np.ndarray) -> dict[int, np.ndarray]:
    """Slots of the last 5 and 3 bytes, and of the 4 and 2 that come before the last."""
    low = lambda v, bits: (v & ((1 << bits) - 1)).astype(np.uint32)
    four = low(code >> 8, 32)
    with np.errstate(over="ignore"):
        context = _mix((four ^ (four >> np.uint32(13))) * np.uint32(0x27D4EB2F), 0x9E3779B1)
    return {5: _five(low(code, 32), low(code >> 32, 8)), 4: context, 3: _mix(low(code, 24), 0x9E3779B1), 2: _mix(low(code >> 8, 16) | np.uint32(1 << 30), 0x85EBCA6B)}


class CharModel:
    """Hashed counts of n-grams and their contexts."""

    def __init__(self, counts: dict[int, np.ndarray] | None = None):
        self.counts = {n: counts[n].astype(np.float32) if counts else np.zeros(1 << BITS, np.float32) for n in SIZES}

    def add(self, code: np.ndarray, n: np.ndarray | float = 1.0) -> None:
        """Count the last character of each 5-gram `n` times, each with the context before it; what is taken away again leaves no less than nothing."""
        for size, slot in _slots(code).items():
            np.add.at(self.counts[size], slot, np.float32(n) if np.isscalar(n) else n.astype(np.float32))
            np.maximum(self.counts[size], 0, out=self.counts[size])

    def score(self, slots: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of the last character after the four before it, backed off to two, and after two alone."""
        c = {n: self.counts[n][slots[n]] for n in SIZES}
        short = (c[3] + 4 / 96) / (c[2] + 4)
        return np.log((c[5] + 3 * short) / (c[4] + 3)), np.log(short)


class Ratios:
    """The log-likelihood ratios of the kinds against prose as two tables: for each 5-gram the models were fitted on, and for each 3-gram."""

    def __init__(self, models: list[CharModel], prose: CharModel, fitted_on: list[np.ndarray]):
        self.five = np.full((1 << BITS, len(models)), np.nan, np.float32)
        self.three = np.zeros((1 << BITS, len(models)), np.float32)
        for code in fitted_on:
            for i in range(0, len(code), 1 << 18):
                slots = _slots(code[i : i + (1 << 18)])
                long, short = prose.score(slots)
                for k, m in enumerate(models):
                    own, alone = m.score(slots)
                    self.five[slots[5], k] = own - long
                    self.three[slots[3], k] = alone - short

    def __getstate__(self) -> dict:
        # every pass sends them to all tasks: only the slots that are in use
        five, three = np.flatnonzero(~np.isnan(self.five[:, 0])), np.flatnonzero(self.three.any(1))
        return {"slots": (five.astype(np.int32), three.astype(np.int32)), "five": self.five[five].astype(np.float16), "three": self.three[three].astype(np.float16)}

    def __setstate__(self, state: dict) -> None:
        kinds = state["five"].shape[1]
        self.five, self.three = np.full((1 << BITS, kinds), np.nan, np.float32), np.zeros((1 << BITS, kinds), np.float32)
        self.five[state["slots"][0]], self.three[state["slots"][1]] = state["five"], state["three"]

    def __call__(self, b: np.ndarray) -> np.ndarray:
        four, first = _fours(b)
        out = self.five[_five(four, first)]
        unseen = np.flatnonzero(np.isnan(out[:, 0]))
        out[unseen] = self.three[_mix(four[unseen] & np.uint32(0xFFFFFF), 0x9E3779B1)]
        return out


def windows(b: np.ndarray, ratios: Ratios) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind (start, end, sum) of every stretch of positive sum up to its peak, none across a break."""
    value = ratios(b) - COST.astype(np.float32)
    value[b == BREAK] = -1e5
    out = []
    for v in value.T:
        # stretches of positive values and those between them take turns; a stream begins with a break
        plus = v > 0
        edge = np.flatnonzero(plus[1:] != plus[:-1]) + 1
        if not len(edge):
            out.append((edge, edge, np.zeros(0)))
            continue
        s = np.cumsum(np.add.reduceat(v, np.r_[0, edge], dtype=np.float64))
        height = s - np.minimum.accumulate(s)
        begin, end, up = edge[::2], np.r_[edge[1::2], len(b)][: -(-len(edge) // 2)], height[1::2]
        group = np.flatnonzero(np.r_[True, height[2::2][: len(up) - 1] <= 0])
        peak = np.maximum.reduceat(up, group)
        top = np.flatnonzero(up == np.repeat(peak, np.diff(np.r_[group, len(up)])))
        first = top[np.unique(np.searchsorted(group, top, side="right") - 1, return_index=True)[1]]
        out.append((begin[group], end[first], peak))
    return out


def _covered(n: int, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], least: np.ndarray, margin: int = 0) -> np.ndarray:
    """(n, kinds): which bytes lie in windows of at least this sum, or within `margin` of them."""
    out = np.zeros((len(found), n), bool)
    for own, (begin, end, peak), low in zip(out, found, least, strict=True):
        keep = peak >= low
        for x, y in zip(np.maximum(begin[keep] - margin, 0).tolist(), (end[keep] + margin).tolist(), strict=True):
            own[x:y] = True
    return out.T


def _seeded(seed: int, part: int, parts: int = 5) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, list[list[str]]]:
    """Streams and counted bytes of the three kinds, the stream of seeded prose, and the wordings left out: each `part`-th template of five (none if part < 0)."""
    rng = np.random.default_rng(seed)
    kept = lambda block: "\n".join(t for i, t in enumerate(block.strip().splitlines()) if i % parts != part)
    left = lambda block: "\n".join(t for i, t in enumerate(block.strip().splitlines()) if i % parts == part)
    slots, filler, notice = seeds.placeholders(rng, block=kept(seeds.PHRASES)), seeds.filler(rng, block=kept(seeds.FILLER)), seeds.notices(rng, block=kept(seeds.NOTICE))
    streams, marks = [], []
    b, at = encoded([t for t, _ in slots])
    raw = np.zeros(at[-1] + 1, bool)
    offset = GAP
    for t, spans in slots:
        for x, y in spans:
            raw[offset + x : min(offset + y + 2, offset + len(t))] = True
        offset += len(t) + GAP
    streams.append(b)
    marks.append(raw[at])
    for texts in (filler, notice):
        b, _ = encoded(texts)
        streams.append(b)
        marks.append(b != BREAK)
    unseen = [] if part < 0 else [[t for t, _ in seeds.placeholders(rng, 400, block=left(seeds.PHRASES), only=True)], seeds.filler(rng, 8, block=left(seeds.FILLER), rules=False), seeds.notices(rng, 8, block=left(seeds.NOTICE))]
    return streams, marks, encoded(seeds.prose(rng))[0], unseen


def _bare() -> np.ndarray:
    """The slots of words that can be a placeholder by themselves."""
    out = np.zeros(1 << BITS, bool)
    for t in seeds.PHRASES.split():
        if t.isalpha() and (t.isupper() or t in seeds.BARE):
            own = encoded([f" {t} "])[0]
            out[_five(*_fours(own))[GAP + 4 :]] = True
    return out


class Tally:
    """The n-grams of all texts: how often they occur, how often 5-grams have signs or belong to bare words, and for each slot the 5-gram that stands for it."""

    NAMES = (*map(str, SIZES), "near", "code")

    def __init__(self, of: dict[str, np.ndarray] | None = None):
        self.of = of or {n: np.zeros(1 << BITS, np.int64) for n in self.NAMES}

    def add(self, b: np.ndarray, bare: np.ndarray) -> None:
        plain = b != BREAK
        near = _SIGN[b]
        for _ in range(4):
            near = near | np.r_[False, near[:-1]]
        code = _codes(b, plain)
        slots = _slots(code)
        for n in SIZES:
            np.add.at(self.of[str(n)], slots[n], 1)
        np.add.at(self.of["near"], slots[5][near[plain] | bare[slots[5]]], 1)
        np.maximum.at(self.of["code"], slots[5], code)


Marked = tuple[np.ndarray, np.ndarray, np.ndarray]  # kind (-1: not prose), 5-gram, how often


def _marked(b: np.ndarray, ratios: Ratios, least: np.ndarray, sure: np.ndarray) -> Marked:
    """The 5-grams of bytes in or near windows of at least `least`, which leave prose, and of those in windows of at least `sure`, which join their kinds."""
    found = windows(b, ratios)
    gone, certain = (b != BREAK) & _covered(len(b), found, least, 12).any(1), _covered(len(b), found, sure)
    own = [(k, *np.unique(_codes(b, where), return_counts=True)) for k, where in [(-1, gone), *enumerate(certain.T)]]
    return np.concatenate([np.full(len(c), k, np.int32) for k, c, _ in own]), np.concatenate([c for _, c, _ in own]), np.concatenate([n for *_, n in own])


def _fitted(tally: Tally, texts: int, again: Callable[[Ratios, np.ndarray, np.ndarray], Marked], rounds: int = 5, part: int = -1, seed: int = 10, sure: tuple = (40.0, 80.0, 80.0), doubt: tuple = (6.0, 8.0, 8.0), gentle: tuple = (20.0, 25.0, 25.0), seldom: float = 0.001, balance: int = 2000) -> tuple[Ratios, list[list[str]]]:
    """The ratios after `rounds` fits, and the wordings that were left out. again: what _marked() gives for all texts.

    The first fit of prose leaves out 5-grams with signs that fewer than `seldom` of the texts have. After each fit, stretches
    of the texts with a sum of at least `sure` are counted as residue of their kind, and bytes in or near stretches of at
    least `doubt`, which rises to `gentle` with the rounds, are left out of prose. balance: all texts are counted, but weigh as
    so many where they are more, since the wordings by rules, which don't grow with the texts, would be outweighed. part: the fifth of the templates that is
    left out, to measure how well unseen wordings are found.
    """
    streams, marks, known, unseen = _seeded(seed, part)
    own, natural = [_codes(b, m & (b != BREAK)) for b, m in zip(streams, marks, strict=True)], _codes(known, known != BREAK)
    every = [np.unique(_codes(b, b != BREAK)) for b in (*streams, known)] + [tally.of["code"][tally.of["code"] > 0]]
    rare = np.flatnonzero((tally.of["5"] < max(1.5, seldom * texts)) & (tally.of["near"] > 0))
    kind, code, n = np.full(len(rare), -1), tally.of["code"][rare], tally.of["near"][rare]
    ratios, weight = None, min(1.0, balance / max(1, texts))
    for step in np.linspace(0, 1, rounds):
        if ratios is not None:
            kind, code, n = again(ratios, (1 - before) * np.array(doubt) + before * np.array(gentle), np.array(sure))  # noqa: F821
        models, prose = [CharModel() for _ in KINDS], CharModel({k: np.float32(weight) * tally.of[str(k)] for k in SIZES})
        prose.add(code[kind < 0], -weight * n[kind < 0])
        prose.add(natural)
        for k, m in enumerate(models):
            m.add(own[k])
            m.add(code[kind == k], 2.0 * weight * n[kind == k])
        ratios, before = Ratios(models, prose, every), step
        del models, prose, m  # before the next ones are made
    return ratios, unseen


def fit_on(texts: list[str], **how) -> tuple[Ratios, list[list[str]]]:
    """The ratios of residue against prose fitted on these texts, and the wordings that were left out; `how` as in _fitted()."""
    chunks = [encoded(texts[i : i + 500])[0] for i in range(0, len(texts), 500)]
    tally, bare = Tally(), _bare()
    for b in chunks:
        tally.add(b, bare)
    none = np.zeros(0, np.int64)
    joined = lambda found: tuple(np.concatenate(x) for x in zip((none, none, none), *found, strict=True))
    return _fitted(tally, len(texts), lambda *how: joined([_marked(b, *how) for b in chunks]), **how)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Texts of some CHUNK bytes as one stream, and how many they are."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        part = np.cumsum([len(t) for t in texts]) // CHUNK
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                yield b - a, encoded(texts[a:b])[0]


PIECE = 1 << 14  # slots of a table in a row


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally, bare, texts = Tally(), _bare(), 0
    for n, b in _streams(batches):
        tally.add(b, bare)
        texts += n
    if texts:
        rows = [("texts", 0, np.array([texts], np.int64).tobytes())] + [(name, i, t[i * PIECE : (i + 1) * PIECE].tobytes()) for name, t in tally.of.items() for i in range(len(t) // PIECE)]
        for i in range(0, len(rows), 64):
            yield pa.RecordBatch.from_pylist([dict(zip(("name", "piece", "n"), r, strict=True)) for r in rows[i : i + 64]], schema=pa.schema([("name", pa.string()), ("piece", pa.int32()), ("n", pa.binary())]))


def _summed(own: pd.DataFrame) -> pd.DataFrame:
    """One row of the rows that tasks have for a piece of a table: their sum, of the 5-grams that stand for slots the largest."""
    out = None
    with_max = own["name"].iloc[0] == "code"
    for x in own["n"]:
        x = np.frombuffer(x, np.int64)
        out = x if out is None else np.maximum(out, x) if with_max else out + x
    return pd.DataFrame({"name": own["name"].iloc[:1], "piece": own["piece"].iloc[:1], "n": [out.tobytes()]})


def fit(documents: DataFrame, text: str) -> Ratios:
    """The ratios of residue against prose, fitted on all documents. As many tasks as there are cores count, so that the tables they send are few."""
    rows = spread(documents.filter(F.col(text).isNotNull()).select(F.col(text).cast("string").alias("text")))
    few = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    tally, texts = Tally({n: np.zeros(1 << BITS, np.int64 if n == "code" else np.float32) for n in Tally.NAMES}), 0
    for r in few.mapInArrow(_tallied, "name string, piece int, n binary").groupBy("name", "piece").applyInPandas(_summed, "name string, piece int, n binary").toLocalIterator():
        n = np.frombuffer(bytes(r.n), np.int64)
        if r.name == "texts":
            texts = int(n[0])
        else:
            tally.of[r.name][r.piece * PIECE : (r.piece + 1) * PIECE] = n

    def again(*how) -> Marked:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, b in _streams(batches):
                kind, code, n = _marked(b, *how)
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["kind", "code", "n"])

        # as many rows as residue has different 5-grams
        found = rows.mapInArrow(run, "kind int, code long, n long").groupBy("kind", "code").agg(F.sum("n").alias("n")).toArrow()
        return tuple(found[c].to_numpy() for c in ("kind", "code", "n"))

    return _fitted(tally, texts, again)[0]


THRESHOLD = (23.0, 42.0, 42.0)
FOUND = "id long, kind string, char_start int, char_end int, score double, n_chars int"
CHUNK = 1 << 20


def located(texts: list[str], ratios: Ratios, threshold: tuple = THRESHOLD) -> list[list[tuple[str, int, int, float]]]:
    """For each text (kind, start, end, sum) of its residue, in characters. Windows of several kinds that overlap are one, of the kind with the highest sum."""
    b, at = encoded(texts)
    breaks = np.flatnonzero(b == BREAK)[GAP - 1 :: GAP]
    rows = []
    for k, (begin, end, peak) in enumerate(windows(b, ratios)):
        keep = np.flatnonzero(peak >= threshold[k])
        own = np.searchsorted(breaks, begin[keep], side="right") - 1
        first = at[breaks[own]] + 1
        rows += zip(own.tolist(), (at[begin[keep]] - first).tolist(), (at[end[keep] - 1] + 1 - first).tolist(), [KINDS[k]] * len(keep), peak[keep].round(3).tolist(), strict=True)
    out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    for i, start, stop, kind, score in sorted(rows):
        raw = texts[i].encode("utf-8", "replace")
        x = len(raw[:start].decode("utf-8", "ignore"))
        y = x + len(raw[start:stop].decode("utf-8", "ignore"))
        if out[i] and x < out[i][-1][2]:
            last = out[i][-1]
            best_kind, best_score = (kind, score) if score > last[3] else (last[0], last[3])
            out[i][-1] = (best_kind, last[1], max(y, last[2]), best_score)
        else:
            out[i].append((kind, x, y, score))
    return out


def _localise(ratios: Ratios, threshold: tuple):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            part = np.cumsum(batch["text"].str.len().to_numpy()) // CHUNK
            for _, own in batch.groupby(part):
                texts = own["text"].tolist()
                out = [(key, kind, a, z, score, len(text)) for key, text, found in zip(own["id"], texts, located(texts, ratios, threshold), strict=True) for kind, a, z, score in found]
                yield pd.DataFrame(out, columns=["id", "kind", "char_start", "char_end", "score", "n_chars"])

    return run


def residue(documents: DataFrame, key: str, text: str, threshold: tuple = THRESHOLD, ratios: Ratios | None = None) -> DataFrame:
    """(id, kind, char_start, char_end, score, n_chars): each stretch of residue in each text; the stretches of a text don't overlap.

    threshold: the least log-likelihood ratio of a placeholder, of filler and of a notice. Null and empty texts have none;
    repeated documents are told each on its own; texts are read whole, and what is found in one doesn't depend on others.
    """
    ratios = ratios or fit(documents, text)
    rows = documents.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return spread(rows).mapInPandas(_localise(ratios, tuple(threshold)), FOUND)


def coverage(found: DataFrame) -> DataFrame:
    """(id, pieces, covered, share): how much of each document is residue. Stretches with the same place, as repeated documents give them, count once."""
    once = found.dropDuplicates(["id", "char_start", "char_end"])
    return once.groupBy("id").agg(F.count("*").alias("pieces"), F.sum(F.col("char_end") - F.col("char_start")).alias("covered"), F.max("n_chars").alias("n_chars")).select("id", "pieces", "covered", (F.col("covered") / F.greatest("n_chars", F.lit(1))).alias("share"))


def excluded(documents: DataFrame, key: str, found: DataFrame, most: float = 0.0) -> DataFrame:
    """The documents without those of whose text a share above `most` is residue; at 0 any residue excludes."""
    return documents.join(coverage(found).filter(F.col("share") > most).select(F.col("id").alias(key)), key, "left_anti")
