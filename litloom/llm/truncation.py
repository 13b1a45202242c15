"""Text cut off by field limits: logistic regression on hashed features of the closing characters.

Positives are made by cutting intact values at chosen places; the features describe how a text closes: its last
characters, words and line, what is left open, whether its last word occurs elsewhere as a whole word, and how its length
stands to the limit of its source. A bounded sample trains the model, in a second round without the values that the
first took for cut; then every record is scored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.runtime import bounded_sample, materialize, spread

DIM = 1 << 16
#: Marks that a sender puts where it has cut. Fixed values.
MARKS = ("...", "…", "[...]", "[...", "[…]", "(...)", "(more)", "(continued)", "[truncated]", "&hellip;", ">>")
MADE = ("", "", "", "", "...", "…", " ...", " [...]", "\ufffd", "\ufffd")  # what the senders of made cases put there; U+FFFD is half a character
_STRIP = ".,;:!?()[]{}<>\"'`|*#“”‘’…-–"
_NUMERAL = re.compile(r"[\W_]*[0-9][0-9.,]*[\W_]*")
_DIGITS, _LETTER = re.compile(r"[0-9]+"), re.compile(r"[^\W\d_]")
_STOPS = re.compile(r".*[.!?]\s+", re.S)


def unmarked(text: str) -> str:
    """The text without outer white space at its end and without all marks there."""
    t = text.rstrip()
    while t and (m := next((m for m in MARKS if t[-len(m) :].lower() == m), None)):
        t = t[: -len(m)].rstrip()
    return t


def last_word(text: str) -> str:
    """The last word of a text without outer punctuation, in lower case."""
    found = unmarked(text).rsplit(None, 1)
    return found[-1].strip(_STRIP).lower() if found else ""


BUCKETS = (("0", 0), ("1", 1), ("2", 2), ("5", 5), ("n", 50))  # in how many texts the last word occurs inside: names and least numbers


def bucket(known: float) -> int:
    return max(i for i, (_, least) in enumerate(BUCKETS) if known >= least)


class Closing:
    """How a text closes: what its features need, read from its end."""

    def __init__(self, text: str):
        t = unmarked(text)
        at = t.rfind("\n") + 1
        line = t[at:].strip()
        few = line.split(None, 9)  # ten pieces at most: nine words and the rest
        self.count = len(few)
        self.last = line.rsplit(None, 3)[-3:] if self.count > 3 else few[-3:]
        self.marked = len(t) < len(text.rstrip())
        self.shape = _DIGITS.sub("9", _LETTER.sub("a", t[-4:]))
        row = line.startswith("|")
        self.kind = "bullet" if self.count <= 8 and re.match(r"[-*•] ", line) and not re.search(r"[.!?] ", line) else "row" if row else "head" if line.startswith("#") else "pair" if self.count <= 8 and re.match(r"[A-Z][\w ]{2,30}: \S", line) else "prose"
        self.end = t[-1:] if not t[-1:].isalnum() else "a" if t[-1:].isalpha() else "9"
        self.number = bool(self.last and _NUMERAL.fullmatch(self.last[-1])) if self.last else False
        open_ = "".join(a for a, b in ("()", "[]") if line.count(a) > line.count(b))
        if line.count('"') % 2:
            open_ += '"'
        if re.search(r"&#?\w{0,8}$", t[-10:]):
            open_ += "&"
        tag = t[t.rfind("<") :] if "<" in t else ""
        if re.fullmatch(r"<[^<>]{0,40}", tag):
            open_ += "<"
        if re.match(r"<(\w+)>[^<]*$", tag):
            open_ += "t"
        self.open = open_
        self.cells = "-"
        if row:
            first = next((x for x in t[:at].split("\n")[:-1] if x.strip().startswith("|")), None)
            self.cells = "same" if first is None or line.count("|") == first.count("|") else "fewer"
        # the last sentence of prose: what it begins with, and how many words it has
        stop = _STOPS.match(line)
        self.sentence = line[stop.end() if stop else 0 :].split(None, 4)
        self.two = t[-2:]

    def features(self, at_limit: int) -> list[list[int]]:
        """Hashed binary features for each bucket of the last word. at_limit: 2 at the source's limit, 1 just below, 0 else."""
        kind, end, limit = self.kind, self.end, str(at_limit)
        words = [_DIGITS.sub("9", w.lower()) for w in self.last]
        own = self.sentence
        closing = _DIGITS.sub("9", (self.last[-1] if len(own) > 4 else own[-1])[-3:]) if end != "a" and own else ""
        fixed = [
            "bias", f"kind {kind}", f"end {kind} {end}", f"shape {kind} {self.shape}", f"open {self.open}", f"open {self.open} {end}", f"cells {self.cells} {end}", f"limit {limit}", f"limit {limit} {end}",
            f"marked {self.marked} {end}", f"strange {any(ord(c) > 0xFFFC or c == chr(0xFFFD) for c in self.two)}",
            f"starts {' '.join(_DIGITS.sub('9', w) for w in own[:2])} {end}" if kind == "pair" else f"number {words[-2] if self.number and len(words) > 1 else ''} {end}",
            f"short {min(len(own), 4)} {end}", f"char {self.two[:1].isdigit() if len(self.two) > 1 else False}{end} {kind}", f"break {end} {closing}",
        ]
        same = [zlib.crc32(n.encode()) & (DIM - 1) for n in fixed]
        out, done = [], {}
        for name, least in BUCKETS:
            seen = "number" if self.number else name
            key = (seen, least >= 5)
            if key not in done:
                names = [f"seen {kind} {end} {seen}", f"last {kind} {words[-1] if words else ''}" if least >= 5 else f"last {kind} {end}", f"words {kind} {min(self.count, 5) if kind in ('bullet', 'pair') else ''} {seen}", f"limit {limit} {kind} {seen}"]
                done[key] = same + [zlib.crc32(n.encode()) & (DIM - 1) for n in names]
            out.append(done[key])
        return out


def features(text: str, known: float, at_limit: int) -> list[int]:
    """Hashed binary features. known: in how many texts the last word occurs inside; at_limit: 2 at the source's limit, 1 just below, 0 else."""
    return Closing(text).features(at_limit)[bucket(known)]


def train(rows: list[list[int]], labels: np.ndarray, epochs: int = 12, rate: float = 0.25, decay: float = 1e-6, seed: int = 3) -> np.ndarray:
    """Logistic regression by AdaGrad on mini-batches of 64."""
    w, g = np.zeros(DIM), np.full(DIM, 1e-6)
    x = np.array(rows, np.int64)
    y = labels.astype(float)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
            p = 1 / (1 + np.exp(-w[x[part]].sum(axis=1).clip(-30, 30)))
            d = np.bincount(x[part].ravel(), weights=np.repeat(p - y[part], x.shape[1]), minlength=DIM)
            at = np.flatnonzero(d)
            step = d[at] + decay * w[at]
            g[at] += step**2
            w[at] -= rate * step / np.sqrt(g[at])
    return w


def cut_already(rows: list[list[int]], labels: np.ndarray, fold: np.ndarray, keep: np.ndarray, rounds: int = 3) -> np.ndarray:
    """Which of the values taken for intact a model trained on the other fold gives a fifth of a chance or more to be cut. Equal endings share a fold."""
    x, doubt = np.array(rows, np.int64), np.zeros(len(labels), bool)
    for _ in range(rounds):
        now = doubt.copy()
        for f in (0, 1):
            w = train([rows[i] for i in np.flatnonzero(keep & ~doubt & (fold != f))], labels[keep & ~doubt & (fold != f)], epochs=4)
            own = fold == f
            now[own] = (labels[own] == 0) & (w[x[own]].sum(axis=1) > -1.4)
        doubt = now
    return doubt


def limits(texts: DataFrame, source: str, text: str, peak: float = 5.0) -> dict[str | None, int]:
    """The length at which each source cuts, where its greatest lengths pile up. One number for each source."""
    lengths = texts.filter(F.col(text).isNotNull()).groupBy(source, F.length(text).alias("n")).count()
    top = lengths.groupBy(source).agg(F.max_by("n", "count").alias("mode"), F.max("count").alias("most"), F.count("*").alias("kinds"), F.sum("count").alias("all"), F.max("n").alias("longest"))
    return {r[source]: r.mode for r in top.collect() if r.most > peak * r["all"] / r.kinds and r.mode >= 0.95 * r.longest}


def _cut(text: str, u: int) -> str | None:
    """The text cut at a place drawn by u, unless it then happens to close well."""
    t = text.rstrip()
    if len(t) < 40:
        return None
    at = len(t) * 3 // 10 + u % (len(t) * 7 // 10 - 1)
    head, rest = t[:at], t[at:]
    if not head.strip() or rest[:1] == "\n" or head[-1] == "\n" or re.search(r"(?:[.!?][\"')\]]*\s*|\|)$", head) and re.match(r"\s|\||[A-Z]", rest):
        return None
    return head


def _prepared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for key, source, n, text, u in batch.itertuples(index=False):
            out.append((key, source, n, text, last_word(text), 0))
            if (cut := _cut(text, int(u) & 0x7FFFFFFF)) is not None:
                cut += MADE[(int(u) >> 32) % len(MADE)]
                out.append((key, source, n, cut, last_word(cut), 1))
        yield pd.DataFrame(out, columns=["id", "source", "n", "text", "word", "made"])


TAILS = "id long, source string, n int, text string, word string, made int"


def inner_words(texts: DataFrame, text: str) -> DataFrame:
    """(word, texts): in how many distinct texts a word occurs before the last one."""
    split = F.split(F.lower(F.col(text)), r"\s+")
    inside = F.slice(split, 1, F.greatest(F.size(split) - 1, F.lit(0)))
    each = texts.filter(F.col(text).isNotNull()).select(F.explode(F.array_distinct(F.transform(inside, lambda w: F.btrim(w, F.lit(_STRIP))))).alias("word"))
    return each.filter("word <> ''").groupBy("word").agg(F.count("*").alias("texts"))


class Model:
    def __init__(self, w: np.ndarray, limit: dict[str | None, int], heldout: float, examples: int):
        self.w, self.limit, self.heldout, self.examples = w.astype(np.float32), limit, heldout, examples

    def place(self, source: str | None, n: int) -> int:
        at = self.limit.get(source)
        return 0 if at is None or n < at - 3 or n > at + 3 else 2 if n >= at else 1

    def scores(self, text: str, source: str | None, n: int) -> list[float]:
        """The log-odds that a text was cut off, for each bucket of its last word."""
        at = np.array(Closing(text).features(self.place(source, n)))
        return self.w[at].sum(axis=1, dtype=np.float64).tolist()


def fit(texts: DataFrame, key: str, source: str, text: str, vocabulary: DataFrame, sample: int = 12_000) -> Model:
    """The model, trained on `sample` records drawn by hash and as many cut ones; a tenth is held out to measure its accuracy."""
    drawn = bounded_sample(texts.filter(F.length(F.trim(F.col(text))) > 0).select(F.col(key).cast("long").alias("id"), F.col(source).alias("source"), F.length(text).alias("n"), F.col(text).alias("text"), F.xxhash64(key, text).alias("u")), "u", sample)
    made = drawn.mapInPandas(_prepared, TAILS)
    rows = made.join(vocabulary, "word", "left").select("id", "source", "n", "text", "made", F.coalesce("texts", F.lit(0)).alias("known")).collect()
    model = Model(np.zeros(DIM), limits(texts, source, text), 0.0, len(rows))
    rows.sort(key=lambda r: (r.id, r.made))
    rng = np.random.default_rng(7)
    # a made case stands at its source's limit, just below it, or anywhere, so length alone never decides
    places = [model.place(r.source, r.n) if not r.made else int(rng.integers(0, 3)) if r.source in model.limit else 0 for r in rows]
    x = [features(r.text, r.known, p) for r, p in zip(rows, places, strict=True)]
    y = np.array([r.made for r in rows])
    if not len(y) or y.min() == y.max():
        return model
    held = rng.random(len(y)) < 0.1
    keep = ~held
    own = ~held & ~cut_already(x, y, np.array([zlib.crc32(r.text[-24:].encode()) % 2 for r in rows]), keep)
    w = train([x[i] for i in np.flatnonzero(own)], y[own])
    p = 1 / (1 + np.exp(-w[np.array(x)].sum(axis=1).clip(-30, 30)))
    made_held = held & (y == 1)
    return Model(w, model.limit, float((p[made_held] > 0.5).mean()) if made_held.any() else 0.0, int(own.sum()))


def _told(model: Model):
    """The end of a whole text decides its last word and its log-odds for each bucket; the text itself goes no further."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odds = [model.scores(t, s, n) for t, s, n in zip(batch["text"], batch["source"], batch["n"], strict=True)]
            yield pd.DataFrame({"id": batch["id"], "source": batch["source"], "n_chars": batch["n"], "word": [last_word(t) for t in batch["text"]], "odds": odds})

    return run


def scored(texts: DataFrame, key: str, source: str, text: str, sample: int = 12_000) -> DataFrame:
    """(id, source, n_chars, score) for every record with a non-blank text: the probability that it was cut off.

    Null and blank texts are not scored; repeated rows each get their score; a null source has no limit.
    """
    vocabulary = materialize(inner_words(texts, text), "words")
    model = fit(texts, key, source, text, vocabulary, sample)
    rows = texts.filter(F.length(F.trim(F.col(text))) > 0).select(F.col(key).cast("long").alias("id"), F.col(source).alias("source"), F.length(text).alias("n"), F.col(text).alias("text"))
    known = spread(rows).mapInPandas(_told(model), "id long, source string, n_chars int, word string, odds array<double>").join(vocabulary, "word", "left")
    own = F.coalesce("texts", F.lit(0))
    at = F.coalesce(*(F.when(own >= least, F.lit(i)) for i, (_, least) in reversed(list(enumerate(BUCKETS)))))
    return known.select("id", "source", "n_chars", (1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.get("odds", at)))))).alias("score"))
