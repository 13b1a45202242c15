"""Near-duplicate records: universal hash minima with banding, signature verification, connected components.

Records with the same set of shingles form a class and take part once. The first `bands` x `rows` of the minima of
`hashes` universal hash functions are cut into bands; records that agree in a band are candidates. A bucket larger than
`block` is cut into blocks, and each pair of blocks is a row of its own, so no task grows with a hot bucket and no
candidate is lost. Candidates are told by their signatures; the sets decide where these come near the threshold. Components come from alternating large-star and
small-star rounds, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from litloom.runtime import drop, materialize, spread, words

_PRIME = np.uint64((1 << 61) - 1)


def _family(n: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, n, np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def shingle_rows(values: np.ndarray, inner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of `width` consecutive word hashes, and whether they lie in one text; inner: the text number of each word."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for j in range(width):
            h = (h ^ values[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h, inner[:n] == inner[width - 1 :]


def _sets(texts: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, one after the other, and where each row's begin; texts: for each row a list of lists of word hashes."""
    inner = texts.flatten()
    rows = np.repeat(np.arange(len(texts)), np.diff(texts.offsets.to_numpy()))
    values = inner.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    sizes = np.diff(inner.offsets.to_numpy())
    text_of = np.repeat(np.arange(len(inner)), sizes)
    h, whole = shingle_rows(values, text_of, width)
    h, row = h[whole], rows[text_of[: len(whole)][whole]]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[first], row[first]
    return h, np.searchsorted(row, np.arange(len(texts) + 1))


def _shingled(width: int):
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("h2", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                h, start = _sets(pa.concat_arrays([part.column(1)]), width)
                full = np.flatnonzero(np.diff(start))
                start = start[np.r_[full, len(start) - 1]]
                with np.errstate(over="ignore"):
                    prints = [np.add.reduceat((h ^ np.uint64(k)) * (h | np.uint64(1)) * np.uint64(k), start[:-1]) if len(full) else h[:0] for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(full)), *(pa.array(x.view(np.int64)) for x in prints), pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(h.view(np.int64)))], schema=schema)

    return run


def shingled(df: DataFrame, key: str, texts: Column, width: int) -> DataFrame:
    """(id, h, h2, shingles): the sorted distinct hashes of `width` consecutive words within each of the record's texts, and two hashes of the set; records without any are left out."""
    hashed = F.transform(F.filter(texts, lambda t: t.isNotNull()), lambda t: F.transform(words(t), lambda w: F.xxhash64(w)))
    rows = df.select(F.col(key).cast("long").alias("id"), hashed.alias("texts")).filter("id is not null and texts is not null")
    return spread(rows).mapInArrow(_shingled(width), "id long, h long, h2 long, shingles array<long>")


def _signed(hashes: int, bands: int, rows: int):
    schema = pa.schema([("id", pa.int64()), ("bands", pa.list_(pa.int64())), ("digest", pa.binary())])
    a, b = _family(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = pa.concat_arrays([part.column(1)])
                flat = lists.flatten().to_numpy().view(np.uint64)
                starts = (lists.offsets.to_numpy() - lists.offsets.to_numpy()[0])[:-1]
                minima = np.empty((hashes, part.num_rows), np.uint64)
                with np.errstate(over="ignore"):
                    for i in range(hashes):
                        minima[i] = np.minimum.reduceat((flat * a[i] + b[i]) >> np.uint64(16), starts)
                    keys = np.zeros((bands, part.num_rows), np.uint64)
                    for j in range(rows):
                        keys = (keys ^ minima[j : bands * rows : rows]) * np.uint64(0xBF58476D1CE4E5B9)
                        keys ^= keys >> np.uint64(31)
                    keys += np.arange(bands, dtype=np.uint64)[:, None] * np.uint64(0x94D049BB133111EB)
                half = (minima & np.uint64(15)).astype(np.uint8)
                digest = (half[::2] | (half[1::2] << 4)).T.copy()
                offsets = pa.array((np.arange(part.num_rows + 1) * bands).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, pa.array(keys.T.reshape(-1).view(np.int64))), pa.array([d.tobytes() for d in digest], pa.binary())], schema=schema)

    return run


def signatures(sets: DataFrame, hashes: int, bands: int, rows: int) -> DataFrame:
    """(id, bands, digest): a key for each band, and four bits of each minimum."""
    return sets.select("id", "shingles").mapInArrow(_signed(hashes, bands, rows), "id long, bands array<long>, digest binary")


def candidates(signed: DataFrame, block: int = 256) -> DataFrame:
    """(a, b), a < b: distinct pairs that agree in at least one band."""
    rows = signed.select("id", F.explode("bands").alias("band"))
    sized = rows.withColumn("size", F.count("*").over(Window.partitionBy("band"))).filter("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    # the window has brought each band together already: lists of about `block` members need no further shuffle
    own = sized.select("band", "id", blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("own"))
    held = materialize(own.groupBy("band", "own").agg(F.max("blocks").alias("blocks"), F.sort_array(F.collect_list("id")).alias("ids")), "buckets")
    within = held.filter(F.size("ids") > 1).select(F.posexplode("ids").alias("at", "a"), "ids").select("a", F.explode(F.slice("ids", F.col("at") + 2, F.size("ids"))).alias("b"))
    hot = held.filter("blocks > 1")
    met = hot.select("band", F.col("own").alias("i"), F.col("ids").alias("x"), F.explode(F.sequence(F.col("own") + 1, F.col("blocks"))).alias("j")).join(hot.select("band", F.col("own").alias("j"), F.col("ids").alias("y")), ["band", "j"])
    across = met.select(F.explode("x").alias("p"), "y").select("p", F.explode("y").alias("q")).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
    return within.unionByName(across).filter("a < b").distinct()


def _verified(threshold: float, hashes: int):
    """Pairs whose signatures agree as often as the threshold allows (four standard deviations below it); sure: whether they do so far above it (five and a half)."""
    spread_ = (threshold * (1 - threshold) / hashes * 16 / 15) ** 0.5
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64()), ("sure", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
            d = x ^ y
            agree = (((d & 15) == 0).sum(axis=1) + ((d >> 4) == 0).sum(axis=1)) / hashes if batch.num_rows else np.zeros(0)
            estimate = (agree - 1 / 16) * 16 / 15
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(estimate), pa.array(estimate >= threshold + 5.5 * spread_)], schema=schema)
            yield out.filter(pa.array(estimate >= threshold - 4 * spread_))

    return run


def similar_pairs(sets: DataFrame, threshold: float, hashes: int = 400, bands: int = 50, rows: int = 4, block: int = 256) -> DataFrame:
    """(a, b, similarity) for the distinct sets `sets` (id, shingles) whose Jaccard similarity is at least `threshold`.

    The similarity is exact where the signatures' estimate is within 5.5 standard deviations of the threshold, else that
    estimate, which then leaves no doubt that the pair belongs here. The result is written out.
    """
    signed = materialize(signatures(sets, hashes, bands, rows), "signatures")
    pairs = candidates(signed, block)
    x = signed.select(F.col("id").alias("a"), F.col("digest").alias("x"))
    y = signed.select(F.col("id").alias("b"), F.col("digest").alias("y"))
    told = materialize(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verified(threshold, hashes), "a long, b long, similarity double, sure boolean"), "verified")
    near = told.filter("not sure").select("a", "b")
    s = near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("s")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("t")), "b")
    both = F.size(F.array_intersect("s", "t"))
    decided = s.select("a", "b", (both / (F.size("s") + F.size("t") - both)).alias("similarity")).filter(F.col("similarity") >= threshold)
    out = materialize(told.filter("sure").select("a", "b", "similarity").unionByName(decided), "pairs")
    drop(signed, told)
    return out


def classes(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets of one record of each class of equal sets, membership (id, rep)); sets is what shingled() gives, best written out."""
    print_ = sets.select("id", "h", "h2", F.size("shingles").alias("n"))
    reps = print_.groupBy("h", "h2", "n").agg(F.min("id").alias("rep"))
    member = materialize(print_.join(reps, ["h", "h2", "n"]).select("id", "rep"), "members")
    return sets.join(member.filter("id = rep").select("id"), "id", "left_semi"), member


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of an edge (a, b) is connected with."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        # e holds (u, v) with u > v
        if large:
            out = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = out.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
            return out.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        joined = e.join(least, "u")
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())

    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while (state := mark(now)) != before:
        before = state
        last, now = now, materialize(star(star(now, True), False), "stars")
        drop(last)
    # at the fixed point every edge goes from a record straight to the smallest of its component
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def expanded(pairs: DataFrame, member: DataFrame) -> DataFrame:
    """Pairs of class representatives, and equal records, as pairs of records (a < b)."""
    x, y = member.select(F.col("id").alias("i"), F.col("rep").alias("a")), member.select(F.col("id").alias("j"), F.col("rep").alias("b"))
    between = pairs.select("a", "b").join(x, "a").join(y, "b").select("i", "j")
    within = x.join(y, (F.col("a") == F.col("b")) & (F.col("i") < F.col("j"))).select("i", "j")
    return between.unionByName(within).select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))
