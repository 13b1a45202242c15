"""Has this key been seen before? Ribbon filters over sealed batches.

Keys are hashed to 64 bits. Arrivals are cut into generations; within a shard (a range of hashes) the keys of a
generation are probed against the filters of the earlier generations, then sealed into a filter of their own. A
filter solves one banded linear system over GF(2) for each block of keys: the row of a key has `WIDTH` random bits
from a random start, its right-hand side is the key's fingerprint. A task keeps one batch of keys and the filters of
one shard; no earlier key is kept. Filters can be kept in a table (Sealed), so that a later run reads its own keys and
the filters only. Keys that are certainly absent run along and measure the rate of wrong answers: with all bits of the
fingerprints, where hardly any is to be seen, and with the lowest few, where enough are to tell whether the filters err as
often as they should. The system is solved for each bit by itself, so a filter's lowest bits are a filter too.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.runtime import WHITESPACE, materialize, partitions

WIDTH = 64
BLOCK = 2048
_U = np.uint64


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over x and a seed."""
    with np.errstate(over="ignore"):
        z = x + _U((seed * 2 + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
        return z ^ (z >> _U(31))


def _below(h: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """The upper half of h, scaled to 0..n-1."""
    return ((h >> _U(32)) * np.asarray(n).astype(np.uint64)) >> _U(32)


@dataclass
class Ribbon:
    """A sealed batch: for each block its offset, slots and seed; the solution vector."""

    keys: int
    bits: int
    offset: np.ndarray
    slots: np.ndarray
    seed: np.ndarray
    z: np.ndarray

    @staticmethod
    def _rows(keys: np.ndarray, slots: np.ndarray | int, seed: np.ndarray | int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            salted = keys ^ _mix(np.asarray(seed).astype(np.uint64), 7)
        start = _below(_mix(salted, 1), np.asarray(slots).astype(np.int64) - WIDTH + 1)
        return start.astype(np.int64), _mix(salted, 2) | _U(1), _mix(salted, 3) & _U((1 << bits) - 1)

    @classmethod
    def seal(cls, keys: np.ndarray, bits: int = 32) -> Ribbon:
        """keys: distinct uint64. A block whose system has no solution is tried again with another seed and more slots."""
        blocks = max(1, -(-len(keys) // BLOCK))
        block = _below(_mix(keys, 0), blocks).astype(np.int64)
        order = np.argsort(block, kind="stable")
        ends = np.searchsorted(block[order], np.arange(blocks), side="right")
        offset, slots, seeds, parts, at, begin = [], [], [], [], 0, 0
        for end in ends:
            own, begin = keys[order[begin:end]], end
            seed = 0
            while True:
                m = int(len(own) * (1.07 + 0.03 * seed)) + WIDTH + 8
                z = cls._solve(*cls._rows(own, m, seed, bits), m)
                if z is not None:
                    break
                seed += 1
            offset.append(at)
            slots.append(m)
            seeds.append(seed)
            parts.append(z)
            at += m
        return cls(len(keys), bits, np.array(offset, np.int64), np.array(slots, np.int64), np.array(seeds, np.int64), np.concatenate(parts).astype(np.uint8 if bits <= 8 else np.uint16 if bits <= 16 else np.uint32))

    @staticmethod
    def _solve(start: np.ndarray, coef: np.ndarray, print_: np.ndarray, m: int) -> np.ndarray | None:
        rows, right = [0] * m, [0] * m
        order = np.argsort(start, kind="stable")  # in order of start, eliminations stay short
        for i, c, b in zip(start[order].tolist(), coef[order].tolist(), print_[order].tolist(), strict=True):
            while r := rows[i]:
                c ^= r
                b ^= right[i]
                if not c:
                    break
                t = (c & -c).bit_length() - 1
                i += t
                c >>= t
            if c:
                rows[i], right[i] = c, b
            elif b:
                return None
        z = [0] * (m + WIDTH)
        for i in range(m - 1, -1, -1):
            if c := rows[i]:
                x, c, j = right[i], c >> 1, i + 1
                while c:
                    t = (c & -c).bit_length() - 1
                    j += t
                    x ^= z[j]
                    c >>= t + 1
                    j += 1
                z[i] = x
        return np.array(z[:m], np.uint32)

    def has(self, keys: np.ndarray) -> np.ndarray:
        return self.differs(keys) == 0

    def differs(self, keys: np.ndarray) -> np.ndarray:
        """The bits in which what the filter holds for a key differs from its fingerprint."""
        block = _below(_mix(keys, 0), len(self.offset)).astype(np.int64)
        start, coef, want = self._rows(keys, self.slots[block], self.seed[block], self.bits)
        at = self.offset[block] + start
        got = np.zeros(len(keys), np.uint32)
        for j in range(WIDTH):
            bit = ((coef >> _U(j)) & _U(1)).astype(np.uint32)
            got ^= self.z[at + j] * bit
        return got ^ want.astype(np.uint32)

    @property
    def size(self) -> int:
        """Bytes in memory."""
        return self.z.nbytes + self.slots.nbytes + self.offset.nbytes + self.seed.nbytes

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, head=np.array([self.keys, self.bits]), offset=self.offset, slots=self.slots, seed=self.seed, z=self.z)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Ribbon:
        with np.load(io.BytesIO(data)) as a:
            return cls(int(a["head"][0]), int(a["head"][1]), a["offset"], a["slots"], a["seed"], a["z"])


def bare(key: Column, *prefixes: str) -> Column:
    """A key without outer blanks, quotes, braces and the prefixes that name its kind, in lower case; '' becomes null."""
    outer = rf"(?:{WHITESPACE}|[\"'{{}}])"
    start = "|".join([outer, *prefixes])
    c = F.regexp_replace(F.lower(key), rf"^(?:{start})+|{outer}+$", "")
    return F.when(c != "", c)


VALUES = pa.schema([("shard", pa.int32()), ("feed", pa.string()), ("generation", pa.int32()), ("khash", pa.int64()), ("first_no", pa.int64()), ("seen", pa.bool_()), ("filter", pa.binary())])
VALUES_DDL = "shard int, feed string, generation int, khash long, first_no long, seen boolean, filter binary"
AUDIT = pa.schema([("feed", pa.string()), ("generation", pa.int32()), *((c, pa.int64()) for c in ("keys", "filter_bytes", "absent_probes", "filter_probes", "wrong_answers", "low_wrong"))])
AUDIT_DDL = "feed string, generation int, keys long, filter_bytes long, absent_probes long, filter_probes long, wrong_answers long, low_wrong long"
LOW_BITS = 10


def _batches(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of one (shard, feed, generation) at a time; the stream is sorted by these."""
    key, held = None, []
    for batch in source:
        if not batch.num_rows:
            continue
        marks = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        change = np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks])) + 1
        edges = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            own = tuple(m[a] for m in marks)
            if own != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def _generations(bits: int, audit: bool, keep: bool):
    """Probe and seal in order. Rows with a filter are filters sealed before. keep: hand on the new filters too."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, filters = None, []
        for (shard, feed, generation), rows in _batches(source):
            if (shard, feed) != of:
                of, filters = (shard, feed), []
            if "filter" in rows.column_names:
                sealed = rows.column("filter").is_valid()
                filters += [Ribbon.from_bytes(f) for f in rows.column("filter").filter(sealed).to_pylist()]
                rows = rows.filter(pc.invert(sealed))
                if not rows.num_rows:
                    continue
            keys = rows.column("khash").to_numpy().astype(np.int64).view(np.uint64)
            real = ~rows.column("absent").to_numpy(zero_copy_only=False).astype(bool)
            seen, low = np.zeros(len(keys), bool), 0
            for f in filters:
                differs = f.differs(keys)
                seen |= differs == 0
                low += int(((differs & np.uint32((1 << min(LOW_BITS, bits)) - 1)) == 0)[~real].sum()) if audit else 0
            fresh = keys[real & ~seen]
            probes, before = int((~real).sum()), len(filters)
            if len(fresh):
                filters.append(Ribbon.seal(fresh, bits))
            if audit:
                told = {"feed": feed, "generation": int(generation), "keys": int(real.sum()), "filter_bytes": filters[-1].size if len(fresh) else 0, "absent_probes": probes if before else 0, "filter_probes": probes * before, "wrong_answers": int((seen & ~real).sum()), "low_wrong": low}
                yield pa.RecordBatch.from_pylist([told], schema=AUDIT)
                continue
            again = np.flatnonzero(real & (seen | (rows.column("rows").to_numpy() > 1)))
            if len(again):
                out = rows.take(pa.array(again))
                n = len(again)
                yield pa.RecordBatch.from_arrays([pa.array([shard] * n, pa.int32()), *(out.column(c).combine_chunks() for c in ("feed", "generation", "khash", "first_no")), pa.array(seen[again]), pa.nulls(n, pa.binary())], schema=VALUES)
            if keep and len(fresh):
                yield pa.RecordBatch.from_pylist([{"shard": int(shard), "feed": feed, "generation": int(generation), "filter": filters[-1].to_bytes()}], schema=VALUES)

    return run


GENERATION_KEYS = 2_000_000  # arrivals that one task holds at once, at most, if hashes and numbers are spread evenly


def _keyed(arrivals: DataFrame, generations: int) -> tuple[DataFrame, list[str], int]:
    """arrivals (feed, number, key; number null: before all) with the key's hash and its generation, by equal ranges of number; and how many generations, more than asked for if there are many arrivals."""
    edges = {r.feed: (r.low, r.high, r.n) for r in arrivals.groupBy("feed").agg(F.min("number").alias("low"), F.max("number").alias("high"), F.count("*").alias("n")).collect()}
    most = max((n for _, _, n in edges.values()), default=0)
    generations = max(generations, -(-most // (GENERATION_KEYS * partitions(arrivals.sparkSession))))
    generation = F.lit(0)
    for feed, (low, high, _) in edges.items():
        if low is not None:
            generation = F.when((F.col("feed") == feed) & F.col("number").isNotNull(), F.lit(1) + F.floor((F.col("number") - low) * generations / (high - low + 1)).cast("int")).otherwise(generation)
    return arrivals.filter(F.col("key").isNotNull()).select("feed", "number", F.xxhash64("feed", "key").alias("khash"), generation.cast("int").alias("generation")), sorted(edges), generations


def _distinct(keyed: DataFrame, shards: int) -> DataFrame:
    """One row for each key of a generation, with its shard."""
    own = keyed.groupBy("feed", "generation", "khash").agg(F.min("number").alias("first_no"), F.count("*").alias("rows"))
    return own.select(F.pmod("khash", F.lit(shards)).cast("int").alias("shard"), "feed", "generation", "khash", "first_no", "rows", F.lit(False).alias("absent"))


def _ordered(sharded: DataFrame, shards: int) -> DataFrame:
    return sharded.repartition(shards, "shard").sortWithinPartitions("shard", "feed", "generation")


def _again(keyed: DataFrame, told: DataFrame) -> DataFrame:
    """The arrivals of keys that were seen in an earlier generation, or earlier in their own."""
    told = told.select(F.col("feed").alias("f"), F.col("khash").alias("k"), F.col("generation").alias("g"), F.col("first_no").alias("first"), "seen")
    rows = keyed.filter(F.col("number").isNotNull())
    return rows.join(told, (F.col("feed") == F.col("f")) & (F.col("khash") == F.col("k")) & (F.col("generation") == F.col("g")) & (F.col("seen") | (F.col("number") > F.col("first")))).select("feed", "number")


def seen_before(arrivals: DataFrame, generations: int = 8, bits: int = 32) -> DataFrame:
    """(feed, number) of each arrival whose key occurred before: at a smaller number of its feed, or with number null.

    Null keys are no case; arrivals that tie in number with the first one are not counted as later. A key that holds
    much of the rows is reduced before the shuffle to one row for each worker and generation.
    """
    keyed, _, _ = _keyed(arrivals, generations)
    n = partitions(keyed.sparkSession)
    return _again(keyed, _ordered(_distinct(keyed, n), n).mapInArrow(_generations(bits, False, False), VALUES_DDL))


def wrong_rate(arrivals: DataFrame, generations: int = 8, bits: int = 32, audit_keys: int = 20_000) -> DataFrame:
    """By feed, how often the filters wrongly say yes to certainly absent keys.

    keys, filter_bytes: distinct keys by generation and the memory of all filters; absent_probes, wrong_answers, wrong_rate: as
    measured with all bits; wrong_rate_below: what the true rate is below with 95 % confidence; expected_rate: filters asked for
    each key x 2^-bits; low_wrong, low_expected: wrong answers of the filters' lowest 10 bits, and how many there should be.
    """
    keyed, feeds, generations = _keyed(arrivals, generations)
    spark = keyed.sparkSession
    n, audit_keys = partitions(spark), max(audit_keys, 1)
    # no key contains U+0001
    drawn = spark.range(audit_keys if feeds else 0).select(F.concat(F.lit("\x01absent:"), F.col("id").cast("string")).alias("key"), F.explode(F.array(*map(F.lit, feeds or [""]))).alias("feed"))
    each = drawn.select(F.xxhash64("feed", "key").alias("khash"), "feed", F.explode(F.sequence(F.lit(0), F.lit(generations))).alias("generation"))
    absent = each.select(F.pmod("khash", F.lit(n)).cast("int").alias("shard"), "feed", "generation", "khash", F.lit(None).cast("long").alias("first_no"), F.lit(0).cast("long").alias("rows"), F.lit(True).alias("absent"))
    told = _ordered(_distinct(keyed, n).unionByName(absent), n).mapInArrow(_generations(bits, True, False), AUDIT_DDL)
    sums = told.groupBy("feed").agg(*(F.sum(c).alias(c) for c in ("keys", "filter_bytes", "absent_probes", "filter_probes", "wrong_answers", "low_wrong")))
    probes, wrong = F.greatest("absent_probes", F.lit(1)), F.col("wrong_answers")
    low = min(LOW_BITS, bits)
    return sums.select(
        "feed", "keys", "filter_bytes", "absent_probes", "wrong_answers", (wrong / probes).alias("wrong_rate"), ((wrong + 2 * F.sqrt(wrong) + 3) / probes).alias("wrong_rate_below"),
        (F.col("filter_probes") / probes / float(2**bits)).alias("expected_rate"), "low_wrong", (F.col("filter_probes") / float(2**low)).alias("low_expected"),
    )


class Sealed:
    """Filters kept in a table of the shared folder: (shard, feed, generation, filter), a folder for each generation.

    Each call of arrive() is one generation: its keys are probed against all filters, then sealed. Earlier keys are not
    read again. The number of shards is that of the first call.
    """

    def __init__(self, spark, folder: str, shards: int | None = None, bits: int = 32):
        self.spark, self.folder, self.bits = spark, folder.rstrip("/"), bits
        self.generation, self.shards = 0, shards or partitions(spark)
        kept = self._filters()
        if kept is not None:
            last = kept.agg(F.max("generation").alias("g"), F.max("shards").alias("n")).first()
            self.generation, self.shards = (last.g or 0), (last.n or self.shards)

    def _filters(self) -> DataFrame | None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        there = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)
        return self.spark.read.parquet(self.folder) if there else None

    def arrive(self, rows: DataFrame) -> DataFrame:
        """(feed, number) of the rows (feed, number, key) whose key came in an earlier call, or at a smaller number of this one.

        A generation that was written half is overwritten when the call is made again: the new filters are written last, in
        one job, and count from then on.
        """
        now = self.generation + 1
        keyed = rows.filter(F.col("key").isNotNull()).select("feed", "number", F.xxhash64("feed", "key").alias("khash"), F.lit(now).alias("generation"))
        own = _distinct(keyed, self.shards).withColumn("filter", F.lit(None).cast("binary"))
        kept = self._filters()
        if kept is not None:
            touched = own.select("shard", "feed").distinct()
            before = kept.filter(F.col("generation") < now).join(touched, ["shard", "feed"], "left_semi")
            own = own.unionByName(before.select("shard", "feed", "generation", "filter"), allowMissingColumns=True).withColumn("absent", F.coalesce("absent", F.lit(False)))
        told = materialize(_ordered(own, self.shards).mapInArrow(_generations(self.bits, False, True), VALUES_DDL), "arrivals")
        new = told.filter("filter is not null").select("shard", "feed", "generation", "filter", F.lit(self.shards).alias("shards"))
        new.write.mode("overwrite").parquet(f"{self.folder}/generation_dir={now:08d}")
        self.generation = now
        return _again(keyed, told.filter("filter is null"))
