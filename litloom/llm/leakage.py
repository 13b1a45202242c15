"""Evaluation texts in training text: a distributed positional inverted index.

The index has a row for each block of documents, with the documents and positions of each term in it. A test text's
windows of `width` words are anchored at their rarest terms; the offset-adjusted lists of a window's two rarest terms
are intersected block by block, and what survives is checked against the lists of all terms of the text. A block has a
bounded number of words, so matching is a pass over the index without a shuffle, and no list of a term is ever gathered
in one place. The index lies in row groups of a few blocks, so that what a task holds doesn't grow with its share of the
documents. Test texts are asked in batches of a bounded number of words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.runtime import materialize, words

INDEX = "block string, ids array<long>, terms array<string>, counts array<int>, docs array<int>, positions array<int>"
#: A row is some megabytes, so pages and row groups are looked at after each: Parquet's own check comes after 100 rows, which both the writer and the reader would hold.
LAYOUT = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
ITEM_WORDS = 1_000_000  # words of test texts that tasks hold at once
LISTED = 2_000_000  # places of anchors in a block that are sorted at once
Items = list[tuple[int, list[str]]]


def _index(most_words: int):
    schema = pa.schema([("block", pa.string()), ("ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())), ("docs", pa.list_(pa.int32())), ("positions", pa.list_(pa.int32()))])
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            lists = pa.concat_arrays([batch.column(1)])
            own = np.diff(lists.offsets.to_numpy())
            cut = np.flatnonzero(np.diff(np.cumsum(own) // most_words, prepend=0)).tolist()
            for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
                sizes = own[a:b]
                if not sizes.sum():
                    continue
                starts = np.cumsum(sizes) - sizes
                doc = np.repeat(np.arange(b - a, dtype=np.int32), sizes)  # by place in the block: a repeated key is another document
                pos = np.arange(sizes.sum(), dtype=np.int32) - np.repeat(starts, sizes).astype(np.int32)
                codes = lists.slice(a, b - a).flatten().dictionary_encode()
                ids = codes.indices.to_numpy()
                order = np.argsort(ids, kind="stable")
                counts = np.bincount(ids, minlength=len(codes.dictionary)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([f"{part}-{n}"], pa.string()), one(pa.array(batch.column(0).slice(a, b - a).to_numpy(), pa.int64())), one(codes.dictionary), one(pa.array(counts)), one(pa.array(doc[order], pa.int32())), one(pa.array(pos[order], pa.int32()))], schema=schema)
                n += 1

    return run


def build_index(documents: DataFrame, key: str, text: str, block: int = 300_000) -> DataFrame:
    """The positional index of all words of all documents; null texts have none. Each document lies in one block of some `block` words, a longer one in a block of its own."""
    rows = documents.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), words(text).alias("words"))
    return materialize(rows.mapInArrow(_index(block), INDEX), "index", options=LAYOUT)


def _blocks(batches: Iterator[pa.RecordBatch], codes: dict[str, int]) -> Iterator[tuple[np.ndarray, list[int], list[np.ndarray], list[np.ndarray]]]:
    """Of each block: the keys of its documents; for the terms asked for, their codes, and the places of the documents (ascending) and positions of each."""
    asked = pa.array(sorted(codes), pa.string())
    code_of = np.array([codes[t] for t in sorted(codes)], np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            ids, terms, counts, docs, positions = (batch.column(c)[i].values for c in range(1, 6))
            found = pc.index_in(terms, value_set=asked)
            own = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            ends = np.cumsum(counts.to_numpy())
            docs, positions = docs.to_numpy(), positions.to_numpy().astype(np.int64)
            at = code_of[found.take(pa.array(own)).to_numpy().astype(np.int64)]
            parts = [slice(ends[t] - counts[int(t)].as_py(), ends[t]) for t in own]
            yield ids.to_numpy(), at.tolist(), [docs[p] for p in parts], [positions[p] for p in parts]


def _frequency(index: DataFrame, items: Items) -> dict[str, int]:
    """How often the terms of a batch of test texts occur in all documents."""
    vocabulary = index.sparkSession.createDataFrame([(t,) for t in sorted({w for _, ws in items for w in ws})], "term string")
    each = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.counts").alias("n"))
    # a batch has at most ITEM_WORDS words, so its vocabulary is bounded
    return {r.term: r.n for r in each.join(F.broadcast(vocabulary), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _batched(items: Items) -> list[Items]:
    """The test texts in batches of at most ITEM_WORDS words, a longer text by itself."""
    out: list[Items] = [[]]
    held = 0
    for item in items:
        if out[-1] and held + len(item[1]) > ITEM_WORDS:
            out.append([])
            held = 0
        out[-1].append(item)
        held += len(item[1])
    return out


def items_of(test: DataFrame, key: str, text: str) -> Items:
    """The words of the test texts: a fixed set, held by the driver and sent to every task."""
    return [(r.id, r.words) for r in test.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), words(text).alias("words")).collect()]


def _plan(items: Items, frequency: dict[str, int], width: int) -> tuple[list[tuple[int, np.ndarray]], list[dict[tuple[int, int], bool]], dict[str, list[tuple[int, int]]]]:
    """Term codes of each item; its pairs of anchor positions; for each term its anchors (item, position)."""
    codes = {t: i for i, t in enumerate(sorted(frequency))}
    texts = [(key, np.array([codes.get(w, -1) for w in ws], np.int32)) for key, ws in items]
    pairs: list[dict[tuple[int, int], bool]] = []
    anchors: dict[str, set[tuple[int, int]]] = defaultdict(set)
    for k, (_, ws) in enumerate(items):
        own: dict[tuple[int, int], bool] = {}
        f = [frequency.get(w, 0) for w in ws]
        for s in range(len(ws) - width + 1):
            if min(f[s : s + width]) > 0:  # else no document can have the window
                one, two = sorted(sorted(range(s, s + width), key=lambda i: (f[i], i))[:2])
                own[one, two] = True
                anchors[ws[one]].add((k, one))
                anchors[ws[two]].add((k, two))
        pairs.append(own)
    return texts, pairs, {t: sorted(a) for t, a in anchors.items()}


MATCHES = "doc_id long, item_id long, item_start int, doc_start int, words int"


def _matches(texts: list, pairs: list, anchors: dict, codes: dict[str, int], width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("words", pa.int32())])

    names = {c: t for t, c in codes.items()}

    def shares(terms: list[int], docs: list[np.ndarray], n: int) -> Iterator[list[tuple[int, int, int, int, int]]]:
        """The anchors that the block has, in shares of some LISTED places: (item, position in it, number of the list, begin and end in the list). Those of an item and a document are in one share."""
        lists: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for j, t in enumerate(terms):
            for k, i in anchors.get(names[t], ()):
                lists[k].append((i, j))
        share, held = [], 0
        for k, own in lists.items():
            many = sum(len(docs[j]) for _, j in own)
            edges = np.unique(np.linspace(0, n, many // LISTED + 2).astype(np.int64)).tolist()
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                cuts = [(k, i, j, *np.searchsorted(docs[j], [low, high]).tolist()) for i, j in own]
                size = sum(y - x for *_, x, y in cuts)
                if share and held + size > LISTED:
                    yield share
                    share, held = [], 0
                share += cuts
                held += size
        if share:
            yield share

    def one(ids: np.ndarray, terms: list[int], docs: list[np.ndarray], positions: list[np.ndarray]) -> pa.RecordBatch:
        alive: list[tuple[int, int, int]] = []
        for share in shares(terms, docs, len(ids)):
            # offset-adjusted lists of the anchors: item, document, document position less item position
            key = np.concatenate([(k * (len(ids) + 1) + docs[j][x:y].astype(np.int64)) * (1 << 28) + (positions[j][x:y] - i + (1 << 24)) for k, i, j, x, y in share])
            place = np.repeat(np.array([i for _, i, *_ in share], np.int32), [y - x for *_, x, y in share])
            order = np.argsort(key, kind="stable")
            key, place = key[order], place[order]
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            for a, b in zip(edge[:-1][np.diff(edge) > 1], edge[1:][np.diff(edge) > 1], strict=True):
                met = sorted(set(place[a:b].tolist()))
                k = int(key[a] >> 28) // (len(ids) + 1)
                if any((x, y) in pairs[k] for i, x in enumerate(met) for y in met[i + 1 :]):
                    alive.append((k, int(key[a] >> 28) % (len(ids) + 1), int(key[a] & ((1 << 28) - 1)) - (1 << 24)))
        out: list[tuple] = []
        if alive:
            # the words of the documents that are left, as far as the items have them
            wanted = np.zeros(len(ids), bool)
            wanted[[d for _, d, _ in alive]] = True
            forward: dict[int, list] = defaultdict(list)
            for t, d, p in zip(terms, docs, positions, strict=True):
                keep = wanted[d]
                for x, y in zip(d[keep].tolist(), p[keep].tolist(), strict=True):
                    forward[x].append((y, t))
            arrays = {}
            for x, own in forward.items():
                arrays[x] = np.full(max(y for y, _ in own) + 1, -2, np.int32)
                for y, c in own:
                    arrays[x][y] = c
            for k, d, shift in alive:
                text, there = texts[k][1], arrays[d]
                low, high = max(0, -shift), min(len(text), len(there) - shift)
                same = np.r_[False, text[low:high] == there[low + shift : high + shift], False]
                change = np.flatnonzero(same[1:] != same[:-1])
                for a, b in zip(change[::2], change[1::2], strict=True):
                    if b - a >= width:
                        out.append((int(ids[d]), texts[k][0], low + int(a), low + int(a) + shift, int(b - a)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 5, schema, strict=True)], schema=schema)

    return lambda batches: (one(*block) for block in _blocks(batches, codes))


def phrase_matches(index: DataFrame, items: Items, width: int = 13) -> DataFrame:
    """(doc_id, item_id, item_start, doc_start, words): each maximal run of at least `width` words common to a document and a test text.

    Items shorter than `width` words have no window and match nothing; repeated documents and items are all reported.
    """
    if width < 2:
        raise ValueError("a passage has at least two words")
    out = []
    for part in _batched(items):
        frequency = _frequency(index, part)
        texts, pairs, anchors = _plan(part, frequency, width)
        codes = {t: i for i, t in enumerate(sorted(frequency))}
        out.append(index.mapInArrow(_matches(texts, pairs, anchors, codes, width), MATCHES))
    return reduce(DataFrame.unionByName, out)


def _queries(items: Items, frequency: dict[str, int], codes: dict[str, int], terms: int, share: float, span: int, width: int, sizes: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different proximity queries of all windows: item, codes of the rarest terms (one beyond the last code for none), number of terms that must be met.

    A term that no document has counts as one of the window's terms, though it can't be met.
    """
    none, seen = len(codes), {}
    for k, (_, ws) in enumerate(items):
        for length in sorted({min(len(ws), int(x)) for x in np.linspace(width, span, sizes)} - {0}):
            part = 1 - (1 - share) * max(0, length - width) / max(1, span - width)
            for s in range(len(ws) - length + 1):
                rarest = sorted(set(ws[s : s + length]), key=lambda w: (frequency.get(w, 0), w))[:terms]
                own, need = sorted(codes[w] for w in rarest if w in codes), max(1, int(np.ceil(part * len(rarest) - 1e-9)))
                if len(own) >= need:
                    seen[k, *own, *[none] * (terms - len(own)), need] = True
    table = np.array(list(seen), np.int32).reshape(-1, terms + 2)
    return table[:, 0], table[:, 1:-1], table[:, -1]


NEAR = "doc_id long, item_id long, found long"


def _near(keys: list[int], queries: tuple[np.ndarray, np.ndarray, np.ndarray], codes: dict[str, int], span: int, piece: int = 256, units: int = 512, rows: int = 2048):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("found", pa.int64())])
    owner, wanted, need = queries

    def one(ids: np.ndarray, terms: list[int], lists: list[np.ndarray], positions: list[np.ndarray]) -> pa.RecordBatch:
        best: dict[tuple[int, int], int] = {}
        if terms and len(owner):
            doc, pos = np.concatenate(lists), np.concatenate(positions)
            term = np.repeat(np.array(terms, np.int64), [len(x) for x in lists])
            # a unit is a piece of a document with the span before it: each stretch lies whole in the unit where it ends
            again = (pos + span - 1) // piece - pos // piece
            turn = np.arange(again.sum() + len(again)) - np.repeat(np.cumsum(again + 1) - again - 1, again + 1)
            doc, term, pos = (np.repeat(x, again + 1) for x in (doc, term, pos))
            part = pos // piece + turn
            inside = pos - part * piece + span - 1
            order = np.lexsort((part, doc))
            doc, term, part, inside = doc[order], term[order], part[order], inside[order]
            edge = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]), True])
            for low in range(0, len(edge) - 1, units):
                own = edge[low : low + units + 1]
                has = np.zeros((len(codes) + 1, len(own) - 1), np.uint8)
                has[term[own[0] : own[-1]], np.repeat(np.arange(len(own) - 1), np.diff(own))] = 1
                pairs = []
                for q in range(0, len(owner), rows):
                    met = np.zeros((len(owner[q : q + rows]), len(own) - 1), np.uint8)
                    for j in range(wanted.shape[1]):
                        met += has[wanted[q : q + rows, j]]
                    x, u = np.nonzero(met >= need[q : q + rows, None])
                    pairs.append(np.stack([u, x + q]))
                u, x = np.concatenate(pairs, axis=1)
                order = np.argsort(u, kind="stable")
                u, x = u[order], x[order]
                for n in np.unique(u).tolist():
                    a, b = own[n], own[n + 1]
                    local, row = np.unique(term[a:b], return_inverse=True)
                    # for each term and each end of a stretch: does the stretch have the term
                    times = np.zeros((len(local) + 1, piece + span), np.int32)
                    np.add.at(times, (row, inside[a:b] + 1), 1)
                    times = np.cumsum(times, axis=1)
                    there = (times[:, span:] > times[:, :-span]).view(np.uint8)
                    place = np.full(len(codes) + 1, len(local))
                    place[local] = np.arange(len(local))
                    mine = x[slice(*np.searchsorted(u, [n, n + 1]))]
                    for q in range(0, len(mine), rows):
                        some = mine[q : q + rows]
                        met = np.zeros((len(some), piece), np.uint8)
                        for j in range(wanted.shape[1]):
                            met += there[place[wanted[some, j]]]
                        most = met.max(axis=1)
                        for i in np.flatnonzero(most >= need[some]).tolist():
                            pair = int(ids[doc[a]]), keys[owner[some[i]]]
                            best[pair] = max(best.get(pair, 0), int(most[i]))
        out = [(*k, n) for k, n in best.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 3, schema, strict=True)], schema=schema)

    return lambda batches: (one(*block) for block in _blocks(batches, codes))


def proximity(index: DataFrame, items: Items, terms: int = 8, share: float = 0.75, span: int = 40, width: int = 13) -> DataFrame:
    """(doc_id, item_id, found): documents that have, inside one stretch of `span` words and in any order, enough of the `terms` rarest terms of some window of a test text.

    Each stretch of a test text with `width` to `span` words, in four lengths, is a window with its own rarest terms; a shorter
    text is one window. Of the terms that the window really has, `share` must be met if it has `span` words, all if it has
    `width` or fewer, and in proportion between: a short window without its one or two names is any text's wording. So each
    match of phrase_matches at `width` is a match here. `found` is the most terms met for any window.
    """
    if not 0 < terms < 256:
        raise ValueError("a window has 1 to 255 terms")
    out = []
    for part in _batched(items):
        frequency = _frequency(index, part)
        codes = {t: i for i, t in enumerate(sorted(frequency))}
        queries = _queries(part, frequency, codes, terms, share, span, min(width, span))
        out.append(index.mapInArrow(_near([k for k, _ in part], queries, codes, span), NEAR))
    # a document lies in one block, but each piece of a batch of items tells its best
    return reduce(DataFrame.unionByName, out).groupBy("doc_id", "item_id").agg(F.max("found").alias("found"))
