"""Frequency of every distinct value: burst-trie counting with adaptive prefix routing.

Each worker holds one burst trie for each field. Its leaves are containers (suffix -> occurrence and record
counter) that burst into a node by next character once they outgrow `burst`. A batch of rows is first reduced by
Arrow kernels, so the trie sees each distinct value of a batch once. The containers are written out once. Routes are
ranges between terms, drawn so that each has its share of the entries: where many values begin alike, routes part further
on in the values, however long what they share is, and there are the more routes the more entries there are. All entries
of a route meet in one task in order of term, which merges the subtrees of the workers, one bounded trie at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.runtime import clean, materialize, partitions


class BurstTrie:
    """Strings with two counters. A node is a dict of children by character; a container a dict of suffixes."""

    __slots__ = ("burst", "root", "size")

    def __init__(self, burst: int = 512):
        self.burst, self.root, self.size = burst, ({}, None), 0

    # A position is a pair (container, children): children is None until the container bursts; after that the
    # container keeps only the string that ends here.
    def add(self, term: str, occurrences: int, records: int) -> None:
        at, i = self.root, 0
        holder, key = None, None
        while at[1] is not None and i < len(term):
            holder, key = at[1], term[i]
            if key not in holder:
                holder[key] = ({}, None)
            at, i = holder[key], i + 1
        suffix = term[i:]
        counts = at[0].get(suffix)
        if counts is None:
            at[0][suffix] = [occurrences, records]
            self.size += 1
            if at[1] is None and len(at[0]) > self.burst:
                self._burst(holder, key, at)
        else:
            counts[0] += occurrences
            counts[1] += records

    def _burst(self, holder: dict | None, key: str | None, at: tuple) -> None:
        children: dict[str, tuple] = {}
        for suffix, counts in at[0].items():
            if suffix:
                children.setdefault(suffix[0], ({}, None))[0][suffix[1:]] = counts
        here = ({"": at[0][""]} if "" in at[0] else {}, children)
        if holder is None:
            self.root = here
        else:
            holder[key] = here

    def containers(self) -> Iterator[tuple[str, dict]]:
        stack = [("", self.root)]
        while stack:
            prefix, (entries, children) = stack.pop()
            if entries:
                yield prefix, entries
            if children:
                stack += [(prefix + c, child) for c, child in children.items()]


ENTRY = pa.schema([("field_name", pa.string()), ("term", pa.string()), ("occurrences", pa.int64()), ("records", pa.int64())])


def _flush(field: str, trie: BurstTrie) -> Iterator[pa.RecordBatch]:
    """The trie's entries, container by container, in batches of some 20,000."""
    terms: list[str] = []
    occurrences: list[int] = []
    records: list[int] = []
    for prefix, entries in trie.containers():
        terms += [prefix + suffix for suffix in entries]
        occurrences += [c[0] for c in entries.values()]
        records += [c[1] for c in entries.values()]
        if len(terms) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array([field] * len(terms), pa.string()), pa.array(terms), pa.array(occurrences, pa.int64()), pa.array(records, pa.int64())], schema=ENTRY)
            terms, occurrences, records = [], [], []
    if terms:
        yield pa.RecordBatch.from_arrays([pa.array([field] * len(terms), pa.string()), pa.array(terms), pa.array(occurrences, pa.int64()), pa.array(records, pa.int64())], schema=ENTRY)


def _count(fields: list[str], burst: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = {f: BurstTrie(burst) for f in fields}
        for batch in batches:
            for field in fields:
                column = batch.column(batch.schema.get_field_index(field))
                flat = pa.table({"row": column.value_parent_indices() if hasattr(column, "value_parent_indices") else pa.compute.list_parent_indices(column), "term": column.flatten()})
                each = flat.group_by(["row", "term"]).aggregate([([], "count_all")])
                counts = each.group_by("term").aggregate([("count_all", "sum"), ("count_all", "count")])
                trie = tries[field]
                for term, n, rows in zip(*(counts.column(c).to_pylist() for c in ("term", "count_all_sum", "count_all_count")), strict=True):
                    if term:
                        trie.add(term, n, rows)
                if trie.size > most:  # a worker's memory stays bounded: the subtrees meet again in the merge
                    yield from _flush(field, trie)
                    tries[field] = BurstTrie(burst)
        for field, trie in tries.items():
            yield from _flush(field, trie)

    return run


def _merge(burst: int, most: int):
    """The entries come sorted: once a trie is full and the next term is another one, it has all of its terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_field, last, trie = None, None, BurstTrie(burst)
        for batch in batches:
            for field, term, n, rows in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if field != open_field or trie.size >= most and term != last:
                    if trie.size:
                        yield from _flush(open_field, trie)
                    open_field, trie = field, BurstTrie(burst)
                trie.add(term, n, rows)
                last = term
        if trie.size:
            yield from _flush(open_field, trie)

    return run


def term_counts(df: DataFrame, fields: list[str], burst: int = 512, worker_entries: int = 2_000_000, route_entries: int = 1_000_000) -> DataFrame:
    """(field_name, term, occurrences, records): each distinct value of the list columns `fields` in all rows of df.

    Values are cleaned first (white space, letter case); null lists, null elements and empty values count nothing. An
    empty table gives no rows. Other columns, whatever their names, are not read.
    """
    lists = df.select(*(F.filter(F.transform(F.coalesce(F.col(f), F.array().cast("array<string>")), clean), lambda x: x.isNotNull() & (x != "")).alias(f) for f in fields))
    entry = "field_name string, term string, occurrences long, records long"
    entries = materialize(lists.mapInArrow(_count(fields, burst, worker_entries), entry), "tries")
    routes = max(partitions(df.sparkSession), -(-entries.count() // route_entries))
    routed = entries.repartitionByRange(routes, "field_name", "term").sortWithinPartitions("field_name", "term")
    return routed.mapInArrow(_merge(burst, worker_entries), entry)


def marked(df: DataFrame, fields: list[str], rare_below: int = 3, common_share: float = 0.15, **how) -> DataFrame:
    """term_counts() with `mark`: rare (in fewer than rare_below rows), common (in more than common_share of all rows) or ''."""
    total = df.count()
    return term_counts(df, fields, **how).withColumn("mark", F.when(F.col("records") < rare_below, "rare").when(F.col("records") > F.lit(common_share) * total, "common").otherwise(""))
