"""Schemas that drift between files: similarity flooding between the schema graphs of consecutive files.

Each task reduces its records to one row for each file and field: type counts and bounded sketches of the values, their
words and their shapes. A feed's files are then compared one after the other: all pairs of fields that may correspond
start with a similarity of content and name; scores flow along equal edges (nesting, type) of the two graphs until they
settle; among fields that only one file has, the best consistent pairs whose settled score is enough are renames. The
changes give each file a map of its names to those of one table, into which all records are cast.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litloom.runtime import spread

KEEP = 256  # hashes kept in a sketch
WORD, LETTERS, DIGITS = re.compile(r"\w+"), re.compile(r"[^\W\d_]+"), re.compile(r"[0-9]+")
FIELDS = 20_000  # fields whose sketches a task holds at once
SUMMARY = "feed string, file_no int, path string, kind string, n long, values_ array<long>, words array<long>, shapes array<long>, low double, high double, word_count long"


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


class _Field:
    """What one task has seen of a field of a file: distinct values, words and shapes, reduced to bounded sketches whenever there are many."""

    __slots__ = ("high", "low", "n", "raw", "sketches", "word_count")

    def __init__(self):
        self.n, self.word_count, self.low, self.high = 0, 0, float("inf"), float("-inf")
        self.raw: tuple[dict[str, int], set[str], set[str]] = ({}, set(), set())  # values with their numbers of words, words, shapes
        self.sketches: list[list[int]] = [[], [], []]

    def see(self, value) -> None:
        self.n += 1
        values, words, shapes = self.raw
        if isinstance(value, str):
            count = values.get(value)
            if count is None:
                found = WORD.findall(value.lower())
                count = values[value] = len(found)
                words.update(found)
                shapes.add(DIGITS.sub("9", LETTERS.sub("a", value)))
            self.word_count += count
        elif isinstance(value, bool):
            values[str(value)] = 0
        elif isinstance(value, (int, float)):
            self.low, self.high = min(self.low, value), max(self.high, value)
            values[repr(value)] = 0
        elif isinstance(value, dict):
            values.update((f"{k}:{v}", 0) for k, v in value.items())
            words.update(value)
        if len(values) + len(words) + len(shapes) > 32 * KEEP:
            self.reduce()

    def reduce(self) -> list[list[int]]:
        for i, raw in enumerate(self.raw):
            if raw:
                self.sketches[i] = heapq.nsmallest(KEEP, {*self.sketches[i], *map(_hash, raw)})
                raw.clear()
        return self.sketches


_KINDS = {bool: "boolean", int: "number", float: "number", str: "string", dict: "object", list: "list"}  # what JSON gives


def _kind(value) -> str:
    return _KINDS[type(value)]


def _observe(seen: dict, path: tuple, value, nested: bool) -> None:
    """Count a non-null value; '' as the kind stands for a list that says nothing of its type."""
    if isinstance(value, list):
        elements = [e for e in value if e is not None]
        if not elements:
            seen[(*path, "")].n += 1
        for e in elements:
            seen[(*path, "list of " + _kind(e))].see(e)
            if nested and isinstance(e, dict):
                for k, v in e.items():
                    if v is not None:
                        _observe(seen, (*path[:2], f"{path[2]}[].{k}"), v, False)
    else:
        seen[(*path, _kind(value))].see(value)


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: dict[tuple, _Field] = defaultdict(_Field)
    for batch in batches:
        for feed, file_no, payload in batch.itertuples(index=False):
            try:
                record = json.loads(payload)
            except ValueError:
                continue
            if isinstance(record, dict):
                for k, v in record.items():
                    if v is not None:
                        _observe(seen, (feed, file_no, k), v, True)
        if len(seen) > FIELDS:
            yield _rows(seen)
            seen.clear()
    yield _rows(seen)


def _rows(seen: dict[tuple, _Field]) -> pd.DataFrame:
    rows = [(*k, f.n, *f.reduce(), *((f.low, f.high) if f.low <= f.high else (None, None)), f.word_count) for k, f in seen.items()]
    return pd.DataFrame(rows, columns=["feed", "file_no", "path", "kind", "n", "values_", "words", "shapes", "low", "high", "word_count"])


def _overlap(a: list, b: list) -> float:
    """Jaccard similarity estimated from two bottom-k sketches."""
    if not a or not b:
        return 0.0
    lowest = set(sorted({*a, *b})[:KEEP])
    return len(lowest & {*a} & {*b}) / len(lowest)


def _name_words(name: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.rpartition("[].")[2]).lower()) if w]


def name_similarity(a: str, b: str) -> float:
    """The best of: shared words, shared letter triples, one the initials of the other's words."""
    x, y = _name_words(a), _name_words(b)
    grams = lambda ws: {g for w in ["".join(ws)] for g in (w[i : i + 3] for i in range(max(1, len(w) - 2)))}
    p, q = grams(x), grams(y)
    stem = {w.rstrip("s") for w in x}, {w.rstrip("s") for w in y}
    initials = lambda one, many: len(one) == 1 and len(one[0]) > 1 and one[0] in "".join(w[0] for w in many)
    return max(2 * len(stem[0] & stem[1]) / max(1, len(stem[0]) + len(stem[1])), len(p & q) / max(1, len(p | q)), 0.9 if initials(x, y) or initials(y, x) else 0.0)


def content_similarity(a: dict, b: dict, name: float, nested: bool) -> float:
    """How much the contents of two fields of one type look alike, 0 without real evidence."""
    kind = a["kind"].removeprefix("list of ")
    if kind == "boolean":
        return max(0.5, name)
    values, words, shapes = (_overlap(a[c], b[c]) for c in ("values_", "words", "shapes"))
    if kind == "number":
        # counts from 1 upwards all look alike: only a range away from zero, or the name, tells
        tells = name >= 0.3 or min(a["low"], b["low"]) > 0.5 * max(a["high"], b["high"])
        ranges = max(0.0, min(a["high"], b["high"]) - max(a["low"], b["low"])) / max(1e-9, max(a["high"], b["high"]) - min(a["low"], b["low"]))
        return max(values, 0.8 * ranges) if tells else 0.0
    if kind == "object":
        return max(words, values)
    prose = min(a["word_count"] / max(1, a["n"]), b["word_count"] / max(1, b["n"])) > 5
    if prose and not nested and name < 0.3:
        return 0.2 * words  # sentences share their words whatever they say
    single = max(a["word_count"] / max(1, a["n"]), b["word_count"] / max(1, b["n"])) <= 1.2
    return max(values, 0.9 * words, (0.8 if single or nested else 0.4) * shapes)


def _leaf(path: str) -> str:
    return path.rpartition("[].")[2]


def _level(schema: dict[str, dict], under: str) -> set[str]:
    """The top-level paths, or those of the members of a list."""
    return {p for p in schema if (p.startswith(f"{under}[].") if under else "[]." not in p)}


def _pairs(a: set[str], b: set[str]) -> list[tuple[str, str]]:
    """The pairs that may correspond: those of equal names, and of what only one side has each with each."""
    own, then = {_leaf(p): p for p in a}, {_leaf(q): q for q in b}
    return [(own[x], then[x]) for x in sorted(own.keys() & then.keys())] + [(own[x], then[y]) for x in sorted(own.keys() - then.keys()) for y in sorted(then.keys() - own.keys())]


# What of a pair's score comes from the pairs of its members, from the pair it is a member of, and from all pairs of its types.
FROM_MEMBERS, FROM_PARENT, FROM_TYPE = 0.4, 0.08, 0.05
ENOUGH = FROM_PARENT + FROM_TYPE  # the settled score of a correspondence: more than a pair without likeness of its own or in its members can get


def flood(old: dict[str, dict], new: dict[str, dict], tops: list[tuple[str, str]], rounds: int = 100, settled: float = 1e-5) -> dict[tuple[str, str], float]:
    """Similarity flooding over the pairs `tops` and the pairs of their members; settled scores from 0 to 1.

    Nodes are pairs of fields and pairs of types, edges nesting and type. A pair starts with the likeness of its contents and
    names; in each round it takes parts of its score from its neighbours: of its members' pairs the best for each member, over
    the larger number of members, so that unlike lists lose by all that has no partner. The shares add up to less than one,
    so the scores settle.
    """
    pairs, members = list(tops), {}
    for i, (p, q) in enumerate(tops):
        if old[p]["kind"] == new[q]["kind"] == "list of object":
            a, b = _level(old, p), _level(new, q)
            below = _pairs(a, b)
            members[i] = (np.arange(len(pairs), len(pairs) + len(below)), [x for x, _ in below], max(len(a), len(b), 1))
            pairs += below
    if not pairs:
        return {}
    start, kinds = np.zeros(len(pairs)), []
    for i, (p, q) in enumerate(pairs):
        x, y = old[p], new[q]
        kinds.append((x["kind"], y["kind"]))
        if x["kind"] == y["kind"] != "":
            name = 1.0 if _leaf(p) == _leaf(q) else name_similarity(p, q)
            content = content_similarity(x, y, name, "[]." in p)
            start[i] = 0.75 * content + (0.25 * name if content > 0 else 0.0)
    types = {k: i for i, k in enumerate(dict.fromkeys(kinds))}
    of_type = np.array([types[k] for k in kinds])
    equal = np.array([k[0] == k[1] for k in types])
    many = np.bincount(of_type, minlength=len(types))
    parent = np.full(len(pairs), -1)
    for i, (below, _, _) in members.items():
        parent[below] = i
    inside = parent >= 0
    own = 1.0 - FROM_TYPE - FROM_PARENT * inside
    own[list(members)] -= FROM_MEMBERS
    score = start
    for _ in range(rounds):
        flow = FROM_TYPE * (np.bincount(of_type, weights=score, minlength=len(types)) / many * equal)[of_type]
        flow[inside] += FROM_PARENT * score[parent[inside]]
        for i, (below, left, size) in members.items():
            best: dict[str, float] = {}
            for j, x in zip(below, left, strict=True):
                best[x] = max(best.get(x, 0.0), score[j])
            flow[i] += FROM_MEMBERS * sum(best.values()) / size
        before, score = score, own * start + flow
        if np.abs(score - before).max() < settled:
            break
    return dict(zip(pairs, score.tolist(), strict=True))


def renames(score: dict[tuple[str, str], float], old: dict[str, dict], new: dict[str, dict], gone: list[str], come: list[str], alike: float = 0.0) -> list[tuple[str, str]]:
    """Consistent correspondences between `gone` and `come`: of the pairs of one type whose settled score is enough, the best first, each field once.

    alike: what the names, values or words of a pair must have in common besides.
    """
    out: list[tuple[str, str]] = []
    left, right = set(gone), set(come)
    for a, b in sorted(((a, b) for a in gone for b in come), key=lambda p: (-score.get(p, 0.0), p)):
        if score.get((a, b), 0.0) < ENOUGH:
            break
        if a in left and b in right and old[a]["kind"] == new[b]["kind"] and (not alike or max(name_similarity(a, b), *(_overlap(old[a][c], new[b][c]) for c in ("values_", "words"))) >= alike):
            left.remove(a)
            right.remove(b)
            out.append((a, b))
    return out


def compare(old: dict[str, dict], new: dict[str, dict]) -> list[tuple[str, str, str]]:
    """(change, old_field, new_field) between two schemas {path: summary}."""
    a, b = _level(old, ""), _level(new, "")
    score = flood(old, new, _pairs(a, b))
    differ = lambda x, y: x["kind"] != y["kind"] and x["kind"] and y["kind"]

    def changed(a: set[str], b: set[str]) -> tuple[list[tuple[str, str, str]], list[tuple[str, str]]]:
        own, then = {_leaf(p): p for p in a}, {_leaf(q): q for q in b}
        lost, got = sorted(own[x] for x in own.keys() - then.keys()), sorted(then[x] for x in then.keys() - own.keys())
        moved = renames(score, old, new, lost, got)
        out = [("renamed", p, q) for p, q in moved]
        out += [("removed", p, "") for p in lost if p not in {x for x, _ in moved}]
        out += [("added", "", q) for q in got if q not in {y for _, y in moved}]
        kept = [(own[x], then[x]) for x in sorted(own.keys() & then.keys())]
        out += [("retyped", q, q) for p, q in kept if differ(old[p], new[q])]
        return out, kept + moved

    out, same = changed(a, b)
    for p, q in same:
        if old[p]["kind"] == new[q]["kind"] == "list of object":
            out += changed(_level(old, p), _level(new, q))[0]
    return out


def _schemas(rows: pd.DataFrame) -> dict[int, dict[str, dict]]:
    """{file_no: {path: summary}}: the parts of all tasks together; the most frequent kind of a path holds."""
    out: dict[int, dict[str, dict]] = {}
    for file_no, own in rows.groupby("file_no"):
        schema: dict[str, dict] = {}
        for path, parts in own.groupby("path"):
            counts = parts[parts["kind"] != ""].groupby("kind")["n"].sum()
            kinds = sorted(counts.index)
            kind = "" if counts.empty else min(counts.index, key=lambda k: (-counts[k], k))
            parts = parts[parts["kind"] == kind]
            sketch = {c: sorted({h for x in parts[c] for h in x})[:KEEP] for c in ("values_", "words", "shapes")}
            schema[path] = sketch | {"kind": kind, "kinds": kinds, "n": int(parts["n"].sum()), "low": parts["low"].min(), "high": parts["high"].max(), "word_count": int(parts["word_count"].sum())}
        out[int(file_no)] = schema
    return out


CHANGES = "feed string, file_no int, change string, old_field string, new_field string"


def _changes(rows: pd.DataFrame) -> pd.DataFrame:
    schemas = _schemas(rows)
    out = [(rows["feed"].iloc[0], n, *c) for n in sorted(schemas) if n - 1 in schemas for c in compare(schemas[n - 1], schemas[n])]
    return pd.DataFrame(out, columns=["feed", "file_no", "change", "old_field", "new_field"])


def summaries(records: DataFrame) -> DataFrame:
    rows = records.filter("feed is not null and file_no is not null and payload is not null").select("feed", F.col("file_no").cast("int").alias("file_no"), "payload")
    return spread(rows).mapInPandas(_summaries, SUMMARY)


def changes(records: DataFrame) -> DataFrame:
    """Each difference between the schema of a file and that of the file before in the same feed.

    records: (feed, file_no, payload), payload one JSON object. Payloads that are no JSON object say nothing; a file
    without a predecessor has no changes; a file delivered twice is one file. A feed's summary has a row for each task,
    file and field, however many records the feed has.
    """
    return summaries(records).groupBy("feed").applyInPandas(_changes, CHANGES)


NAMES = "feed string, file_no int, field string, canonical string, kind string, kinds array<string>"
SKETCH = "n long, values_ array<long>, words array<long>, shapes array<long>, low double, high double, word_count long"
SKETCHED = [c.split()[0] for c in SKETCH.split(", ")]


def _free(name: str, taken: set[str]) -> str:
    return name if name not in taken else next(x for n in range(2, 2 + len(taken)) if (x := f"{name}_{n}") not in taken)


def _lineage(schemas: dict[int, dict[str, dict]]) -> dict[int, dict[str, str]]:
    """{file_no: {path: canonical path}} of one feed. A name that comes again for something else gets a name of its own."""
    known: dict[str, str] = {}
    held: dict[str, tuple[str, dict]] = {}  # canonical path: the path that last had it, and its summary
    out: dict[int, dict[str, str]] = {}
    for n in sorted(schemas):
        schema, before = schemas[n], schemas.get(n - 1, {})
        moved = {q: p for change, p, q in compare(before, schema) if change == "renamed"} if before else {}
        mine: dict[str, str] = {}

        def origin(q: str, moved: dict = moved) -> str:
            top, _, leaf = q.partition("[].")
            return moved.get(q) or (f"{moved.get(top, top)}[].{leaf}" if leaf else q)

        for q in sorted(schema, key=lambda q: ("[]." in q, origin(q) not in before, q)):
            top, _, leaf = q.partition("[].")
            under = f"{mine[top]}[]." if leaf else ""
            goes_on = origin(q) in before
            c = under + known.get(origin(q) if goes_on else q, q).rpartition("[].")[2]
            used = set(mine.values())
            if not goes_on and c in held and held[c][0] != q:
                other = held[c][1]
                if other["kind"] != schema[q]["kind"] or content_similarity(other, schema[q], name_similarity(held[c][0], q), bool(leaf)) < 0.15 or held[c][0] in schema:
                    used |= held.keys()
            mine[q] = _free(c, used)
        known |= mine
        held |= {c: (q, schema[q]) for q, c in mine.items()}
        out[n] = mine
    return out


def _feed_names(rows: pd.DataFrame) -> pd.DataFrame:
    """The names within a feed; the sketches of a canonical field are with its last use."""
    schemas = _schemas(rows)
    names = _lineage(schemas)
    last = {c: (n, q) for empty in (True, False) for n in sorted(names) for q, c in names[n].items() if empty or schemas[n][q]["kind"]}
    blank = {"n": 0, "values_": [], "words": [], "shapes": [], "low": None, "high": None, "word_count": 0}
    out = [(rows["feed"].iloc[0], n, q, c, schemas[n][q]["kind"], schemas[n][q]["kinds"], *((schemas[n][q] if last[c] == (n, q) else blank)[x] for x in SKETCHED)) for n in names for q, c in names[n].items()]
    return pd.DataFrame(out, columns=["feed", "file_no", "field", "canonical", "kind", "kinds", *SKETCHED])


def _match(table: dict[str, dict], own: dict[str, dict]) -> dict[str, str]:
    """The path in the table that each canonical path of a feed goes to. table and own: {path: summary, with all its raw names}."""
    to: dict[str, str] = {}

    def match(ours: list[str], theirs: list[str], under: str, top: str) -> None:
        free = {_leaf(t): t for t in theirs}
        for p in ours:
            if _leaf(p) in free:
                to[p] = free.pop(_leaf(p))
        for p in ours:
            common = [n for n, t in sorted(free.items()) if p not in to and table[t]["names"] & own[p]["names"]]
            if common:
                to[p] = free.pop(common[0])
        alone = [p for p in ours if p not in to]
        score = flood(table, own, [(to[top], top)] if under else [(to[p], p) for p in ours if p in to] + [(t, p) for t in free.values() for p in alone])
        # of feeds of unlike kinds, equal shapes alone are no evidence
        for t, p in renames(score, table, own, sorted(free.values()), alone, alike=0.3):
            to[p] = t
        for p in ours:
            to.setdefault(p, under + _leaf(p))

    match(sorted(_level(own, "")), sorted(_level(table, "")), "", "")
    for top in sorted(_level(own, "")):
        if to[top] in table:
            match(sorted(_level(own, top)), sorted(_level(table, to[top])), f"{to[top]}[].", top)
        else:
            for p in _level(own, top):
                to[p] = f"{to[top]}[].{_leaf(p)}"
    return to


def _names(rows: pd.DataFrame) -> pd.DataFrame:
    """One set of names for all feeds: feed by feed, its fields go to those of the feeds before."""
    table: dict[str, dict] = {}
    out = []
    for feed, part in rows.groupby("feed"):
        own: dict[str, dict] = {}
        for c, uses in part.groupby("canonical"):
            own[c] = {x: list(v) if isinstance(v, np.ndarray) else v for x, v in uses.loc[uses["n"].idxmax()].items()} | {"names": {f.rpartition("[].")[2] for f in uses["field"]}}
        to = _match(table, own)
        for c, summary in own.items():
            one = table.setdefault(to[c], summary)
            one["names"] = one["names"] | summary["names"]
        out += [(feed, n, f, to[c], kind, kinds) for n, f, c, kind, kinds in part[["file_no", "field", "canonical", "kind", "kinds"]].itertuples(index=False)]
    return pd.DataFrame(out, columns=["feed", "file_no", "field", "canonical", "kind", "kinds"])


def canonical_names(records: DataFrame) -> DataFrame:
    """(feed, file_no, field, canonical, kind, kinds): the column of the one table that a file's field goes to, or for a path `list[].member` the member's name in it.

    kind is the most frequent one, kinds has all that were seen. The feeds' schemas are matched in one place: a row for each
    feed, file and field, with one bounded sketch for each field of a feed.
    """
    own = summaries(records).groupBy("feed").applyInPandas(_feed_names, f"{NAMES}, {SKETCH}")
    return own.groupBy().applyInPandas(_names, NAMES)


_SCALARS = {"number": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "object": T.MapType(T.StringType(), T.StringType())}
OTHER = "value"  # the member that holds elements that are no objects, in a list that has both


def _types(kinds: dict[str, set[str]]) -> dict[str, T.DataType]:
    """The merged type of each top-level canonical field; kinds has those of the members too."""
    members: dict[str, list[str]] = defaultdict(list)
    for path in sorted(kinds):
        if "[]." in path:
            members[path.partition("[].")[0]].append(path)

    def type_of(path: str) -> T.DataType:
        own = {k.removeprefix("list of ") for k in kinds[path]}
        one = _SCALARS.get(next(iter(own)), T.StringType()) if len(own) == 1 else T.StringType()
        if not any(k.startswith("list of ") for k in kinds[path]):
            return one
        if "object" in own and members[path]:
            fields = {_leaf(m): type_of(m) for m in members[path]}
            if len(own) > 1:
                fields[_free(OTHER, set(fields))] = T.StringType()
            return T.ArrayType(T.StructType([T.StructField(m, t) for m, t in fields.items()]))
        return T.ArrayType(one)

    return {p: type_of(p) for p in kinds if "[]." not in p}


def _cast(own: Column, to: T.DataType, mixed: bool) -> Column:
    """JSON text, or the bare text of a JSON string, as `to`. What stands alone is the only element of an array. mixed: some elements may be no objects."""
    if isinstance(to, T.MapType):
        return F.from_json(own, to)
    if not isinstance(to, T.ArrayType):
        return own.try_cast(to)
    listed = own.rlike(r"^\s*\[")
    inner = to.elementType
    if not isinstance(inner, T.StructType):
        alone = F.from_json(own, inner) if isinstance(inner, T.MapType) else own.try_cast(inner)
        return F.coalesce(F.when(listed, F.from_json(own, to)), F.when(alone.isNotNull(), F.array(alone)))
    if not mixed:
        return F.from_json(F.when(listed, own).when(own.isNotNull(), F.concat(F.lit("["), own, F.lit("]"))), to)

    def element(e: Column) -> Column:
        told = F.from_json(e, T.StructType(inner.fields[:-1]))
        other = ~e.rlike(r"^\s*\{")
        return F.when(e.isNotNull(), F.struct(*(F.when(~other, told[f.name]).alias(f.name) for f in inner.fields[:-1]), F.when(other, e).alias(inner.fields[-1].name)))

    texts = F.coalesce(F.when(listed, F.from_json(own, T.ArrayType(T.StringType()))), F.when(own.isNotNull(), F.array(own)))
    return F.transform(texts, element)


def consistent_table(records: DataFrame, key: str, names: DataFrame) -> DataFrame:
    """All records in one table: key, feed, file_no and a column for each canonical field.

    A column has the merged type of all its values: double, boolean or string, map<string, string> for objects, an array if any
    value is a list (one that stands alone is the only element), an array of structs for lists of objects, whose members have
    their canonical names and types; if some elements are no objects they are in a member `value`. Scalars of several kinds
    become text. names is canonical_names(), best materialised.
    """
    tops = names.filter(~F.col("field").contains("[]."))
    kinds = names.groupBy("canonical").agg(F.array_distinct(F.flatten(F.collect_set("kinds"))).alias("kinds")).collect()  # one row for each column of the result and member
    columns = _types({r.canonical: set(r.kinds) for r in kinds})
    mixed = {r.canonical for r in kinds if len({k.removeprefix("list of ") for k in r.kinds}) > 1}
    member = F.regexp_extract("canonical", r"\[\]\.(.*)$", 1)
    inner = names.filter(F.col("field").contains("[].")).select("feed", "file_no", F.substring_index("field", "[].", 1).alias("field"), F.regexp_extract("field", r"\[\]\.(.*)$", 1).alias("old"), member.alias("new")).filter("old <> new")
    inside = inner.groupBy("feed", "file_no", "field").agg(F.map_from_entries(F.collect_list(F.struct("old", "new"))).alias("m")).groupBy("feed", "file_no").agg(F.map_from_entries(F.collect_list(F.struct("field", "m"))).alias("inside"))
    maps = tops.groupBy("feed", "file_no").agg(F.map_from_entries(F.collect_list(F.struct("field", "canonical"))).alias("to")).join(inside, ["feed", "file_no"], "left")

    def renamed(e: Column) -> Column:
        own = F.try_element_at("inside", e["key"])
        parts = F.try_variant_get(F.try_parse_json(e["value"]), "$", "array<variant>")

        def element(v: Column) -> Column:
            members = F.try_variant_get(v, "$", "map<string,variant>")
            named = F.transform(F.map_entries(members), lambda m: F.struct(F.coalesce(F.try_element_at(own, m["key"]), m["key"]).alias("key"), m["value"].alias("value")))
            # as JSON by hand: two members of one element may go to one name, and an element that is no object stays
            text = F.concat(F.lit("{"), F.array_join(F.transform(named, lambda m: F.concat(F.regexp_extract(F.to_json(F.create_map(m["key"], F.lit(0))), r"^\{(.*):0\}$", 1), F.lit(":"), F.coalesce(F.to_json(m["value"]), F.lit("null")))), ","), F.lit("}"))
            return F.coalesce(F.when(members.isNotNull(), text), F.to_json(v), F.lit("null"))

        return F.when(own.isNull() | parts.isNull(), e["value"]).otherwise(F.concat(F.lit("["), F.array_join(F.transform(parts, element), ","), F.lit("]")))

    parsed = records.select(F.col(key), "feed", F.col("file_no").cast("int").alias("file_no"), F.from_json("payload", T.MapType(T.StringType(), T.StringType())).alias("own"))
    joined = parsed.join(maps, ["feed", "file_no"], "left")
    # two fields of one record may go to one column: the first that is not null holds
    entries = F.transform(F.filter(F.map_entries("own"), lambda e: e["value"].isNotNull()), lambda e: F.struct(F.coalesce(F.try_element_at("to", e["key"]), e["key"]).alias("key"), renamed(e).alias("value")))
    held = joined.select(key, "feed", "file_no", entries.alias("entries")).select(key, "feed", "file_no", F.col("entries.key").alias("fields"), F.col("entries.value").alias("values"))
    taken = {key, "feed", "file_no"}

    def column(name: str, kind: T.DataType) -> Column:
        own = F.get("values", (F.array_position("fields", name) - 1).cast("int"))
        return _cast(own, kind, name in mixed).alias(f"{name}_" if name in taken else name)

    return held.select(key, "feed", "file_no", *(column(c, t) for c, t in sorted(columns.items())))
