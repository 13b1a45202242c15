import collections
import glob
import itertools
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litloom.llm import leakage, mixing, neardup, queries, residue, seen, split, terms, truncation

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(agree, name):
    agree(queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(queries.QUERIES.keys() - queries.SQL.keys()))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() >= 0


def test_sealed_filters_stay(spark, tmp_path):
    rows = lambda *ks: spark.createDataFrame([("f" if k != "z" else "g", n, k) for n, k in ks], "feed string, number long, key string")
    first = seen.Sealed(spark, str(tmp_path / "s"), shards=3)
    assert {tuple(r) for r in first.arrive(rows((1, "a"), (2, "b"), (3, "a"), (4, None), (5, "z"))).collect()} == {("f", 3)}
    again = seen.Sealed(spark, str(tmp_path / "s"))
    assert (again.generation, again.shards) == (1, 3)
    assert {tuple(r) for r in again.arrive(rows((6, "b"), (7, "c"), (8, "c"), (9, "z"))).collect()} == {("f", 6), ("f", 8), ("g", 9)}
    assert {tuple(r) for r in again.arrive(rows((10, "c"), (11, "d"))).collect()} == {("f", 10)}
    assert again.arrive(rows((12, "q")).limit(0)).count() == 0
    keys = seen._mix(np.arange(5000, dtype=np.uint64), 3)
    f = seen.Ribbon.seal(keys, 12)
    assert seen.Ribbon.from_bytes(f.to_bytes()).has(keys).all() and f.z.dtype == np.uint16


# 1


def _labels(n=160, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(60)] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        ws = list(base[i % len(base)])
        for _ in range(rng.choice([0, 0, 1, 2, 4, 12])):
            ws[rng.randrange(len(ws))] = rng.choice(vocabulary)
        rows.append((i, "Drug", [" ".join(ws), None]))
    return rows


def _brute(rows, width, threshold):
    sets = {}
    for i, *texts in rows:
        flat = [t for x in texts for t in (x if isinstance(x, list) else [x])]
        s = {tuple(ws[j : j + width]) for t in flat if t for ws in [re.findall("[a-z0-9]+", t.lower())] for j in range(len(ws) - width + 1)}
        if s:
            sets[i] = s
    return {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


def test_near_duplicates_equal_brute_force(spark):
    from pyspark.sql import functions as F

    rows = [*_labels(), (900, None, None), (901, "", []), (902, "a b", ["c d"]), (903, "x y z", None)]
    df = spark.createDataFrame(rows, "id long, name string, texts array<string>")
    sets, member = neardup.classes(neardup.shingled(df, "id", F.concat(F.array("name"), F.coalesce("texts", F.array().cast("array<string>"))), 3))
    pairs = neardup.similar_pairs(sets, 0.65, block=4)
    found = {(r.a, r.b) for r in neardup.expanded(pairs, member).collect()}
    assert found == _brute(rows, 3, 0.65)
    parent = {i: i for i in {x for p in found for x in p}}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    reps = {r.id: r.rep for r in member.collect()}
    got = {r.id: r.component for r in neardup.components(pairs).collect()}
    assert all(got[x] == root(x) for x in got) and {reps[x] for x in parent if reps[x] in got} == set(got)
    empty, _ = neardup.classes(neardup.shingled(df.limit(0), "id", F.array("name"), 3))
    assert neardup.similar_pairs(empty, 0.65).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(64)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in neardup.components(edges).collect()}
    assert got == {i: 0 for i in range(65)} | {100: 100, 101: 100}


# 2


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet="ab. \n,é", min_size=0, max_size=400), st.integers(5, 60), st.integers(0, 40))
def test_split_round_trip(text, limit, overlap):
    overlap = min(overlap, limit // 2)
    spans = split.pieces(text, limit, overlap)
    assert all(0 < b - a <= limit for a, b in spans) or text == ""
    assert all(b0 - a1 == overlap for (_, b0), (a1, _) in zip(spans, spans[1:]))
    assert text[spans[0][0] : spans[0][1]] + "".join(text[a + overlap : b] for a, b in spans[1:]) == text


def test_split_is_optimal_and_natural():
    text = " ".join(f"Sentence number {i} ends here." for i in range(60))
    spans = split.pieces(text, 300, 30)
    assert all(text[:b].rstrip().endswith(".") for _, b in spans)
    at, penalty = split.boundaries(text, 270)
    assert len(split.pieces("x" * 1000, 300, 30)) == 4 and len(at) == len(penalty)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aaaab. \n,", min_size=20, max_size=200), st.integers(12, 50), st.integers(0, 8))
def test_no_way_over_all_boundaries_costs_less(text, limit, overlap):
    n = len(text)
    if n <= limit:
        return
    at, penalty = split.boundaries(text, limit - overlap)
    best, _ = split._program(n, limit, overlap, 1.0, at, penalty)
    own = dict(zip(at.tolist(), penalty.tolist(), strict=True))
    target = (n - overlap) / -(-(n - overlap) // (limit - overlap))

    def cost(ends):
        sizes = [ends[0] - overlap, *(b - a for a, b in zip(ends, ends[1:]))]
        return sum(0.0 if e == n else own[e] for e in ends) + split.PIECE * len(ends) + sum((x / target - 1) ** 2 for x in sizes)

    assert abs(cost(split.cuts(text, limit, overlap)) - best) < 1e-9
    if len(at) <= 12:  # the program itself against all ways, where these are few
        ways = [[*way, n] for k in range(len(at)) for way in itertools.combinations(at[:-1].tolist(), k)]
        fit = [w for w in ways if w[0] <= limit and all(b - a <= limit - overlap for a, b in zip(w, w[1:])) and all(x > overlap for x in w[:-1])]
        assert abs(min(map(cost, fit)) - best) < 1e-9


def test_split_operator_edges(spark):
    limits = spark.createDataFrame([("a", 50, 10), ("b", 20, 99), ("c", 10, None)], "item_kind string, max_chars int, overlap_chars int")
    items = spark.createDataFrame([("a", 1, 0, "word " * 40), ("a", 1, 0, "word " * 40), ("a", 2, 0, None), ("b", 3, 1, "z" * 45), ("c", 4, 2, "q r " * 6), ("d", 5, 0, "x" * 99), (None, 6, 0, "x" * 99)], "item_kind string, record_no long, section_pos int, text string")
    got = split.split_oversized(items, limits).collect()
    assert {r.record_no for r in got} == {1, 3, 4} and max(len(r.piece) for r in got if r.item_kind == "b") <= 20
    assert split.split_oversized(items.limit(0), limits).count() == 0


# 3


def test_truncation_learns_to_tell_ends(spark):
    rng = random.Random(4)
    nouns, verbs = [f"noun{chr(97 + i)}ing" for i in range(26)], ["lowered", "raised", "changed"]

    def sentence():
        return f"The {rng.choice(nouns)} {rng.choice(verbs)} the {rng.choice(nouns)} by {rng.randrange(99)} units."

    rows, truth = [], set()
    for i in range(1500):
        t = " ".join(sentence() for _ in range(5))
        if i % 10 == 0:
            while t.endswith("."):
                t = t[: rng.randrange(60, len(t))].rstrip()
            truth.add(i)
        rows.append((i, ["s1", "s2", None][i % 3], t + (" " if i % 7 == 0 else ""), "clash"))
    rows += [(2001, "s1", None, ""), (2002, None, "  ", ""), (2003, "s1", "", None)]
    df = spark.createDataFrame(rows, "n long, source string, text string, id string")
    got = {r.id: r.score > 0.5 for r in truncation.scored(df.drop("id"), "n", "source", "text").collect()}
    assert set(got) == set(range(1500))
    hits = {i for i, cut in got.items() if cut}
    assert len(hits & truth) >= 0.9 * len(truth) and len(hits - truth) <= 0.05 * len(hits)
    assert truncation.scored(df.limit(0), "n", "source", "text").count() == 0


# 5


def test_ribbon_has_all_keys_and_few_others():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 30_000, np.uint64))
    f = seen.Ribbon.seal(keys, 16)
    assert f.has(keys).all() and f.has(rng.integers(0, 1 << 63, 200_000, np.uint64)).mean() < 1e-4
    one = seen.Ribbon.seal(keys[:1])
    assert one.has(keys[:1]).all() and not one.has(keys[1:1000]).any()


def test_seen_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [("f", n, rng.choice(["hot", f"k{rng.randrange(400)}", f"u{n}", None])) for n in range(3000)] + [("g", n, f"k{n % 5}") for n in range(20)] + [("f", None, f"k{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "feed string, number long, key string")
    first, before = {}, {(f, k) for f, n, k in rows if n is None}
    for f, n, k in rows:
        if n is not None and k is not None:
            first[f, k] = min(n, first.get((f, k), n))
    want = {(f, n) for f, n, k in rows if n is not None and k is not None and ((f, k) in before or n > first[f, k])}
    assert {tuple(r) for r in seen.seen_before(df).collect()} == want
    assert seen.wrong_rate(df, audit_keys=500).filter("wrong_answers > 0").count() == 0
    many = df.sparkSession.range(40_000).selectExpr("'f' as feed", "id as number", "concat('k', id) as key")
    told = seen.wrong_rate(many, bits=16, audit_keys=20_000).first()
    # within five standard deviations of what the theory says, with 16 bits and with their lowest 10
    assert abs(told.low_wrong - told.low_expected) < 5 * told.low_expected**0.5 and told.low_expected > 100
    assert abs(told.wrong_answers - told.expected_rate * told.absent_probes) < 5 * (told.expected_rate * told.absent_probes) ** 0.5 + 5
    assert told.wrong_rate <= told.wrong_rate_below and told.filter_bytes < 40_000 * 16 / 8 * 1.4
    assert seen.seen_before(df.limit(0)).count() == 0 and seen.wrong_rate(df.limit(0)).count() == 0


# 6


def test_terms_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"shared prefix {i}" for i in range(300)] + ["é", "a  b", " A\tB ", "", " ", "x" * 5000]
    rows = [([rng.choice(vocabulary) if rng.random() > 0.1 else None for _ in range(rng.randrange(6))] if i % 9 else None, [], i) for i in range(800)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>, term int")
    want = collections.Counter()
    records = collections.Counter()
    for a, _, _ in rows:
        own = [t for t in (" ".join(x.split()).lower() for x in a or [] if x is not None) if t]
        want.update(own)
        records.update(set(own))
    got = {r.term: (r.occurrences, r.records) for r in terms.term_counts(df, ["a", "b"], burst=8, worker_entries=50, route_entries=40).collect()}
    assert got == {t: (want[t], records[t]) for t in want}
    assert terms.marked(df.limit(0), ["a"]).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="abé", max_size=6), max_size=60))
def test_burst_trie(words):
    trie = terms.BurstTrie(3)
    for w in words:
        trie.add(w, 2, 1)
    assert {p + s: c for p, own in trie.containers() for s, c in own.items()} == {w: [2 * n, n] for w, n in collections.Counter(words).items()}


# 8


def test_phrases_equal_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    w = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(4)) for _ in range(n)]
    items = [(i, w(rng.choice([4, 12, 13, 30]))) for i in range(12)]
    docs = []
    for d in range(60):
        ws = w(rng.randrange(40))
        if d % 2:
            _, t = rng.choice(items)
            at = rng.randrange(len(t))
            ws[5:5] = t[at : at + rng.randrange(5, 20)]
        docs.append((d, ", ".join(ws).upper(), "x"))
    docs += [(100, None, None), (101, "", ""), (102, docs[1][1], "again")]
    index = leakage.build_index(spark.createDataFrame(docs, "d long, text string, term string"), "d", "text", block=7)
    items_df = spark.createDataFrame([(i, " ".join(t)) for i, t in items] + [(99, None)], "i long, t string")
    for width in (2, 6, 13):
        grams = lambda ws: {tuple(ws[j : j + width]) for j in range(len(ws) - width + 1)}  # noqa: B023, E731
        want = {(d, i) for d, t, _ in docs if t for i, ws in items if grams(re.findall("[a-z0-9]+", t.lower())) & grams(ws)}
        got = leakage.phrase_matches(index, leakage.items_of(items_df, "i", "t"), width)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    assert leakage.phrase_matches(index, []).count() == 0
    whole = {tuple(r) for r in leakage.phrase_matches(index, leakage.items_of(items_df, "i", "t"), 5).collect()}
    monkeypatch.setattr(leakage, "ITEM_WORDS", 30)
    assert len(leakage._batched(leakage.items_of(items_df, "i", "t"))) > 1
    assert {tuple(r) for r in leakage.phrase_matches(index, leakage.items_of(items_df, "i", "t"), 5).collect()} == whole
    monkeypatch.undo()
    assert leakage.proximity(index, leakage.items_of(items_df, "i", "t"), terms=4, share=1.0, span=30).count() > 0


def test_index_is_written_and_read_a_few_blocks_at_a_time(spark):
    rows = spark.range(0, 3200, 1, 1).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2000)), lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", i), F.lit(9000)))), " ").alias("text"))
    index = leakage.build_index(rows, "id", "text", block=100_000)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{index.written_at}/*.parquet")]
    groups = [m.row_group(g) for m in files for g in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == index.count() >= 64
    assert max(g.total_byte_size for g in groups) < 14 << 20 and len(groups) > 1


def test_phrases_of_documents_with_one_key_and_of_one_word(spark, monkeypatch):
    item = [f"t{i}" for i in range(20)]
    docs = [(1, " ".join(item[:15])), (1, " ".join(["x"] * 15)), (2, " ".join(["a"] * 50)), (1, " ".join(["y", *item[5:]]))]
    items = [(7, item), (8, ["a"] * 14)]
    index = leakage.build_index(spark.createDataFrame(docs, "d long, text string").coalesce(1), "d", "text")
    assert index.count() == 1
    found = sorted(tuple(r) for r in leakage.phrase_matches(index, items).collect())
    assert [r for r in found if r[1] == 7] == [(1, 7, 0, 0, 15), (1, 7, 5, 1, 15)]
    assert {r[:2] for r in found} == {(1, 7), (2, 8)}
    monkeypatch.setattr(leakage, "LISTED", 7)
    assert sorted(tuple(r) for r in leakage.phrase_matches(index, items).collect()) == found


def test_proximity_has_every_phrase_match_and_equals_brute_force(spark):
    rng = random.Random(88)
    w = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(n)]
    items = [(i, w(rng.choice([3, 13, 25, 90]))) for i in range(10)] + [(10, [])]
    docs = []
    for d in range(50):
        ws = w(rng.choice([0, 30, 700]))
        t = rng.choice(items)[1]
        at = rng.randrange(len(t) + 1)
        passage = t[at : at + rng.randrange(3, 40)]
        if d % 3 == 0:
            rng.shuffle(passage)
        elif d % 3 == 1:
            passage = [x if rng.random() < 0.8 else "other" for x in passage]
        ws[(at := rng.randrange(len(ws) + 1)) : at] = passage
        docs.append((d, " ".join(ws)))
    index = leakage.build_index(spark.createDataFrame(docs, "d long, text string"), "d", "text", block=7)
    got = {(r.doc_id, r.item_id): r.found for r in leakage.proximity(index, items).collect()}
    phrases = {(r.doc_id, r.item_id) for r in leakage.phrase_matches(index, items).collect()}
    assert phrases and phrases < got.keys()
    frequency = collections.Counter(x for _, t in docs for x in t.split())
    want = {}
    for i, ws in items:
        for n in {min(len(ws), n) for n in (13, 22, 31, 40)} - {0}:
            for s in range(len(ws) - n + 1):
                rarest = set(sorted(set(ws[s : s + n]), key=lambda x: (frequency[x], x))[:8])
                need = len(rarest) * (1 - 0.25 * max(0, n - 13) / 27) - 1e-9
                for d, t in docs:
                    t = t.split()
                    most = max((len(rarest & set(t[q : q + 40])) for q in range(max(1, len(t) - 39))), default=0)
                    if most >= need:
                        want[d, i] = max(want.get((d, i), 0), most)
    assert got == want


def test_proximity_on_the_tables(spark):
    pairs = lambda name: {(r.doc_id, r.item_id) for r in queries.QUERIES[name](spark, "/root/testdata/sf0.01").collect()}
    assert pairs("p8_found") <= pairs("p8_proximity")


# 9


def test_flow_keeps_shares_and_caps():
    flow = mixing.route({("a",): 100, ("a", "b"): 50, ("b",): 10}, {"a": (0.5, 1), "b": (0.5, 3)}, None)
    a, b = (sum(v for (_, s), v in flow.items() if s == x) for x in "ab")
    assert abs(a - b) <= 2 and flow.get((("b",), "b"), 0) <= 30
    assert mixing.route({}, {"a": (1.0, 1)}) == {}


def test_mixture(spark):
    rng = random.Random(9)
    rows = [(i, f"text {i % 900} " + "word " * rng.randrange(1, 30), [" A", "a", "b-x", "B_X", "c", None, "other"][i % 7], 0) for i in range(1400)] + [(5000, None, "a", 1), (5001, "", "a", 1)]
    rows += [(6000 + i, "copied text of both", s, 2) for i, s in enumerate(["a", "b_x", "a"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, tokens int")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b_x", 0.3, 3), ("c", 0.2, 4), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mixture(df, targets, "doc_id", "text", "source")
    got = {r.source: r for r in mixing.shares(mixed, targets).collect()}
    assert all(abs(got[s].actual_share - got[s].target_share) < 0.01 and got[s].most_uses <= got[s].max_repeats for s in ("a", "b_x", "c"))
    own = {i: s.strip().lower().replace("-", "_") for i, _, s, _ in rows if s}
    picked = mixed.collect()
    assert all(own[r.doc_id] == r.source for r in picked) and len({(r.doc_id, r.source) for r in picked}) == len(picked)
    assert sorted(mixing.mixture(df, targets, "doc_id", "text", "source").collect()) == sorted(picked)
    assert mixing.mixture(df.limit(0), targets, "doc_id", "text", "source").count() == 0


# 10


@pytest.fixture(scope="module")
def ratios():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()
    return residue.fit_on([t for t in texts if t])[0]


def test_seeds_are_not_in_the_test_tables():
    import pyarrow.parquet as pq

    from litloom.llm import seeds

    plain = lambda t: re.sub(r"[0-9]+", "9", re.sub(r"\s+", " ", t.lower()))
    rng = np.random.default_rng(5)
    made = {plain(x).strip(" .") for t in [*seeds.notices(rng), *seeds.filler(rng), *seeds.prose(rng)] for x in re.split(r"(?<=[.!?])\s", t)}
    sentences = {s for s in made if len(s) >= 25}
    for scale in ("sf0.001", "sf0.01", "sf0.1"):
        corpus = "\n".join(plain(t) for t in pq.read_table(f"/root/testdata/{scale}/documents.parquet", columns=["text"]).column("text").to_pylist() if t)
        assert not [s for s in sentences if s in corpus]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Give {{ drug_name }} daily.", True), ("Give ${dose} daily.", True), ("Give <%= title %> mg", True), ("of [INSERT DOSE HERE] mg", True),
        ("%(name)s was", True), ("see [[name]]", True), ("took &lt;dose&gt; mg", True), ("Dear #{first_name},", True), ("Service unavailable. Please try again later.", True),
        ("Costs rose by 5% (95% CI 2 to 9).", False), ("The ratio was low where no event occurred.", False), ("<4 mg and >79 mg", False),
        ("at 5% deviation", False), ("[see Warnings (5.2)]", False), ("5% was", False), ("", False),
    ],
)
def test_residue_of_one_text(ratios, text, found):
    assert bool(residue.located([text], ratios)[0]) is found


def test_residue_is_the_same_in_any_batch(ratios):
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column("text").to_pylist() if t] + ["é {{ name }} ü", "\0", "\ud800 {{ name }}"]
    together = residue.located(texts, ratios)
    assert together == [residue.located([t], ratios)[0] for t in texts]
    assert together == residue.located(texts[::-1], ratios)[::-1]
    assert "{ name }" in "".join("é {{ name }} ü"[a:b] for _, a, b, _ in together[-3])
    assert all(x[2] <= y[1] for own in together for x, y in zip(own, own[1:]))


def test_residue_finds_wordings_that_were_left_out():
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist() if t]
    rates = []
    for part in (1, 3):
        ratios, unseen = residue.fit_on(texts, part=part, rounds=3)
        rates.append([np.mean([bool(x) for x in residue.located(own, ratios)]) for own in unseen])
    slots, filler, notices = np.mean(rates, axis=0)
    assert notices >= 0.8 and filler >= 0.6 and slots >= 0.4


def test_residue_is_fitted_on_all_documents(spark, monkeypatch):
    counted = []
    fitted = residue._fitted
    monkeypatch.setattr(residue, "_fitted", lambda tally, texts, again: (counted.append((texts, tally)), fitted(tally, texts, again, rounds=2))[1])
    df = spark.range(0, 15000, 1, 5).select("id", F.concat(F.lit("Patient "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"), F.lit(" was well. Give {{ name }} twice.")).alias("text"))
    residue.fit(df.unionByName(df.limit(1).select("id", F.lit(None).cast("string").alias("text"))), "text")
    texts, tally = counted[0]
    local = residue.Tally()
    local.add(residue.encoded([r.text for r in df.collect()])[0], residue._bare())
    assert texts == 15000 and all(np.array_equal(tally.of[n], local.of[n]) for n in residue.Tally.NAMES)
    monkeypatch.undo()
    rows = [r.text for r in df.limit(300).collect()]
    one, two = residue.fit(spark.createDataFrame([(t,) for t in rows], "text string"), "text"), residue.fit_on(rows)[0]
    assert np.array_equal(one.five, two.five, equal_nan=True) and np.array_equal(one.three, two.three)


def test_residue(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join(f"The {rng.choice(['median', 'mild', 'severe'])} response of {rng.randrange(500)} patients was {rng.choice(['stable', 'lower', 'reduced'])} after treatment." for _ in range(n))
    bad = ["Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "Please enable JavaScript to view this page.", "Error 404: the page you are looking for could not be found.", "Access denied. You don't have permission to access this page."]
    rows = [(i, prose(6) + (" " + bad[i % 4] if i % 20 == 0 else ""), None) for i in range(400)] + [(900, None, 1), (901, "", 1), (902, prose(3000), 1), (903, prose(2000) + " " + bad[0], 1)]
    df = spark.createDataFrame(rows, "doc long, text string, id int")
    found = residue.residue(df, "doc", "text")
    assert {r.id for r in found.select("id").distinct().collect()} == {i for i in range(400) if i % 20 == 0} | {903}
    kept = residue.excluded(df, "doc", found)
    assert kept.count() == len(rows) - 21 and kept.columns == df.columns
    assert residue.residue(df.limit(0), "doc", "text").count() == 0
