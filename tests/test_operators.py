import hashlib
import uuid

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litloom.functions import classify, ids
from litloom.functions import text as texts
from litloom.operators import batching, embed, incremental
from litloom.sources import sink
from litloom.streaming import ingest


def test_identifiers(spark):
    names = ["pubmed:1_abstract", "ü", "", "a" * 300]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(ids.uuid5(F.col("n")).alias("u"), ids.shard(F.col("n"), 7).alias("s")).collect()
    assert [r.u for r in got] == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]
    assert [r.s for r in got] == [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "big") % 7 for n in names]
    assert ids.shard_names("m", 1) == ["m"] and ids.shard_names("m", 2, "s") == ["m_s_0", "m_s_1"] and ids.shard_names("m", 2)[1] == "m_shard_1"


def test_chunks_tail_and_blanks(spark):
    rows = [(1, " ".join(map(str, range(9)))), (2, " \n "), (3, None), (4, "a b")]
    got = texts.chunked(spark.createDataFrame(rows, "k int, t string"), "t", 4, 3).orderBy("k", "chunk_index").collect()
    assert [(r.k, r.chunk_text) for r in got] == [(1, "0 1 2 3"), (1, "3 4 5 6"), (1, "6 7 8"), (4, "a b")]
    assert [r.token_count for r in got] == [5, 5, 4, 2]


def test_evidence_order(spark):
    rows = [("Case_Report", ["Review"], None), (None, ["Comment", "Review"], "rct"), (None, None, "infarct seen"), (None, None, "randomized trial of phase 2"), ("news", None, None), ("research-article", None, "cohort study"), (None, [None], "")]
    got = spark.createDataFrame(rows, "a string, p array<string>, t string").select(classify.evidence(F.col("a"), F.col("p"), F.col("t")).alias("e")).select("e.*").collect()
    assert [(r.grade, r.matched_term, r.matched_from) for r in got] == [("C", "case-report", "article_type"), ("D", "comment", "publication_type"), ("B", "rct", "abstract"), ("B", "randomized trial + phase", "abstract"), ("D", "news", "fallback"), ("C", "cohort study", "abstract"), ("C", None, "fallback")]


def test_json_skip_reason(spark):
    rows = [('{"is_pmc_openaccess": false}',), ('{"open_access": " No ", "license": "cc-by-nc"}',), ('{"license_name": "CC BY-NC 4.0", "license_text": "non-commercial"}',), ('{"license": "cc-by"}',), ("x",), (None,)]
    got = [r.r for r in spark.createDataFrame(rows, "m string").select(classify.json_skip_reason(F.col("m")).alias("r")).collect()]
    assert got == ["metadata field is_pmc_openaccess is false", "metadata field open_access is false", "metadata field license_name marks a non-commercial license (CC BY-NC 4.0)", None, None, None]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=30), st.integers(1, 5), st.integers(1, 60))
def test_greedy(tokens, most, budget):
    out = batching.greedy(tokens, most, budget)
    assert out == sorted(out) and len(out) == len(tokens)
    for b in set(out):
        own = [t for t, x in zip(tokens, out, strict=True) if x == b]
        assert len(own) <= most and (sum(own) <= budget or len(own) == 1)


def test_keep_first_newest_and_batches(spark):
    df = spark.createDataFrame([(1, "a", "p"), (2, "a", "q"), (3, "", "r"), (4, None, "s"), (5, None, "t")], "n long, k string, _x string")
    assert {r.n for r in incremental.keep_first(df, "k", "n").collect()} == {1, 3, 4, 5}
    assert {r.n for r in incremental.newest(df, "k", "n").collect()} == {2, 3, 5}
    assert [r.batch_no for r in incremental.batches(df, "n", 2, 3).orderBy("n").collect()] == [0, 0, 1, 1, 2]
    assert incremental.batches(df.limit(0), "n", 2).count() == 0
    kept, dead = incremental.split_by_reason(df, F.when(F.col("n") > 3, F.lit(" too \n late ")), F.col("n").cast("string"), "s")
    assert kept.count() == 3 and {tuple(r) for r in dead.collect()} == {("4", "s", "too late"), ("5", "s", "too late")}


def test_table_upsert_and_stream(spark, tmp_path):
    table = sink.Table(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.upsert(spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 3)], "id string, v int, n int"), "n")
    table.upsert(spark.createDataFrame([("b", 9, "w")], "id string, n int, w string"))
    assert {(r.id, r.v, r.w) for r in table.read().collect()} == {("a", 1, None), ("b", None, "w")}
    src, target = tmp_path / "in", sink.Table(spark, str(tmp_path / "s"))
    spark.range(10).select(F.concat(F.lit("k"), (F.col("id") % 4).cast("string")).alias("id"), F.col("id").alias("n")).coalesce(1).write.parquet(str(src))
    schema = spark.read.parquet(str(src)).schema
    for _ in range(2):
        ingest.upsert_stream(ingest.files(spark, str(src), schema), target, str(tmp_path / "cp"), "n")
    assert {(r.id, r.n) for r in target.read().collect()} == {("k0", 0), ("k1", 1), ("k2", 2), ("k3", 3)}
    assert sink.guarded_drop(spark, str(tmp_path / "s"), "s", ["prod"], "t")["reason"] == "not confirmed" and sink.guarded_drop(spark, str(tmp_path / "s"), "s", [], "s")["dropped"]


def test_stream_rate_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    events.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = ingest.request_rate(ingest.files(spark, str(tmp_path / "e"), events.schema), "ts", "1 hour")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("rate").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    want = events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour")).count().agg(F.sum("count"), F.count("*")).first()
    assert spark.table("rate").agg(F.sum("requests"), F.count("*")).first()[:] == want[:]


def test_coerced(spark):
    df = spark.createDataFrame([([], [(1,)], (2,), "x"), (["a"], [], None, "0.5")], "l array<string>, s array<struct<a:int>>, o struct<b:int>, section_weight string")
    assert [tuple(r) for r in sink.coerced(df).collect()] == [(None, '[{"a":1}]', '{"b":2}', 0.0), (["a"], None, None, 0.5)]


def test_routes():
    r = embed.Routes(["big", "big", "small"])
    assert {r.pick(0), r.pick(0)} == {0, 1}
    r.failed(0, 0, server=True)
    r.failed(0, 0, server=True)
    r.failed(1, 0, limited=True)
    assert r.pick(1) == 2 and r.pick(31) == 2
    r.failed(2, 31, limited=True)
    assert r.pick(32) == 1


def test_agencies(spark):
    from pyspark.sql import functions as F

    from litloom.functions import classify

    AFFILIATIONS = [
        (1, ["Office of Research, National Cancer Institute, Bethesda, MD"], None), (2, ["National Institute of Allergy and Infectious Diseases"], ["Wellcome"]),
        (3, ["Rockville, MD"], None), (4, ["VA Medical Center", "Walter Reed Hospital"], ["NIH HHS", None]), (5, None, ["Veterans Fund "]), (6, [], []), (7, ["CDC, Atlanta, GA", None], None),
    ]
    rows = spark.createDataFrame(AFFILIATIONS, "id int, affiliations array<string>, grants array<string>")
    got = {r.id: r.agencies for r in rows.select("id", F.array_join(classify.agencies(F.col("affiliations"), F.col("grants")), "; ").alias("agencies")).collect()}
    assert got == {1: "NCI", 2: "NIH", 3: "", 4: "NIH HHS; VA; Walter Reed", 5: "Veterans Fund", 6: "", 7: "CDC"}
