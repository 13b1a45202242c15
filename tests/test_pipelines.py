import pytest
from pyspark.sql import functions as F

from litloom.config import Config, listed
from litloom.plans import pipelines
from litloom.sources import writer
from litloom.sources.sink import Table
from tests.test_sources import JATS, PUBMED, SPL, _zip


class _Client:
    def __init__(self, errors=()):
        self.errors, self.calls = list(errors), []

    def write(self, columns, schema):
        self.calls.append((columns, schema))
        if self.errors:
            raise RuntimeError(self.errors.pop(0))


def test_writer_schema_once_and_union_of_keys():
    c = _Client()
    w = writer.BatchWriter(c, {"id": "uuid"}, batch=2)
    assert w.write([{"id": "1", "a": "x"}, {"id": "2", "b": "y"}, {"id": "1", "a": "z"}, {"id": ""}, {"id": ""}]) == 4
    assert [s for _, s in c.calls] == [{"id": "uuid"}, None] and c.calls[0][0] == {"a": ["x", None], "b": [None, "y"], "id": ["1", "2"]}
    assert writer.BatchWriter(c, dry_run=True).write([{"id": "1"}, {"id": "1"}]) == 2 and len(c.calls) == 2


def test_writer_retries_and_paces():
    slept, now = [], [0.0]
    c = _Client(["429 too many requests"])
    w = writer.BatchWriter(c, batch=1, interval=5, sleep=slept.append, clock=lambda: now[0])
    w.write([{"id": "1"}, {"id": "2"}])
    assert len(c.calls) == 3 and 1 <= slept[0] <= 1.5 and slept[1] == 5
    bad = _Client(["400 bad request"])
    with pytest.raises(RuntimeError):
        writer.BatchWriter(bad, sleep=slept.append).write([{"id": "1"}])
    assert len(bad.calls) == 1
    with pytest.raises(ValueError):
        writer.BatchWriter(_Client(["413"])).write([{"id": "1"}])


def test_rate_limiter():
    now = [0.0]
    r = writer.RateLimiter(2, 1.0, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(5):
        r.acquire()
    assert now[0] == 2.0


def test_write_frame(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "id string, n int")
    out = writer.write_frame(df, lambda: writer.BatchWriter(type("Null", (), {"write": lambda *_: None})()), order="n", writers=2)
    assert out.agg(F.sum("written")).first()[0] == 3


def test_config(spark):
    c = Config.of({"LITLOOM_CHUNK_SIZE": "100", "LITLOOM_DRY_RUN": "yes", "LITLOOM_SHARDS": "many"})
    assert (c.chunk_words, c.stride_words, c.dry_run, c.shards) == (75, 1, True, 1)
    assert (Config().chunk_words, Config().stride_words) == (1536, 1344)
    assert spark.range(1).select(listed(F.lit(" a,b,, a ")).alias("x")).first().x == ["a", "b"]


def test_pubmed_update(spark, tmp_path):
    (tmp_path / "in").mkdir()
    body = PUBMED.replace(b"<MedlineDate>1999 Spring-Summer</MedlineDate>", b"<Year>2020</Year>").replace(b"aa <b>bb</b> cc", b"long " * 20) + b"</PubmedArticleSet>"
    (tmp_path / "in" / "a.xml").write_bytes(body)
    table = Table(spark, str(tmp_path / "t"))
    for _ in range(2):
        pipelines.pubmed_update(spark, str(tmp_path / "in"), table, str(tmp_path / "c"))
    got = table.read().collect()
    assert len(got) == 1 and got[0].doc_id == "8" and got[0].page_content.startswith("Title: A b2 c Abstract: AIM: long")
    (tmp_path / "in" / "b.xml").write_bytes(body.replace(b">8<", b">9<"))
    pipelines.pubmed_update(spark, str(tmp_path / "in"), table, str(tmp_path / "c"))
    assert table.read().count() == 2


def test_pmc_and_labels(spark):
    inventory = spark.createDataFrame([("k1", "e", True, None, "CC BY"), ("k2", "e", True, None, "cc-by-nc"), ("k3", None, True, None, None), ("k4", "e", None, None, None), ("k5", "e", None, True, "x")], "metadata_key string, etag string, is_pmc_openaccess boolean, is_manuscript boolean, license string")
    done = spark.createDataFrame([("k3",), (None,)], "key string")
    fetched = spark.createDataFrame([("k1", "a.xml", bytearray(JATS)), ("k2", "b.xml", bytearray(JATS)), ("k3", "c", bytearray(JATS)), ("k5", "d", bytearray(b"<article"))], "metadata_key string, path string, content binary")
    good, dead = pipelines.pmc_articles(inventory, done, fetched)
    assert [r.document_id for r in good.collect()] == ["pmid_5"]
    assert {tuple(r) for r in dead.collect()} == {("pmc_oa:k2:e", "metadata filter", "metadata field license marks a non-commercial license (cc-by-nc)"), ("pmc_manuscript:k5:e", "parse", "parse error: ParseError")}
    archives = spark.createDataFrame([("z", bytearray(_zip({"One.xml": SPL, "two.xml": SPL.replace(b"s-1", b"s-2"), "three.xml": b"<"})))], "path string, content binary")
    points = pipelines.label_points(archives, spark.createDataFrame([("two",)], "key string")).collect()
    assert {p.chunk_id for p in points} == {"s-1_warnings_part0", "s-1_warnings_table_0_part0", "s-1_highlights_part0"} and len(points[0].vector) == 64


def _pmc_rows(spark):
    inventory = spark.createDataFrame(
        [("k1", "e", True, None, "CC BY"), ("k1", "e2", True, None, "CC BY"), ("k2", "e", True, None, "cc-by-nc"), ("k5", "e", None, True, "x"), ("k6", "e", True, None, None)],
        "metadata_key string, etag string, is_pmc_openaccess boolean, is_manuscript boolean, license string",
    ).withColumn("last_modified", F.lit("2026-01-02 00:00:00").cast("timestamp_ntz"))
    long = JATS.replace(b"<p>did</p>", b"<p>" + b"did what was said " * 10 + b"</p>")
    fetched = spark.createDataFrame([("k1", "PMC1.xml", bytearray(long)), ("k5", "d", bytearray(b"<article"))], "metadata_key string, path string, content binary")
    return inventory, fetched


def test_pmc_update_reaches_the_table_and_goes_on_after_a_crash(spark, tmp_path):
    from litloom.sources.checkpoint import Checkpoint

    inventory, fetched = _pmc_rows(spark)
    table, checkpoint = Table(spark, str(tmp_path / "t"), shards=2), Checkpoint(spark, str(tmp_path / "c"))

    class Killed(Table):
        def _commit(self, manifest):
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        pipelines.pmc_update(inventory, fetched, Killed(spark, str(tmp_path / "t"), shards=2), checkpoint)
    assert table.read() is None and checkpoint.done().count() == 0
    told = pipelines.pmc_update(inventory, fetched, table, checkpoint)
    rows = table.read().collect()
    assert told["articles"] == 1 and told["points"] == len(rows) >= 1 and all(r.doc_id == "pmid_5" and len(r.vector) == 64 for r in rows)
    assert {r.key for r in checkpoint.done().collect()} == {"pmc_oa:k1:e2"}
    assert {(r.key, r.stage) for r in checkpoint.dropped().collect()} == {("pmc_oa:k2:e", "metadata filter"), ("pmc_manuscript:k5:e", "parse"), ("k6", "xml download")}
    # the watermark keeps the second run from seeing anything; without it only what failed on the way is tried again
    assert pipelines.pmc_update(inventory, fetched, table, checkpoint)["articles"] == 0 and checkpoint.dropped().count() == 3
    late = spark.createDataFrame([("k6", "PMC6.xml", bytearray(JATS.replace(b">5<", b">6<").replace(b"<p>did</p>", b"<p>" + b"more words " * 10 + b"</p>")))], fetched.schema)
    assert pipelines.pmc_update(inventory.drop("last_modified"), late, table, checkpoint)["articles"] == 1
    assert {r.doc_id for r in table.read().collect()} == {"pmid_5", "pmid_6"}


def test_label_update(spark, tmp_path):
    from litloom.sources.checkpoint import Checkpoint

    table, checkpoint = Table(spark, str(tmp_path / "t")), Checkpoint(spark, str(tmp_path / "c"))
    archives = spark.createDataFrame([("z", bytearray(_zip({"One.xml": SPL, "three.xml": b"<"})))], "path string, content binary")
    assert pipelines.label_update(archives, table, checkpoint) == 3 == table.read().count()
    assert {r.key for r in checkpoint.done().collect()} == {"one", "s-1"} and [tuple(r) for r in checkpoint.dropped().collect()] == [("three", "parse", "parse_error")]
    assert pipelines.label_update(archives, table, checkpoint) == 0 and table.read().count() == 3


def test_table_versions(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), shards=4)
    rows = lambda *r: spark.createDataFrame(list(r), "id string, v int, n int")
    assert table.upsert(rows(("a", 1, 2), ("a", 2, 1), ("b", 3, 1), (None, 4, 1), (None, 5, 1), ("c", 6, 1), ("c", 6, 1)), "n") == 5
    got = lambda: sorted((r.id or "", r.v) for r in table.read().collect())
    assert got() == [("", 4), ("", 5), ("a", 2), ("b", 3), ("c", 6)]
    before = table._manifest()["files"]
    assert table.upsert(rows(("a", 9, 1))) == 1 and got() == [("", 4), ("", 5), ("a", 9), ("b", 3), ("c", 6)]
    after = table._manifest()["files"]
    assert sum(before[k] != after[k] for k in before) == 1
    assert table.upsert(rows().limit(0)) == 0 and Table(spark, str(tmp_path / "t"), shards=9).shards == 4
    assert table.upsert(spark.createDataFrame([("d", "x")], "id string, other string")) == 1 and "other" in table.read().columns
    with pytest.raises(RuntimeError):
        table._commit(table._manifest())
    table.vacuum(keep=1)
    assert got() == [("", 4), ("", 5), ("a", 9), ("b", 3), ("c", 6), ("d", None)]


def test_schema_by_name(spark):
    from litloom.sources.sink import schema_by_name

    df = spark.createDataFrame([], "id string, vector array<float>, page_content string, title string, year long, is_table boolean, keywords array<string>, other_ids string, extra array<string>, n double, doc_id string, drug_name string")
    told = schema_by_name(df.schema, 8)
    assert told["id"] == "uuid" and told["vector"] == {"type": "[8]f16", "ann": True} and told["page_content"]["full_text_search"]["stemming"] and told["title"]["full_text_search"] is True
    assert (told["year"], told["is_table"], told["keywords"], told["extra"], told["n"], told["doc_id"]) == ("int", "bool", "[]string", "[]string", "float", "string")
    assert told["other_ids"] == {"type": "string", "filterable": False} and told["drug_name"]["filterable"]


def test_asking_again_and_routes():
    from litloom.operators.embed import asked, routed

    calls, slept, now = [], [], [0.0]

    def flaky(errors):
        def ask(texts):
            calls.append(len(texts))
            if errors:
                raise errors.pop(0)
            return [[1.0]] * len(texts)

        return ask

    limited = RuntimeError("429 too many requests")
    limited.retry_after = 7
    assert asked(flaky([RuntimeError("503"), limited]), 3, slept.append)(["a"]) == [[1.0]] and slept == [1.0, 7.0]
    with pytest.raises(RuntimeError):
        asked(flaky([RuntimeError("400 bad request")]), 3, slept.append)(["a"])
    assert len(slept) == 2
    which = []
    one = lambda texts: which.append(1) or (_ for _ in ()).throw(RuntimeError("429"))
    two = lambda texts: which.append(2) or [[2.0]]
    ask = routed([one, two], ["m", "m"], rest=30, per_second=100, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert [ask(["x"]) for _ in range(4)] == [[[2.0]]] * 4 and which.count(1) <= 1


def test_weekly_update_goes_on():
    got = pipelines.weekly_update({"a": lambda: 1, "b": lambda: 1 / 0, "c": lambda: 3, "d": lambda: 4}, skip=["d"])
    assert (got["a"]["result"], got["b"]["state"], got["c"]["state"], got["d"]["state"]) == (1, "failed", "done", "skipped") and "ZeroDivisionError" in got["b"]["error"]
