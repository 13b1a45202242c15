from litloom.operators import nested


def test_levels_links_and_clashing_names(spark):
    kind = "k long, c struct<a:array<struct<record_no:string,x:struct<y:int>,b:array<string>>>,n:array<array<int>>>, child_pos int"
    rows = [(1, ([("p", (1,), ["u", None, "v"]), None, ("q", None, None)], [[1, 2], None]), 5), (2, None, 5), (3, ([], None), 5), (1, ([(None, None, [])], []), 5)]
    out = nested.child_tables(spark.createDataFrame(rows, kind), "k", "c")
    assert sorted(out) == ["c.a", "c.a.b", "c.n", "c.n[]"]
    a = out["c.a"].orderBy("record_no", "child_pos", "record_no_value").collect()
    assert [(r.record_no, r.child_pos, r.record_no_value, r.x_y) for r in a] == [(1, 0, None, None), (1, 0, "p", 1), (1, 2, "q", None)]
    b = out["c.a.b"].orderBy("child_pos").collect()
    assert [(r.parent_key, r.parent_pos, r.child_pos, r.value) for r in b] == [("1/c.a/0", 0, 0, "u"), ("1/c.a/0", 0, 2, "v")]
    assert [r.value for r in out["c.n[]"].orderBy("child_pos").collect()] == [1, 2]
    empty = nested.child_tables(spark.createDataFrame([], kind), "k", "c")
    assert empty["c.a.b"].count() == 0


def test_json_lists(spark):
    rows = [(1, '{"w": [null, {"a": 1}, 2]}'), (2, '{"w": {"a": 1}}'), (3, '{"w": null}'), (4, "not json"), (5, None), (6, "{}"), (7, '{"w": "x"}')]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "k long, t string")
    got = nested.child_table(df, "k", nested.json_list(F.try_parse_json("t"), "$.w"), "w").orderBy("record_no", "child_pos").collect()
    assert [(r.record_no, r.child_pos) for r in got] == [(1, 1), (1, 2), (2, 0)]


def test_json_walk_by_merged_schema(spark):
    texts = [
        '{"v": 1, "p": {"n": "x", "steps": [{"s": "a", "ms": 5, "in": [1, 2]}, null, {"s": "b"}]}, "w": [{"c": "k", "at": {"t": {"row": 3}}}, null, {"c": "l"}]}',
        '{"v": 2, "w": {"c": "m", "at": {"s": 4}}, "odd key, <1>": true}',
        '{"w": "alone", "mixed": 1, "nn": [[1], [2, 3]]}',
        '{"w": null, "mixed": "x", "record_no": 7}',
        "not json",
        None,
    ]
    out = nested.json_tables(spark.createDataFrame(list(enumerate(texts)), "k long, t string"), "k", "t")
    assert sorted(out) == ["t", "t.nn", "t.nn[]", "t.p.steps", "t.p.steps.in", "t.w"]
    top = {r.record_no: r for r in out["t"].collect()}
    assert len(top) == 6 and top[0].p_n == "x" and top[1]["odd key, <1>"] and (top[2].mixed, top[3].mixed) == ("1", '"x"')
    assert [top[i].w for i in range(6)] == [None, None, '"alone"', None, None, None] and top[3].record_no_value == 7
    w = out["t.w"].orderBy("record_no", "child_pos").collect()
    assert [(r.record_no, r.child_pos, r.c, r.at_t_row, r.at_s) for r in w] == [(0, 0, "k", 3, None), (0, 2, "l", None, None), (1, 0, "m", None, 4)]
    steps = out["t.p.steps"].orderBy("child_pos").collect()
    assert [(r.row_key, r.child_pos, r.s, r.ms) for r in steps] == [("0/t.p.steps/0", 0, "a", 5), ("0/t.p.steps/2", 2, "b", None)]
    inner = out["t.p.steps.in"].orderBy("child_pos").collect()
    assert [(r.parent_key, r.parent_pos, r.child_pos, r.value) for r in inner] == [("0/t.p.steps/0", 0, 0, 1), ("0/t.p.steps/0", 0, 1, 2)]
    assert [(r.parent_key, r.value) for r in out["t.nn[]"].orderBy("parent_pos", "child_pos").collect()] == [("2/t.nn/0", 1), ("2/t.nn/1", 2), ("2/t.nn/1", 3)]


def test_metadata_tables(spark, duck):
    from litloom.plans import training
    from tests.conftest import DATA

    steps = duck.sql("""select record_no, q, json_extract_string(s, '$[' || q || '].step'), json_extract(s, '$[' || q || '].ms')::bigint from (
      select record_no, s, unnest(range(json_array_length(s)::bigint)) as q from (select record_no, json_extract(try_cast(extraction_metadata as json), '$.parser.steps') as s from pmc_articles) where s is not null)""").fetchall()
    got = training.QUERIES["p7_parser_steps"](spark, DATA).select("record_no", "child_pos", "step", "ms").collect()
    assert steps and sorted(map(tuple, got)) == sorted(steps)
    assert {"code", "where_section", "where_table_row", "where_table_col"} <= set(training.QUERIES["p7_warnings"](spark, DATA).columns)
    assert {"parser_name", "tables_in_floats_group", "processing_date"} <= set(training.QUERIES["p7_metadata"](spark, DATA).columns)
