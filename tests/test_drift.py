import json

from litloom.operators import drift


def _rows(*files):
    return [(1 + 100 * f + i, "f", f + 1, json.dumps(r)) for f, own in enumerate(files) for i, r in enumerate(own)]


def test_changes(spark):
    a = [{"year": 2000 + i % 20, "kind": ["x", "y"][i % 2], "parts": [{"id": f"s{i}", "content": f"some words {i}"}], "note": "a b c"} for i in range(40)]
    b = [{"pub_year": r["year"], "sort": r["kind"], "parts": [{"id": p["id"], "body": p["content"]} for p in r["parts"]], "total": 3} for r in a]
    c = [{"pub_year": str(r["pub_year"]), "sort": None if i else r["sort"], "parts": [], "total": 3} for i, r in enumerate(b)]
    df = spark.createDataFrame([*_rows(a, b, c), (999, "f", 1, "no json"), (998, "f", 2, None), (997, None, 2, "{}"), (996, "f", 2, "[1]")], "rec_no long, feed string, file_no int, payload string")
    got = {tuple(r)[1:] for r in drift.changes(df).collect()}
    assert got == {
        (2, "renamed", "year", "pub_year"), (2, "renamed", "kind", "sort"), (2, "renamed", "parts[].content", "parts[].body"), (2, "removed", "note", ""), (2, "added", "", "total"),
        (3, "retyped", "pub_year", "pub_year"),
    }
    names = drift.canonical_names(df)
    table = drift.consistent_table(df, "rec_no", names)
    assert {"rec_no", "feed", "file_no", "year", "kind", "parts", "note", "total"} == set(table.columns)
    assert table.filter("rec_no = 101").first().year == "2000" and table.count() == df.count()
    assert drift.changes(df.limit(0)).count() == 0


def test_no_rename_by_chance():
    assert drift.name_similarity("is_open_access", "oa") > 0.5
    old = {"grants": {"kind": "number", "n": 3, "values_": [1, 2, 3], "words": [], "shapes": [9], "low": 1, "high": 300, "word_count": 0}}
    new = {"pages": old["grants"] | {"values_": [2, 3, 4]}}
    assert drift.compare(old, new) == [("removed", "grants", ""), ("added", "", "pages")]


def test_one_table_for_all_feeds(spark):
    a = [{"types": ["review", "trial"], "parts": [{"sec_type": f"t{i % 3}", "body": f"some words {i}"}], "x": i + 5000, "code": f"A-{i}"} for i in range(40)]
    b = [{"types": r["types"], "parts": [{"type": p["sec_type"], "body": p["body"]} for p in r["parts"]], "x": "n/a" if i == 7 else r["x"], "label": r["code"]} for i, r in enumerate(a)]
    c = [{**r, "code": i % 2 == 0} for i, r in enumerate(b)]
    d = [{"type_names": r["types"]} for r in a]
    rows = _rows(a, b, c) + [(5000 + i, "g", 1, json.dumps(r)) for i, r in enumerate(d)]
    df = spark.createDataFrame(rows, "rec_no long, feed string, file_no int, payload string")
    names = drift.canonical_names(df)
    table = {r.rec_no: r for r in drift.consistent_table(df, "rec_no", names).collect()}
    assert set(table[1].__fields__) == {"rec_no", "feed", "file_no", "types", "parts", "x", "code", "code_2"}
    assert table[5000].types == table[1].types == ["review", "trial"]
    assert [p.asDict() for p in table[101].parts] == [p.asDict() for p in table[1].parts] == a[0]["parts"]
    assert table[108].x == "n/a" and table[1].x == "5000"
    assert (table[1].code, table[101].code, table[201].code, table[201].code_2, table[1].code_2) == ("A-0", "A-0", "A-0", True, None)


def test_columns_of_several_kinds(spark):
    a = [{"m": [{"id": f"s{i}", "n": i}], "k": ["x", "y"], "o": {"p": i}, "z": [1, 2]} for i in range(5)]
    b = [{"m": ["a, b", None], "k": "alone [1]", "o": {"p": "q"}, "z": 3}, {"m": {"id": "only", "n": 2}, "k": None, "z": []}]
    df = spark.createDataFrame(_rows(a, b), "rec_no long, feed string, file_no int, payload string")
    table = {r.rec_no: r.asDict(recursive=True) for r in drift.consistent_table(df, "rec_no", drift.canonical_names(df)).collect()}
    assert table[2]["m"] == [{"id": "s1", "n": 1.0, "value": None}] and table[2]["k"] == ["x", "y"] and table[2]["z"] == [1.0, 2.0] and table[2]["o"] == {"p": "1"}
    assert table[101]["m"] == [{"id": None, "n": None, "value": "a, b"}, None] and table[101]["k"] == ["alone [1]"] and table[101]["z"] == [3.0]
    assert table[102]["m"] == [{"id": "only", "n": 2.0, "value": None}] and table[102]["k"] is None and table[102]["z"] == []


def _field(kind, values, words=(), shapes=(5,)):
    return {"kind": kind, "n": 9, "values_": sorted(values), "words": sorted(words), "shapes": sorted(shapes), "low": None, "high": None, "word_count": 90}


def test_flooding_decides():
    """Two lists come for one that goes, with like names and values themselves; what their members say settles which is the same."""
    member = lambda seed: _field("string", range(seed, seed + 200), range(seed, seed + 200), [seed])
    old = {"parts": _field("list of object", [1], [1]), "parts[].a": member(1000), "parts[].b": member(2000)}
    new = {
        "bparts": _field("list of object", [1], [1]), "bparts[].a": member(1000), "bparts[].c": member(2000),
        "aparts": _field("list of object", [1], [1]), "aparts[].a": member(7000), "aparts[].c": member(8000),
    }
    tops = [("parts", "aparts"), ("parts", "bparts")]
    score = drift.flood(old, new, tops)
    alone = drift.flood(old, new, tops, rounds=0)
    assert alone[tops[0]] == alone[tops[1]] and score[tops[1]] > score[tops[0]]
    assert drift.renames(score, old, new, ["parts"], ["aparts", "bparts"]) == [("parts", "bparts")]
    assert drift.renames(dict.fromkeys(score, 0.0), old, new, ["parts"], ["aparts", "bparts"]) == []
    assert ("renamed", "parts[].b", "bparts[].c") in drift.compare(old, new)
    assert ("removed", "parts[].b", "") in drift.compare(old, {k.replace("bparts", "parts"): v for k, v in new.items() if "bparts" in k} | {"parts[].c": member(8000)})
