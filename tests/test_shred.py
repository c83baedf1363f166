import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import deepjson as D
from millrace.operators import shred as S

JSON = st.recursive(st.none() | st.booleans() | st.integers(-5, 5) | st.sampled_from(["", "a", "[x", "{}", '[1,{"q":"[2]"}]', " [] "]), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.sampled_from(["a", "b/c", "~", "0", "", "i", "o"]), x, max_size=4), max_leaves=25)


def walk(v, path="", parent="", item=False):
    if isinstance(v, str) and v.strip()[:1] in ("{", "[") and v.strip():
        try:
            inner = json.loads(v)
        except ValueError:
            inner = v
        v = inner if isinstance(inner, (dict, list)) else v
    if isinstance(v, dict):
        if path:
            yield path, parent
            parent = path
        for k, x in v.items():
            yield from walk(x, f"{path}/{k.replace('~', '~0').replace('/', '~1')}", parent)
    elif isinstance(v, list):
        for i, x in enumerate(v):
            yield from walk(x, f"{path}/{i}", parent, True)
    elif v is not None and item:
        yield path, parent


OPEN = st.sets(st.sampled_from(["", "a", "b/c", "~", "/*", "/[]", "a/*", "a/[]", "o"]), max_size=4).map(frozenset)


def rows(columns):
    return [(r.table, r.row_id, r.scalars, r.empties()) for r in S.rows_of(columns)]


@settings(max_examples=400, deadline=None)
@given(JSON, OPEN)
def test_round_trip_and_nodes(v, open_):
    root = S.parse(json.dumps(v))
    columns = S.shred(root, open_)
    assert S.rebuild(columns) == root
    assert S.record_of(rows(columns)) == root and S.record_of(reversed(rows(columns))) == root
    nodes, fields = S.assemble(columns)
    assert sorted((p, x[0]) for p, x in nodes.items()) == sorted(walk(v))
    for parent, name, value in fields:
        at = root
        for step in parent.split("/")[1:]:
            at = at[int(step)] if isinstance(at, list) else at[step.replace("~1", "/").replace("~0", "~")]
        assert at[name] == value


def test_any_depth():
    for text, path in (("[" * 9_000 + "1" + "]" * 9_000, "/0" * 9_000), ('{"a":' * 1_500 + "[2]" + "}" * 1_500, "/a" * 1_500 + "/0")):
        columns = S.shred(S.parse(text))
        assert path in S.assemble(columns)[0]
        back = S.rebuild(columns)
        assert D.dumps(back, separators=(",", ":")) == text
    assert S.parse("[" * 20_000) is None  # never closed


@settings(max_examples=200, deadline=None)
@given(JSON)
def test_readers_agree(v):
    for text in (json.dumps(v), json.dumps(v, indent=3)):
        assert D._read(text, D._skip(text, 0))[0] == v
    for indent in (None, 2):
        assert D._write(v, False, (", " if indent is None else ",", ": "), True, indent) == json.dumps(v, ensure_ascii=False, sort_keys=True, indent=indent)
    for bad in ("[1,]", '{"a":1,}', '{"a" 1}', "[1 2]", '{"a":1', "[", "{", "{1:2}"):
        with pytest.raises(ValueError):
            D._read(bad, 0)


def test_levels():
    named = S.shred(S.parse('{"x": {"b": 1}, "y": {}, "z": 3}'), frozenset([""]))
    assert named[("m", "e", "key")] == [(0, 3, "x"), (1, 3, "y"), (1, 3, "z")] and named[("m", "e", "o", "k:b", "s")] == [(0, 5, 1), (1, 3, None), (1, 2, None)]
    got = S.shred(S.parse('{"a": [{"b": 1}, {"b": 2}, {}, null], "c": []}'))
    assert got[("o", "k:a", "l", "i", "o", "k:b", "s")] == [(0, 7, 1), (1, 7, 2), (1, 5, None), (1, 4, None)]
    assert got[("o", "k:c", "l")] == [(0, 3, None)]


def test_table(spark, rows):
    deep = "[" * 400 + "1" + "]" * 400
    data = [(1, '{"r": {"x": ["a", null, "b"]}}'), (2, None), (3, ""), (4, "{bad"), (5, "[]"), (6, "3"), (7, '"[{}]"'), (8, deep), (9, "[" * 5000), (None, "[1]"), (1, '{"r": {}}'), (10, '["\\ud800"]')]
    df = spark.createDataFrame(data, "file_id bigint, rules string").withColumns({c: F.lit("z") for c in ("node_path", "parent_path", "value", "name")})
    got = rows(S.nodes(df, "file_id", "rules").select("file_id", "node_path", "parent_path"))
    want = [(1, "/r", ""), (1, "/r", ""), (1, "/r/x/0", "/r"), (1, "/r/x/2", "/r"), (7, "/0", ""), (8, "/0" * 400, ""), (10, "/0", ""), (None, "/0", "")]
    assert got == sorted(want, key=repr)
    assert rows(S.fields(spark.createDataFrame([(1, '{"a": 1, "b": {"c": true, "d": null, "e": "x"}}')], "id bigint, t string"), "id", "t")) == [(1, "", "a", "1"), (1, "/b", "c", "true"), (1, "/b", "e", "x")]
    assert S.nodes(df.limit(0), "file_id", "rules").count() == 0 and S.levels(df, "file_id", "rules").count() == 10


def test_tables(spark):
    rule = lambda n: f'"rule {n}": {{"function": "f{n}", "examples": [{{"input": "x", "tags": ["t", "u"]}}, {{"input": "y", "tags": []}}], "origin": {{"place": null, "year": {n}}}, "sub_rules": {{"s": {{}}}}}}'
    data = [(k, "{" + ", ".join(rule(10 * k + j) for j in range(3)) + "}") for k in range(1, 5)] + [(7, None), (8, '[{"a": null}, 2.5]'), (9, '{"*": {"[]": [1]}}'), (10, "{bad"), (11, "null")]
    df = spark.createDataFrame(data, "id bigint, t string").withColumns({c: F.lit("z") for c in ("table_name", "row_id", "fields")})
    assert S.open_contexts(df, "t") == {""}  # thirteen names, three a record
    got = S.tables(df, "id", "t").collect()
    by = {(r.id, r.row_id): r for r in got}
    assert by[1, "/rule 10"].table_name == "/*" and by[1, "/rule 10"].fields == {"/function": "f10", "/origin/year": "10"} and by[1, "/rule 10"].types["/origin/year"] == "bigint"
    assert by[1, "/rule 10"].empties == ["/origin/place null", "/sub_rules/s {}"] and by[1, "/rule 10"].name == "rule 10" and by[1, "/rule 10"].parent_id == ""
    tag = by[1, "/rule 10/examples/0/tags/1"]
    assert (tag.table_name, tag.parent_id, tag.fields) == ("/*/examples/[]/tags/[]", "/rule 10/examples/0", {"": "u"})
    typed = {(r.id, r.row_id): r for r in S.typed_table(S.tables(df, "id", "t"), "id", "/*").collect()}
    assert len(typed) == 13 and typed[2, "/rule 21"].function == "f21" and typed[2, "/rule 21"]["origin/year"] == 21 and typed[9, "/*"].function is None
    cat = {(r.table_name, r.column_name, r.type): tuple(r)[1:] for r in S.catalogue(S.tables(df, "id", "t")).collect()}
    assert cat["/*/examples/[]", "/input", "string"] == ("/*", "/input", "string", 24, 24) and cat["/[]", "", "double"] == ("", "", "double", 1, 2)
    assert S.tables(df.limit(0), "id", "t", frozenset()).count() == 0 and S.open_contexts(df.limit(0), "t") == frozenset()
    columns = {r.leaf_path: r for r in S.columns_of(S.levels(df, "id", "t"), "id").collect()}
    assert columns["m e o k:function s"].n_records == 4 and columns["m e o k:function s"].n_lacking == 2 and columns["m e o k:function s"].n_values == 12


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01/v1_rules.parquet"), reason="no tables")
def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/v1_rules.parquet")
    got = sorted(tuple(r) for r in S.nodes(df, "file_id", "rules").select("file_id", "node_path", "parent_path").collect())
    want = sorted((r.file_id, *x) for r in df.collect() if r.rules for x in walk(json.loads(r.rules)))
    assert got == want


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01/v1_rules.parquet"), reason="no tables")
def test_whole_table_from_its_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/v1_rules.parquet")
    by = {}
    for r in S.tables(df, "file_id", "rules").collect():
        by.setdefault(r.file_id, []).append((r.table_name, r.row_id, {k: v if r.types[k] == "string" else json.loads(v) for k, v in r.fields.items()}, r.empties))
    want = {r.file_id: S.parse(r.rules) for r in df.collect() if S.parse(r.rules) is not None}
    assert {k: S.record_of(v) for k, v in by.items()} == want
