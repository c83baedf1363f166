import json
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import formatting

REC = "rec_id bigint, instruction string, input string, output string"


def canon(t):
    t = "".join(c for c in t or "" if unicodedata.category(c)[0] != "P")
    return re.sub(r"\s+", " ", t.upper().lower()).strip()


def brute(rows):
    groups = {}
    for i, *f in rows:
        groups.setdefault(tuple(map(canon, f)), []).append(i)
    return sorted(((min(g), i) for g in groups.values() for i in g if i != min(g)), key=repr)


ROWS = [
    (5, "Translate", "A  b", "c."), (3, "translate!", "a b", "C"), (9, "“translate”", " a\u00a0b\n", "c…"), (7, "translate", "a b", "d"), (1, None, None, None), (2, "", "…", " "),
    (4, "x", "straße", "y"), (6, "X", "STRASSE", "y"), (8, "x y", "", "z"), (10, "x", "y", "z"), (11, "Translate", "A  b", "c."), (12, "x" * 100_000, "", ""), (13, "X" * 100_000 + "!", None, ""),
]


@pytest.mark.parametrize("broadcast", [formatting.BROADCAST, 0])
def test_copies(spark, rows, monkeypatch, broadcast):
    monkeypatch.setattr(formatting, "BROADCAST", broadcast)
    df = spark.createDataFrame(ROWS, REC)
    assert rows(formatting.copies(df)) == brute(ROWS)
    assert (8, 10) not in rows(formatting.copies(df))  # fields don't run into each other
    groups = dict(rows(formatting.groups(df)))
    assert groups[3] == 4 and groups[1] == 2 and sum(groups.values()) == len(ROWS)


def test_clashing_columns_repeats_and_empty(spark, rows):
    df = spark.createDataFrame(ROWS, REC).withColumns({c: F.lit(1) for c in ("n", "m", "raw", "c", "canonical", "first_id", "keep_id", "dup_id")})
    assert rows(formatting.copies(df)) == brute(ROWS)
    assert rows(formatting.copies(df.unionAll(df)).distinct()) == brute(ROWS)
    assert formatting.copies(df.limit(0)).count() == 0 and formatting.groups(df.limit(0)).count() == 0
    null_id = df.select(F.lit(None).cast("bigint").alias("rec_id"), "instruction", "input", "output")
    assert formatting.copies(null_id).count() == 0


def test_hot_group(spark):
    df = spark.range(3000).select(F.col("id").alias("rec_id"), F.lit("i").alias("instruction"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("Hot "), F.repeat(F.lit("!"), (F.col("id") % 7).cast("int")))).otherwise(F.col("id").cast("string")).alias("input"), F.lit("o").alias("output"))
    got = formatting.copies(df.repartition(6))
    assert got.count() == 999 and got.select("keep_id").distinct().count() == 1


def test_parsed_lines(spark, rows):
    good = {"instruction": "i", "input": None, "output": "é", "tags": [1]}
    lines = [json.dumps(good), json.dumps(good)[:-3], json.dumps(good) + " x", "[1]", "", None, '{"instruction": 3, "output": {"a": 1}}', '{"output": "a", "output": "b"}', '{"output": "\\ud800"}']
    df = spark.createDataFrame(list(enumerate(lines)), "rec_id bigint, raw_line string")
    assert rows(formatting.parsed(df)) == [(0, "i", None, "é"), (6, "3", None, '{"a": 1}'), (7, None, None, "b"), (8, None, None, "?")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a b", "A  B!", "a", "ab", "", None, "Ŋ", "ŋ."]), st.sampled_from(["x", "X-", None, " "]), st.sampled_from(["é", "É", "é"])), min_size=1, max_size=40))
def test_against_brute_force(spark, texts):
    data = [(i, *t) for i, t in enumerate(texts)]
    assert sorted((tuple(r) for r in formatting.copies(spark.createDataFrame(data, REC)).collect()), key=repr) == brute(data)


def test_deep_values(spark):
    deep = "[" * 6_000 + "1" + "]" * 6_000
    df = spark.createDataFrame([(1, '{"instruction": "i", "input": ' + deep + ', "output": "o"}'), (2, '{"output": "O!", "input": ' + deep + ', "instruction": "I"}')], "rec_id bigint, raw_line string")
    got = formatting.parsed(df)
    assert {r.rec_id: r.input for r in got.collect()} == {1: deep, 2: deep} and [tuple(r) for r in formatting.copies(got).collect()] == [(1, 2)]
