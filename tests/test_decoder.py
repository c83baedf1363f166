import json
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import constants as K
from millrace.functions import text as X
from millrace.operators import normalize
from millrace.plans import prepare, tree
from millrace.sources import decoder, files, staging

CASES = [
    ('{\n "a": 1\n}\n{"b":2}\n{"c":3}\n', 3), ('{"a":1}{"b":2}', 2), ('[{"a":1},3,{"b":2}]', 2), ('[[{"a":1}]]', 0), ('Section A\n{"a":1}\n', 1),
    ('3. Title\n{"a":1}\n', 1), ('{"a":1\n{"b":2}\n', 1), ("junk", 0), ("", 0), (" \n\t", 0), (None, 0), ('{"a":1,"a":2}', 1), ('{"a":1}\r\n{"b":2}\r\n', 2),
    ('"Label"\n{"a":1}', 1), ('{"a": NaN}', 1), ("[" * 100_000, 0),
]


@pytest.mark.parametrize("text,n", CASES)
def test_decoder(text, n):
    assert len(list(decoder.decode_values(text))) == n


def test_last_key_wins_and_flags():
    assert list(decoder.decode_values('{"a":1,"a":2}[{"b":"ŋ"}]')) == [(0, {"a": 2}, False), (1, {"b": "ŋ"}, True)]


@pytest.fixture()
def corpus(tmp_path):
    rec = '{{"instruction":"Translate from Balanda to English","input":"{0}","output":"{1}"}}\n'
    head = '{\n  "instruction_type": "grammar_rule",\n  "grammar_name": "past_tense",\n  "rules": {"k1": {"function": "f", "structure": "s.", "notes": "n"}, "k2": "text", "k3": {"function": "f"}}\n}\n'
    os.makedirs(tmp_path / "in" / "Noun + verb (+ object")
    (tmp_path / "in" / "a_v1.jsonl").write_text(head + rec.format("x", "y") + rec.format("x", "y") + rec.format("x2", "y2"))
    (tmp_path / "in" / "Noun + verb (+ object" / "place)_v1.jsonl").write_text(rec.format("x", "y") + "junk\n" + '{"instruction":"Identify noun","output":"z"}\n' + rec.format("q", "r"))
    (tmp_path / "in" / "only_header_v1.jsonl").write_text('{"instruction_type":"grammar_rule","grammar_name":"noun","rules":{}}')
    (tmp_path / "in" / "x_v1_corrected.jsonl").write_text(rec.format("no", "no"))
    return tmp_path


def test_pipeline(spark, corpus, rows):
    done = prepare.run(spark, str(corpus / "in"), str(corpus / "out"))
    assert rows(done.source_counts) == [("Noun + verb (+ object/place)_v1.jsonl", 2), ("a_v1.jsonl", 3), ("only_header_v1.jsonl", 0)]
    assert rows(done.dedup_stats) == [(7, 5, 2)]
    got = {(r._source, r.input): (r.output, r._itype) for r in done.records.collect()}
    assert got[("Noun + verb (+ object/place)_v1.jsonl", "x")] == ("y", "translate_b2e")  # the first path in order keeps it
    assert got[("a_v1.jsonl", "k1")] == ("k1 — f. n Structure: s..", "explain") and got[("a_v1.jsonl", "k3")] == ("k3 — f.", "explain")
    assert sum(done.valid.values()) == 5
    back = files.read_split(spark, str(corpus / "out"))
    assert {r.split for r in back.select("split").distinct().collect()} <= {"train", "validation", "test"} and back.count() == 5
    without = prepare.run(spark, str(corpus / "in"), augment_rules=False)
    assert rows(without.dedup_stats) == [(5, 3, 2)]


def test_no_input(spark, tmp_path):
    with pytest.raises(files.NoInput):
        files.read_whole(spark, str(tmp_path / "absent"))
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(files.NoInput):
        files.read_whole(spark, str(tmp_path))


def test_tree(spark, corpus, rows):
    report = tree.run(spark, str(corpus / "in"), str(corpus / "norm"))
    got = {r.path: (r.status, r.n_before, r.n_after) for r in report.collect()}
    assert got["a_v1.jsonl"] == ("converted", 3, 3) and got["Noun + verb (+ object/place)_v1.jsonl"] == ("header-inferred", 3, 3) and got["only_header_v1.jsonl"] == ("converted", 0, 0)
    text = (corpus / "norm" / "Noun + verb (+ object" / "place)_v1.jsonl").read_text()
    assert text.startswith('{\n  "instruction_type": "grammar_rule",\n  "grammar_name": "place)"') and '"instruction":"Identify the Balanda noun","input":"","output":"z"' in text and "Items covered: noun." in text
    again = tree.run(spark, str(corpus / "norm"), str(corpus / "norm2"))
    assert {r.status for r in again.collect()} == {"skipped"} or all(r.status in ("skipped", "converted") for r in again.collect())
    once_more = tree.run(spark, str(corpus / "norm"), str(corpus / "norm2"))
    assert {r.status for r in once_more.collect()} == {"skipped"}


def test_underscored_names(spark, tmp_path, rows):
    os.makedirs(tmp_path / "_d" / "e+ f")
    for name in ("_a_v1.jsonl", "b_v1.jsonl", "_d/e+ f/c_v1.jsonl", "_other.jsonl", ".hidden_v1.jsonl"):
        (tmp_path / name).write_text(f'{{"x":"{name} \u014b"}}')
    assert rows(files.read_whole(spark, str(tmp_path))) == sorted((n, f'{{"x":"{n} \u014b"}}') for n in ("_a_v1.jsonl", "b_v1.jsonl", "_d/e+ f/c_v1.jsonl"))
    os.remove(tmp_path / "b_v1.jsonl")
    assert files.read_whole(spark, f"file://{tmp_path}").count() == 2


def test_deep_objects():
    deep = '{"a":' * 4_000 + "1" + "}" * 4_000
    assert [decoder.dump(o) for _, o, _ in decoder.decode_values(deep + '\n{"b":2}')] == [deep, '{"b":2}']


def test_failures_are_reported(spark, corpus, monkeypatch, rows):
    failed = spark.createDataFrame([("a_v1.jsonl", None, None, None, "ERROR: x"), ("b_v1.jsonl", 0, '{"instruction":"i","input":"","output":"o"}', False, None)], "path string, ordinal int, obj string, in_array boolean, error string")
    monkeypatch.setattr(prepare.decoder, "parse_files", lambda _: failed)
    done = prepare.run(spark, str(corpus / "in"))
    assert rows(done.failures) == [("a_v1.jsonl", "ERROR: x")] and done.records.count() == 1
    monkeypatch.undo()
    (corpus / "in" / "deep_v1.jsonl").write_text('{"instruction":"i","input":"","output":' + "[" * 3_000 + "]" * 3_000 + "}")
    assert [r.path for r in prepare.run(spark, str(corpus / "in")).failures.collect()] == ["deep_v1.jsonl"]


def test_staging(spark, tmp_path):
    with staging.scope():
        path = staging.place(spark).removeprefix("file:")
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path) and staging.stage(spark.range(2)).count() == 2
    assert not os.path.exists(path)

    class Elsewhere:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})
            _jsc = type("J", (), {"sc": staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)})())})())})()

        conf = type("C", (), {"get": staticmethod(lambda *_: None)})()

    with pytest.raises(staging.NoSharedFolder):
        staging.folder(Elsewhere())


def test_file_plan_agrees_with_columns(spark):
    rng = random.Random(1)
    parts = ["Identify", "identify", "the", "Balanda", "balanda", "noun", " ", "  ", "\t", "\u00a0", "x_v2", ".jsonl", "_v1", "_v\u0663", "-", "/", K.B2E, "É", "\n"]
    texts = sorted({"".join(rng.choice(parts) for _ in range(rng.randint(0, 7))) for _ in range(5_000)})
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", X.canonical_instruction("t").alias("c"), X.grammar_name("t").alias("g")).collect():
        assert (tree.canonical(r.t), tree.name_of(r.t)) == (r.c, r.g), repr(r.t)
    shapes = [("instruction", "input", "output"), ("instruction", "output"), ("balanda", "english", "x"), ("type", "source", "target"), ("instruction",)]
    objs = [{**{k: rng.choice(texts) for k in rng.choice(shapes)}, **({"type": "translation_pair"} if n % 2 else {})} for n in range(200)]
    got = spark.createDataFrame([(n, json.dumps(o)) for n, o in enumerate(objs)], "n int, o string").select("n", normalize.normalize_record(F.col("o")).alias("r")).collect()
    assert {r.n: r.r and r.r.asDict() for r in got} == {n: tree.record(o) for n, o in enumerate(objs)}


def test_changed_files(spark, rows):
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, content string")
    old = spark.createDataFrame([("a", "1"), ("b", "2\n")], "path string, content string")
    assert rows(files.changed_files(new, old).select("path")) == [("b",), ("c",)]


def test_bad_file_does_not_stop(spark):
    source = spark.createDataFrame([("a_v1.jsonl", '{"instruction_type":"x","rules":{"k":null}}'), ("b_v1.jsonl", None), ("c", "")], "path string, content string")
    got = {r.path: r for r in tree.normalized(source).collect()}
    assert got["a_v1.jsonl"].status == "converted" and '"structure": "None"' in got["a_v1.jsonl"].content
    assert got["b_v1.jsonl"].status == "header-inferred" and got["c"].n_before == 0
    parsed = decoder.parse_files(source).where(F.col("error").isNotNull())
    assert parsed.count() == 0
