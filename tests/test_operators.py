import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import constants as K
from millrace.operators import augment, chat, classify, dedup, metrics, normalize, ranking, report, split, validate

REC = "rec_id bigint, _source string, instruction string, input string, output string"


def test_kind(spark):
    objs = ['{"instruction_type":"grammar_rule","instruction":1,"input":2,"output":3}', '{"instruction":null,"input":"","output":"x","z":1}', '{"type":"metadata"}', '{"instruction":"x"}', "[1]", "{bad", None, ""]
    df = spark.createDataFrame([(o,) for o in objs], "o string")
    assert [r[0] for r in df.select(classify.kind(F.col("o"))).collect()] == ["header", "record", "metadata", "other", "other", "invalid", "invalid", "invalid"]


def test_first_header_and_metadata(spark, rows):
    df = spark.createDataFrame([("p", 0, '{"type":"metadata","v":1}'), ("p", 1, '{"type":"metadata","v":2}'), ("p", 2, '{"instruction_type":"grammar_rule","v":3}'), ("p", 3, '{"instruction_type":"grammar_rule","v":4}'), ("q", 0, '{"grammar_name":"g"}')], "path string, ordinal int, obj string")
    assert rows(classify.first_header(df, [F.col("ordinal")]).select("ordinal")) == [(2,)]
    assert rows(classify.first_header(df, [F.col("ordinal")], loose=True).select("path", "ordinal")) == [("p", 2), ("q", 0)]
    assert rows(classify.last_metadata(df)) == [("p", '{"type":"metadata","v":2}')]


def test_record_shapes(spark, rows):
    objs = [
        {"instruction": "Identify noun", "input": "a", "output": "b", "x": 1}, {"instruction": "i", "output": "b"}, {"balanda": "a", "english": "b"},
        {"type": "translation_pair", "source": "a", "target": "b"}, {"instruction": "i"}, {"instruction": "i", "input": None, "output": "b", "balanda": "p", "english": "q"},
    ]
    df = spark.createDataFrame([(n, json.dumps(o)) for n, o in enumerate(objs)], "n int, obj string")
    assert rows(normalize.normalize_records(df, ["n"])) == [(0, "Identify the Balanda noun", "a", "b"), (1, "i", "", "b"), (2, K.B2E, "a", "b"), (3, K.B2E, "a", "b"), (5, "i", None, "b")]


@pytest.mark.parametrize("value,want", [
    ({}, ("", "", "")), ({"function": "f"}, ("f", "", "")), ({"statement": "s", "note": "n"}, ("my key", "s", "n")),
    ({"structure": "", "rule": "r", "l": ["a", 1, {"z": 1}]}, ("my key", "r", "a; 1")), ({"a": "x", "b": "y"}, ("my key", '{"a": "x", "b": "y"}', "x | y")),
    ("text", ("my key", "text", "")), (["a", 2, [3]], ("my key", "a; 2", "")), (3, ("my key", "3", "")), (True, ("my key", "True", "")), (None, ("my key", "None", "")),
    ({"function": None, "notes": ["a", "b"]}, ("", "", "a; b")),
])
def test_rule_values(value, want):
    assert normalize.rule_fields("my_key", value) == want


def test_deep_rules(spark):
    deep = "[" * 5_000 + "]" * 5_000
    df = spark.createDataFrame([("p", '{"rules": {"a": {"x": ' + deep + '}, "b": "\\ud800"}}')], "p string, h string")
    got = {r.rule: r for r in normalize.normalize_rules(df, "p", "h").collect()}
    assert got["a"].structure == '{"x": ' + deep + "}" and got["b"].structure == "?"


def test_normalize_rules_bad_headers(spark, rows):
    df = spark.createDataFrame([(1, "{bad"), (2, None), (3, '{"rules": [1]}'), (4, "[]"), (5, '{"rules": {"a_b": "t"}}')], "id bigint, h string")
    assert rows(normalize.normalize_rules(df, "id", "h")) == [(5, 0, "a_b", "a b", "t", "")]


def test_headers(spark, rows):
    df = spark.createDataFrame([("x/Noun list_v1.jsonl", '{"grammar_name":"","rules":{"a":1}}'), ("y_v2.jsonl", '{"grammar_name":"g","description":"d","rules":[1]}')], "p string, h string")
    got = {r.p: r for r in normalize.normalize_header(df, "p", "h").collect()}
    assert tuple(got["x/Noun list_v1.jsonl"])[1:4] == ("grammar_rule", "noun_list", "") and [tuple(r) for r in got["x/Noun list_v1.jsonl"].rules] == [("a", "a", "1", "")]
    assert tuple(got["y_v2.jsonl"])[1:] == ("grammar_rule", "g", "d", [], 0)
    meta = spark.createDataFrame([("a/Lex_v1.jsonl", '{"dataset":"My Set-x"}'), ("b.jsonl", "{}")], "p string, o string")
    assert rows(normalize.header_from_metadata(meta, "p", "o")) == [(p, "grammar_rule", name, f"Balanda lexicon extracted from {p.split('/')[-1]}.", [], 0) for p, name in (("a/Lex_v1.jsonl", "my_set-x"), ("b.jsonl", "b"))]
    recs = spark.createDataFrame([("n_v1.jsonl", "Identify Big noun"), ("n_v1.jsonl", "identify the big noun"), ("n_v1.jsonl", None), ("m_v1.jsonl", "x")], "p string, instruction string")
    got = {r.p: r for r in normalize.infer_header(recs, "p").collect()}
    assert [tuple(r) for r in got["n_v1.jsonl"].rules] == [("big_noun", "big noun", "", K.INFERRED_NOTE)] and got["n_v1.jsonl"].description.endswith("Items covered: Big noun, big noun.") and got["m_v1.jsonl"].n_rules == 0


def test_augment(spark):
    rules = {"k": {"function": "f", "structure": "s", "notes": "n"}, "k2": {"function": "f", "structure": "", "notes": ""}, "k3": {}, "k4": {"function": "f", "structure": "s."}, "k5": "x", "k6": {"function": None, "notes": 3}}
    h = json.dumps({"grammar_name": "past_tense", "rules": rules})
    df = spark.createDataFrame([("p", h), ("q", '{"rules": [1]}'), ("r", None)], "path string, h string")
    got = {r.input: r for r in augment.augment_rules(df, "path", "h").collect()}
    assert {k: r.output for k, r in got.items()} == {"k": "k — f. n Structure: s.", "k2": "k2 — f.", "k3": "k3 — .", "k4": "k4 — f. Structure: s..", "k6": "k6 — ."}
    assert got["k"].instruction == "Explain the Balanda tense k" and got["k"]._itype == "explain" and got["k4"].pos == 3


def data(spark, n=300, parts=3):
    out = [(i, f"s{i % 3 if i % 2 else 0}", "i" if i % 7 else None, str(i % 11), None) for i in range(n)]
    return spark.createDataFrame(out, REC).repartition(parts)


def test_dedup(spark, rows):
    df = data(spark)
    once = dedup.keep_first(df, [F.col("rec_id").asc()])
    ids = [r.rec_id for r in once.collect()]
    assert len(ids) == 22 and max(ids) < 77  # the first of each combination, NULLs equal
    assert rows(dedup.keep_first(once, [F.col("rec_id").asc()])) == rows(once)
    assert rows(dedup.keep_first(df.repartition(7), [F.col("rec_id").asc()])) == rows(once)
    assert rows(dedup.dedup_stats(df)) == [(300, 22, 278)] and rows(dedup.dedup_stats(df.limit(0))) == [(0, 0, 0)]
    clash = df.withColumn("n", F.lit(1)).withColumn("c", F.lit(2))
    assert dedup.keep_first(clash, [F.col("rec_id").asc()]).count() == 22


def test_positions_against_row_number(spark):
    df = data(spark, 500)
    got = {r.rec_id: (r.k, r.n) for r in ranking.positions(df, ["_source"], F.floor(F.col("rec_id") / 7), [F.col("rec_id")]).collect()}
    for s in ("s0", "s1", "s2"):
        ids = sorted(i for i in range(500) if f"s{i % 3 if i % 2 else 0}" == s)
        assert [got[i] for i in ids] == [(k + 1, len(ids)) for k in range(len(ids))]
    assert ranking.positions(df.limit(0), ["_source"], F.lit(0), [F.col("rec_id")]).count() == 0


def test_split_properties(spark, rows):
    df = data(spark).withColumn("split", F.lit("old")).withColumn("k", F.lit(1)).withColumn("n", F.lit(1))
    a = split.stratified_split(df, ["_source"], "rec_id")
    assert a.columns.count("split") == 1 and a.count() == 300 and {r.split for r in a.collect()} == set(K.SPLITS)
    assert rows(a) == rows(split.stratified_split(df.repartition(9), ["_source"], "rec_id"))
    assert rows(a.select("rec_id", "split")) != rows(split.stratified_split(df, ["_source"], "rec_id", seed=1).select("rec_id", "split"))
    assert split.stratified_split(df.limit(0), ["_source"], "rec_id").count() == 0
    assert split.split_leakage(a, ["input"]).count() == 11
    shuffled = split.seeded_shuffle(a, "rec_id", ["split"])
    assert sorted(r.rank for r in shuffled.where("split = 'val'").collect()) == list(range(1, a.where("split = 'val'").count() + 1))
    assert split.sample_pairs(a, "rec_id", ["split"], 4).count() == 12


def test_reports(spark, rows):
    a = split.stratified_split(data(spark), ["_source"], "rec_id")
    assert sum(r.n for r in report.split_summary(a).collect()) == 300 and report.split_summary(a.limit(0)).count() == 0
    files = spark.createDataFrame([("s0",), ("s1",), ("nothing",)], "file_path string")
    assert rows(report.source_counts(files, a)) == [("nothing", 0), ("s0", 200), ("s1", 50)]
    cross = report.itype_by_split(a.withColumn("t", F.lit("x")), F.col("t")).collect()
    assert cross[0].train + cross[0].val + cross[0].test == 300
    rep = spark.createDataFrame([(1, "a", "ERROR: x", 1, None), (2, "b", None, 2, 1), (3, "c", "header-inferred-from-records", 1, 1), (4, "d", "ERROR: y", 1, 1)], "report_id bigint, file_path string, file_status string, n_before int, n_after int")
    assert rows(report.status_report(rep)) == [("error", 2, 2, 1), ("header-inferred...", 1, 1, 1), ("unknown", 1, 2, 1)]
    assert report.status_report(rep.limit(0)).count() == 0


def test_latest_reports(spark, rows):
    rep = spark.sql("select * from values (1L,'a','header-inferred',1,1,timestamp'2025-01-02',timestamp'2025-01-02'), (2L,'a','converted',1,1,timestamp'2025-01-01',timestamp'2025-02-02'), (3L,'b','header-inferred',2,2,null,null) t(report_id,file_path,file_status,n_before,n_after,run_at,loaded_at)")
    assert rows(report.review_list(rep)) == [("a", 1, 1), ("b", 2, 2)]


def test_validate(spark, rows):
    good = '{"output":"o","instruction":"i","input":""}'
    df = spark.createDataFrame([("p", "\n".join([good, "", good, '{"instruction":"i"}', "nope", " "])), ("q", good + "\r\n"), ("r", ""), ("s", None)], "path string, content string")
    lines = validate.numbered_lines(df)
    assert rows(validate.validate_lines(lines, "line", ["path", "lineno"])) == [("p", 1, "ok"), ("p", 3, "ok"), ("p", 4, "keys"), ("p", 5, "invalid"), ("p", 6, "invalid"), ("q", 1, "ok")]


def test_written_lines(spark, tmp_path, rows):
    good = json.dumps({"output": "o" * 30, "instruction": "i", "input": ""}) + "\n"
    (tmp_path / "a.jsonl").write_text(good * 50 + "\n" + good * 49 + "nope\n" + good * 20 + '{"instruction":1}')
    (tmp_path / "b.jsonl").write_text(good * 3)
    (tmp_path / "c.jsonl").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")  # many blocks a file
    try:
        got = sorted((r.path.split("/")[-1], r.lineno or 0, r.status, r.n) for r in validate.written_lines(spark, str(tmp_path)).collect())
        assert got == [("a.jsonl", 0, "ok", 119), ("a.jsonl", 101, "invalid", 1), ("a.jsonl", 122, "keys", 1), ("b.jsonl", 0, "ok", 3)]
        with pytest.raises(validate.InvalidJsonl, match="a.jsonl:101: invalid"):
            validate.require_valid(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert validate.require_valid(spark, str(tmp_path / "b.jsonl")) == 3 and validate.require_valid(spark, str(tmp_path / "c.jsonl")) == 0


def test_labels(spark):
    df = spark.createDataFrame([("a", 1), ("long label", 2), (None, 3)], "l string, n int")
    assert report.label_width(df, "l") == 10 and [r.l for r in report.aligned(df, "l").collect()] == ["a" + " " * 9, "long label", " " * 10]
    assert report.label_width(df.limit(0), "l") == 0


def test_chat(spark):
    df = spark.createDataFrame([(1, "s", K.B2E, "in", " out "), (2, "s", K.E2B, "", "o"), (3, "s", "Explain x", None, None), (4, "s", None, None, "y")], REC)
    r = {x.rec_id: x for x in df.select("rec_id", chat.messages().alias("m"), chat.render(chat.messages(False), True).alias("p")).collect()}
    assert [m.role for m in r[1].m] == ["system", "user", "assistant"] and r[1].m[1].content == K.B2E + "\n\nin" and r[2].m[1].content == K.E2B and r[3].m[2].content == "" and r[4].m[1].content == ""
    assert r[2].p.endswith("<|im_start|>assistant\n") and r[2].p.count("<|im_start|>") == 3
    pairs = {x.rec_id: x for x in chat.eval_pairs(df).collect()}
    assert set(pairs) == {1, 2} and pairs[1].reference == "out" and pairs[1].direction == "b2e"
    b = chat.batch_slices(spark.createDataFrame([(i, "a") for i in range(20)], "id bigint, g string"), "id", ["g"])
    assert sorted(x.batch_no for x in b.collect()) == [0] * 8 + [1] * 8 + [2] * 4


def test_metrics(spark, rows):
    pairs = spark.createDataFrame([("b2e", "the cat sat on the mat", "the cat sat on the mat"), ("b2e", "a", "a"), ("e2b", "x y z", "p q"), ("e2b", None, "")], "direction string, hyp string, ref string")
    chrf, bleu = ({r[0]: r[2] for r in f.collect()} for f in (metrics.chrf_score(metrics.chrf_stats(pairs)), metrics.bleu_score(metrics.bleu_stats(pairs))))
    assert chrf["b2e"] == 100.0 and bleu["b2e"] == 100.0 and chrf["e2b"] == 0.0 and bleu["e2b"] == 0.0
    stats = {(r.direction, r.gram): tuple(r)[2:] for r in metrics.bleu_stats(pairs.repartition(3)).collect()}
    assert stats["b2e", "1"] == (7, 7, 7, 2) and stats["b2e", "4"] == (3, 3, 3, 2)
    directions = spark.createDataFrame([("b2e",), ("none",)], "direction string")
    assert [(r.direction, r.n_pairs, r.chrf) for r in metrics.eval_report(pairs, directions).orderBy("direction").collect()] == [("b2e", 2, 100.0), ("none", 0, None)]
    assert metrics.chrf_score(metrics.chrf_stats(pairs.limit(0))).count() == 0
