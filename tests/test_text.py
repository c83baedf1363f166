import pytest
from pyspark.sql import functions as F

from millrace.functions import constants as K
from millrace.functions import text as X
from millrace.operators import split


def one(spark, f, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


def test_instruction_type(spark):
    got = one(spark, X.instruction_type, K.B2E, K.E2B, "Identify noun", "Identifying nouns", "Explain x", "explain x", "", None)
    assert got == ["translate_b2e", "translate_e2b", "identify", "identify", "explain", "other", "other", "other"]


def test_canonical_instruction(spark):
    cases = {
        K.B2E: K.B2E, "Identify noun": "Identify the Balanda noun", "identify the balanda  noun": "Identify the Balanda noun",
        "Identify Balanda Balanda noun": "Identify the Balanda noun", "Identifying nouns": "Identifying nouns", "Explain x": "Explain x", "": "",
        "Identify\u00a0the noun \u3000": "Identify the Balanda noun",
    }
    got = one(spark, X.canonical_instruction, *cases, None)
    assert got == [*cases.values(), None]
    again = one(spark, X.canonical_instruction, *cases.values())
    assert again == list(cases.values())


def test_keyword_category(spark):
    cases = {"x_pronoun_list": "pronoun", "noun_adjective": "adjective", "noun_verb": "verb", "number_noun": "number", "past_modal_question": "modal", "PAST_THING": "tense", "misc": "grammar item", "": "grammar item"}
    assert one(spark, X.keyword_category, *cases, None) == [*cases.values(), None]


def test_names(spark):
    assert one(spark, X.grammar_name, "a/Past Tense-form_v12.jsonl", "x_v1.b_v2.jsonl", ".hidden", "nouns/Noun + verb (+ object/place)_v1.jsonl", "") == ["past_tense_form", "x_v1.b", ".hidden", "place)", ""]
    assert one(spark, X.humanize, "my_key-x_", None) == ["my key x", None]
    assert one(spark, X.strip, " \u00a0a b\u3000\t", "", None) == ["a b", "", None]


def test_opt_in_forms(spark):
    assert one(spark, X.nfc, "e\u0301", "abc", "", None) == ["é", "abc", "", None]
    assert one(spark, X.replace_digraph, "ng'a Ng'a", None) == ["ŋa Ŋa", None]
    assert one(spark, lambda c: X.truncate_words(c, 2), " a  b c", "", None) == ["a b", "", None]
    assert one(spark, X.short_status, "x" * 19, "x" * 18, None) == ["x" * 15 + "...", "x" * 18, None]


@pytest.mark.parametrize("n,sizes", [(1, (1, 0, 0)), (2, (1, 0, 1)), (3, (1, 1, 1)), (9, (7, 1, 1)), (10, (8, 1, 1)), (20, (18, 1, 1)), (21, (18, 1, 2)), (22, (18, 2, 2)), (41, (36, 2, 3)), (60, (54, 3, 3)), (141, (126, 7, 8))])
def test_split_sizes(spark, n, sizes):
    df = spark.createDataFrame([(i, None, "t") for i in range(n)], "id bigint, s string, t string")
    got = {r.split: r["count"] for r in split.stratified_split(df, ["s", "t"], "id").groupBy("split").count().collect()}
    assert tuple(got.get(x, 0) for x in K.SPLITS) == sizes


def test_nfc_in_sql(spark):
    X.register(spark)
    assert spark.sql("select nfc('e' || decode(unhex('CC81'), 'utf-8')) as x").first().x == "\u00e9"
