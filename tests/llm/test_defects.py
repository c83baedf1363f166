import os

import pytest
from pyspark.sql import functions as F

from millrace.llm import defects as D
from tests.llm.test_langid import SAMPLES, sentences

B2E, E2B = "Translate from Balanda to English", "Translate from English to Balanda"


@pytest.mark.parametrize("out,inp,want", [(None, "x", True), ("", "x", True), (" \u200b\t", "x", True), ("N/A", "x", True), ("[no output]", "x", True), ("???", "", True), ("—", "", True), ("nil", "Vraal nil tsaŋ", False), ("nil", "x", True), ("kpɛn", "x", False), ("7", "x", False), ("." * 100, "x", True)])
def test_empty(out, inp, want):
    assert D.is_empty(out, inp) is want


@pytest.mark.parametrize("out,inp,wanted,want", [
    ("Unknown", "kpɛn", "en", False), ("answer", "shoŋ gul", "en", False), ("Unknown", "kpɛn naŋ tsaŋ drö", "en", True), ("unknown", "the cat", "bld", True), ("[empty]", "kpɛn", "en", True), ("EMPTY", "kpɛn", "en", True),
    ("missing", "x missing y", "bld", False), ("nothing", "kpɛn", None, False), ("- " * 40 + "no answer" + " -" * 40, "x", "en", True), ("T\u00adO\u200bD\u200bO", "x", "en", True), ("empty the bag", "kpɛn", "en", False),
])
def test_placeholders_by_instruction(out, inp, wanted, want):
    assert D.is_empty(out, inp, wanted) is want


REFUSALS = [
    "I'm sorry, but I can't translate this sentence because the input is unclear.", "Regrettably it is not possible for me to complete the task.", "This is something I am not allowed to translate.",
    "My apologies, there is no translation I could offer for this input.", "Hmm, answering this prompt is outside what I may do", "I do not have enough knowledge of Balanda to respond", "As a language assistant, I don’t feel comfortable producing this text.",
    "I must decline: I won't be able to answer this question", "Lo siento, no puedo traducir esta frase.", "Je suis désolé, je ne peux pas répondre à cette demande.", "Извините, я не могу перевести это.", "Leider kann ich diese Anfrage nicht beantworten.", "Desculpe, não posso ajudar com este pedido.", "Samahani, siwezi kutafsiri sentensi hii.",
]
ANSWERS = [
    "Unfortunately the wet harp cannot burn the stool.", "I am sorry, but I cannot weave the quiet widow.", "I won't crack the hen because I am not allowed to push it.", "Sorry, we were not able to cover the wood quietly.",
    "The lost question did not push the white gate.", "I cannot answer the small cat above the roof.", "We want the question while Kozako will return the kitchen", "", "Он не могут нести корзину.",
]


@pytest.mark.parametrize("text", REFUSALS)
def test_refusals(text):
    assert D.is_refusal(D.clean(text))


@pytest.mark.parametrize("text", ANSWERS)
def test_no_refusals(text):
    assert not D.is_refusal(D.clean(text))


@pytest.mark.parametrize("i,a,o,want", [
    (B2E, "Kpɛn naŋ tsaŋ drö", "“KPƐN  NAŊ tsaŋ drö!”", True), (B2E, "a b", "Translate from Balanda to English: a b", True), (B2E, "a b", "Question: a b", True), (B2E, "a b", "a b a b", True),
    (B2E, "a b", "A b is here", False), (B2E, "", B2E, True), (B2E, None, "x", False), ("Identify the Balanda noun", "favuŋ", "favuŋ", False), ("Identify the Balanda noun", "Lék favuŋ", "favuŋ", False), (B2E, "a b c d e f", "a b c d", True),
])
def test_copy(i, a, o, want):
    w = D.norm(i)
    assert D.is_copy(w, D.norm(a), D.norm(o), w[0] == "identify") is want


def test_expected_language():
    got = [D.expected_language(x) for x in (B2E, E2B, "TRANSLATE  from balanda, to English...", "Identify the Balanda noun", "Explain the Balanda verb x", "Give an English sentence with the Balanda verb x", None, "", "Sing", "Translate to")]
    assert got == ["en", "bld", "en", "bld", "en", "en", None, None, None, None]


def test_breaks_off():
    assert D.breaks_off("The dog sat on the") == "the" and D.breaks_off("The dog sat. The cat…") == "cat" and D.breaks_off("One") == "no" and D.breaks_off("A b c.") == "no"
    assert D.breaks_off("The “old dog saw the cat") == "yes" and D.breaks_off("A “b c”.") == "no" and D.breaks_off("x — y. Structure: [a] + x +") == "yes" and D.breaks_off("x — y. Structure: [a] + x + [b]") == "no"
    assert D.breaks_off("He came and the small pond") == "yes" and D.breaks_off("") == "no"


def table(spark):
    whole = [s[:-1] + m for n, s in enumerate(sentences("en", 400, seed=11)) for m in [". " if n % 3 else ""]]
    inputs = sentences("bld", 400, seed=12)
    end = ["knife", "river", "tree", "rain", "door", "basket"]
    data = [(n, B2E, i, " ".join([*(w for w in o.strip(". ").split() if w not in D._JOINERS), "the", end[n // 3 % 6] + ("." if n % 3 else "")])) for n, (o, i) in enumerate(zip(whole, inputs))]
    ru = sentences("ru", 1)[0]
    bad = [
        (1001, B2E, "x y", None, "empty"), (1002, B2E, "x y", "TODO", "empty"), (1003, B2E, "x y", REFUSALS[0], "refusal"), (1004, B2E, inputs[0], inputs[0], "copy"), (1005, B2E, inputs[0], ru, "other_language"),
        (1006, B2E, inputs[0], "the old hunter can carry the", "truncated"), (1007, B2E, inputs[0], "the girl will not open the kni", "truncated"), (1008, E2B, "x", data[0][3], "other_language"),
    ]
    rows = data + [b[:4] for b in bad]
    return spark.createDataFrame(rows, "rec_id bigint, instruction string, input string, output string"), {b[0]: b[4] for b in bad}


def test_found(spark):
    df, want = table(spark)
    clash = df.withColumns({c: F.lit("z") for c in ("defect", "own", "word", "ends", "inside")})
    got = {r.rec_id: r.defect for r in D.found(clash.repartition(3), SAMPLES).collect()}
    assert got == want
    every = {(r.rec_id, r.defect) for r in D.defects(df, SAMPLES).collect()}
    assert {(1004, "copy"), (1004, "other_language")} <= every and set(want.items()) <= every
    assert D.found(df.limit(0), SAMPLES).count() == 0


def test_answers_of_few_words_in_another_language(spark):
    noun = "Identify the Balanda noun"
    data = [(1, noun, "kpɛn naŋ tsaŋ", "корзину"), (2, noun, "kpɛn naŋ tsaŋ", "kpɛn"), (3, B2E, "kpɛn naŋ", "la cesta pesada"), (4, B2E, "kpɛn naŋ", "the heavy basket."), (5, noun, "kpɛn rain tsaŋ", "77"), (6, B2E, "kpɛn", "no")]
    df = spark.createDataFrame(data, "rec_id bigint, instruction string, input string, output string")
    assert sorted((r.rec_id, r.defect) for r in D.defects(df, SAMPLES).collect() if r.defect == "other_language") == [(1, "other_language"), (3, "other_language")]


def test_truncated_whatever_the_instruction(spark):
    df, _ = table(spark)
    noun, cut, ru = "Identify the Balanda noun", "the girl will not open the kni", sentences("ru", 1)[0].rstrip(".")
    more = [(2001, None, "x y", cut), (2002, "Render this", "x y", cut), (2003, noun, "kpɛn shoŋgüü naŋ", "shoŋg"), (2004, noun, "kpɛn shoŋgüü naŋ", "Shoŋgüü"), (2005, None, "x y", ru + " дождё"), (2006, noun, "kpɛn shoŋgüü naŋ", "“shoŋgüü naŋ"), (2007, "Render this", "x y", cut[:-3] + "river")]
    got = {r.rec_id: r.defect for r in D.found(df.unionAll(spark.createDataFrame(more, df.schema)), SAMPLES).where("rec_id > 2000").collect()}
    assert got == {2001: "truncated", 2002: "truncated", 2003: "truncated", 2006: "truncated"}


HELD_OUT = [
    "Sorry, but this request is not something I can help with, so I cannot fulfil it.", "I apologise, but I'm unable to provide an answer to this question.", "I'm not able to assist with that request.", "I cannot comply with this instruction.",
    "As an AI language model, I can't translate that.", "I won't translate this text.", "Je suis désolée, mais je ne peux pas vous aider avec cette demande.", "Malheureusement, il m'est impossible de traduire ce texte.", "Je dois décliner cette requête.",
    "Lamento no poder ayudarte con esta petición.", "Lamentablemente no puedo responder a esta pregunta.", "Me niego a traducir este texto.", "Infelizmente não consigo traduzir esta frase.", "Lamento, mas não posso ajudar com esta tarefa.",
    "Es tut mir leid, aber ich kann diesen Text nicht übersetzen.", "Ich darf diese Frage nicht beantworten.", "Samahani, siwezi kujibu swali hili.", "Kwa bahati mbaya sitaweza kukusaidia.", "К сожалению, я не смогу ответить на этот вопрос.", "Извините, но я отказываюсь переводить этот текст.",
]


def test_held_out_refusals():
    """Phrases that the lists were not made from."""
    assert sum(map(D.is_refusal, HELD_OUT)) >= 0.9 * len(HELD_OUT), [x for x in HELD_OUT if not D.is_refusal(x)]


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001/lang_samples.parquet"), reason="no tables")
def test_samples_are_no_refusals(spark):
    assert not [r.sample_text for r in spark.read.parquet("/root/testdata/sf0.001/lang_samples.parquet").collect() if D.is_refusal(r.sample_text)]


def test_long_identify_answers_are_judged(spark):
    df, _ = table(spark)
    more = [(3001, "Identify the Balanda noun", "x y", "the girl will not open the kni"), (3002, "Identify the Balanda noun", "x y", "the old girl will not open the door")]
    got = {r.rec_id for r in D.defects(df.unionAll(spark.createDataFrame(more, df.schema)), SAMPLES).where("rec_id > 3000 and defect = 'truncated'").collect()}
    assert got == {3001}


def test_word_endings(spark):
    df = spark.createDataFrame([("a cat. a dog! the cat", None), ("the cat.", "ŋgɛ cat"), ("", "  ")], "x string, y string")
    got = {(r.own, r.word): (r.ends, r.inside) for r in D.word_endings(df.repartition(3), ["x", "y"]).collect()}
    assert got == {(False, "cat"): (2, 0), (False, "dog"): (1, 0), (False, "a"): (0, 2), (False, "the"): (0, 2), (True, "ŋgɛ"): (0, 1)}
