import unicodedata as ud

import pytest
from pyspark.sql import functions as F

from millrace.llm import confusables
from millrace.llm import skeleton as S

CASES = ["e\u0301 x", "ｆｕｌｌ text", "ﬁne", "zero\u200bwidth", "\ufeffbom", "no\u00a0break", "thin\u2009space", "ideographic\u3000space", "soft\u00adhyphen", "pаy", "Тhe dog", "ǌuvo", "Наш сосед cторожит лодку", "οmega in Latin: οf", "The саr is red", "x\ufeff", "Ι trust him"]
PROPER = ["", "plain", "“quotes” – dashes… ‘x’", "Мать несёт лодку у вождя", "English and (Мать у реки и с братом) more", "ŋ\u0301u kpɛn naŋ", "Straße œuvre ça", "tab\tand\nline", "Καλημέρα κόσμε", "½ № ™ ©", "日本語 テスト"]


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    assert S.is_case(text)
    assert not S.is_case(S.clean(text)) and S.clean(S.clean(text)) == S.clean(text)


@pytest.mark.parametrize("text", PROPER)
def test_proper(text):
    assert not S.is_case(text) and S.clean(text) == text


def test_clean_forms():
    assert S.clean("ｆｕｌｌ\u3000ﬁne\u200b e\u0301 pаy ǌ") == "full fine é pay nj"
    assert S.clean("Наш сосед cторожит") == "Наш сосед сторожит"
    assert S.skeleton("pаy") == S.skeleton("pay") == "pay" and S.skeleton("") == ""


def test_found_and_groups(spark, rows):
    data = [(1, "pаy", None), (2, "pay", ""), (3, None, "zero\u200bwidth"), (4, "pay", "x" * 300_000 + "\u00a0"), (None, "ﬁ", "ok")]
    df = spark.createDataFrame(data, "rec_id bigint, input string, output string").withColumns({c: F.lit("z") for c in ("k", "t", "s", "n", "field_name", "text")})
    assert rows(S.found(df, "rec_id", ["input", "output"])) == [(1, "input"), (3, "output"), (4, "output"), (None, "input")]
    assert (1, "input", "pay") in rows(S.cleaned(df, "rec_id", ["input", "output"]))
    got = S.groups(df, "rec_id", ["input", "output"]).collect()
    assert len(got) == 1 and (got[0].n_texts, got[0].n_rows, got[0].first_id) == (2, 3, 1)
    assert S.found(df.limit(0), "rec_id", ["input"]).count() == 0 and S.groups(df.limit(0), "rec_id", ["input"]).count() == 0


@pytest.mark.parametrize("text,plain", [("hՕuse here is big", "hOuse here is big"), ("the Ꭺpple is big", "the Apple is big"), ("ꓮpple pie", "Apple pie"), ("wⲟrd by word", "word by word"), ("an օօ sound of words", "an oo sound of words")])
def test_other_scripts(text, plain):
    assert S.is_case(text) and S.clean(text) == plain and S.skeleton(text) == S.skeleton(plain)


def test_other_scripts_where_they_belong():
    for text in ("Մենք խոսում ենք հայերեն", "հայերեն is a language", "the letter Օ here", "Tシャツ is nice", "هو يقرأ الكتاب", "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ", "ꓡꓲ-ꓢꓴ ꓥꓳꓰ"):
        assert not S.is_case(text) and S.clean(text) == text, text


def test_every_listed_letter_shares_its_skeleton():
    for c, latin in S._LATIN_OF.items():
        assert S.skeleton(c) == S.skeleton(latin), c
    for a, b in (("ⅼ", "l"), ("ɑ", "a"), ("Օ", "O"), ("Ꭺ", "A"), ("ꓮ", "A"), ("rn", "m"), ("１", "l"), ("ﬁ", "fi"), (" ", " "), ("x​y", "xy")):
        assert S.skeleton(a) == S.skeleton(b)


def test_published_table_against_the_library(spark):
    table = confusables.table()
    assert len(table) > 6_000
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    own = lambda t: ud.normalize("NFD", "".join(table.get(c, c) for c in ud.normalize("NFD", t)))
    for c in sorted(table)[::7]:
        if ud.category(c) not in ("Cf", "Cn"):  # the library drops what is ignorable
            t = f"ab{c}d"
            assert checker.getSkeleton(0, t) == own(t), repr(t)
