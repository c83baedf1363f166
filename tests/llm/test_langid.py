import os
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid as L

WORDS = {
    "en": "the old hunter can carry the heavy basket under the tall tree before the rain and she will not open the door with the knife while the brave girl watches the river".split(),
    "es": "el viejo cazador lleva la cesta pesada debajo del árbol antes de la lluvia pero la mujer no abre la puerta con el cuchillo mientras la niña mira el río".split(),
    "ru": "старый охотник несёт тяжёлую корзину под деревом перед дождём но женщина не открывает дверь ножом пока девочка смотрит на реку".split(),
    "bld": "kpɛn shoŋgüü drömbaa vein nyü tsaŋ ŋgandɛr faawiŋ lüntsaal mbégba dulé vevrishüü kpunda rök njöŋ süli vraal mbakül gbüüŋ shözé".split(),
}


def sentences(lang, n, size=9, seed=0):
    rng = np.random.default_rng(seed + len(lang) * 7)
    w = WORDS[lang]
    return [" ".join(rng.choice(w, size)) + "." for _ in range(n)]


SAMPLES = {k: sentences(k, 60) for k in WORDS}


@pytest.fixture(scope="module")
def ident():
    return L.Identifier(SAMPLES)


def test_probabilities_sum_to_one(ident):
    """What the model gives the next characters sums to 1: to the seen ones, and the floor's share to all others."""
    alphabet = sorted({c for v in SAMPLES.values() for s in v for c in s.lower() if c.isalpha()})
    m = ident.models
    for ctx in ("", "t", "th", "hunt", "qq", "к"):
        at = len(ctx) + 1
        follow = np.array([m.logs([ctx + c])[0][at] for c in alphabet] + [m.logs([ctx])[0][at]])  # the last: the word ends
        unseen = np.exp(m.logs([ctx + "\u4e00"])[0][at])
        total = np.exp(follow).sum(axis=0) + unseen * (1 / m.floor - len(alphabet) - 1)
        assert np.allclose(total, 1, atol=1e-6), (ctx, total)
    hunter, nonsense = m.score(["hunter", "qzxqzx"])[:, ident.languages.index("en")]
    assert hunter > nonsense


def test_word_scores_add_up(ident):
    a, b = ident.models.score(["hunter", "rain"])
    assert np.allclose(ident.models.score(["rain", "hunter"])[0], b) and np.allclose(ident.models.score(["hunter"])[0], a)
    assert (ident.models.score([""]) == 0).all()


def test_held_out(ident):
    for lang in WORDS:
        for s in sentences(lang, 20, seed=99):
            segs = ident.segments([s])[0]
            assert [x[2] for x in segs] == [lang] and segs[0][3] > 0.9


def test_mixed_and_short(ident):
    en, es, ru = (sentences(k, 1, seed=5)[0] for k in ("en", "es", "ru"))
    assert [x[2] for x in ident.segments([f"{en} {ru}"])[0]] == ["en", "ru"]
    assert [x[2] for x in ident.segments([f"{ru} ({es}) {en}"])[0]] == ["ru", "es", "en"]
    assert [x[2] for x in ident.segments([en + " дверь"])[0]] == ["en"]  # a single foreign word is none
    assert ident.segments(["one two three", "", None, "   ", ". . . ."]) [:4] == [[], [], [], []]
    assert ident.segments([". , ; !"])[0][0][2] == "und"
    assert ident.segments(["qxzj wvkq zzxx jjqq vvkk"])[0][0][2] == "und"


def test_long_text(ident):
    text = " ".join([sentences("en", 1)[0]] * 7_000 + [sentences("ru", 1)[0]] * 3)
    segs = ident.segments([text])[0]
    assert [x[2] for x in segs] == ["en", "ru"] and segs[-1][1] == len(text.split())


def test_labels():
    assert [L.label(x) for x in (None, "", " UND ", "unknown", "en-GB", "English", "eng", "BLD ", "Balanda", "pt-BR", "xx", "Русский")] == [None] * 4 + ["en", "en", "en", "bld", "bld", "pt", "xx", "ru"]


def test_table(spark, rows):
    en, ru = sentences("en", 1, seed=3)[0], sentences("ru", 1, seed=3)[0]
    data = [(1, en, "EN", ru, "en"), (2, en, None, None, None), (3, f"{en} {ru}", "en", "short", "ru"), (4, "", "en", en, "English"), (None, ru, "und", None, None), (1, en, "EN", ru, "en")]
    df = spark.createDataFrame(data, "rec_id bigint, input string, il string, output string, ol string").withColumns({c: F.lit("z") for c in ("lang", "label", "seg_no", "field_name")})
    got = L.segments(df, "rec_id", {"input": "il", "output": "ol"}, SAMPLES, cases_only=True).drop("confidence")
    assert rows(got) == sorted([(1, "output", 0, "ru")] * 2 + [(2, "input", 0, "en"), (3, "input", 0, "en"), (3, "input", 1, "ru"), (None, "input", 0, "ru")], key=repr)
    every = L.segments(df, "rec_id", {"input": "il", "output": "ol"}, SAMPLES)
    assert every.count() == 9 and every.columns[-1] == "label"
    assert L.segments(df.limit(0), "rec_id", {"input": "il"}, SAMPLES).count() == 0


def test_texts_of_few_words(ident):
    got = ident.segments(["hunter", "la cesta pesada", "Старый охотник!", "kpɛn", "7 + 7", "", None, "  ", "hunter. дверь", "qxzj"], least=1)
    assert [[x[2] for x in s] for s in got[:4]] == [["en"], ["es"], ["ru"], ["bld"]] and all(0 < s[0][3] <= 1 for s in got[:4])
    assert got[4] == [(0, 3, "und", 0.0)] and got[5:8] == [[], [], []] and len(got[8]) == 1 and got[9][0][2] == "und"
    whole = [sentences(k, 1, seed=8)[0] for k in WORDS]
    assert ident.segments(whole, least=1) == ident.segments(whole)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001/train.parquet"), reason="no tables")
def test_every_text_with_letters_has_a_language(spark):
    from millrace.llm import queries as Q

    d = "/root/testdata/sf0.001"
    t = spark.read.parquet(f"{d}/train.parquet")
    texts = t.select("rec_id", F.lit("input").alias("field_name"), F.col("input").alias("t")).unionAll(t.select("rec_id", F.lit("output"), "output")).where(r"t RLIKE '\\p{L}'")
    assert texts.join(Q.QUERIES["p4_segments"](spark, d), ["rec_id", "field_name"], "left_anti").count() == 0
    few = Q.QUERIES["p4_found"](spark, d).join(texts, ["rec_id", "field_name"]).where(r"size(split(trim(t), '\\s+')) < 4")
    assert few.count() == 0


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001/lang_samples.parquet"), reason="no tables")
def test_accuracy_on_held_out_samples(spark):
    samples = L.load_samples(spark.read.parquet("/root/testdata/sf0.001/lang_samples.parquet"))
    fit = L.Identifier({k: [t for i, t in enumerate(v) if i % 4] for k, v in samples.items()})
    held = [(k, t) for k, v in samples.items() for i, t in enumerate(v) if i % 4 == 0]
    right = sum([x[2] for x in s] == [k] for (k, _), s in zip(held, fit.segments([t for _, t in held])))
    assert right >= 0.98 * len(held)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001/lang_samples.parquet"), reason="no tables")
def test_recall_of_runs_of_four_words(spark):
    samples = L.load_samples(spark.read.parquet("/root/testdata/sf0.001/lang_samples.parquet"))
    fit = L.Identifier({k: [t for i, t in enumerate(v) if i % 4] for k, v in samples.items()})
    held = {k: [[w.strip(".,;:!?¿¡«»\"()") for w in t.split()] for i, t in enumerate(v) if i % 4 == 0] for k, v in samples.items()}
    found = {}
    for a in held:
        for b in held:
            if a != b:
                texts = [" ".join(x + y[o : o + 4] + z) for x, y, z in zip(held[a], held[b], held[a][1:] + held[a][:1]) for o in range(len(y) - 3)]
                found.setdefault({a, b} == {"es", "pt"}, []).extend([r[2] for r in s] == [a, b, a] for s in fit.segments(texts))
    assert np.mean(found[False]) >= 0.97 and np.mean(found[True]) >= 0.5, {k: np.mean(v) for k, v in found.items()}
    whole = [" ".join(x + y) for v in held.values() for x, y in zip(v, v[1:])]
    assert all(len(s) == 1 for s in fit.segments(whole))


def test_long_texts_are_one_piece(ident):
    en, ru = sentences("en", 8_000, seed=1), sentences("ru", 3, seed=2)
    words = [w.strip(".") for s in en for w in s.split()][:49_998] + [w.strip(".") for s in ru for w in s.split()]
    segs = ident.segments([" ".join(words)])[0]
    assert [(a, z, lang) for a, z, lang, _ in segs] == [(0, 49_998, "en"), (49_998, len(words), "ru")]


def test_many_short_runs_are_merged_fast(ident):
    path = np.arange(100_000) % 2
    rng = np.random.default_rng(0)
    began = time.time()
    runs = ident._runs(path, list(range(1, len(path))), rng.normal(size=(len(path), 2)), np.ones(len(path)))
    assert time.time() - began < 5 and runs[0][0] == 0 and runs[-1][1] == len(path) and all(b - a >= L.RUN for a, b, _ in runs)


def test_cases_have_the_numbers_of_all_runs(spark, rows, monkeypatch):
    runs = [[(0, 4, "en", 0.9), (4, 8, "und", 0.0), (8, 12, "ru", 0.9)], [(0, 4, "en", 0.9), (4, 8, "und", 0.0)], [(0, 4, "und", 0.0)]]

    class Fake:
        segments = staticmethod(lambda texts, least: [runs[int(t)] for t in texts])

    monkeypatch.setattr(L, "identifier", lambda _: Fake())
    batch = pa.RecordBatch.from_pydict({"k": [1, 2, 3, 4], "t": ["0", "1", "1", "2"], "l": ["en", "en", "fr", None]})
    taken = []
    df = type("D", (), {"select": lambda self, *_: self, "mapInArrow": lambda self, f, ddl: taken.extend(f([batch]))})()
    monkeypatch.setattr(L, "spread", lambda d: d)
    monkeypatch.setattr(L.F, "col", lambda c: type("C", (), {"cast": lambda s, t: s, "alias": lambda s, a: s})())
    L.segments(df, "k", {"t": "l"}, {}, cases_only=True)
    assert [(r["k"], r["seg_no"], r["lang"]) for r in taken[0].to_pylist()] == [(1, 0, "en"), (1, 2, "ru"), (3, 0, "en")]
