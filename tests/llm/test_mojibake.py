import pytest
from pyspark.sql import functions as F

from millrace.llm import mojibake as M

GOOD = ["", "plain", "Lutoru shovraa kpal kpanyombüŋ, “gɛn” – don’t", "LIÇÃO 36 NIÑO «É»", "Signs: Å, µ, £, Ã, °, ß, œ, Þ, €, Â.", "Мать забыл у реки. Её ёж", "La particule ndaal © 2024", "ŋ\u0301u é ö ü ɛ", "¿Qué? ¡Sí!", "Übung für große Häuser"]
SAMPLE = "Lutoru shovraa kpanyombüŋ yén nyü gɛn “ŋgé” – don’t"


@pytest.mark.parametrize("text", GOOD)
def test_proper_text_stays(text):
    assert M.restore(text) == (text, False, False)


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "cp1250", "cp1251", "cp437", "mac_roman", "cp850"])
def test_round_trip(encoding):
    def wrong(t):
        return "".join(bytes([b]).decode(encoding, "ignore") or chr(b) for b in t.encode())

    assert M.restore(wrong(SAMPLE)) == (SAMPLE, True, True)
    assert M.restore("Proper start. " + wrong("vrüüyü") + " proper end ŋü") == ("Proper start. vrüüyü proper end ŋü", True, True)


def test_marks_as_tails():
    assert M.restore("she says gedukpiЕ‹. The bЙ›yi") == ("she says gedukpiŋ. The bɛyi", True, True)
    assert M.restore("‹kpɛ› and „kpɛ‚") == ("‹kpɛ› and „kpɛ‚", False, False)


def test_twice():
    w = lambda t: "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in t.encode())
    assert M.restore(w(w("nyihél ‘gɛn’ düü"))) == ("nyihél ‘gɛn’ düü", True, True)


def test_cyrillic_read_as_another():
    text = "Девочка смотрит на свежие овощи у вождя пока мой брат починил забор"
    assert M.restore(text.encode("cp1251").decode("cp1252")) == (text, True, True)
    assert M.restore(text.encode("koi8_r").decode("cp1251")) == (text, True, True)
    assert M.restore("".join(bytes([b]).decode("cp1251", "ignore") or chr(b) for b in text.encode())) == (text, True, True)


@pytest.mark.parametrize("times", range(1, 8))
@pytest.mark.parametrize("encoding", ["cp1252", "cp850", "cp1251"])
def test_many_times(times, encoding):
    text = "é"
    for _ in range(times):
        text = "".join(bytes([b]).decode(encoding, "ignore") or chr(b) for b in text.encode())
    assert M.restore(f"caf{text} noir") == ("café noir", True, True)


@pytest.mark.parametrize("order", ["swap first", "swap last"])
def test_single_bytes_and_utf8_together(order):
    text = "Девочка смотрит на свежие овощи у вождя пока мой брат починил забор"
    swapped = lambda t: "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in t.encode("cp1251"))
    read = lambda t, e: "".join(bytes([b]).decode(e, "ignore") or chr(b) for b in t.encode())
    assert M.restore(read(swapped(text), "cp1252") if order == "swap first" else swapped(read(text, "cp1251").replace("\x98", "?")))[1]
    if order == "swap first":
        assert M.restore(read(swapped(text), "cp1252")) == (text, True, True)


@pytest.mark.parametrize("word", ["mañana", "corazón"])
@pytest.mark.parametrize("read_as,really", [("cp437", "cp1252"), ("cp850", "cp1252")])
def test_latin_single_bytes(word, read_as, really):
    got = M.restore("La " + word.encode(really).decode(read_as) + " es otro")
    assert got[0] == f"La {word} es otro" and got[1]


def test_proper_signs_and_names():
    for text in ("a±b", "Čačić Dvořák Wałęsa", "10µm x÷y", "Åäö x", "β-carotene", "don”t", "weiß·nicht", "Ελλάδα είναι", "日本語テキスト", "r²d m²ab ab©cd foo™bar", "Å¡"[:1] + ", Æ, Ø,"):
        assert not M.restore(text)[1], text


def test_no_piece_is_cut():
    for n in range(395, 404):
        assert M.restore("a" * n + "Ã©" + "b" * 500) == ("a" * n + "é" + "b" * 500, True, True)
    text = "a" * 10 + "&eacute;" + "b" * 600 + "Ã¼" + "c" * 300
    assert M.restore(text) == ("a" * 10 + "é" + "b" * 600 + "ü" + "c" * 300, True, True)


def test_whole_is_true_only_for_ordinary_text():
    assert M.restore("tailâ€ and Ã©t")[1:] == (True, False)  # a byte is lost
    assert M.restore("Â© Ã©t") == ("© ét", True, True)


def test_lost_and_escaped():
    assert M.restore("dr�f�ny") == ("dr�f�ny", True, False)
    assert M.restore("a \x92 b")[1]
    assert M.restore("caf&eacute; n\\u00fcy") == ("café nüy", False, False)
    assert M.restore("AT&T &c. R&D;") == ("AT&T &c. R&D;", False, False)


def test_long_texts():
    long = "vrÃ¼Ã¼" * 50_000
    assert M.restore(long) == ("vrüü" * 50_000, True, True)
    assert M.restore("proper ŋü " * 50_000)[1] is False


def test_table(spark, rows):
    df = spark.createDataFrame([(1, "vrÃ¼k"), (2, "ok ŋ"), (3, None), (4, ""), (5, "x�"), (1, "vrÃ¼k"), (None, "Ã©t")], "doc_id bigint, text string").withColumn("restored", F.lit(1))
    assert rows(M.found(df)) == [(1,), (1,), (5,), (None,)]
    assert rows(M.restored(df)) == [(1, "vrük", True), (1, "vrük", True), (5, "x�", False), (None, "ét", True)]
    assert M.found(df.limit(0)).count() == 0
