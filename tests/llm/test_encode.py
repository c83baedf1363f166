import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import encode as E

TEXTS = ["", "plain text", "don't we'll I'm", "Ŋgɛ kpɛn ü", "a" * 3000, " " * 2000 + "x", "word " * 1500, "\n" * 999 + "z" * 999 + " " * 500, "日本語" * 400, "1234567890" * 200, "<|endoftext|> x", "🙂" * 300]


@pytest.mark.parametrize("size,overlap", [(50, 20), (200, 7), (1000, 64), (7, 3)])
def test_chunks_equal_whole(size, overlap):
    c = E.codec()
    for t in TEXTS:
        assert E.encode_text(t, size=size, overlap=overlap) == c.encode(t)
        assert c.decode(c.encode(t)).decode() == t


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab ŋ'.1\n\tstélrev", max_size=300), st.integers(3, 40), st.integers(0, 15))
def test_any_text(text, size, overlap):
    assert E.encode_text(text, size=size, overlap=overlap) == E.codec().encode(text)


def test_contractions_at_every_cut():
    text = "we'll they're I've 'll''re 've " * 20
    for size in range(3, 40):
        for overlap in (0, 1, 2, 5):
            assert E.encode_text(text, size=size, overlap=overlap) == E.codec().encode(text)


def test_runs_without_boundaries_are_linear():
    took = []
    for n in (1 << 18, 1 << 20):
        text = "ab" * (n // 2) + " end"
        began = time.time()
        got = E.encode_text(text)
        took.append(time.time() - began)
        assert got == E.codec().encode(text)
    assert took[1] < 1.5 and took[1] < 10 * took[0] + 0.2


def test_matches_other_library():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    for x in TEXTS:
        assert t.encode(x, add_special_tokens=False).ids == E.codec().encode(x)


def test_table(spark, rows):
    rng = random.Random(3)
    long = ["".join(rng.choice(["ka ", "ŋü", "x", "\n", "don't ", "  "]) for _ in range(400)) for _ in range(20)]
    data = [(i, t) for i, t in enumerate([*TEXTS, *long, None])] + [(0, "again"), (4, TEXTS[4]), (4, TEXTS[4])]
    df = spark.createDataFrame(data, "doc_id bigint, text string").withColumns({c: F.lit("z") for c in ("ids", "n", "h", "t", "ends", "n_tokens")})
    c = E.codec()
    want = sorted((i, tuple(c.encode(t or ""))) for i, t in data)
    got = E.encode(df.repartition(5), size=100, overlap=16)
    assert sorted((r.doc_id, tuple(r.ids)) for r in got.collect()) == want
    assert sorted(tuple(r) for r in E.token_counts(df, size=100, overlap=16).collect()) == sorted((i, len(x)) for i, x in want)
    back = {r.doc_id: r.text for r in E.decode(got.where("doc_id > 4")).collect()}
    assert back == {i: t or "" for i, t in data if i > 4}
    assert E.encode(df.limit(0)).count() == 0


def test_other_tokenizer(spark):
    df = spark.createDataFrame([(1, "straße ŋü")], "doc_id bigint, text string")
    r = E.encode(df, name="byte_bpe_multi_50k").first()
    assert E.codec("byte_bpe_multi_50k").decode(r.ids).decode() == "straße ŋü"
