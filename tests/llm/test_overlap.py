import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import overlap as O


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(prev + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=30), st.lists(st.sampled_from("abc"), max_size=30), st.integers(0, 12))
def test_within(a, b, d):
    assert O.within(a, b, d) == (distance(a, b) <= d)
    if a and b:
        assert O._distance(a, b) == distance(a, b)


def test_words():
    assert O.words("The “old”\tDog-house, ﬁne!") == O.words("the old doghouse fine") and O.words("Dоg") == O.words("dog")
    assert O.words(None) == [] and O.words("… !") == []


def data(seed=1, n=400):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocab) for _ in range(rng.choice([3, 6, 7, 8, 9, 15, 16, 17, 24, 31, 40]))] for _ in range(60)]

    def edit(ws):
        ws = list(ws)
        for _ in range(rng.randint(0, len(ws) // 6)):
            i, how = rng.randrange(len(ws) + 1), rng.random()
            if how < 0.4:
                ws.insert(i, rng.choice(vocab))
            elif i < len(ws) and len(ws) > 1:
                ws[i : i + 1] = [rng.choice(vocab)] if how < 0.7 else []
        t = " ".join(ws)
        return t.upper() + " !" if rng.random() < 0.3 else t

    train = [(i, edit(rng.choice(base)), edit(rng.choice(base)) if rng.random() < 0.8 else None) for i in range(n)]
    test = [(10_000 + i, edit(rng.choice(base))) for i in range(80)]
    return train + [(n, "", "…"), (n + 1, None, None)], test + [(20_000, None), (20_001, ""), (20_002, " ?")]


def brute(train, test):
    out = set()
    for j, e in test:
        e = O.words(e)
        for i, *fields in train:
            for t in fields:
                w = O.words(t)
                if w and e and (w == e or distance(w, e) * 8 <= max(len(w), len(e))):
                    out.add((i, j))
    return out


def test_all_pairs(spark):
    train, test = data()
    a = spark.createDataFrame(train, "rec_id bigint, input string, output string").withColumns({c: F.lit("z") for c in ("id", "k", "n", "text", "h")})
    b = spark.createDataFrame(test, "rec_id bigint, input string").withColumns({c: F.lit("z") for c in ("id", "k", "n", "text", "h")})
    got = [tuple(r) for r in O.overlaps(a.repartition(3), b).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(train, test) and len(got) > 300
    assert O.overlaps(a.limit(0), b).count() == 0 and O.overlaps(a, b.limit(0)).count() == 0


def test_hot_text(spark):
    hot = "one two three four five six seven eight nine"
    a = spark.range(900).select(F.col("id").alias("rec_id"), F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat_ws(" ", F.lit("a b c d e f g"), F.col("id").cast("string"))).alias("input"), F.lit(None).cast("string").alias("output"))
    b = spark.createDataFrame([(5000, hot.replace("five", "5")), (5001, hot + "!"), (5002, "a b c d e f g")], "rec_id bigint, input string")
    got = O.overlaps(a, b)
    assert got.where("test_id = 5000").count() == 300 and got.where("test_id = 5001").count() == 300 and got.where("test_id = 5002").count() == 600


def test_long_texts(spark):
    rng = random.Random(2)
    long = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    other = list(long)
    for i in range(0, 20_000, 10):
        other[i] = "changed"
    a = spark.createDataFrame([(1, " ".join(long), None), (2, " ".join(reversed(long)), None)], "rec_id bigint, input string, output string")
    b = spark.createDataFrame([(9, " ".join(other)), (8, " ".join(long[:15_000]))], "rec_id bigint, input string")
    assert [tuple(r) for r in O.overlaps(a, b).collect()] == [(1, 9)]


def test_report(spark, rows):
    a = spark.createDataFrame([(1, "s", "a b"), (2, "t", "a b"), (3, None, "a b")], "rec_id bigint, _source string, input string").withColumn("output", F.lit("A, b!"))
    b = spark.createDataFrame([(7, "val", "A B"), (8, "test", "a, b"), (9, None, "a b")], "rec_id bigint, split_name string, input string")
    got = rows(O.report(O.linked(a, b, train_label="_source", test_label="split_name")))
    assert got == sorted([(y, x, 1, 1, 1) for y in ("val", "test", None) for x in ("s", "t", None)], key=repr)


def test_classes_and_report_against_pairs(spark):
    train, test = data()
    a = spark.createDataFrame(train, "rec_id bigint, input string, output string").withColumn("_source", F.concat(F.lit("s"), (F.col("rec_id") % 3).cast("string")))
    b = spark.createDataFrame(test, "rec_id bigint, input string").withColumn("split_name", F.when(F.col("rec_id") % 2 == 0, "val").otherwise("test"))
    want = brute(train, test)
    f = O.linked(a, b, train_label="_source", test_label="split_name")
    by = {}
    for i, j in want:
        t, e, n = by.setdefault(("val" if j % 2 == 0 else "test", f"s{i % 3}"), (set(), set(), []))
        t.add(i), e.add(j), n.append(1)
    assert sorted(tuple(r) for r in O.report(f).collect()) == sorted((*k, len(e), len(t), len(n)) for k, (t, e, n) in by.items())
    members = {}
    for r in O.classes(f).collect():
        members.setdefault((r.side, r.class_id), set()).add(r.rec_id)
    links = [tuple(r) for r in O.class_links(f).collect()]
    assert len(links) == len(set(links)) and {(i, j) for x, y in links for i in members["train", x] for j in members["test", y]} == want
    counts = {(r.side, r.rec_id, r.class_id): r.n_links for r in O.classes(f).collect()}
    assert all(n == sum(1 for link in links if link[side == "test"] == c) for (side, _, c), n in counts.items())
    empty = O.linked(a.limit(0), b)
    assert O.classes(empty).count() == 0 and O.class_links(empty).count() == 0 and O.report(empty).count() == 0


def test_signatures_lose_no_match():
    rng, s = random.Random(4), O.Shingler(None, 1)
    for _ in range(2_000):
        ws = [f"w{rng.randrange(50)}" for _ in range(rng.randint(7, 30))]
        other, d = list(ws), rng.randint(0, 3)
        for _ in range(d):
            at = rng.randrange(len(other))
            other[at : at + rng.randint(0, 1)] = [f"v{rng.randrange(50)}"] * rng.randint(0, 1)
        assert (s.signature(ws) ^ s.signature(other)) & (1 << 64) - 1 in range(1 << 64) and bin((s.signature(ws) ^ s.signature(other)) & (1 << 64) - 1).count("1") <= 2 * d
