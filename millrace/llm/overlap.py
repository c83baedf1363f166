"""Records that occur in several splits, exactly or almost.

An exact prefix-filter join between the (smaller) evaluation side and training.  Two texts match if
they have the same words in the same order, or differ by at most one word in eight of the longer one.
Whatever d such edits do, a shingle of three words that they leave whole lies, in any common order,
among the 3 d + 1 first shingles of both texts, at positions no more than d apart.  So it suffices to
index those of the evaluation texts, rarest first, probe with those of training, and verify.  Before texts
are fetched for that, lengths, positions and a signature of the words, of which an edit changes at most
two bits, leave out what can't match: templated texts share shingles, but not their words.

Five-word shingles would lose matches here: one edit can touch every one of the four shingles of a
text of eight words.

The order is that of a frequency sketch of fixed size over the index's shingles.  Training texts are
held against it before anything is shuffled; slots that shingles share by chance cost time, never
results.  Equal texts are joined once and expanded at the end.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from ..sources.tables import spread
from .skeleton import clean

#: Words per shingle; one word in so many may differ; texts below this length only match exactly.
SHINGLE, ONE_IN, SHORTEST = 3, 8, 7
#: The sketches of the index have 2**bits bytes: at most 2**26 (64 MiB), whatever the data.
LEAST_BITS, MOST_BITS = 20, 26
_PART = 1 << 16
_SPREAD, _ALL, _POSITIVE = 0x9E3779B97F4A7C15, (1 << 64) - 1, (1 << 63) - 1

_BARE = re.compile(r"[^\w\s\u0300-\u036f]|_")


def words(text: str | None) -> list[str]:
    """The words that are compared: consistent characters, one case, no punctuation."""
    if not text:
        return []
    return _BARE.sub("", text.casefold() if text.isascii() else clean(text).casefold()).split()


def edits_allowed(n: int, m: int) -> int:
    """Words that two texts of ``n`` and ``m`` words may differ by."""
    return max(n, m) // ONE_IN


def most_edits(n: int) -> int:
    """The most that a text of ``n`` words may differ by from any other: a longer partner may add words."""
    return n // (ONE_IN - 1)


def within(a: list[str], b: list[str], d: int) -> bool:
    """The word edit distance is at most ``d``: common ends off, then dynamic programming in a band."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > d:
        return False
    lo, n, m = 0, len(a), len(b)
    while lo < n and lo < m and a[lo] == b[lo]:
        lo += 1
    while n > lo and m > lo and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    a, b = a[lo:n], b[lo:m]
    if not a or not b:
        return max(len(a), len(b)) <= d
    if d > 8:
        return _distance(a, b) <= d
    far = d + 1
    row = [j if j <= d else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [i if i <= d else far] + [far] * len(b)
        for j in range(max(1, i - d), min(len(b), i + d) + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
        if min(new) > d:
            return False
        row = new
    return row[-1] <= d


def _distance(a: list[str], b: list[str]) -> int:
    """Word edit distance by bit vectors (Myers 1999, Hyyrö 2003): one step of big integers a word."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for x in b:
        eq = at.get(x, 0)
        vertical = eq | down
        same = (((eq & up) + up) ^ up) | eq
        plus, minus = down | ~(same | up) & full, up & same
        score += 1 if plus & last else -1 if minus & last else 0
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        up, down = minus | ~(vertical | plus) & full, plus & vertical
    return score


class Shingler:
    """Prefixes of texts in a fixed order of all shingles: the rarest in the index first, then by hash.

    ``sketch`` holds, in 2**bits bytes, how often the index has the shingles of each slot: 0 for none, else
    the logarithm.  Shingles that the index lacks come first and can match nothing, so a text with more
    of them than its edits can touch is out at once.
    """

    def __init__(self, sketch: bytes | None, bits: int):
        self.sketch, self.shift = sketch, 64 - bits
        self.known: dict[str, int] = {}

    def _word(self, w: str) -> int:
        if len(self.known) > 500_000:
            self.known.clear()
        r = self.known[w] = xxhash.xxh64_intdigest(w) >> 3
        return r

    def shingles(self, ws: list[str]) -> list[int]:
        """The hashes of all shingles; none for texts that only match exactly."""
        if len(ws) < SHORTEST:
            return []
        known = self.known
        hs = [known.get(w) or self._word(w) for w in ws]
        return [(x * 31 + y * 1_000_003 + z * 998_244_353) & _POSITIVE for x, y, z in zip(hs, hs[1:], hs[2:])]

    def signature(self, ws: list[str]) -> int:
        """64 bits, each the parity of the words whose hash falls on it: an edit flips at most two."""
        known, bits = self.known, 0
        for w in ws:
            bits ^= 1 << ((known.get(w) or self._word(w)) & 63)
        return bits - (1 << 64) if bits >> 63 else bits

    def prefix(self, ws: list[str]) -> list[tuple[int, int]]:
        """``(hash, position)`` of those of the first 3 d + 1 shingles that the index has."""
        grams = self.shingles(ws)
        if not grams:
            return []
        sketch, shift = self.sketch, self.shift
        often = [sketch[(h * _SPREAD & _ALL) >> shift] for h in grams]
        room = SHINGLE * most_edits(len(ws)) + 1 - often.count(0)
        if room <= 0:
            return []
        return [(h, i) for _, h, i in heapq.nsmallest(room, ((c, h, i) for i, (c, h) in enumerate(zip(often, grams)) if c))]


def _key_hash(k: bytes) -> int:
    return int.from_bytes(k[:8], "little") >> 1


def key_of(ws: list[str]) -> bytes:
    """128 bits of a text's words."""
    return hashlib.md5(" ".join(ws).encode("utf-8", "surrogatepass")).digest()


_TEXT = pa.schema([("id", pa.int64()), ("k", pa.binary()), ("n", pa.int32()), ("text", pa.string()), ("label", pa.string())])
_TEXT_DDL = "id bigint, k binary, n int, text string, label string"


def _label(column: str | None):
    return (F.lit(None) if column is None else F.col(column)).cast("string").alias("__label")


def _texts(df: DataFrame, key: str, field: str, label: str | None) -> DataFrame:
    """``id, k, n, text, label`` of each text with at least one word."""

    def run(batches):
        for b in batches:
            out = []
            for i, t, name in zip(*(b.column(c).to_pylist() for c in range(3))):
                ws = words(t)
                if ws:
                    out.append((i, key_of(ws), len(ws), " ".join(ws), name))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TEXT.types)], schema=_TEXT)

    return df.select(F.col(key).cast("bigint"), field, _label(label)).mapInArrow(run, _TEXT_DDL)


def _all_shingles(distinct: DataFrame) -> DataFrame:
    """``h`` of every shingle of each text."""

    def run(batches):
        s = Shingler(None, 1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([h for t in b.column(0).to_pylist() for h in s.shingles(t.split(" "))], pa.int64())], ["h"])

    return distinct.select("text").mapInArrow(run, "h bigint")


def _prefixes(distinct: DataFrame, sketch, bits: int) -> DataFrame:
    """``k, n, sig, h, pos`` of each distinct text's prefix."""

    def run(batches):
        s = Shingler(sketch.value, bits)
        for b in batches:
            out: list[tuple] = []
            for k, n, t in zip(*(b.column(c).to_pylist() for c in ("k", "n", "text"))):
                ws = t.split(" ")
                found = s.prefix(ws)
                if found:
                    sig = s.signature(ws)
                    out += [(k, n, sig, h, p) for h, p in found]
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32()))], ["k", "n", "sig", "h", "pos"])

    return distinct.select("k", "n", "text").mapInArrow(run, "k binary, n int, sig bigint, h bigint, pos int")


def _sketch(values: DataFrame, bits: int) -> bytes:
    """How often each of 2**bits slots is hit by the hashes ``h``, as bytes: 0, or 1 + the base-2 logarithm.

    Counts are combined in the tasks, then by slot; the driver gets pieces of a fixed total size.
    """

    def slots(batches):
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            with np.errstate(over="ignore"):
                at, n = np.unique((h * np.uint64(_SPREAD)) >> np.uint64(64 - bits), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((at // _PART).astype(np.int32)), pa.array((at % _PART).astype(np.int32)), pa.array(n.astype(np.int64))], ["part", "slot", "n"])

    def dense(key, table):
        box = np.zeros(_PART, dtype=np.uint8)
        box[table.column("slot").to_numpy()] = 1 + np.log2(table.column("n").to_numpy()).astype(np.uint8)
        return pa.table({"part": [key[0].as_py()], "bits": [box.tobytes()]}, schema=pa.schema([("part", pa.int32()), ("bits", pa.binary())]))

    counted = values.select("h").mapInArrow(slots, "part int, slot int, n bigint").groupBy("part", "slot").agg(F.sum("n").alias("n"))
    out = bytearray(max(1 << bits, _PART))
    for r in counted.groupBy("part").applyInArrow(dense, "part int, bits binary").collect():  # a group has at most _PART rows, the result 2**bits bytes
        out[r.part * _PART : (r.part + 1) * _PART] = r.bits
    return bytes(out)


def _probe(train: DataFrame, key: str, fields: list[str], sketch, keys, bits: int, label: str | None) -> DataFrame:
    """``id, k, n, text, label`` of the training texts that may match: they are in ``keys``, or have a prefix in ``sketch``."""

    def run(batches):
        s, exact, shift = Shingler(sketch.value, bits), keys.value, 64 - bits
        for b in batches:
            ids, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            out = []
            for n in range(len(fields)):
                for i, t, name in zip(ids, b.column(n + 2).to_pylist(), labels):
                    ws = words(t)
                    if ws:
                        k = key_of(ws)
                        if exact[(_key_hash(k) * _SPREAD & _ALL) >> shift] or s.prefix(ws):
                            out.append((i, k, len(ws), " ".join(ws), name))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TEXT.types)], schema=_TEXT)

    return spread(train.select(F.col(key).cast("bigint").alias("id"), _label(label), *fields)).mapInArrow(run, _TEXT_DDL)


def _verified(pairs: DataFrame) -> DataFrame:
    """The pairs ``kt, ke`` whose texts ``tt, te`` are within the allowed distance."""

    def run(batches):
        for b in batches:
            keep = [within(x := a.split(" "), y := c.split(" "), edits_allowed(len(x), len(y))) for a, c in zip(b.column("tt").to_pylist(), b.column("te").to_pylist())]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("kt").filter(mask), b.column("ke").filter(mask)], ["kt", "ke"])

    return pairs.select("kt", "ke", "tt", "te").mapInArrow(run, "kt binary, ke binary")


@dataclass
class Linked:
    """Texts that match, by class (equal words): members of both sides and the pairs of classes."""

    train: DataFrame  # id, k, label: the members of classes that may match
    test: DataFrame  # id, k, label
    candidates: DataFrame  # kt, ke: pairs of different texts that are verified
    pairs: DataFrame  # kt, ke


def linked(train: DataFrame, test: DataFrame, key: str = "rec_id", train_fields: tuple[str, ...] = ("input", "output"), test_field: str = "input", train_label: str | None = None, test_label: str | None = None) -> Linked:
    """The classes of texts that match in any of ``train_fields``, and their pairs, each once.

    NULL, empty and wordless texts match nothing.  No candidate is dropped; equal texts are compared
    once.  An empty side gives no rows.  The labels are columns that the members keep.
    """
    spark = train.sparkSession
    evals = stage(_texts(test, key, test_field, test_label))
    one = lambda d: d.groupBy("k").agg(F.first("n").alias("n"), F.first("text").alias("text"))
    eval_texts = one(evals)
    words_there = evals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(MOST_BITS, max(LEAST_BITS, int(words_there).bit_length() + 4))
    sketch = spark.sparkContext.broadcast(_sketch(_all_shingles(eval_texts), bits))
    keys = spark.sparkContext.broadcast(_sketch(_key_hashes(evals), bits))
    index = _prefixes(eval_texts, sketch, bits)

    rows = stage(_probe(train, key, list(train_fields), sketch, keys, bits, train_label))
    train_texts = one(rows)
    probes = _prefixes(train_texts, sketch, bits).select(F.col("k").alias("kt"), F.col("n").alias("nt"), F.col("sig").alias("st"), "h", F.col("pos").alias("pt"))
    found = probes.join(index.select(F.col("k").alias("ke"), F.col("n").alias("ne"), F.col("sig").alias("se"), "h", F.col("pos").alias("pe")), "h")
    d = F.floor(F.greatest("nt", "ne") / ONE_IN)
    alike = F.bit_count(F.col("st").bitwiseXOR(F.col("se"))) <= 2 * d
    near = found.where((F.abs(F.col("nt") - F.col("ne")) <= d) & (F.abs(F.col("pt") - F.col("pe")) <= d) & alike & (F.col("kt") != F.col("ke"))).select("kt", "ke").distinct()
    with_texts = near.join(train_texts.select(F.col("k").alias("kt"), F.col("text").alias("tt")), "kt").join(eval_texts.select(F.col("k").alias("ke"), F.col("text").alias("te")), "ke")
    same = train_texts.select("k").join(eval_texts.select("k"), "k").select(F.col("k").alias("kt"), F.col("k").alias("ke"))
    return Linked(rows.select("id", "k", "label"), evals.select("id", "k", "label"), near, _verified(with_texts).unionAll(same))


def overlaps(train: DataFrame, test: DataFrame, key: str = "rec_id", train_fields: tuple[str, ...] = ("input", "output"), test_field: str = "input") -> DataFrame:
    """``train_id, test_id`` of each pair of rows whose texts match, once: the class form of :func:`classes` written out."""
    f = linked(train, test, key, train_fields, test_field)
    out = f.pairs.join(f.train.select(F.col("id").alias("train_id"), F.col("k").alias("kt")), "kt").join(f.test.select(F.col("id").alias("test_id"), F.col("k").alias("ke")), "ke")
    return out.select("train_id", "test_id").distinct()


def class_links(f: Linked) -> DataFrame:
    """``train_class, test_class``: pairs of classes that match; equal ids are equal texts."""
    name = lambda k: F.lower(F.hex(k))
    return f.pairs.select(name("kt").alias("train_class"), name("ke").alias("test_class"))


def classes(f: Linked) -> DataFrame:
    """``side, rec_id, class_id, n_links``: each row with a match, the class of its text and how many classes that is linked to.

    A training row whose input and output both match is in two classes.  Copies are members, not pairs: the
    result grows with rows and links between different texts only.
    """
    pairs = stage(f.pairs)  # narrow, read for both sides
    parts = []
    for side, rows, own, other in (("train", f.train, "kt", "ke"), ("test", f.test, "ke", "kt")):
        links = pairs.groupBy(F.col(own).alias("k")).agg(F.count(other).alias("n_links"))
        members = rows.select("id", "k").distinct().join(links, "k")
        parts.append(members.select(F.lit(side).alias("side"), F.col("id").alias("rec_id"), F.lower(F.hex("k")).alias("class_id"), "n_links"))
    return parts[0].unionAll(parts[1])


def _key_hashes(evals: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_key_hash(k) for k in b.column(0).to_pylist()], pa.int64())], ["h"])

    return evals.select("k").mapInArrow(run, "h bigint")


def report(f: Linked) -> DataFrame:
    """``split_name, _source, n_test, n_train, n_pairs``: overlaps per evaluation split and training source (the labels).

    Counted from classes: rows with the same classes and label are counted first, no pair of rows is made.
    """
    pairs = stage(f.pairs)  # read twice
    there = pairs.select(F.col("kt").alias("k")).distinct()
    rows = f.train.join(there, "k", "left_semi").groupBy("id", "label").agg(F.array_sort(F.collect_set("k")).alias("ks"))  # a row has a class a field
    alike = rows.groupBy(F.col("label").alias("_source"), "ks").agg(F.count(F.lit(1)).alias("m"))
    links = alike.select("_source", "ks", "m", F.explode("ks").alias("kt")).join(pairs, "kt").select("_source", "ks", "m", "ke").distinct()
    evals = f.test.groupBy(F.col("label").alias("split_name"), F.col("k").alias("ke")).agg(F.count(F.lit(1)).alias("c"))
    both = stage(links.join(evals, "ke"))
    by = ["split_name", "_source"]
    total = both.groupBy(*by).agg(F.sum(F.col("m") * F.col("c")).alias("n_pairs"))
    train = both.select(*by, "ks", "m").distinct().groupBy(*by).agg(F.sum("m").alias("n_train"))
    test = both.select(*by, "ke", "c").distinct().groupBy(*by).agg(F.sum("c").alias("n_test"))
    same = lambda a, b: a.join(b.select(F.struct(*[F.coalesce(c, F.lit("\u0000")).alias(c) for c in by]).alias("g"), b.columns[-1]), F.struct(*[F.coalesce(a[c], F.lit("\u0000")).alias(c) for c in by]) == F.col("g")).drop("g")
    return same(same(total, train), test).select(*by, "n_test", "n_train", "n_pairs")
