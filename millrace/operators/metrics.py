"""Corpus scores: chrF++ (Popović 2015, 2017) and BLEU (Papineni et al. 2002).

n-gram statistics are taken for each pair where the pair is, so no n-gram is ever shuffled;
only a few sums for each partition and direction are.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread

CHAR_ORDER, WORD_ORDER, BETA = 6, 2, 2
BLEU_ORDER = 4
_WORD = re.compile(r"\w+|[^\w\s]")


def _grams(items, n: int) -> Counter:
    if n == 1:
        return Counter(items)
    if isinstance(items, str):
        return Counter([items[i : i + n] for i in range(len(items) - n + 1)])
    return Counter(zip(*(items[i:] for i in range(n))))


def _shared(a: Counter, b: Counter) -> int:
    """Clipped matches."""
    return sum(min(a[g], b[g]) for g in a.keys() & b.keys())


def chrf_orders(hyp: str, ref: str) -> list[tuple[str, int, int, int]]:
    """``(order, matches, hyp_total, ref_total)`` for c1..c6 over characters without white space and w1..w2 over
    words, with marks of punctuation as words."""
    out = []
    hc, rc = "".join(hyp.split()), "".join(ref.split())
    hw, rw = _WORD.findall(hyp), _WORD.findall(ref)
    for name, h, r, top in (("c", hc, rc, CHAR_ORDER), ("w", hw, rw, WORD_ORDER)):
        for n in range(1, top + 1):
            a, b = _grams(h, n), _grams(r, n)
            out.append((f"{name}{n}", _shared(a, b), max(len(h) - n + 1, 0), max(len(r) - n + 1, 0)))
    return out


def bleu_orders(hyp: str, ref: str) -> list[tuple[str, int, int, int]]:
    """``(order, clipped matches, hyp_total, ref_total)`` for 1..4 over case-sensitive words and marks."""
    h, r = _WORD.findall(hyp), _WORD.findall(ref)
    out = []
    for n in range(1, BLEU_ORDER + 1):
        a, b = _grams(h, n), _grams(r, n)
        out.append((str(n), _shared(a, b), max(len(h) - n + 1, 0), max(len(r) - n + 1, 0)))
    return out


def _pair_stats(pairs: DataFrame, per_pair) -> DataFrame:
    def run(batches):
        sums: dict[tuple[str, str], list[int]] = {}
        for b in batches:
            for d, h, r in zip(*(b.column(i).to_pylist() for i in range(3))):
                for order, m, nh, nr in per_pair(h or "", r or ""):
                    s = sums.setdefault((d, order), [0, 0, 0, 0])
                    s[0] += m; s[1] += nh; s[2] += nr; s[3] += 1  # noqa: E702
        rows = [(*k, *v) for k, v in sums.items()]
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), *(pa.array(c, pa.int64()) for c in cols[2:])], ["direction", "gram", "matches", "n_hyp", "n_ref", "pairs"])

    part = spread(pairs.select("direction", "hyp", "ref")).mapInArrow(run, "direction string, gram string, matches bigint, n_hyp bigint, n_ref bigint, pairs bigint")
    return part.groupBy("direction", "gram").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("matches", "n_hyp", "n_ref", "pairs")])


def chrf_stats(pairs: DataFrame) -> DataFrame:
    """``direction, gram, matches, n_hyp, n_ref, pairs`` of ``(direction, hyp, ref)``; NULL texts count as empty."""
    return _pair_stats(pairs, chrf_orders)


def bleu_stats(pairs: DataFrame) -> DataFrame:
    """Likewise for BLEU's four orders."""
    return _pair_stats(pairs, bleu_orders)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def chrf_score(stats: DataFrame) -> DataFrame:
    """``direction, n_pairs, chrf``: the mean F-score (beta 2) of the orders that both sides have, times 100, 4 decimals."""
    p, r = _ratio(F.col("matches"), F.col("n_hyp")), _ratio(F.col("matches"), F.col("n_ref"))
    f = F.when(p + r > 0, (1 + BETA**2) * p * r / (BETA**2 * p + r)).otherwise(F.lit(0.0))
    live = F.when((F.col("n_hyp") > 0) & (F.col("n_ref") > 0), f)
    return stats.groupBy("direction").agg(F.max("pairs").alias("n_pairs"), F.round(100 * F.coalesce(F.avg(live), F.lit(0.0)), 4).alias("chrf"))


def bleu_score(stats: DataFrame) -> DataFrame:
    """``direction, n_pairs, bleu`` times 100, 4 decimals.

    Smoothing: an order above the first without a match counts as half a match; without any
    unigram match, or with an order that has no n-gram at all, the score is 0.
    """
    n = F.col("gram").cast("int")
    by = stats.groupBy("direction").agg(
        F.max("pairs").alias("n_pairs"),
        F.sum(F.ln(F.when(F.col("n_hyp") > 0, F.greatest(F.col("matches").cast("double"), F.lit(0.5)) / F.col("n_hyp")))).alias("logs"),
        F.min("n_hyp").alias("least"),
        F.max(F.when(n == 1, F.col("matches"))).alias("m1"), F.max(F.when(n == 1, F.col("n_hyp"))).alias("h"), F.max(F.when(n == 1, F.col("n_ref"))).alias("r"),
    )
    brevity = F.when(F.col("h") < F.col("r"), F.exp(1 - F.col("r") / F.col("h"))).otherwise(F.lit(1.0))
    score = F.when((F.col("m1") > 0) & (F.col("least") > 0), 100 * F.exp(F.col("logs") / BLEU_ORDER) * brevity).otherwise(F.lit(0.0))
    return by.select("direction", "n_pairs", F.round(score, 4).alias("bleu"))


def eval_report(pairs: DataFrame, directions: DataFrame) -> DataFrame:
    """``direction, n_pairs, chrf, bleu`` (2 decimals) for each listed direction; 0 pairs and NULL scores where it has none."""
    c, b = chrf_score(chrf_stats(pairs)), bleu_score(bleu_stats(pairs)).drop("n_pairs")
    out = directions.join(c, "direction", "left").join(b, "direction", "left")
    return out.select("direction", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"), F.round("chrf", 2).alias("chrf"), F.round("bleu", 2).alias("bleu"))
