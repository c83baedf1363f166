import itertools

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import packing as P


def items(spark, sizes):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id bigint, n_tokens int").withColumns({c: F.lit(7) for c in ("size", "k", "n", "container_id", "piece_no")})
    return P.pieces(df, capacity=10)


def test_pieces(spark, rows):
    assert rows(items(spark, [0, None, 3, 10, 25])) == [(2, 0, 3), (3, 0, 10), (4, 0, 10), (4, 1, 10), (4, 2, 5)]


def test_containers(spark):
    sizes = [3, 7, 7, 3, 5, 5, 25, 1, 9, 10, 2, 8, 0, None, 6, 4]
    it = items(spark, sizes)
    got = P.containers(it, capacity=10).collect()
    fill = {}
    for r in got:
        fill[r.container_id] = fill.get(r.container_id, 0) + r["size"]
    assert len(got) == it.count() and max(fill.values()) <= 10 and sum(fill.values()) == sum(x or 0 for x in sizes)
    assert sorted(fill) == list(range(len(fill))) and len(fill) == 10  # 95 tokens need 10
    again = P.containers(it.repartition(7), capacity=10).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    u = P.unused(P.containers(it, capacity=10), 10).first()
    assert (u.n_items, u.n_containers, u.n_tokens, u.unused, u.least_containers) == (16, 10, 95, 5, 10)
    for f in (P.containers, P.bucket_batches):
        assert f(it.limit(0), capacity=10).count() == 0


def test_hot_length(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 4).otherwise(F.col("id") % 10 + 1).cast("int").alias("n_tokens"))
    u = P.unused(P.containers(P.pieces(df, capacity=10), capacity=10), 10).first()
    assert u.n_items == 4000 and u.n_containers <= 1.1 * u.least_containers


def test_buckets(spark):
    got = P.bucket_batches(items(spark, [3, 7, 7, 3, 5, 5, 25, 1, 9, 10, 2, 8]), capacity=10, buckets=3).collect()
    by = {}
    for r in got:
        assert r["size"] <= r.bucket_bound
        by.setdefault(r.container_id, []).append(r.bucket_bound)
    assert all(len(set(b)) == 1 and sum(b) <= 10 for b in by.values()) and len(by) == len(set(by))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=8, max_size=8), st.integers(1, 4))
def test_bounds_are_optimal(counts, k):
    h = np.array([0, *counts])
    used = [s for s in range(1, 9) if h[s]]
    if not used:
        assert P.bucket_bounds(h, k) == []
        return

    def padding(bounds):
        return sum(int(h[s]) * (min(b for b in bounds if b >= s) - s) for s in used)

    got = P.bucket_bounds(h, k)
    best = min(padding([*c, used[-1]]) for n in range(min(k, len(used))) for c in itertools.combinations(used[:-1], n))
    assert padding(got) == best and len(got) <= k


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=16, max_size=16))
def test_patterns_hold_every_item(counts):
    h = np.array([0, *counts])
    found = P.patterns(h)
    back = np.zeros_like(h)
    for p, m in found:
        assert m > 0 and sum(s * k for s, k in p.items()) <= 16
        for s, k in p.items():
            back[s] += k * m
    assert (back == h).all() and len(found) <= 3 * 16
    assert sum(m for _, m in found) <= 1 + 1.3 * -(-int((h * np.arange(17)).sum()) // 16)
