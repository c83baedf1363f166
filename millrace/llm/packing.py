"""Filling containers of fixed capacity with items of varying length.

Everything is decided on the global histogram of item lengths, which has at most ``capacity`` bins
whatever the number of items; the driver sees nothing else.  Items then find their container from
their rank among items of their length (or bucket), which is computed in hash buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import hash_bucket, positions

CAPACITY, BUCKETS = 2_048, 64


def pieces(sizes: DataFrame, key: str = "doc_id", n: str = "n_tokens", capacity: int = CAPACITY) -> DataFrame:
    """``key, piece_no, size``: items no longer than the capacity.  Longer ones give full pieces and a rest;
    items of length 0 or NULL need no container and give none."""
    d = sizes.where(F.col(n) > 0)
    count = F.ceil(F.col(n) / capacity).cast("int")
    return d.select(key, F.explode(F.sequence(F.lit(0), count - 1)).alias("piece_no"), F.col(n).alias("__n")).select(
        key, "piece_no", F.least(F.col("__n") - F.col("piece_no") * capacity, F.lit(capacity)).cast("int").alias("size")
    )


def histogram(items: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """How many items there are of each length; ``capacity + 1`` numbers."""
    h = np.zeros(capacity + 1, dtype=np.int64)
    for r in items.groupBy("size").count().collect():  # at most `capacity` rows
        h[r["size"]] = r["count"]
    return h


def bucket_bounds(h: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most ``buckets`` length buckets that minimise the total padding of items to their bound.

    Dynamic programming over the histogram: cost(i, j) of a bucket (i, j] is j * count - tokens, each
    layer one vectorised pass.
    """
    top = len(h) - 1
    count, total = np.cumsum(h), np.cumsum(h * np.arange(top + 1))
    used = [s for s in range(1, top + 1) if h[s]]
    if not used:
        return []
    ends = np.array([0, *used])
    m = len(ends)
    c, t = count[ends].astype(float), total[ends].astype(float)
    cost = ends[None, :] * (c[None, :] - c[:, None]) - (t[None, :] - t[:, None])  # from bound i to bound j
    cost[np.tril_indices(m)] = np.inf
    best, back = np.full(m, np.inf), []
    best[0] = 0
    for _ in range(min(buckets, m - 1)):
        step = best[:, None] + cost
        arg = step.argmin(axis=0)
        new = step[arg, np.arange(m)]
        new[0] = 0
        back.append(arg)
        best = new
    out, j = [], m - 1
    for arg in reversed(back):
        if j == 0:
            break
        out.append(int(ends[j]))
        j = int(arg[j])
    return sorted(out)


def patterns(h: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """``(items by length, number of containers)``: best-fit decreasing on the histogram, whole lengths at a time.

    A length goes to the open containers with the least room that takes it, all containers of equal
    filling at once.  Each length splits at most a few such groups, so there are at most three
    patterns a length whatever the counts.
    """
    capacity = len(h) - 1
    open_: dict[int, list[list]] = {}  # room -> [[pattern, containers], ...]
    for s in range(capacity, 0, -1):
        left = int(h[s])
        room = s
        while left:
            while room <= capacity and not open_.get(room):
                room += 1
            if room > capacity:
                fits = capacity // s
                whole, rest = divmod(left, fits)
                for k, m in ((fits, whole), (rest, 1 if rest else 0)):
                    if m:
                        open_.setdefault(capacity - k * s, []).append([{s: k}, m])
                break
            group = open_[room].pop()
            fits = room // s
            take = min(group[1], left // fits)
            if take:
                p = dict(group[0])
                p[s] = p.get(s, 0) + fits
                open_.setdefault(room - fits * s, []).append([p, take])
                left -= take * fits
                if group[1] > take:
                    open_[room].append([group[0], group[1] - take])
            else:  # fewer items left than one container takes
                p = dict(group[0])
                p[s] = p.get(s, 0) + left
                open_.setdefault(room - left * s, []).append([p, 1])
                if group[1] > 1:
                    open_[room].append([group[0], group[1] - 1])
                left = 0
    return [(p, m) for groups in open_.values() for p, m in groups]


def _slots(found: list[tuple[dict[int, int], int]]) -> tuple[np.ndarray, ...]:
    """For each length the rank intervals of its items: sorted key (length, first rank), and of each interval the
    first container and the items a container takes."""
    rows, first, at = [], 0, {}
    for p, m in found:
        for s, k in p.items():
            lo = at.get(s, 0)
            rows.append((s, lo, first, k))
            at[s] = lo + m * k
        first += m
    rows.sort()
    a = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return a[:, 0] << 44 | a[:, 1], a[:, 2], a[:, 3]


def _ranked(items: DataFrame, key: str, group: str) -> DataFrame:
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.col("piece_no").cast("string")))
    d = items.withColumn("__h", h)
    return positions(d, [group], hash_bucket(F.col("__h")), [F.col("__h"), F.col(key), F.col("piece_no")], "k", "n").drop("__h", "n")


def containers(items: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``key, piece_no, size, container_id`` with as little unused space as best-fit decreasing leaves.

    Deterministic in the items.  Lengths that a third of the items have are ranked in buckets.  What
    the tasks are sent has at most 3 x capacity patterns of at most sqrt(2 x capacity) lengths each.
    """
    keys, firsts, takes = _slots(patterns(histogram(items, capacity)))

    def run(batches):
        for b in batches:
            size, k = b.column("size").to_numpy().astype(np.int64), b.column("k").to_numpy() - 1
            i = np.searchsorted(keys, size << 44 | k, side="right") - 1
            place = firsts[i] + (k - (keys[i] & (1 << 44) - 1)) // takes[i] if len(k) else k
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("piece_no"), b.column("size"), pa.array(place, pa.int64())], [key, "piece_no", "size", "container_id"])

    return _ranked(items, key, "size").mapInArrow(run, f"{key} bigint, piece_no int, size int, container_id bigint")


def bucket_batches(items: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """``key, piece_no, size, bucket_bound, container_id``: optimal length buckets, and in each bucket batches of as
    many items as the token budget takes when each is padded to the bucket's bound."""
    h = histogram(items, capacity)
    bounds = bucket_bounds(h, buckets)
    count = np.cumsum(h)
    first, firsts, lo = 0, [], 0
    for b in bounds:
        firsts.append(first)
        n = int(count[b] - count[lo])
        first += -(-n // (capacity // b))
        lo = b
    bound = F.lit(None).cast("int")
    base = F.lit(None).cast("bigint")
    for b, f in reversed(list(zip(bounds, firsts))):
        bound = F.when(F.col("size") <= b, F.lit(b)).otherwise(bound)
        base = F.when(F.col("bucket_bound") <= b, F.lit(f)).otherwise(base)
    ranked = _ranked(items.withColumn("bucket_bound", bound), key, "bucket_bound")
    per = F.floor(F.lit(capacity) / F.col("bucket_bound"))
    return ranked.select(key, "piece_no", "size", "bucket_bound", (base + F.floor((F.col("k") - 1) / per)).cast("bigint").alias("container_id"))


def unused(assigned: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``n_items, n_containers, n_tokens, unused, least_containers`` of an assignment."""
    by = assigned.groupBy("container_id").agg(F.sum("size").alias("t"), F.count(F.lit(1)).alias("m"))
    t = F.coalesce(F.sum("t"), F.lit(0))
    return by.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n_items"), F.count(F.lit(1)).alias("n_containers"), t.alias("n_tokens"), (F.count(F.lit(1)) * capacity - t).alias("unused"), F.ceil(t / capacity).alias("least_containers"))
