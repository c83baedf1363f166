"""Deterministic stratified splits with exact sizes for each stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import hash_bucket, positions


def shuffle_key(key: Column | str, seed: int = 42) -> Column:
    """A pseudo-random order that depends on (seed, key) only."""
    return F.md5(F.concat(F.lit(f"{seed}:"), (F.col(key) if isinstance(key, str) else key).cast("string")))


def test_size(n: Column) -> Column:
    """Rows of a stratum of ``n`` that go to test: none of one, one below ten, else a twentieth rounded up."""
    return F.when(n < 2, 0).when(n < 10, 1).otherwise(F.ceil(n / 20)).cast("bigint")


def val_size(n: Column) -> Column:
    """Likewise for val: none below three, one below ten, else a nineteenth of what test leaves, rounded up."""
    return F.when(n < 3, 0).when(n < 10, 1).otherwise(F.ceil((n - test_size(n)) / 19)).cast("bigint")


def split_label(k: Column, n: Column) -> Column:
    """The split of the ``k``-th row of a stratum of ``n``: first test, then val, then train."""
    return F.when(k <= test_size(n), "test").when(k <= test_size(n) + val_size(n), "val").otherwise("train")


def stratified_split(df: DataFrame, strata: list[str], key: str, seed: int = 42) -> DataFrame:
    """``df`` with ``split``, which replaces a column of that name.

    Sizes are exact for each stratum, membership depends on (seed, key) alone, not on
    partitioning.  ``key`` must be unique; NULL strata form a stratum.  A stratum may hold any
    share of the rows: it is ranked in buckets (:func:`ranking.positions`).
    """
    d = df.withColumn("__h", shuffle_key(key, seed))
    ranked = positions(d, strata, hash_bucket(F.col("__h")), [F.col("__h"), F.col(key)], "__k", "__n")
    return ranked.withColumn("split", split_label(F.col("__k"), F.col("__n"))).select(*[c for c in df.columns if c != "split"], "split")


def seeded_shuffle(df: DataFrame, key: str, group: list[str], seed: int = 42, rank: str = "rank") -> DataFrame:
    """``df`` with its 1-based place in a seeded shuffle of each ``group``."""
    d = df.withColumn("__h", shuffle_key(key, seed))
    return positions(d, group, hash_bucket(F.col("__h")), [F.col("__h"), F.col(key)], rank, "__n").drop("__h", "__n")


def sample_pairs(df: DataFrame, key: str, group: list[str], n: int = 10, seed: int = 42) -> DataFrame:
    """Up to ``n`` rows of each group in the order of :func:`shuffle_key`.

    A sampling operator: the limit is the feature.  ``WindowGroupLimit`` keeps ``n`` rows a
    group and map task before the shuffle.
    """
    w = Window.partitionBy(*group).orderBy(shuffle_key(key, seed), F.col(key))
    return df.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n).drop("__k")


def split_leakage(df: DataFrame, keys: list[str]) -> DataFrame:
    """Combinations of ``keys`` that occur in several splits: ``keys, n_splits, n_rows``."""
    out = df.groupBy(*keys).agg(F.collect_set("split").alias("s"), F.count(F.lit(1)).alias("n_rows"))
    return out.where(F.size("s") > 1).select(*keys, F.size("s").cast("bigint").alias("n_splits"), "n_rows")

