"""Exact de-duplication with a defined survivor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K


def keep_first(df: DataFrame, order: list[Column], keys: list[str] = K.RECORD_KEYS) -> DataFrame:
    """The first row in ``order`` for each combination of ``keys``; NULL equals NULL.

    No trimming, case folding or composition.  ``order`` must be total.  Spark plans a
    ``WindowGroupLimit`` on both sides of the exchange, so a hot key leaves each map task as
    one row: groups may be of any size.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__first", first).where("__first = 1").drop("__first")


def dedup_stats(df: DataFrame, keys: list[str] = K.RECORD_KEYS) -> DataFrame:
    """One row ``(n_before, n_after, n_removed)``; zeros for an empty table."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c"), F.lit(0)).cast("bigint")
    after = F.count(F.lit(1))
    return groups.agg(before.alias("n_before"), after.alias("n_after"), (before - after).alias("n_removed"))
