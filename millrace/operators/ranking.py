"""Positions inside groups of any size.

A plain ``row_number() over (partition by g order by o)`` sorts a whole group in one task,
which fails when one group holds a third of all rows.  Here each group is cut into buckets
whose order agrees with ``o``; rows are numbered inside a bucket, and the bucket's offset
comes from the bucket sizes, which are aggregated before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ids per bucket where the order is that of an integer id.
ID_BUCKET = 1 << 16  # as in the shift of id_bucket


def positions(df: DataFrame, group: list[str], bucket: Column, order: list[Column], rank: str = "k", size: str = "n") -> DataFrame:
    """``df`` with ``rank`` (bigint from 1 in ``order`` within ``group``) and ``size`` (rows of the group).

    ``bucket`` must not decrease along ``order``, and ``order`` must be total for the result to be
    deterministic.  NULLs in ``group`` form groups of their own.  An empty table gives an empty table.
    Columns of ``df`` with the names of the new ones are replaced; names that begin with ``__`` are reserved.
    """
    d = df.withColumn("__b", bucket)
    inside = d.withColumn("__rn", F.row_number().over(Window.partitionBy(*group, "__b").orderBy(*order)))
    sizes = d.groupBy(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__b").alias("__bb")).agg(F.count(F.lit(1)).alias("__c"))
    keys = [f"__g{i}" for i in range(len(group))]
    by_group = Window.partitionBy(*keys)
    offsets = sizes.withColumn("__off", F.coalesce(F.sum("__c").over(by_group.orderBy("__bb").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("__n", F.sum("__c").over(by_group))
    on = F.col("__b").eqNullSafe(F.col("__bb"))
    for k, g in zip(keys, group):
        on = on & F.col(g).eqNullSafe(F.col(k))
    out = inside.join(offsets, on)
    kept = [c for c in df.columns if c not in (rank, size)]
    return out.select(*kept, (F.col("__off") + F.col("__rn")).cast("bigint").alias(rank), F.col("__n").cast("bigint").alias(size))


def hash_bucket(digest: Column) -> Column:
    """4,096 buckets in the order of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")


def id_bucket(key: Column) -> Column:
    """Buckets of at most :data:`ID_BUCKET` rows in the order of a unique integer key."""
    return F.shiftright(key, 16)
