"""Reading the project's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name``; column pruning and filters reach its scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its scan has fewer partitions than there are cores.

    For work that costs much more than its rows weigh.  Tables of any size worth the name have more
    partitions than cores and stay as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
