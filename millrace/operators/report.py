"""Counts and summaries.  All are aggregations with map-side combine over few groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import short_status


def source_counts(files: DataFrame, records: DataFrame, file_key: str = "file_path", source: str = "_source") -> DataFrame:
    """``(file_path, n_records)`` for every file, 0 where it has no record.

    Records are counted before the join, so it joins one row a source whatever the skew.
    """
    counts = records.groupBy(F.col(source).alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    joined = files.select(file_key).join(counts, F.col(file_key) == F.col("__s"), "left")
    return joined.select(file_key, F.coalesce("__n", F.lit(0)).cast("bigint").alias("n_records"))


def stratum_sizes(df: DataFrame, strata: list[str]) -> DataFrame:
    """``strata, n``."""
    return df.groupBy(*strata).agg(F.count(F.lit(1)).alias("n"))


def split_summary(df: DataFrame) -> DataFrame:
    """``split, n, pct`` (share of the total, one decimal).  An empty table gives no rows, not a division by zero."""
    by = df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # one row a split reaches this window
    return by.select("split", "n", F.round(F.col("n") * 100.0 / total, 1).alias("pct"))


def itype_by_split(df: DataFrame, itype: Column) -> DataFrame:
    """``itype, train, val, test``: counts with zeros."""
    pivoted = df.select(itype.alias("itype"), "split").groupBy("itype").pivot("split", K.SPLITS).agg(F.count(F.lit(1)))
    return pivoted.na.fill(0, K.SPLITS)


def status_report(report: DataFrame) -> DataFrame:
    """``status, n_files, n_before, n_after``: all ``ERROR...`` statuses together as ``error``, NULL as ``unknown``."""
    status = F.when(F.col("file_status").startswith("ERROR"), "error").otherwise(F.coalesce("file_status", F.lit("unknown")))
    return report.groupBy(short_status(status).alias("status")).agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("n_before"), F.lit(0)).cast("bigint").alias("n_before"), F.coalesce(F.sum("n_after"), F.lit(0)).cast("bigint").alias("n_after")
    )


def latest_reports(report: DataFrame) -> DataFrame:
    """The last run of each file: by ``run_at``, then ``loaded_at``, then ``report_id``."""
    w = Window.partitionBy("file_path").orderBy(F.col("run_at").desc_nulls_last(), F.col("loaded_at").desc_nulls_last(), F.col("report_id").desc())
    return report.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def review_list(report: DataFrame) -> DataFrame:
    """Files whose header was inferred in their last run."""
    return latest_reports(report).where(F.col("file_status") == "header-inferred").select("file_path", "n_before", "n_after")


def split_peek(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """``split, n, first_*``: the size and first row of each split."""
    first = F.min_by(F.struct(*K.RECORD_KEYS), key)
    out = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), first.alias("f"))
    return out.select(split, "n", *[F.col(f"f.{k}").alias(f"first_{k}") for k in K.RECORD_KEYS])


def label_width(df: DataFrame, label: str) -> int:
    """The length of the longest label, 0 without any."""
    return df.agg(F.coalesce(F.max(F.length(F.col(label))), F.lit(0))).first()[0]


def aligned(df: DataFrame, label: str) -> DataFrame:
    """``df`` with its first column ``label`` padded to one width, as reports are printed."""
    return df.withColumn(label, F.rpad(F.coalesce(label, F.lit("")), label_width(df, label), " "))


def print_report(df: DataFrame, label: str) -> None:
    """Every row, labels aligned; rows come to the driver partition by partition."""
    print("  ".join(df.columns))
    for row in aligned(df, label).toLocalIterator():
        print("  ".join(str(x) for x in row))
