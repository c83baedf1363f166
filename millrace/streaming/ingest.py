"""Incremental ingest of record files as a stream.

The batch operators work on streams unchanged where they are stateless (decoding, classification,
normalisation).  Exact de-duplication keeps the first arrival of each record within a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import constants as K
from ..functions.text import instruction_type
from ..operators.classify import kind
from ..operators.normalize import normalize_record


def records(spark: SparkSession, directory: str, files_per_trigger: int = 1_000) -> DataFrame:
    """A stream of ``_source, arrived, instruction, input, output, _itype`` from JSON lines that are added to ``directory``.

    Lines of a known record shape are normalised, all others are dropped.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(directory)
    tagged = lines.select(F.col("_metadata.file_name").alias("_source"), F.col("_metadata.file_modification_time").alias("arrived"), F.col("value").alias("obj"))
    shaped = tagged.where(kind(F.col("obj")).isin("record", "other")).select("_source", "arrived", normalize_record(F.col("obj")).alias("r")).where("r IS NOT NULL")
    return shaped.select("_source", "arrived", *[f"r.{k}" for k in K.RECORD_KEYS]).withColumn("_itype", instruction_type("instruction"))


def first_arrivals(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each record once: state for a record is kept for ``delay``; later copies count as new."""
    return stream.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(K.RECORD_KEYS)


def counts(stream: DataFrame, window: str = "10 minutes", delay: str = "1 day") -> DataFrame:
    """Records per source and type in tumbling windows of arrival; rows later than ``delay`` are dropped."""
    return stream.withWatermark("arrived", delay).groupBy(F.window("arrived", window), "_source", "_itype").agg(F.count(F.lit(1)).alias("n"))


def write(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append to parquet exactly once; ``checkpoint`` lies in a folder that all executors share."""
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
