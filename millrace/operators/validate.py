"""Checks of written JSONL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..sources.staging import stage
from .classify import is_valid


class InvalidJsonl(ValueError):
    """A line breaks the format."""


def line_status(line: Column) -> Column:
    """``blank`` for NULL and empty lines, ``invalid`` for what is not JSON, ``keys`` where the keys are not
    exactly the record's, else ``ok``."""
    keys = F.array_sort(F.json_object_keys(line))
    wanted = F.array(*[F.lit(k) for k in sorted(K.RECORD_KEYS)])
    return F.when(F.coalesce(line, F.lit("")) == "", "blank").when(~is_valid(line), "invalid").when(F.coalesce(keys == wanted, F.lit(False)), "ok").otherwise("keys")


def validate_lines(df: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """``keep, status`` for each line that is not blank."""
    return df.select(*keep, line_status(F.col(line)).alias("status")).where("status != 'blank'")


def numbered_lines(files: DataFrame) -> DataFrame:
    """``(path, content)`` -> ``(path, lineno, line)`` with line numbers from 1."""
    lines = F.posexplode(F.split("content", "\r\n|\n|\r"))
    return files.select("path", lines.alias("p", "line")).select("path", (F.col("p") + 1).alias("lineno"), "line")


def written_lines(spark: SparkSession, place: str) -> DataFrame:
    """``path, lineno, status`` of every bad line of the files at ``place``, and a row ``path, NULL, 'ok'`` with ``n`` for the
    good ones of each file.

    A file may be read in many blocks: lines are numbered in their block, blocks are counted, and only
    bad lines are told where their block begins.
    """
    read = spark.read.text(place).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), line_status(F.col("value")).alias("status"))
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("status", pa.string()), ("n", pa.int64())])

    def number(batches):
        block, at, good = None, 0, 0
        for b in batches:
            out = []
            for path, start, status in zip(*(b.column(i).to_pylist() for i in range(3))):
                if (path, start) != block:
                    if block:
                        out.append((*block, at, None, good))
                    block, at, good = (path, start), 0, 0
                at += 1
                good += status == "ok"
                if status not in ("ok", "blank"):
                    out.append((path, start, at, status, None))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)
        if block:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*block, at, None, good)))], schema=schema)

    found = stage(read.mapInArrow(number, "path string, block bigint, at bigint, status string, n bigint"))  # a row a block, and the bad lines
    blocks = found.where("status IS NULL")
    before = F.coalesce(F.sum("at").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("path", "block", before.alias("before"))
    bad = found.where("status IS NOT NULL").join(starts, ["path", "block"]).select("path", (F.col("before") + F.col("at")).alias("lineno"), "status", F.lit(1).cast("bigint").alias("n"))
    return bad.unionByName(blocks.groupBy("path").agg(F.sum("n").alias("n")).select("path", F.lit(None).cast("bigint").alias("lineno"), F.lit("ok").alias("status"), "n"))


def require_valid(spark: SparkSession, place: str) -> int:
    """The number of records in the files at ``place``; raises :class:`InvalidJsonl` naming the first bad line as ``path:line: reason``."""
    lines = stage(written_lines(spark, place))
    bad = lines.where("status != 'ok'").orderBy("path", "lineno").limit(1).collect()  # one row: the first failure
    if bad:
        raise InvalidJsonl(f"{bad[0].path}:{bad[0].lineno}: {bad[0].status}")
    return lines.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
