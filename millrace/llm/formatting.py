"""Duplicates hidden by formatting differences.

Byte-identical rows collapse first, with counts; only the distinct survivors are made canonical; a
second grouping on the full canonical text sums the counts.  Both groupings combine before they
shuffle, so a group with a third of all rows leaves each task as one row.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.deepjson import dumps, loads
from ..sources.staging import stage

_FIELDS = K.RECORD_KEYS
#: Digests that are broadcast at most: 24 bytes each, so 24 MB.
BROADCAST = 1_000_000


def canonical(x: Column) -> Column:
    """Without punctuation (category P), in one case, runs of white space as one space, trimmed; NULL as ''.

    The case is folded by way of upper case, so that ``ß`` equals ``SS``; punctuation is dropped between
    the two steps, as the optimizer would make ``lower(upper(x))`` a mere ``lower(x)``.
    """
    bare = F.regexp_replace(F.upper(F.coalesce(x, F.lit(""))), r"\p{P}+", "")
    return F.btrim(F.regexp_replace(F.lower(bare), f"{K.WS}+", " "))


def parsed(raw: DataFrame, key: str = "rec_id", line: str = "raw_line") -> DataFrame:
    """``key, instruction, input, output`` of the lines that are JSON objects; other lines give no rows.

    Other keys are ignored, absent ones and nulls are NULL, values that are no strings are their JSON
    text.  Equal keys: the last one wins.
    """
    schema = pa.schema([(key, pa.int64()), *((f, pa.string()) for f in _FIELDS)])

    def text(v):
        s = v if v is None or isinstance(v, str) else dumps(v)
        return s if s is None or s.isascii() else s.encode("utf-8", "replace").decode("utf-8")

    def run(batches):
        for b in batches:
            out = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    o = loads(t or "")
                except ValueError:
                    continue
                if isinstance(o, dict):
                    out.append((k, *(text(o.get(f)) for f in _FIELDS)))
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return raw.select(F.col(key).cast("bigint"), line).mapInArrow(run, f"{key} bigint, " + ", ".join(f"{f} string" for f in _FIELDS))


def _digest(name: str, *cols: Column) -> list[Column]:
    """128 bits of the columns as two numbers; NULL, '' and where a field ends make a difference.

    Never NULL, so that no join adds a filter on it, which would move its computation below the grouping.
    """
    parts = [x for c in cols for x in (F.coalesce(F.length(c), F.lit(-1)), F.coalesce(c, F.lit("")))]
    return [F.xxhash64(*parts).alias(f"{name}1"), F.xxhash64(F.lit(name), *parts).alias(f"{name}2")]


def _distinct(records: DataFrame, key: str) -> DataFrame:
    """The byte-identical groups: digest, ``n``, ``first_id``, the canonical text and its digest."""
    d = records.where(F.col(key).isNotNull()).groupBy(*_FIELDS).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_id"))
    text = F.concat_ws("\n", *[canonical(F.col(f)) for f in _FIELDS])  # no canonical field holds a line feed
    shaped = d.select(*_digest("raw", *[F.col(f) for f in _FIELDS]), "n", "first_id", text.alias("canonical"))
    return shaped.select("raw1", "raw2", "n", "first_id", "canonical", *_digest("canon", F.col("canonical")))


def groups(records: DataFrame, key: str = "rec_id") -> DataFrame:
    """``keep_id, n_copies`` of every record that is left: the smallest id of its group and how many rows it stands for.

    Rows without an id are left out.
    """
    return _distinct(records, key).groupBy("canonical").agg(F.min("first_id").alias("keep_id"), F.sum("n").alias("n_copies")).select("keep_id", "n_copies")


def copies(records: DataFrame, key: str = "rec_id") -> DataFrame:
    """``keep_id, dup_id`` for each row beyond the smallest id of its group.

    The groups found by canonical text are carried back to the byte-identical ones over 128-bit digests.  One of
    those that stands for a single row names it by its first id; only rows that have byte-identical
    copies are looked up by their digest, over a broadcast of the digests wanted where their number is at most
    :data:`BROADCAST`, else in a join on keys that adaptive execution may split where they are skewed.  An id that
    occurs in several rows of a group is no copy of itself where it is the smallest.
    """
    distinct = stage(_distinct(records, key))  # else it would be made for each of its uses
    several = distinct.groupBy("canonical").agg(F.min("first_id").alias("keep_id"), F.sum("n").alias("m"), F.first("canon1").alias("canon1"), F.first("canon2").alias("canon2")).where("m > 1").select("canon1", "canon2", "keep_id")
    members = distinct.select("raw1", "raw2", "n", "first_id", "canon1", "canon2").join(several, ["canon1", "canon2"]).select("raw1", "raw2", "n", "first_id", "keep_id")
    members = stage(members)
    single = members.where("n = 1").select("keep_id", F.col("first_id").alias("dup_id"))
    repeated = members.where("n > 1").select("raw1", "raw2", "keep_id")
    wanted = F.broadcast(repeated) if repeated.count() <= BROADCAST else repeated
    rows = records.where(F.col(key).isNotNull()).select(F.col(key).alias("dup_id"), *_digest("raw", *[F.col(f) for f in _FIELDS]))
    return single.unionByName(rows.join(wanted, ["raw1", "raw2"]).select("keep_id", "dup_id")).where("dup_id <> keep_id")
