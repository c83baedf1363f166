"""File-level sources and sinks."""

from __future__ import annotations

import fnmatch
import os
import urllib.parse

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K


class NoInput(ValueError):
    """No file matches."""


def _local(place: str) -> str:
    """A ``file:`` URI as a path, anything else as it is."""
    return urllib.parse.unquote("/" + place[5:].lstrip("/")) if place.startswith("file:") else place


def _file_system(place: str) -> tuple[pafs.FileSystem, str]:
    """The file system that a path or URI is in, and its path there."""
    place = _local(place)
    return pafs.FileSystem.from_uri(place) if "://" in place else (pafs.LocalFileSystem(), os.path.abspath(place))


def _underscored(root: str, pattern: str) -> list[str]:
    """Paths relative to ``root`` of the matching files that Spark's scans leave out: those of which a part begins with an underscore."""
    fs, base = _file_system(root)
    if fs.get_file_info(base).type != pafs.FileType.Directory:
        return []
    base = base.rstrip("/") + "/"
    found = (f.path[len(base) :] for f in fs.get_file_info(pafs.FileSelector(base, recursive=True)) if f.type == pafs.FileType.File)
    parts = lambda p: p.split("/")
    return [p for p in found if fnmatch.fnmatchcase(parts(p)[-1], pattern) and any(x[:1] == "_" and "=" not in x for x in parts(p)) and not any(x[:1] == "." for x in parts(p))]


def read_whole(spark: SparkSession, root: str, pattern: str = "*_v1.jsonl") -> DataFrame:
    """``(path, content)``: each file below ``root`` whose name fits ``pattern``, one row a file.

    Paths are relative to ``root`` and decoded (spaces, ``+`` and the like as in the file
    system).  Names that begin with a dot are hidden; those that begin with an underscore, which Spark's
    own scans hide too, are read beside them.  No match raises :class:`NoInput`.
    """
    root = _local(root)
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    try:
        raw = reader.text(root, wholetext=True)
    except Exception as e:  # noqa: BLE001 - an absent root raises an AnalysisException
        raise NoInput(f"nothing to read at {root}") from e
    hidden = _underscored(root, pattern)
    if not hidden and not raw.inputFiles():
        raise NoInput(f"no {pattern} below {root}")
    prefix = urllib.parse.quote(os.path.abspath(root)) if "://" not in root else root
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    base = urllib.parse.unquote(prefix).rstrip("/") + "/"
    at = F.instr(path, base)
    seen = raw.select(F.expr("*"), path.alias("_p"), at.alias("_at")).select(
        F.when(F.col("_at") > 0, F.col("_p").substr(F.col("_at") + F.lit(len(base)), F.length("_p"))).otherwise(F.col("_p")).alias("path"),
        F.col("value").alias("content"),
    )
    if not hidden:
        return seen

    def read(batches):
        fs, place = _file_system(root)
        for b in batches:
            for p in b.column(0).to_pylist():
                with fs.open_input_stream(f"{place.rstrip('/')}/{p}") as f:
                    yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([f.read().decode("utf-8", "replace")])], ["path", "content"])

    names = spark.createDataFrame([(p,) for p in hidden], "path string").repartition(min(len(hidden), spark.sparkContext.defaultParallelism))
    return seen.unionAll(names.mapInArrow(read, "path string, content string"))


def read_split(spark: SparkSession, directory: str) -> DataFrame:
    """``train.jsonl``, ``val.jsonl`` and ``test.jsonl`` as one table with ``split`` (``val`` is called ``validation``)."""
    schema = ", ".join(f"{k} string" for k in K.RECORD_KEYS)
    parts = [
        spark.read.schema(schema).json(f"{directory}/{name}.jsonl").withColumn("split", F.lit("validation" if name == "val" else name))
        for name in K.SPLITS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def to_jsonl(df: DataFrame) -> DataFrame:
    """One compact JSON line ``value`` a row with exactly the record's three keys; NULLs are written as ``null``."""
    return df.select(F.to_json(F.struct(*K.RECORD_KEYS), {"ignoreNullFields": "false"}).alias("value"))


def write_splits(df: DataFrame, directory: str) -> None:
    """A directory ``<split>.jsonl`` of text parts for each split, in the order of ``rank`` if there is one.

    The parts of a split are range-partitioned by rank, so part after part is the whole order.
    """
    for name in K.SPLITS:
        part = df.where(F.col("split") == name)
        part = part.repartitionByRange("rank").sortWithinPartitions("rank") if "rank" in df.columns else part
        to_jsonl(part).write.mode("overwrite").text(f"{directory}/{name}.jsonl")


def changed_files(new: DataFrame, old: DataFrame) -> DataFrame:
    """The rows of ``new(path, content)`` whose bytes differ from those of ``old``, or that ``old`` lacks.

    Only digests are shuffled against each other.
    """
    digest = lambda d, n: d.select("path", F.sha2(F.col("content").cast("binary"), 256).alias(n))
    same = digest(new, "h").join(digest(old, "h"), ["path", "h"], "left_semi").select("path")
    return new.join(same, "path", "left_anti")


def write_documents(docs: DataFrame, target: str) -> DataFrame:
    """Write ``(path, content, status)`` below ``target``, each to its own file, if its bytes differ.

    Returns ``(path, status)``; untouched files have status ``skipped``.  Inputs are never
    overwritten while they are read: give another directory than the source's.  ``target`` is a
    folder that all executors share, or a URI of a file system that pyarrow knows.
    """

    def write(batches):
        fs, base = _file_system(target)
        for batch in batches:
            out = []
            for path, content, status in zip(*(batch.column(c).to_pylist() for c in ("path", "content", "status"))):
                full, data = f"{base.rstrip('/')}/{path}", content.encode("utf-8")
                try:
                    with fs.open_input_stream(full) as f:
                        same = f.read() == data
                except OSError:
                    same = False
                if same:
                    status = "skipped"
                else:
                    try:
                        fs.create_dir(full.rsplit("/", 1)[0], recursive=True)
                        with fs.open_output_stream(full + ".part") as f:
                            f.write(data)
                        fs.move(full + ".part", full)
                    except OSError as e:
                        status = f"ERROR: {e}"
                out.append((path, status))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string())], ["path", "status"])

    return docs.select("path", "content", "status").mapInArrow(write, "path string, status string")
