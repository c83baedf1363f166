"""Tolerant decoding of files that are concatenations of JSON values, labels and junk.

The decoder is one pass with an index, so it is linear in the file size.  It runs as a
Python UDTF (``LATERAL parse_objects(content)``) because a file is not line-structured:
neither Spark's line mode nor its multi-line mode reads more than one pretty-printed value.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf

from ..functions.deepjson import dumps, raw_decode

#: Only these count as space between values.
_GAP = " \t\r\n"


def decode_values(text: str | None) -> Iterator[tuple[int, object, bool]]:
    """``(ordinal, dict, in_array)`` of each object in ``text``.

    Objects come out as they are, arrays give those of their elements that are objects
    (one level), scalars are consumed and give nothing.  Where no value can be read, the
    rest of the line is skipped; without a further line the scan ends.  NULL, empty and
    blank texts give nothing.  Equal keys: the last one wins.
    """
    at, ordinal, end = 0, 0, len(text or "")
    while at < end:
        begin = at
        while begin < end and text[begin] in _GAP:
            begin += 1
        if begin == end:
            return
        try:
            value, at = raw_decode(text, begin)
        except ValueError:
            newline = text.find("\n", begin)
            if newline < 0:
                return
            at = newline + 1
            continue
        found = [(value, False)] if isinstance(value, dict) else [(v, True) for v in value if isinstance(v, dict)] if isinstance(value, list) else []
        for obj, in_array in found:
            yield ordinal, obj, in_array
            ordinal += 1


def dump(value: object) -> str:
    """Compact JSON, not escaped; lone surrogates become U+FFFD so that it can be stored as UTF-8."""
    return dumps(value, separators=(",", ":")).encode("utf-8", "replace").decode("utf-8")


class ParseObjects:
    """One row for each object of a file; a failure becomes a row with ``error`` set, not a failed job."""

    def eval(self, content: str):
        try:
            for ordinal, obj, in_array in decode_values(content):
                yield ordinal, dump(obj), in_array, None
        except Exception as e:  # noqa: BLE001 - one bad file must not stop the rest
            yield None, None, None, f"ERROR: {e}"


def register(spark: SparkSession) -> None:
    """Make ``parse_objects`` callable from SQL."""
    spark.udtf.register("parse_objects", udtf(ParseObjects, returnType="ordinal int, obj string, in_array boolean, error string"))


def parse_files(files: DataFrame) -> DataFrame:
    """``(path, content)`` -> ``(path, ordinal, obj, in_array, error)``; files without objects give no rows."""
    spark = files.sparkSession
    register(spark)
    return spark.sql("SELECT f.path, o.* FROM {files} f, LATERAL parse_objects(f.content) o", files=files)
