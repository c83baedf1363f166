"""What kind of JSON object a text holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K


def has_keys(obj: Column, keys: list[str]) -> Column:
    """All ``keys`` are present at the top level, null values included; false for anything but an object."""
    present = F.json_object_keys(obj)
    return F.coalesce(reduce(lambda a, b: a & b, [F.array_contains(present, k) for k in keys]), F.lit(False))


def is_valid(obj: Column) -> Column:
    """The whole text is one JSON value."""
    return F.coalesce(F.try_parse_json(obj).isNotNull(), F.lit(False))


def kind(obj: Column) -> Column:
    """``header`` (instruction_type is grammar_rule), else ``record`` (all three keys present, nulls allowed),
    else ``metadata`` (type is metadata), else ``other``; ``invalid`` for NULL and for what is not JSON."""
    return (
        F.when(~is_valid(obj), "invalid")
        .when(F.get_json_object(obj, "$.instruction_type") == "grammar_rule", "header")
        .when(has_keys(obj, K.RECORD_KEYS), "record")
        .when(F.get_json_object(obj, "$.type") == "metadata", "metadata")
        .otherwise("other")
    )


def looks_like_header(obj: Column) -> Column:
    """The looser test of the normaliser: it has an instruction type or a grammar name."""
    return F.when(is_valid(obj), has_keys(obj, ["instruction_type"]) | has_keys(obj, ["grammar_name"])).otherwise(False)


def first_header(objects: DataFrame, order: list[Column], path: str = "path", obj: str = "obj", loose: bool = False) -> DataFrame:
    """The first header of each file, all columns; later headers are dropped."""
    test = looks_like_header(F.col(obj)) if loose else kind(F.col(obj)) == "header"
    w = Window.partitionBy(path).orderBy(*order)
    return objects.where(test).withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def last_metadata(objects: DataFrame, ordinal: str = "ordinal", path: str = "path", obj: str = "obj") -> DataFrame:
    """The last metadata object of each file that is no header: ``path, obj``."""
    meta = (F.get_json_object(obj, "$.type") == "metadata") & ~looks_like_header(F.col(obj))
    return objects.where(meta).groupBy(path).agg(F.max_by(obj, ordinal).alias(obj))
