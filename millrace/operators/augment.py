"""Rows generated from the rules of headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import keyword_category, strip


def _text(value: Column, field: str) -> Column:
    """A string field of a JSON object, stripped; '' where it is absent, null or no string."""
    raw = F.get_json_object(value, f"$.{field}")
    plain = F.schema_of_variant(F.variant_get(F.try_parse_json(value), f"$.{field}", "variant")) == "STRING"
    return F.coalesce(F.when(plain, strip(raw)), F.lit(""))


def explode_rules(headers: DataFrame, header: str, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``pos, key, value``: each rule in document order, its value as JSON text.

    Rules that are no object give no rows.
    """
    rules = F.get_json_object(header, "$.rules")
    as_map = F.from_json(F.when(rules.startswith("{"), rules), "map<string,string>")
    return headers.select(*keep, F.posexplode(F.map_entries(as_map)).alias("pos", "e")).select(*keep, "pos", F.col("e.key").alias("key"), F.col("e.value").alias("value"))


def augment_rules(headers: DataFrame, path: str, header: str) -> DataFrame:
    """One explaining record for each rule that is an object: ``_source, pos, instruction, input, output, _itype``.

    Fields that are absent, null or no strings count as empty.
    """
    rules = explode_rules(headers.withColumn("__name", F.coalesce(F.get_json_object(header, "$.grammar_name"), F.lit(""))), header, [path, "__name"])
    v, key = F.col("value"), F.col("key")
    function, structure, notes = (_text(v, f) for f in K.RULE_FIELDS)
    output = F.concat_ws(
        " ",
        F.concat(key, F.lit(" — "), function, F.lit(".")),
        F.nullif(notes, F.lit("")),
        F.when(structure != "", F.concat(F.lit("Structure: "), structure, F.lit("."))),
    )
    return rules.where(v.startswith("{")).select(
        F.col(path).alias("_source"), "pos", F.concat(F.lit("Explain the Balanda "), keyword_category(F.col("__name")), F.lit(" "), key).alias("instruction"),
        key.alias("input"), output.alias("output"), F.lit("explain").alias("_itype"),
    )


def union_augmented(primary: DataFrame, augmented: DataFrame, enabled: bool = True) -> DataFrame:
    """Both as one bag ``_source, phase, ordinal, instruction, input, output, _itype``; phase 0 is primary, 1 augmented."""
    cols = ["_source", "phase", "ordinal", *K.RECORD_KEYS, "_itype"]
    one = primary.withColumn("phase", F.lit(0)).select(*cols)
    if not enabled:
        return one
    return one.unionByName(augmented.withColumn("phase", F.lit(1)).withColumn("ordinal", F.col("pos").cast("bigint")).select(*cols))
