"""Unifying record, rule and header shapes.

Record and header operators are Column expressions.  Rule values are unions of JSON types whose
key order matters, which Spark's map (ordered, untyped) and variant (typed, re-ordered) each lose
half of; they go through one Arrow-batched pass, without a shuffle.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.deepjson import dumps, loads
from ..functions.text import canonical_instruction, first_filled, grammar_name, identified_category

_EDGE = "".join(chr(c) for c in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])


_SHAPE_KEYS = [*K.RECORD_KEYS, "balanda", "english", "type", "source", "target"]


def _has(keys: Column, *wanted: str) -> Column:
    return F.coalesce(F.size(F.array_intersect(keys, F.array(*[F.lit(k) for k in wanted]))) == len(wanted), F.lit(False))


def _shape(keys: Column, kind: Column) -> Column:
    """Which shape an object with these keys and this ``type`` has: 1 record, 2 language pair, 3 translation pair, else NULL."""
    return F.when(_has(keys, "instruction", "output"), 1).when(_has(keys, "balanda", "english"), 2).when((kind == "translation_pair") & _has(keys, "source", "target"), 3)


def _record(shape: Column, keys: Column, value) -> Column:
    """The record of an object of a known shape."""
    rec = lambda i, a, b: F.struct(i.alias("instruction"), a.alias("input"), b.alias("output"))
    own = rec(canonical_instruction(value("instruction")), F.when(_has(keys, "input"), value("input")).otherwise(""), value("output"))
    return (
        F.when(shape == 1, own)
        .when(shape == 2, rec(F.lit(K.B2E), value("balanda"), value("english")))
        .when(shape == 3, rec(F.lit(K.B2E), value("source"), value("target")))
    )


def normalize_record(obj: Column) -> Column:
    """``struct<instruction,input,output>`` of a JSON object of any known shape, NULL for any other.

    In this order: the three keys; instruction and output without input (input becomes ''); balanda
    and english; a translation pair with source and target.  Only the first two have their
    instruction made canonical.  Values that are no strings come out as their JSON text, null as NULL.
    """
    keys, value = F.json_object_keys(obj), lambda k: F.get_json_object(obj, f"$.{k}")
    return _record(_shape(keys, value("type")), keys, value)


def normalize_records(objects: DataFrame, keep: list[str], obj: str = "obj") -> DataFrame:
    """``keep, instruction, input, output`` of the objects that have a known shape (see :func:`normalize_record`).

    Objects are parsed once for their values; the filter on the shape, which Catalyst moves below that,
    needs their keys and type only.
    """
    parsed = objects.select(*keep, F.json_object_keys(obj).alias("__k"), F.from_json(obj, ", ".join(f"`{k}` string" for k in _SHAPE_KEYS)).alias("__o"))
    known = parsed.withColumn("__s", _shape(F.col("__k"), F.col("__o.type"))).where("__s IS NOT NULL")
    shaped = known.select(*keep, _record(F.col("__s"), F.col("__k"), lambda k: F.col(f"__o.{k}")).alias("__r"))
    return shaped.select(*keep, *[f"__r.{k}" for k in K.RECORD_KEYS])


def _scalar(v: object) -> str:
    return v if isinstance(v, str) else str(v)


def _joined(items: list) -> str:
    return "; ".join(_scalar(x) for x in items if not isinstance(x, (dict, list)))


def _flat(v: object) -> str:
    return v if isinstance(v, str) else "" if v is None else _joined(v) if isinstance(v, list) else dumps(v)


def rule_fields(key: str, value: object) -> tuple[str, str, str]:
    """``(function, structure, notes)`` of a rule value of any JSON type.

    Objects with only those keys are filled with ''.  Other objects: structure is the first filled one
    of structure, statement and rule, else the object as JSON; notes are the remaining strings and
    lists of scalars in key order.  Strings and lists become the structure, other scalars their
    spelling.  Where a field itself is a list its scalars are joined; null is ''.
    """
    human = key.replace("_", " ").replace("-", " ").strip(_EDGE)
    if isinstance(value, dict):
        if not set(value) - set(K.RULE_FIELDS):
            return tuple(_flat(value.get(f, "")) for f in K.RULE_FIELDS)
        structure = next((value[k] for k in ("structure", "statement", "rule") if value.get(k)), None)
        rest = [_joined(v) if isinstance(v, list) else v for k, v in value.items() if k not in ("function", "structure", "statement", "rule") and isinstance(v, (str, list))]
        return _flat(value.get("function", human)), dumps(value) if structure is None else _flat(structure), " | ".join(x for x in rest if x)
    return human, _joined(value) if isinstance(value, list) else _scalar(value), ""


def _rules_of(header: str | None, rules_field: str) -> list[tuple[int, str, str, str, str]]:
    """``(pos, rule, function, structure, notes)`` of each rule of a header, storable as UTF-8."""
    try:
        rules = loads(header or "").get(rules_field)
    except (ValueError, AttributeError):
        return []
    whole = lambda x: x if x.isascii() else x.encode("utf-8", "replace").decode("utf-8")
    return [(pos, *map(whole, (name, *rule_fields(name, value)))) for pos, (name, value) in enumerate(rules.items() if isinstance(rules, dict) else ())]


def normalize_rules(headers: DataFrame, key: str, header: str, rules_field: str = "rules") -> DataFrame:
    """``key, pos, rule, function, structure, notes`` of each rule; rules that are no object, and headers that
    are no JSON object, give no rows.  ``key`` is a bigint or a string column."""
    of = headers.schema[key].dataType.simpleString()
    kind, ddl = (pa.string(), "string") if of == "string" else (pa.int64(), "bigint")
    schema = pa.schema([(key, kind), ("pos", pa.int32()), *((n, pa.string()) for n in ("rule", *K.RULE_FIELDS))])

    def run(batches):
        for b in batches:
            out = [(k, *r) for k, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r in _rules_of(h, rules_field)]
            cols = list(zip(*out)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return headers.select(F.col(key).cast(ddl), header).mapInArrow(run, f"`{key}` {ddl}, pos int, rule string, function string, structure string, notes string")


def normalize_header(headers: DataFrame, path: str, header: str) -> DataFrame:
    """``path, instruction_type, grammar_name, description, rules, n_rules``, the rules as an array of ``{rule, function,
    structure, notes}`` in their order.

    An empty or absent name comes from the file name, an absent description is '', rules that are no
    object count 0.
    """
    rule = pa.struct([(n, pa.string()) for n in ("rule", *K.RULE_FIELDS)])
    columns = headers.select(path, first_filled(F.get_json_object(header, "$.grammar_name"), grammar_name(path)).alias("grammar_name"), F.coalesce(F.get_json_object(header, "$.description"), F.lit("")).alias("description"), header)

    def run(batches):
        for b in batches:
            rules = [[dict(zip(("rule", *K.RULE_FIELDS), r[1:])) for r in _rules_of(h, "rules")] for h in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(rules, pa.list_(rule))], [path, "grammar_name", "description", "rules"])

    full = columns.mapInArrow(run, f"`{path}` string, grammar_name string, description string, rules array<struct<rule: string, function: string, structure: string, notes: string>>")
    return full.select(path, F.lit(K.HEADER_TYPE).alias("instruction_type"), "grammar_name", "description", "rules", F.size("rules").cast("bigint").alias("n_rules"))


def header_from_metadata(meta: DataFrame, path: str, obj: str) -> DataFrame:
    """Likewise of a metadata object: the name is its dataset in lower case with underscores for white space, there are no rules."""
    name = F.coalesce(F.get_json_object(obj, "$.dataset"), grammar_name(path))
    file_name = F.regexp_extract(path, r"([^/]*)$", 1)
    before, after = K.METADATA_DESCRIPTION.split("{file}")
    description = F.coalesce(F.get_json_object(obj, "$.description"), F.concat(F.lit(before), file_name, F.lit(after)))
    none = F.array().cast("array<struct<rule: string, function: string, structure: string, notes: string>>")
    return meta.select(
        path, F.lit(K.HEADER_TYPE).alias("instruction_type"), F.lower(F.regexp_replace(name, f"{K.WS}+", "_")).alias("grammar_name"), description.alias("description"),
        none.alias("rules"), F.lit(0).cast("bigint").alias("n_rules"),
    )


def infer_header(records: DataFrame, path: str, instruction: str = "instruction") -> DataFrame:
    """Likewise from the categories that a file's instructions ask for, with one rule a category.

    Distinct (file, category) pairs are taken before anything is collected, so a set holds
    categories, not records.  Categories with equal keys give one rule, at the place of the first and
    with the text of the last.
    """
    pairs = records.select(path, identified_category(instruction).alias("c")).distinct()
    sets = pairs.groupBy(path).agg(F.array_sort(F.collect_set("c")).alias("cats"))  # NULLs aren't collected
    name = grammar_name(path)
    lead, (before, after) = K.INFERRED_DESCRIPTION.split("{name}"), K.INFERRED_ITEMS.split("{items}")
    text = F.concat(F.lit(lead[0]), humanize_name(name), F.lit(lead[1]), F.when(F.size("cats") > 0, F.concat(F.lit(before), F.array_join("cats", ", "), F.lit(after))).otherwise(""))
    keyed = sets.withColumn("__keys", F.transform("cats", lambda c: F.regexp_replace(F.lower(c), f"{K.WS}+", "_")))
    last = lambda k: F.element_at(F.filter("cats", lambda c: F.regexp_replace(F.lower(c), f"{K.WS}+", "_") == k), -1)
    rules = F.transform(F.array_distinct("__keys"), lambda k: F.struct(k.alias("rule"), last(k).alias("function"), F.lit("").alias("structure"), F.lit(K.INFERRED_NOTE).alias("notes")))
    return keyed.select(path, F.lit(K.HEADER_TYPE).alias("instruction_type"), name.alias("grammar_name"), F.rtrim(text).alias("description"), rules.alias("rules")).withColumn("n_rules", F.size("rules").cast("bigint"))


def humanize_name(name: Column) -> Column:
    """Underscores as spaces."""
    return F.translate(name, "_", " ")
