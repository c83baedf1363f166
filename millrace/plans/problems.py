"""Queries of the general data-preparation problems."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import schema_drift, shred
from ..sources.staging import stage
from ..sources.tables import table
from .catalog import query


@query("p2_found")
def p2_found(spark, d) -> DataFrame:
    """Every change of a header field between neighbouring revisions."""
    return schema_drift.changes(table(spark, d, "v1_headers"))


@query("p2_unified")
def p2_unified(spark, d) -> DataFrame:
    """All header revisions in one schema."""
    return schema_drift.unified(table(spark, d, "v1_headers"))


_UNWRAP = lambda x: f"CASE WHEN json_type({x}) = 'VARCHAR' AND json_valid({x} ->> '$') AND left(ltrim({x} ->> '$', ' ' || chr(9) || chr(10) || chr(13)), 1) IN ('{{', '[') THEN CAST({x} ->> '$' AS JSON) ELSE {x} END"
_TREE = f"""WITH RECURSIVE tree(file_id, v, path, parent, name, item) AS (
  SELECT file_id, {_UNWRAP("j")}, '', '', '', false FROM (SELECT file_id, CAST(rules AS JSON) AS j FROM v1_rules WHERE json_valid(rules))
  UNION ALL
  SELECT p.file_id, {_UNWRAP("e.value")}, p.path || '/' || replace(replace(e.key, '~', '~0'), '/', '~1'), CASE WHEN p.t = 'OBJECT' THEN p.path ELSE p.parent END, e.key, p.t = 'ARRAY'
  FROM (SELECT *, json_type(v) AS t FROM tree WHERE json_type(v) IN ('OBJECT', 'ARRAY')) p, json_each(p.v) e)"""


@query("p7_found", f"{_TREE} SELECT file_id, path AS node_path, parent AS parent_path FROM tree WHERE path <> '' AND (json_type(v) = 'OBJECT' OR item AND json_type(v) NOT IN ('ARRAY', 'NULL'))")
def p7_found(spark, d) -> DataFrame:
    """Each node of the rule trees with its parent."""
    return shred.nodes(table(spark, d, "v1_rules"), "file_id", "rules").select("file_id", "node_path", "parent_path")


@query("p7_fields", f"{_TREE} SELECT file_id, parent AS node_path, name, v ->> '$' AS value FROM tree WHERE path <> '' AND NOT item AND json_type(v) NOT IN ('OBJECT', 'ARRAY', 'NULL')")
def p7_fields(spark, d) -> DataFrame:
    """The scalar fields of each node."""
    return shred.fields(table(spark, d, "v1_rules"), "file_id", "rules")


@query("p7_levels")
def p7_levels(spark, d) -> DataFrame:
    """The shredded columns themselves."""
    return shred.levels(table(spark, d, "v1_rules"), "file_id", "rules")


@query("p7_columns")
def p7_columns(spark, d) -> DataFrame:
    """Every leaf path of the corpus: how many records have it and lack it, its entries, values and levels."""
    return shred.columns_of(stage(p7_levels(spark, d)), "file_id")


@query("p7_tables")
def p7_tables(spark, d) -> DataFrame:
    """The rows of all tables, each with its own and its parent's key."""
    return shred.tables(table(spark, d, "v1_rules"), "file_id", "rules")


@query("p7_catalogue")
def p7_catalogue(spark, d) -> DataFrame:
    """The tables, their parents and their columns."""
    return shred.catalogue(stage(p7_tables(spark, d)))  # read twice


@query("p7_table_rules")
def p7_table_rules(spark, d) -> DataFrame:
    """The table of the named rules, with a typed column for each field."""
    return shred.typed_table(p7_tables(spark, d), "file_id", "/*")


@query("p7_table_examples")
def p7_table_examples(spark, d) -> DataFrame:
    """The table of the rules' examples, whose parent is that of the rules."""
    return shred.typed_table(p7_tables(spark, d), "file_id", "/*/examples/[]")
