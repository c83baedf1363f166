"""Queries that run the whole way of a corpus: a tree of files, decoding, normalising, preparing, writing, reading back.

The trees are written from the project's tables into the shared folder.  A source is cut into files by
ranges of record ids, so that no file grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import classify, normalize, report, validate
from ..sources import decoder, files
from ..sources.staging import place, stage
from ..sources.tables import table
from . import prepare, tree
from .catalog import _AUG_ROWS, _CANONICAL, _CAT_OF, _FH, _GNAME, _ITYPE, _NT, _NV, _RULES_OF, _first_headers, query

#: Record ids a file covers, as a shift: at most 65,536 records a file.
FILE_SHIFT = 16
_STEM = "regexp_replace({0}, '[.]jsonl$', '')"


def _file_of(source: str, key: str):
    return F.concat(F.expr(_STEM.format(source)), F.lit("."), F.shiftright(key, FILE_SHIFT).cast("string"), F.lit("_v1.jsonl"))


_FILE_SQL = f"{_STEM.format('_source')} || '.' || (rec_id >> {FILE_SHIFT}) || '_v1.jsonl'"
_HEADER_SQL = f"{_STEM.format('{0}')} || '.header_v1.jsonl'"


def write_tree(spark: SparkSession, lines: DataFrame) -> str:
    """A new folder with the files ``path`` made of ``line`` in the order of ``at`` and ``id``."""
    root = place(spark)
    ordered = F.array_sort(F.collect_list(F.struct("at", "id", "line")))
    docs = lines.groupBy("path").agg(F.concat(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n"), F.lit("\n")).alias("content"))
    failed = files.write_documents(docs.withColumn("status", F.lit("new")), root).where("status != 'new'").take(1)
    if failed:
        raise OSError(failed[0].status)
    return root


def corpus_tree(spark: SparkSession, d: str) -> str:
    """The records of ``train`` and the first header of each file."""
    train = table(spark, d, "train").select(_file_of("_source", "rec_id").alias("path"), F.coalesce("line_no", F.lit(2**31 - 1)).alias("at"), F.col("rec_id").alias("id"), *K.RECORD_KEYS)
    records = train.select("path", "at", "id", F.to_json(F.struct(*K.RECORD_KEYS), {"ignoreNullFields": "false"}).alias("line"))
    headers = _first_headers(spark, d).select(F.expr(f"concat({_STEM.format('file_path')}, '.header_v1.jsonl')").alias("path"), F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("id"), F.col("header_json").alias("line"))
    return write_tree(spark, records.unionAll(headers))


def raw_tree(spark: SparkSession, d: str) -> str:
    """The lines of ``train_raw`` as they are."""
    raw = table(spark, d, "train_raw")
    return write_tree(spark, raw.select(_file_of("_source", "rec_id").alias("path"), F.lit(0).alias("at"), F.col("rec_id").alias("id"), F.coalesce("raw_line", F.lit("")).alias("line")))


_ALL = f"""SELECT {_FILE_SQL} AS path, 0 AS phase, row_number() OVER (PARTITION BY {_FILE_SQL} ORDER BY coalesce(line_no, 2147483647), rec_id) - 1 AS ordinal, instruction, input, output FROM train
  UNION ALL SELECT {_HEADER_SQL.format("_source")}, 1, pos, instruction, input, output FROM ({_AUG_ROWS})"""
_RID = "path || ':' || phase || ':' || ordinal"
_PREPARED = f"""SELECT CASE WHEN k <= {_NT} THEN 'test' WHEN k <= {_NT} + {_NV} THEN 'validation' ELSE 'train' END AS split, instruction, input, output FROM (
  SELECT *, row_number() OVER (PARTITION BY path, itype ORDER BY md5('42:' || {_RID}), {_RID}) AS k, count(*) OVER (PARTITION BY path, itype) AS n FROM (
    SELECT *, {_ITYPE} AS itype FROM (SELECT *, row_number() OVER (PARTITION BY instruction, input, output ORDER BY path, phase, ordinal) AS r1 FROM ({_ALL})) WHERE r1 = 1))"""


def _prepared(spark: SparkSession, d: str) -> tuple[str, prepare.Prepared]:
    out = place(spark)
    return out, prepare.run(spark, corpus_tree(spark, d), out)


@query("prepare_run", _PREPARED)
def _(spark, d):
    """The records of the written splits, read back."""
    return files.read_split(spark, _prepared(spark, d)[0])


@query(
    "prepare_sources",
    f"SELECT path AS file_path, count(*) AS n_records FROM (SELECT {_FILE_SQL} AS path FROM train) GROUP BY 1 UNION ALL SELECT {_HEADER_SQL.format('file_path')}, 0 FROM ({_FH})",
)
def _(spark, d):
    """Records of each file of the tree, those without records included."""
    paths, primary, *_ = prepare.load(spark, corpus_tree(spark, d))
    return report.source_counts(paths.withColumnRenamed("path", "file_path"), primary)


@query("prepare_checked", f"SELECT split, count(*) AS n_good, CAST(0 AS BIGINT) AS n_bad FROM ({_PREPARED}) GROUP BY 1")
def _(spark, d):
    """Good and bad lines of the written splits."""
    out = _prepared(spark, d)[0]
    parts = [validate.written_lines(spark, f"{out}/{name}.jsonl").withColumn("split", F.lit("validation" if name == "val" else name)) for name in K.SPLITS]
    good = F.col("status") == "ok"
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).groupBy("split").agg(F.sum(F.when(good, F.col("n")).otherwise(0)).alias("n_good"), F.sum(F.when(good, 0).otherwise(F.col("n"))).alias("n_bad"))


@query(
    "validate_files",
    f"""SELECT path, lineno, status FROM (SELECT {_FILE_SQL} AS path, row_number() OVER (PARTITION BY {_FILE_SQL} ORDER BY rec_id) AS lineno,
    CASE WHEN NOT json_valid(raw_line) THEN 'invalid' WHEN list_sort(json_keys(raw_line)) = ['input', 'instruction', 'output'] THEN 'ok' ELSE 'keys' END AS status FROM train_raw) WHERE status <> 'ok'""",
)
def _(spark, d):
    """Every bad line of a tree of raw files by file and line number."""
    lines = validate.numbered_lines(files.read_whole(spark, raw_tree(spark, d)))
    return validate.validate_lines(lines, "line", ["path", "lineno"]).where("status != 'ok'").select("path", F.col("lineno").cast("bigint").alias("lineno"), "status")


_RAW = f"""SELECT {_FILE_SQL} AS path, rec_id, raw_line AS o, json_keys(raw_line) AS ks FROM (SELECT * FROM train_raw WHERE json_valid(raw_line)) WHERE json_type(raw_line) = 'OBJECT'"""
_HEADED = "(list_contains(ks, 'instruction_type') OR list_contains(ks, 'grammar_name'))"
_LOOSE_RECORDS = f"SELECT *, list_contains(ks, 'instruction') AND list_contains(ks, 'output') OR list_contains(ks, 'balanda') AND list_contains(ks, 'english') OR o ->> '$.type' = 'translation_pair' AND list_contains(ks, 'source') AND list_contains(ks, 'target') AS shaped FROM ({_RAW}) WHERE NOT {_HEADED} AND coalesce(o ->> '$.type', '') <> 'metadata'"


@query(
    "normalize_tree",
    f"""SELECT p.path, CASE WHEN h.path IS NULL THEN 'header-inferred' ELSE 'converted' END AS status, CAST(coalesce(n_before, 0) AS INTEGER) AS n_before, CAST(coalesce(n_after, 0) AS INTEGER) AS n_after
    FROM (SELECT DISTINCT {_FILE_SQL} AS path FROM train_raw) p LEFT JOIN (SELECT DISTINCT path FROM ({_RAW}) WHERE {_HEADED}) h ON h.path = p.path
    LEFT JOIN (SELECT path, count(*) AS n_before, count(*) FILTER (coalesce(shaped, false)) AS n_after FROM ({_LOOSE_RECORDS}) GROUP BY 1) r ON r.path = p.path""",
)
def _(spark, d):
    """Every file of a tree of raw files normalised and written: its status, and its records before and after."""
    return tree.run(spark, raw_tree(spark, d), place(spark))


_C = _CAT_OF("o ->> '$.instruction'")


@query(
    "normalized_tree_records",
    f"""SELECT path, {_CANONICAL("i", "c")} AS instruction,
    CASE WHEN list_contains(ks, 'input') THEN o ->> '$.input' ELSE '' END AS input, o ->> '$.output' AS output
    FROM (SELECT *, o ->> '$.instruction' AS i, {_C} AS c FROM ({_LOOSE_RECORDS})) WHERE list_contains(ks, 'instruction') AND list_contains(ks, 'output')""",
)
def _(spark, d):
    """The records of the normalised files, read back by the decoder."""
    target = place(spark)
    tree.run(spark, raw_tree(spark, d), target)
    objects = decoder.parse_files(files.read_whole(spark, target)).where(classify.kind(F.col("obj")) == "record")
    return objects.select("path", *[F.get_json_object("obj", f"$.{k}").alias(k) for k in K.RECORD_KEYS])


@query("header_rules", _RULES_OF("file_path", f"SELECT * FROM ({_FH})"))
def _(spark, d):
    """The uniform rules of each file's own header, in order."""
    rules = normalize.normalize_header(_first_headers(spark, d), "file_path", "header_json")
    return rules.select("file_path", F.posexplode("rules").alias("pos", "r")).select("file_path", "pos", "r.rule", *[f"r.{f}" for f in K.RULE_FIELDS])


@query(
    "inferred_rules",
    f"""SELECT _source, CAST(row_number() OVER (PARTITION BY _source ORDER BY first) - 1 AS INTEGER) AS pos, rule, function, '' AS structure, '{K.INFERRED_NOTE}' AS notes FROM (
      SELECT _source, regexp_replace(lower(c), '{K.WS}+', '_', 'g') AS rule, min(c) AS first, max(c) AS function FROM (SELECT _source, {_CAT_OF("instruction")} AS c FROM train) WHERE c IS NOT NULL GROUP BY 1, 2)""",
)
def _(spark, d):
    """The rules of the headers that are inferred from each source's records."""
    rules = normalize.infer_header(table(spark, d, "train"), "_source")
    return rules.select("_source", F.posexplode("rules").alias("pos", "r")).select("_source", "pos", "r.rule", *[f"r.{f}" for f in K.RULE_FIELDS])


@query(
    "metadata_header",
    f"""SELECT file_path, '{K.HEADER_TYPE}' AS instruction_type, lower(regexp_replace(coalesce(category, {_GNAME("file_path")}), '{K.WS}+', '_', 'g')) AS grammar_name,
    coalesce('Declares ' || n_declared || ' records', 'Balanda lexicon extracted from ' || regexp_extract(file_path, '([^/]*)$', 1) || '.') AS description, CAST(0 AS BIGINT) AS n_rules FROM source_files""",
)
def _(spark, d):
    """Headers made of the last metadata object of each file, from the objects that ``source_files`` stands for."""
    f = table(spark, d, "source_files")
    obj = lambda **kv: F.to_json(F.struct(*[c.alias(k) for k, c in kv.items()]))
    says = F.concat(F.lit("Declares "), F.col("n_declared").cast("string"), F.lit(" records"))
    objects = f.select(F.col("file_path").alias("path"), F.posexplode(F.array(
        obj(type=F.lit("metadata"), dataset=F.lit("older")), obj(type=F.lit("metadata"), dataset=F.col("category"), description=says), obj(type=F.lit("metadata"), grammar_name=F.lit("a header"), dataset=F.lit("none")),
    )).alias("ordinal", "obj"))
    return normalize.header_from_metadata(classify.last_metadata(objects), "path", "obj").drop("rules").withColumnRenamed("path", "file_path")


@query(
    "changed_headers",
    "SELECT file_path FROM (SELECT file_path, arg_min(header_json, struct_pack(a := rev_no, b := header_json)) AS old, arg_max(header_json, struct_pack(a := rev_no, b := header_json)) AS new FROM v1_headers GROUP BY 1) WHERE old <> new",
)
def _(spark, d):
    """Files whose header is not what it was in their first revision."""
    ends = stage(
        table(spark, d, "v1_headers").groupBy(F.col("file_path").alias("path"))
        .agg(F.min_by("header_json", F.struct("rev_no", "header_json")).alias("old"), F.max_by("header_json", F.struct("rev_no", "header_json")).alias("new"))
    )
    return files.changed_files(ends.select("path", F.col("new").alias("content")), ends.select("path", F.col("old").alias("content"))).select(F.col("path").alias("file_path"))
