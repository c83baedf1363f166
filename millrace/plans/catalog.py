"""The queries over the project's tables, each with the SQL that gives the same rows where SQL can.

A query is ``f(spark, sf_dir) -> DataFrame`` over whole tables.  The SQL is what a plain SQL engine
(checked with DuckDB) runs on the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..operators import augment, chat, classify, dedup, metrics, normalize, report, split, validate
from ..sources.files import to_jsonl
from ..sources.staging import stage
from ..sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, if there is one, its SQL."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# ---- SQL building blocks --------------------------------------------------------------------------------------------

_WS = K.WS
_STRIP = lambda x: f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"
_ITYPE = f"CASE WHEN instruction = '{K.B2E}' THEN 'translate_b2e' WHEN instruction = '{K.E2B}' THEN 'translate_e2b' WHEN starts_with(instruction, 'Identify') THEN 'identify' WHEN starts_with(instruction, 'Explain') THEN 'explain' ELSE 'other' END"
_CATEGORY = lambda x: f"CASE WHEN {x} IS NULL THEN NULL " + " ".join(f"WHEN contains(lower({x}), '{k}') THEN '{c}'" for k, c in K.CATEGORY_KEYWORDS) + f" ELSE '{K.DEFAULT_CATEGORY}' END"
_IDENT = X._IDENTIFY.replace("'", "''")
_CAT_OF = lambda x: f"CASE WHEN regexp_matches({x}, '{_IDENT}') THEN {_STRIP(f'''regexp_extract({x}, '{_IDENT}', 1)''')} END"
_CANONICAL = lambda i, c: f"CASE WHEN {c} IS NULL OR {i} IN ('{K.B2E}', '{K.E2B}') THEN {i} WHEN starts_with(lower({c}), 'balanda') THEN 'Identify the ' || {c} ELSE 'Identify the Balanda ' || {c} END"
_STEM = lambda x: f"regexp_replace(regexp_extract({x}, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1')"
_GNAME = lambda x: f"lower(regexp_replace(regexp_replace({_STEM(x)}, '_v\\p{{Nd}}+$', ''), '(?:{_WS}|-)+', '_', 'g'))"
_ORDER = "_source ASC NULLS LAST, line_no ASC NULLS LAST, rec_id ASC"
_FIRST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instruction, input, output ORDER BY {_ORDER}) AS r1 FROM train) WHERE r1 = 1"
_NT = "CASE WHEN n < 2 THEN 0 WHEN n < 10 THEN 1 ELSE CAST(ceil(n / 20.0) AS BIGINT) END"
_NV = f"CASE WHEN n < 3 THEN 0 WHEN n < 10 THEN 1 ELSE CAST(ceil((n - ({_NT})) / 19.0) AS BIGINT) END"
_H = "md5('42:' || CAST(rec_id AS VARCHAR))"
_SPLIT = f"""SELECT *, CASE WHEN k <= {_NT} THEN 'test' WHEN k <= {_NT} + {_NV} THEN 'val' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY _source, itype ORDER BY {_H}, rec_id) AS k, count(*) OVER (PARTITION BY _source, itype) AS n
  FROM (SELECT *, {_ITYPE} AS itype FROM ({_FIRST})))"""


def _order():
    return [F.col("_source").asc_nulls_last(), F.col("line_no").asc_nulls_last(), F.col("rec_id").asc()]


def _deduped(spark, d):
    return dedup.keep_first(table(spark, d, "train"), _order())


def _split(spark, d, *more):
    """The records that are left with their split.  Ranking reads its input twice, so the narrow result of the
    de-duplication is staged: whole records are shuffled once."""
    kept = _deduped(spark, d).select("rec_id", "_source", X.instruction_type("instruction").alias("itype"), *more)
    return split.stratified_split(stage(kept), ["_source", "itype"], "rec_id")


# ---- text functions -------------------------------------------------------------------------------------------------


@query("instruction_type", f"SELECT rec_id, {_ITYPE} AS itype FROM train")
def _(spark, d):
    return table(spark, d, "train").select("rec_id", X.instruction_type("instruction").alias("itype"))


@query("keyword_category", f"SELECT file_path, {_CATEGORY('file_path')} AS category_of_path, {_CATEGORY('category')} AS category_of_name FROM source_files")
def _(spark, d):
    return table(spark, d, "source_files").select("file_path", X.keyword_category("file_path").alias("category_of_path"), X.keyword_category("category").alias("category_of_name"))


@query(
    "canonical_instruction",
    f"SELECT rec_id, {_CANONICAL('instruction', 'c')} AS instruction FROM (SELECT rec_id, instruction, {_CAT_OF('instruction')} AS c FROM train)",
)
def _(spark, d):
    return table(spark, d, "train").select("rec_id", X.canonical_instruction("instruction").alias("instruction"))


@query("grammar_name", f"SELECT file_path, {_GNAME('file_path')} AS grammar_name FROM source_files")
def _(spark, d):
    return table(spark, d, "source_files").select("file_path", X.grammar_name("file_path").alias("grammar_name"))


@query("humanize", f"SELECT file_id, {_STRIP('''translate(grammar_name, '_-', '  ')''')} AS title FROM v1_rules")
def _(spark, d):
    return table(spark, d, "v1_rules").select("file_id", X.humanize("grammar_name").alias("title"))


@query("strip_unicode", f"SELECT rec_id, {_STRIP('output')} AS output FROM train")
def _(spark, d):
    return table(spark, d, "train").select("rec_id", X.strip("output").alias("output"))


@query("nfc_text", "SELECT rec_id, nfc_normalize(input) AS input, nfc_normalize(output) AS output FROM train")
def _(spark, d):
    return table(spark, d, "train").select("rec_id", X.nfc("input").alias("input"), X.nfc("output").alias("output"))


@query("replace_digraph", "SELECT doc_id, replace(replace(replace(text, 'ng''', 'ŋ'), 'Ng''', 'Ŋ'), 'NG''', 'Ŋ') AS text FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", X.replace_digraph("text").alias("text"))


@query("truncate_words", f"SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '{_WS}+'), lambda w: w <> '')[1:64], ' ') AS text FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", X.truncate_words("text", 64).alias("text"))


# ---- classification and normalisation -------------------------------------------------------------------------------

_HAS = lambda o, *ks: " AND ".join(f"list_contains(json_keys({o}), '{k}')" for k in ks)
_KIND = lambda o: f"""CASE WHEN NOT coalesce(json_valid({o}), false) THEN 'invalid' WHEN json_extract_string({o}, '$.instruction_type') = 'grammar_rule' THEN 'header'
  WHEN {_HAS(o, *K.RECORD_KEYS)} THEN 'record' WHEN json_extract_string({o}, '$.type') = 'metadata' THEN 'metadata' ELSE 'other' END"""  # noqa: E731
_LOOSE = lambda o: f"CASE WHEN coalesce(json_valid({o}), false) THEN ({_HAS(o, 'instruction_type')}) OR ({_HAS(o, 'grammar_name')}) ELSE false END"


@query(
    "classify_objects",
    f"""SELECT 'header' AS origin, file_id AS id, {_KIND("header_json")} AS kind, {_LOOSE("header_json")} AS loose_header FROM v1_headers
    UNION ALL SELECT 'line', rec_id, {_KIND("raw_line")}, {_LOOSE("raw_line")} FROM train_raw""",
)
def _(spark, d):
    one = lambda name, origin, key, obj: table(spark, d, name).select(F.lit(origin).alias("origin"), F.col(key).alias("id"), classify.kind(F.col(obj)).alias("kind"), classify.looks_like_header(F.col(obj)).alias("loose_header"))
    return one("v1_headers", "header", "file_id", "header_json").unionAll(one("train_raw", "line", "rec_id", "raw_line"))


_FH = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY rev_no, loaded_at, header_json) AS r1 FROM v1_headers
  WHERE ({_KIND("header_json")}) = 'header') WHERE r1 = 1"""


def _first_headers(spark, d):
    return classify.first_header(table(spark, d, "v1_headers"), [F.col("rev_no"), F.col("loaded_at"), F.col("header_json")], "file_path", "header_json")


@query("first_header", f"SELECT file_path, rev_no, json_extract_string(header_json, '$.grammar_name') AS grammar_name FROM ({_FH})")
def _(spark, d):
    return _first_headers(spark, d).select("file_path", "rev_no", F.get_json_object("header_json", "$.grammar_name").alias("grammar_name"))


_RAW_OBJECTS = "SELECT rec_id, raw_line AS o, json_keys(raw_line) AS ks FROM (SELECT * FROM train_raw WHERE json_valid(raw_line)) WHERE json_type(raw_line) = 'OBJECT'"
_IN = lambda *ks: " AND ".join(f"list_contains(ks, '{k}')" for k in ks)


@query(
    "normalize_records",
    f"""SELECT rec_id, {_CANONICAL("instruction", "c")} AS instruction, input, output FROM (SELECT *, {_CAT_OF("instruction")} AS c FROM train)
    UNION ALL SELECT rec_id, CASE WHEN s = 1 THEN {_CANONICAL("i", "c")} ELSE '{K.B2E}' END,
      CASE s WHEN 1 THEN CASE WHEN {_IN("input")} THEN o ->> '$.input' ELSE '' END WHEN 2 THEN o ->> '$.balanda' ELSE o ->> '$.source' END,
      CASE s WHEN 1 THEN o ->> '$.output' WHEN 2 THEN o ->> '$.english' ELSE o ->> '$.target' END
    FROM (SELECT *, o ->> '$.instruction' AS i, {_CAT_OF("o ->> '$.instruction'")} AS c, CASE WHEN {_IN("instruction", "output")} THEN 1 WHEN {_IN("balanda", "english")} THEN 2
      WHEN o ->> '$.type' = 'translation_pair' AND {_IN("source", "target")} THEN 3 END AS s FROM ({_RAW_OBJECTS})) WHERE s IS NOT NULL""",
)
def _(spark, d):
    """The records of ``train`` as they are written, and the lines of ``train_raw``, whole."""
    train = table(spark, d, "train")
    written = train.select("rec_id", F.to_json(F.struct(*K.RECORD_KEYS), {"ignoreNullFields": "false"}).alias("obj"))
    return normalize.normalize_records(written.unionAll(table(spark, d, "train_raw").select("rec_id", "raw_line")), ["rec_id"])


_LIST = lambda x: f"array_to_string(list_transform(list_filter(from_json({x}, '[\"JSON\"]'), lambda y: json_type(y) NOT IN ('OBJECT', 'ARRAY')), lambda y: y ->> '$'), '; ')"
_FLAT = lambda x: f"CASE json_type({x}) WHEN 'VARCHAR' THEN {x} ->> '$' WHEN 'ARRAY' THEN {_LIST(x)} ELSE '' END"
_AT = lambda f: f"json_extract(v, '$.{f}')"
_FILLED = lambda f: f"(CASE WHEN json_type(v, '$.{f}') = 'VARCHAR' THEN v ->> '$.{f}' <> '' WHEN json_type(v, '$.{f}') = 'ARRAY' THEN json_array_length(v, '$.{f}') > 0 ELSE false END)"
_NAMED = "('function', 'structure', 'statement', 'rule')"
_DUMP = lambda x: f"CASE json_type({x}) WHEN 'ARRAY' THEN '[' || array_to_string(list_transform(from_json({x}, '[\"JSON\"]'), lambda y: CAST(y AS VARCHAR)), ', ') || ']' ELSE CAST({x} AS VARCHAR) END"
#: An object without any structure becomes its JSON with spaces after commas and colons (one level of nesting here).
_RULES_OF = lambda key, headers: f"""SELECT {key}, CAST(row_number() OVER (PARTITION BY {key}, rid ORDER BY jid) - 1 AS INTEGER) AS pos, rule,
  CASE WHEN t <> 'OBJECT' THEN {_STRIP("translate(rule, '_-', '  ')")} WHEN plain OR json_exists(v, '$.function') THEN {_FLAT(_AT("function"))} ELSE {_STRIP("translate(rule, '_-', '  ')")} END AS function,
  CASE WHEN t = 'VARCHAR' THEN v ->> '$' WHEN t = 'ARRAY' THEN {_LIST("v")} WHEN plain OR {_FILLED("structure")} THEN {_FLAT(_AT("structure"))}
    WHEN {_FILLED("statement")} THEN {_FLAT(_AT("statement"))} WHEN {_FILLED("rule")} THEN {_FLAT(_AT("rule"))}
    ELSE '{{' || array_to_string(list_transform(ks, lambda k: '"' || k || '": ' || {_DUMP("json_extract(v, '$.' || k)")}), ', ') || '}}' END AS structure,
  CASE WHEN t <> 'OBJECT' THEN '' WHEN plain THEN {_FLAT(_AT("notes"))} ELSE array_to_string(list_filter(list_transform(list_filter(ks, lambda k: k NOT IN {_NAMED}),
    lambda k: {_FLAT("json_extract(v, '$.' || k)")}), lambda n: n <> ''), ' | ') END AS notes
  FROM (SELECT *, json_keys(v) AS ks, len(list_filter(json_keys(v), lambda k: k NOT IN ('function', 'structure', 'notes'))) = 0 AS plain FROM (
    SELECT h.{key}, h.rid, je.id AS jid, je.key AS rule, je.value AS v, je.type AS t FROM (SELECT *, row_number() OVER () AS rid FROM ({headers})) h, json_each(h.header_json, '$.rules') je
    WHERE json_type(h.header_json, '$.rules') = 'OBJECT'))"""  # noqa: E731


@query("normalize_rules", _RULES_OF("file_id", "SELECT * FROM v1_headers"))
def _(spark, d):
    return normalize.normalize_rules(table(spark, d, "v1_headers"), "file_id", "header_json")


@query(
    "normalize_header",
    f"""SELECT file_path, '{K.HEADER_TYPE}' AS instruction_type, coalesce(nullif(json_extract_string(header_json, '$.grammar_name'), ''), {_GNAME("file_path")}) AS grammar_name,
    coalesce(json_extract_string(header_json, '$.description'), '') AS description,
    CASE WHEN json_type(header_json, '$.rules') = 'OBJECT' THEN CAST(len(json_keys(header_json, '$.rules')) AS BIGINT) ELSE 0 END AS n_rules FROM ({_FH})""",
)
def _(spark, d):
    return normalize.normalize_header(_first_headers(spark, d), "file_path", "header_json").drop("rules")  # those: header_rules


@query(
    "infer_header",
    f"""SELECT _source, '{K.HEADER_TYPE}' AS instruction_type, {_GNAME("_source")} AS grammar_name,
    rtrim('This file contains Balanda language training examples for ' || replace({_GNAME("_source")}, '_', ' ') || '. ' ||
      CASE WHEN len(cats) > 0 THEN 'Items covered: ' || array_to_string(cats, ', ') || '.' ELSE '' END) AS description,
    CAST(len(keys) AS BIGINT) AS n_rules
    FROM (SELECT _source, cats, list_transform(list_filter(list_zip(ks, range(1, len(ks) + 1)), lambda x: list_position(ks, x[1]) = x[2]), lambda x: x[1]) AS keys
      FROM (SELECT *, list_transform(cats, lambda c: regexp_replace(lower(c), '{_WS}+', '_', 'g')) AS ks
        FROM (SELECT _source, list_sort(coalesce(list(DISTINCT c) FILTER (c IS NOT NULL), [])) AS cats FROM (SELECT _source, {_CAT_OF("instruction")} AS c FROM train) GROUP BY _source)))""",
)
def _(spark, d):
    return normalize.infer_header(table(spark, d, "train"), "_source").drop("rules")  # those: inferred_rules


@query(
    "normalize_report",
    """SELECT CASE WHEN length(s) > 18 THEN left(s, 15) || '...' ELSE s END AS status, count(*) AS n_files,
    CAST(coalesce(sum(n_before), 0) AS BIGINT) AS n_before, CAST(coalesce(sum(n_after), 0) AS BIGINT) AS n_after
    FROM (SELECT *, CASE WHEN starts_with(file_status, 'ERROR') THEN 'error' ELSE coalesce(file_status, 'unknown') END AS s FROM file_report) GROUP BY 1""",
)
def _(spark, d):
    return report.status_report(table(spark, d, "file_report"))


@query(
    "review_list",
    """SELECT file_path, n_before, n_after FROM (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY run_at DESC NULLS LAST, loaded_at DESC NULLS LAST, report_id DESC) AS r FROM file_report)
    WHERE r = 1 AND file_status = 'header-inferred'""",
)
def _(spark, d):
    return report.review_list(table(spark, d, "file_report"))


# ---- augmentation ---------------------------------------------------------------------------------------------------

_RF = lambda f: f"CASE WHEN json_type(v, '$.{f}') = 'VARCHAR' THEN {_STRIP(f'''json_extract_string(v, '$.{f}')''')} ELSE '' END"
_AUG = f"""SELECT _source, CAST(row_number() OVER (PARTITION BY _source ORDER BY jid) - 1 AS INTEGER) AS pos, v, rule, t, name FROM (
  SELECT h.file_path AS _source, je.id AS jid, je.key AS rule, je.value AS v, je.type AS t, coalesce(json_extract_string(h.header_json, '$.grammar_name'), '') AS name
  FROM ({_FH}) h, json_each(h.header_json, '$.rules') je WHERE json_type(h.header_json, '$.rules') = 'OBJECT')"""
_AUG_ROWS = f"""SELECT _source, pos, 'Explain the Balanda ' || {_CATEGORY("name")} || ' ' || rule AS instruction, rule AS input,
  concat_ws(' ', rule || ' — ' || ({_RF("function")}) || '.', nullif({_RF("notes")}, ''), CASE WHEN ({_RF("structure")}) <> '' THEN 'Structure: ' || ({_RF("structure")}) || '.' END) AS output,
  'explain' AS _itype FROM ({_AUG}) WHERE t = 'OBJECT'"""


@query("augment_rules", _AUG_ROWS)
def _(spark, d):
    return augment.augment_rules(_first_headers(spark, d), "file_path", "header_json")


@query(
    "union_augmented",
    f"""SELECT _source, 0 AS phase, CAST(line_no AS BIGINT) AS ordinal, instruction, input, output, {_ITYPE} AS _itype FROM train
    UNION ALL SELECT _source, 1, CAST(pos AS BIGINT), instruction, input, output, _itype FROM ({_AUG_ROWS})""",
)
def _(spark, d):
    primary = table(spark, d, "train").withColumn("ordinal", F.col("line_no").cast("bigint")).withColumn("_itype", X.instruction_type("instruction"))
    return augment.union_augmented(primary, augment.augment_rules(_first_headers(spark, d), "file_path", "header_json"))


# ---- counts, dedup, splits ------------------------------------------------------------------------------------------


@query("source_counts", "SELECT f.file_path, coalesce(n, 0) AS n_records FROM source_files f LEFT JOIN (SELECT _source, count(*) AS n FROM train GROUP BY 1) t ON f.file_path = t._source")
def _(spark, d):
    return report.source_counts(table(spark, d, "source_files"), table(spark, d, "train"))


@query("dedup_keep_first", f"SELECT rec_id, _source, line_no, instruction, input, output FROM ({_FIRST})")
def _(spark, d):
    return _deduped(spark, d).select("rec_id", "_source", "line_no", *K.RECORD_KEYS)


@query("dedup_stats", "SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n_before, count(*) AS n_after, CAST(coalesce(sum(c), 0) - count(*) AS BIGINT) AS n_removed FROM (SELECT count(*) AS c FROM train GROUP BY instruction, input, output)")
def _(spark, d):
    return dedup.dedup_stats(table(spark, d, "train"))


@query("stratum_sizes", f"SELECT _source, itype, count(*) AS n FROM (SELECT *, {_ITYPE} AS itype FROM ({_FIRST})) GROUP BY 1, 2")
def _(spark, d):
    return report.stratum_sizes(_deduped(spark, d).withColumn("itype", X.instruction_type("instruction")), ["_source", "itype"])


@query("stratified_split", f"SELECT rec_id, _source, itype, split FROM ({_SPLIT})")
def _(spark, d):
    return _split(spark, d).select("rec_id", "_source", "itype", "split")


@query("seeded_shuffle", f"SELECT rec_id, split, row_number() OVER (PARTITION BY split ORDER BY {_H}, rec_id) AS rank FROM ({_SPLIT})")
def _(spark, d):
    return split.seeded_shuffle(stage(_split(spark, d).select("rec_id", "split")), "rec_id", ["split"])  # ranking reads its input twice


@query("split_summary", f"SELECT split, n, round(n * 100.0 / sum(n) OVER (), 1) AS pct FROM (SELECT split, count(*) AS n FROM ({_SPLIT}) GROUP BY 1)")
def _(spark, d):
    return report.split_summary(_split(spark, d))


@query("itype_by_split", f"SELECT itype, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM ({_SPLIT}) GROUP BY 1")
def _(spark, d):
    return report.itype_by_split(_split(spark, d), F.col("itype"))


@query("split_leakage", f"SELECT instruction, input, count(DISTINCT split) AS n_splits, count(*) AS n_rows FROM ({_SPLIT}) GROUP BY 1, 2 HAVING count(DISTINCT split) > 1")
def _(spark, d):
    return split.split_leakage(_split(spark, d, "instruction", "input"), ["instruction", "input"])


@query("split_peek", "SELECT split_name, count(*) AS n, arg_min(coalesce(instruction, ''), rec_id) AS first_instruction, arg_min(coalesce(input, ''), rec_id) AS first_input, arg_min(coalesce(output, ''), rec_id) AS first_output FROM test GROUP BY 1")
def _(spark, d):
    filled = table(spark, d, "test").select("rec_id", "split_name", *[F.coalesce(k, F.lit("")).alias(k) for k in K.RECORD_KEYS])
    return report.split_peek(filled, "rec_id", "split_name")


@query("sample_pairs", f"SELECT rec_id, split_name, input, output FROM (SELECT *, row_number() OVER (PARTITION BY split_name ORDER BY {_H}, rec_id) AS k FROM test) WHERE k <= 10")
def _(spark, d):
    return split.sample_pairs(table(spark, d, "test"), "rec_id", ["split_name"]).select("rec_id", "split_name", "input", "output")


# ---- sinks and validation -------------------------------------------------------------------------------------------


@query("to_jsonl", "SELECT CAST(json_object('instruction', instruction, 'input', input, 'output', output) AS VARCHAR) AS value FROM train")
def _(spark, d):
    return to_jsonl(table(spark, d, "train"))


@query(
    "validate_jsonl",
    """SELECT _source, line_no, CASE WHEN NOT json_valid(raw_line) THEN 'invalid' WHEN list_sort(json_keys(raw_line)) = ['input', 'instruction', 'output'] THEN 'ok' ELSE 'keys' END AS status
    FROM train_raw WHERE coalesce(raw_line, '') <> ''""",
)
def _(spark, d):
    return validate.validate_lines(table(spark, d, "train_raw"), "raw_line", ["_source", "line_no"])


# ---- prompts --------------------------------------------------------------------------------------------------------

_USER = "coalesce(instruction, '') || CASE WHEN length(coalesce(input, '')) > 0 THEN chr(10) || chr(10) || input ELSE '' END"
_SYS = K.SYSTEM_PROMPT.replace("'", "''")
_TURN = lambda r, c: f"'<|im_start|>{r}' || chr(10) || {c} || '<|im_end|>' || chr(10)"
_PROMPT = f"""{_TURN("system", f"'{_SYS}'")} || {_TURN("user", f"({_USER})")} || '<|im_start|>assistant' || chr(10)"""


@query("chat_format", f"SELECT rec_id, '{_SYS}' AS system_text, {_USER} AS user_text, coalesce(output, '') AS assistant_text FROM train")
def _(spark, d):
    m = table(spark, d, "train").select("rec_id", chat.messages().alias("m"))
    return m.select("rec_id", *[F.col("m")[i]["content"].alias(n) for i, n in enumerate(("system_text", "user_text", "assistant_text"))])


@query("chat_render", f"""SELECT rec_id, {_TURN("system", f"'{_SYS}'")} || {_TURN("user", f"({_USER})")} || {_TURN("assistant", "coalesce(output, '')")} AS training_text, {_PROMPT} AS prompt FROM train""")
def _(spark, d):
    return table(spark, d, "train").select("rec_id", chat.render(chat.messages()).alias("training_text"), chat.render(chat.messages(False), True).alias("prompt"))


_DIR = "CASE WHEN contains(instruction, 'Balanda to English') THEN 'b2e' ELSE 'e2b' END"


@query("eval_pairs", f"SELECT rec_id, {_DIR} AS direction, {_PROMPT} AS prompt, {_STRIP('''coalesce(output, '')''')} AS reference FROM test WHERE instruction IN ('{K.B2E}', '{K.E2B}')")
def _(spark, d):
    return chat.eval_pairs(table(spark, d, "test"))


@query("batch_slices", f"SELECT rec_id, direction, CAST(floor((row_number() OVER (PARTITION BY direction ORDER BY rec_id) - 1) / 8) AS BIGINT) AS batch_no FROM (SELECT rec_id, {_DIR} AS direction FROM train WHERE instruction IN ('{K.B2E}', '{K.E2B}'))")
def _(spark, d):
    t = table(spark, d, "train").where(F.col("instruction").isin(K.B2E, K.E2B)).select("rec_id", X.direction("instruction").alias("direction"))
    return chat.batch_slices(t, "rec_id", ["direction"])


# ---- metrics: the untranslated input as hypothesis (the copy baseline) ------------------------------------------------


def _copy_baseline(spark, d):
    t = table(spark, d, "train").where(F.col("instruction").isin(K.B2E, K.E2B))
    return t.select(X.direction("instruction").alias("direction"), F.coalesce("input", F.lit("")).alias("hyp"), F.coalesce("output", F.lit("")).alias("ref"))


_PAIRS = f"SELECT rec_id AS id, {_DIR} AS direction, coalesce(input, '') AS hyp, coalesce(output, '') AS ref FROM train WHERE instruction IN ('{K.B2E}', '{K.E2B}')"
_SIDES = f"SELECT id, direction, 'h' AS side, hyp AS s FROM ({_PAIRS}) UNION ALL SELECT id, direction, 'r', ref FROM ({_PAIRS})"
_WORDS = f"SELECT id, direction, side, regexp_extract_all(s, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_{_WS[1:-1]}]') AS t FROM ({_SIDES})"
_WORD_GRAMS = lambda top, mark: f"SELECT id, direction, side, '{mark}' || n AS gram, array_to_string(t[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(t) - n + 2)) AS i FROM ({_WORDS}), (SELECT unnest(range(1, {top + 1})) AS n))"
_CHAR_GRAMS = f"""SELECT id, direction, side, 'c' || n AS gram, substr(s, i, n) AS g FROM (SELECT *, unnest(range(1, length(s) - n + 2)) AS i
  FROM (SELECT id, direction, side, regexp_replace(s, '{_WS}', '', 'g') AS s FROM ({_SIDES})), (SELECT unnest(range(1, {metrics.CHAR_ORDER + 1})) AS n))"""


def _stats_sql(grams: str, orders: list[str]) -> str:
    """Clipped n-gram statistics for each direction and order, also of orders without any n-gram."""
    return f"""WITH gr AS MATERIALIZED (SELECT id, direction, side, gram, g, count(*) AS c FROM ({grams}) GROUP BY ALL),
      m AS (SELECT a.direction, a.gram, sum(least(a.c, b.c)) AS matches FROM gr a JOIN gr b ON a.id = b.id AND a.gram = b.gram AND a.g = b.g AND a.side = 'h' AND b.side = 'r' GROUP BY 1, 2),
      t AS (SELECT direction, gram, sum(CASE WHEN side = 'h' THEN c END) AS n_hyp, sum(CASE WHEN side = 'r' THEN c END) AS n_ref FROM gr GROUP BY 1, 2),
      p AS (SELECT direction, count(*) AS pairs FROM ({_PAIRS}) GROUP BY 1), o AS (SELECT unnest({orders}) AS gram)
      SELECT p.direction, o.gram, CAST(coalesce(matches, 0) AS BIGINT) AS matches, CAST(coalesce(n_hyp, 0) AS BIGINT) AS n_hyp, CAST(coalesce(n_ref, 0) AS BIGINT) AS n_ref, pairs
      FROM p CROSS JOIN o LEFT JOIN m USING (direction, gram) LEFT JOIN t USING (direction, gram)"""


_CHRF_STATS = _stats_sql(f"{_CHAR_GRAMS} UNION ALL {_WORD_GRAMS(metrics.WORD_ORDER, 'w')}", [f"c{n + 1}" for n in range(metrics.CHAR_ORDER)] + [f"w{n + 1}" for n in range(metrics.WORD_ORDER)])
_BLEU_STATS = _stats_sql(_WORD_GRAMS(metrics.BLEU_ORDER, ""), [str(n + 1) for n in range(metrics.BLEU_ORDER)])
_CHRF = f"""SELECT direction, max(pairs) AS n_pairs, round(100 * coalesce(avg(f), 0), 4) AS chrf FROM (
  SELECT *, CASE WHEN n_hyp > 0 AND n_ref > 0 THEN CASE WHEN matches > 0 THEN 5 * (matches / n_hyp) * (matches / n_ref) / (4 * (matches / n_hyp) + matches / n_ref) ELSE 0 END END AS f FROM ({_CHRF_STATS})) GROUP BY 1"""
_BLEU = f"""SELECT direction, n_pairs, round(CASE WHEN m1 > 0 AND low > 0 THEN 100 * exp(logs / 4) * CASE WHEN h < r THEN exp(1 - r / h) ELSE 1 END ELSE 0 END, 4) AS bleu FROM (
  SELECT direction, max(pairs) AS n_pairs, min(n_hyp) AS low, sum(CASE WHEN n_hyp > 0 THEN ln(greatest(matches, 0.5) / n_hyp) END) AS logs,
  max(CASE WHEN gram = '1' THEN matches END) AS m1, max(CASE WHEN gram = '1' THEN n_hyp END) AS h, max(CASE WHEN gram = '1' THEN n_ref END) AS r FROM ({_BLEU_STATS}) GROUP BY 1)"""


@query("chrf_stats", _CHRF_STATS)
def _(spark, d):
    return metrics.chrf_stats(_copy_baseline(spark, d))


@query("chrf_score", _CHRF)
def _(spark, d):
    return metrics.chrf_score(metrics.chrf_stats(_copy_baseline(spark, d)))


@query("bleu_stats", _BLEU_STATS)
def _(spark, d):
    return metrics.bleu_stats(_copy_baseline(spark, d))


@query("bleu_score", _BLEU)
def _(spark, d):
    return metrics.bleu_score(metrics.bleu_stats(_copy_baseline(spark, d)))


@query(
    "eval_report",
    f"""SELECT d.direction, coalesce(c.n_pairs, 0) AS n_pairs, round(chrf, 2) AS chrf, round(bleu, 2) AS bleu
    FROM (VALUES ('b2e'), ('e2b')) d(direction) LEFT JOIN ({_CHRF}) c USING (direction) LEFT JOIN ({_BLEU}) b USING (direction)""",
)
def _(spark, d):
    directions = spark.createDataFrame([("b2e",), ("e2b",)], "direction string")
    return metrics.eval_report(_copy_baseline(spark, d), directions)
