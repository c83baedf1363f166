"""SQL with the same result, where SQL can express a query over whole tables."""

from __future__ import annotations

from ..functions import constants as K

_CANON = lambda x: rf"trim(regexp_replace(lower(replace(regexp_replace(upper(coalesce({x}, '')), '\p{{P}}+', '', 'g'), 'ß', 'SS')), '{K.WS}+', ' ', 'g'))"
_RECORDS = """SELECT rec_id, instruction, input, output FROM train UNION ALL
  SELECT rec_id, raw_line ->> '$.instruction', raw_line ->> '$.input', raw_line ->> '$.output' FROM (SELECT * FROM train_raw WHERE json_valid(raw_line)) WHERE json_type(raw_line) = 'OBJECT'"""
_GROUPED = f"""SELECT rec_id, min(rec_id) OVER (PARTITION BY ci, cn, co) AS keep_id FROM (
  SELECT rec_id, {_CANON("instruction")} AS ci, {_CANON("input")} AS cn, {_CANON("output")} AS co FROM ({_RECORDS}))"""

SQL = {
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p1_found": f"SELECT keep_id, rec_id AS dup_id FROM ({_GROUPED}) WHERE rec_id <> keep_id",
    "p1_groups": f"SELECT keep_id, count(*) AS n_copies FROM ({_GROUPED}) GROUP BY 1",
}
