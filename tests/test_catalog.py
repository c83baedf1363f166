"""Every query with SQL gives the same rows as that SQL."""

import json
import os
from collections import Counter

import pytest

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")

import __spark_entry__ as entry  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
    assert Counter(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_core_does_not_import_the_subpackage():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, names in os.walk(os.path.join(root, "millrace")):
        if f"{os.sep}llm" not in folder:
            for n in names:
                if n.endswith(".py"):
                    text = open(os.path.join(folder, n), encoding="utf-8").read()
                    assert "from .llm" not in text and "from ..llm" not in text and "millrace.llm" not in text, n


def test_raw_lines_are_every_valid_line(spark):
    def record(line):
        try:
            v = json.loads(line or "")
        except ValueError:
            return None
        return v if isinstance(v, dict) and {"instruction", "input", "output"} <= set(v) else None

    spell = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))
    lines = {r.rec_id: record(r.raw_line) for r in spark.read.parquet(f"{DATA}/train_raw.parquet").collect()}
    want = {k: (spell(v["input"]), spell(v["output"])) for k, v in lines.items() if v}
    got = {r.rec_id: (r.input, r.output) for r in entry.queries()["normalize_records"](spark, DATA).collect() if r.rec_id in lines}
    assert want and got == want and len(want) < len(lines)
