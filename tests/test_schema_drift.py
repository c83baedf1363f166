import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import schema_drift as S

BASE = {"instruction_type": "x", "grammar_name": "x", "description": "x", "rules": {"r": {"function": "x", "structure": "x", "notes": "x"}}}


def jtype(v):
    return set() if v is None else {"boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object" if isinstance(v, dict) else "number"}


def rules_of(h):
    keys = [k for k in h if "rule" in k.lower()]
    keys = [k for k in keys if isinstance(h[k], (dict, list))] or keys
    v = h[keys[0]] if keys else None
    return list(v.items()) if isinstance(v, dict) else [(e.get("name") if isinstance(e, dict) else None, e) for e in v] if isinstance(v, list) else []


def brute(revisions):
    """The statement's rules, one revision after the other, without any matching of schemas."""
    same = lambda a, b: json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True)
    out, first, rfirst = [], True, True
    top, ttypes = BASE, {k: jtype(v) for k, v in BASE.items()}
    ents, etypes, rule = dict(rules_of(BASE)), {k: {"string"} for k in ("function", "structure", "notes")}, {"object"}
    for rev, h in revisions:
        gone, came = [k for k in top if k not in h], [k for k in h if k not in top]
        for k in list(gone):
            y = next((y for y in came if not first and same(top[k], h[y]) and h[y] not in (None, "", [], {})), None)
            if y is not None:
                came.remove(y)
                gone.remove(k)
                out.append((rev, k, "renamed"))
        out += [(rev, k, "removed") for k in gone] + [(rev, k, "added") for k in came]
        types = {k: jtype(v) or (ttypes[k] if k in top else set()) for k, v in h.items()}
        out += [(rev, k, "retyped") for k in h if k in top and types[k] and ttypes[k] and types[k] != ttypes[k]]
        top, ttypes, first = h, types, False
        entries = rules_of(h)
        kinds = set().union(*[jtype(e) for _, e in entries]) if entries else set()
        if kinds:
            if kinds != rule:
                out.append((rev, "rule", "retyped"))
            rule = kinds
        objs = {n: e for n, e in entries if isinstance(e, dict)}
        if not objs:
            continue
        types = {}
        for e in objs.values():
            for k, v in e.items():
                types[k] = types.get(k, set()) | jtype(v)
        types = {k: t or etypes.get(k, set()) for k, t in types.items()}
        gone, came = [k for k in etypes if k not in types], [k for k in types if k not in etypes]
        for k in list(gone):
            for y in list(came):
                both = [(ents[n][k], objs[n][y]) for n in objs if n in ents and k in ents[n] and y in objs[n]]
                if not rfirst and both and all(same(a, b) for a, b in both) and any(b not in (None, "", [], {}) for _, b in both):
                    came.remove(y)
                    gone.remove(k)
                    out.append((rev, f"rule.{k}", "renamed"))
                    break
        out += [(rev, f"rule.{k}", "removed") for k in gone] + [(rev, f"rule.{k}", "added") for k in came]
        out += [(rev, f"rule.{k}", "retyped") for k in types if k in etypes and types[k] and etypes[k] and types[k] != etypes[k]]
        ents, etypes, rfirst = objs, types, False
    return out


def evolve(rng, n):
    h = {"instruction_type": "grammar_rule", "grammar_name": "g1", "description": "d", "rules": {f"r{i}": {"function": f"f{i}", "structure": f"s{i}", "notes": ""} for i in range(3)}}
    for rev in range(1, n + 1):
        h = json.loads(json.dumps(h))
        for _ in range(rng.randint(0, 2)):
            key = next(k for k in h if "rule" in k.lower())
            box = h[key]
            es = [e for e in (box.values() if isinstance(box, dict) else box) if isinstance(e, dict)]
            what = rng.randint(0, 9)
            if what == 0:
                k = rng.choice(list(h))
                new = rng.choice(["x_", "y_"]) + k if "rule" not in k.lower() else rng.choice(["Rules", "ruleEntries", "rule_set"])
                if new not in h:
                    h[new] = h.pop(k)
            elif what == 1:
                h[f"extra{rng.randint(0, 3)}"] = rng.choice([1, "a", None, True, []])
            elif what == 2 and len(h) > 2:
                h.pop(rng.choice([k for k in h if k != key]), None)
            elif what == 3:
                k = rng.choice([k for k in h if k != key])
                h[k] = rng.choice([None, 1, "t", ["t"], {"a": 1}])
            elif what == 4:
                h[key] = [{"name": k, **e} for k, e in box.items() if isinstance(e, dict)] if isinstance(box, dict) else {e.get("name", str(i)): {k: v for k, v in e.items() if k != "name"} for i, e in enumerate(box) if isinstance(e, dict)}
            elif what == 5 and es:
                old, new = rng.choice(["function", "structure", "fn"]), rng.choice(["fn", "st", "function"])
                for e in es:
                    if old in e and new not in e:
                        e[new] = e.pop(old)
            elif what == 6 and es:
                rng.choice(es)["since"] = rng.choice([1, "u", None])
            elif what == 7 and es:
                e = rng.choice(es)
                e["notes"] = rng.choice(["n", ["n"], None])
            elif what == 8 and isinstance(box, dict):
                h[key] = {**box, f"r{rng.randint(5, 9)}": rng.choice(["text", None, {"function": "z"}])}
            elif what == 9:
                h[key] = rng.choice([{}, [], box])
        yield rev, h


def frame(spark, data):
    return spark.createDataFrame([(f, r, json.dumps(h), i) for i, (f, r, h) in enumerate(data)], "file_id bigint, rev_no int, header_json string, i int").withColumn("loaded_at", F.to_timestamp(F.lit("2025-01-01")))


@pytest.mark.parametrize("block", [S.BLOCK, 2, 3])
def test_against_brute_force(spark, block):
    rng = random.Random(7)
    data = [(f, r, h) for f in range(40) for r, h in evolve(rng, rng.randint(1, 12))]
    want = sorted((f, *x) for f in range(40) for x in brute([(r, h) for g, r, h in data if g == f]))
    df = frame(spark, data)
    twice = df.unionAll(df.where("i % 3 = 0")).repartition(5).withColumns({c: F.lit("z") for c in ("block", "state", "summary", "lo", "hi")})
    got = sorted(tuple(r) for r in S.changes(twice, block).collect())
    assert got == want


def test_odd_rows(spark, rows):
    data = [(1, 1, "{bad"), (1, 2, None), (1, 3, "[]"), (None, 1, "{}"), (2, None, "{}"), (3, 1, "{}"), (3, 7, json.dumps({"description": "d" * 100_000}))]
    df = spark.createDataFrame(data, "file_id bigint, rev_no int, header_json string").withColumn("loaded_at", F.lit(None).cast("timestamp"))
    assert rows(S.changes(df)) == sorted([(3, 1, k, "removed") for k in S.BASE_FIELDS] + [(3, 7, "description", "added")], key=repr)
    assert S.changes(df.limit(0)).count() == 0 and S.unified(df.limit(0)).count() == 0
    assert S.unified(df).count() == 2


def test_flooding_prefers_equal_values_and_names():
    found = S.correspondences({"alpha": ["string"], "beta": ["string"]}, {"alphaName": ["string"], "other": ["string"]}, {"alpha": ["1"], "beta": ["2"]}, {"alphaName": ["1"], "other": ["2"]})
    assert {(a, b) for a, b, _ in found} == {("alpha", "alphaName"), ("beta", "other")}
    crossed = S.correspondences({"p": ["string"], "q": ["string"]}, {"x": ["string"], "y": ["string"]}, {"p": ["1"], "q": ["2"]}, {"x": ["2"], "y": ["1"]})
    assert {(a, b) for a, b, _ in crossed} == {("p", "y"), ("q", "x")}
    named = S.correspondences({"grammar_name": ["string"], "rules": ["object"]}, {"ruleEntries": ["array"], "grammarName": ["string"]}, {}, {})
    assert ("grammar_name", "grammarName") in {(a, b) for a, b, _ in named}


def test_verification_rejects_and_selection_goes_on():
    args = ({"p": ["string"], "q": ["string"]}, {"pp": ["string"], "z": ["string"]}, {"p": ["1"], "q": ["2"]}, {"pp": ["2"], "z": ["1"]})
    asked = []

    def holds(x, y):
        asked.append((x, y))
        return (x, y) == ("p", "z")

    assert [(x, y) for x, y, _ in S.correspondences(*args, holds)] == [("p", "z")] and len(asked) > 1


@pytest.mark.parametrize("name", ["name", "gname", "grammar", "grammar_title", "Grammar_Name", "grammarName"])
def test_base_names_by_flooding(name):
    header = {"instruction_type": ["string"], name: ["string"], "description": ["string"], "ruleEntries": ["array"], "level": ["number"], "owner": ["string"]}
    assert S.by_name(S.BASE_FIELDS, header) == {name: "grammar_name", "ruleEntries": "rules"}


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01/v1_headers.parquet"), reason="no tables")
def test_unified_holds_every_value(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/v1_headers.parquet")

    def leaves(v):
        if isinstance(v, (dict, list)):
            return [y for x in (v.values() if isinstance(v, dict) else v) for y in leaves(x)]
        return [] if v is None else [v if isinstance(v, str) else json.dumps(v)]

    def opened(t):
        try:
            v = json.loads(t)
        except ValueError:
            return [t]
        return [t, *leaves(v)] if isinstance(v, (dict, list)) else [t]

    got = {(r.file_id, r.rev_no): r for r in S.unified(df).collect()}
    for r in S.revisions(df).collect():
        row = got[r.file_id, r.rev_no]
        texts = [row.instruction_type, row.grammar_name, row.description, *row.extra.values(), *row.lists.values()] + [t for rule in row.rules.values() for t in rule] + list(row.rules)
        there = Counter(x for t in texts if t is not None for x in opened(t))
        missing = Counter(leaves(json.loads(r.header_json))) - there
        assert not missing, (r.file_id, r.rev_no, missing)


def test_unified(spark):
    h1 = {"grammarName": "g", "instruction_type": "t", "rules": {"r": {"function": "f", "structure": ["s", "t"], "more": 1}}}
    h2 = {"title": "g", "instruction_type": "t", "ruleEntries": [{"name": "r", "func": "f", "structure": ["s", "t"], "more": 1}, "plain"], "level": 2}
    got = {r.rev_no: r for r in S.unified(frame(spark, [(1, 1, h1), (1, 2, h2)])).collect()}
    assert got[1].grammar_name == "g" and got[2].grammar_name == "g" and got[2].extra == {"level": "2"}
    assert got[1].rules["r"].function == "f" and got[2].rules["r"].function == "f" and got[2].rules["r"].structure == "s" and got[2].rules["r"].extra == '{"more": 1}' and got[2].rules["#1"].structure == "plain"


def test_unified_loses_no_value(spark):
    entries = [
        {"name": "r", "function": ["f1", "f2"], "structure": ["only"], "since": ["x", "y"]}, {"name": "r", "function": "g"}, {"name": 5, "notes": "n"}, ["p1", "p2"],
        {"name": "r", "notes": None, "structure": "z"},
    ]
    h1 = {"grammar_name": ["g1", "g2"], "tags": ["a", "b"], "rules": entries}
    h2 = {"grammar_name": "g", "rules": {"k": {"name": "own", "function": "f"}}}
    h3 = {"rules": "none yet", "description": ["d1", "d2", "d3"]}
    got = {r.file_id: r for r in S.unified(frame(spark, [(1, 1, h1), (2, 1, h2), (3, 1, h3)])).collect()}
    one = got[1]
    assert one.grammar_name == "g1" and one.lists == {"grammar_name": '["g1", "g2"]'} and one.extra == {"tags": '["a", "b"]'}
    assert sorted(one.rules) == ["#2", "#3", "r", "r#2", "r#3"] and one.rules["r#2"].function == "g" and one.rules["r#3"].structure == "z"
    first = one.rules["r"]
    assert first.function == "f1" and json.loads(first.lists) == {"function": ["f1", "f2"], "structure": ["only"]} and json.loads(first.extra) == {"since": ["x", "y"]}
    assert json.loads(one.rules["#2"].extra) == {"name": 5} and json.loads(one.rules["#3"].lists) == {"structure": ["p1", "p2"]}
    assert json.loads(got[2].rules["k"].extra) == {"name": "own"} and got[2].lists == {}
    assert got[3].extra == {"rules": "none yet"} and got[3].lists == {"description": '["d1", "d2", "d3"]'}


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01/v1_headers.parquet"), reason="no tables")
def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/v1_headers.parquet")
    by = {}
    for r in df.select("file_id", "rev_no", "header_json").distinct().orderBy("file_id", "rev_no").collect():
        by.setdefault(r.file_id, []).append((r.rev_no, json.loads(r.header_json)))
    want = sorted((f, *x) for f, revs in by.items() for x in brute(revs))
    assert sorted(tuple(r) for r in S.changes(df).collect()) == want
