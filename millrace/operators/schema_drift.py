"""Schemas that drift between revisions of a file: correspondences, a change report, one table.

Each header is turned into a schema graph (fields, their types, their nesting, what they hold).  The
graphs of neighbouring revisions are matched by similarity flooding (Melnik, Garcia-Molina, Rahm
2002): an initial similarity of names spreads along equally labelled edges until it no longer
changes, and a one-to-one set of correspondences is selected from the result.  The change report
takes its renamings from those correspondences; each is then verified against the values, which may
reject it but adds none.

Revisions of one file depend on each other in order.  To keep a file with a third of all rows out of
a single task, revisions are processed in blocks of :data:`BLOCK` revision numbers: blocks are
summarised in parallel, only the summaries of files with several blocks are folded in order, and each
block then starts from its folded state.
"""

from __future__ import annotations

import json
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.deepjson import dumps, loads

#: Revision numbers per block: bounds what one task sees of a file.
BLOCK = 256
#: Flooding stops when no similarity changes by more than this.
EPSILON, MAX_ROUNDS = 1e-4, 200
#: Least flooded similarity, relative to that of a field with itself, at which names without values to compare correspond
#: (for the unified table).  Renamings of the base header's fields reach 0.23 and more, other names at most 0.18.  Two names
#: have something in common from an initial similarity of SEED on.
NAME_MATCH, SEED = 0.2, 0.25

#: The header that the first revision is compared with.
BASE_FIELDS = {"instruction_type": ["string"], "grammar_name": ["string"], "description": ["string"], "rules": ["object"]}
BASE_RULE_FIELDS = {"function": ["string"], "structure": ["string"], "notes": ["string"]}
_INHERIT = "?"  # a type that only an earlier block knows


def json_type(v: object) -> list[str]:
    """The JSON type as a list of one name, none for null."""
    if v is None:
        return []
    if isinstance(v, bool):
        return ["boolean"]
    return ["string"] if isinstance(v, str) else ["array"] if isinstance(v, list) else ["object"] if isinstance(v, dict) else ["number"]


def canonical(v: object) -> str:
    """Equal for equal JSON values."""
    return dumps(v, ascii_only=True, separators=(",", ":"), sort_keys=True)


def _void(v: object) -> bool:
    return v is None or v == "" or v == [] or v == {}


def rule_container(header: dict) -> str | None:
    """The top-level key that holds the rules: the first with ``rule`` in its name that holds an object or list, else the first."""
    named = [k for k in header if "rule" in k.lower()]
    return next((k for k in named if isinstance(header[k], (dict, list))), named[0] if named else None)


def entries_of(header: dict) -> list[tuple[str | None, object]]:
    """``(id, value)`` of each rule; in a list the id is the entry's ``name``."""
    key = rule_container(header)
    box = header.get(key) if key is not None else None
    if isinstance(box, dict):
        return list(box.items())
    if isinstance(box, list):
        return [(e["name"] if isinstance(e, dict) and isinstance(e.get("name"), str) else None, e) for e in box]
    return []


# ---- similarity flooding --------------------------------------------------------------------------------------------


def name_similarity(a: str, b: str) -> float:
    """Dice coefficient of the letter trigrams of two names, blind to case and to how words are joined."""

    def grams(s: str) -> set[str]:
        s = "".join(c.lower() for c in s if c.isalnum())
        s = f"  {s} "
        return {s[i : i + 3] for i in range(len(s) - 2)}

    x, y = grams(a), grams(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x and y else 0.0


def flood(edges_a: list[tuple], edges_b: list[tuple], initial: dict[tuple, float]) -> dict[tuple, float]:
    """Flooded similarity of node pairs.

    Edges are ``(source, label, target)``.  A pair of nodes and a pair of their neighbours over equal
    labels exchange similarity in both directions, shared out evenly over the pairs that a label
    reaches.  Iterated with the initial similarities added in each round and scaled to a maximum of 1,
    until the largest change is below :data:`EPSILON`.
    """
    by_label = defaultdict(list)
    for s, label, t in edges_b:
        by_label[label].append((s, t))
    flows: dict[tuple, list[tuple[tuple, str]]] = defaultdict(list)
    for s, label, t in edges_a:
        for s2, t2 in by_label[label]:
            flows[(s, s2)].append(((t, t2), label))
            flows[(t, t2)].append(((s, s2), "-" + label))
    share: list[tuple[tuple, tuple, float]] = []
    for pair, out in flows.items():
        count: dict[str, int] = defaultdict(int)
        for _, label in out:
            count[label] += 1
        share += [(pair, other, 1 / count[label]) for other, label in out]
    first = {p: initial.get(p, 0.0) for p in flows} | initial
    now = dict(first)
    for _ in range(MAX_ROUNDS):
        new = {p: v + first[p] for p, v in now.items()}
        for p, q, w in share:
            new[q] += w * (now[p] + first[p])
        top = max(new.values(), default=0.0) or 1.0
        new = {p: v / top for p, v in new.items()}
        moved = max((abs(new[p] - now[p]) for p in new), default=0.0)
        now = new
        if moved < EPSILON:
            break
    return now


def schema_graph(fields: dict[str, list[str]], held: dict[str, list[str]]) -> list[tuple]:
    """Edges of a schema graph: the record has fields, a field has types and holds what ``held`` lists."""
    edges = []
    for name, types in fields.items():
        edges.append((("record",), "field", ("field", name)))
        edges += [(("field", name), "type", ("type", t)) for t in types]
        edges += [(("field", name), "holds", ("value", v)) for v in held.get(name, ())]
    return edges


def similarities(old: dict[str, list[str]], new: dict[str, list[str]], held_old: dict[str, list[str]], held_new: dict[str, list[str]]) -> dict[tuple[str, str], float]:
    """Converged similarity of each pair of an old and a new name.  A name that both have only corresponds to itself."""
    both = old.keys() & new.keys()
    start = {(("field", x), ("field", y)): name_similarity(x, y) for x in old for y in new if x == y or not {x, y} & both}
    there = {v for y in held_new.values() for v in y}
    start |= {(("value", v), ("value", v)): 1.0 for x in held_old.values() for v in x if v in there}
    types = {t for x in old.values() for t in x} & {t for x in new.values() for t in x}
    start |= {(("type", t), ("type", t)): 0.5 for t in types}
    sim = flood(schema_graph(old, held_old), schema_graph(new, held_new), start)
    return {(x, y): sim.get((("field", x), ("field", y)), 0.0) for x in old for y in new}


def selection(pairs: dict[tuple[str, str], float]) -> list[tuple[str, str, float]]:
    """One-to-one ``(old name, new name, similarity)`` by similarity relative to the best of either name."""
    best: dict[tuple[int, str], float] = defaultdict(float)
    for (x, y), s in pairs.items():
        best[0, x], best[1, y] = max(best[0, x], s), max(best[1, y], s)
    left, right, chosen = set(), set(), []
    for _, s, x, y in sorted((-min(s / best[0, x], s / best[1, y]), -s, x, y) for (x, y), s in pairs.items() if s > 0):
        if x not in left and y not in right:
            left.add(x)
            right.add(y)
            chosen.append((x, y, -s))
    return chosen


def correspondences(old: dict[str, list[str]], new: dict[str, list[str]], held_old: dict[str, list[str]], held_new: dict[str, list[str]], holds=None) -> list[tuple[str, str, float]]:
    """The :func:`selection` from the converged similarities of two schemas.

    ``holds(a, b)`` verifies what was selected: a pair that fails is rejected, and the selection is made
    anew without it until all that is selected holds.
    """
    pairs = similarities(old, new, held_old, held_new)
    while True:
        chosen = selection(pairs)
        wrong = [(x, y) for x, y, _ in chosen if holds is not None and not holds(x, y)]
        if not wrong:
            return chosen
        for w in wrong:
            del pairs[w]


def by_name(old: dict[str, list[str]], new: dict[str, list[str]]) -> dict[str, str]:
    """``{new name: old name}`` of the names that only one side has, where there are no values to compare.

    Whole schemas are flooded, so that the fields that both have set the scale: a selected pair counts if
    its similarity is at least :data:`NAME_MATCH` of the greatest of a field with itself.
    """
    pairs = similarities(old, new, {}, {})
    scale = max((pairs[k, k] for k in old.keys() & new.keys()), default=1.0)
    apart = {(x, y): s for (x, y), s in pairs.items() if x not in new and y not in old and name_similarity(x, y) >= SEED}
    return {y: x for x, y, s in selection(apart) if s >= NAME_MATCH * scale}


# ---- one step from a revision to the next ---------------------------------------------------------------------------


def base_state() -> dict:
    """What is known before the first revision of a file."""
    return {
        "top": {k: {"t": t, "v": None} for k, t in BASE_FIELDS.items()}, "entries": {}, "rtypes": dict(BASE_RULE_FIELDS), "rule": ["object"],
        "base": True, "rbase": True, "alias": {k: k for k in BASE_FIELDS}, "ralias": {k: k for k in BASE_RULE_FIELDS},
    }


def _carried(value_types: list[str], known: dict | None, name: str, was_there: bool) -> list[str]:
    return value_types or ([_INHERIT] if known is None else known.get(name, []) if was_there else [])


def step(state: dict | None, header: dict) -> tuple[dict, list[tuple[str, str]]]:
    """The state after ``header`` and its changes ``(field_name, change)``.  ``state`` None: nothing is known yet."""
    changes: list[tuple[str, str]] = []
    prev = state["top"] if state else {}
    text = {k: canonical(v) for k, v in header.items()}
    types = {k: _carried(json_type(v), {n: x["t"] for n, x in prev.items()} if state else None, k, k in prev) for k, v in header.items()}
    gone, came = [k for k in prev if k not in header], [k for k in header if k not in prev]
    alias = {k: state["alias"].get(k, k) for k in header if k in prev} if state else {k: k for k in header}
    if state:
        renamed = {}
        if state["base"]:
            # No values to compare: names and types decide which field of the one table a new name feeds.
            guess = by_name({k: x["t"] for k, x in prev.items()}, types) if gone and came else {}
        else:
            guess = {}
            if gone and came:
                same = lambda x, y: prev[x]["v"] == text[y] and not _void(header[y])
                found = correspondences({k: prev[k]["t"] for k in gone}, {k: types[k] for k in came}, {k: [prev[k]["v"]] for k in gone}, {k: [text[k]] for k in came}, same)
                renamed = {x: y for x, y, _ in found}
        came_by = {y: x for x, y in renamed.items()}
        for k in came:
            alias[k] = state["alias"].get(came_by[k], came_by[k]) if k in came_by else guess.get(k, k)
        changes += [(k, "renamed" if k in renamed else "removed") for k in gone] + [(k, "added") for k in came if k not in came_by]
        changes += [(k, "retyped") for k in header if k in prev and types[k] and prev[k]["t"] and sorted(types[k]) != sorted(prev[k]["t"])]
    new = {"top": {k: {"t": types[k], "v": text[k]} for k in header}, "alias": alias, "base": False}

    entries = entries_of(header)
    kinds = sorted({t for _, e in entries for t in json_type(e)})
    known = state["rule"] if state else [_INHERIT]
    if kinds:
        if state and known and kinds != sorted(known):
            changes.append(("rule", "retyped"))
        new["rule"] = kinds
    else:
        new["rule"] = known
    objects = [(n if n is not None else f"#{i}", e) for i, (n, e) in enumerate(entries) if isinstance(e, dict)]
    if not objects:
        new |= {"entries": state["entries"] if state else None, "rtypes": state["rtypes"] if state else None, "rbase": state["rbase"] if state else False, "ralias": state["ralias"] if state else None}
        return new, changes
    seen: dict[str, list[str]] = {}
    for _, e in objects:
        for k, v in e.items():
            seen.setdefault(k, [])
            seen[k] = sorted({*seen[k], *json_type(v)})
    before = state["rtypes"] if state else None
    first_look = state is not None and before is None
    if first_look:
        before = None
    rtypes = {k: _carried(t, before, k, before is not None and k in before) for k, t in seen.items()}
    table = {n: {k: canonical(v) for k, v in e.items()} for n, e in objects}
    ralias = {k: (state["ralias"] or {}).get(k, k) if state else k for k in seen}
    if before is not None:
        gone, came = [k for k in before if k not in seen], [k for k in seen if k not in before]
        renamed = {}
        if gone and came and not state["rbase"]:
            old_table = state["entries"]

            def same(x: str, y: str) -> bool:
                both = [(old_table[n][x], table[n][y]) for n in table if n in old_table and x in old_table[n] and y in table[n]]
                return bool(both) and all(p == q for p, q in both) and any(q not in ("null", '""', "[]", "{}") for _, q in both)

            held_old = {k: [f"{n}={e[k]}" for n, e in old_table.items() if k in e] for k in gone}
            held_new = {k: [f"{n}={e[k]}" for n, e in table.items() if k in e] for k in came}
            renamed = {x: y for x, y, _ in correspondences({k: before[k] for k in gone}, {k: rtypes[k] for k in came}, held_old, held_new, same)}
        elif gone and came:
            ralias |= by_name(before, rtypes)
        came_by = {y: x for x, y in renamed.items()}
        for y, x in came_by.items():
            ralias[y] = state["ralias"].get(x, x)
        changes += [(f"rule.{k}", "renamed" if k in renamed else "removed") for k in gone] + [(f"rule.{k}", "added") for k in came if k not in came_by]
        changes += [(f"rule.{k}", "retyped") for k in seen if k in before and rtypes[k] and before[k] and sorted(rtypes[k]) != sorted(before[k])]
    new |= {"entries": table, "rtypes": rtypes, "rbase": False, "ralias": ralias}
    return new, changes


def fold(state: dict, first: dict, rest: dict) -> dict:
    """The state after a block that begins with ``first`` and whose own state, from nothing known, is ``rest``."""
    start, _ = step(state, first)
    out = dict(rest)
    out["top"] = {k: {"t": start["top"].get(k, {"t": []})["t"] if x["t"] == [_INHERIT] else x["t"], "v": x["v"]} for k, x in rest["top"].items()}
    out["alias"] = {k: start["alias"].get(a, a) for k, a in rest["alias"].items()}
    out["rule"] = start["rule"] if rest["rule"] == [_INHERIT] else rest["rule"]
    if rest["entries"] is None:
        return out | {k: start[k] for k in ("entries", "rtypes", "rbase", "ralias")}
    before = start["rtypes"] or {}
    out["rtypes"] = {k: before.get(k, []) if t == [_INHERIT] else t for k, t in rest["rtypes"].items()}
    out["ralias"] = {k: (start["ralias"] or {}).get(a, a) for k, a in rest["ralias"].items()}
    return out


def load(text: str | None) -> dict | None:
    """A header, None where the text is no JSON object."""
    try:
        v = loads(text or "")
    except ValueError:
        return None
    return v if isinstance(v, dict) else None


# ---- distribution ---------------------------------------------------------------------------------------------------


def revisions(headers: DataFrame) -> DataFrame:
    """``file_id, rev_no, header_json``, one row a revision: of rows delivered twice the earliest loaded, then the smallest text."""
    d = headers.where("file_id IS NOT NULL AND rev_no IS NOT NULL")
    one = F.min_by("header_json", F.struct(F.coalesce("loaded_at", F.lit("9999-12-31").cast("timestamp")), "header_json"))
    return d.groupBy("file_id", F.col("rev_no").cast("bigint").alias("rev_no")).agg(one.alias("header_json"))


def _walk(headers: DataFrame, emit, schema: pa.Schema, ddl: str, block: int) -> DataFrame:
    """Run ``emit(file_id, rev_no, header, state before, state after, changes)`` over all revisions in order."""
    number = F.floor(F.col("rev_no") / block).cast("bigint")
    revs = revisions(headers).withColumn("block", number)

    # Files with several blocks: summaries, then the state that each of their blocks starts from.
    spans = revs.groupBy("file_id").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).where("lo < hi")
    long = revs.join(spans, "file_id")

    def summarise(batches):
        key, first, state = None, None, None

        def done():
            if first is not None:
                yield pa.RecordBatch.from_pydict({"file_id": [key[0]], "block": [key[1]], "summary": [json.dumps([first, state])]}, schema=pa.schema([("file_id", pa.int64()), ("block", pa.int64()), ("summary", pa.string())]))

        for b in batches:
            for f, k, text in zip(*(b.column(c).to_pylist() for c in ("file_id", "block", "header_json"))):
                if (f, k) != key:
                    yield from done()
                    key, first, state = (f, k), None, None
                header = load(text)
                if header is not None:
                    first = header if first is None else first
                    state = step(state, header)[0]
        yield from done()

    parts = long.where("block < hi").repartition("file_id", "block").sortWithinPartitions("file_id", "block", "rev_no").select("file_id", "block", "header_json")
    summaries = parts.mapInArrow(summarise, "file_id bigint, block bigint, summary string")

    def starts(batches):
        key, state = None, None
        for b in batches:
            out = ([], [], [])
            for f, k, s in zip(*(b.column(c).to_pylist() for c in ("file_id", "block", "summary"))):
                if f != key:
                    key, state = f, base_state()
                if s is None:  # a block of the file: say what it starts from
                    for o, x in zip(out, (f, k, json.dumps(state))):
                        o.append(x)
                else:
                    state = fold(state, *json.loads(s))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["file_id", "block", "state"])

    asked = long.where("block > lo").select("file_id", "block").distinct().withColumn("summary", F.lit(None).cast("string"))
    ordered = summaries.unionByName(asked).withColumn("o", F.col("summary").isNotNull()).repartition("file_id").sortWithinPartitions("file_id", "block", "o").drop("o")
    states = ordered.mapInArrow(starts, "file_id bigint, block bigint, state string")

    rows = revs.withColumn("state", F.lit(None).cast("string")).unionByName(states.select("file_id", F.lit(None).cast("bigint").alias("rev_no"), F.lit(None).cast("string").alias("header_json"), "block", "state"))
    rows = rows.repartition("file_id", "block").sortWithinPartitions("file_id", "block", F.col("rev_no").asc_nulls_first())

    def run(batches):
        key, state = None, None
        for b in batches:
            out: list[tuple] = []
            for f, r, text, k, s in zip(*(b.column(c).to_pylist() for c in ("file_id", "rev_no", "header_json", "block", "state"))):
                if (f, k) != key:
                    key, state = (f, k), base_state()
                if s is not None:
                    state = json.loads(s)
                    continue
                header = load(text)
                if header is not None:
                    state, changes = step(state, header)
                    out.extend(emit(f, r, header, state, changes))
            cols = list(zip(*out)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return rows.select("file_id", "rev_no", "header_json", "block", "state").mapInArrow(run, ddl)


def changes(headers: DataFrame, block: int = BLOCK) -> DataFrame:
    """``file_id, rev_no, field_name, change`` of each revision against the one before, the first against the base header.

    Rows without file_id or rev_no, and texts that are no JSON object, are passed over.  A field that
    was null ever since it was added has no type yet, so its first type is no change.
    """
    schema = pa.schema([("file_id", pa.int64()), ("rev_no", pa.int64()), ("field_name", pa.string()), ("change", pa.string())])

    def emit(f, r, header, state, found):
        for name, change in found:
            yield f, r, name.encode("utf-8", "replace").decode("utf-8"), change

    return _walk(headers, emit, schema, "file_id bigint, rev_no bigint, field_name string, change string", block)


def unified(headers: DataFrame, block: int = BLOCK) -> DataFrame:
    """All revisions in one schema: ``file_id, rev_no, instruction_type, grammar_name, description, rules, extra, lists``.

    Each field feeds the column that its correspondences lead back to; values are cast to text (lists
    and objects as JSON, a list of strings by its first item, the whole list then being in ``lists``).
    ``rules`` is a map of rule name to ``function, structure, notes``, the rest as JSON and, as JSON,
    the ``lists``; fields without a column go to ``extra``.  A name that is taken gets a number, so
    that each value of a header is somewhere in its row.
    """
    rule = pa.struct([(c, pa.string()) for c in ("function", "structure", "notes", "extra", "lists")])
    texts = pa.map_(pa.string(), pa.string())
    schema = pa.schema([("file_id", pa.int64()), ("rev_no", pa.int64()), ("instruction_type", pa.string()), ("grammar_name", pa.string()), ("description", pa.string()), ("rules", pa.map_(pa.string(), rule)), ("extra", texts), ("lists", texts)])
    ddl = "file_id bigint, rev_no bigint, instruction_type string, grammar_name string, description string, rules map<string, struct<function: string, structure: string, notes: string, extra: string, lists: string>>, extra map<string, string>, lists map<string, string>"

    def text(v):
        s = v if v is None or isinstance(v, str) else dumps(v)
        return s if s is None else s.encode("utf-8", "replace").decode("utf-8")

    def cell(v, column, lists):
        """The text of a value in its column; a list of strings is kept in ``lists``."""
        if isinstance(v, list) and v and all(isinstance(x, str) for x in v):
            lists[column] = v
            return text(v[0])
        return text(v)

    def put(into, taken, name, v):
        to = name
        while to in into:
            taken[name] = taken.get(name, 1) + 1
            to = f"{name}#{taken[name]}"
        into[to] = v

    def emit(f, r, header, state, found):
        box = rule_container(header)
        top, extra, lists, taken = {}, {}, {}, {}
        for k, v in header.items():
            to = state["alias"].get(k, k)
            if k == box and (v is None or isinstance(v, (dict, list))):
                continue
            if to in BASE_FIELDS and to != "rules" and to not in top:
                top[to] = cell(v, to, lists)
            else:
                put(extra, taken, text(to), text(v))
        rules, used = {}, {}
        for n, (name, e) in enumerate(entries_of(header)):
            cols, rest, more, again = {}, {}, {}, {}
            for k, v in (e.items() if isinstance(e, dict) else [("structure", e)]):
                to = (state["ralias"] or {}).get(k, k)
                if to in BASE_RULE_FIELDS and to not in cols:
                    cols[to] = cell(v, to, more)
                elif k != "name" or name is None or isinstance(header[box], dict):  # in a list it is the rule's name
                    put(rest, again, to, v)
            put(rules, used, text(name if name is not None else f"#{n}"), {**{c: cols.get(c) for c in BASE_RULE_FIELDS}, "extra": text(rest) if rest else None, "lists": text(more) if more else None})
        yield f, r, top.get("instruction_type"), top.get("grammar_name"), top.get("description"), list(rules.items()), list(extra.items()), [(k, text(v)) for k, v in lists.items()]

    return _walk(headers, emit, schema, ddl, block)
