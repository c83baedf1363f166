"""Deeply nested JSON as flat tables, by columnar shredding with repetition and definition levels.

Each record is shredded into columns, one for each leaf path.  A path is a chain of steps:
``o`` (the value is an object), ``k:<name>`` (it has that key), ``m`` (the value is an object whose keys
are names of things, not of fields), ``e`` (an entry of it; ``key`` is the leaf that holds its name),
``l`` (the value is a list), ``i`` (an item of it) and ``s`` (the value is a scalar other than null).
An entry of a column has

* the repetition level: which ``i`` or ``e`` step, counted from the root, it repeats (0: none, a new record);
* the definition level: how many steps of the chain hold; null, missing and values of another
  type differ in where the chain stops, so values of mixed types need no common type;
* the value, if the whole chain holds.

Which objects have names of things for keys is found over the whole corpus (:func:`open_contexts`), so
that leaf paths are columns of the corpus and their number does not grow with the names.

Tables are rebuilt from these sequences alone: one for each repeated ancestor, whose rows carry their
own and their parent's key.  List positions follow from the repetition levels, which objects exist
from the definition levels.  Shredding is narrow (record by record, no shuffle), whatever the records
share, and of any depth: nothing here is recursive.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.deepjson import dumps, loads

Entry = tuple[int, int, object]
Chain = tuple[str, ...]
Columns = dict[Chain, list[Entry]]

#: An object's keys are names of things if there are more than so many different ones, or at least MIXED_KEYS of which an
#: object has, on average, less than the share MIXED_SHARE.
MANY_KEYS, MIXED_KEYS, MIXED_SHARE = 256, 8, 0.25


def _unwrap(v: object) -> object:
    if isinstance(v, str) and v.strip(" \t\r\n")[:1] in ("{", "["):
        try:
            return loads(v)
        except ValueError:
            pass
    return v


def parse(text: str | None) -> object:
    """The JSON value of ``text``, None for what is no JSON.  Strings that hold a whole object or list
    count as that object or list, at any depth, the root included.  Of equal keys the last one wins."""
    if text is None:
        return None
    try:
        root = [loads(text)]
    except ValueError:
        return None
    work: list = [root]
    while work:
        box = work.pop()
        for k, v in box.items() if isinstance(box, dict) else enumerate(box):
            new = _unwrap(v)
            if new is not v:
                box[k] = new
            if isinstance(new, (dict, list)):
                work.append(new)
    return root[0]


class _Place:
    """What values occur at one place of a record, and the columns below it: those of its objects, lists and scalars
    are the ranges ``[lo, mid1)``, ``[mid1, mid2)`` and ``[mid2, hi)``."""

    __slots__ = ("context", "fields", "entry", "item", "scalar", "lo", "mid1", "mid2", "hi")

    def __init__(self, context: str):
        self.context = context
        self.fields: dict[str, _Place] | None = None
        self.entry: _Place | None = None  # of an object whose keys are names
        self.item: _Place | None | bool = False  # False: never a list; None: only empty lists
        self.scalar = False


def _place(root: object, open_: frozenset[str]) -> _Place:
    top = _Place("")
    work = [(top, root)]
    while work:
        p, v = work.pop()
        if isinstance(v, dict):
            p.fields = {} if p.fields is None else p.fields
            if p.context in open_:
                if v and p.entry is None:
                    p.entry = _Place(p.context + "/*")
                work += [(p.entry, x) for x in v.values()]
                continue
            for k, x in v.items():
                child = p.fields.get(k)
                if child is None:
                    child = p.fields[k] = _Place(k)
                work.append((child, x))
        elif isinstance(v, list):
            if v and not p.item:
                p.item = _Place(p.context + "/[]")
            p.item = p.item or None
            work += [(p.item, x) for x in v]
        elif v is not None:
            p.scalar = True
    return top


def _layout(top: _Place, open_: frozenset[str]) -> list[Chain]:
    """Number the columns: of each place first its objects', then its lists', then its own."""
    chains: list[Chain] = []
    work: list[tuple[str, _Place, Chain]] = [("objects", top, ())]
    while work:
        what, p, chain = work.pop()
        if what == "objects":
            p.lo = len(chains)
            work.append(("lists", p, chain))
            if p.entry is not None:
                chains.append((*chain, "m", "e", "key"))
                work.append(("objects", p.entry, (*chain, "m", "e")))
            elif p.fields:
                work += [("objects", x, (*chain, "o", f"k:{k}")) for k, x in reversed(p.fields.items())]
            elif p.fields is not None:
                chains.append((*chain, "m" if p.context in open_ else "o"))
        elif what == "lists":
            p.mid1 = len(chains)
            work.append(("own", p, chain))
            if p.item:
                work.append(("objects", p.item, (*chain, "l", "i")))
            elif p.item is None:
                chains.append((*chain, "l"))
        else:
            p.mid2 = len(chains)
            if p.scalar:
                chains.append((*chain, "s"))
            elif p.mid2 == p.lo:
                chains.append(chain)
            p.hi = len(chains)
    return chains


def shred(root: object, open_: frozenset[str] = frozenset()) -> Columns:
    """The columns of one record: ``{leaf path: [(repetition, definition, value), ...]}``."""
    top = _place(root, open_)
    chains = _layout(top, open_)
    out: list[list[Entry]] = [[] for _ in chains]

    def stop(lo: int, hi: int, rep: int, level: int) -> None:
        for c in range(lo, hi):
            out[c].append((rep, level, None))

    work = [(top, root, 0, 0, 0)]
    while work:
        p, v, rep, level, depth = work.pop()
        below: list[tuple] = []
        if isinstance(v, dict):
            if p.context in open_:
                if not v:
                    stop(p.lo, p.mid1, rep, level + 1)
                for n, (k, x) in enumerate(v.items()):
                    again = depth + 1 if n else rep
                    out[p.lo].append((again, level + 3, k))
                    below.append((p.entry, x, again, level + 2, depth + 1))
            elif not p.fields:
                stop(p.lo, p.mid1, rep, level + 1)
            else:
                for k, x in p.fields.items():
                    if k in v:
                        below.append((x, v[k], rep, level + 2, depth))
                    else:
                        stop(x.lo, x.hi, rep, level + 1)
        else:
            stop(p.lo, p.mid1, rep, level)
        if isinstance(v, list):
            if not v:
                stop(p.mid1, p.mid2, rep, level + 1)
            below += [(p.item, x, depth + 1 if n else rep, level + 2, depth + 1) for n, x in enumerate(v)]
        else:
            stop(p.mid1, p.mid2, rep, level)
        if p.scalar and v is not None and not isinstance(v, (dict, list)):
            out[p.mid2].append((rep, level + 1, v))
        else:
            stop(p.mid2, p.hi, rep, level)
        work.extend(reversed(below))
    return dict(zip(chains, out))


def _escape(key: str) -> str:
    return key.replace("~", "~0").replace("/", "~1")


def _table_step(key: str) -> str:
    """A key in the name of a table, apart from ``[]`` and ``*``."""
    return "~" + key if key in ("[]", "*") else _escape(key)


def positions(chain: Chain, entries: list[Entry]) -> Iterator[tuple[int, int, object, list[int]]]:
    """``(repetition, definition, value, positions)`` of each entry, the positions from the levels alone."""
    depth = chain.count("i") + chain.count("e")
    at = [0] * depth
    for rep, level, value in entries:
        if rep:
            at[rep - 1] += 1
        for i in range(rep, depth):
            at[i] = 0
        yield rep, level, value, at


class _Names:
    """The names of entries, from the columns that hold them."""

    def __init__(self, columns: Columns):
        self.of: dict[Chain, dict[tuple[int, ...], str]] = {}
        for chain, entries in columns.items():
            if chain[-1:] == ("key",):
                self.of[chain[:-1]] = {tuple(at): value for _, level, value, at in positions(chain, entries) if level == len(chain)}

    def path_step(self, chain: Chain, n: int, at: list[int], item: int) -> str:
        """What the ``i`` or ``e`` step at ``n`` is called."""
        return str(at[item]) if chain[n] == "i" else self.of[chain[: n + 1]][tuple(at[: item + 1])]


def _resumed(columns: Columns, root: object) -> Iterator[tuple[Chain, int, object, list[int], int, int, object, list[dict]]]:
    """``(chain, definition, value, positions, step, items, state, stores)`` of each entry of each column of values.

    A walk down a chain need not begin at the root: what was found at the deepest ``i`` or ``e`` step that an
    earlier walk has passed at the same positions is ``state``, the walk goes on at ``step``, after ``items`` such steps.
    Where it passes further ones it puts its states into ``stores``, under the positions so far.
    """
    seen: dict[Chain, dict[tuple[int, ...], object]] = {}
    for chain, entries in columns.items():
        if chain[-1:] == ("key",):
            continue  # what its entries are shows in the columns of their values
        repeated, passed = [], [0]
        for n, step in enumerate(chain):
            if step == "i" or step == "e":
                repeated.append(n)
            passed.append(len(repeated))
        stores = [seen.setdefault(chain[: n + 1], {}) for n in repeated]
        for _, level, value, at in positions(chain, entries):
            items, begin, state = passed[level], 0, root
            while items:
                found = stores[items - 1].get(tuple(at[:items]))
                if found is not None:
                    state, begin = found, repeated[items - 1] + 1
                    break
                items -= 1
            yield chain, level, value, at, begin, items, state, stores


def assemble(columns: Columns) -> tuple[dict[str, tuple[str, str, object]], list[tuple[str, str, object]]]:
    """Nodes and fields from level sequences.

    Nodes: ``{node_path: (parent_path, table, value)}`` for each object below the root and each
    scalar item of a list; ``table`` is the path with list positions as ``[]`` and names of entries as
    ``*``, the value is None for objects.  Fields: ``(node_path, name, value)`` of the scalars held by keys.
    """
    names = _Names(columns)
    nodes: dict[str, tuple[str, str, object]] = {}
    fields: list[tuple[str, str, object]] = []
    for chain, level, value, at, begin, item, state, stores in _resumed(columns, ("", "", "", "")):
        path, table, parent, name = state
        for n in range(begin, level):
            step = chain[n]
            if step == "i" or step == "e":
                name = names.path_step(chain, n, at, item)
                path, table, item = f"{path}/{_escape(name)}", f"{table}/{'[]' if step == 'i' else '*'}", item + 1
                stores[item - 1][tuple(at[:item])] = path, table, parent, name
            elif step == "o" or step == "m":
                if n:
                    if path not in nodes:
                        nodes[path] = (parent, table, None)
                    parent = path
            elif step == "s":
                if n and chain[n - 1] == "i":
                    nodes[path] = (parent, table, value)
                elif n:
                    fields.append((parent, name, value))
            elif step != "l":
                name = step[2:]
                path, table = f"{path}/{_escape(name)}", f"{table}/{_table_step(name)}"
    return nodes, fields


def rebuild(columns: Columns) -> object:
    """The record itself from its columns; with :func:`shred` an exact round trip up to the order of keys."""
    names = _Names(columns)
    missing = object()
    root: list = [missing]
    for chain, entries in columns.items():
        if chain[-1:] == ("key",):
            continue
        for _, level, value, at in positions(chain, entries):
            box, key, item = root, 0, 0
            for n, step in enumerate(chain[:level]):
                if step == "o" or step == "m":
                    if not isinstance(box[key], dict):
                        box[key] = {}
                elif step == "l":
                    if not isinstance(box[key], list):
                        box[key] = []
                elif step == "i":
                    box, key, item = box[key], at[item], item + 1
                    while len(box) <= key:
                        box.append(None)
                elif step == "e":
                    box, key, item = box[key], names.path_step(chain, n, at, item), item + 1
                    box.setdefault(key, None)
                elif step == "s":
                    box[key] = value
                else:
                    box, key = box[key], step[2:]
                    box.setdefault(key, None)
    return None if root[0] is missing else root[0]


# ---- related tables -------------------------------------------------------------------------------------------------


def type_of(v: object) -> str:
    """The column type of a scalar: ``boolean``, ``bigint``, ``double``, ``string``, or ``number`` for integers beyond 64 bits."""
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "bigint" if -(1 << 63) <= v < 1 << 63 else "number"
    return "double" if isinstance(v, float) else "string"


class Row:
    """A row of a table: where it stands in its record, its scalars and what else is known of its places."""

    __slots__ = ("table", "row_id", "parent_id", "name", "scalars", "kinds")

    def __init__(self, table: str, row_id: str, parent_id: str | None, name: str | None):
        self.table, self.row_id, self.parent_id, self.name = table, row_id, parent_id, name
        self.scalars: dict[str, object] = {}
        self.kinds: dict[str, str | None] = {}  # place -> object, list, filled (has parts), scalar; None: present

    def empties(self) -> list[str]:
        """Places that hold null, an empty object or an empty list, as ``place null`` and so on; the row itself is ``''``."""
        said = {"object": "{}", "list": "[]", None: "null"}
        return [f"{place} {said[k]}" for place, k in self.kinds.items() if k in said]


def rows_of(columns: Columns) -> list[Row]:
    """The rows of all tables of a record from its level sequences.

    There is a table for the records (``''``) and one for each repeated ancestor: its path with list
    positions as ``[]`` and names of entries as ``*``.  A row holds what lies between its ancestor and
    the next one: objects in between are flattened, their scalars are columns called by the JSON Pointer from
    the row's own place (``''`` for a row that is a scalar itself).  ``row_id`` is the row's JSON Pointer in
    the record, ``parent_id`` that of the row of the parent table it belongs to, ``name`` its position or name there.
    """
    names = _Names(columns)
    top = Row("", "", None, None)
    top.kinds[""] = None
    rows = [top]
    for chain, level, value, at, begin, item, state, stores in _resumed(columns, (top, "", "")):
        row, path, table = state
        place = ""
        for n in range(begin, level):
            step = chain[n]
            if step == "i" or step == "e":
                row.kinds[place] = "filled"
                name = names.path_step(chain, n, at, item)
                path, table, item = f"{path}/{_escape(name)}", f"{table}/{'[]' if step == 'i' else '*'}", item + 1
                row, place = Row(table, path, row.row_id, name), ""
                row.kinds[""] = None
                rows.append(row)
                stores[item - 1][tuple(at[:item])] = row, path, table
            elif step == "o" or step == "m" or step == "l":
                if row.kinds[place] is None:
                    row.kinds[place] = "list" if step == "l" else "object"
            elif step == "s":
                row.kinds[place] = "scalar"
                row.scalars[place] = value
            else:
                row.kinds[place] = "filled"
                key = _escape(step[2:])
                place, path, table = f"{place}/{key}", f"{path}/{key}", f"{table}/{_table_step(step[2:])}"
                row.kinds.setdefault(place, None)
    return rows


def _unescape(key: str) -> str:
    return key.replace("~1", "/").replace("~0", "~")


def record_of(rows: Iterable[tuple[str, str, dict[str, object], list[str]]]) -> object:
    """The record from its rows ``(table, row_id, scalars, empties)``, whatever their order: the inverse of :func:`rows_of`.

    Whether a step is a list position or a key is told by the table's name.
    """
    root: list = [None]
    leaves: list[tuple[list[str], list[str], object]] = []
    for table, row_id, scalars, empties in rows:
        kinds, path = table.split("/")[1:], row_id.split("/")[1:]
        for place, value in scalars.items():
            more = place.split("/")[1:]
            leaves.append((kinds + [""] * len(more), path + more, value))
        for said in empties:
            place, what = said.rsplit(" ", 1)
            more = place.split("/")[1:]
            leaves.append((kinds + [""] * len(more), path + more, {} if what == "{}" else [] if what == "[]" else None))
    for kinds, path, value in leaves:
        box, key = root, 0
        for kind, step in zip(kinds, path):
            if kind == "[]":
                if not isinstance(box[key], list):
                    box[key] = []
                box, key = box[key], int(step)
                while len(box) <= key:
                    box.append(None)
            else:
                if not isinstance(box[key], dict):
                    box[key] = {}
                box, key = box[key], _unescape(step)
                box.setdefault(key, None)
        box[key] = value
    return root[0]


# ---- distribution ---------------------------------------------------------------------------------------------------


def _spell(v: object) -> str | None:
    text = None if v is None else v if isinstance(v, str) else dumps(v)
    return text if text is None or text.isascii() else text.encode("utf-8", "replace").decode("utf-8")


def _records(batches, build, schema: pa.Schema, open_: frozenset[str] = frozenset()):
    for b in batches:
        rows: list[tuple] = []
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            root = parse(text)
            if root is not None:
                for r in build(shred(root, open_)):
                    rows.append((key, *r))
                    if len(rows) >= 50_000:  # keep batches small whatever a record holds
                        yield _batch(rows, schema)
                        rows = []
        yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)


def _pass(df: DataFrame, key: str, text: str, build, fields: list[tuple[str, pa.DataType, str]], open_: frozenset[str] = frozenset()) -> DataFrame:
    schema = pa.schema([(key, pa.int64()), *((n, t) for n, t, _ in fields)])
    ddl = ", ".join([f"`{key}` bigint", *(f"`{n}` {d}" for n, _, d in fields)])
    return df.select(F.col(key).cast("bigint"), text).mapInArrow(lambda it: _records(it, build, schema, open_), ddl)


def open_contexts(df: DataFrame, text: str) -> frozenset[str]:
    """The contexts of objects whose keys are names of things (see :data:`MANY_KEYS`), over all records.

    The context of an object is the last key above it that names a field (``''``: none), with ``/[]`` and
    ``/*`` for the lists and named entries in between; so what recurs at many depths is one context.
    Keys are counted in the tasks, at most :data:`MANY_KEYS` a context, then over all; the driver gets the
    names of the contexts that are open.  The values of an open context are one context only once it is
    known, so the pass is repeated until it finds no more.
    """
    found: frozenset[str] = frozenset()
    while True:
        known = found

        def count(batches, known=known):
            keys: dict[str, dict[str, int] | None] = {}
            objects: dict[str, int] = defaultdict(int)
            for b in batches:
                for t in b.column(0).to_pylist():
                    work = [("", parse(t))]
                    while work:
                        context, v = work.pop()
                        if isinstance(v, list):
                            work += [(context + "/[]", x) for x in v if isinstance(x, (dict, list))]
                        elif isinstance(v, dict):
                            is_open = context in known
                            if not is_open:
                                objects[context] += 1
                                seen = keys.setdefault(context, {})
                                if seen is not None:
                                    for k in v:
                                        seen[k] = seen.get(k, 0) + 1
                                    if len(seen) > MANY_KEYS:
                                        keys[context] = None
                            work += [(context + "/*" if is_open else k, x) for k, x in v.items() if isinstance(x, (dict, list))]
            out = [(c, None, n, keys[c] is None) for c, n in objects.items()] + [(c, k, n, False) for c, seen in keys.items() if seen for k, n in seen.items()]
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array([_spell(x) for x in cols[0]], pa.string()), pa.array([_spell(x) for x in cols[1]], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.bool_())], ["context", "key", "n", "many"])

        counted = df.select(text).mapInArrow(count, "context string, key string, n bigint, many boolean")
        sums = counted.groupBy("context", "key").agg(F.sum("n").alias("n"), F.max("many").alias("many"))
        has = F.col("key").isNotNull()
        by = sums.groupBy("context").agg(F.count("key").alias("keys"), F.sum(F.when(has, F.col("n"))).alias("held"), F.sum(F.when(~has, F.col("n"))).alias("objects"), F.max("many").alias("many"))
        names = F.col("many") | (F.col("keys") > MANY_KEYS) | ((F.col("keys") >= MIXED_KEYS) & (F.col("held") < MIXED_SHARE * F.col("keys") * F.col("objects")))
        new = found | {r.context for r in by.where(names).select("context").collect()}
        if new == found:
            return found
        found = new


def nodes(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, node_path, parent_path, table_path, item_value``: one row for each object below the root and each
    scalar item of a list.

    Paths are JSON Pointers from the root, ``parent_path`` is that of the nearest enclosing object that
    is a node, else ``''``.  NULL, empty, invalid and scalar records give no rows; equal records of
    equal keys give their rows as often as they occur.
    """

    def build(columns):
        for path, (parent, table, value) in assemble(columns)[0].items():
            yield _spell(path), _spell(parent), _spell(table), _spell(value)

    return _pass(df, key, text, build, [(n, pa.string(), "string") for n in ("node_path", "parent_path", "table_path", "item_value")])


def fields(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, node_path, name, value``: the scalar fields of each object, the root's with node_path ``''``."""

    def build(columns):
        for path, name, value in assemble(columns)[1]:
            yield _spell(path), _spell(name), _spell(value)

    return _pass(df, key, text, build, [(n, pa.string(), "string") for n in ("node_path", "name", "value")])


def leaf_path(chain: Chain) -> str:
    """A chain as text: its steps with spaces between them, names as JSON strings without quotes."""
    return _spell(" ".join(dumps(x)[1:-1] if x.startswith("k:") else x for x in chain))


def levels(df: DataFrame, key: str, text: str, open_: frozenset[str] | None = None) -> DataFrame:
    """``key, leaf_path, entry_no, repetition, definition, value``: the shredded columns.

    A record has entries in the columns of the paths that it has; that it lacks the others is said once for
    all records by :func:`columns_of`.
    """
    open_ = open_contexts(df, text) if open_ is None else open_

    def build(columns):
        for chain, entries in columns.items():
            name = leaf_path(chain)
            for n, (rep, level, value) in enumerate(entries):
                yield name, n, rep, level, _spell(value)

    return _pass(df, key, text, build, [("leaf_path", pa.string(), "string"), *((n, pa.int32(), "int") for n in ("entry_no", "repetition", "definition")), ("value", pa.string(), "string")], open_)


def columns_of(levels_: DataFrame, key: str) -> DataFrame:
    """``leaf_path, n_records, n_lacking, n_entries, n_values, max_repetition, max_definition``: every column of the corpus.

    ``levels_`` (read twice: stage it) is what :func:`levels` gives.  ``n_lacking`` of its records have no entry,
    which stands for one with both levels 0 and no value.
    """
    total = levels_.select(F.countDistinct(key).alias("__all"))
    by = levels_.groupBy("leaf_path").agg(
        F.countDistinct(key).alias("n_records"), F.count(F.lit(1)).alias("n_entries"), F.count("value").alias("n_values"), F.max("repetition").alias("max_repetition"), F.max("definition").alias("max_definition")
    )
    every = by.crossJoin(F.broadcast(total))  # one row
    return every.select("leaf_path", "n_records", (F.col("__all") - F.col("n_records")).alias("n_lacking"), "n_entries", "n_values", "max_repetition", "max_definition")


_ROW = [("table_name", pa.string(), "string"), ("row_id", pa.string(), "string"), ("parent_id", pa.string(), "string"), ("name", pa.string(), "string")]


def tables(df: DataFrame, key: str, text: str, open_: frozenset[str] | None = None) -> DataFrame:
    """``key, table_name, row_id, parent_id, name, fields, types, empties``: the rows of all tables (see :func:`rows_of`).

    ``fields`` maps the columns of the row's table to their values as text, ``types`` to their types; with
    ``empties`` a record is its rows, nothing is lost (:func:`record_of`).  :func:`typed_table` gives one of
    the tables with columns of its own.  NULL, empty and invalid records have no rows.
    """
    open_ = open_contexts(df, text) if open_ is None else open_
    pairs = pa.map_(pa.string(), pa.string())

    def build(columns):
        for r in rows_of(columns):
            yield (
                _spell(r.table), _spell(r.row_id), _spell(r.parent_id), _spell(r.name), [(_spell(k), _spell(v)) for k, v in r.scalars.items()],
                [(_spell(k), type_of(v)) for k, v in r.scalars.items()], [_spell(e) for e in r.empties()],
            )

    return _pass(df, key, text, build, [*_ROW, ("fields", pairs, "map<string,string>"), ("types", pairs, "map<string,string>"), ("empties", pa.list_(pa.string()), "array<string>")], open_)


def catalogue(rows: DataFrame) -> DataFrame:
    """``table_name, parent_table, column_name, type, n_values, n_rows``: the columns of all tables of :func:`tables`.

    A column with values of several types has a line for each.  Tables without scalars have one line without a column.
    """
    sizes = rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))
    columns = rows.select("table_name", F.explode("types").alias("column_name", "type")).groupBy("table_name", "column_name", "type").agg(F.count(F.lit(1)).alias("n_values"))
    # The parent's name ends before the last list or named entry in the own one.
    parent = F.when(F.col("table_name") == "", F.lit(None)).otherwise(F.coalesce(F.regexp_extract("table_name", r"^(.*/(?:\[\]|\*))/(?:.*/)?(?:\[\]|\*)$", 1), F.lit("")))
    return sizes.join(columns, "table_name", "left").select("table_name", parent.alias("parent_table"), "column_name", "type", F.coalesce("n_values", F.lit(0)).alias("n_values"), "n_rows")


def typed_table(rows: DataFrame, key: str, name: str) -> DataFrame:
    """One of the tables of :func:`tables` with columns of their own types.

    A column with values of several types becomes one for each, with the type in its name.  The driver
    reads the table's columns, which are names of fields: their number does not grow with the rows.
    """
    mine = rows.where(F.col("table_name") == name)
    found = sorted(tuple(r) for r in mine.select(F.explode("types").alias("c", "t")).distinct().collect())
    several = {c for c, _ in found if sum(1 for x, _ in found if x == c) > 1}
    out = []
    for c, t in found:
        value = F.when(F.col("types")[c] == t, F.col("fields")[c])
        out.append(value.cast({"number": "string"}.get(t, t)).alias((c.removeprefix("/") or "value") + (f" ({t})" if c in several else "")))
    return mine.select(key, "row_id", "parent_id", "name", *out)
