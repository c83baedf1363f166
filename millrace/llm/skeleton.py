"""Visually identical text with different characters.

``skeleton`` is the confusables skeleton of Unicode Technical Standard 39: decompose, replace every
character by its prototype, decompose again; texts with equal skeletons look alike.  ``clean`` is the
one consistent form: composed, ordinary widths and spaces, nothing invisible, each word in one script.  A text
is a case if it is not its consistent form though the two have one skeleton.

The prototypes are those of the whole published table (:mod:`confusables`), after rules for what it leaves
to normalisation (width, ligature and font variants, white space, format characters) and the listed letters
of Cyrillic and Greek, which the table keeps apart where typefaces do, though not where they are put in for
Latin ones.
"""

from __future__ import annotations

import re
import sys
import unicodedata as ud

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import confusables

# Letters of Cyrillic and Greek that look like Latin ones, upper and lower case.
CYRILLIC_LIKE = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Ғ": "F", "Ѵ": "V", "Ё": "Ë", "Ї": "Ï", "Ԑ": "Ɛ",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "һ": "h", "ԁ": "d",
    "ԛ": "q", "ԝ": "w", "ӏ": "l", "Ӏ": "I", "ѵ": "v", "ү": "y", "ё": "ë", "ї": "ï", "ԑ": "ɛ", "ӧ": "ö", "Ӧ": "Ö", "ӓ": "ä", "Ӓ": "Ä",
}
GREEK_LIKE = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "α": "a", "ι": "i", "κ": "k", "ρ": "p", "υ": "u", "χ": "x", "γ": "y", "ε": "ɛ",
    "ό": "ó", "ά": "á", "έ": "ɛ\u0301", "ϳ": "j", "ϲ": "c", "Ϲ": "C", "Ϳ": "J", "τ": "t", "η": "n", "ω": "w", "σ": "o", "β": "ß",
}
#: Look-alikes that are close enough to replace a letter inside a word of another script, but that are letters of words as well.
_LATIN_OF = CYRILLIC_LIKE | GREEK_LIKE
_CYRILLIC_OF = {v: k for k, v in reversed(list(CYRILLIC_LIKE.items())) if len(v) == 1}


def _is_ligature(c: str) -> bool:
    kind, *parts = ud.decomposition(c).split()
    return kind == "<compat>" and len(parts) > 1 and all(ud.category(chr(int(p, 16)))[0] == "L" for p in parts)


def _table() -> tuple[dict[int, str], set[str], set[str], set[str], set[str]]:
    prototypes: dict[int, str] = {}
    wide, ligatures, invisible, spaces = set(), set(), set(), set()
    for cp in range(0x80, sys.maxunicode + 1):
        if 0x3400 <= cp < 0xF900 or 0x20000 <= cp < 0xE0000:
            continue  # ideographs, syllables and private use: no prototypes
        c = chr(cp)
        cat, dec = ud.category(c), ud.decomposition(c)
        if cat in ("Zs", "Zl", "Zp") or cp == 0x85:
            spaces.add(c)
            prototypes[cp] = " "
        elif cat == "Cf" or cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF:
            invisible.add(c)
            prototypes[cp] = ""
        elif dec.startswith("<wide>") or dec.startswith("<narrow>"):
            wide.add(c)
            prototypes[cp] = ud.normalize("NFKD", c)
        elif cat[0] == "L" and dec and _is_ligature(c):
            ligatures.add(c)
            prototypes[cp] = ud.normalize("NFKD", c)
        elif dec.startswith("<font>"):
            prototypes[cp] = ud.normalize("NFKD", c)
    for k, v in _LATIN_OF.items():
        prototypes[ord(k)] = ud.normalize("NFD", v)
    return prototypes, wide, ligatures, invisible, spaces


_RULES, WIDE, LIGATURES, INVISIBLE, SPACES = _table()
_PLAIN = {ord(c): _RULES[ord(c)] for c in WIDE | LIGATURES | INVISIBLE | SPACES}
_PUBLISHED = confusables.table()


def _prototypes() -> dict[int, str]:
    """The published prototypes; what a rule replaces gets those of its replacement."""
    final = lambda t: "".join(_PUBLISHED.get(x, x) for x in ud.normalize("NFD", t))
    return {ord(c): final(p) for c, p in _PUBLISHED.items()} | {cp: final(p) for cp, p in _RULES.items()}


PROTOTYPES = _prototypes()


def _others() -> dict[str, str]:
    """Letters of all other scripts that have a Latin prototype, and the Latin letter they stand for."""
    stands: dict[tuple[str, bool], str] = {}
    for c in map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250), *range(0x250, 0x2B0)]):
        if c.isalpha():
            p = "".join(PROTOTYPES.get(ord(x), x) for x in ud.normalize("NFD", c))
            stands.setdefault((p, c.isupper()), c)
    out = {}
    for c, p in _PUBLISHED.items():
        if ud.category(c)[0] == "L" and _script(c) == "?" and ord(c) not in _RULES:
            p = PROTOTYPES[ord(c)]
            # Scripts without case look like capitals where the prototype is one.
            latin = stands.get((p, c.isupper())) or stands.get((p, not c.isupper()))
            if latin:
                out[c] = latin
    return out


def _class(chars) -> str:
    """A regular-expression class body of runs of code points."""
    out, cps = [], sorted(map(ord, chars))
    i = 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        out.append(f"\\U{cps[i]:08x}" + (f"-\\U{cps[j]:08x}" if j > i else ""))
        i = j + 1
    return "".join(out)


def _script(c: str) -> str:
    o = ord(c)
    if o < 0x250 or 0x250 <= o < 0x2B0 or 0x1E00 <= o < 0x1F00 or 0x2C60 <= o < 0x2C80 or 0xA720 <= o < 0xA800:
        return "L" if c.isalpha() else ""
    if 0x400 <= o < 0x530:
        return "C"
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "G"
    return "" if 0x300 <= o < 0x370 else "?" if c.isalpha() else ""


OTHER_LIKE = _others()
_LATIN_OF |= OTHER_LIKE
#: Characters that have a plain form whatever stands around them.
_CODED = re.compile(f"[{_class(WIDE | LIGATURES | INVISIBLE | SPACES)}]")
#: Letters of scripts that share shapes with Latin; all characters that may have another form.  Looking characters up in a set is much faster
#: than such a class.
_ALIENS = frozenset(OTHER_LIKE) | {chr(o) for a, z in ((0x370, 0x400), (0x400, 0x530), (0x1F00, 0x2000)) for o in range(a, z)}
_SUSPECTS = frozenset(WIDE | LIGATURES | INVISIBLE | SPACES) | _ALIENS
_WORD = re.compile(r"[^\W\d_]+(?:[\u0300-\u036f]*[^\W\d_]*)*")


def skeleton(text: str) -> str:
    """Equal for texts that look alike.  Empty for empty text."""
    return ud.normalize("NFD", (text if text.isascii() else ud.normalize("NFD", text)).translate(PROTOTYPES))


def _words(text: str) -> list[list]:
    """``[start, end, scripts, own]`` of each word; ``own``: scripts with a letter that no other script has.

    Scripts are Latin, Cyrillic, Greek and any other that has letters which look like Latin ones.
    """
    out = []
    for m in _WORD.finditer(text):
        scripts, own = set(), set()
        known = "LCG?" if any(c in OTHER_LIKE for c in m.group()) else "LCG"
        for c in m.group():
            s = _script(c)
            if s and s in known:
                scripts.add(s)
                if not (c in _LATIN_OF if s != "L" else c in _CYRILLIC_OF):
                    own.add(s)
        if scripts:
            out.append([m.start(), m.end(), scripts, own])
    return out


def _mixed(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, script)`` of the words that hold letters of another script for look-alikes of ``script``.

    A word with letters of several scripts is one.  So is a word all of whose letters could be of the
    text's own script, unless a word beside it is surely of the word's script: then it is properly so.
    """
    words = _words(text)
    sure = {s: sum(1 for w in words if w[3] == {s}) for s in "LCG"}
    main = max("LCG", key=lambda s: (sure[s], s == "L"))
    out = []
    i = 0
    while i < len(words):
        scripts, own = words[i][2], words[i][3]
        if len(scripts) > 1:
            real = own if len(own) == 1 else {main} & scripts or {"L"} & scripts or scripts
            out.append((words[i][0], words[i][1], min(real)))
            i += 1
            continue
        (s,) = scripts
        j = i
        while j < len(words) and words[j][2] == scripts:
            j += 1
        long = s != "?" or all(words[k][1] - words[k][0] > 1 for k in range(i, j))  # single letters of another script are cited
        if s != main and sure[main] and long and not any(words[k][3] for k in range(i, j)) and (s != "L" or main == "C") and (s == "L" or main == "L"):
            out += [(w[0], w[1], main) for w in words[i:j]]
        i = j
    return out


def plain(text: str) -> str:
    """Composed, with ordinary widths, letters for ligatures, ASCII spaces and nothing invisible."""
    return ud.normalize("NFC", text.translate(_PLAIN)) if _CODED.search(text) else text if ud.is_normalized("NFC", text) else ud.normalize("NFC", text)


def clean(text: str) -> str:
    """The consistent form of ``text``; idempotent, and the identity for texts that are no case."""
    if text.isascii():
        return text
    if _SUSPECTS.isdisjoint(text):
        return text if ud.is_normalized("NFC", text) else ud.normalize("NFC", text)
    t = plain(text)
    if not _ALIENS.isdisjoint(t):
        found = _mixed(t)
        if found:
            out, at = [], 0
            for start, end, script in found:
                table = _LATIN_OF if script == "L" else _CYRILLIC_OF if script == "C" else {}
                out += [t[at:start], "".join(c if _script(c) == script else table.get(c, c) for c in t[start:end])]
                at = end
            t = ud.normalize("NFC", "".join(out) + t[at:])
    return t


def is_case(text: str | None) -> bool:
    """The text holds a character that only looks like the usual one: it is not its consistent form, and has the same skeleton.

    Whether letters of another script stand in for the text's own is decided by the words around them.
    NULL and empty: no.
    """
    if not text or text.isascii():
        return False
    if _SUSPECTS.isdisjoint(text) and ud.is_normalized("NFC", text):
        return False  # no character that has another form
    consistent = clean(text)
    return consistent != text and skeleton(consistent) == skeleton(text)


def _over_fields(df: DataFrame, key: str, fields: list[str], per_text, schema: pa.Schema, ddl: str) -> DataFrame:
    def run(batches):
        for b in batches:
            keys = b.column(0)
            out: list[tuple] = []
            for n, f in enumerate(fields):
                for k, t in zip(keys, b.column(n + 1).to_pylist()):
                    if t is not None:
                        row = per_text(t)
                        if row is not None:
                            out.append((k.as_py(), f, *row))
            cols = list(zip(*out)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return df.select(F.col(key).cast("bigint"), *fields).mapInArrow(run, ddl)


def found(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, field_name`` of the texts that are a case.  Narrow: one pass, no shuffle."""
    schema = pa.schema([(key, pa.int64()), ("field_name", pa.string())])
    return _over_fields(df, key, fields, lambda t: () if is_case(t) else None, schema, f"{key} bigint, field_name string")


def cleaned(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, field_name, text`` of the cases in their consistent form."""
    schema = pa.schema([(key, pa.int64()), ("field_name", pa.string()), ("text", pa.string())])
    return _over_fields(df, key, fields, lambda t: (clean(t),) if is_case(t) else None, schema, f"{key} bigint, field_name string, text string")


def groups(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Skeletons that several different texts share: ``skeleton_id, n_texts, n_rows, first_id``.

    Byte-identical texts are collapsed first (map-side), so a text that a third of the rows hold
    reaches the second step once.
    """
    texts = None
    for f in fields:
        part = df.select(F.col(key).alias("k"), F.col(f).alias("t")).where("t IS NOT NULL")
        texts = part if texts is None else texts.unionAll(part)
    distinct = texts.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first_id"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([skeleton(t) for t in b.column(0).to_pylist()], pa.string()), b.column(1), b.column(2)], ["s", "n", "first_id"])

    shaped = distinct.mapInArrow(run, "s string, n bigint, first_id bigint")
    return shaped.groupBy("s").agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_rows"), F.min("first_id").alias("first_id")).where("n_texts > 1").select(F.md5("s").alias("skeleton_id"), "n_texts", "n_rows", "first_id")
