"""JSON of any depth.

The standard reader and writer are recursive and give up on deep nesting.  They are tried first, as
they are fast; what they give up on is read and written with explicit stacks, with the same result.
"""

from __future__ import annotations

import json
import re
from json import JSONDecodeError
from json.decoder import scanstring

_SPACE = re.compile(r"[ \t\n\r]*")
_decoder = json.JSONDecoder()


def _skip(text: str, at: int) -> int:
    return _SPACE.match(text, at).end()


def _key(text: str, at: int) -> tuple[str, int]:
    """A key and where its value begins."""
    if text[at : at + 1] != '"':
        raise JSONDecodeError("Expecting property name enclosed in double quotes", text, at)
    key, at = scanstring(text, at + 1, True)
    at = _skip(text, at)
    if text[at : at + 1] != ":":
        raise JSONDecodeError("Expecting ':' delimiter", text, at)
    return key, _skip(text, at + 1)


def _read(text: str, at: int) -> tuple[object, int]:
    boxes: list = []
    keys: list[str] = []
    while True:
        mark = text[at : at + 1]
        if mark in ("{", "["):
            box: dict | list = {} if mark == "{" else []
            at = _skip(text, at + 1)
            if text[at : at + 1] != ("}" if mark == "{" else "]"):
                boxes.append(box)
                if mark == "{":
                    key, at = _key(text, at)
                    keys.append(key)
                continue
            value, at = box, at + 1
        else:
            value, at = _decoder.raw_decode(text, at)
        while True:
            if not boxes:
                return value, at
            box = boxes[-1]
            named = isinstance(box, dict)
            if named:
                box[keys.pop()] = value
            else:
                box.append(value)
            at = _skip(text, at)
            mark = text[at : at + 1]
            if mark == ",":
                at = _skip(text, at + 1)
                if named:
                    key, at = _key(text, at)
                    keys.append(key)
                break
            if mark != ("}" if named else "]"):
                raise JSONDecodeError("Expecting ',' delimiter", text, at)
            value, at = boxes.pop(), at + 1


def raw_decode(text: str, at: int = 0) -> tuple[object, int]:
    """The value that begins at ``at`` and where it ends; ValueError where there is none."""
    try:
        return _decoder.raw_decode(text, at)
    except RecursionError:
        return _read(text, at)


def loads(text: str) -> object:
    """The value that the whole text is; ValueError where it is none."""
    try:
        return json.loads(text)
    except RecursionError:
        value, at = _read(text, _skip(text, 0))
        at = _skip(text, at)
        if at != len(text):
            raise JSONDecodeError("Extra data", text, at) from None
        return value


def _write(value: object, ascii_only: bool, separators: tuple[str, str], sort_keys: bool, indent: int | None) -> str:
    comma, colon = separators
    spell = lambda v: json.dumps(v, ensure_ascii=ascii_only)
    out: list[str] = []
    work: list[tuple[object, int]] = [(value, 0)]  # depth -1: text that is written as it is
    while work:
        v, depth = work.pop()
        if depth < 0:
            out.append(v)
        elif isinstance(v, (dict, list)) and v:
            opens, closes = "{}" if isinstance(v, dict) else "[]"
            line = "" if indent is None else "\n" + " " * (indent * (depth + 1))
            parts: list[tuple[object, int]] = [(opens, -1)]
            for n, x in enumerate((sorted(v) if sort_keys else v) if isinstance(v, dict) else v):
                lead = (comma if n else "") + line
                parts += [(lead + spell(x) + colon, -1), (v[x], depth + 1)] if isinstance(v, dict) else [(lead, -1), (x, depth + 1)]
            parts.append((("" if indent is None else "\n" + " " * (indent * depth)) + closes, -1))
            work.extend(reversed(parts))
        else:
            out.append(spell(v))
    return "".join(out)


def dumps(value: object, ascii_only: bool = False, separators: tuple[str, str] | None = None, sort_keys: bool = False, indent: int | None = None) -> str:
    """JSON text; by default not escaped, with spaces after commas and colons."""
    try:
        return json.dumps(value, ensure_ascii=ascii_only, separators=separators, sort_keys=sort_keys, indent=indent)
    except RecursionError:
        return _write(value, ascii_only, separators or (", " if indent is None else ",", ": "), sort_keys, indent)
