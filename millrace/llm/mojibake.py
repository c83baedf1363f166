"""Garbled text from wrong character encodings.

Restoration is a best-first search over encode, decode and unescape operations.  A state is a piece of
text; an operation re-encodes the characters that one encoding would have produced and decodes the
bytes as another, or resolves escapes.  States are ordered by the implausibility of their characters
plus the price of the operations so far, visited ones are kept in a hash set, and the cheapest reachable
text wins.  The search ends by itself: a state is left alone once another operation would cost more
than the best text found, or once it is much less plausible than that; operations that decode several
bytes shorten the text and must make it more plausible, and two changes of single bytes never follow each
other.  Neither the number of states nor depth nor length are capped.

Operations are one to one where they apply (decoding is strict), so a path can be played back to the
text as it was.
"""

from __future__ import annotations

import heapq
import html
import re
import unicodedata as ud

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread

#: Encodings whose characters UTF-8 bytes may have been read as.
READ_AS = ["cp1252", "cp1250", "cp1251", "cp437", "cp850", "cp852", "cp866", "mac_roman", "koi8_r", "cp1254", "cp1253"]
#: Single-byte confusions of Cyrillic: (read as, really).
SWAPS = [("cp1252", "cp1251"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp1252", "koi8_r"), ("cp1251", "cp866"), ("cp866", "cp1251"), ("cp1252", "cp866"), ("mac_roman", "cp1251"), ("cp437", "cp1251"), ("cp437", "cp866")]
#: Single-byte confusions of Latin letters: (read as, really).  Those that only turn letters into other letters (cp1250)
#: can't be told from names of other languages.
LATIN_SWAPS = [("cp437", "cp1252"), ("cp850", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "mac_roman")]
#: Price of an operation, and of a confusion of Latin letters, which leaves less evidence.
OPERATION, LATIN_OPERATION = 1.0, 2.5
#: States are followed up to this multiple of the best text's total (and two operations): text may have to become less plausible first.
WIDTH = 1.25
#: Text up to this cost (that of a sign that stands alone) is ordinary.
ORDINARY = 1.0

# Everyday letters of the corpus' eight languages beyond ASCII, their accents, the most frequent Russian ones,
# and marks of ordinary typography.
LETTERS = "áàâãäçéèêëíîïñóôõöœúùûüßŋɛ" + "абвгдежзийклмнопрстуфхцчшщъыьэюяё"
ACCENTS = "\u0300\u0301\u0302\u0303\u0308\u030a\u0327"
COMMON = "оеаинтсрвл"
MARKS = "‘’“”„‚«»‹›–—…•¡¿·′″"
#: Letters that are proper somewhere but not in these languages cost more than these.
_USUAL = set(LETTERS) | set(LETTERS.upper())


def _bytes_of(encoding: str) -> dict[str, int]:
    """Character to byte; bytes that an encoding leaves open stand for themselves, as lenient decoders have it."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            c = chr(b)
        out[c] = b
    if encoding == "cp1252":
        for b in range(0x80, 0xA0):
            out.setdefault(chr(b), b)  # ISO 8859-1
    return out


def _set(chars) -> str:
    return "[" + "".join(f"\\U{ord(c):08x}" for c in sorted(chars)) + "]"


class _Reader:
    """UTF-8 sequences as they look when read as one encoding."""

    price = OPERATION

    def __init__(self, encoding: str):
        self.map = _bytes_of(encoding)
        of = lambda lo, hi: _set(c for c, b in self.map.items() if lo <= b <= hi)
        tail = of(0x80, 0xBF)
        self.pattern = re.compile(f"{of(0xC2, 0xDF)}{tail}|{of(0xE0, 0xEF)}{tail}{{2}}|{of(0xF0, 0xF4)}{tail}{{3}}")

    def _one(self, m: re.Match) -> str:
        try:
            return bytes(self.map[c] for c in m.group()).decode("utf-8")
        except UnicodeDecodeError:
            return m.group()

    def apply(self, text: str) -> str:
        return self.pattern.sub(self._one, text)


class _Swap:
    """Text made of one encoding's upper half, decoded as another; None where it does not apply."""

    def __init__(self, read_as: str, really: str):
        self.map, self.read_as, self.really = _bytes_of(read_as), read_as, really
        self.pattern = re.compile(f"{_set(self.map)}+")

    def swapped(self, text: str) -> str | None:
        try:
            return self.pattern.sub(lambda m: bytes(self.map[c] for c in m.group()).decode(self.really), text)
        except UnicodeDecodeError:
            return None


class _CyrillicSwap(_Swap):
    """Words without ASCII letters, all of whose letters become Cyrillic."""

    price = OPERATION

    def apply(self, text: str) -> str | None:
        if not _SWAP_HINT.search(text) or _ASCII_LETTER.search(text):
            return None
        odd = lambda t: sum(c >= "\x80" for c in t)
        if 2 * odd(READERS[f"utf-8 as {self.read_as}"].pattern.sub("", text)) <= odd(text):
            return None  # that half of it is whole UTF-8 sequences is no accident
        new = self.swapped(text)
        letters = [c for c in new or "" if c.isalpha()]
        return new if len(letters) >= 4 and all(map(_CYRILLIC.match, letters)) and re.search(r"\w{3}", new) else None


class _LatinSwap(_Swap):
    """A word in which what is no Latin letter stands between letters, all of whose odd characters become usual letters."""

    price = LATIN_OPERATION

    def apply(self, text: str) -> str | None:
        if not _INSIDE.search(text):
            return None
        new = self.swapped(text)
        letters = [c for c in new or "" if c.isalpha()]
        return new if len(letters) >= 4 and not _INSIDE.search(new) and all(_script(c) == "L" and (c < "\x80" or c in _USUAL) for c in letters) else None


_ESCAPE = re.compile(r"&(?:#\d{2,6}|#x[0-9a-fA-F]{2,5}|[A-Za-z][A-Za-z0-9]{1,30});|\\u[0-9a-fA-F]{4}")


class _Unescape:
    """Character references and ``\\u`` escapes."""

    price = OPERATION

    def apply(self, text: str) -> str:
        return _ESCAPE.sub(lambda m: html.unescape(m.group()) if m.group()[0] == "&" else chr(int(m.group()[2:], 16)), text)


READERS = {f"utf-8 as {e}": _Reader(e) for e in READ_AS}
CYRILLIC = {f"{r} as {e}": _CyrillicSwap(e, r) for e, r in SWAPS}
SWAPPERS = CYRILLIC | {f"{r} as {e}, Latin": _LatinSwap(e, r) for e, r in LATIN_SWAPS}
UNESCAPE = {"escaped": _Unescape()}

_C1 = re.compile("[\x80-\x84\x86-\x9f]")
_LOST = "�"


def _kind(c: str) -> str:
    if c in _USUAL:
        return "u"  # a usual letter
    if c in MARKS:
        return "m"
    if c == _LOST:
        return "x"
    cat = ud.category(c)
    if c in ACCENTS:
        return "u"
    if cat[0] in "LM":
        return "l" if ord(c) < 0x530 or 0x1E00 <= ord(c) < 0x2000 else "c"  # scripts far from the corpus' own
    if cat in ("Cc", "Cn", "Co", "Cs"):
        return "c"
    if cat in ("Zs", "Cf"):
        return "z"
    return "s"


_KINDS: dict[str, str] = {}


def kind(c: str) -> str:
    k = _KINDS.get(c)
    if k is None:
        k = _KINDS[c] = _kind(c)
    return k


def _script(c: str) -> str:
    o = ord(c)
    return "C" if 0x400 <= o < 0x530 else "L" if c.isalpha() and (o < 0x2B0 or 0x1E00 <= o < 0x1F00) else "O" if c.isalpha() else ""


def cost(text: str) -> float:
    """How implausible the characters of ``text`` are, each in its place; 0 for ordinary text.

    Control characters cost most, then escapes that could be resolved, then symbols that touch letters, letters foreign to the corpus'
    languages, capitals after small letters, words in inverted case, scripts that change inside a word.
    """
    total, n = 0.0, len(text)
    if _CYRILLIC.search(text):
        letters = [c for c in text.lower() if _CYRILLIC.match(c)]
        if len(letters) >= 8:  # of two ways to read single bytes the one with the everyday letters
            total += 1.0 - sum(c in COMMON for c in letters) / len(letters)
        total += 2.0 * sum(1 for w in text.split() if len(w) > 2 and w[0].islower() and w[1:].isupper())
    if "&" in text or "\\u" in text:
        total += 2.0 * sum(1 for m in _ESCAPE.finditer(text) if UNESCAPE["escaped"].apply(m.group()) != m.group())
    for i, c in enumerate(text):
        if c < "\x80":
            if c.isupper() and i and text[i - 1] >= "\x80" and text[i - 1].islower():
                total += 1.0
            continue
        k = kind(c)
        before, after = text[i - 1] if i else " ", text[i + 1] if i + 1 < n else " "
        touch = before.isalpha() or after.isalpha()
        if k == "c":
            total += 5.0
        elif k == "x":
            total += 6.0
        elif k == "s":
            total += 3.0 if touch or before >= "\x80" and before not in MARKS or after >= "\x80" and after not in MARKS else 1.0
        elif k == "z":
            total += 1.5 if before >= "\x80" or after >= "\x80" else 0.5
        elif k == "m":
            if before.isalpha() and after.isalpha() and c not in "’–—·":
                total += 1.5
            elif (before in MARKS or after in MARKS) and c in "‹›‚„":
                total += 1.0
        else:
            if k == "l":
                total += 2.0
            elif ud.combining(c) and not (before.isalpha() or ud.combining(before)):
                total += 3.0
            if c.isupper() and before.islower():
                total += 2.0
            if c.islower() and i > 1 and before.isupper() and before >= "\x80" and text[i - 2].islower():
                total += 0.5
            s = _script(c)
            if s and before.isalpha() and _script(before) not in ("", s):
                total += 2.0
    return total


OPERATIONS = READERS | UNESCAPE | SWAPPERS


def search(text: str, operations: dict = OPERATIONS) -> tuple[str, tuple[str, ...], bool]:
    """The cheapest text that the operations reach, how, and whether it is the only one at that cost: best-first, each state once.

    Text stays as it is unless it gains more than the price of the operations.
    """
    start = cost(text)
    best, alone = (start, text, ()), True
    heap, seen = [(start, 0, text, (), 0.0)], {text}
    while heap:
        total, _, state, path, spent = heapq.heappop(heap)
        if total > WIDTH * best[0] + 2 * OPERATION:
            break  # so are all that are left
        plain = total - spent
        for name, op in operations.items():
            price = spent + op.price
            if price > best[0] or name in SWAPPERS and path and path[-1] in SWAPPERS:
                continue
            new = op.apply(state)
            if new is None or new in seen:
                continue
            seen.add(new)
            total = cost(new) + price
            if name not in SWAPPERS and total - price >= plain:
                continue  # sequences that make no better text are accidents
            if total < best[0]:
                best, alone = (total, new, (*path, name)), True
            elif total == best[0]:
                alone = False
            heapq.heappush(heap, (total, len(seen), new, (*path, name), price))
    return best[1], best[2], alone


#: What can come from a wrong decoding: anything but usual letters and marks where they belong.
_ODD = re.compile("[^\x00-\x7f" + "".join(sorted(_USUAL | set(MARKS) | {chr(c) for c in range(0x300, 0x370)})).replace("-", "\\-").replace("]", "\\]").replace("^", "\\^") + "]|[ÂÃâ][¡¿·«»‹›‘’“”„‚–—…•\xa0-\xbf]|[а-яё][А-ЯЁ]{2}|[‚]Ä|[^\x00-\x7f][‹›‚„]|&#?\\w+;|\\\\u[0-9a-fA-F]{4}")
_ODD_TOKEN = re.compile(r"[^ \t\r\n]+")
_SWAP_HINT = re.compile("[\x80-\xff]{3}|[а-яё][А-ЯЁ]{2}|[─-╿Α-Ω]{2}")
_CYRILLIC = re.compile("[А-яЁё]")
_ASCII_LETTER = re.compile("[A-Za-z]")
#: What is no letter of the word's script between two of its letters; marks that join words aside.
_INSIDE = re.compile(r"(?<=[a-z\u00df-\u00ff])(?:[^\x00-\x7f\w’–—·™©®°\u0300-\u036f\xad\u200b-\u200f\ufeff\xa0]|[\x80-\x9f¼½¾\u0370-\u03ff])(?=[a-z\u00df-\u00ff])")

#: What is left of a UTF-8 sequence that has lost a byte.
_BROKEN = re.compile("â€|[ÂÃ][^\\w\\s,.;:!?)]")

_cache: dict[str, tuple[str, tuple[str, ...], bool]] = {}


def _piece(t: str) -> tuple[str, tuple[str, ...], bool]:
    r = _cache.get(t)
    if r is None:
        if len(_cache) > 200_000:
            _cache.clear()
        r = search(t)
        if len(t) < 100:
            _cache[t] = r
    return r


#: Words without ASCII letters in a row.
_FOREIGN_RUN = re.compile(r"(?<![^ \t\r\n(\"“«‘':;,.!?—–-])(?:[^\x00-\x7f ]+(?:[ ,.!?;:)(\"'-]+|$))+")


class _Restoration:
    """One text on its way back."""

    def __init__(self):
        self.paths: set[tuple[str, ...]] = set()
        self.whole = True  # all that was restored is ordinary text

    def over(self, pieces: re.Pattern, line: str, using: dict | None = None) -> str:
        """``line`` with its odd pieces restored; only where one of the operations ``using`` took part, if given."""
        out, at = [], 0
        for m in pieces.finditer(line):
            t = m.group()
            if not t.isascii() and (_ODD.search(t) or _SWAP_HINT.search(t)) or _ESCAPE.search(t):
                new, path, alone = _piece(t)
                if path and (using is None or any(name in using for name in path)):
                    out += [line[at : m.start()], new]
                    at = m.end()
                    self.paths.add(path)
                    self.whole &= alone and cost(new) <= ORDINARY
        return "".join(out) + line[at:]

    def carry(self, line: str) -> str:
        """Apply what restored the odd pieces of a text to its other words too, where that costs nothing."""

        def one(m: re.Match) -> str:
            t = m.group()
            if t.isascii():
                return t
            for path in self.paths:
                new = t
                for name in path:
                    new = new and OPERATIONS[name].apply(new)
                if new and new != t and cost(new) <= cost(t) and all(kind(c) in "umls" for c in new if c >= "\x80"):
                    self.whole &= cost(new) <= ORDINARY
                    return new
            return t

        return _ODD_TOKEN.sub(one, line)


def restore(text: str) -> tuple[str, bool, bool]:
    """``(restored text, garbled, whole)``.

    ``garbled``: some characters come from a wrong decoding, whether or not they can be restored
    (replacement characters and stray control characters cannot).  ``whole``: all of them are restored and
    what came out is ordinary text, so that playing the operations back gives the text as it was.
    Escapes are resolved but are no wrong decoding.  Empty and ordinary texts come back as they are.
    """
    if text.isascii() and not _ESCAPE.search(text) or not (_ODD.search(text) or _SWAP_HINT.search(text)):
        return text, False, False
    lost = _LOST in text or bool(_C1.search(text))
    lines = text.split("\n")
    r = _Restoration()
    for n, line in enumerate(lines):
        if _ODD.search(line) or _SWAP_HINT.search(line):
            if not line.isascii():  # single bytes are told by several words rather than by one
                line = r.over(_FOREIGN_RUN, line, CYRILLIC)
            lines[n] = r.over(_ODD_TOKEN, line)
    read = any(name in READERS for path in r.paths for name in path)
    if read:
        lines = [line if line.isascii() else r.carry(line) for line in lines]
    garbled = lost or any(name != "escaped" for path in r.paths for name in path)
    new = "\n".join(lines)
    return new, garbled, garbled and new != text and r.whole and _LOST not in new and not _C1.search(new) and not _BROKEN.search(new)


def _run(docs: DataFrame, key: str, text: str, with_text: bool) -> DataFrame:
    schema = pa.schema([(key, pa.int64())] + ([("text", pa.string()), ("restored", pa.bool_())] if with_text else []))

    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not t:
                    continue
                new, garbled, whole = restore(t)
                if garbled:
                    out.append((k, new, whole) if with_text else (k,))
            cols = list(zip(*out)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return spread(docs.select(F.col(key).cast("bigint").alias(key), text)).mapInArrow(run, f"{key} bigint" + (", text string, restored boolean" if with_text else ""))


def found(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` of the documents with wrongly decoded characters.  Narrow: one pass, no shuffle.  NULL and empty: none."""
    return _run(docs, key, text, False)


def restored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text, restored``: those documents as far as they can be restored; ``restored``: completely, to ordinary text."""
    return _run(docs, key, text, True)
