"""The published look-alike table (Unicode Technical Standard 39), read from what every Spark distribution brings along.

Spark's collations use the ICU library, whose archive holds the whole table in ICU's binary form: big-endian
numbers after ICU's common header; sorted keys with a code point in the lower 24 bits and the length of the
prototype, less one, in the upper 8; for each key a value, which is the prototype itself if it is one UTF-16
unit, else its place in a string of UTF-16 units.
"""

from __future__ import annotations

import glob
import os
import struct
import zipfile

_MEMBER = "com/ibm/icu/impl/data/icudata/confusables.cfu"
_MAGIC = 0x3845FDEF


def archive() -> str:
    """Where Spark's ICU library is on this machine."""
    import pyspark

    for home in (os.environ.get("SPARK_HOME"), os.path.dirname(pyspark.__file__)):
        found = sorted(glob.glob(os.path.join(home, "jars", "icu4j-*.jar"))) if home else []
        if found:
            return found[-1]
    raise FileNotFoundError("no icu4j library among Spark's jars: set SPARK_HOME to a whole Spark distribution")


def parse(data: bytes) -> dict[str, str]:
    """Character to prototype."""
    body = data[struct.unpack(">H", data[:2])[0] :]
    magic, _, _, keys_at, n, values_at, m, text_at, units = struct.unpack(">9I", body[:36])
    if magic != _MAGIC or n != m:
        raise ValueError("not ICU's table of confusables")
    keys = struct.unpack(f">{n}I", body[keys_at : keys_at + 4 * n])
    values = struct.unpack(f">{n}H", body[values_at : values_at + 2 * n])
    text = body[text_at : text_at + 2 * units]
    out = {}
    for k, v in zip(keys, values):
        length = (k >> 24) + 1
        out[chr(k & 0xFFFFFF)] = chr(v) if length == 1 else text[2 * v : 2 * (v + length)].decode("utf-16-be")
    return out


def table(path: str | None = None) -> dict[str, str]:
    """The whole table, of ``path`` or of Spark's own library."""
    with zipfile.ZipFile(path or archive()) as z:
        return parse(z.read(_MEMBER))
