"""Column expressions over text.  All stay in generated JVM code; none is a Python UDF
except :func:`nfc`, for which Spark has no built-in.

Every function maps NULL to NULL unless its docstring says otherwise.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

__all__ = [
    "strip", "humanize", "grammar_name", "file_stem", "keyword_category", "instruction_type",
    "identified_category", "canonical_instruction", "first_filled", "nfc", "replace_digraph",
    "truncate_words", "direction", "short_status", "register",
]


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(_c(x), rf"^{K.WS}+|{K.WS}+$", "")


def first_filled(*xs: Column) -> Column:
    """The first argument that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in xs], F.lit(""))


def humanize(x: Column | str) -> Column:
    """Underscores and hyphens as spaces, stripped."""
    return strip(F.translate(_c(x), "_-", "  "))


def file_stem(path: Column | str) -> Column:
    """The last part of a path without its last suffix; a name that only begins with a dot keeps it."""
    name = F.regexp_extract(_c(path), r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=[^/])\.[^.]*$", "")


def grammar_name(path: Column | str) -> Column:
    """A grammar name made of a file name: no version, spaces and hyphens as underscores, lower case."""
    unversioned = F.regexp_replace(file_stem(path), r"_v\p{Nd}+$", "")
    return F.lower(F.regexp_replace(unversioned, rf"(?:{K.WS}|-)+", "_"))


def keyword_category(name: Column | str) -> Column:
    """The category of the first listed keyword that the lower-cased name contains."""
    low = F.lower(_c(name))
    start = F.when(low.isNull(), F.lit(None).cast("string"))
    chain = reduce(lambda acc, kv: acc.when(low.contains(kv[0]), F.lit(kv[1])), K.CATEGORY_KEYWORDS, start)
    return chain.otherwise(F.lit(K.DEFAULT_CATEGORY))


def instruction_type(x: Column | str) -> Column:
    """One of :data:`constants.ITYPES`; case-sensitive; NULL is ``other``."""
    c = _c(x)
    return (
        F.when(c == K.B2E, "translate_b2e").when(c == K.E2B, "translate_e2b")
        .when(c.startswith("Identify"), "identify").when(c.startswith("Explain"), "explain").otherwise("other")
    )


_IDENTIFY = "(?i)" + K.IDENTIFY_PATTERN.replace(r"\s", K.WS).replace("(.+)", r"([^\n]+)").replace("$", r"\n?\z")


def identified_category(x: Column | str) -> Column:
    """What an instruction of the identify kind asks for, stripped; NULL for other instructions.

    The pattern is only tried on what begins with the word, which most instructions don't.
    """
    c = _c(x)
    begins = F.lower(F.substring(c, 1, 8)) == "identify"
    return F.when(begins, F.when(c.rlike(_IDENTIFY), strip(F.regexp_extract(c, _IDENTIFY, 1))))


def canonical_instruction(x: Column | str) -> Column:
    """One spelling for each identify instruction; every other text stays as it is."""
    c, cat = _c(x), identified_category(x)
    lead = F.when(F.lower(cat).startswith("balanda"), "Identify the ").otherwise("Identify the Balanda ")
    return F.when(cat.isNull() | c.isin(K.B2E, K.E2B), c).otherwise(F.concat(lead, cat))


def direction(instruction: Column | str) -> Column:
    """Translation direction by the words of the instruction."""
    return F.when(_c(instruction).contains("Balanda to English"), "b2e").otherwise("e2b")


def short_status(x: Column | str) -> Column:
    """A status of at most 18 characters: longer ones keep 15 and get an ellipsis."""
    c = _c(x)
    return F.when(F.length(c) > 18, F.concat(F.substring(c, 1, 15), F.lit("..."))).otherwise(c)


def replace_digraph(x: Column | str) -> Column:
    """``ng'`` as ``ŋ`` (both cases).  Opt-in: an English quotation mark after *ng* matches as well."""
    c = F.replace(_c(x), F.lit("ng'"), F.lit("ŋ"))
    return F.replace(F.replace(c, F.lit("Ng'"), F.lit("Ŋ")), F.lit("NG'"), F.lit("Ŋ"))


def truncate_words(x: Column | str, n: int) -> Column:
    """At most the first ``n`` words, single-spaced.  A stand-in where no tokenizer is named."""
    words = F.filter(F.split(_c(x), K.WS + "+"), lambda w: w != "")
    return F.array_join(F.slice(words, 1, n), " ")


def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def nfc(x: Column | str) -> Column:
    """Unicode NFC.  Opt-in."""
    return F.pandas_udf(_nfc, "string")(_c(x))


def register(spark) -> None:
    """Make ``nfc`` callable from SQL."""
    spark.udf.register("nfc", F.pandas_udf(_nfc, "string"))
