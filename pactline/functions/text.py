"""Text cleaning as JVM-side Column expressions.

Each rule has a Spark form (used on data) and a Python form (used on the
driver to fold contract literals, and by the exact accents mode).
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Built from Python's own definition of whitespace (what ``str.strip()``
# removes): 29 code points.
PY_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def strip_py(value: str) -> str:
    return value.strip()


def upper_py(value: str) -> str:
    return value.upper()


def remove_accents_py(value: str) -> str:
    """NFKD, then drop every code point with a non-zero combining class."""
    decomposed = unicodedata.normalize("NFKD", value)
    return "".join(ch for ch in decomposed if not unicodedata.combining(ch))


def trim_ws(col: Column) -> Column:
    """Strip leading/trailing Unicode whitespace (plain ``trim`` strips only U+0020)."""
    return F.trim(col, F.lit(PY_WHITESPACE))


def upper_full(col: Column) -> Column:
    """Full Unicode upper case (``ß`` -> ``SS``), as Python's ``str.upper``."""
    return F.upper(col)


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str, int]:
    """``translate`` arguments generated from ``unicodedata``.

    For every code point, NFKD-without-marks of the single character is
    either itself (skipped), one character (a mapping), nothing (a
    deletion) or several characters (cannot be expressed by ``translate``;
    counted and left unchanged). Mappings come first in ``matching`` so
    that the trailing deletions have no replacement and are removed.
    """
    src, dst, dele = [], [], []
    multi = 0
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        out = remove_accents_py(ch)
        if out == ch:
            continue
        if len(out) == 1:
            src.append(ch)
            dst.append(out)
        elif not out:
            dele.append(ch)
        else:
            multi += 1
    return "".join(src) + "".join(dele), "".join(dst), multi


def remove_accents(col: Column, mode: str = "native") -> Column:
    """Drop accents.

    ``native`` (default) stays inside whole-stage codegen with one
    ``translate``; it is exact for every code point whose accent-free form
    is at most one character. ``exact`` runs Python's NFKD in an
    Arrow-batched UDF, exact for the remaining compatibility expansions
    (Hangul syllables, ligatures such as ``ﬁ``).
    """
    if mode == "exact":
        return _exact_accents_udf()(col)
    if mode != "native":
        raise ValueError(f"unknown accents mode {mode!r}")
    matching, replace, _ = accent_table()
    # ASCII text (as many bytes as characters) has nothing to remove: skip
    # the per-character table lookups.
    return F.when(F.octet_length(col) == F.length(col), col).otherwise(F.translate(col, matching, replace))


@lru_cache(maxsize=1)
def _exact_accents_udf():
    """Arrow-batched NFKD accent removal.

    Built as a closure over the standard library only, so it is shipped to
    the Python workers by value: executors need no copy of this package.
    """
    import unicodedata as ud

    def strip_accents(values: pd.Series) -> pd.Series:
        def one(v):
            if v is None or v.isascii():  # ASCII text has nothing to remove
                return v
            return "".join(ch for ch in ud.normalize("NFKD", v) if not ud.combining(ch))

        return values.map(one)

    return F.pandas_udf(strip_accents, StringType())


RULES_SPARK = {
    "trim": lambda c, mode: trim_ws(c),
    "uppercase": lambda c, mode: upper_full(c),
    "remove_accents": lambda c, mode: remove_accents(c, mode),
}

RULES_PY = {
    "trim": strip_py,
    "uppercase": upper_py,
    "remove_accents": remove_accents_py,
}


def basename(path: Column) -> Column:
    """Last ``/``-separated segment; empty when the path ends with ``/``."""
    return F.element_at(F.split(path, "/"), -1)


def python_json_text_py(text: str | None) -> str | None:
    """JSON text re-serialised as ``json.dumps(value, ensure_ascii=False)`` writes it.

    Text that is not JSON is a JSON string's content (the parser unquotes
    strings) and is written as a quoted JSON string.
    """
    import json

    if text is None:
        return None
    try:
        value = json.loads(text)
    except ValueError:
        value = text
    return json.dumps(value, ensure_ascii=False)


@lru_cache(maxsize=1)
def _python_json_udf():
    """Arrow-batched ``json.dumps`` re-serialisation (a closure shipped by value)."""
    import json as js

    def dumps(values: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            try:
                value = js.loads(text)
            except ValueError:
                value = text
            return js.dumps(value, ensure_ascii=False)

        return values.map(one)

    return F.pandas_udf(dumps, StringType())


def json_literal(value, mode: str = "compact") -> str:
    """A constant as JSON text."""
    import json

    return json.dumps(value, ensure_ascii=False, separators=(",", ":") if mode == "compact" else None)


def json_quoted(col: Column) -> Column:
    """Text as a quoted JSON string (a one-element array's JSON without its brackets)."""
    array = F.to_json(F.array(col))
    return F.when(col.isNotNull(), F.substring(array, F.lit(2), F.char_length(array) - 2))


def json_text(col: Column, mode: str = "compact") -> Column:
    """Text of a ``json`` column: compact (JVM) or ``json.dumps`` spacing (Arrow UDF)."""
    if mode == "compact":
        return col
    if mode == "python":
        return _python_json_udf()(col)
    raise ValueError(f"unknown json text mode {mode!r}")
