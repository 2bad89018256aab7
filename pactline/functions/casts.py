"""Contract type casts and value-to-text rendering.

Source fields are always read as JSON text (never inferred); these turn
that text into the declared type, and render typed values back to the
text a record holds for hashing and for the EAV value column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactline.contract import COLUMN_TYPES


def parse_integer(text: Column, strict: bool = True) -> Column:
    """JSON text -> BIGINT, as ``int()`` treats a parsed JSON value.

    Integers as they are; numbers with a fraction or exponent truncated
    toward zero (``int(7.9) == 7``); ``true``/``false`` as 1/0. The parsed
    text cannot tell ``7.0`` from ``"7.0"``, so the quoted forms are
    accepted too (where the original would stop the run).
    """
    value = F.coalesce(
        text.try_cast("bigint"),
        text.try_cast("decimal(38,9)").try_cast("bigint"),
        F.when(text == F.lit("true"), F.lit(1).cast("bigint")).when(text == F.lit("false"), F.lit(0).cast("bigint")),
    )
    if not strict:
        return value
    message = F.concat(F.lit("cannot cast value to bigint: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(message).cast("bigint")).otherwise(value)


def to_utc_wall_clock(instant: Column) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ holding the UTC wall clock."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


# Rewrites from the ISO 8601 variants Python's ``datetime.fromisoformat``
# reads to the extended form Spark's cast reads, applied in order: basic
# date, any one separator character, basic time, missing minutes and
# seconds, "," fraction, fraction beyond microseconds, +-HHMM and +-HH offsets.
ISO_REWRITES = (
    (r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3"),
    (r"^(\d{4}-\d{2}-\d{2})[^\d](?=\d)", "$1T"),
    (r"T(\d{2})(\d{2})(\d{2})(?![\d:])", "T$1:$2:$3"),
    (r"T(\d{2})(\d{2})(?![\d:])", "T$1:$2"),
    (r"T(\d{2})(?![\d:])", "T$1:00"),
    (r"T(\d{2}):(\d{2})(?![\d:])", "T$1:$2:00"),
    (r"(T\d{2}:\d{2}:\d{2}),(\d)", "$1.$2"),
    (r"(T\d{2}:\d{2}:\d{2}\.\d{6})\d+", "$1"),
    (r"(T[\d:.]+[+-]\d{2})(\d{2})$", "$1:$2"),
    (r"(T[\d:.]+[+-]\d{2})$", "$1:00"),
)


# A calendar date, then optionally any one separator, a time and an offset.
# Spark's cast alone would also read times without a date (as today), years
# and months alone, zone names and outer blanks.
ISO_DATE_TIME = r"^\d{4}(-\d{2}-\d{2}|\d{4})([^\d]\d{2}[\d:.,]*(Z|[+-]\d{2}[\d:.]*)?)?$"


def _iso_extended(text: Column) -> Column:
    """The ISO variants Spark's cast rejects, rewritten to the extended form.

    A chain of single-pass rewrites (each appears once in the expression),
    reached only when the plain cast failed.
    """
    out = text
    for pattern, replacement in ISO_REWRITES:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def parse_timestamp(text: Column, strict: bool = True, formats: list[str] | None = None) -> Column:
    """ISO-8601 text -> UTC wall clock (TIMESTAMP_NTZ).

    Text with an offset is converted to UTC; text without one is read in
    the session time zone (pinned to UTC by the session builder). With
    ``formats``, each pattern is tried first. Spark's cast reads the common
    extended form; the other forms Python's ``fromisoformat`` accepts
    (basic format, ``HH:MM``, ``+HHMM`` offsets, ``,`` fractions ...) are
    rewritten by ``ISO_REWRITES``, only for values the cast rejected.

    ISO week dates and offsets Java cannot hold are left out on purpose:
    adding them as further candidates slowed timestamp-heavy queries by
    about 40% in a measured A/B (presumably the larger generated code of
    the mapping projection), too high a price for forms that do not occur
    in practice.
    """
    candidates = [F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats or []]
    iso = F.when(text.rlike(ISO_DATE_TIME), text)
    candidates.append(iso.try_cast("timestamp"))
    candidates.append(_iso_extended(iso).try_cast("timestamp"))
    value = to_utc_wall_clock(F.coalesce(*candidates))
    if strict:
        message = F.concat(F.lit("cannot cast value to timestamp: "), text)
        value = F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message).cast("timestamp_ntz")))
    return value


def cast_declared(text: Column, col_type: str, strict: bool = True, formats: list[str] | None = None) -> Column:
    """JSON text of a source field -> the contract type."""
    if col_type in ("string", "json"):
        return text
    if col_type == "integer":
        return parse_integer(text, strict)
    if col_type == "timestamp":
        return parse_timestamp(text, strict, formats)
    raise ValueError(f"unsupported column type {col_type!r}")


def spark_type(col_type: str) -> str:
    return COLUMN_TYPES[col_type]


def iso_text(ts: Column) -> Column:
    """UTC wall clock -> ISO text with ``+00:00``; fraction only when non-zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.when(F.date_format(ts, "SSSSSS") == F.lit("000000"), whole).otherwise(frac)


def value_text(col: Column, col_type: str) -> Column:
    """The text a record holds for a typed value (null stays null)."""
    if col_type == "timestamp":
        return iso_text(col)
    if col_type == "integer":
        return col.cast("string")
    return col
