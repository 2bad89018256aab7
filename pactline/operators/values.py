"""Plan-time values: a contract literal or a Column, with its contract type.

Contract constants (default values, header fields, hashes of constants,
processing dates) stay Python values until the final projection, so they
are computed exactly once on the driver and reach Spark as literals.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactline.contract import COLUMN_TYPES
from pactline.functions.casts import iso_text, parse_timestamp, value_text


def py_text(value: Any) -> str:
    """``str(value)`` as the record would render it for hashing."""
    return str(value)


def written_text(value: Any) -> str | None:
    """Text a literal has once written to a string column."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (dict, list)):
        return json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    return str(value)


@dataclass(frozen=True)
class Val:
    """A value that every record shares (``lit``) or a per-record Column (``col``)."""

    kind: str
    value: Any
    ctype: str = "string"
    # For a ``json`` column before it is written: whether the record's value is a JSON string.
    is_string: Any = None

    @staticmethod
    def lit(value: Any, ctype: str = "string") -> "Val":
        return Val("lit", value, ctype)

    @staticmethod
    def col(column: Column, ctype: str, is_string: Column | None = None) -> "Val":
        return Val("col", column, ctype, is_string)

    @property
    def is_lit(self) -> bool:
        return self.kind == "lit"

    @property
    def is_null(self) -> bool:
        return self.kind == "lit" and self.value is None

    def text(self) -> Column:
        """Per-record text, ``''`` for null (hash input)."""
        if self.is_lit:
            return F.lit("" if self.value is None else py_text(self.value))
        return F.coalesce(value_text(self.value, self.ctype), F.lit(""))

    def nullable_text(self) -> Column:
        """Per-record text, null kept (EAV value)."""
        if self.is_lit:
            return F.lit(written_text(self.value)).cast("string")
        return value_text(self.value, self.ctype)

    def as_type(self, ctype: str) -> Column:
        """The value written into a column of contract type ``ctype``."""
        spark_type = COLUMN_TYPES[ctype]
        if self.is_lit:
            if self.value is None:
                return F.lit(None).cast(spark_type)
            if ctype == "timestamp":
                return _literal_timestamp(self.value)
            if ctype == "integer":
                if isinstance(self.value, (bool, int)):
                    return F.lit(int(self.value)).cast("bigint")
                return F.lit(written_text(self.value)).cast("bigint")
            return F.lit(written_text(self.value))
        if ctype == self.ctype or (ctype in ("string", "json") and self.ctype in ("string", "json")):
            return self.value
        if ctype == "timestamp":
            return parse_timestamp(value_text(self.value, self.ctype))
        if ctype == "integer":
            return value_text(self.value, self.ctype).cast("bigint")
        if self.ctype == "timestamp":
            return iso_text(self.value)
        return self.value.cast(spark_type)


def _literal_timestamp(value: Any) -> Column:
    """Literal text -> UTC wall clock, parsed once on the driver."""
    if isinstance(value, datetime):
        parsed = value
    else:
        parsed = datetime.fromisoformat(str(value))
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(parsed.isoformat(sep=" ")).cast("timestamp_ntz")
