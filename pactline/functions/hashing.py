"""SHA-256 based audit values."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator of the surrogate-key inputs (ASCII unit separator).
UNIT_SEP = "\u001f"


def sha256_hex_py(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def sha256_joined(parts: list[Column], delimiter: str = "") -> Column:
    """sha256 of the delimiter-joined parts; a null part is an empty segment.

    ``concat_ws`` alone skips nulls (``a##b`` would become ``a#b``), so
    every part is coalesced to ``''`` first.
    """
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws(delimiter, *texts), 256)


def surrogate_key(run_id: str, column_name: str, source_path: Column) -> Column:
    """Per-record surrogate: sha256(run id, audit column, source path).

    Unique per record (one record per source document), new on every run,
    and deterministic for a given run, so a retried task or the second
    branch of a two-output plan recomputes the very same value.
    """
    return F.sha2(F.concat_ws(UNIT_SEP, F.lit(run_id), F.lit(column_name), source_path), 256)
