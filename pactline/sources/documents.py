"""Strict whole-document JSON parsing, tolerant per document.

A landing document is one JSON object per file. A document that is not
valid UTF-8 JSON holding exactly one object is not an error for the batch:
it gets a status other than ``ok`` and is routed to the quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactline.contract import RESERVED_SOURCE_FIELD

OK = "ok"
EMPTY = "empty"
INVALID_UTF8 = "invalid_utf8"
INVALID_JSON = "invalid_json"
NOT_OBJECT = "not_object"
TOO_LARGE = "too_large"
GONE = "gone"

# Strict JSON: no single quotes, no comments, no unquoted names, no
# leading zeros, no raw control characters (Spark defaults differ on the
# first one).
STRICT_JSON = {
    "allowSingleQuotes": "false",
    "allowComments": "false",
    "allowUnquotedFieldNames": "false",
    "allowNumericLeadingZeros": "false",
    "allowUnquotedControlChars": "false",
    "allowBackslashEscapingAnyCharacter": "false",
    "mode": "PERMISSIVE",
    # No parser limits: any document that fits in a value is read.
    "maxStringLen": "2147483647",
    "maxNumLen": "2147483647",
    "maxNestingDepth": "2147483647",
}


def _ddl_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# Fixed value: key of the end marker appended after every document.
END_KEY = RESERVED_SOURCE_FIELD
END_MARK = '{"' + END_KEY + '":1}'
BOM = "\ufeff"


def record_schema(fields: list[str]) -> str:
    """Every source field read as its raw JSON text (strings never inferred)."""
    inner = ",".join(f"{_ddl_name(f)}:string" for f in [*fields, END_KEY])
    return f"array<struct<{inner}>>"


def _wrapped(text: Column) -> Column:
    """``[`` + document (one leading BOM dropped) + ``,`` + end marker + ``]``.

    Spark's JSON reader stops after the first complete value and ignores
    what follows, so the document alone, or the document in brackets,
    would accept ``{...}] junk``. With the end marker as a second array
    element, a good document parses to exactly ``[record, marker]``:
    trailing data, a second document or a stray ``]`` all break that shape.
    """
    # One leading BOM is dropped with a prefix test (a ``^`` regex would still
    # try every position of the document).
    body = F.when(text.startswith(F.lit(BOM)), F.substring(text, 2, 2147483647)).otherwise(text)
    return F.concat(F.lit("["), body, F.lit("," + END_MARK + "]"))


def kind_field(name: str) -> str:
    """Record field that says whether ``name`` held a JSON string (read as text, ``"5"`` and ``5`` look alike)."""
    return f"{RESERVED_SOURCE_FIELD}string:{name}"


def _with_parse(docs: DataFrame, text: Column, fields: list[str], keep: tuple[str, ...],
                path: Column, json_fields: tuple[str, ...] = ()) -> DataFrame:
    """Lower projection: the document parsed once into ``_p``; ``json_fields`` again, as typed values, into ``_v``.

    A document is good when the wrapped array is exactly one non-null
    struct followed by the end marker (see ``_wrapped``). Nested values and
    numbers come back as their JSON text. The parse is its own projection
    so that status and record read ``_p`` instead of re-parsing (Catalyst
    does not collapse a non-cheap expression used more than once).
    """
    parsed = F.from_json(_wrapped(text), record_schema(fields), STRICT_JSON)
    typed = []
    if json_fields:
        inner = ",".join(f"{_ddl_name(f)}:variant" for f in json_fields)
        typed = [F.from_json(_wrapped(text), f"array<struct<{inner}>>", STRICT_JSON).getItem(0).alias("_v")]
    return docs.select(*keep, path.alias("source_path"), text.alias("_text"), parsed.alias("_p"), *typed)


def _is_good() -> Column:
    p = F.col("_p")
    return (F.is_valid_utf8(F.col("_text")) & (F.size(p) == 2) & p.getItem(0).isNotNull()
            & (p.getItem(1).getField(END_KEY) == F.lit("1")))


def _record(fields: list[str], json_fields: tuple[str, ...] = ()) -> Column:
    """The document's fields as text, and for ``json_fields`` whether each was a JSON string.

    A typed value that could not be built (an object that names a key twice) is no string.
    """
    if not json_fields:
        return F.col("_p").getItem(0).dropFields(END_KEY)
    record = F.col("_p").getItem(0)
    quoted = lambda f: F.coalesce(F.startswith(F.to_json(F.col("_v").getField(f)), F.lit('"')), F.lit(False))
    return F.struct(*(record.getField(f).alias(f) for f in fields), *(quoted(f).alias(kind_field(f)) for f in json_fields))


def _status() -> Column:
    """Why a document is (not) good; the second parse runs for bad documents only.

    Every field is read as text, so any JSON object parses to a non-null
    record: a document that is valid JSON (the wrapped array parses to the
    value and the end marker) but not good is a non-object value.
    """
    as_text = F.from_json(_wrapped(F.col("_text")), "array<string>", STRICT_JSON)
    valid_json = (F.size(as_text) == 2) & (as_text.getItem(1) == F.lit(END_MARK))
    return (
        F.when(~F.is_valid_utf8(F.col("_text")), F.lit(INVALID_UTF8))
        .when(_is_good(), F.lit(OK))
        .when(valid_json, F.lit(NOT_OBJECT))
        .otherwise(F.lit(INVALID_JSON))
    )


def _status_and_record(lower: DataFrame, keep: tuple[str, ...], status: Column, record: Column) -> DataFrame:
    """``(*keep, source_path, status, rec)``, passed through a one-row generator.

    Status and record are computed in a (code-generated) projection; the
    generator only re-emits them. A filter on a generator's output cannot
    be pushed below it, so a later ``status = 'ok'`` (or ``<> 'ok'``)
    filter does not drag the parse into a pushed-down predicate.
    """
    upper = lower.select(*keep, "source_path", status.alias("_status"),
                         F.when(_is_good(), record).alias("_rec"))
    fence = F.inline(F.array(F.struct(F.col("_status").alias("status"), F.col("_rec").alias("rec"))))
    return upper.select(*keep, "source_path", fence)


def parse_documents(docs: DataFrame, fields: list[str], text_col: str = "text",
                    keep: tuple[str, ...] = (), json_fields: tuple[str, ...] = ()) -> DataFrame:
    """``docs(source_path, <text_col>)`` -> ``(*keep, source_path, status, rec)``.

    Narrow: projections only, no shuffle; runs inside the scan's stage.
    """
    lower = _with_parse(docs, F.col(text_col), fields, keep, F.col("source_path"), json_fields)
    return _status_and_record(lower, keep, _status(), _record(fields, json_fields))


def good_documents(docs: DataFrame, fields: list[str], text_col: str = "text",
                   keep: tuple[str, ...] = (), json_fields: tuple[str, ...] = ()) -> DataFrame:
    """Only the good documents: ``(*keep, source_path, rec)``.

    A generator (``explode`` of the one-element array, or of nothing)
    instead of a filter: a filter on the parse result would be pushed below
    the projection and inlined, parsing every document twice.
    """
    lower = _with_parse(docs, F.col(text_col), fields, keep, F.col("source_path"), json_fields)
    one = F.when(_is_good(), F.array(_record(fields, json_fields)))
    return lower.select(*keep, "source_path", F.explode(one).alias("rec"))


def parse_binary_documents(files: DataFrame, fields: list[str], max_bytes: int | None = None,
                           json_fields: tuple[str, ...] = ()) -> DataFrame:
    """``binaryFile`` rows ``(path, length, content)`` -> ``(source_path, status, rec)``.

    A row without content was not read: its file is too large or has gone
    (length -1). Zero-length files never reach a ``binaryFile`` scan; see
    ``landing.missing_from_scan``. With ``max_bytes``, larger files are not
    read at all (the ``length`` filter is evaluated by the file source before
    it loads content) and are reported as ``too_large`` instead of failing
    the scan.
    """
    readable = files if max_bytes is None else files.where(F.col("length") <= F.lit(max_bytes))
    lower = _with_parse(readable.withColumn("_len", F.col("length")), F.col("content").cast("string"), fields,
                        ("_len",), F.col("path"), json_fields)
    unread = F.when(F.col("_len") < 0, F.lit(GONE)).otherwise(F.lit(TOO_LARGE))
    status = F.when(F.col("_len") == 0, F.lit(EMPTY)).when(F.col("_text").isNull(), unread).otherwise(_status())
    parsed = _status_and_record(lower, (), status, _record(fields, json_fields))
    if max_bytes is None:
        return parsed
    oversized = files.where(F.col("length") > F.lit(max_bytes)).select(
        F.col("path").alias("source_path"), F.lit(TOO_LARGE).alias("status"),
        F.lit(None).cast(parsed.schema["rec"].dataType).alias("rec"))
    return parsed.unionByName(oversized)
