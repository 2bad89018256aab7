"""Rename, stamp, cast and clean: parsed documents -> business columns.

The whole mapping is one projection over the parsed frame, planned once
from the contract; it runs in the scan's stage (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactline.contract import Contract, Field
from pactline.functions.casts import cast_declared
from pactline.functions.text import RULES_PY, RULES_SPARK, json_literal, json_quoted, json_text
from pactline.operators.values import Val
from pactline.sources.documents import kind_field


def map_values(contract: Contract, rec: str = "rec", strict_casts: bool = True,
               honor_input_formats: bool = False) -> dict[str, Val]:
    """Every business column's value before cleaning: a document field cast to its type (null if absent), or a constant."""
    def value(f: Field) -> Val:
        if f.field is None:
            return Val.lit(f.constant, f.type)
        text = F.col(rec).getField(f.field)
        kind = F.col(rec).getField(kind_field(f.field)) if f.type == "json" else None
        return Val.col(cast_declared(text, f.type, strict_casts, list(f.formats) if honor_input_formats else None), f.type, kind)

    return {f.name: value(f) for f in contract.fields}


def _is_text(v: Val) -> bool:
    """Whether some record may hold text here, so that a cleaning rule applies.

    Timestamps are left out: no rule changes ISO text. A JSON value is text where it is a JSON string.
    """
    return isinstance(v.value, str) if v.is_lit else v.ctype == "string" or v.is_string is not None


def _cleaned(v: Val, kind: str, accents: str) -> Val:
    if v.is_lit:
        return Val.lit(RULES_PY[kind](v.value), v.ctype)
    done = RULES_SPARK[kind](v.value, accents)
    return Val.col(done if v.is_string is None else F.when(v.is_string, done).otherwise(v.value), v.ctype, v.is_string)


def clean_values(contract: Contract, values: dict[str, Val], accents: str = "native") -> dict[str, Val]:
    """The contract's rules one after another, each on the columns it names or on all text; constants on the driver."""
    out = dict(values)
    for rule in contract.rules:
        named = out if rule.get("selector") == "all-string" else rule.get("columns", ())
        out |= {n: _cleaned(out[n], rule["type"], accents) for n in named if n in out and _is_text(out[n])}
    return out


def serialized(values: dict[str, Val], json_mode: str = "compact") -> dict[str, Val]:
    """``json`` values as JSON text, null kept: strings quoted, so ``"5"`` and ``5`` differ; constants like fields."""
    out = dict(values)
    for name, v in values.items():
        if v.ctype != "json":
            continue
        if v.is_lit:
            out[name] = v if v.value is None else Val.lit(json_literal(v.value, json_mode), "json")
        else:
            text = json_text(v.value, json_mode)
            out[name] = Val.col(text if v.is_string is None else F.when(v.is_string, json_quoted(v.value)).otherwise(text), "json")
    return out


def business_values(contract: Contract, rec: str = "rec", strict_casts: bool = True,
                    accents: str = "native", honor_input_formats: bool = False,
                    json_mode: str = "compact") -> dict[str, Val]:
    values = clean_values(contract, map_values(contract, rec, strict_casts, honor_input_formats), accents)
    return serialized(values, json_mode)


def map_records(parsed: DataFrame, contract: Contract, strict_casts: bool = True,
                accents: str = "native", keep: tuple[str, ...] = ("source_path",),
                honor_input_formats: bool = False, json_mode: str = "compact", errors: str | None = None) -> DataFrame:
    """Good documents -> ``(source_path, <business columns typed>)``.

    Every business column is materialised with its declared Spark type,
    constants included, so downstream operators see one static schema.
    """
    values = business_values(contract, "rec", strict_casts, accents, honor_input_formats, json_mode)
    cols = [v.as_type(contract.types[n]).alias(n) for n, v in values.items()]
    if errors is None:
        return parsed.select(*keep, *cols)
    # Values first, then the errors from values and texts: each cast stands once in the plan.
    typed = parsed.select(*keep, "rec", *cols)
    return typed.select(*keep, *values, cast_error_list(contract).alias(errors))


def cast_error_list(contract: Contract, rec: str = "rec") -> Column:
    """``array<struct<column, text, reason>>`` of a typed record: fields that hold text but got no value of their type."""
    found = []
    for f in contract.fields:
        if f.field is not None and f.type in ("integer", "timestamp"):
            text = F.col(rec).getField(f.field)
            error = F.struct(F.lit(f.name).alias("column"), text.alias("text"), F.lit(f"not_{f.type}").alias("reason"))
            found.append(F.when(text.isNotNull() & F.col(f.name).isNull(), error))
    empty = F.array().cast("array<struct<column:string,text:string,reason:string>>")
    return F.array_compact(F.array(*found)) if found else empty


def values_of(frame_columns: list[str], contract: Contract) -> dict[str, Val]:
    """Business values of an already mapped frame: constants stay literals, but for json ones, written in the run's mode."""
    constants = clean_values(contract, map_values(contract))
    keep = lambda f: constants[f.name].is_lit and f.type != "json"
    return {f.name: constants[f.name] if keep(f) else Val.col(F.col(f.name), f.type) for f in contract.fields}
