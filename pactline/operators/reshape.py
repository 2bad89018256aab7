"""Fan-out of the deduplicated business frame into the two outputs.

* core: one row per record, business columns plus the core keep-list of
  audit columns; an audit column replaces a business column of the same
  name. Everything is cast to its declared type (audit types win).
* atts: entity-attribute-value, exactly one row per (record, business
  column), nulls kept, carrying the atts keep-list of audit columns.

Both are projections of the same frame (a generator for atts): no
shuffle. The per-record surrogate is deterministic for the run, so the
two branches agree on ``registro_id``/``registro_hash`` even when each
recomputes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.contract import AUDIT_COLUMN_TYPES, EAV_FIELDS, Contract
from pactline.operators.audit import RunContext, resolve_audit
from pactline.operators.mapping import values_of
from pactline.operators.values import Val


def _audit_value(audit: dict[str, Val], name: str) -> Val:
    return audit.get(name, Val.lit(None))


def core_frame(deduped: DataFrame, contract: Contract, ctx: RunContext) -> DataFrame:
    business = values_of(deduped.columns, contract)
    audit = resolve_audit(contract, business, ctx)
    types = {**contract.types, **contract.audit_types}
    keep = contract.core.audit
    cols = []
    for name in contract.types:
        value = _audit_value(audit, name) if name in keep else business[name]
        cols.append(value.as_type(types[name]).alias(name))
    for name in keep:
        if name not in business:
            cols.append(_audit_value(audit, name).as_type(types[name]).alias(name))
    return deduped.select(*cols)


def atts_frame(deduped: DataFrame, contract: Contract, ctx: RunContext) -> DataFrame:
    business = values_of(deduped.columns, contract)
    audit = resolve_audit(contract, business, ctx)
    types = contract.audit_types
    shared = [n for n in contract.atts.audit if n not in EAV_FIELDS]
    shared_cols = [_audit_value(audit, n).as_type(types[n]).alias(n) for n in shared]
    attrs = F.array(*[
        F.struct(
            F.lit(spec.name).alias("atributo_nombre"),
            F.lit(spec.type).alias("atributo_tipo"),
            F.lit(spec.position).cast("bigint").alias("atributo_posicion"),
            business[spec.name].nullable_text().alias("atributo_valor"),
        )
        for spec in contract.fields
    ])
    eav_types = {n: AUDIT_COLUMN_TYPES.get(n, "string") for n in EAV_FIELDS}
    exploded = deduped.select(*shared_cols, F.inline(attrs))
    return exploded.select(
        *shared,
        *[F.col(n).cast("bigint" if eav_types[n] == "integer" else "string").alias(n) for n in EAV_FIELDS],
    )
