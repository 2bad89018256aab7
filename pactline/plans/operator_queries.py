"""Per-operator queries over the given tables (whole tables, whole texts).

Nulls, duplicates, ties and corrupt payloads are injected by rule, since
the tables hold none; the same rules appear in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.contract import load_contract
from pactline.functions.casts import iso_text, parse_timestamp
from pactline.functions.text import basename, remove_accents, trim_ws, upper_full
from pactline.operators.audit import resolve_audit
from pactline.operators.dedup import keep_best
from pactline.operators.mapping import map_values
from pactline.operators.reshape import atts_frame
from pactline.operators.values import Val
from pactline.plans import stages
from pactline.plans.queries import CTX, _landing_deduped, _landing_good
from pactline.session import apply_defaults
from pactline.sources.documents import parse_documents
from pactline.sources.testdata import table

# The whitespace wrappers used to exercise Unicode trim.
TRIM_WRAPPERS = ["\u3000", "\u00a0\u2009", "\t\n", "\u2028 ", "\u1680\u0085", ""]

# Offsets appended to event times to exercise UTC conversion.
TS_OFFSETS = ["-05:00", "+01:30", "Z", "+00:00", ""]


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)).cast("int") + 1)


# -- cleaning functions -------------------------------------------------------

def trim_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    wrapped = F.concat(_pick(TRIM_WRAPPERS, F.col("conv_id") + F.col("turn")), F.col("text"),
                       _pick(TRIM_WRAPPERS, F.col("turn")))
    return conv.select("conv_id", "turn", trim_ws(wrapped).alias("trimmed"))


def upper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", upper_full(F.col("text")).alias("upper_text"))


def remove_accents_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", remove_accents(F.col("text")).alias("plain_text"))


def remove_accents_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same as ``remove_accents`` through the exact (Arrow UDF) mode."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", remove_accents(F.col("text"), "exact").alias("plain_text"))


def clean_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    cleaned = remove_accents(upper_full(trim_ws(F.col("text"))))
    return conv.select("conv_id", "turn", cleaned.alias("cleaned"))


# -- casts ----------------------------------------------------------------------

def ts_to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    body = F.when(eid % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    text = F.concat(body, _pick(TS_OFFSETS, eid))
    utc = parse_timestamp(text)
    return ev.select("event_id", text.alias("ts_text"), utc.alias("ts_utc"), iso_text(utc).alias("ts_iso"))


def rename_default_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename + cast + stamped constants, before any cleaning rule."""
    from pactline.contract import shipped_contract

    contract = shipped_contract()
    values = map_values(contract)
    parsed = _landing_good(spark, sf_dir)
    pick = ["consumidor_nombre", "consumidor_apellido", "interaccion_resultado", "interaccion_turnos",
            "interaccion_fecha_inicio", "cliente_prefijo", "caso_uso_id", "canal"]
    return parsed.select("source_path", *[values[n].as_type(contract.types[n]).alias(n) for n in pick])


def json_serialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``json`` column: nested value kept as compact JSON text, key order kept."""
    from pactline.contract import shipped_contract

    mapped = stages.mapped(_landing_good(spark, sf_dir), shipped_contract())
    return mapped.select("source_path", "mensajes")


# -- tolerant parsing -------------------------------------------------------------

def _event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid, props = F.col("event_id"), F.col("props")
    text = (F.when(eid % 10 == 0, F.expr("substr(props, 1, length(props) - 1)"))
            .when(eid % 10 == 3, F.concat(props, props))
            .when(eid % 10 == 7, F.concat(F.lit("["), props, F.lit("]")))
            .when(eid % 20 == 9, F.lit("null"))
            .when(eid % 20 == 19, F.lit("5"))
            .otherwise(props))
    return ev.select("event_id", F.concat(F.lit("events/"), eid.cast("string")).alias("source_path"), text.alias("text"))


def tolerant_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_documents(_event_documents(spark, sf_dir), ["k"], keep=("event_id",))
    return parsed.select("event_id", "status", F.col("rec.k").alias("k"))


def skipped_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_documents(_event_documents(spark, sf_dir), ["k"])
    return stages.quarantine(parsed).groupBy("reason").agg(F.count(F.lit(1)).alias("files"))


# -- dedup ------------------------------------------------------------------------

MULTI_ORDER = {"enabled": True, "record_key": ["o_custkey"],
               "order_by": ["o_orderpriority", "o_orderdate"], "order_type": ["asc", "desc"]}


def dedup_multi_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    src = o.select(
        "o_orderkey", "o_custkey",
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_orderdate")).alias("o_orderdate"),
    )
    return keep_best(src, MULTI_ORDER, tie_breakers=("o_orderkey",))


# -- audit columns ----------------------------------------------------------------

def _orders_business(o: DataFrame) -> tuple[DataFrame, dict[str, Val]]:
    k = F.col("o_orderkey")
    frame = o.select(
        F.concat(F.lit("orders/"), k.cast("string"), F.lit(".json")).alias("source_path"),
        "o_orderkey", "o_custkey",
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    business = {
        "o_orderkey": Val.col(F.col("o_orderkey"), "integer"),
        "o_custkey": Val.col(F.col("o_custkey"), "integer"),
        "o_orderstatus": Val.col(F.col("o_orderstatus"), "string"),
        "o_orderdate": Val.col(F.col("o_orderdate"), "timestamp"),
        "o_orderpriority": Val.col(F.col("o_orderpriority"), "string"),
    }
    return frame, business


HASH_SPECS = {
    "row_hash": {"calculus_type": "concatetation", "delimiter": "#",
                 "columns": ["o_orderkey", "o_orderstatus", "o_orderdate", "missing_field"]},
}


def hash_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, business = _orders_business(table(spark, sf_dir, "orders"))
    audit = resolve_audit(None, business, CTX, specs=HASH_SPECS)
    return frame.select("o_orderkey", audit["row_hash"].as_type("string").alias("row_hash"))


CHAIN_RAW = {"client_prefix": "CLX", "section": {"name": "transcripciones"}}
CHAIN_SPECS = {
    "tenant_id": {"calculus_type": "field_mapping", "columns": ["client_prefix"]},
    "chain_hash": {"calculus_type": "concatetation", "delimiter": "|",
                   "columns": ["row_key", "interaccion_fecha_fin", "interaccion_turnos"]},
    "row_key": {"calculus_type": "concatetation", "delimiter": "#",
                "columns": ["tenant_id", "interaccion_id", "section[name]"]},
}


def _landing_business(deduped: DataFrame) -> dict[str, Val]:
    from pactline.contract import shipped_contract
    from pactline.operators.mapping import values_of

    return values_of(deduped.columns, shipped_contract())


def hash_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward reference, precedence of a computed audit name over a business one, bracket refs."""
    d = _landing_deduped(spark, sf_dir)
    audit = resolve_audit(None, _landing_business(d), CTX, specs=CHAIN_SPECS, raw=CHAIN_RAW)
    return d.select("source_path", *[audit[n].as_type("string").alias(n) for n in ("tenant_id", "row_key", "chain_hash")])


MAPPING_RAW = {"output_core": {"output_name_file": "transcripciones"}, "channel_id": "VOZ"}
MAPPING_SPECS = {
    "fm_result": {"calculus_type": "field_mapping", "columns": ["No apply", "interaccion_resultado", "consumidor_nombre"]},
    "fm_bracket": {"calculus_type": "field_mapping", "columns": ["output_core[output_name_file]", "channel_id"]},
    "fm_missing": {"calculus_type": "field_mapping", "columns": ["No apply", "not_a_field"]},
    "fm_time": {"calculus_type": "field_mapping", "columns": ["interaccion_fecha_fin", "landing_time"]},
    "landing_time": {"calculus_type": "file_landing_date"},
    "fm_turns": {"calculus_type": "field_mapping", "columns": ["interaccion_turnos"]},
}


def field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _landing_deduped(spark, sf_dir)
    audit = resolve_audit(None, _landing_business(d), CTX, specs=MAPPING_SPECS, raw=MAPPING_RAW)
    names = ["fm_result", "fm_bracket", "fm_missing", "fm_time", "fm_turns"]
    return d.select("source_path", *[audit[n].as_type("string").alias(n) for n in names])


def surrogate_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _landing_deduped(spark, sf_dir)
    specs = {"registro_id": {"calculus_type": "uniqe"}, "ejecucion_id": {"calculus_type": "execution_id"}}
    audit = resolve_audit(None, {}, CTX, specs=specs)
    return d.select("source_path", audit["registro_id"].as_type("string").alias("registro_id"),
                    audit["ejecucion_id"].as_type("string").alias("ejecucion_id"))


def file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    specs = {"base_nombre": {"calculus_type": "file_name"}}
    audit = resolve_audit(None, {}, CTX, source_path=F.col("url"), specs=specs)
    return pages.select("page_id", basename(F.col("url")).alias("url_base"),
                        audit["base_nombre"].as_type("string").alias("base_nombre"))


def landing_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pactline.contract import shipped_contract

    contract = shipped_contract()
    d = _landing_deduped(spark, sf_dir)
    audit = resolve_audit(contract, _landing_business(d), CTX)
    types = contract.audit_types
    names = ["cargue_fecha", "cargue_fecha_id", "archivo_fecha", "archivo_fecha_id"]
    return d.select("source_path", *[audit[n].as_type(types[n]).alias(n) for n in names])


# -- EAV --------------------------------------------------------------------------

ORDERS_CONTRACT = {
    "client_prefix": "TPC", "operation_prefix": "ORD",
    "source": {"bucket_name": "orders", "prefix_pattern": "orders"},
    "columns": [
        {"position": 1, "name": "o_orderkey", "source_column": "o_orderkey", "type": "integer"},
        {"position": 2, "name": "o_custkey", "source_column": "o_custkey", "type": "integer"},
        {"position": 3, "name": "o_orderstatus", "source_column": "o_orderstatus", "type": "string"},
        {"position": 4, "name": "o_orderdate", "source_column": "o_orderdate", "type": "timestamp"},
        {"position": 5, "name": "o_orderpriority", "source_column": "o_orderpriority", "type": "string"},
    ],
    "output_core": {"bucket_name": "out", "prefix_pattern": "core", "output_name_file": "orders",
                    "technical_col_keep": ["registro_id"]},
    "output_atts": {"bucket_name": "out", "prefix_pattern": "atts", "output_name_file": "orders",
                    "technical_col_keep": ["ejecucion_id", "registro_id", "base_id", "atributo_nombre",
                                           "atributo_tipo", "atributo_posicion", "atributo_valor"]},
    "technical_columns": {
        "ejecucion_id": {"calculus_type": "execution_id"},
        "registro_id": {"calculus_type": "uniqe"},
        "base_id": {"calculus_type": "concatetation", "delimiter": "#", "columns": ["client_prefix", "operation_prefix"]},
    },
}


def eav_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = _orders_business(table(spark, sf_dir, "orders"))
    return atts_frame(frame, load_contract(ORDERS_CONTRACT), CTX)


QUERIES = {
    "rename_default_cast": rename_default_cast,
    "ts_to_utc": ts_to_utc,
    "trim_unicode": trim_unicode,
    "upper_full": upper_text,
    "remove_accents": remove_accents_docs,
    "remove_accents_exact": remove_accents_exact,
    "clean_in_order": clean_in_order,
    "json_serialize": json_serialize,
    "tolerant_json": tolerant_json,
    "skipped_report": skipped_report,
    "dedup_multi_order": dedup_multi_order,
    "hash_concat": hash_concat,
    "hash_chain": hash_chain,
    "field_mapping": field_mapping,
    "surrogate_unique": surrogate_unique,
    "file_name": file_name,
    "landing_date": landing_date,
    "eav_unpivot": eav_unpivot,
}
