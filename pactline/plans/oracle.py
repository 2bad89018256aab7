"""DuckDB SQL equivalents of the registered queries (independent check).

Written by hand against the same Parquet views, with the same fixed run
constants, so that each Spark query has an oracle of its own.
"""

from __future__ import annotations

from pactline.functions.text import PY_WHITESPACE
from pactline.plans.queries import NOW, RUN_ID

S = "varchar"

WS = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"


def _clean(expr: str, upper: bool) -> str:
    """trim (Unicode whitespace) -> [upper, ß as SS] -> strip accents."""
    x = f"trim({expr}, {WS})"
    if upper:
        x = f"replace(upper({x}), 'ẞ', 'SS')"
    return f"strip_accents({x})"


def _utc(expr: str) -> str:
    return f"(cast({expr} AS timestamptz) AT TIME ZONE 'UTC')"


LANDING = f"""
SELECT conv_id,
       'landing/conv_' || lpad(cast(conv_id AS {S}), 8, '0') || '.json' AS source_path,
       'tenant_' || cast(conv_id % 3 AS {S}) AS tenant_id,
       cast(10000000 + conv_id * 7919 AS {S}) AS client_dni,
       'CC' AS client_dni_type,
       substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12) AS cloud_conversation_id,
       md5('t' || cast(conv_id - CASE WHEN conv_id % 4 = 1 THEN 1 ELSE 0 END AS {S})) AS trace_id,
       CASE WHEN conv_id % 5 = 0 THEN '' ELSE '  Niño ' || cast(conv_id AS {S}) || ' ' END AS client_name,
       CASE WHEN conv_id % 2 = 0 THEN 'Muñoz' ELSE 'Pérez' END AS client_last_name,
       'Natural' AS person_type,
       CASE WHEN conv_id % 3 = 0 THEN NULL WHEN conv_id % 3 = 1 THEN '' ELSE 'resuelto' END AS interaction_result,
       '2026-08-' || lpad(cast(conv_id % 28 + 1 AS {S}),2,'0') || 'T' || lpad(cast(conv_id % 24 AS {S}),2,'0') || ':15:30-05:00' AS started_at,
       CASE WHEN conv_id % 11 <> 0 THEN
       '2026-08-' || lpad(cast(b % 28 + 1 AS {S}),2,'0') || 'T23:' || lpad(cast(b % 60 AS {S}),2,'0') || ':45-05:00' END AS exported_at,
       turns, messages
FROM (SELECT conv_id, conv_id - CASE WHEN conv_id % 8 = 5 THEN 1 ELSE 0 END AS b,
             md5(cast(conv_id AS {S})) AS h, count(*) AS turns,
             cast(to_json(list(struct_pack(role := role, content := text) ORDER BY turn)) AS {S}) AS messages
      FROM conversations GROUP BY conv_id) g
"""

MAPPED = f"""
SELECT source_path,
       {_clean('client_dni_type', True)} AS consumidor_tipo_id,
       {_clean('client_dni', False)} AS consumidor_id,
       {_clean('client_name', True)} AS consumidor_nombre,
       {_clean('client_last_name', True)} AS consumidor_apellido,
       {_clean('person_type', False)} AS consumidor_tipo_persona,
       {_clean('cloud_conversation_id', False)} AS conversacion_id,
       {_clean('trace_id', False)} AS interaccion_id,
       {_utc('started_at')} AS interaccion_fecha_inicio,
       {_utc('exported_at')} AS interaccion_fecha_fin,
       cast(turns AS bigint) AS interaccion_turnos,
       {_clean('interaction_result', False)} AS interaccion_resultado,
       {_clean('tenant_id', False)} AS tenant_id,
       messages AS mensajes,
       'CLX' AS cliente_prefijo, 'SAC' AS operacion_prefijo, 'temporal_id' AS caso_uso_id,
       'VOICEBOT' AS canal, 'NUBE_CONTACTO' AS origen
FROM landing
"""

DEDUPED = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY interaccion_id
                               ORDER BY interaccion_fecha_fin DESC NULLS FIRST, source_path ASC) AS rn
  FROM mapped) WHERE rn = 1
"""

_NOW_DATE = NOW.strftime("%Y-%m-%d")
_NOW_TS = NOW.strftime("%Y-%m-%d %H:%M:%S")

AUDITED = f"""
SELECT d.*,
       '{RUN_ID}' AS a_ejecucion_id,
       sha256(concat_ws(chr(31), '{RUN_ID}', 'registro_id', source_path)) AS a_registro_id,
       sha256('CLX' || '#' || 'SAC' || '#' || 'Servicio al Cliente' || '#' || 'Asistente') AS a_base_id,
       '{_NOW_DATE}' AS a_cargue_fecha_id,
       sha256(sha256('CLX#SAC#Servicio al Cliente#Asistente') || '#' || '{_NOW_DATE}') AS a_cargue_id,
       sha256(sha256(sha256('CLX#SAC#Servicio al Cliente#Asistente') || '#' || '{_NOW_DATE}') || '#' ||
              sha256(concat_ws(chr(31), '{RUN_ID}', 'registro_id', source_path))) AS a_registro_hash,
       string_split(source_path, '/')[-1] AS a_base_nombre
FROM deduped d
"""

WITH = f"WITH landing AS ({LANDING}), mapped AS ({MAPPED}), deduped AS ({DEDUPED}), audited AS ({AUDITED})"

CONTRACT_CORE = WITH + f"""
SELECT consumidor_tipo_id, consumidor_id, consumidor_nombre, consumidor_apellido, consumidor_tipo_persona,
       conversacion_id, interaccion_id, interaccion_fecha_inicio, interaccion_fecha_fin, interaccion_turnos,
       interaccion_resultado, tenant_id, mensajes, 'CLX' AS cliente_prefijo, 'SAC' AS operacion_prefijo,
       caso_uso_id, canal, origen,
       'VOZ' AS canal_id, cast(NULL AS {S}) AS gestion_tipo, 'Proveedor-Voz' AS canal_proveedor,
       cast(NULL AS {S}) AS gestion_canal, cast(NULL AS {S}) AS base_fecha_id,
       a_ejecucion_id AS ejecucion_id, a_registro_id AS registro_id, a_registro_hash AS registro_hash,
       'Servicio al Cliente' AS operacion_segmento, 'Asistente' AS operacion_proceso,
       cast(NULL AS {S}) AS base_grupo, cast(NULL AS {S}) AS base_proceso, a_base_nombre AS base_nombre,
       a_base_id AS base_id, a_cargue_id AS cargue_id, TIMESTAMP '{_NOW_TS}' AS cargue_fecha,
       a_cargue_fecha_id AS cargue_fecha_id, 'transcripciones' AS parquet_nombre
FROM audited
"""


def _iso(expr: str) -> str:
    """UTC wall clock -> ISO text with +00:00 (fraction only when non-zero)."""
    return (f"CASE WHEN {expr} IS NULL THEN NULL WHEN microsecond({expr}) % 1000000 = 0 "
            f"THEN strftime({expr}, '%Y-%m-%dT%H:%M:%S+00:00') "
            f"ELSE strftime({expr}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END")


_ATTS_VALUES = [
    ("consumidor_tipo_id", "string", 1, "consumidor_tipo_id"),
    ("consumidor_id", "string", 2, "consumidor_id"),
    ("consumidor_nombre", "string", 3, "consumidor_nombre"),
    ("consumidor_apellido", "string", 4, "consumidor_apellido"),
    ("consumidor_tipo_persona", "string", 5, "consumidor_tipo_persona"),
    ("conversacion_id", "string", 6, "conversacion_id"),
    ("interaccion_id", "string", 7, "interaccion_id"),
    ("interaccion_fecha_inicio", "timestamp", 8, _iso("interaccion_fecha_inicio")),
    ("interaccion_fecha_fin", "timestamp", 9, _iso("interaccion_fecha_fin")),
    ("interaccion_turnos", "integer", 10, f"cast(interaccion_turnos AS {S})"),
    ("interaccion_resultado", "string", 11, "interaccion_resultado"),
    ("tenant_id", "string", 12, "tenant_id"),
    ("mensajes", "json", 13, "mensajes"),
    ("cliente_prefijo", "string", 14, "cliente_prefijo"),
    ("operacion_prefijo", "string", 15, "operacion_prefijo"),
    ("caso_uso_id", "string", 16, "caso_uso_id"),
    ("canal", "string", 17, "canal"),
    ("origen", "string", 18, "origen"),
]

CONTRACT_ATTS = WITH + " " + " UNION ALL ".join(
    f"""SELECT a_ejecucion_id AS ejecucion_id, a_registro_id AS registro_id, a_registro_hash AS registro_hash,
       a_base_id AS base_id, a_cargue_id AS cargue_id, 'CLX' AS cliente_prefijo, 'SAC' AS operacion_prefijo,
       'Servicio al Cliente' AS operacion_segmento, '{_NOW_DATE}' AS archivo_fecha_id,
       'transcripciones' AS parquet_nombre, '{name}' AS atributo_nombre, '{ctype}' AS atributo_tipo,
       cast({pos} AS bigint) AS atributo_posicion, cast({expr} AS {S}) AS atributo_valor
FROM audited"""
    for name, ctype, pos, expr in _ATTS_VALUES
)

DEDUP_LATEST = WITH + """
SELECT source_path, interaccion_id, interaccion_fecha_fin, consumidor_nombre, interaccion_resultado FROM deduped
"""

DISTINCT_IDS = WITH + """
SELECT DISTINCT conversacion_id AS conversation_id FROM mapped
WHERE conversacion_id IS NOT NULL AND conversacion_id <> ''
"""

REQUEST_FANOUT = WITH + """
SELECT conversation_id, 'conversations_surveys' AS endpoint,
       replace('/api/v2/quality/conversations/{conversationId}/surveys', '{conversationId}', conversation_id) AS url,
       'GET' AS method, 'unitary' AS type, 'conversations_surveys' AS path, 'state' AS result_data
FROM (SELECT DISTINCT conversacion_id AS conversation_id FROM mapped
      WHERE conversacion_id IS NOT NULL AND conversacion_id <> '') ids
"""

ORACLE = {
    "contract_core": CONTRACT_CORE,
    "contract_atts": CONTRACT_ATTS,
    "dedup_latest": DEDUP_LATEST,
    "distinct_ids": DISTINCT_IDS,
    "request_fanout": REQUEST_FANOUT,
}


# -- per-operator oracles ---------------------------------------------------------

def _pick_sql(values: list[str], idx: str) -> str:
    arr = "[" + ", ".join("(" + (" || ".join(f"chr({ord(c)})" for c in v) or "''") + ")" for v in values) + "]"
    return f"{arr}[({idx}) % {len(values)} + 1]"


def _ops_oracles() -> dict[str, str]:
    from pactline.plans.operator_queries import TRIM_WRAPPERS, TS_OFFSETS

    ts_text = (f"CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') "
               f"ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END || {_pick_sql(TS_OFFSETS, 'event_id')}")
    event_doc = """CASE WHEN event_id % 10 = 0 THEN substr(props, 1, length(props) - 1)
                        WHEN event_id % 10 = 3 THEN props || props
                        WHEN event_id % 10 = 7 THEN '[' || props || ']'
                        WHEN event_id % 20 = 9 THEN 'null'
                        WHEN event_id % 20 = 19 THEN '5'
                        ELSE props END"""
    status = """CASE WHEN NOT json_valid(t) THEN 'invalid_json'
                     WHEN json_type(t) <> 'OBJECT' THEN 'not_object' ELSE 'ok' END"""
    orders_b = f"""SELECT 'orders/' || cast(o_orderkey AS {S}) || '.json' AS source_path, o_orderkey, o_custkey,
                          CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
                          o_orderdate,
                          CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
                   FROM orders"""
    eav = [("o_orderkey", "integer", 1, f"cast(o_orderkey AS {S})"),
           ("o_custkey", "integer", 2, f"cast(o_custkey AS {S})"),
           ("o_orderstatus", "string", 3, "o_orderstatus"),
           ("o_orderdate", "timestamp", 4, _iso("o_orderdate")),
           ("o_orderpriority", "string", 5, "o_orderpriority")]
    row_key = "sha256('CLX' || '#' || interaccion_id || '#' || 'transcripciones')"
    return {
        "rename_default_cast": f"""WITH landing AS ({LANDING})
            SELECT source_path, client_name AS consumidor_nombre, client_last_name AS consumidor_apellido,
                   interaction_result AS interaccion_resultado, cast(turns AS bigint) AS interaccion_turnos,
                   {_utc('started_at')} AS interaccion_fecha_inicio, 'CLX' AS cliente_prefijo,
                   'temporal_id' AS caso_uso_id, 'VOICEBOT' AS canal FROM landing""",
        "ts_to_utc": f"""SELECT event_id, ts_text, ts_utc, {_iso('ts_utc')} AS ts_iso FROM (
            SELECT event_id, ts_text,
                   CASE WHEN ts_text LIKE '%Z' OR ts_text LIKE '%+__:__' OR ts_text LIKE '%-__:__'
                        THEN {_utc('ts_text')} ELSE cast(ts_text AS timestamp) END AS ts_utc
            FROM (SELECT event_id, {ts_text} AS ts_text FROM events))""",
        "trim_unicode": f"""SELECT conv_id, turn,
                   trim({_pick_sql(TRIM_WRAPPERS, 'conv_id + turn')} || text || {_pick_sql(TRIM_WRAPPERS, 'turn')}, {WS}) AS trimmed
            FROM conversations""",
        "upper_full": "SELECT conv_id, turn, replace(upper(text), 'ẞ', 'SS') AS upper_text FROM conversations",
        "remove_accents": "SELECT doc_id, strip_accents(text) AS plain_text FROM documents",
        "remove_accents_exact": "SELECT doc_id, strip_accents(text) AS plain_text FROM documents",
        "clean_in_order": f"SELECT conv_id, turn, {_clean('text', True)} AS cleaned FROM conversations",
        "json_serialize": f"WITH landing AS ({LANDING}) SELECT source_path, messages AS mensajes FROM landing",
        "tolerant_json": f"""SELECT event_id, {status} AS status,
                   CASE WHEN {status} = 'ok' THEN json_extract(t, '$.k')::varchar END AS k
            FROM (SELECT event_id, {event_doc} AS t FROM events)""",
        "skipped_report": f"""SELECT reason, count(*) AS files FROM (
                SELECT {status} AS reason FROM (SELECT {event_doc} AS t FROM events)) WHERE reason <> 'ok'
            GROUP BY reason""",
        "dedup_multi_order": """SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate FROM (
              SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority ASC NULLS LAST,
                                           o_orderdate DESC NULLS FIRST, o_orderkey ASC) AS rn
              FROM (SELECT o_orderkey, o_custkey,
                           CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
                           CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate
                    FROM orders)) WHERE rn = 1""",
        "hash_concat": f"""SELECT o_orderkey, sha256(concat_ws('#', cast(o_orderkey AS {S}), coalesce(o_orderstatus, ''),
                   coalesce({_iso('o_orderdate')}, ''), '')) AS row_hash FROM ({orders_b})""",
        "hash_chain": WITH + f"""
            SELECT source_path, 'CLX' AS tenant_id, {row_key} AS row_key,
                   sha256(concat_ws('|', {row_key}, coalesce({_iso('interaccion_fecha_fin')}, ''),
                                    cast(interaccion_turnos AS {S}))) AS chain_hash
            FROM deduped""",
        "field_mapping": WITH + f"""
            SELECT source_path, coalesce(interaccion_resultado, consumidor_nombre) AS fm_result,
                   'transcripciones' AS fm_bracket, cast(NULL AS {S}) AS fm_missing,
                   coalesce({_iso('interaccion_fecha_fin')}, '{NOW.isoformat()}') AS fm_time,
                   cast(interaccion_turnos AS {S}) AS fm_turns
            FROM deduped""",
        "surrogate_unique": WITH + f"""
            SELECT source_path, sha256(concat_ws(chr(31), '{RUN_ID}', 'registro_id', source_path)) AS registro_id,
                   '{RUN_ID}' AS ejecucion_id FROM deduped""",
        "file_name": """SELECT page_id, string_split(url, '/')[-1] AS url_base,
                               string_split(url, '/')[-1] AS base_nombre FROM pages""",
        "landing_date": WITH + f"""
            SELECT source_path, TIMESTAMP '{_NOW_TS}' AS cargue_fecha, '{_NOW_DATE}' AS cargue_fecha_id,
                   TIMESTAMP '{_NOW_TS}' AS archivo_fecha, '{_NOW_DATE}' AS archivo_fecha_id FROM deduped""",
        "eav_unpivot": " UNION ALL ".join(
            f"""SELECT '{RUN_ID}' AS ejecucion_id,
                       sha256(concat_ws(chr(31), '{RUN_ID}', 'registro_id', source_path)) AS registro_id,
                       sha256('TPC#ORD') AS base_id, '{n}' AS atributo_nombre, '{t}' AS atributo_tipo,
                       cast({p} AS bigint) AS atributo_posicion, cast({e} AS {S}) AS atributo_valor
                FROM ({orders_b})""" for n, t, p, e in eav),
    }


ORACLE.update(_ops_oracles())


def _io_oracles() -> dict[str, str]:
    from pactline.plans.io_queries import BAD_CAST_RULE, BAD_TIME_RULE, DOUBLED_RULE, EMPTY_RULE

    date = f"'{NOW:%Y}' AS year, '{NOW:%m}' AS month, '{NOW:%d}' AS day"
    hidden = f"""CASE conv_id % 9 WHEN 2 THEN '_' WHEN 4 THEN '.' WHEN 6 THEN '_late/' WHEN 8 THEN '.old/batch/' ELSE '' END
                 || 'conv_' || lpad(cast(conv_id AS {S}), 8, '0') || '.json'"""
    hidden_landing = f"SELECT * REPLACE ({hidden} AS source_path) FROM ({LANDING}) WHERE NOT ({EMPTY_RULE})"
    return {
        "partition_roundtrip": f"""SELECT o_orderkey, o_totalprice, o_orderdate, o_orderpriority,
                   CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
                   {date} FROM orders""",
        "declared_types": f"SELECT *, {date} FROM ({CONTRACT_CORE})",
        "atts_roundtrip": f"SELECT *, {date} FROM ({CONTRACT_ATTS})",
        "incremental_ingest": f"""SELECT * REPLACE ('{RUN_ID}-0' AS ejecucion_id, true AS registro_id, true AS registro_hash), {date}
            FROM ({CONTRACT_CORE})""",
        "landing_any_name": f"""SELECT {hidden} AS name, CASE WHEN {EMPTY_RULE} THEN 'empty' ELSE 'ok' END AS status,
                   CASE WHEN {EMPTY_RULE} THEN NULL ELSE trace_id END AS trace_id FROM ({LANDING})""",
        "incremental_any_name": f"""WITH landing AS ({hidden_landing}), mapped AS ({MAPPED}), deduped AS ({DEDUPED})
            SELECT string_split(source_path, '/')[-1] AS name, 'core' AS went FROM deduped UNION ALL
            SELECT string_split({hidden}, '/')[-1], 'empty' FROM ({LANDING}) WHERE {EMPTY_RULE}""",
        "cast_quarantine": f"""WITH landing AS ({LANDING})
            SELECT source_path, 'interaccion_turnos' AS "column", 'about ' || turns AS text, 'not_integer' AS reason
            FROM landing WHERE {BAD_CAST_RULE} UNION ALL
            SELECT source_path, 'interaccion_fecha_fin', '31/08/2026', 'not_timestamp' FROM landing WHERE {BAD_TIME_RULE} UNION ALL
            SELECT source_path, NULL, cast(turns AS {S}), NULL FROM landing WHERE NOT ({BAD_CAST_RULE}) AND NOT ({BAD_TIME_RULE})""",
        "written_manifest": f"""SELECT o_orderstatus, o_orderpriority, year, cast(count(*) AS bigint) AS rows, true AS has_bytes,
                   cast(count(*) OVER () AS bigint) AS partitions
            FROM (SELECT o_orderpriority, '{NOW:%Y}' AS year,
                   CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders)
            GROUP BY ALL""",
        "landing_quarantine": f"""WITH landing AS ({LANDING})
            SELECT 'conv_' || lpad(cast(conv_id AS {S}), 8, '0') AS doc,
                   CASE WHEN {DOUBLED_RULE} THEN 'invalid_json' ELSE 'ok' END AS status,
                   CASE WHEN {DOUBLED_RULE} THEN NULL ELSE trace_id END AS trace_id
            FROM landing""",
        "run_manifest": WITH + """
            SELECT (SELECT count(*) FROM landing) AS processed_files, cast(0 AS bigint) AS skipped_files,
                   (SELECT count(*) FROM deduped) AS core_rows, (SELECT 18 * count(*) FROM deduped) AS atts_rows,
                   (SELECT count(DISTINCT conversacion_id) FROM mapped
                     WHERE conversacion_id IS NOT NULL AND conversacion_id <> '') AS conversation_ids,
                   (SELECT count(*) FROM landing) AS deleted_source_files, cast(0 AS bigint) AS failed_deletes,
                   cast(1 AS bigint) AS output_core_partitions, cast(1 AS bigint) AS output_atts_partitions,
                   (SELECT count(*) FROM deduped) AS core_rows_in_files, (SELECT 18 * count(*) FROM deduped) AS atts_rows_in_files,
                   cast(0 AS bigint) AS left_in_landing""",
    }


ORACLE.update(_io_oracles())


def _skew_oracles() -> dict[str, str]:
    from pactline.plans.queries import HOT_RULE
    from pactline.sources.testdata import HOT_TRACE_ID

    hot_landing = f"SELECT * REPLACE (CASE WHEN {HOT_RULE} THEN '{HOT_TRACE_ID}' ELSE trace_id END AS trace_id) FROM ({LANDING})"
    return {
        "dedup_hot_key": f"""WITH landing AS ({hot_landing}), mapped AS ({MAPPED}), deduped AS ({DEDUPED})
            SELECT source_path, interaccion_id, interaccion_fecha_fin, consumidor_nombre FROM deduped""",
    }


ORACLE.update(_skew_oracles())
