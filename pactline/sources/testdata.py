"""Landing documents derived from the given test tables.

The test tables are Parquet, not landed JSON. ``landing_records`` derives
one landing record per conversation from ``conversations`` (duplicates of
the dedup key, exact ties, null and empty values are produced by rule),
and ``landing_documents`` renders each record as the JSON document a
source system would have dropped, so the real parser runs on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.sources.listing import write_files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, "0")


def landing_records(spark: SparkSession, sf_dir: str, with_messages: bool = True) -> DataFrame:
    """One record per conversation (grouped by ``conv_id``).

    Rules (on ``conv_id``): ``% 4 = 1`` repeats the previous record's
    trace id; ``% 8 = 5`` also repeats its export time (an exact tie);
    ``% 11 = 0`` has no export time; ``% 5 = 0`` has an empty name, the
    others have outer blanks and an accent.
    """
    conv = table(spark, sf_dir, "conversations")
    aggs = [F.count(F.lit(1)).alias("turns")]
    if with_messages:
        ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
        aggs.append(F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))
    g = conv.groupBy("conv_id").agg(*aggs)
    cid = F.col("conv_id")
    b = cid - F.when(cid % 8 == 5, 1).otherwise(0)
    h = F.md5(cid.cast("string"))
    cols = [
        cid,
        F.concat(F.lit("landing/conv_"), _pad(cid, 8), F.lit(".json")).alias("source_path"),
        F.concat(F.lit("tenant_"), (cid % 3).cast("string")).alias("tenant_id"),
        (F.lit(10000000) + cid * 7919).cast("string").alias("client_dni"),
        F.lit("CC").alias("client_dni_type"),
        F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                    F.substring(h, 17, 4), F.substring(h, 21, 12)).alias("cloud_conversation_id"),
        F.md5(F.concat(F.lit("t"), (cid - F.when(cid % 4 == 1, 1).otherwise(0)).cast("string"))).alias("trace_id"),
        F.when(cid % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("  Niño "), cid.cast("string"), F.lit(" "))).alias("client_name"),
        F.when(cid % 2 == 0, F.lit("Muñoz")).otherwise(F.lit("Pérez")).alias("client_last_name"),
        F.lit("Natural").alias("person_type"),
        F.when(cid % 3 == 0, F.lit(None).cast("string")).when(cid % 3 == 1, F.lit("")).otherwise(F.lit("resuelto")).alias("interaction_result"),
        F.concat(F.lit("2026-08-"), _pad(cid % 28 + 1, 2), F.lit("T"), _pad(cid % 24, 2), F.lit(":15:30-05:00")).alias("started_at"),
        F.when(cid % 11 != 0, F.concat(F.lit("2026-08-"), _pad(b % 28 + 1, 2), F.lit("T23:"), _pad(b % 60, 2), F.lit(":45-05:00"))).alias("exported_at"),
        F.col("turns"),
    ]
    if with_messages:
        cols.append(F.col("messages"))
    return g.select(*cols)


# Fixed value: the shared trace id of the skewed records.
HOT_TRACE_ID = "ffffffffffffffffffffffffffffffff"

DOCUMENT_FIELDS = (
    "tenant_id", "client_dni", "client_dni_type", "cloud_conversation_id", "trace_id", "interaction_result",
    "started_at", "exported_at", "turns", "messages", "person_type", "client_name", "client_last_name",
)


def landing_documents(spark: SparkSession, sf_dir: str, hot_key: Column | None = None) -> DataFrame:
    """``(source_path, text)``: each record as one JSON object document.

    ``interaction_result`` is left out of the document when null (an
    absent field), like a source that omits empty fields. Records matching
    ``hot_key`` all carry the same trace id (a skewed dedup key).
    """
    recs = landing_records(spark, sf_dir)
    if hot_key is not None:
        recs = recs.withColumn("trace_id", F.when(hot_key, F.lit(HOT_TRACE_ID)).otherwise(F.col("trace_id")))
    doc = F.to_json(F.struct(*[F.col(c) for c in DOCUMENT_FIELDS]))
    return recs.select("conv_id", "source_path", doc.alias("text"))


def landing_names(conv_id: Column, hidden: bool = False) -> Column:
    """File name of a conversation's document; with ``hidden``, some begin with ``_`` or ``.`` or lie in such folders."""
    name = F.concat(F.lit("conv_"), _pad(conv_id, 8), F.lit(".json"))
    if not hidden:
        return name
    prefix = F.when(conv_id % 9 == 2, F.lit("_")).when(conv_id % 9 == 4, F.lit(".")).when(conv_id % 9 == 6, F.lit("_late/")).when(
        conv_id % 9 == 8, F.lit(".old/batch/")).otherwise(F.lit(""))
    return F.concat(prefix, name)


def write_landing_files(spark: SparkSession, sf_dir: str, path: str, doubled: Column | None = None,
                        empty: Column | None = None, hidden: bool = False) -> str:
    """Land every record as its own JSON document file below ``path``, written by tasks; returns ``path``.

    Null fields are left out of the document. Records matching ``doubled`` hold two
    concatenated documents (a corrupt upload), those matching ``empty`` nothing.
    """
    text = F.to_json(F.struct(*[F.col(c) for c in DOCUMENT_FIELDS]))
    if doubled is not None:
        text = F.when(doubled, F.concat(text, F.lit("\n"), text)).otherwise(text)
    if empty is not None:
        text = F.when(empty, F.lit("")).otherwise(text)
    # a conversation's rows are grouped already: its file is written in that stage
    files = landing_records(spark, sf_dir).select(landing_names(F.col("conv_id"), hidden).alias("name"), text.alias("content"))
    write_files(files, path).write.format("noop").mode("overwrite").save()
    return path
