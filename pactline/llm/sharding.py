"""Sharding by histogram sort.

Rows are ordered by (text hash, doc_id), so equal texts lie side by side. Each
round counts the exact bytes of every probe interval over all partitions,
keeps the interval that holds each target (total * i / shards) and refines it,
until the splitter meets the tolerance; then rows are exchanged once.

Defined results: null text weighs nothing and groups with empty text; null
doc_ids come last within a group; a group of equal texts above
``group_tolerance`` of a shard is split by doc_id; rows equal in text and
doc_id stay in one shard. Very long texts count with all their bytes. An empty table
gives an empty result. Own columns ``size``, ``shard`` and ``slot`` give way to the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.llm.common import drop_stage, stage, text_of

PROBES = 1024
TOLERANCE = 0.01
GROUP_TOLERANCE = 0.05
KEY_SPACE = 1 << 62
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def with_keys(docs: DataFrame) -> DataFrame:
    """Adds the sort key (``_key``, ``_doc``) and ``size``."""
    text = text_of(docs)
    return docs.withColumns({
        "size": (F.octet_length(text) + 8).cast("long"),
        "_key": F.shiftrightunsigned(F.xxhash64(text), 2),
        "_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(HIGHEST)),
    })


def _count(rows: DataFrame, column: str, spans: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
    """Per span ``[low, high)``: (least, greatest, exact bytes) of each probe interval that has rows, ascending.

    At most PROBES rows a span reach the driver.
    """
    wide = any(high - low > HIGHEST for low, high in spans)
    value = F.col(column).cast("decimal(20,0)") if wide else F.col(column)
    number = (lambda v: F.lit(v).cast("decimal(20,0)")) if wide else F.lit
    which, from_, width = F.lit(None).cast("int"), F.lit(None), F.lit(None)
    for i, (low, high) in reversed(list(enumerate(spans))):
        inside = (F.col(column) >= low) & (F.col(column) <= high - 1)
        which = F.when(inside, F.lit(i)).otherwise(which)
        from_ = F.when(inside, number(low)).otherwise(from_)
        width = F.when(inside, number(-(-(high - low) // PROBES))).otherwise(width)
    placed = rows.select(column, "size", which.alias("w"), from_.alias("f"), width.alias("x"), value.alias("v")).where("w is not null")
    probed = placed.groupBy("w", F.expr("(v - f) div x").alias("p")).agg(
        F.min(column).alias("least"), F.max(column).alias("most"), F.sum("size").alias("bytes"))
    out: list[list[tuple[int, int, int]]] = [[] for _ in spans]
    for r in probed.collect():
        out[r["w"]].append((r["least"], r["most"], r["bytes"]))
    return [sorted(x) for x in out]


def _refine(rows: DataFrame, column: str, low: int, high: int, before: int, targets: list[int],
            tolerance: float, group_tolerance: float | None = None) -> tuple[dict[int, int], dict[int, int]]:
    """Splitters in one key column: ``{target: value}``, and ``{target: value}`` of values too heavy to stay whole."""
    open_ = {t: (low, high, before) for t in targets}
    done: dict[int, int] = {}
    heavy: dict[int, int] = {}
    while open_:
        spans = sorted({(a, b) for a, b, _ in open_.values()})
        counts = dict(zip(spans, _count(rows, column, spans), strict=True))
        for t, (a, b, ahead) in list(open_.items()):
            at = ahead
            for least, most, weight in counts[a, b]:
                if at + weight >= t:
                    break
                at += weight
            single = least == most
            if single and group_tolerance is not None and weight > group_tolerance:
                heavy[t] = least
            elif single or weight <= tolerance:
                done[t] = least if t - at <= at + weight - t else most + 1
            else:
                open_[t] = (least, most + 1, at)
                continue
            del open_[t]
    return done, heavy


def find_splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE, group_tolerance: float = GROUP_TOLERANCE) -> list[tuple[int, int]]:
    """``shards - 1`` ascending (key, doc) lower bounds."""
    total = keys.agg(F.sum("size")).first()[0]
    if not total:
        return [(KEY_SPACE, LOWEST)] * (shards - 1)
    share = total / shards
    targets = [round(total * i / shards) for i in range(1, shards)]
    done, heavy = _refine(keys, "_key", 0, KEY_SPACE, 0, targets, tolerance * share, group_tolerance * share)
    found = {t: (k, LOWEST) for t, k in done.items()}
    groups = sorted(set(heavy.values()))  # fewer than shards / group_tolerance
    if groups:
        ahead = [F.sum(F.when(F.col("_key") < k, F.col("size")).otherwise(0)).alias(f"b{i}") for i, k in enumerate(groups)]
        bytes_before = keys.agg(*ahead).first()
        ends = {r["_key"]: r for r in keys.where(F.col("_key").isin(groups)).groupBy("_key").agg(
            F.min("_doc").alias("least"), F.max("_doc").alias("most"), F.sum("size").alias("bytes")).collect()}
        for i, k in enumerate(groups):
            own, least, most = [t for t, v in heavy.items() if v == k], ends[k]["least"], ends[k]["most"]
            at = bytes_before[i]
            if least == most:  # one document
                found |= {t: (k, LOWEST) if t - at <= at + ends[k]["bytes"] - t else (k + 1, LOWEST) for t in own}
                continue
            inside, _ = _refine(keys.where(F.col("_key") == k), "_doc", least, most + 1, at, own, tolerance * share)
            found |= {t: (k, d) if d <= most else (k + 1, LOWEST) for t, d in inside.items()}
    return sorted(found[t] for t in targets)


def assign(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """Adds ``shard``: the number of splitters at or below the row's (key, doc)."""
    shard = F.lit(0)
    for k, d in splitters:
        shard = shard + ((F.col("_key") > k) | ((F.col("_key") == k) & (F.col("_doc") >= d))).cast("int")
    return rows.withColumn("shard", shard)


def with_slots(rows: DataFrame, parts: int) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard: ranks in ``parts`` equal parts of a shard, plus the parts before."""
    cut = rows.withColumn("_part", F.pmod(F.xxhash64("_key", "_doc"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_key", "_doc"))
    return cut.withColumn("_rank", rank - 1).join(offsets, ["shard", "_part"]).withColumn("slot", (F.col("_base") + F.col("_rank")).cast("long"))


def shard_rows(spark: SparkSession, docs: DataFrame, shards: int = 24, tolerance: float = TOLERANCE, group_tolerance: float = GROUP_TOLERANCE) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``; every other column is kept, whatever its name: a row travels as one struct."""
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("size", "shard", "slot")))
    keyed = with_keys(docs.select(own.alias("row"), "doc_id", "text"))
    small = stage(spark, keyed.select("_key", "_doc", "size"), "shard-keys")
    rows = small.count()
    splitters = find_splitters(small, shards, tolerance, group_tolerance)
    drop_stage(spark, small)
    slotted = with_slots(assign(keyed, splitters), max(64, -(-rows // (shards * 500_000))))
    return slotted.select("row.*", "size", "shard", "slot")


def op4_shards(spark: SparkSession, docs: DataFrame, shards: int = 24) -> DataFrame:
    """The contract's digest columns of :func:`shard_rows` under the law ``bytes``."""
    crc = F.crc32(text_of(docs).cast("binary"))
    narrow = docs.select("doc_id", "text", crc.alias("text_crc32"))
    return shard_rows(spark, narrow, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
