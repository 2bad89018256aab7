"""Mixing sources to target weights: repetition rates per source, then whole copies and one Bernoulli copy.

Words are counted once per document and aggregated per source before anything
is shuffled. The sources' targets follow from two running sums over the sources
table: weights go round by the sources' rank, and where a source's target would
exceed its cap the excess goes to the others by weight (water filling: in the
order of cap per unit of weight, the first source whose cap is not below the
level of what is left ends the capped ones; the level times the weight is the
target of all others). Both sums are taken in ranges of the sorted table, so the
number of sources may grow without one task holding them all. Each document
of a source with rate r = target / size is emitted floor(r) times, plus once more
if a number in [0, 1) drawn by hash from (seed, doc_id, text) is below the fraction.
DataFrame functions only. Documents meet their source's rate through a join
salted by that draw, so a source with a third of all rows is spread.

Defined results: null text has no words; a document without words is taken like
any other of its source, with 0 words; a source without words has target 0 and
is not taken; sources sort by code point, the null source last, the empty string is a source
of its own; rows equal in doc_id and text draw alike, rows without an id by their text; very
long texts are counted whole; an empty table gives no rows; every column of
``docs`` is kept whatever its name, since a row travels as one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.llm.common import drop_stage, stage

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
CAP = 2
SALTS = 32
SEED = "mix"


def words_in(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 52 bits of a hash: the same in every run and on every retry."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def running(spark: SparkSession, table: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``table`` with a column per sum: its total over all rows before, in a global order without ties.

    The table is dealt into ranges and written, each range is summed on its own,
    and the ranges' totals (as many rows as ranges) are added up.
    """
    ranges = stage(spark, table.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "mix-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("_range").agg(*(F.sum(c).alias(f"_{n}") for n, c in sums.items()))
    bases = totals.select("_range", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranges.join(F.broadcast(bases), "_range")  # one row per range
    out = stage(spark, joined.select(*table.columns, *((F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items())), "mix-sums")
    drop_stage(spark, ranges)
    return out


def source_targets(spark: SparkSession, sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """``sizes(source, size)`` to (source, source_size, weight, target, rate): one staged row per source."""
    if share_percent > 100 * cap:
        raise ValueError("the share must not exceed what the caps allow")
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = [F.col("source").isNull().asc(), F.col("source").asc()]
    numbered = running(spark, per_source, named, {"before": F.lit(1)})
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.pmod(F.col("before"), F.lit(len(weights))) + 1).cast("int"))
    ranked = stage(spark, numbered.select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")
    total = ranked.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    size, weighed = int(total["s"] or 0), int(total["w"] or 0)
    # ascending cap per unit of weight; exact numbers, so ties and levels are decided without rounding
    order = [(F.col("source_size") / F.col("weight")).asc(), *named]
    sums = running(spark, ranked, order, {"size_before": F.col("source_size"), "weight_before": F.col("weight")})
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    left = F.lit(share_percent * size).cast("decimal(38,0)") - F.lit(100 * cap).cast("decimal(38,0)") * wide("size_before")
    level_ends = left * wide("weight") <= F.lit(100 * cap).cast("decimal(38,0)") * wide("source_size") * (F.lit(weighed).cast("decimal(38,0)") - wide("weight_before"))
    first = sums.where(level_ends).agg(F.min(F.struct("weight_before", "size_before")).alias("at")).first()["at"]
    level = (share_percent * size - 100 * cap * int(first["size_before"])) / (100 * (weighed - int(first["weight_before"]))) if first else 0.0
    target = F.least(F.lit(level) * F.col("weight"), (cap * F.col("source_size")).cast("double"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    rates = stage(spark, ranked.select("source", "source_size", "weight", target.alias("target"), rate.alias("rate")), "mix-rates")
    for done in (numbered, ranked, sums):
        drop_stage(spark, done)
    return rates


def mix_documents(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """(row struct, size, source_size, target, copies): every document with the number of copies the mix takes."""
    text, source = F.col("text").cast("string"), F.col("source").cast("string")
    sized = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), source.alias("source"), words_in(text).alias("size"), draw(F.col("doc_id"), text, seed).alias("draw"))
    rates = source_targets(spark, sized.select("source", "size"), weights, share_percent, cap)
    salted = rates.select(F.col("source").alias("of"), "source_size", "target", "rate", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
    cut = sized.withColumn("salt", F.floor(F.col("draw") * SALTS).cast("int"))
    # a join salted by the draw; small rate tables are broadcast by their measured size
    joined = cut.join(salted, F.col("source").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("part")))
    whole = F.floor("rate")
    copies = (whole + F.when(F.col("draw") < F.col("rate") - whole, 1).otherwise(0)).cast("long")
    return joined.select("row", "size", "source_size", "target", copies.alias("copies"))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: the documents' own columns, each row as often as the mix takes it."""
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op11_mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    mixed = mix_documents(spark, docs.select("doc_id", "text", "source"))
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
  CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1, 13))::BIGINT AS DOUBLE) / {1 << 52}.0 AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)} {' '.join(f'WHEN {i} THEN {v}' for i, v in enumerate(WEIGHTS))} END AS weight FROM s),
r AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
  coalesce(sum(source_size) OVER o, 0) AS size_before, coalesce(sum(weight) OVER o, 0) AS weight_before
  FROM w WINDOW o AS (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT CAST({SHARE_PERCENT} * total - {100 * CAP} * size_before AS DOUBLE) / CAST(100 * (weights - weight_before) AS DOUBLE) AS level FROM r
  WHERE ({SHARE_PERCENT} * total - {100 * CAP} * size_before) * weight <= {100 * CAP} * source_size * (weights - weight_before) ORDER BY weight_before LIMIT 1),
t AS (SELECT source, source_size, least(level * weight, CAST({CAP} * source_size AS DOUBLE)) AS target FROM w, l),
m AS (SELECT d.doc_id, d.size, CAST(t.source_size AS BIGINT) AS source_size, t.target, d.draw,
  CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0 END AS rate FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM m
"""
