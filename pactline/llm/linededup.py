"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line is removed if an earlier line of the corpus, by (doc_id, line number),
lies within one edit of it (equal, or one code point replaced, inserted or
deleted). Earlier lines count even if they are removed themselves, so the
result does not depend on any order of work and a chain keeps its first line.

All variants of a line with one code point deleted are the keys:

* two lines of equal length that agree after deleting the same place differ in that place alone;
* a line that equals a variant of a longer line lies one insertion away.

Both rules need only the earliest member of each key, so groups are
aggregated, never expanded into pairs. A variant can only join where the rest
of the line is shared, so two exact filters run first: a line must share its
front or back half with another line, and a block of about sqrt(length) code points
must be the only place where two lines differ. Variants are hashed as
(hash of the text before and after the block, the block without the code point). Every link
is verified by edit distance on the whole lines.

Defined results: lines under ``MIN_CHARS`` code points are removed only if they
equal an earlier line (one edit turns short words into others); empty lines stay; null text stays null and has no
lines; an empty text has one empty line; null doc_ids come last; rows equal in doc_id and text are one document
and get the same result; rows with equal doc_ids follow by text hash; an empty table gives no rows;
columns of any name keep their values. A very long line is read whole, with one hash of what is
before and after each of its about sqrt(length) blocks, and only if half of it occurs elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm.common import drop_stage, stage

MIN_CHARS = 16
NO_ID = (1 << 63) - 1
BLOCK = 32  # least block length


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, text, _doc, _tid): a document travels as one struct, so no column of its own can clash with a key."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_doc"), F.xxhash64(F.col("text")).alias("_tid"))


def _lines(keyed: DataFrame, exact_from: int) -> DataFrame:
    """(at, line, h, n) of every line that is judged; ``at`` orders lines."""
    rows = keyed.where("text is not null").select("_doc", "_tid", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.select(F.struct("_doc", "_tid", "pos").alias("at"), "line", F.xxhash64("line").alias("h"), F.char_length("line").alias("n")).where(f"n >= {max(1, exact_from)}")


def _half_keys() -> list:
    """Front and back keys for partners of the same length, one longer and one shorter.

    For the shorter length m of a pair, front and back hold 8 * (m div 16) code
    points each, so one of them is free of the edit.
    """
    def keys(m):
        half = F.floor(m / 16).cast("int") * 8
        return [F.xxhash64(F.lit(1), half, F.substring("line", F.lit(1), half)), F.xxhash64(F.lit(2), half, F.substring("line", F.col("n") - half + 1, half))]

    n = F.col("n")
    own, other = keys(n), keys(n - 1)
    return [*own, *(F.when(n % 16 == 0, k) for k in other)]


def _width(n):
    """Block length for lines of n code points: a power of two near sqrt(n)."""
    return F.greatest(F.lit(BLOCK), F.pow(F.lit(2), F.ceil(F.log2(n.cast("double")) / 2))).cast("int")


def _blocks(lines: DataFrame) -> DataFrame:
    """(h, s, w, role, key): roles are 0 replaced, 1 longer partner, 2 shorter partner."""
    n = F.col("n")
    before, after = F.xxhash64(F.substring("line", F.lit(1), F.col("s"))), lambda skip: F.xxhash64(F.substring("line", F.col("s") + skip + 1, n))
    longer = lines.withColumn("w", _width(n)).select("h", "line", "n", "w", F.explode(F.sequence(F.lit(0), n - 1, F.col("w"))).alias("s"))
    longer = longer.select("h", "s", "w", F.col("n"), before.alias("b"), after(F.col("w")).alias("a"))
    longer = longer.select("h", "s", "w", F.explode(F.array(
        F.struct(F.lit(0).alias("role"), F.xxhash64(F.lit(0), "n", "s", "b", "a").alias("key")),
        F.struct(F.lit(1).alias("role"), F.xxhash64(F.lit(1), F.col("n") - 1, "s", "b", "a").alias("key")))).alias("k")).select("h", "s", "w", "k.*")
    shorter = lines.withColumn("w", _width(n + 1)).select("h", "line", "n", "w", F.explode(F.sequence(F.lit(0), n, F.col("w"))).alias("s"))
    shorter = shorter.select("h", "s", "w", F.lit(2).alias("role"), F.xxhash64(F.lit(1), "n", "s", before, after(F.col("w") - 1)).alias("key"))
    return longer.unionByName(shorter)


def _variants(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """(key, role, h, at) of every deletion variant of the given blocks, and of the blocks of shorter partners as they are."""
    own = blocks.join(lines.select("h", "at", "line", "n"), "h")
    place = F.when(F.col("role") == 2, F.array(F.lit(0))).otherwise(F.sequence(F.col("s") + 1, F.least(F.col("s") + F.col("w"), F.col("n"))))
    each = own.select("h", "at", "line", "s", "w", "role", "key", F.explode(place).alias("i"))
    deleted = F.concat(F.substring("line", F.col("s") + 1, F.col("i") - F.col("s") - 1), F.substring("line", F.col("i") + 1, F.col("s") + F.col("w") - F.col("i")))
    whole = F.substring("line", F.col("s") + 1, F.col("w") - 1)
    at_place = F.when(F.col("role") == 0, F.col("i")).otherwise(0)
    return each.select(F.xxhash64("key", at_place, F.when(F.col("role") == 2, whole).otherwise(deleted)).alias("key"), "role", "h", "at")


def _near_links(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """(h) of lines with an earlier line one edit away; ``lines`` is the staged candidate table (h, n, at, line)."""
    role = F.col("role")
    blocks = stage(spark, _blocks(lines), "line-blocks")
    both = blocks.groupBy("key").agg(F.min("h").alias("l"), F.max("h").alias("g"), F.min("role").alias("first"), F.max("role").alias("last"))
    open_ = stage(spark, both.where("l <> g and (last = 0 or first < last)").select("key"), "line-open")
    members = stage(spark, _variants(lines, blocks.join(open_, "key")), "line-variants")
    first = lambda r: F.min(F.when(role == r, F.struct("at", "h")))
    groups = members.groupBy("key").agg(F.min("h").alias("l"), F.max("h").alias("g"), *(first(r).alias(f"f{r}") for r in (0, 1, 2)))
    groups = stage(spark, groups.where("l <> g").select("key", "f0", "f1", "f2"), "line-groups")
    earlier = F.when(role == 0, F.col("f0")).when(role == 1, F.col("f2")).otherwise(F.col("f1"))
    links = members.join(groups, "key").withColumn("e", earlier).where("e.at < at").select("h", F.col("e.h").alias("e")).distinct()
    texts = lines.select("h", "line")
    pairs = links.join(texts, "h").join(texts.select(F.col("h").alias("e"), F.col("line").alias("other")), "e")
    near = stage(spark, pairs.where("levenshtein(line, other, 1) between 0 and 1").select("h").distinct(), "line-near")
    for done in (blocks, open_, members, groups):
        drop_stage(spark, done)
    return near


def removed_lines(spark: SparkSession, docs: DataFrame, exact_from: int = 1) -> DataFrame:
    """(_doc, _tid, drops): the line numbers to remove of each document that loses any."""
    keyed = _keyed(docs)
    every = _lines(keyed, exact_from)
    first = stage(spark, every.select("h", "n", "at", F.array_compact(F.array(*_half_keys())).alias("keys")).groupBy("h", "n").agg(
        F.min("at").alias("at"), F.count(F.lit(1)).alias("m"), F.first("keys").alias("keys")), "lines")
    halves = first.where(f"n >= {MIN_CHARS}").select("h", "n", "at", F.explode("keys").alias("key"))
    shared = stage(spark, halves.groupBy("key").agg(F.min("h").alias("l"), F.max("h").alias("g")).where("l <> g").select("key"), "line-halves")
    places = halves.join(shared, "key").groupBy("at._doc", "at._tid").agg(F.collect_set("at.pos").alias("places"))
    places = stage(spark, places, "line-places")
    found = keyed.where("text is not null").select("_doc", "_tid", "text").hint("merge").join(places, ["_doc", "_tid"]).select(
        "_doc", "_tid", "places", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where("array_contains(places, pos)")
    lines = stage(spark, found.select(F.xxhash64("line").alias("h"), F.char_length("line").alias("n"), F.struct("_doc", "_tid", "pos").alias("at"), "line").dropDuplicates(["at"]), "line-texts")
    near = _near_links(spark, lines)
    flagged = first.join(near.withColumn("near", F.lit(True)), "h", "left").where("m > 1 or near").select(
        "h", "n", F.col("at").alias("first"), F.coalesce("near", F.lit(False)).alias("near"))
    flagged = stage(spark, flagged, "line-flagged")
    drops = every.select("h", "n", "at").join(flagged, ["h", "n"]).where("near or at <> first")
    drops = stage(spark, drops.groupBy("at._doc", "at._tid").agg(F.collect_set("at.pos").alias("drops")), "line-drops")
    for done in (first, shared, places, lines, near, flagged):
        drop_stage(spark, done)
    return drops


def dedup_lines(spark: SparkSession, docs: DataFrame, exact_from: int = 1) -> DataFrame:
    """``docs`` with ``text`` less its removed lines, plus ``n_lines`` and ``n_removed``; lines under ``exact_from`` code points stay.

    Columns of ``docs`` keep their values and order whatever their names; only
    own ``n_lines`` and ``n_removed`` give way to the counts.
    """
    # the list grows with the corpus: never broadcast, so the plan is the same at every size
    joined = _keyed(docs).hint("merge").join(removed_lines(spark, docs, exact_from), ["_doc", "_tid"], "left")
    gone, text = F.col("drops"), F.col("text")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(gone, i)), "\n")
    n_lines = F.coalesce(F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")
    n_removed = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    own = [F.when(gone.isNull(), text).otherwise(kept).alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(*own, n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def op1_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return dedup_lines(spark, docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")


ORACLE = f"""
WITH e AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
j AS (SELECT * FROM e WHERE line <> ''),
f AS (SELECT line, length(line) AS n, min(row(doc_id, pos)) AS place FROM j GROUP BY line),
g AS (SELECT * FROM f WHERE n >= {MIN_CHARS}),
v AS (SELECT line, n, place, i, substr(line, 1, i - 1) || substr(line, i + 1) AS cut FROM (SELECT line, n, place, CAST(unnest(range(1, n + 1)) AS INTEGER) AS i FROM g)),
replaced AS (SELECT v.line FROM v JOIN (SELECT cut, i, min(place) AS place FROM v GROUP BY cut, i HAVING count(*) > 1) p USING (cut, i) WHERE p.place < v.place),
longer AS (SELECT v.line FROM v JOIN g ON g.line = v.cut WHERE g.place < v.place),
shorter AS (SELECT g.line FROM v JOIN g ON g.line = v.cut WHERE v.place < g.place),
near AS (SELECT DISTINCT line FROM (SELECT * FROM replaced UNION ALL SELECT * FROM longer UNION ALL SELECT * FROM shorter)),
d AS (SELECT j.doc_id, j.pos FROM j JOIN f USING (line) LEFT JOIN near USING (line) WHERE near.line IS NOT NULL OR row(j.doc_id, j.pos) <> f.place),
r AS (SELECT e.doc_id, count(*) AS n_lines, count(d.pos) AS n_removed, coalesce(string_agg(e.line, chr(10) ORDER BY e.pos) FILTER (WHERE d.pos IS NULL), '') AS text
      FROM e LEFT JOIN d USING (doc_id, pos) GROUP BY e.doc_id)
SELECT documents.doc_id, coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n_removed, 0) AS n_removed, r.text FROM documents LEFT JOIN r USING (doc_id)
"""
