"""MinHash near-duplicates by min-max hashing.

Each of ``PERMUTATIONS`` hash evaluations of a document's shingle set yields
two signature values, the minimum and the maximum; bands of ``ROWS`` values
give candidates (a pair at similarity 0.8 escapes all 20 bands with probability 6e-7).
Candidates are confirmed on full shingle sets and joined into components.

Documents with equal shingle sets form one node first. In a bucket of nodes
no round emits all pairs: round by round a growing number of its nodes
(1, 64, 4096, ...) is compared with the later nodes that are not yet known to be in the same
component, until every node has had its turn or the bucket is one component.
So no link between components is lost and there is no cap on buckets.

A pair leaves the join only if its parity bitmaps allow a link (a test in the join's own condition). A bitmap holds,
per slot of the shingle space, whether an odd number of the set's shingles fall
there; each shingle in which two sets differ flips one bit, so the bits in which
two bitmaps differ are never more than the shingles in which the sets do. At two
to four slots a shingle, that exact bound stops pairs whose similarity is below about 0.78.

Defined results: documents without words link with nothing and are their own
component; rows are told apart by (doc_id, text); a component's id is its
least non-null doc_id; rows without an id are kept only if their component
has no id at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.llm.common import LOWER_ASCII, drop_stage, stage, text_of
from pactline.llm.components import extend_components

PERMUTATIONS = 30
ROWS = 3
PERCENT = 80
SALTS = 32  # parts in which a band's nodes are ranked
GROWTH = 64  # so many times more nodes have their turn in each round
NO_ID = (1 << 63) - 1  # stands for a null doc_id: after all others
_RANDOM = np.random.default_rng(20240229)
MULTIPLIERS = _RANDOM.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Word to 64-bit hash, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 500_000:
            self[word] = h
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: bytes, size: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    found = text.translate(LOWER_ASCII).split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))], np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    out = h[: len(h) - size + 1].copy()
    for k in range(1, size):
        out = out * BASE + h[k: len(h) - size + 1 + k]
    return np.unique(mixed(out))


def bands(hashes: np.ndarray) -> np.ndarray:
    """Band keys of the min-max signature."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(hashes), 8192):
        moved = hashes[at: at + 8192, None] * MULTIPLIERS
        low, high = np.minimum(low, moved.min(axis=0)), np.maximum(high, moved.max(axis=0))
    values = mixed(np.stack([low, high], axis=1).reshape(-1, ROWS))
    keys = np.arange(len(values), dtype=np.uint64) * MIX
    for k in range(ROWS):
        keys = mixed(keys * BASE + values[:, k])
    return keys


def parities(hashes: np.ndarray) -> np.ndarray:
    """Parity bitmap of a shingle set: a power of two of slots, at least two a shingle, in 64-bit words."""
    slots = 64
    while slots < 2 * len(hashes):
        slots *= 2
    odd = np.bincount((hashes & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    # slot i is bit i % 64 of word i // 64: folding a bitmap to fewer slots is an exclusive or of whole words
    words = odd.reshape(-1, 64).astype(np.uint64) << np.arange(64, dtype=np.uint64)
    return np.bitwise_or.reduce(words, axis=1).view(np.int64)


def differing_bits(a: str, b: str) -> str:
    """SQL: the bits in which two parity bitmaps differ, the longer one folded to the words of the shorter."""
    fold = lambda c, w: f"if(size({c}) = {w}, {c}, transform(sequence(0, {w} - 1), i -> aggregate(sequence(i, size({c}) - 1, {w}), 0L, (x, j) -> x ^ {c}[j])))"
    words = f"least(size({a}), size({b}))"
    return f"aggregate(zip_with({fold(a, words)}, {fold(b, words)}, (x, y) -> bit_count(x ^ y)), 0, (t, c) -> t + c)"


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, tid, n, node, bands, bits): tid tells texts apart, node equal shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            counts, nodes, keys, bits = [], [], [], []
            for text in batch.column(2):
                own = shingles(text.as_py(), size, words)
                counts.append(len(own))
                nodes.append(int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())))) if len(own) else None)
                keys.append(bands(own).view(np.int64) if len(own) else [])
                bits.append(parities(own) if len(own) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))], names=["doc_id", "tid", "n", "node", "bands", "bits"])

    text = text_of(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"), text.cast("binary").alias("t")).mapInArrow(
        run, "doc_id long, tid long, n long, node long, bands array<long>, bits array<long>")


def candidate_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, t) of ``wanted(node, doc, tid)``: one whole text of each wanted node."""
    text = text_of(docs)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("tid"), text.cast("binary").alias("t"))
    # the list grows with the corpus: never broadcast, so the plan is the same at every size
    return texts.hint("merge").join(wanted, ["doc", "tid"]).select("node", "t").dropDuplicates(["node"])


def shingle_sets(texts: DataFrame, named: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the nodes in ``named(node)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            sets = [shingles(t.as_py(), size, words).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return texts.hint("merge").join(named, "node").mapInArrow(run, "node long, shingles array<long>")


def ranked_members(members: DataFrame) -> DataFrame:
    """Adds ``rank``, from 1, within each band: ranks in SALTS parts of a band, plus the parts before."""
    cut = members.withColumn("salt", F.pmod(F.col("node"), F.lit(SALTS)))
    before = Window.partitionBy("band").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut.groupBy("band", "salt").agg(F.count(F.lit(1)).alias("c")).select("band", "salt", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    own = F.row_number().over(Window.partitionBy("band", "salt").orderBy("node"))
    return cut.withColumn("own", own).join(bases, ["band", "salt"]).select("band", "node", "n", (F.col("own") + F.col("base")).alias("rank"))


def confirmed(spark: SparkSession, texts: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``pairs(a, b)`` whose full shingle sets are similar enough; sets are made for their nodes alone."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stage(spark, shingle_sets(texts, named, size), "sets")
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    out = stage(spark, both.where(f"100 * common >= {percent} * (size(sa) + size(sb) - common)").select("a", "b"), "links")
    drop_stage(spark, sets)
    return out


def find_links(spark: SparkSession, texts: DataFrame, nodes: DataFrame, ranked: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Confirmed links, enough of them to join every component, as (node, root); None without links.

    ``ranked`` is a staged table of band, node, size and rank; a node's bitmap is joined to its rows in open
    buckets alone. The tables of each round are dropped when the next has been written.
    """
    labels = None
    low, high = 1, 2  # nodes of these ranks are compared in this round
    while True:
        now = ranked.withColumn("label", F.col("node"))
        if labels is not None:
            now = ranked.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
        # buckets with two components and a node that has not had its turn
        ends = now.groupBy("band").agg(F.min("label").alias("l"), F.max("label").alias("g"), F.max("rank").alias("last"))
        left = stage(spark, now.join(ends.where(f"l < g and last > {low}").select("band"), "band"), "open")
        if left.isEmpty():
            drop_stage(spark, left)
            return labels
        # of each node the rows from its first turn on; as the list grows with the corpus, bitmaps are not broadcast
        mapped = left.hint("merge").join(nodes.select("node", "bits"), "node")
        a = mapped.where(f"rank >= {low} and rank < {high}").select(*(F.col(c).alias(f"{c}_a") for c in mapped.columns))
        b = mapped.where(f"rank > {low}").select(*(F.col(c).alias(f"{c}_b") for c in mapped.columns))
        # a link differs in at most (100 - percent) / (100 + percent) of both sizes together; this is part of the
        # join's own condition (a filter behind a join would stay behind it), so other pairs never leave the join
        test = (f"band_a = band_b and rank_a < rank_b and label_a <> label_b and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
                f" and {100 + percent} * {differing_bits('bits_a', 'bits_b')} <= {100 - percent} * (n_a + n_b)")
        pairs = stage(spark, a.join(b, F.expr(test)).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "pairs")
        new = None if pairs.isEmpty() else confirmed(spark, texts, pairs, size, percent)
        drop_stage(spark, pairs)
        if new is not None and not new.isEmpty():
            labels = extend_components(spark, labels, new)
        drop_stage(spark, ranked)
        ranked = left.drop("label")
        ranked._llm_path = left._llm_path
        low, high = high, high + GROWTH * (high - low)


def find_components(spark: SparkSession, docs: DataFrame, size: int = 4, percent: int = PERCENT) -> DataFrame:
    """Per row: (doc_id, tid, n_shingles, root, component_id, kept); ``root`` is null without words."""
    found = stage(spark, signatures(docs, size), "signatures")
    nodes = stage(spark, found.where("n > 0").groupBy("node").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "tid")).alias("at"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits")), "nodes")
    member = nodes.select("node", "n", F.explode("bands").alias("band"))
    shared = stage(spark, member.groupBy("band").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("band"), "shared-bands")
    ranked = stage(spark, ranked_members(member.join(shared, "band")), "ranks")
    drop_stage(spark, shared)
    # texts of the nodes that share a bucket at all; no later step reads the documents
    wanted = nodes.select("node", "at.doc", "at.tid").join(ranked.select("node").distinct(), "node", "left_semi")
    texts = stage(spark, candidate_texts(docs, wanted), "candidate-texts")
    labels = find_links(spark, texts, nodes, ranked, size, percent)
    drop_stage(spark, texts)
    rooted = nodes.select("node", F.col("at.doc").alias("doc"))
    if labels is None:
        named = rooted.select("node", F.col("node").alias("root"), F.col("doc").alias("least"))
    else:
        rooted = stage(spark, rooted.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")), "roots")
        least = stage(spark, rooted.groupBy("root").agg(F.min("doc").alias("least")), "least")
        named = rooted.join(least, "root").select("node", "root", "least")
    named = stage(spark, named, "named")
    out = found.select("doc_id", "tid", "n", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.nullif("least", F.lit(NO_ID)))
    return out.select("doc_id", "tid", F.col("n").alias("n_shingles"), "root", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def op9_neardup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return find_components(spark, docs).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component; rows equal in doc_id and text count as one document."""
    kept = find_components(spark, docs, size, percent).where("kept").select("doc_id", "tid", "root").distinct()
    # a component keeps one text even if two of its texts have the same id
    once = kept.withColumn("_k", F.row_number().over(Window.partitionBy(F.coalesce("root", "tid")).orderBy("doc_id", "tid")))
    chosen = stage(spark, once.where("_k = 1 or root is null").select(F.col("doc_id").alias("_d"), F.col("tid").alias("_t")), "chosen")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_doc"), F.xxhash64(text_of(docs)).alias("_tid"))
    single = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_doc", "_tid").orderBy("_doc"))).where("_n = 1")
    return single.join(chosen, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_tid") == F.col("_t")), "left_semi").select("_row.*")
