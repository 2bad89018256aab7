"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item gives its windows of 13 consecutive words (a shorter
item: one window). A window is a set of placed word shingles (two words each; one
word where the window has no more), ranked by rarity: the number of documents that hold
them, over the whole corpus. Containment of a whole window needs all its
shingles, so its necessary prefix is the rarest: documents join windows on
that shingle alone, the shingle's place in the window gives the only possible start
(positional bound), the document must have room for the window on both
sides (length bound), and the window is then compared word by word.

Both sides are tables. Documents send only places whose shingle can be a
benchmark's: a bitmap of hashed shingles, of a size bounded by ``MAX_SLOTS``, goes to
the tasks; neither windows nor documents do. The join is salted, so a frequent
shingle is spread; texts are never shuffled.

Defined results: null and empty texts have no words and hold nothing; items
that are null or empty have no windows; windows of items without an id count
as hits, but name no item; items with the same id count once; rows equal in doc_id and
text share their result, each has its row; very long texts are read whole; an
empty table of documents gives no rows, of benchmark items no hits; other columns are kept
by ``drop_contaminated``, whatever their names, and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.llm.common import ALNUM_LOWER, drop_stage, stage, text_of

WINDOW = 13
SALTS = 16
MAX_SLOTS = 1 << 28  # bits of a bitmap of shingles: 32 MB at most
NO_ID = (1 << 63) - 1
CHUNK_BYTES = 1 << 20  # texts taken apart at once
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM_LOWER).split()


class WordHashes(dict):
    """Word to 64-bit hash, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 300_000:
            self[word] = h
        return h


def shingle_hashes(words: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word alone, hash of each two adjacent words)."""
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    two = h[:-1] * BASE + h[1:]
    two = (two ^ (two >> np.uint64(31))) * MIX
    return h, two ^ (two >> np.uint64(29))


def shingled(batch: pa.RecordBatch, text: int, known: WordHashes, bits: np.ndarray, slots: int) -> Iterator[tuple]:
    """(first row, words of each row, [(row, place, hash) arrays of the shingles whose slot is set]), some texts at a time."""
    column, start = batch.column(text), 0
    while start < len(column):
        words, size = [], 0
        while start + len(words) < len(column) and size < CHUNK_BYTES:
            raw = column[start + len(words)].as_py()
            size += len(raw)
            words.append(words_of(raw))
        counts = np.fromiter(map(len, words), np.int64, len(words))
        flat = [w for own in words for w in own]
        found = []
        if flat:
            row = np.repeat(np.arange(len(words)), counts)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
            one, two = shingle_hashes(flat, known)
            for hashes, same in ((one, np.ones(len(one), bool)), (two, row[1:] == row[:-1])):
                at = np.flatnonzero(held(bits, slots, hashes) & same)
                found.append((row[at], place[at], hashes[at]))
        yield start, words, found
        start += len(words)


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (window, item, shingles): the window's words joined by blanks, and the hash of the shingle at each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            windows, items, shingles = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if not words:
                    continue
                one, two = shingle_hashes(words, known)
                keys = (two if len(words) > 1 else one).view(np.int64).tolist()
                for i in range(max(1, len(words) - size + 1)):
                    windows.append(b" ".join(words[i: i + size]).decode())
                    items.append(item)
                    shingles.append(keys[i: i + max(1, min(size, len(words)) - 1)])
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.string()), pa.array(items, pa.string()), pa.array(shingles, pa.list_(pa.int64()))], names=["window", "item", "shingles"])

    named = benchmark.select(F.col("item_id").cast("string").alias("item"), text_of(benchmark).cast("binary").alias("text"))
    return named.mapInArrow(run, "window string, item string, shingles array<long>").distinct()


def bitmap(shingles: DataFrame, slots: int) -> np.ndarray:
    """Which of ``slots`` the hashes of ``shingles(shingle)`` fall into, as packed bits; put together by Spark."""
    slot = F.pmod(F.col("shingle"), F.lit(slots)) + 1
    parts = shingles.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    bits = np.zeros(max(1, slots // 32768) * 4096, np.uint8)
    for r in parts:
        bits[(r["part"] - 1) * 4096: r["part"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits


def held(bits: np.ndarray, slots: int, hashes: np.ndarray) -> np.ndarray:
    """Which hashes' slots are set."""
    at = hashes & np.uint64(slots - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def document_frequency(docs: DataFrame, bits: np.ndarray, slots: int) -> DataFrame:
    """(shingle, n): the documents that hold each shingle whose slot is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()

        def counted(found: list[np.ndarray]) -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

        found, size = [], 0
        for batch in batches:
            for _, _, places in shingled(batch, 0, known, bits, slots):
                for row, _, hashes in places:
                    own = np.unique(np.stack([row.astype(np.uint64), hashes]), axis=1)[1]
                    found.append(own)
                    size += len(own)
                if size > 2_000_000:
                    yield counted(found)
                    found, size = [], 0
        if size:
            yield counted(found)

    return docs.select(text_of(docs).cast("binary").alias("text")).mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def candidate_places(docs: DataFrame, bits: np.ndarray, slots: int, size: int) -> DataFrame:
    """(doc_id, tid, n_words, places): per document the places whose shingle can be a window's prefix, with the words around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        kind = pa.list_(pa.struct([("at", pa.int32()), ("first", pa.int32()), ("shingle", pa.int64()), ("around", pa.list_(pa.string()))]))

        def batch_of(ids, tids, counts, places) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(tids, pa.int64()), pa.array(counts, pa.int64()), pa.array(places, kind)], names=["doc_id", "tid", "n_words", "places"])

        for batch in batches:
            ids, tids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, words, found in shingled(batch, 2, known, bits, slots):
                places = [[] for _ in words]
                for row, place, hashes in found:
                    for r, at, h in zip(row.tolist(), place.tolist(), hashes.view(np.int64).tolist(), strict=True):
                        first = max(0, at - size + 1)
                        places[r].append({"at": at, "first": first, "shingle": h, "around": [w.decode() for w in words[r][first: at + size]]})
                end = start + len(words)
                yield batch_of(ids[start:end], tids[start:end], list(map(len, words)), places)

    text = text_of(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"), text.cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, tid long, n_words long, places array<struct<at:int,first:int,shingle:long,around:array<string>>>")


def prefixes(windows: DataFrame, frequency: DataFrame) -> DataFrame:
    """(shingle, offset, window, n): each window that can occur, by its rarest shingle and that shingle's place."""
    places = windows.select("window", F.posexplode("shingles").alias("offset", "shingle"))
    # a shingle that no document holds rules its window out; the join is on the corpus counts of benchmark shingles alone
    ranked = places.join(frequency, "shingle", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("rarest"))
    return ranked.where("rarest.n > 0").select("rarest.shingle", "rarest.offset", "window", F.size(F.split("window", " ")).alias("n"))


def find_contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, tid (hash of its text), n_words, n_hit and the sorted ``items`` whose windows occur in it."""
    windows = stage(spark, benchmark_windows(benchmark, size), "windows")
    slots = 1 << 20
    while slots < 16 * WINDOW * windows.count() and slots < MAX_SLOTS:
        slots *= 2
    of_benchmark = windows.select(F.explode("shingles").alias("shingle"))
    single = windows.groupBy("window").agg(F.first("shingles").alias("shingles"))
    chosen = stage(spark, prefixes(single, document_frequency(docs, bitmap(of_benchmark, slots), slots)), "prefixes")
    found = stage(spark, candidate_places(docs, bitmap(chosen.select("shingle"), slots), slots, size), "places")
    place = found.select("doc_id", "tid", F.explode("places").alias("p")).select("doc_id", "tid", "p.*").withColumn("salt", F.pmod(F.xxhash64("doc_id", "tid", "at"), F.lit(SALTS)))
    salted = chosen.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    start = F.col("at") - F.col("offset")
    own = F.array_join(F.slice("around", start - F.col("first") + 1, F.col("n")), " ")
    # positional and length bounds, then the words themselves, all in the join's condition
    same = (place["shingle"] == salted["shingle"]) & (place["salt"] == salted["salt"]) & (start >= F.col("first")) & (
        start - F.col("first") + F.col("n") <= F.size("around")) & (own == F.col("window"))
    hits = stage(spark, place.join(salted, same).select("doc_id", "tid", start.alias("start"), (start + F.col("n")).alias("end"), "window").distinct(), "hits")
    before = Window.partitionBy("doc_id", "tid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(before), F.lit(0))
    covered = hits.select("doc_id", "tid", "start", "end").distinct().select("doc_id", "tid", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reach)).alias("n"))
    covered = covered.groupBy("doc_id", "tid").agg(F.sum("n").cast("long").alias("n_hit"))
    named = hits.select("doc_id", "tid", "window").distinct().join(windows.select("window", "item"), "window").groupBy("doc_id", "tid").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    of_doc = stage(spark, covered.join(named, (covered["doc_id"].eqNullSafe(named["doc_id"])) & (covered["tid"] == named["tid"])).select(
        covered["doc_id"].alias("_doc"), covered["tid"].alias("_tid"), "n_hit", "items"), "contamination")
    for done in (windows, chosen, hits):
        drop_stage(spark, done)
    return found.join(of_doc, (F.col("doc_id").eqNullSafe(F.col("_doc"))) & (F.col("tid") == F.col("_tid")), "left").select(
        "doc_id", "tid", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))


def op10_contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_contamination(spark, docs, benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without its contaminated rows; a row travels as one struct, so its columns can have any names."""
    gone = find_contamination(spark, docs, benchmark).where(contaminated()).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), "tid").distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"), F.xxhash64(text_of(docs)).alias("tid"))
    return rows.join(gone, ["d", "tid"], "left_anti").select("row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, len(win) AS n, array_to_string(win, ' ') AS win FROM (SELECT item, w[i:i + least(len(w), 13) - 1] AS win FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw USING (n, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM h WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
