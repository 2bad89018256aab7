"""Removal of long repeated byte strings by external induced suffix sorting.

A byte goes if a ``length``-byte string that covers it also starts anywhere
else in the corpus. Only a sample of the suffixes is sorted, as in
induced sorting; the others take their order from it:

1. Of the suffixes in each window of ``length`` bytes one is sampled by content: the
   one whose first ``SEED`` bytes have the least hash. Equal windows sample
   the same suffix, so a window is repeated only if its sample's seed is.
2. Samples with a repeated seed are dealt by seed and sorted with their
   following bytes. Spark's sort spills to disk, so a shard may be far larger than memory.
   Neighbours' common prefix lengths are carried along the sorted order.
3. Induction goes leftwards from the samples: the class of the string one byte
   further left is the pair (that byte, class of the string after it), and a common
   prefix of ``length - d`` bytes joins neighbours at distance d. A window is
   repeated if its class has two members.

Texts that occur more than once are treated once; with ``length`` bytes or
more, all of each copy goes. Defined results: null text is empty; rows with
equal texts get equal results; texts under ``length`` bytes lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm.common import drop_stage, partitions, stage, text_of

LENGTH = 200
SEED = 64
NO_ID = (1 << 63) - 1
CHUNK = 100_000  # sampled suffixes that are induced at once; a chunk ends between two seeds
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xBF58476D1CE4E5B9)
CODES = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=np.uint64)


def _seed_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes from each place, by doubling."""
    h, size = CODES[text], 1
    while size < SEED:
        h = h[:-size] * np.uint64(pow(BASE, size, 1 << 64)) + h[size:]
        size *= 2
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[:-rest], values[rest:]) if rest else values


def sample_suffixes(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, seed hash, least distance, greatest distance) of each sample; distances are to the starts of its windows."""
    n_windows = len(text) - length + 1
    if n_windows <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    width = length - SEED + 1
    h = _seed_hashes(np.frombuffer(text, np.uint8))
    least = _slide(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    is_sample = _slide(np.concatenate([pad, least, pad]), width, np.maximum) == h
    samples = np.flatnonzero(is_sample)
    windows = np.arange(n_windows)
    owner = np.searchsorted(samples, windows)
    todo = windows
    while todo.size:
        todo = todo[h[samples[owner[todo]]] != least[todo]]
        owner[todo] += 1
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    last = np.concatenate([first[1:], [n_windows]]) - 1
    place = samples[owner[first]]
    return place, h[place], place - last, place - first


def induce(seeds: np.ndarray, following: np.ndarray, before: np.ndarray, low: np.ndarray, high: np.ndarray, several: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """``[row, d]``: whether the window that starts d bytes before the row's sample is repeated.

    Rows are sorted by (seed, following bytes); ``before`` holds the preceding bytes, nearest first;
    ``several`` marks rows that stand for more than one place.
    """
    n, width = len(seeds), before.shape[1]
    distance = np.arange(width + 1)
    repeated = several[:, None] & (low[:, None] <= distance) & (distance <= high[:, None])
    if n < 2:
        return repeated
    same = following[1:] == following[:-1]
    common = np.where(same.all(axis=1), following.shape[1], same.argmin(axis=1))
    common[seeds[1:] != seeds[:-1]] = -1
    rank = np.zeros(n, np.int64)  # class of the d bytes before the sample
    for d in range(width + 1):
        if d:
            _, rank = np.unique(rank * 256 + before[:, d - 1], return_inverse=True)
        rows = np.flatnonzero((low <= d) & (d <= high))
        if rows.size < 2:
            continue
        run = np.concatenate([[0], np.cumsum(common < length - d)])[rows]
        _, at, count = np.unique(run * (rank.max() + 1) + rank[rows], return_inverse=True, return_counts=True)
        repeated[rows, d] |= count[at] > 1
    return repeated


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _samples(texts: DataFrame, length: int) -> DataFrame:
    """(seed, tid, place) of every sampled suffix of ``texts(tid, t binary)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                place, seed, _, _ = sample_suffixes(text.as_py(), length)
                if len(place):
                    yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(np.full(len(place), tid)), pa.array(place.astype(np.int32))], names=["seed", "tid", "place"])

    return texts.mapInArrow(run, "seed long, tid long, place int")


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """Sorting tuples of the samples whose places are listed in ``texts(tid, t, places)``.

    Places of a text with equal surroundings, as in a run that repeats, share a tuple.
    """
    names = ["seed", "tid", "places", "low", "high", "following", "before"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tid, data, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                text = data.as_py()
                place, seed, low, high = sample_suffixes(text, length)
                rows = np.flatnonzero(np.isin(place, wanted.values.to_numpy(zero_copy_only=False)))
                tuples: dict[tuple, list[int]] = {}
                for h, p, lo, hi in zip(seed[rows].view(np.int64).tolist(), place[rows].tolist(), low[rows].tolist(), high[rows].tolist(), strict=True):
                    tuples.setdefault((h, lo, hi, text[p: p + length - lo], text[p - hi: p][::-1]), []).append(p)
                h, lo, hi, following, before = zip(*tuples, strict=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(h, pa.int64()), pa.array([tid] * len(h), pa.int64()), pa.array(tuples.values(), pa.list_(pa.int32())), pa.array(lo, pa.int32()),
                    pa.array(hi, pa.int32()), pa.array(following, pa.binary()), pa.array(before, pa.binary())], names=names)

    return texts.mapInArrow(run, "seed long, tid long, places array<int>, low int, high int, following binary, before binary")


def _matrix(column: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in column), np.uint8).reshape(len(column), width)


def _induced(sorted_rows: DataFrame, length: int) -> DataFrame:
    """(tid, start, stop): bytes covered by repeated windows."""
    names = ["tid", "start", "stop"]

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        seed, tid, places, low, high, following, before = zip(*rows, strict=True)
        low, high = np.array(low), np.array(high)
        found = induce(np.array(seed), _matrix(following, length), _matrix(before, max(1, int(high.max()))), low, high, np.array([len(p) > 1 for p in places]), length)
        out: list[tuple[int, int, int]] = []
        for row in np.flatnonzero(found.any(axis=1)):
            for a, b in zip(*_runs(found[row]), strict=True):  # distances a .. b - 1
                out += [(tid[row], p - int(b) + 1, p - int(a) + length) for p in places[row]]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), *(pa.array([r[k] for r in out], pa.int32()) for k in (1, 2))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= CHUNK and row[0] != held[-1][0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    return sorted_rows.mapInArrow(run, "tid long, start int, stop int")


def removed_spans(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(tid, copies, spans array<struct<start, stop>>) of each distinct text that loses bytes."""
    text = text_of(docs)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("tid"), text.cast("binary").alias("t"))
    ones = stage(spark, keyed.where(F.octet_length("t") >= length).groupBy("tid").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies")), "texts")
    samples = stage(spark, _samples(keyed.select("tid", "t"), length), "samples")
    where = F.struct("tid", "place")
    repeated = stage(spark, samples.groupBy("seed").agg(F.min(where).alias("l"), F.max(where).alias("g")).where("l <> g").select("seed"), "seeds")
    wanted = stage(spark, samples.join(repeated, "seed").groupBy("tid").agg(F.collect_set("place").alias("places")).join(ones, "tid").select("tid", "doc", "places"), "places")
    tuples = _contexts(keyed.hint("merge").join(wanted, ["tid", "doc"]).select("tid", "t", "places"), length)
    dealt = tuples.repartition(partitions(spark), "seed").sortWithinPartitions("seed", "following")
    spans = _induced(dealt, length).groupBy("tid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    out = stage(spark, ones.select("tid", "copies").join(spans, "tid", "left").where("copies > 1 or spans is not null"), "spans")
    for done in (ones, samples, repeated, wanted):
        drop_stage(spark, done)
    return out


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (binary: the remaining bytes)."""
    text = text_of(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"), text.cast("binary").alias("t"))
    # the list grows with the corpus: never broadcast, so the plan is the same at every size
    joined = rows.hint("merge").join(removed_spans(spark, docs, length), "tid", "left").select("doc_id", "t", "copies", F.col("spans.start").alias("start"), F.col("spans.stop").alias("stop"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, copies, start, stop in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                own = data.as_py()
                if copies is not None and copies > 1:
                    out.append((len(own), len(own), 1, b""))
                elif start is None:
                    out.append((len(own), 0, 0, own))
                else:
                    steps = np.zeros(len(own) + 1, np.int32)
                    np.add.at(steps, start, 1)
                    np.add.at(steps, stop, -1)
                    gone = np.cumsum(steps[:-1]) > 0
                    out.append((len(own), int(gone.sum()), len(_runs(gone)[0]), np.frombuffer(own, np.uint8)[~gone].tobytes()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op8_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return remove_repeats(spark, docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
