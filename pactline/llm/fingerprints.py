"""Document fingerprints by content-defined chunking.

A 32-byte windowed gear hash marks chunk ends: a strict mask before the normal
chunk size, a loose one after it, with least and greatest sizes. A
fingerprint is the set of chunk digests weighted by chunk length; likeness
is containment: the weight two sets share over the smaller set's weight.
Boundaries depend on 32 bytes of content alone, so they survive shifts.

The next document (ascending doc_id) is found without a global sort: texts
are exchanged once into doc_id ranges, and each range also gets a copy of the
first row of the following range.

Defined results: null text is empty; an empty fingerprint is like another
empty one (1) and unlike any other (0); null doc_ids come last; rows with
equal doc_ids follow each other by text hash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm.common import partitions, text_of

LEAST, NORMAL, GREATEST = 32, 64, 256
STRICT, LOOSE = np.uint32(0xFF000000), np.uint32(0xF0000000)
GEAR = np.array([xxhash.xxh3_64_intdigest(bytes([b]), seed=17) & 0xFFFFFFFF for b in range(256)], np.uint32)
LAST = (1 << 63) - 1
OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """Ends of the chunks of each text."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    h = GEAR[joined]
    for shift in (1, 2, 4, 8, 16):  # after these, h covers the last 32 bytes
        moved = h[:-shift] << np.uint32(shift)
        h = h.copy()
        h[shift:] += moved
    loose = np.flatnonzero(h & LOOSE == 0)
    strict = loose[h[loose] & STRICT == 0]
    loose_l, strict_l = (loose + 1).tolist(), (strict + 1).tolist()
    out, base, n_loose, n_strict = [], 0, len(loose_l), len(strict_l)
    i = j = 0
    for text in texts:
        ends, start, stop = [], base, base + len(text)
        while start < stop:
            if stop - start <= LEAST:
                end = stop
            else:
                i = bisect_left(strict_l, start + LEAST, i)
                if i < n_strict and strict_l[i] < start + NORMAL and strict_l[i] <= stop:
                    end = strict_l[i]
                else:
                    j = bisect_left(loose_l, start + NORMAL, j)
                    end = min(start + GREATEST, stop)
                    if j < n_loose and loose_l[j] < end:
                        end = loose_l[j]
            ends.append(end - base)
            start = end
        out.append(ends)
        base = stop
    return out


def digests(texts: list[bytes]) -> list[dict[int, int]]:
    """Weighted chunk digest set of each text."""
    out, hashed = [], xxhash.xxh3_64_intdigest
    for text, ends in zip(texts, chunk_ends(texts), strict=True):
        own, start = {}, 0
        for end in ends:
            own[hashed(text[start:end])] = end - start
            start = end
        out.append(own)
    return out


def encode(weights: dict[int, int]) -> str:
    return " ".join(f"{d:016x}:{w}" for d, w in sorted(weights.items()))


def decode(fingerprint: str) -> dict[int, int]:
    return {int(a, 16): int(b) for a, b in (x.split(":") for x in fingerprint.split())}


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    if not a or not b:
        return float(not a and not b)
    shared = sum(a[d] for d in a.keys() & b.keys())
    return shared / min(sum(a.values()), sum(b.values()))


def fingerprint_texts(texts: list[str]) -> list[str]:
    return [encode(d) for d in digests([t.encode() for t in texts])]


def edited(text: str, following: str) -> str:
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


def _fingerprint_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (range, copy, doc): each own row meets its successor; a range's last row meets the copy."""
    names = [x.split()[0] for x in OUT.split(", ")]

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        raw = [r[2].encode() for r in rows]
        changed = [edited(r[2], n).encode() for r, (_, n) in zip(rows, (r[3] for r in rows), strict=True)]
        following = [r[3][1].encode() for r in rows]
        # successors that are rows of this batch too are fingerprinted once
        own, new = digests(raw), digests(changed)
        nexts = own[1:] + digests(following[-1:])
        for k in [k for k in range(len(rows) - 1) if following[k] is not raw[k + 1] and following[k] != raw[k + 1]]:
            nexts[k] = digests([following[k]])[0]
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[2]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in changed]), pa.array([encode(d) for d in own]), pa.array([encode(d) for d in new]),
            pa.array([containment(a, b) for a, b in zip(own, new, strict=True)], pa.float64()),
            pa.array([containment(a, b) for a, b in zip(own, nexts, strict=True)], pa.float64())], names=names)

    held: tuple | None = None  # (doc_id, range, text) of the last own row, whose successor is still to come
    done = False  # the held row's range has had its copy
    ready: list[tuple] = []
    weight = 0
    for batch in batches:
        for doc, p, copy, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if copy and (held is None or done or p != held[1]):
                continue
            if held is not None:
                ready.append((*held, (p, text)))
                weight += len(text)
                if weight > 4_000_000:
                    yield emit(ready)
                    ready, weight = [], 0
            held, done = (None, True) if copy else ((doc, p, text), False)
    if ready:
        yield emit(ready)


def fingerprint_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).withColumns({
        "d": F.coalesce("doc_id", F.lit(LAST)), "h": F.xxhash64("text")})
    parts = partitions(spark)
    quantiles = keyed.agg(F.percentile_approx("d", F.lit([i / parts for i in range(1, parts)] or [0.5]), 10 * max(100, parts))).first()[0]
    splits = sorted({float(q) for q in quantiles or []})
    if splits:
        cut = Bucketizer(splits=[-float("inf"), *splits, float("inf")], inputCol="x", outputCol="p")
        ranged = cut.transform(keyed.withColumn("x", F.col("d").cast("double"))).drop("x").withColumn("p", F.col("p").cast("int"))
    else:
        ranged = keyed.withColumn("p", F.lit(0))
    firsts = sorted((r["p"], r["m"]["d"], r["m"]["h"]) for r in ranged.groupBy("p").agg(F.min(F.struct("d", "h")).alias("m")).collect())
    marks = spark.createDataFrame([(p, d, h, firsts[i - 1][0]) for i, (p, d, h) in enumerate(firsts)], "p int, d long, h long, before int")
    # one row a range: as many rows as shuffle partitions, whatever the data
    marked = ranged.join(F.broadcast(marks), ["p", "d", "h"], "left")
    own = F.struct("p", F.lit(0).alias("copy"))
    places = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("before").alias("p"), F.lit(1).alias("copy"))))
    dealt = marked.select("doc_id", "text", "d", "h", F.explode(places).alias("at")).select("doc_id", F.col("at.p").alias("p"), F.col("at.copy").alias("copy"), "text", "d", "h")
    ordered = dealt.repartition(parts, "p").sortWithinPartitions("p", "copy", "d", "h")
    return ordered.select("doc_id", "p", "copy", "text").mapInArrow(_fingerprint_ranges, OUT)
