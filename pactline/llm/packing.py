"""Packing by non-negative least squares over shallow length combinations.

Documents are tokenised once and cut at multiples of the window, so only the
remainders need partners. The histogram of piece lengths (at most ``window``
rows) goes to the driver: combinations of up to three lengths that fill the
window exactly are enumerated, their repeat counts solved by NNLS against the
histogram and rounded within stock; the residual is packed greedily, largest first,
again on the histogram. The plan's size depends on the window, never on the
data. Pieces take their places by their rank within their length.

Defined results: null text counts as empty (one piece, the end id); repeated
rows are packed once each; an empty table gives no rows. A sequence is padded
to the window unless its length is a power of two.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.llm.common import stage, text_of

WINDOW = 2048
PARTS = 64
TOKENIZER = "byte_bpe_50k"
CACHE_WORDS = 400_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def make_encoder(name: str = TOKENIZER, end_id: int = 1):
    """A function from text to its ids (with the end id) as little-endian uint32 bytes.

    A blank between two non-blanks always begins a new pre-token, so texts are
    encoded word by word through a bounded cache. Texts with runs of white
    space or the special token's string, and words beyond the Latin blocks, go
    to the ``tokenizers`` library itself.
    """
    import base64

    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path(f"{name}.json"))
    with open(P.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    quick = tiktoken.Encoding(name, pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    unsafe, beyond = re.compile(r"\s | \s|<\|endoftext\|>"), re.compile("[^\x00-ɏ]")
    as_bytes = lambda ids: np.asarray(ids, dtype="<u4").tobytes()
    end = as_bytes([end_id])

    def exact(text: str) -> bytes:
        return as_bytes(whole.encode(text, add_special_tokens=False).ids)

    class Words(dict):
        def __init__(self, before: str) -> None:
            self.before = before

        def __missing__(self, word: str) -> bytes:
            ids = exact(self.before + word) if beyond.search(word) else as_bytes(quick.encode_ordinary(self.before + word))
            if len(self) < CACHE_WORDS:
                self[word] = ids
            return ids

    first, spaced = Words(""), Words(" ")

    def encode(text: str) -> bytes:
        if not text:
            return end
        if unsafe.search(text):
            return exact(text) + end
        words = text.split(" ")
        head = first[words[0]] if words[0] else b""
        return head + b"".join(map(spaced.__getitem__, words[1:])) + end

    return encode


def tokenize_pieces(docs: DataFrame, window: int = WINDOW, tokenizer: str = TOKENIZER, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens[, ids binary])."""
    schema = PIECES + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import builtins

        # one encoder a worker, as a released one stays in memory until a full collection; it is kept by the
        # interpreter: a module's cache would be shipped by reference, and workers can't import this package
        kept = builtins.__dict__.setdefault("_packing_encoders", {})
        if (tokenizer, end_id) not in kept:
            kept[tokenizer, end_id] = make_encoder(tokenizer, end_id)
        encode = kept[tokenizer, end_id]
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py())
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start: 4 * (start + window)]
                    out.append((doc, start, len(piece) // 4, zlib.crc32(piece), total, piece))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]] + ([pa.array(cols[5], pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(arrays)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(run, schema)


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Exact fillings of ``lengths`` (ascending), one a row: one, two or three lengths, 0 for none; at most about window^2 / 12 rows."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    out = [np.array([[window, 0, 0]] if have[window] else [], np.int64).reshape(-1, 3)]
    pair = lengths[(2 * lengths <= window) & have[window - lengths]]
    out.append(np.stack([pair, window - pair, np.zeros_like(pair)], 1))
    for a in lengths[lengths <= window // 3]:
        b = lengths[(lengths >= a) & (2 * lengths <= window - a)]
        b = b[have[window - a - b]]
        out.append(np.stack([np.full_like(b, a), b, window - a - b], 1))
    return np.concatenate(out)


def nnls(combos: np.ndarray, goal: np.ndarray, rounds: int = 400) -> np.ndarray:
    """min |A x - goal|, x >= 0, by accelerated projected gradient; a column of A counts the lengths of a combination.

    The steps are the inverse of A'A's row sums, a diagonal that bounds it.
    """
    def times(v: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(c, v, minlength=len(goal)) for c in combos.T)
        out[0] = 0.0
        return out

    back = lambda v: sum(v[c] for c in combos.T)
    step = 1.0 / back(times(np.ones(len(combos))))
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        miss = times(y) - goal
        new = np.maximum(0.0, y - step * back(miss))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def _solve(histogram: dict[int, int], window: int, rounds: tuple[tuple[int, ...], ...]) -> list[tuple[tuple[int, ...], int]]:
    """One plan: NNLS over the combinations of each round's depths, then the residual greedily.

    Repeats are rounded along the columns' running sum, so that many small shares add up.
    """
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    chosen: Counter = Counter()
    for depths in rounds:
        combos = combinations(np.flatnonzero(left), window)
        combos = combos[np.isin((combos > 0).sum(1), depths)]
        if not len(combos):
            continue
        x = nnls(combos, left.astype(float))
        whole = np.floor(x)
        part = np.floor(np.cumsum(x - whole) + 0.5)
        share = (whole + np.diff(part, prepend=0.0)).astype(np.int64)
        stock = left.tolist()
        order = np.argsort(-x, kind="stable")
        for i in order[share[order] > 0]:
            combo = tuple(v for v in combos[i].tolist() if v)
            n = min(int(share[i]), *(stock[v] // combo.count(v) for v in combo))
            if n > 0:
                chosen[combo] += n
                for v in combo:
                    stock[v] -= n
        left = np.array(stock, np.int64)
    chosen = list(chosen.items())
    while left.any():  # each pattern uses up at least one length
        room, pattern, stock = window, [], left.copy()
        while room and (fit := np.flatnonzero(stock[: room + 1])).size:
            pattern.append(int(fit[-1]))
            stock[fit[-1]] -= 1
            room -= int(fit[-1])
        n = min(int(left[v]) // pattern.count(v) for v in set(pattern))
        chosen.append((tuple(pattern), n))
        for v in pattern:
            left[v] -= n
    return chosen


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, repeats)`` of every pattern; all pieces are covered, none twice.

    Where many pieces exceed half a window, triples take the small pieces that
    they need; so pairs are also solved before triples, and alone, and the plan with least padding counts.
    """
    plans = [_solve(histogram, window, rounds) for rounds in (((1, 2, 3),), ((1, 2), (3,)), ((1, 2),))]
    padding = lambda p: sum(n * (window - sum(c)) for c, n in p if sum(c) & (sum(c) - 1))
    return min(plans, key=padding)


def pack_documents(spark: SparkSession, docs: DataFrame, window: int = WINDOW, tokenizer: str = TOKENIZER, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; with ``with_ids`` their token ids too."""
    pieces = stage(spark, tokenize_pieces(docs, window, tokenizer, end_id, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for pattern, n in plan(histogram, window):
        offset = 0
        for v in pattern:
            segments.setdefault(v, []).append((used.get(v, 0), base, offset))
            used[v] = used.get(v, 0) + n
            offset += v
        base += n
    table = {v: np.array(s, dtype=np.int64) for v, s in segments.items()}

    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(PARTS)).cast("int")
    cut = pieces.withColumn("_part", part)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "start"))
    ranked = cut.withColumn("_rank", rank - 1).join(offsets, ["length", "_part"]).withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_part", "_base")
    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "_rank"))
            seq, off = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for v in np.unique(lengths):
                at = np.flatnonzero(lengths == v)
                own = table[int(v)]
                k = np.searchsorted(own[:, 0], ranks[at], side="right") - 1
                seq[at], off[at] = own[k, 1] + ranks[at] - own[k, 0], own[k, 2]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in order), pa.array(seq), pa.array(off)], names=[*order, "sequence_id", "offset"])

    schema = PIECES + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"
    return ranked.select(*order, "_rank").mapInArrow(place, schema)


def op6_pack(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return pack_documents(spark, docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
