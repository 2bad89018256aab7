"""Cross-tokenizer alignment by sparse products of token-byte incidence matrices.

A text is encoded by a byte-level BPE (A) and a piece BPE (B); both cover the
same bytes, a blank before the text included. Row i of a token-byte incidence
matrix in compressed sparse rows (indptr, indices; all values 1) holds the bytes
of token i. Gustavson's row products A·Bᵀ give the overlap links, whose sums are the
bytes two tokens share. Links chain tokens into groups, cut where tokens of both sides
end together, and the products of the two group-incidence matrices give the
shared-group links.

A blank after anything but white space begins a token on both sides, so a text is
aligned in segments from one such blank to the next, and no group crosses a
segment. Segments are kept in a bounded table per worker.

How many documents hold an id pair linked is counted over the corpus in two
steps: each worker counts the pairs of a block of documents (bounded by its
tokens), Spark adds up the blocks. Each block then asks only for its
own distinct pairs, and its documents meet the answers as one row, so rows sent grow with
the corpus and no pair table is held by a worker or the driver.

Defined results: null and empty texts, and texts whose joined bytes on either
side differ from blank + text, have no tokens: zeros and an empty digest; special
tokens' strings are plain text; repeated rows are documents of their own, counted each;
null ids stay null; a very long text is one block of its own; an empty table gives
no rows; columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm.common import stage, text_of

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
BLOCK_LINKS = 1_500_000  # a block of documents ends when its distinct pairs per document reach this sum
CACHE_SEGMENTS = 250_000
BATCH_CHARS = 1_000_000  # texts aligned in one call, and words in one product
SALTS = 16
ROWS = 8192  # token rows of one product
BLANK_AFTER_SPACE = re.compile(r"(?:^|\s) ")
CUT = re.compile(r"(?<=\S) ")
COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def incidence(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token-byte incidence matrix in compressed sparse rows: token i covers the next ``lengths[i]`` bytes."""
    indptr = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=indptr[1:])
    return indptr, np.arange(indptr[-1], dtype=np.int64)


def transposed(indptr: np.ndarray, indices: np.ndarray, n_columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a 0/1 matrix exchanged; rows stay ascending within each column."""
    rows = np.repeat(np.arange(len(indptr) - 1, dtype=np.int64), np.diff(indptr))
    out = np.zeros(n_columns + 1, np.int64)
    np.cumsum(np.bincount(indices, minlength=n_columns), out=out[1:])
    return out, rows[np.argsort(indices, kind="stable")]


def product(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], n_columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gustavson: row i of ``left`` times ``right`` is the sum of the rows of ``right`` that row i names.

    Returns (row, column, value) of the non-zero entries, in row order.
    """
    indptr, inner = left
    starts, ends = right[0][inner], right[0][inner + 1]
    width = ends - starts
    rows = np.repeat(np.repeat(np.arange(len(indptr) - 1, dtype=np.int64), np.diff(indptr)), width)
    # positions of all entries of the named rows, one row after another
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(width)[:-1])), width) if len(width) else width
    columns = right[1][np.arange(len(rows), dtype=np.int64) + first]
    keys, values = np.unique(rows * n_columns + columns, return_counts=True)
    return keys // n_columns, keys % n_columns, values


def overlap_links(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, shared bytes) of every pair of tokens that share a byte: A·Bᵀ, some rows of A at a time, against the rows of B that share their bytes."""
    ends_a, ends_b = np.cumsum(a_lengths), np.cumsum(b_lengths)
    found = []
    for at in range(0, len(a_lengths), ROWS):
        low, high = int(ends_a[at] - a_lengths[at]), int(ends_a[min(at + ROWS, len(ends_a)) - 1])
        first, last = int(np.searchsorted(ends_b, low, side="right")), int(np.searchsorted(ends_b, high, side="left"))
        b_ends = np.minimum(ends_b[first: last + 1], high) - low
        a, b = incidence(a_lengths[at: at + ROWS]), incidence(np.diff(b_ends, prepend=0))
        la, lb, shared = product(a, transposed(*b, high - low), len(b_ends))
        found.append((la + at, lb + first, shared))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def group_links(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group of each a, group of each b, a, b): groups from the overlap links, links from the group incidences.

    Overlap links come in byte order, so a group begins where a link shares neither token with the link before.
    """
    a, b, _ = overlap_links(a_lengths, b_lengths)
    begins = np.ones(len(a), np.int64)
    begins[1:] = (a[1:] != a[:-1]) & (b[1:] != b[:-1])
    group = np.cumsum(begins) - 1
    of_a, of_b = np.zeros(len(a_lengths), np.int64), np.zeros(len(b_lengths), np.int64)
    of_a[a], of_b[b] = group, group
    n_groups = int(group[-1]) + 1 if len(group) else 0
    left = (np.arange(len(of_a) + 1, dtype=np.int64), of_a)
    right = transposed(np.arange(len(of_b) + 1, dtype=np.int64), of_b, n_groups)
    la, lb, _ = product(left, right, max(1, len(of_b)))
    return of_a, of_b, la, lb


class Segments:
    """Aligned segments by number: token and group counts, the groups' text, and the id pairs of their links with repeats."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.names: list[str] = []
        self.counts: list[np.ndarray] = []  # parts of rows (n_a, n_b, n_groups, n_links); n_a 0: no tokens
        self.pairs: list[np.ndarray] = []

    def add(self, words: list[str], counts: np.ndarray, names: list[str], pairs: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.names), len(self.names) + len(words)), strict=True))
        self.names += names
        self.counts.append(counts)
        self.pairs.append(pairs)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(counts, first pair of each segment, pairs), joined once after every addition."""
        if len(self.counts) != 1:
            self.counts = [np.concatenate(self.counts) if self.counts else np.zeros((0, 4), np.int64)]
            self.pairs = [np.concatenate(self.pairs) if self.pairs else np.zeros(0, np.int64)]
        counts = self.counts[0]
        return counts, np.cumsum(counts[:, 3]) - counts[:, 3], self.pairs[0]


def make_aligner(tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B):
    """A function from texts to one (n_a, n_b, n_groups, groups text, distinct pairs, their repeats) each, or None without tokens."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    side_a = Tokenizer.from_file(P.path(tokenizer_a))
    side_a.encode_special_tokens = True
    side_b = sentencepiece.SentencePieceProcessor(model_file=P.path(tokenizer_b))
    # byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    alphabet = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = side_a.get_vocab()
    bytes_a = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        bytes_a[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
    bytes_b = []
    for i in range(side_b.get_piece_size()):
        piece = side_b.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if side_b.is_byte(i) else piece.replace("▁", " ").encode())
    length_a, length_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (bytes_a, bytes_b))
    blank_b = side_b.piece_to_id("▁")

    def covers(ids: list[list[int]], table: list[bytes], own: list[bytes]) -> np.ndarray:
        """Which token lists spell their segment's bytes."""
        return np.fromiter((b"".join(map(table.__getitem__, i)) == o for i, o in zip(ids, own, strict=True)), bool, len(own))

    def align_words(words: list[str], into: Segments) -> None:
        """All ``words`` (a blank stands before each) as one block-diagonal product."""
        spaced = [" " + w for w in words]
        ids_a = [e.ids for e in side_a.encode_batch_fast(spaced, add_special_tokens=False)]
        ids_b = [i or [blank_b] for i in side_b.encode(words, num_threads=1)]
        own = [w.encode() for w in spaced]
        good = covers(ids_a, bytes_a, own) & covers(ids_b, bytes_b, own)
        ids_a, ids_b = ([i if g else [] for i, g in zip(ids, good, strict=True)] for ids in (ids_a, ids_b))
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
        counts = np.zeros((len(words), 4), np.int64)
        counts[:, 0], counts[:, 1] = n_a, n_b
        names, pairs = [""] * len(words), np.zeros(0, np.int64)
        if len(a):
            of_a, of_b, la, lb = group_links(length_a[a], length_b[b])
            segment = np.repeat(np.arange(len(words)), n_a)
            first = np.flatnonzero(np.diff(of_a, prepend=-1))
            counts[:, 2] = np.bincount(segment[first], minlength=len(words))
            counts[:, 3] = np.bincount(segment[la], minlength=len(words))
            pairs = a[la] << 32 | b[lb]
            ends_a, ends_b = np.append(first[1:], len(a)).tolist(), np.append(np.flatnonzero(np.diff(of_b, prepend=-1))[1:], len(b)).tolist()
            text_a, text_b, groups, i, j = list(map(str, a.tolist())), list(map(str, b.tolist())), [], 0, 0
            for x, y in zip(ends_a, ends_b, strict=True):
                groups.append((text_a[i] if x == i + 1 else ",".join(text_a[i:x])) + "|" + (text_b[j] if y == j + 1 else ",".join(text_b[j:y])))
                i, j = x, y
            at = 0
            for k, n in enumerate(counts[:, 2].tolist()):
                names[k] = groups[at] if n == 1 else ";".join(groups[at: at + n])
                at += n
        into.add(words, counts, names, pairs)

    kept = Segments()

    def align(texts: list[str | None]) -> list:
        cut = [None if not t else CUT.split(t) if BLANK_AFTER_SPACE.search(t) else t.split(" ") for t in texts]
        new = list({w: None for words in cut if words for w in words if w not in kept.number})
        store, extra = kept, None
        if len(kept.number) + len(new) > CACHE_SEGMENTS:  # the table is full: these are forgotten after the call
            store = extra = Segments()
        at = 0
        while at < len(new):
            size, end = len(new[at]), at + 1
            while end < len(new) and size + len(new[end]) <= BATCH_CHARS:
                size += len(new[end])
                end += 1
            align_words(new[at:end], store)
            at = end
        counts, starts, pairs = kept.arrays()
        names, find = kept.names, kept.number.__getitem__
        if extra is not None:
            more, _, more_pairs = extra.arrays()
            counts, pairs = np.concatenate([counts, more]), np.concatenate([pairs, more_pairs])
            starts = np.cumsum(counts[:, 3]) - counts[:, 3]
            early, late, names = kept.number, {w: i + len(names) for w, i in extra.number.items()}, names + extra.names
            find = lambda w: early[w] if w in early else late[w]
        out = []
        for words in cut:
            if not words:
                out.append(None)
                continue
            own = list(map(find, words))
            at_words = np.array(own)
            sums = counts[at_words]
            if not sums[:, 0].all():
                out.append(None)
                continue
            width = sums[:, 3]
            ends = np.cumsum(width)
            held = pairs[np.repeat(starts[at_words] - (ends - width), width) + np.arange(ends[-1])]
            distinct, times = np.unique(held, return_counts=True)
            n_a, n_b, n_groups, _ = sums.sum(axis=0).tolist()
            out.append((n_a, n_b, n_groups, ";".join(map(names.__getitem__, own)), distinct, times))
        return out

    return align


def aligned_blocks(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B) -> DataFrame:
    """(block, documents, pairs, holding): documents with their link counts by pair, packed; pairs with the number of documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = make_aligner(tokenizer_a, tokenizer_b)
        part, n = TaskContext.get().partitionId(), 0
        rows, own, often, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal rows, own, often, held, n
            every = np.concatenate(own) if own else np.zeros(0, np.int64)
            pairs, at, holding = np.unique(every, return_inverse=True, return_counts=True)
            times = np.concatenate(often) if often else np.zeros(0, np.int32)
            payload = pickle.dumps((rows, at.astype(np.int32), times.astype(np.int32)))
            made = pa.RecordBatch.from_arrays([
                pa.array([part << 32 | n], pa.int64()), pa.array([payload], pa.binary()),
                pa.array([pairs], pa.list_(pa.int64())), pa.array([holding], pa.list_(pa.int64()))], names=["block", "documents", "pairs", "holding"])
            rows, own, often, held, n = [], [], [], 0, n + 1
            return made

        def some_texts() -> Iterator[tuple]:
            """Documents with their alignment, a bounded number of code points at a time."""
            for batch in batches:
                waiting, size = [], 0
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    waiting.append((doc, text.as_py()))
                    size += len(waiting[-1][1])
                    if size >= BATCH_CHARS:
                        yield from zip(waiting, align([t for _, t in waiting]), strict=True)
                        waiting, size = [], 0
                yield from zip(waiting, align([t for _, t in waiting]), strict=True)

        for (doc, _), found in some_texts():
            if found is None:
                rows.append((doc, 0, 0, 0, "", 0))
            else:
                names, pairs, times = found[3:]
                rows.append((doc, *found[:3], hashlib.sha256(names.encode()).hexdigest(), len(pairs)))
                own.append(pairs)
                often.append(times)
                held += len(pairs)
            if held >= BLOCK_LINKS or len(rows) >= 20_000:
                yield block()
        if rows:
            yield block()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(
        run, "block long, documents binary, pairs array<long>, holding array<long>")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold a pair linked, and whether no pair of the same A id has more."""
    counts = blocks.select(F.explode(F.arrays_zip("pairs", "holding")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holding").alias("count"))
    # as many rows as ids of A's vocabulary at most
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("most"))
    return counts.join(most, F.shiftright("pair", 32) == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_documents(spark: SparkSession, docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B) -> DataFrame:
    """One row per document: token, group and link counts, best links, the sum of its links' counts, and the digest of its groups."""
    blocks = stage(spark, aligned_blocks(docs, tokenizer_a, tokenizer_b), "aligned")
    counted = stage(spark, pair_counts(blocks.select("pairs", "holding")), "pair-counts")
    # a frequent pair is asked for by every block: its questions and its count are spread by a salt
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"), F.pmod(F.xxhash64("block"), F.lit(SALTS)).alias("salt"))
    known = counted.select("pair", "count", "best", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    answers = asked.join(known, ["pair", "salt"]).groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, found in zip(batch.column(0), batch.column(1), strict=True):
                rows, at, often = pickle.loads(packed.as_buffer())
                count, best = np.zeros(0, np.int64), np.zeros(0, bool)
                if found.is_valid:
                    known = found.values
                    order = np.argsort(known.field("at").to_numpy())
                    count = known.field("count").to_numpy()[order]
                    best = known.field("best").to_numpy(zero_copy_only=False)[order]
                out, start = [], 0
                for doc, n_a, n_b, n_groups, digest, n_pairs in rows:
                    own, times = at[start: start + n_pairs], often[start: start + n_pairs].astype(np.int64)
                    start += n_pairs
                    out.append((doc, n_a, n_b, n_groups, int(times.sum()), int(times[best[own]].sum()), int((times * count[own]).sum()), digest))
                cols = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 7 + [pa.string()], strict=True)], names=[c.split()[0] for c in COLUMNS.split(", ")])

    joined = blocks.select("block", "documents").hint("merge").join(answers, "block", "left")
    return joined.select("documents", "answers").mapInArrow(run, COLUMNS)
