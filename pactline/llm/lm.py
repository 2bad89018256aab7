"""Language-model scoring with Elias-Fano n-gram tries.

The model is a bigram model with Dirichlet smoothing towards the smoothed
unigram: p(v | u) = (c(u, v) + MU p(v)) / (c(u) + MU). It grows with the corpus, so
it is never one object: contexts are dealt to shards by hash (a context that
holds 1/2000 of all tokens is split over all shards), each shard's counts
become one trie in a task, and that task answers the queries of all texts.

A trie has two levels in memory-mapped Elias-Fano sequences: the contexts,
monotone pointers to their successors, and the successors' word codes, offset by the
rank of their context so that the whole level is monotone. Each successor
carries the quantised probability c(u, v) / (c(u) + MU). A query finds its context,
then searches the successor among that context's own pointers.

Texts are tokenised once, into blocks of about ``BLOCK`` tokens that hold word
numbers local to the block. A block sends each shard its distinct bigrams
with their training counts; the same message trains the shard and asks it.

Defined results: null and empty texts hold only the end token; rows without an id
count as training rows; repeated rows are trained and scored once each;
without training rows every word has the base probability of an unseen word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm.common import LOWER_ASCII, drop_stage, partitions, stage, text_of
from pactline.llm.elias_fano import EliasFano, mapped

MU = 32.0
BLOCK = 2_000_000  # tokens of a block
SHARD_TOKENS = 2_000_000  # tokens for each shard
HOT_SHARE = 2000  # a context with 1/2000 of all tokens is split
CODE_BITS = 40  # of a successor's word hash, told apart only within its context
STEP = 2.0 ** -12  # of the quantised log10 probabilities
START, END = np.uint64(1), np.uint64(2)
MIX = np.uint64(0x9E3779B97F4A7C15)

BLOCKS = ("block string, doc_ids array<long>, held array<boolean>, lengths binary, sequence binary, words binary, counts binary, "
          "trained long, heavy array<struct<word: long, n: long>>")


def _shard_of(context: np.ndarray, code: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each bigram: by context, and by successor too if the context is hot."""
    key = np.where(np.isin(context, hot), context ^ (code * MIX), context)
    key = (key ^ (key >> np.uint64(31))) * MIX
    return ((key >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def tokenize_blocks(docs: DataFrame) -> DataFrame:
    """Texts as blocks: per token its word's place in the block's sorted word hashes; each document ends with END."""
    names = [c.split()[0].rstrip(":") for c in ("block", "doc_ids", "held", "lengths", "sequence", "words", "counts", "trained", "heavy")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        seen: dict[bytes, int] = {}
        hashes: list[int] = []
        ids: list[int | None] = []
        held: list[bool] = []
        parts: list[np.ndarray] = []
        size = 0

        def number(word: bytes) -> int:
            at = seen[word] = len(hashes)
            hashes.append(max(3, xxhash.xxh3_64_intdigest(word)))
            return at

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(p) + 1 for p in parts], np.uint32)
            local = np.full(int(lengths.sum()), len(hashes), np.int64)  # END unless a word is put there
            word_places = np.ones(len(local), bool)
            word_places[np.cumsum(lengths) - 1] = False
            if parts:
                local[word_places] = np.concatenate(parts)
            words, place = np.unique(np.array([*hashes, int(END)], np.uint64), return_inverse=True)
            sequence = place[local].astype(np.uint32)
            training = np.repeat(~np.array(held, bool), lengths)
            counts = np.bincount(sequence[training], minlength=len(words)).astype(np.uint32)
            often = np.bincount(sequence, minlength=len(words))
            heavy = np.flatnonzero(often >= max(1, len(sequence) // HOT_SHARE))
            row = (f"{task}-{made}", ids, held, lengths.tobytes(), sequence.tobytes(), words.tobytes(), counts.tobytes(), int(training.sum()),
                   [{"word": int(words[k].view(np.int64)), "n": int(often[k])} for k in heavy])
            kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 4, pa.int64(), pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = text.as_py().translate(LOWER_ASCII).split()
                parts.append(np.fromiter((seen[w] if w in seen else number(w) for w in found), np.int64, len(found)))
                ids.append(doc)
                held.append(out)
                size += len(found) + 1
                if size >= BLOCK:
                    yield flush()
                    made, size, seen, hashes, ids, held, parts = made + 1, 0, {}, [], [], [], []
        if ids:
            yield flush()

    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held"), text_of(docs).cast("binary").alias("t")).mapInArrow(run, BLOCKS)


def _bigrams(sequence: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, successor) pairs, both as places in the words (START: their number), and each token's pair."""
    before = np.empty(len(sequence), np.int64)
    before[1:] = sequence[:-1]
    before[np.cumsum(lengths) - lengths] = len(words)
    pairs, own = np.unique(before * len(words) + sequence, return_inverse=True)
    return pairs // len(words), pairs % len(words), own


def _routes(context: np.ndarray, successor: np.ndarray, words: np.ndarray, hot: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context hash, successor code and shard of each distinct pair."""
    hashes = np.append(words, START)[context]
    code = words[successor] >> np.uint64(64 - CODE_BITS)
    code = np.where(words[successor] == END, np.uint64(0), np.maximum(code, np.uint64(1)))
    return hashes, code, _shard_of(hashes, code, hot, shards)


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["sequence"], np.uint32).astype(np.int64), np.frombuffer(row["lengths"], np.uint32).astype(np.int64),
            np.frombuffer(row["words"], np.uint64), np.frombuffer(row["counts"], np.uint32))


def send_bigrams(blocks: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    """One row per block and shard: its contexts, how many successors each has, their codes and training counts."""
    names = ["shard", "block", "contexts", "degrees", "codes", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sequence, lengths, words, _ = _unpack(row)
                context, successor, own = _bigrams(sequence, lengths, words)
                training = np.repeat(~np.array(row["held"], bool), lengths)
                count = np.bincount(own[training], minlength=len(context))
                hashes, code, shard = _routes(context, successor, words, hot, shards)
                order = np.lexsort((code, hashes, shard))
                edges = np.searchsorted(shard[order], np.arange(shards + 1))
                for s in range(shards):
                    at = order[edges[s]: edges[s + 1]]
                    if at.size:
                        contexts, degrees = np.unique(hashes[at], return_counts=True)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([s], pa.int32()), pa.array([row["block"]]), pa.array([contexts.tobytes()], pa.binary()), pa.array([degrees.astype(np.uint32).tobytes()], pa.binary()),
                            pa.array([_short(code[at])], pa.binary()), pa.array([count[at].astype(np.uint32).tobytes()], pa.binary())], names=names)

    return blocks.select("block", "held", "lengths", "sequence", "words", "counts").mapInArrow(
        run, "shard int, block string, contexts binary, degrees binary, codes binary, counts binary")


def _short(codes: np.ndarray) -> bytes:
    return np.ascontiguousarray(codes).view(np.uint8).reshape(-1, 8)[:, : CODE_BITS // 8].tobytes()


def _long(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) * 8 // CODE_BITS, 8), np.uint8)
    out[:, : CODE_BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, CODE_BITS // 8)
    return out.reshape(-1).view(np.uint64)


class Trie:
    """Contexts, pointers and successors of one shard, from sorted distinct bigrams with positive counts."""

    def __init__(self, contexts: np.ndarray, codes: np.ndarray, counts: np.ndarray, totals: dict[int, int]) -> None:
        own, first = np.unique(contexts, return_index=True)
        rank = np.repeat(np.arange(len(own)), np.diff(np.append(first, len(contexts))))
        self.n = len(own)
        total = np.bincount(rank, counts, minlength=self.n).astype(np.int64)
        for k in np.flatnonzero(np.isin(own, np.array(list(totals), np.uint64))):
            total[k] = totals[int(own[k])]
        self.contexts = EliasFano(own, 1 << 64)
        self.pointers = EliasFano(np.append(first, len(contexts)), len(contexts) + 1)
        self.successors = EliasFano(codes + (rank.astype(np.uint64) << np.uint64(CODE_BITS)), self.n << CODE_BITS)
        self.totals = mapped(total)
        # quantised downwards, so that no context's probabilities sum to more than 1
        share = -np.log10(counts / (total[rank] + MU))
        self.values = mapped(np.minimum(65535, np.ceil(share / STEP) + 1).astype(np.uint16))

    def query(self, contexts: np.ndarray, degrees: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quantised probability of each successor (0: unseen), and the total of each context."""
        found = np.zeros(len(codes), np.uint16)
        totals = np.zeros(len(contexts), np.int64)
        if not self.n:
            return found, totals
        at = self.contexts.successor(np.zeros(len(contexts), np.int64), np.full(len(contexts), self.n), contexts)
        known = at < self.n
        known[known] = self.contexts[at[known]] == contexts[known]
        totals[known] = self.totals[at[known]]
        rows = np.flatnonzero(np.repeat(known, degrees))
        rank = np.repeat(at, degrees)[rows]
        low, high = self.pointers[rank].astype(np.int64), self.pointers[rank + 1].astype(np.int64)
        value = codes[rows] + (rank.astype(np.uint64) << np.uint64(CODE_BITS))
        place = self.successors.successor(low, high, value)
        hit = place < high
        hit[hit] = self.successors[place[hit]] == value[hit]
        found[rows[hit]] = self.values[place[hit]]
        return found, totals


def answer_shards(messages: DataFrame, totals: dict[int, int]) -> DataFrame:
    """Build each shard's trie and answer every block's message; rows come sorted by shard. ``distinct`` counts a shard's own known contexts once."""
    names = ["block", "shard", "found", "totals", "distinct"]
    split = np.array(list(totals), np.uint64)

    def solve(shard: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        contexts = [np.frombuffer(r["contexts"], np.uint64) for r in rows]
        degrees = [np.frombuffer(r["degrees"], np.uint32).astype(np.int64) for r in rows]
        codes = [_long(r["codes"]) for r in rows]
        u = np.concatenate([np.repeat(c, d) for c, d in zip(contexts, degrees, strict=True)])
        v, n = np.concatenate(codes), np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in rows]).astype(np.int64)
        seen = np.flatnonzero(n)
        order = seen[np.lexsort((v[seen], u[seen]))]
        u, v, n = u[order], v[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])) if len(u) else np.zeros(0, np.int64)
        trie = Trie(u[first], v[first], np.add.reduceat(n, first) if len(u) else n, totals)
        own = int((~np.isin(np.unique(u[first]), split)).sum())
        for k, r in enumerate(rows):
            found, total = trie.query(contexts[k], degrees[k], codes[k])
            yield pa.RecordBatch.from_arrays([pa.array([r["block"]]), pa.array([shard], pa.int32()), pa.array([found.tobytes()], pa.binary()),
                                              pa.array([total.tobytes()], pa.binary()), pa.array([0 if k else own], pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != now and rows:
                    yield from solve(now, rows)
                    rows = []
                now = row["shard"]
                rows.append(row)
        if rows:
            yield from solve(now, rows)

    return messages.mapInArrow(run, "block string, shard int, found binary, totals binary, distinct long")


def score_blocks(blocks: DataFrame, answers: DataFrame, totals: dict[int, int], shards: int, n_train: int, vocabulary: int, train_docs: int) -> DataFrame:
    """Scores of every document, from its block and the answers to it."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    hot = np.array(list(totals), np.uint64)
    scale = n_train + 0.5 * (vocabulary + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                sequence, lengths, words, _ = _unpack(row)
                context, successor, own = _bigrams(sequence, lengths, words)
                hashes, code, shard = _routes(context, successor, words, hot, shards)
                order = np.lexsort((code, hashes, shard))
                found = np.zeros(len(context), np.uint16)
                # contexts get their totals by place: words, then START
                count = np.zeros(len(words) + 1, np.int64)
                edges = np.searchsorted(shard[order], np.arange(shards + 1))
                for answer in row["answers"]:
                    mine = order[edges[answer["shard"]]: edges[answer["shard"] + 1]]
                    found[mine] = np.frombuffer(answer["found"], np.uint16)
                    firsts = np.flatnonzero(np.concatenate([[True], hashes[mine][1:] != hashes[mine][:-1]]))
                    count[context[mine[firsts]]] = np.frombuffer(answer["totals"], np.int64)
                for k, word in enumerate(hot):
                    if word == START:
                        count[len(words)] = totals[int(word)]
                    elif (place := np.searchsorted(words, word)) < len(words) and words[place] == word:
                        count[place] = totals[int(word)]
                count[np.searchsorted(words, END)] = train_docs
                unigram = (count[:-1] + 0.5) / scale
                seen = np.where(found > 0, 10.0 ** (-(found.astype(float) - 1) * STEP), 0.0)
                rest = MU / (count[context] + MU)
                logs = np.log10(seen + rest * unigram[successor])
                starts = np.cumsum(lengths) - lengths
                sums = lambda x: np.add.reduceat(x, starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(lengths), pa.array(sums((count[:-1] > 0).astype(np.int64)[sequence])),
                    pa.array(np.full(len(lengths), n_train)), pa.array(sums(np.log10(unigram)[sequence])), pa.array(sums(logs[own]))], names=names)

    gathered = stage(answers.sparkSession, answers.groupBy("block").agg(F.collect_list(F.struct("shard", "found", "totals")).alias("answers")), "lm-gathered")
    whole = blocks.select("block", "doc_ids", "held", "lengths", "sequence", "words", "counts").join(gathered, "block")
    return whole.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    blocks = stage(spark, tokenize_blocks(docs), "lm-blocks")
    sizes = blocks.agg(F.sum("trained").alias("n"), F.sum(F.size("doc_ids")).alias("docs"),
                       F.sum(F.size(F.filter("held", lambda x: ~x))).alias("train_docs"), F.sum(F.octet_length("sequence") / 4).alias("tokens")).first()
    n_train, train_docs, tokens = int(sizes["n"] or 0), int(sizes["train_docs"] or 0), int(sizes["tokens"] or 0)
    shards = max(1, -(-tokens // SHARD_TOKENS), partitions(spark) // 4)
    # at most HOT_SHARE words hold 1/HOT_SHARE of all tokens
    hot = blocks.select(F.explode("heavy").alias("x")).groupBy("x.word").agg(F.sum("x.n").alias("n")).where(F.col("n") >= max(1, tokens // HOT_SHARE)).orderBy(F.desc("n"), "word").limit(HOT_SHARE)
    words = np.array([int(START), *(r["word"] & 0xFFFFFFFFFFFFFFFF for r in hot.collect() if r["word"] != int(END))], np.uint64)

    def count_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, count = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["counts"], np.uint32)
                at = np.flatnonzero(np.isin(own, words))
                yield pa.RecordBatch.from_arrays([pa.array(own[at].view(np.int64)), pa.array(count[at].astype(np.int64))], names=["word", "n"])

    exact = blocks.select("words", "counts").mapInArrow(count_hot, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    totals = {int(w): 0 for w in words} | {r["word"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in exact} | {int(START): train_docs}
    messages = send_bigrams(blocks, words, shards).repartition(min(shards, 4 * partitions(spark)), "shard").sortWithinPartitions("shard", "block")
    answers = stage(spark, answer_shards(messages, totals), "lm-answers")
    distinct = answers.agg(F.sum("distinct")).first()[0] or 0
    vocabulary = int(distinct) + sum(1 for w, n in totals.items() if n and w != int(START)) + (1 if train_docs else 0)
    out = score_blocks(blocks, answers, totals, shards, n_train, vocabulary, train_docs)
    drop_stage(spark, answers)
    return out


def op5_lm(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return score_documents(spark, docs)
