"""Toxicity by a counterfactual-regularised classifier.

A logistic classifier on word and word-stem features is fitted on a bounded
sample of labelled documents (``SAMPLE`` per label, by a hash of the id). For
every identity term in a labelled sentence the term is swapped for the others
of its group, and the squared change of the score is penalised, so that a
neutral mention of a group adds nothing to a score. Feature statistics are
counted in Spark over the sample; the fit sees only the selected features.

Labels come only from rows whose crc32(doc_id as text) mod 4 is not 2;
lang, source and doc_id are never features. Every document is scored
over its whole text.

Defined results: null and empty texts get the score of no features;
repeated document rows get equal scores; labels with a null id or mark are
skipped; a doc_id labelled twice counts as toxic if any row says so; without
labels of both kinds every score is the share of toxic labels (0 if none).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm.common import drop_stage, stage, text_of

SAMPLE = 6000  # labelled documents of each kind at most
FEATURES = 20_000  # selected features at most
SIGNIFICANT = 14.0  # least log likelihood ratio of a selected feature
THRESHOLD = 0.3
STEMS = (3, 4, 5, 6, 7, 8)
#: Identity terms that are swapped within a sentence; the first of each row is the neutral mention.
IDENTITY = (
    ("people", "women", "men", "muslims", "christians", "jews", "hindus", "buddhists", "immigrants", "refugees", "gays", "lesbians", "asians", "africans", "europeans", "latinos"),
    ("person", "woman", "man", "muslim", "christian", "jew", "hindu", "buddhist", "immigrant", "refugee", "gay", "lesbian", "asian", "african", "european", "latino"),
    ("ordinary", "jewish", "islamic", "catholic", "black", "white", "disabled", "deaf", "blind", "transgender", "homosexual", "old", "young"),
    ("personnes", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés", "homosexuels"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "einwanderer", "flüchtlinge", "homosexuelle"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados", "homosexuales"),
)
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")


def features_of(word: str) -> list[str]:
    """The word and its stems (a stem ends in ``*``)."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


def document_features(text: str) -> set[str]:
    return {f for w in set(WORD.findall(text.lower())) for f in features_of(w)}


def identity_swaps(text: str) -> Counter:
    """(term, other term) of each swap the text's sentences allow, with the number of sentences."""
    groups = {t: g for g in IDENTITY for t in g}
    out: Counter = Counter()
    words = WORD.findall
    if groups.keys().isdisjoint(words(text.lower())):
        return out
    for sentence in SENTENCE.split(text.lower()):
        for term in groups.keys() & set(words(sentence)):
            out.update((term, other) for other in groups[term] if other != term)
    return out


def fit_logistic(rows: list[list[int]], labels: np.ndarray, weights: np.ndarray, n: int, pairs: list[tuple[list[int], list[int], float]],
                 ridge: float = 1.0, swap: float = 100.0, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient descent; ``pairs`` are (features, swapped features, count)."""
    flat = np.array([f for r in rows for f in r], np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    differences: list[tuple[np.ndarray, np.ndarray, float]] = []
    for a, b, count in pairs:
        own = Counter(a)
        own.subtract(b)
        at = [k for k, v in own.items() if v]
        if at:
            differences.append((np.array(at), np.array([own[k] for k in at], float), count))
    scale = swap / max(1.0, sum(c for *_, c in differences))
    total = weights.sum()

    def gradient(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        z = b + np.bincount(owner, w[flat], minlength=len(rows))
        error = weights * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / total
        g = np.bincount(flat, error[owner], minlength=n) + ridge * w / total
        for at, v, count in differences:
            g[at] += scale * count * (w[at] @ v) * v
        return g, float(error.sum())

    # a diagonal bound of the curvature gives each feature its own step; documents share it by their size
    size = np.bincount(owner, minlength=len(rows)).astype(float) + 1
    step = 1 / (np.bincount(flat, (weights * size)[owner], minlength=n) / total / 4 + ridge / total)
    bias_step = 4 * total / (weights * size).sum()
    for at, v, count in differences:
        step[at] = 1 / (1 / step[at] + scale * count * np.abs(v) * np.abs(v).sum())
    w = y = np.zeros(n)
    b = c = float(np.log((weights @ labels + 0.5) / (weights @ (1 - labels) + 0.5)))
    t = 1.0
    for _ in range(rounds):
        g, gb = gradient(y, c)
        w_new, b_new = y - step * g, c - bias_step * gb
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, c = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return w, b


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of at most ``per_label`` documents of each label, and the number of training labels of each."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    train = marks.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    counts = {int(r["toxic"]): r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for label in (0, 1):
        own = train.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        chosen = own if chosen is None else chosen.unionByName(own)
    # 2 * per_label rows at most
    known = docs.where("doc_id is not null").select("doc_id", text_of(docs).alias("text"))
    return known.join(F.broadcast(chosen), "doc_id").select("text", "toxic").distinct(), counts


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE, max_features: int = FEATURES) -> tuple[dict[str, float], float]:
    """Feature weights and bias."""
    sample, counts = training_sample(docs, labels, per_label)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([sorted(document_features(t)) for t in texts], pa.list_(pa.string()))], names=["toxic", "features"])

    held = stage(docs.sparkSession, sample.mapInArrow(extract, "toxic int, features array<string>"), "toxic-features")
    try:
        sizes = {r["toxic"]: r["n"] for r in held.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        bad, good = sizes.get(1, 0), sizes.get(0, 0)
        if not bad or not good:
            share = counts.get(1, 0) / max(1, sum(counts.values()))
            return {}, float(np.log(share / (1 - share))) if 0 < share < 1 else (30.0 if share else -30.0)
        each = held.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(
            F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).where("a + b >= 3")
        share = bad / (bad + good)
        n, a, b = F.col("a") + F.col("b"), F.col("a"), F.col("b")
        surprise = lambda seen, rate: F.when(seen > 0, seen * F.log(seen / (n * rate))).otherwise(0.0)
        ratio = 2 * (surprise(a, share) + surprise(b, 1 - share))  # log likelihood ratio
        best = each.select("f", ratio.alias("g")).where(F.col("g") >= SIGNIFICANT).orderBy(F.desc("g"), "f").limit(max_features)
        identity = {t for group in IDENTITY for t in group}
        vocabulary = {f: i for i, f in enumerate(sorted({r["f"] for r in best.collect()} | identity))}

        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [[vocabulary[f] for f in r if f in vocabulary] for r in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["toxic", "at"])

        data = held.mapInArrow(index, "toxic int, at array<int>").collect()
    finally:
        drop_stage(docs.sparkSession, held)

    def swaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(identity_swaps(text))
        a, b = [k[0] for k in found], [k[1] for k in found]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(list(found.values()), pa.int64())], names=["a", "b", "n"])

    pairs = [(*([vocabulary[f] for f in features_of(r[k]) if f in vocabulary] for k in ("a", "b")), float(r["n"]))
             for r in sample.select("text").mapInArrow(swaps, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()]
    y = np.array([r["toxic"] for r in data], float)
    weights = np.where(y == 1, counts[1] / bad, counts[0] / good)
    order = sorted(range(len(data)), key=lambda i: (data[i]["toxic"], data[i]["at"]))
    w, bias = fit_logistic([data[i]["at"] for i in order], y[order], weights[order], len(vocabulary), pairs)
    return {f: float(w[i]) for f, i in vocabulary.items() if abs(w[i]) > 1e-6}, bias


def score_texts(docs: DataFrame, model: tuple[dict[str, float], float], keep: list[str]) -> DataFrame:
    """``keep`` columns with ``score`` over whole texts."""
    weights, bias = model
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word: dict[str, tuple[str, ...]] = {}

        def known(word: str) -> tuple[str, ...]:
            found = tuple(f for f in features_of(word) if f in weights)
            if len(of_word) < 500_000:
                of_word[word] = found
            return found

        for batch in batches:
            scores = []
            for text in batch.column(n_keep):
                own: set[str] = set()
                for word in set(WORD.findall(text.as_py().lower())):
                    hit = of_word.get(word)
                    own.update(known(word) if hit is None else hit)
                z = bias + sum(weights[f] for f in sorted(own))
                scores.append(1 / (1 + float(np.exp(-max(-30.0, min(30.0, z))))))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(n_keep)), pa.array(scores, pa.float64())], names=[*keep, "score"])

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, text_of(docs).alias("_text")).mapInArrow(run, f"{kept}, score double")


def op7_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_texts(docs, train(docs, labels), ["doc_id"])
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored at or above the threshold."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return score_texts(packed, train(docs, labels), ["_row"]).where(F.col("score") < threshold).select("_row.*")
