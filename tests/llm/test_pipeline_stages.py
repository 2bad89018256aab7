"""Each pipeline stage against a brute-force version, and the whole pipeline, on planted and awkward documents."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from pactline.llm.decontamination import words_of
from tests.llm.helpers import PASSAGE, awkward_docs, empty_docs

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, _row string, _doc long, _tid long, drops string, row int, items string"
STAGES = dict(corpus_pipeline.STAGES)


def planted(spark, workdir):
    """Clean documents, exact and near copies, repeated lines, benchmark passages and toxic ones; tables beside them."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(rng.choices(words, k=rng.randint(60, 90))) for _ in range(120)]
    texts += [texts[0], texts[0], texts[1] + " end", "start " + texts[2], texts[3].replace(" ", "  ", 1)]
    texts += [f"{texts[i]}\na line that many documents share, number one\nshort\n{texts[i + 1]}" for i in (10, 20, 30)]
    texts += [f"{texts[40]} {PASSAGE}", PASSAGE.upper(), "", None]
    texts += [f"you are a vile stupid idiot {' '.join(rng.choices(words, k=8))}" for _ in range(60)]
    rows = [(i, t, "en", "s", None if t is None else len(t), "r", 1, 2, "d", 3, "i") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, EXTRA)
    first_toxic = len(texts) - 60
    labels = [(i, 1, int(i >= first_toxic)) for i in range(len(texts))]
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{workdir}/labels.parquet")
    spark.createDataFrame([("item", PASSAGE), (None, texts[50])], "item_id string, text string").write.parquet(f"{workdir}/benchmark.parquet")
    docs.write.parquet(f"{workdir}/documents.parquet")
    return docs, {r[0]: r[1] for r in rows}, first_toxic


def run_stage(spark, name, docs, workdir):
    out = STAGES[name](spark, docs, workdir)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert all((r["_row"], r["_doc"], r["_tid"], r["drops"], r["row"], r["items"]) == ("r", 1, 2, "d", 3, "i") for r in got.values())
    return got


def test_toxicity_stage(spark, workdir):
    docs, texts, first_toxic = planted(spark, workdir)
    kept = run_stage(spark, "toxicity", docs, workdir)
    assert set(kept) == {i for i in texts if i < first_toxic}


def test_line_stage(spark, workdir):
    docs, texts, _ = planted(spark, workdir)
    kept = run_stage(spark, "line_dedup", docs, workdir)

    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < 16 or abs(len(a) - len(b)) > 1:
            return False
        a, b = sorted((a, b), key=len)
        return any(a[:i] + (a[i + 1:] if len(a) == len(b) else a[i:]) == b[:i] + b[i + 1:] for i in range(len(b)))

    seen = []
    for i, text in texts.items():
        lines = []
        for line in (text or "").split("\n"):
            if not line or not any(near(line, s) for s in seen):
                lines.append(line)
            seen += [line] if line else []
        assert kept[i]["text"] == (None if text is None else "\n".join(lines))
        assert kept[i]["n_chars"] == (None if text is None else len(kept[i]["text"]))


def test_near_duplicate_stage(spark, workdir):
    docs, texts, _ = planted(spark, workdir)
    kept = set(run_stage(spark, "near_dedup", docs, workdir))
    sets = {}
    for i, text in texts.items():
        words = (text or "").lower().split()
        sets[i] = {tuple(words[k: k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    root = {i: i for i in texts}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in texts:
        for j in texts:
            if i < j and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert kept == {i for i in texts if find(i) == i}
    assert len(kept) < len(texts) - 4


def test_decontamination_stage(spark, workdir):
    docs, texts, _ = planted(spark, workdir)
    kept = set(run_stage(spark, "decontaminate", docs, workdir))
    windows = set()
    for item in (PASSAGE, texts[50]):
        words = words_of(item.encode())
        windows |= {tuple(words[i: i + 13]) for i in range(len(words) - 12)}
    expected = set()
    for i, text in texts.items():
        words = words_of((text or "").encode())
        hit = {p for k in range(len(words) - 12) if tuple(words[k: k + 13]) in windows for p in range(k, k + 13)}
        if not hit or 20 * len(hit) < len(words):
            expected.add(i)
    assert kept == expected and 50 not in kept


def test_the_whole_pipeline(spark, workdir):
    docs, texts, first_toxic = planted(spark, workdir)
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = spark.createDataFrame(stage(spark, before, workdir).collect(), EXTRA)
    expected = corpus_pipeline.packing(spark, before, workdir)
    got = corpus_pipeline.run(spark, workdir)
    assert got.columns == expected.columns
    pieces = lambda df: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert pieces(got) == pieces(expected)
    assert not {r["doc_id"] for r in got.collect()} & set(range(first_toxic, len(texts)))


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_awkward_documents(spark, workdir, empty):
    docs, rows = awkward_docs(spark)
    docs = empty_docs(spark) if empty else docs
    spark.createDataFrame([] if empty else [(1, 1, 0), (2, 1, 1), (None, 1, 1)], "doc_id long, quality long, toxic long").write.parquet(f"{workdir}/labels.parquet")
    spark.createDataFrame([] if empty else [(None, None), ("a", "")], "item_id string, text string").write.parquet(f"{workdir}/benchmark.parquet")
    sizes = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, workdir)
        assert out.columns == docs.columns
        sizes[name] = out.count()
    n = 0 if empty else len(rows)
    assert sizes["line_dedup"] == sizes["decontaminate"] == n
    assert sizes["near_dedup"] < n or empty
