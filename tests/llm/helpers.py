"""Small inputs with the awkward cases, and brute-force helpers."""

import random

PASSAGE = " ".join(f"passage{i}" for i in range(60))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, node string, _part int"


def awkward_docs(spark, seed=0, n=60):
    """Nulls, empty and very long texts, ties, repeated rows and columns whose names clash."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(n)]
    texts += [texts[0], texts[1], texts[2] + " extra", PASSAGE, f"front {PASSAGE} back", f"{PASSAGE}\n{texts[3]}"]
    texts += ["", None, " \n\t ", "For " * 400, "é" * 700, "x" * 30_000, "a\nline that repeats itself here\nline that repeats itself here"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[4]), (None, None), rows[5], rows[5], (7, "another text under the same id")]
    rng.shuffle(rows)
    return spark.createDataFrame([(d, t, None, None, None, None, None, None, None) for d, t in rows], DOCS), rows


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def texts_of(rows):
    return [(d, t or "") for d, t in rows]
