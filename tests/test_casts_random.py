"""Differential tests of value rendering and integer parsing against Python."""

import json
import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from pactline.functions.casts import iso_text, parse_integer


def test_iso_text_matches_isoformat(spark):
    rng = random.Random(2)
    base = datetime(1970, 1, 1)
    values = [base + timedelta(seconds=rng.randint(0, 4_000_000_000), microseconds=rng.choice([0, 0, rng.randint(0, 999_999)]))
              for _ in range(2000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, ts timestamp_ntz")
    got = {r.i: r.t for r in df.select("i", iso_text(F.col("ts")).alias("t")).collect()}
    for i, v in enumerate(values):
        assert got[i] == v.replace(tzinfo=timezone.utc).isoformat()


def test_integer_parsing_matches_int_of_json_numbers(spark):
    rng = random.Random(4)
    numbers = [rng.choice([rng.randint(-10**15, 10**15), rng.uniform(-1e6, 1e6), float(rng.randint(-100, 100)),
                           rng.choice([1e3, -2.5e2, 7.999999, -0.5, 0.0])]) for _ in range(2000)]
    texts = [json.dumps(n) for n in numbers] + ["true", "false"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.v for r in df.select("i", parse_integer(F.col("t"), strict=False).alias("v")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == int(json.loads(text)), text


def test_joined_hash_matches_hashlib(spark):
    import hashlib

    from pactline.functions.hashing import sha256_joined

    rng = random.Random(9)
    alphabet = "ab#ñé中😀\t \\\"'"
    rows = [tuple(None if rng.random() < 0.2 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8)))
                  for _ in range(3)) for _ in range(1500)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string")
    got = {r.i: r.h for r in df.select("i", sha256_joined([F.col("a"), F.col("b"), F.col("c")], "#").alias("h")).collect()}
    for i, r in enumerate(rows):
        assert got[i] == hashlib.sha256("#".join(v or "" for v in r).encode("utf-8")).hexdigest()
