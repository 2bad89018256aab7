"""Differential test of timestamp parsing against Python's datetime.fromisoformat."""

import random
from datetime import datetime, timezone

from pyspark.sql import functions as F

from pactline.functions.casts import parse_timestamp


def _forms(n=2000, seed=3):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        y, mo, d = rng.randint(1970, 2100), rng.randint(1, 12), rng.randint(1, 28)
        h, mi, s = rng.randint(0, 23), rng.randint(0, 59), rng.randint(0, 59)
        frac = rng.choice(["", ".5", ",25", ".123", ".123456", ".1234567"])
        sep = rng.choice(["T", " ", "t", "x"])
        off = rng.choice(["", "Z", "z", "+00:00", "-05:00", "+05:30", "+0530", "+05", "-03:30:15", "+14:00", "UTC"])
        date = rng.choice([f"{y:04d}-{mo:02d}-{d:02d}", f"{y:04d}{mo:02d}{d:02d}"])
        time = rng.choice([f"{h:02d}:{mi:02d}:{s:02d}{frac}", f"{h:02d}:{mi:02d}", f"{h:02d}{mi:02d}{s:02d}", f"{h:02d}"])
        out.append(rng.choice([f"{date}{sep}{time}{off}", date, f"{date}{sep}{time}"]))
    return out + ["2026-02-30T10:00:00", "2026-08-16T24:00:00", "nonsense", "2026-08-16T04:05:06+25:00",
                  "2026-08-16T15:53:60", "2026-08-16T04:05:06-03:30:15", "2026-08-16T04:05:06+18:00"]


# Offsets fromisoformat reads but Java's ZoneOffset does not (beyond +-18:00,
# minute or second overflow, fractional seconds): rejected here.
EXOTIC_OFFSETS = ["2026-08-16T04:05:06+23:59", "2026-08-16T04:05:06+05:75", "2026-08-16T04:05:06-05:30:75",
                  "2026-08-16T04:05:06-03:30:15.5"]


def _python(text):
    try:
        value = datetime.fromisoformat(text)
    except ValueError:
        return None
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc).replace(tzinfo=None)


def test_parsing_matches_fromisoformat(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    texts = _forms()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.u for r in df.select("i", parse_timestamp(F.col("t"), strict=False).alias("u")).collect()}
    for i, text in enumerate(texts):
        expected = _python(text)
        if expected is None and got[i] is not None:
            # Accepted only by Spark's own cast: a zone name such as UTC.
            assert text.endswith("UTC"), text
        else:
            assert got[i] == expected, text


def test_exotic_offsets_are_rejected(spark):
    df = spark.createDataFrame([(t,) for t in EXOTIC_OFFSETS], "t string")
    assert [r.u for r in df.select(parse_timestamp(F.col("t"), strict=False).alias("u")).collect()] == [None] * 4
    assert all(_python(t) is not None for t in EXOTIC_OFFSETS)
