"""Differential test of the strict document parser against Python's json.loads."""

import json
import random

from pactline.sources.documents import INVALID_JSON, NOT_OBJECT, OK, parse_documents

FIELDS = ["a", "b", "c"]


def _value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind == 0:
        return rng.choice([None, True, False])
    if kind == 1:
        return rng.randint(-10**12, 10**12)
    if kind == 2:
        return rng.choice([0.5, -1.25, 3.0e10, 1e-7])
    if kind in (3, 4):
        return "".join(rng.choice("abcñé \\\"/\t\n{}[],:😀") for _ in range(rng.randint(0, 12)))
    if kind in (5, 6):
        return {k: _value(rng, depth + 1) for k in rng.sample(FIELDS + ["x", "y"], rng.randint(0, 4))}
    return [_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]


def _document(rng):
    base = json.dumps(_value(rng) if rng.random() < 0.2 else {k: _value(rng) for k in rng.sample(FIELDS, 3)},
                      ensure_ascii=rng.random() < 0.5)
    action = rng.randrange(10)
    if action == 0:
        return base[: rng.randint(0, max(0, len(base) - 1))]
    if action == 1:
        return base + rng.choice(["]", "}", " junk", ",", "\n" + base, "], [1]"])
    if action == 2:
        return rng.choice([" ", "\n", "\t"]) + base + rng.choice([" ", "\r\n", ""])
    return base


def _python_status(text):
    try:
        value = json.loads(text)
    except ValueError:
        return INVALID_JSON
    return OK if isinstance(value, dict) else NOT_OBJECT


def test_statuses_and_values_match_json_loads(spark):
    rng = random.Random(11)
    docs = [_document(rng) for _ in range(3000)]
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "source_path string, text string")
    got = {int(r.source_path): r for r in parse_documents(df, FIELDS).collect()}
    for i, text in enumerate(docs):
        expected = _python_status(text)
        assert got[i].status == expected, text
        if expected == OK:
            obj = json.loads(text)
            for f in FIELDS:
                value = getattr(got[i].rec, f)
                if obj.get(f) is None:
                    assert value is None, (text, f)
                elif isinstance(obj[f], str):
                    assert value == obj[f], (text, f)
                else:
                    assert json.loads(value) == obj[f], (text, f)
