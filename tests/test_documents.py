"""Strict whole-document JSON parsing (one object per document)."""

import pytest

from pactline.sources.documents import INVALID_JSON, INVALID_UTF8, NOT_OBJECT, OK, parse_documents, parse_binary_documents

CASES = [
    ('{"a": "x", "n": 7}', OK),
    ('  {"a": "x"}\n', OK),
    ('\ufeff{"a": "x"}', OK),
    ('{"a": "x"}\n{"a": "y"}', INVALID_JSON),
    ('{"a": "x"},{"a": "y"}', INVALID_JSON),
    ('{"a": "x"', INVALID_JSON),
    ("", INVALID_JSON),
    ("   ", INVALID_JSON),
    ("not json at all", INVALID_JSON),
    ("{'a': 'x'}", INVALID_JSON),
    ('{"a": "x"} trailing', INVALID_JSON),
    ('{"a": "x"}]', INVALID_JSON),
    ('{"a": "x"}], [{"a": "y"}', INVALID_JSON),
    ('{"a": "x"}] junk', INVALID_JSON),
    ("[1, 2]", NOT_OBJECT),
    ("[]", NOT_OBJECT),
    ('{"a": {"b": [1, {"c": null}]}}', OK),
    ("5", NOT_OBJECT),
    ("null", NOT_OBJECT),
    ('[{"a": "x"}]', NOT_OBJECT),
    ('"text"', NOT_OBJECT),
]


def test_document_statuses(spark):
    rows = [(f"d{i}", text) for i, (text, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "source_path string, text string")
    got = {r.source_path: r.status for r in parse_documents(df, ["a", "n"]).collect()}
    for i, (text, expected) in enumerate(CASES):
        assert got[f"d{i}"] == expected, text


def test_field_values_are_raw_json_text(spark):
    text = '{"a": "x", "n": 7, "b": true, "m": [{"role": "r", "content": "ñ"}], "o": {"z": 1, "a": 2}, "a": "last"}'
    df = spark.createDataFrame([("p", text)], "source_path string, text string")
    rec = parse_documents(df, ["a", "n", "b", "m", "o", "missing"]).first().rec
    assert rec.a == "last"  # duplicate keys: the last one wins
    assert rec.n == "7"
    assert rec.b == "true"
    assert rec.m == '[{"role":"r","content":"ñ"}]'
    assert rec.o == '{"z":1,"a":2}'  # key order kept
    assert rec.missing is None


def test_invalid_utf8_is_quarantined(spark):
    df = spark.createDataFrame([("p", 3, bytearray(b'{"a": "\xff\xfe"}'))], "path string, length bigint, content binary")
    assert parse_binary_documents(df, ["a"]).first().status == INVALID_UTF8


@pytest.mark.parametrize("payload", [b'{"a": "ok"}', '\ufeff{"a": "ok"}'.encode("utf-8")])
def test_binary_documents_parse(spark, payload):
    df = spark.createDataFrame([("p", len(payload), bytearray(payload))], "path string, length bigint, content binary")
    row = parse_binary_documents(df, ["a"]).first()
    assert row.status == OK and row.rec.a == "ok"
