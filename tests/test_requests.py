from pactline.contract import shipped_endpoints
from pactline.operators.requests import build_requests, conversation_ids
from tests.helpers import landed_record, mapped

IDS = [landed_record(n)["cloud_conversation_id"] for n in (1, 2)]


def test_url_template_is_filled(spark):
    ids = spark.createDataFrame([(i,) for i in IDS], "conversation_id string")
    rows = build_requests(ids, shipped_endpoints()).orderBy("conversation_id").collect()
    assert len(rows) == 2
    first = rows[0]
    assert first.conversation_id == IDS[0]
    assert first.endpoint == "conversations_surveys"
    assert first.request_context.url == f"/api/v2/quality/conversations/{IDS[0]}/surveys"
    assert first.request_context.method == "GET"
    assert first.request_context.result_data == "state"


def test_no_ids_no_requests(spark):
    ids = spark.createDataFrame([], "conversation_id string")
    assert build_requests(ids, shipped_endpoints()).count() == 0


def test_every_endpoint_for_every_id(spark):
    ids = spark.createDataFrame([(i,) for i in IDS], "conversation_id string")
    endpoints = {"e1": {"url": "/a/{conversationId}"}, "e2": {"url": "/b/{conversationId}/c", "method": "POST"}}
    rows = build_requests(ids, endpoints).collect()
    assert len(rows) == 4
    assert {r.request_context.url for r in rows if r.endpoint == "e2"} == {f"/b/{i}/c" for i in IDS}
    assert all(r.request_context.type is None for r in rows)


def test_ids_are_distinct_nonempty_and_taken_before_dedup(spark, records):
    dup = dict(records[0], exported_at="2026-08-17T00:00:00-05:00", cloud_conversation_id="  other-id ")
    blank = dict(records[1], cloud_conversation_id="", trace_id="zz")
    ids = {r.conversation_id for r in conversation_ids(mapped(spark, records + [dup, blank])).collect()}
    assert ids == set(IDS) | {"other-id"}
