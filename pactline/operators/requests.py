"""Conversation ids and the per-conversation API request rows.

Ids are taken from the mapped, cleaned rows *before* deduplication; null
and empty ids are dropped. Each id is paired with every configured
endpoint. The endpoint table is a small configuration document, so the
pairing is a generator over a literal array (one projection, no join and
no shuffle beyond the ``distinct``).
"""

from __future__ import annotations

import json
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.contract import CONVERSATION_ID_COLUMN

# Fixed value: placeholder filled with the conversation id.
URL_PLACEHOLDER = "{conversationId}"

REQUEST_FIELDS = ("url", "method", "type", "path", "result_data")


def conversation_ids(mapped: DataFrame, column: str = CONVERSATION_ID_COLUMN) -> DataFrame:
    """Distinct non-empty ids (partial aggregation before the shuffle)."""
    ids = F.col(column)
    return (
        mapped.where(ids.isNotNull() & (ids != F.lit("")))
        .select(ids.alias("conversation_id"))
        .distinct()
    )


def _endpoint_text(value) -> str | None:
    """Text of an endpoint setting; nested values as JSON."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False) if isinstance(value, (dict, list)) else str(value)


def build_requests(ids: DataFrame, endpoints: Mapping[str, Mapping]) -> DataFrame:
    """``(conversation_id, endpoint, endpoint_order, request_context)``."""
    if not endpoints:
        return ids.select(
            "conversation_id",
            F.lit(None).cast("string").alias("endpoint"),
            F.lit(None).cast("int").alias("endpoint_order"),
            F.lit(None).cast(f"struct<{','.join(f + ':string' for f in REQUEST_FIELDS)}>").alias("request_context"),
        ).where(F.lit(False))
    table = F.array(*[
        F.struct(
            F.lit(i).alias("endpoint_order"),
            F.lit(name).alias("endpoint"),
            *[F.lit(_endpoint_text(spec.get(f))).cast("string").alias(f) for f in REQUEST_FIELDS],
        )
        for i, (name, spec) in enumerate(endpoints.items())
    ])
    cid = F.col("conversation_id")
    paired = ids.select("conversation_id", F.inline(table))
    context = F.struct(
        F.replace(F.col("url"), F.lit(URL_PLACEHOLDER), cid).alias("url"),
        *[F.col(f).alias(f) for f in REQUEST_FIELDS[1:]],
    )
    return paired.select("conversation_id", "endpoint", "endpoint_order", context.alias("request_context"))
