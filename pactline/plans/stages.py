"""Building blocks of the ingestion plan, shared by batch, streaming and queries.

documents -> parsed (status per document) -> mapped (typed, cleaned,
pre-dedup) -> deduped -> {core, atts}; mapped -> ids -> requests.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.contract import Contract
from pactline.operators.audit import RunContext
from pactline.operators.dedup import keep_best
from pactline.operators.mapping import map_records
from pactline.operators.requests import build_requests, conversation_ids
from pactline.operators.reshape import atts_frame, core_frame
from pactline.sources.documents import OK, good_documents, parse_documents


# Column of a mapped frame that lists a record's cast errors.
ERRORS = "__pactline_cast_errors__"


@dataclass(frozen=True)
class Options:
    """Knobs that change results, all off the reference's defaults only by choice.

    * ``on_cast_error``: a bad integer/timestamp fails the batch (``fail``, the
      default), becomes null (``null``), or sets its record aside with every column
      that failed, its text and the reason (``quarantine``).
    * ``accents``: ``native`` (JVM ``translate``) or ``exact`` (Arrow UDF).
    * ``honor_input_formats``: try ``columns[].input_formats`` patterns first.
    * ``json_text``: ``compact`` (JVM) or ``python`` (``json.dumps`` spacing,
      byte-identical to the original's text; Arrow UDF on json columns).
    """

    on_cast_error: str = "fail"
    accents: str = "native"
    honor_input_formats: bool = False
    json_text: str = "compact"


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") == F.lit(OK))


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") != F.lit(OK)).select("source_path", F.col("status").alias("reason"))


def parse(docs: DataFrame, contract: Contract) -> DataFrame:
    """Status of every document (good ones carry their record)."""
    return parse_documents(docs, contract.read_fields, json_fields=contract.json_fields)


def good_docs(docs: DataFrame, contract: Contract) -> DataFrame:
    """Only the good documents' records, each document parsed once."""
    return good_documents(docs, contract.read_fields, json_fields=contract.json_fields)


def mapped(records: DataFrame, contract: Contract, opts: Options = Options(), keep: tuple[str, ...] = ("source_path",)) -> DataFrame:
    """Good records ``(source_path, rec)`` -> typed, cleaned business columns; with ``quarantine``, their cast errors too."""
    if opts.on_cast_error not in ("fail", "null", "quarantine"):
        raise ValueError(f"unknown on_cast_error {opts.on_cast_error!r}")
    return map_records(records, contract, opts.on_cast_error == "fail", opts.accents, keep=keep,
                       honor_input_formats=opts.honor_input_formats, json_mode=opts.json_text,
                       errors=ERRORS if opts.on_cast_error == "quarantine" else None)


def castable(mapped_df: DataFrame) -> DataFrame:
    """The records all of whose values have their declared type."""
    return mapped_df.where(F.size(ERRORS) == 0).drop(ERRORS)


def cast_errors(mapped_df: DataFrame) -> DataFrame:
    """``(source_path, column, text, reason)``: one row per value that could not be cast."""
    return mapped_df.where(F.size(ERRORS) > 0).select("source_path", F.inline(ERRORS))


def deduped(mapped_df: DataFrame, contract: Contract) -> DataFrame:
    return keep_best(mapped_df, contract.best)


def outputs(deduped_df: DataFrame, contract: Contract, ctx: RunContext) -> tuple[DataFrame, DataFrame]:
    return core_frame(deduped_df, contract, ctx), atts_frame(deduped_df, contract, ctx)


def requests(mapped_df: DataFrame, endpoints: Mapping[str, Mapping]) -> DataFrame:
    return build_requests(conversation_ids(mapped_df), endpoints)

