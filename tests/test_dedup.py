"""Keep-best dedup: order directions, null placement, ties, null keys."""

from datetime import datetime

from pyspark.sql import functions as F

from pactline.contract import KeepBest, shipped_contract
from pactline.operators.dedup import keep_best
from pactline.plans import stages
from tests.helpers import mapped

DEDUP = shipped_contract().best


def test_keeps_latest_export(spark, records):
    older = records[0]
    newer = dict(older, exported_at="2026-08-16T20:00:00-05:00", interaction_result="actualizado")
    out = stages.deduped(mapped(spark, [older, newer]), shipped_contract()).collect()
    assert len(out) == 1 and out[0].interaccion_resultado == "actualizado"


def test_distinct_keys_survive(spark, records):
    assert stages.deduped(mapped(spark, records), shipped_contract()).count() == 2


def test_disabled_or_keyless_keeps_everything(spark, records):
    m = mapped(spark, records + records)
    assert keep_best(m, {"enabled": False}).count() == 4
    assert keep_best(m, {"enabled": True, "record_key": []}).count() == 4
    assert keep_best(m, None).count() == 4


def test_string_order_type_covers_first_column_only():
    def order(**block):
        return KeepBest.parse({"enabled": True, "record_key": ["k"], **block}).order

    assert order(order_by=["a", "b"], order_type="desc") == (("a", True), ("b", False))
    assert order(order_by=["a", "b"], order_type=["ASC", "desc"]) == (("a", False), ("b", True))
    assert order(order_by=["a"], order_type=[]) == (("a", False),)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "source_path string, k string, v bigint, w string")


def test_descending_puts_nulls_first(spark):
    df = _frame(spark, [("p1", "a", 5, None), ("p2", "a", None, None), ("p3", "a", 9, None)])
    out = keep_best(df, {"enabled": True, "record_key": ["k"], "order_by": ["v"], "order_type": "desc"})
    assert out.first().source_path == "p2"


def test_ascending_puts_nulls_last(spark):
    df = _frame(spark, [("p1", "a", None, None), ("p2", "a", 7, None), ("p3", "a", 3, None)])
    out = keep_best(df, {"enabled": True, "record_key": ["k"], "order_by": ["v"], "order_type": "asc"})
    assert out.first().source_path == "p3"


def test_exact_tie_keeps_first_in_listing_order(spark):
    df = _frame(spark, [("p9", "a", 1, None), ("p1", "a", 1, None), ("p5", "a", 1, None)])
    out = keep_best(df, {"enabled": True, "record_key": ["k"], "order_by": ["v"], "order_type": "desc"})
    assert out.first().source_path == "p1"


def test_null_keys_form_one_group(spark):
    df = _frame(spark, [("p1", None, 1, None), ("p2", None, 2, None), ("p3", "a", 1, None)])
    out = keep_best(df, {"enabled": True, "record_key": ["k"], "order_by": ["v"], "order_type": "desc"})
    assert sorted(r.source_path for r in out.collect()) == ["p2", "p3"]


def test_multi_column_mixed_directions(spark):
    df = _frame(spark, [("p1", "a", 1, "x"), ("p2", "a", 1, "z"), ("p3", "a", 2, "a"), ("p4", "a", 1, None)])
    spec = {"enabled": True, "record_key": ["k"], "order_by": ["v", "w"], "order_type": ["asc", "desc"]}
    assert keep_best(df, spec).first().source_path == "p4"  # v asc -> 1s; w desc -> null first
    spec = {"enabled": True, "record_key": ["k"], "order_by": ["v", "w"], "order_type": ["asc"]}
    assert keep_best(df, spec).first().source_path == "p1"  # w defaults to asc, nulls last


def test_empty_order_keeps_first_row(spark):
    df = _frame(spark, [("p2", "a", 1, None), ("p1", "a", 2, None)])
    assert keep_best(df, {"enabled": True, "record_key": ["k"]}).first().source_path == "p1"


def test_skewed_key_is_trimmed_before_the_shuffle(spark):
    """A key holding most rows: the plan limits per key map side (WindowGroupLimit)."""
    df = spark.range(0, 20000).select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("source_path"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"), F.lit(None).cast("string").alias("w"))
    out = keep_best(df, {"enabled": True, "record_key": ["k"], "order_by": ["v"], "order_type": "desc"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert out.where(F.col("k") == "hot").first().v == 19998
    assert out.count() == 20000 - 6667 + 1


def test_dedup_order_is_on_timestamps_not_text(spark, records):
    a = dict(records[0], exported_at="2026-08-16T23:59:00-05:00")
    b = dict(records[0], exported_at="2026-08-17T00:30:00+00:00")  # earlier instant, larger text
    out = stages.deduped(mapped(spark, [a, b]), shipped_contract()).first()
    assert out.interaccion_fecha_fin == datetime(2026, 8, 17, 4, 59)


def test_unknown_key_column_makes_one_group(spark):
    df = _frame(spark, [("p2", "a", 1, None), ("p1", "b", 2, None), ("p3", "c", 9, None)])
    out = keep_best(df, {"enabled": True, "record_key": ["nope"], "order_by": ["v", "also_nope"], "order_type": "desc"})
    assert [r.source_path for r in out.collect()] == ["p3"]
