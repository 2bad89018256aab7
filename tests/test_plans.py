"""Plan properties that must hold for every registered query (scale rules)."""

import re

import pytest

from pactline.plans.queries import all_queries

SF = "/root/testdata/sf0.001"
STORAGE = {"partition_roundtrip", "declared_types", "atts_roundtrip", "incremental_ingest", "run_manifest",
           "landing_quarantine"}
NAMES = sorted(n for n in all_queries() if n not in STORAGE)


def _final_plan(df) -> str:
    """The executed plan after running it (AQE's final plan, with codegen stages)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


@pytest.fixture(scope="module")
def plans(spark):
    return {n: _final_plan(all_queries()[n](spark, SF)) for n in NAMES}


@pytest.mark.parametrize("name", NAMES)
def test_no_pairwise_joins_and_no_row_python(plans, name):
    plan = plans[name]
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert banned not in plan, f"{name}: {banned}"


def test_keep_best_is_trimmed_before_its_shuffle(plans):
    windowed = {n: p for n, p in plans.items() if "Window " in p or "Window [" in p}
    assert windowed
    for name, plan in windowed.items():
        # The partial group limit must sit below (i.e. before) an exchange.
        assert re.search(r"Exchange[^\n]*\n(?:[^\n]*\n)*?[^\n]*WindowGroupLimit[^\n]*Partial", plan), name


def test_only_the_exact_mode_uses_python(plans):
    with_python = {n for n, p in plans.items() if "ArrowEvalPython" in p}
    assert with_python == {"remove_accents_exact"}


def test_cleaning_projections_stay_in_whole_stage_codegen(plans):
    # The accents step starts with its ASCII test (the long translate literal is cut from plan strings).
    lines = [(n, line) for n, p in plans.items() for line in p.splitlines() if "Project [" in line and "octet_length(" in line]
    assert lines
    for name, line in lines:
        assert line.lstrip(" +-:").startswith("*("), f"{name}: {line[:120]}"
