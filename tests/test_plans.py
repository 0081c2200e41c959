"""Plan checks: no Python UDF in non-ML operators, filters pushed, columns pruned, no global window."""

import re

import pytest

import __spark_entry__ as E
from data_paths import SMALL

NON_ML = ["question_stats", "numeric_summary", "multi_mode", "correlation_matrix", "category_frequencies",
          "histogram", "filter_range_category", "page_of_records", "sentiment_rows", "tfidf_terms",
          "tfidf_documents", "minmax_survey", "assign_nearest", "dominant_minority", "page_script_vars",
          "distinct_first_seen", "quality_table"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NON_ML)
def test_no_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filter_pushed_and_columns_pruned(spark):
    df = E.queries()["filter_range_category"](spark, SMALL)
    plan = _plan(df)
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert pushed, plan
    assert "c_acctbal" not in plan.split("ReadSchema:")[1].split("\n")[0]
    q = E.queries()["category_filter"](spark, SMALL)
    assert "EqualTo(o_orderstatus,F)" in _plan(q)


SPEC = re.compile(r"windowspecdefinition\((?P<first>[^,()]*(?:\([^()]*\))?[^,]*)")


@pytest.mark.parametrize("name", ["question_stats", "tfidf_terms", "histogram", "category_frequencies",
                                  "numeric_summary", "distinct_first_seen", "sentiment_by_group"])
def test_no_unpartitioned_window_over_rows(spark, name):
    df = E.queries()[name](spark, SMALL)
    df.collect()  # final adaptive plan
    seen = 0
    for line in _plan(df).splitlines():
        if "Window [" not in line:
            continue
        for m in SPEC.finditer(line):
            seen += 1
            first = m.group("first").strip()
            unpartitioned = first.startswith("specifiedwindowframe") or " ASC " in first or " DESC " in first
            # the only global windows allowed run over one row per partition (rank offsets ordered by pid)
            assert not unpartitioned or "pid" in first, line
    if name == "numeric_summary":
        assert seen > 0


@pytest.mark.parametrize("name", ["tfidf_terms", "tfidf_documents", "tfidf_conversations"])
def test_terms_are_cut_once_per_cell(spark, name):
    plan = E.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1, plan
