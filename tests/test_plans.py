"""Physical-plan properties of the registered queries (read from explain())."""

import pytest

from conftest import SF_SMALL
from roundbook import queries as own
from roundbook.plans.checks import assert_no_nested_loop, assert_no_python_udf, plan_text

TOP_K = ["organizations_by_category", "top_funded", "top_investors", "recent_rounds", "quarterly_trend"]


@pytest.mark.parametrize("name", TOP_K)
def test_top_k_plans_as_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in plan_text(own.QUERIES[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", sorted(own.QUERIES))
def test_no_nested_loop_and_no_row_udf(spark, name):
    df = own.QUERIES[name](spark, SF_SMALL)
    assert_no_nested_loop(df)
    assert_no_python_udf(df)


def test_plain_rollup_has_no_window_or_python(spark):
    text = plan_text(own.QUERIES["funding_text"](spark, SF_SMALL))
    assert "Window" not in text and "MapInPandas" not in text and "ArrowEvalPython" not in text
