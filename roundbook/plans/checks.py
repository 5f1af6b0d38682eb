"""Plan checks: read a DataFrame's physical plan the way a user would, via
``explain`` text, and assert properties the operators promise."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The ``explain(mode)`` output as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def assert_no_nested_loop(df: DataFrame) -> None:
    """No nested-loop or cartesian join anywhere in the plan."""
    text = plan_text(df)
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct"):
        if bad in text:
            raise AssertionError(f"plan contains {bad}")


def assert_no_python_udf(df: DataFrame) -> None:
    """No row-at-a-time Python UDF (``BatchEvalPython``) on the query path."""
    text = plan_text(df)
    if "BatchEvalPython" in text:
        raise AssertionError("plan evaluates a row-at-a-time Python UDF")


def pushed_filters(df: DataFrame) -> list[str]:
    """The ``PushedFilters`` lines of every scan in the plan."""
    return [line.strip() for line in plan_text(df).splitlines() if "PushedFilters" in line]


def read_schemas(df: DataFrame) -> list[str]:
    """The ``ReadSchema`` lines: which columns each scan actually reads."""
    return [line.strip() for line in plan_text(df).splitlines() if "ReadSchema" in line]
