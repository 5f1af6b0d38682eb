"""Quarter labels and quarter series (C5-C9) as Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the founding date assumed when a company has none.
DEFAULT_FOUNDED = dt.date(1900, 1, 1)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quarter_label(d: Column | str) -> Column:
    """``"YYYY Qn"`` of a date; NULL for NULL."""
    d = _col(d)
    return F.concat(F.year(d).cast("string"), F.lit(" Q"), F.quarter(d).cast("string"))


def quarter_index(d: Column | str) -> Column:
    """Dense quarter number ``year*4 + quarter - 1``; orders quarters chronologically."""
    d = _col(d)
    return F.year(d) * 4 + F.quarter(d) - 1


def label_of_index(i: Column | str) -> Column:
    """Inverse of :func:`quarter_index` as a ``"YYYY Qn"`` label."""
    i = _col(i)
    return F.concat(F.floor(i / 4).cast("bigint").cast("string"), F.lit(" Q"), (F.pmod(i, F.lit(4)) + 1).cast("string"))


def effective_date(closed_on: Column | str, announced_on: Column | str) -> Column:
    """Date a round counts in: ``closed_on`` else ``announced_on``."""
    return F.coalesce(_col(closed_on), _col(announced_on))


def founded_or_default(founded_on: Column | str) -> Column:
    """Founding date, 1900-01-01 when missing."""
    return F.coalesce(_col(founded_on), F.lit(DEFAULT_FOUNDED))


def parse_quarter(label: Column | str) -> Column:
    """Parse ``"YYYY Qn"`` or ``"Qn-YY"`` into ``struct(year, q)``.

    Both patterns are anchored at the start only (a prefix match). Two-digit
    years up to 50 are 20YY, others 19YY. Anything else gives ``(0, 0)``.
    """
    s = _col(label)
    new = s.rlike(r"^[0-9]{4} Q[0-9]+")
    old = s.rlike(r"^Q[0-9]+-[0-9]+")
    y_new = F.regexp_extract(s, r"^([0-9]{4}) Q([0-9]+)", 1).try_cast("int")
    q_new = F.regexp_extract(s, r"^([0-9]{4}) Q([0-9]+)", 2).try_cast("int")
    q_old = F.regexp_extract(s, r"^Q([0-9]+)-([0-9]+)", 1).try_cast("int")
    yy = F.regexp_extract(s, r"^Q([0-9]+)-([0-9]+)", 2).try_cast("int")
    y_old = F.when(yy <= 50, yy + 2000).otherwise(yy + 1900)
    year = F.when(new, y_new).when(old, y_old).otherwise(F.lit(0))
    q = F.when(new, q_new).when(old, q_old).otherwise(F.lit(0))
    return F.struct(year.alias("year"), q.alias("q"))


def quarter_series(start: Column | str, end: Column | str) -> Column:
    """Quarter labels visited by stepping from ``start`` to ``end``.

    The walk starts at ``start`` itself, then goes to the first day of the
    month three months later, and so on while the date is ``<= end``. It
    therefore starts in the founding quarter and may stop one quarter short
    of ``end``'s quarter, exactly like the reference loop. Empty when
    ``start > end`` (Spark's ``sequence`` would raise there).
    """
    a, b = _col(start), _col(end)
    steps = F.sequence(F.trunc(a, "MM"), b, F.expr("INTERVAL 3 MONTHS"))
    return F.when(a <= b, F.transform(steps, quarter_label)).otherwise(F.array().cast("array<string>"))


def series_span(start: Column | str, end: Column | str) -> tuple[Column, Column]:
    """``(first, last)`` quarter index of :func:`quarter_series`, both NULL when empty.

    The series is a run of consecutive quarters, so its two ends describe it
    completely; aggregating ends instead of exploding labels keeps axis
    computation O(rows) rather than O(rows x quarters).
    """
    a, b = _col(start), _col(end)
    months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    k = F.floor(months / 3).cast("int")
    last_step = F.add_months(F.trunc(a, "MM"), k * 3)
    ok = a <= b
    first = F.when(ok, quarter_index(a))
    last = F.when(ok, quarter_index(last_step))
    return first, last


def quarter_labels_between(first_index: int, last_index: int, newest_first: bool = True) -> list[str]:
    """Labels for a closed index range; the list length is last-first+1."""
    idx = range(first_index, last_index + 1)
    labels = [f"{i // 4} Q{i % 4 + 1}" for i in idx]
    return labels[::-1] if newest_first else labels
