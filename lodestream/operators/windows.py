"""Window helpers.

``rolling`` and ``moved`` without partitions run in one task; they are for frames at the grain of days, whose number the
calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def rolling(fn, column: str, n: int, order: str = "date_day", by: list[str] | None = None) -> Column:
    """``fn`` of ``column`` over this row and the n - 1 before it; over a gap-filled calendar these are days."""
    if n < 1:
        raise ValueError("a window has at least one row")
    return fn(column).over(Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(1 - n, 0))


def moved(column: str, n: int = 1, order: str = "date_day", by: list[str] | None = None) -> Column:
    """The value n rows before."""
    return F.lag(column, n).over(Window.partitionBy(*(by or [])).orderBy(order))


def carried(column: str, by: str, order: list[str]) -> Column:
    """The last value so far that is not null, this row's included."""
    return F.last(column, ignorenulls=True).over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def following(column: str, by: str, order: list[str]) -> Column:
    return F.lead(column).over(Window.partitionBy(by).orderBy(*order))


def distinct_over(column: str, by: str) -> Column:
    """Distinct non-null values of a partition; Spark has no distinct count over a window."""
    return F.size(F.collect_set(column).over(Window.partitionBy(by)))
