"""Ratios and percentages that never divide by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, total: Column, digits: int = 1) -> Column:
    """`part / total * 100`, rounded half up on integers so that ties never depend on floats."""
    scale = 100 * 10**digits
    doubled = 2 * scale * part.cast("long") + total.cast("long")
    exact = F.call_function("div", doubled, F.nullif(2 * total.cast("long"), F.lit(0).cast("long")))
    return F.coalesce(exact, F.lit(0)).cast("double") / F.lit(float(10**digits))


def ratio(part: Column, total: Column) -> Column:
    """`part / total` as a double, 0 when the total is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), total.cast("double")), F.lit(0.0))
