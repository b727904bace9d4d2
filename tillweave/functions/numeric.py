"""Numbers that come out alike in any engine: cent rounding, exact means, guarded percentages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(x: Column) -> Column:
    """x to two decimals, halves up, in double arithmetic."""
    return F.floor(x * 100.0 + 0.5) / 100.0


def exact_mean(x: Column | str) -> Column:
    """Mean of a decimal column: the exact sum as a double over the count."""
    return F.sum(x).cast("double") / F.count(x)


def profile(name: str, percents: Iterable[int] = (50, 75, 85, 90, 100), accuracy: int = 10_000) -> list[Column]:
    """The mean of a column and its percentiles, named average_{name} and {p}percentile_{name}."""
    out = [exact_mean(name).alias(f"average_{name}")]
    for p in percents:
        out.append(F.percentile_approx(name, p / 100.0, accuracy).cast("double").alias(f"{p}percentile_{name}"))
    return out


def percent_change(new: Column, old: Column) -> Column:
    """100 * (new - old) / old where old is positive, else 0."""
    return F.when(old > 0, 100.0 * (new - old) / old).otherwise(0.0)
