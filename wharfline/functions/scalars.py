"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double; NULL when the denominator is 0 or NULL (ANSI division would fail the job)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; 0 for an empty whole."""
    return F.coalesce(ratio(part.cast("double") * 100, whole), F.lit(0.0))


def rounded(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal form, so 119.935 stored as 119.93499… still gives 119.94."""
    exact = F.round(value.try_cast("decimal(38,12)"), digits).cast("double")
    return F.coalesce(exact, F.round(value.cast("double"), digits))


def percent_text(value: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", value)


def is_true(condition: Column) -> Column:
    """NULL counts as false, so that a row with a missing input never passes a check."""
    return F.coalesce(condition, F.lit(False))


def supply_days(stock: Column, daily_sales: Column) -> Column:
    """Days of supply; NULL without sales (``greatest`` alone would skip the NULL and give 1)."""
    at_least_one = F.when(daily_sales.isNotNull(), F.greatest(daily_sales, F.lit(1.0)))
    return ratio(stock, at_least_one)


def stock_health(days: Column) -> Column:
    return (
        F.when(days < 7, "CRITICAL").when(days < 30, "LOW").when(days < 90, "OPTIMAL").otherwise("EXCESS")
    )


def missing_to_null(name: str, dtype: str) -> Column:
    """NaN means missing in the data model; Spark would order it above every number."""
    if dtype in ("double", "float"):
        return F.when(~F.isnan(name), F.col(name)).alias(name)
    return F.col(name)


def observed(df: DataFrame, figures: Sequence[Column], action: Callable[[DataFrame], object]) -> dict[str, Any]:
    """Aggregates of ``df`` taken while ``action`` runs over it; for the last stage of a job, whose tasks count once."""
    seen = Observation()
    action(df.observe(seen, *figures))
    return dict(seen.get)
