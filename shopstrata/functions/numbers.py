"""Metric value types."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shopstrata.schemas import METRIC, MONEY, RATE


def money(column: Column) -> Column:
    return column.cast(MONEY)


def metric(column: Column) -> Column:
    return column.cast(METRIC)


def ratio(numerator: Column, denominator: Column, result: str = RATE) -> Column:
    """Decimal quotient, rounded half up; zero where the denominator is zero or missing."""
    top = F.coalesce(numerator, F.lit(0)).cast(METRIC)
    bottom = denominator.cast(METRIC)
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(0)).cast(result)
