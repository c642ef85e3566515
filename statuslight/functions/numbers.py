"""Safe casts and the percent and pound formats of the financial bundle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_bigint(text: Column) -> Column:
    return text.try_cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error for a zero divisor."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_text(value: Column) -> Column:
    return F.concat(F.round(value).cast("bigint").cast("string"), F.lit("%"))


def pounds_text(value: Column) -> Column:
    return F.concat(F.lit("£"), F.round(value).cast("bigint").cast("string"))
