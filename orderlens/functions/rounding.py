"""Exact decimal rounding helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.functions.columns import MONEY


def half_up_mean(total: Column, count: Column) -> Column:
    """total / count rounded half up (away from zero) to cents.

    ``avg`` of a decimal rounds to 6 places first, and rounding that again to
    2 places can move a value lying just under a half cent. Dividing a
    decimal(22,2) by a decimal(20,0) keeps 18 places, so the one rounding to
    cents is exact for any count below 10^16. Null when count is 0."""
    n = count.cast("decimal(20,0)")
    mean = total.cast("decimal(22,2)") / n
    return F.when(n > 0, F.round(mean, 2).cast(MONEY))


def half_up_mean_or_zero(total: str, count: str) -> Column:
    """The exact mean of two columns, 0 when the count is 0 (null for a null total)."""
    n = F.col(count)
    return F.when(n > 0, half_up_mean(F.col(total), n)).otherwise(F.lit(0).cast(MONEY))


def half_up_ratio(numerator: Column, denominator: Column, scale_by: int = 1) -> Column:
    """numerator * scale_by / denominator rounded half up to 2 places, exactly
    (18 working decimals, as ``half_up_mean``). Null when the denominator is 0
    or null (the SQL ``NULLIF(d, 0)``)."""
    num = (numerator * F.lit(scale_by)).cast("decimal(24,2)")
    den = denominator.cast("decimal(22,2)")
    return F.when(den != 0, F.round(num / den, 2).cast(MONEY))
