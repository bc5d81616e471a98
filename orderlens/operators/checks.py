"""Run-time checks (C1-C6, V6). Each check has a DataFrame form (the offending
rows, for reports and the oracle) and an ``assert_*`` form that raises before
anything is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A pipeline check failed; nothing has been overwritten."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once, with their count (partial
    aggregation before the shuffle keeps a hot key cheap)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def silver_grain_duplicates(lines: DataFrame) -> DataFrame:
    """Duplicate (ORDER_ID, LINEITEM_ID) in silver lines."""
    return duplicate_keys(lines, ["ORDER_ID", "LINEITEM_ID"])


def assert_no_duplicates(df: DataFrame, keys: list[str], what: str) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise CheckFailed(f"{what} contains duplicate {' + '.join(keys)} combinations.")


def assert_not_empty(df: DataFrame, what: str) -> None:
    """C2."""
    if df.isEmpty():
        raise CheckFailed(f"{what} is empty.")


def assert_same_count(actual: int, expected: int, what: str) -> None:
    """V6: the silver line count equals the bronze line count."""
    if actual != expected:
        raise CheckFailed(f"{what}: {actual} rows, expected {expected}.")


def observed(df: DataFrame, name: str):
    """Attach a row counter that fills in when ``df`` is written (no
    extra pass over the data). Returns (frame, observation)."""
    from pyspark.sql import Observation  # noqa: PLC0415

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
