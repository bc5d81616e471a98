"""Reusable Column expressions. All are built-in Spark expressions (codegen, no
Python at run time); each is a small function so operators read like the
business rule they implement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, TimestampNTZType

# Daypart bands.
# Silver line daypart (4 bands): hour < 5 Night, < 12 Morning, < 17 Afternoon,
# else Evening (a null hour falls to Evening).
SILVER_DAYPART_BANDS = [(5, "Night"), (12, "Morning"), (17, "Afternoon")]
SILVER_DAYPART_ELSE = "Evening"
# Weekly trend daypart (3 bands): hour < 12 Morning, < 16 Afternoon, else Evening.
TREND_DAYPART_BANDS = [(12, "Morning"), (16, "Afternoon")]
TREND_DAYPART_ELSE = "Evening"

REVENUE_INPUT = DecimalType(18, 2)
MONEY = DecimalType(38, 2)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters that count as white space in raw text (regex class).
WHITE = r"\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def is_missing(c: str | Column) -> Column:
    """Null, empty or text of white space only, tabs and line breaks included (the
    quality report's 'missing')."""
    c = col(c)
    return c.isNull() | ~c.rlike(f"[^{WHITE}]")


def is_missing_cell(c: str | Column) -> Column:
    """``is_missing`` without a search of texts that begin with a visible ASCII character. It
    is for values in a projection; in a filter its three uses of the text would go below all
    that makes the text."""
    c = col(c)
    return c.isNull() | ~(((c >= "!") & (c < "\x7f")) | c.rlike(f"[^{WHITE}]"))


def stripped(c: str | Column) -> Column:
    """Text without white space at its ends."""
    return F.regexp_replace(col(c), f"^[{WHITE}]+|[{WHITE}]+$", "")


def is_identified(user: str | Column = "USER_ID") -> Column:
    """A user id that is neither null nor blank."""
    u = col(user)
    return u.isNotNull() & (F.trim(u) != "")


def revenue(price: str | Column, quantity: str | Column) -> Column:
    """price cast to decimal(18,2) times quantity (exact decimal, never double)."""
    return col(price).cast(REVENUE_INPUT) * col(quantity)


def amount(price: str | Column = "ITEM_PRICE", quantity: str | Column = "ITEM_QUANTITY") -> Column:
    """Metric amount: ITEM_PRICE * ITEM_QUANTITY (options excluded)."""
    return col(price) * col(quantity)


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def banded(hour: str | Column, bands: list[tuple[int, str]], otherwise: str) -> Column:
    """Chained CASE over ascending upper bounds."""
    h = col(hour)
    expr = None
    for upper, label in bands:
        expr = F.when(h < upper, label) if expr is None else expr.when(h < upper, label)
    return expr.otherwise(otherwise)


def silver_daypart(hour: str | Column = "ORDER_HOUR_UTC") -> Column:
    return banded(hour, SILVER_DAYPART_BANDS, SILVER_DAYPART_ELSE)


def trend_daypart(hour: str | Column) -> Column:
    return banded(hour, TREND_DAYPART_BANDS, TREND_DAYPART_ELSE)


def week_start(ts: str | Column) -> Column:
    """Monday of the week as a date. Built from the date, so an NTZ timestamp is
    never shifted through the session time zone."""
    return F.trunc(F.to_date(col(ts)), "week")


def ts_literal(text: str, like: DataType) -> Column:
    """Timestamp literal of the same flavour (NTZ or session) as a column."""
    if isinstance(like, TimestampNTZType):
        return F.to_timestamp_ntz(F.lit(text))
    return F.to_timestamp(F.lit(text))
