"""Bronze -> silver operators: option revenue per line, unmatched option keys,
the calendar, enriched order lines and enriched options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.columns import is_identified, revenue, silver_daypart

C = F.col

# The span of a calendar that is built without data.
DEFAULT_CALENDAR_START = "2020-04-21"
DEFAULT_CALENDAR_END = "2024-02-21"

# Order dates outside these years are taken for errors: they get no calendar day, so that a
# calendar has at most 400 years of days (146,097 rows) whatever the data hold.
FIRST_YEAR, LAST_YEAR = 1800, 2199

LINE_KEY = ["ORDER_ID", "LINEITEM_ID"]
CALENDAR_COLUMNS = [
    "year", "month", "week", "day_of_week", "is_weekend", "is_holiday", "holiday_name",
]


def option_revenue_by_line(options: DataFrame) -> DataFrame:
    """V1: OPTION_REVENUE summed per (ORDER_ID, LINEITEM_ID). Aggregated before
    the join to the lines so a line never fans out over its options; partial
    aggregation runs before the shuffle."""
    return options.groupBy(*LINE_KEY).agg(
        F.sum(revenue("OPTION_PRICE", "OPTION_QUANTITY")).alias("OPTION_REVENUE")
    )


def unmatched_option_keys(items: DataFrame, options: DataFrame) -> DataFrame:
    """V2: distinct option keys with no order line (plain equality: a null key
    never matches)."""
    return (
        options.select(*LINE_KEY)
        .distinct()
        .join(items.select(*LINE_KEY), on=LINE_KEY, how="left_anti")
    )


def build_calendar(
    spark: SparkSession | None = None,
    start: str = DEFAULT_CALENDAR_START,
    end: str = DEFAULT_CALENDAR_END,
    holidays: DataFrame | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """One row per day from ``start`` to ``end`` with calendar attributes.

    ``bounds`` (one row with ``start``/``end`` date columns) derives the span
    from data instead. ``holidays`` (date_key, holiday_name) marks holidays;
    without it every day is a non-holiday, as in the original job. The year is
    the calendar year and the week the ISO week, so 2021-01-01 is year 2021,
    week 53. ``day_index`` is the 0-based position of the day in the span."""
    if bounds is None:
        bounds = spark.range(1).select(
            F.to_date(F.lit(start)).alias("start"), F.to_date(F.lit(end)).alias("end")
        )
    span = F.sequence("start", "end", F.expr("interval 1 day"))
    too_long = F.datediff("end", "start") >= 366 * (LAST_YEAR - FIRST_YEAR + 1)
    span = F.when(too_long, F.raise_error(F.lit("a calendar of more than 400 years")).cast("array<date>")).otherwise(span)
    days = bounds.select(F.posexplode(span).alias("day_index", "date_key"))
    cal = days.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.weekofyear("date_key").alias("week"),
        F.date_format("date_key", "EEEE").alias("day_of_week"),
        F.dayofweek("date_key").isin(1, 7).alias("is_weekend"),
        "day_index",
    )
    if holidays is None:
        cal = cal.withColumn("is_holiday", F.lit(False)).withColumn(
            "holiday_name", F.lit(None).cast("string")
        )
    else:
        # A holiday list is a handful of rows per year.
        h = F.broadcast(holidays.select("date_key", C("holiday_name").alias("_hn")))
        cal = (
            cal.join(h, "date_key", "left")
            .withColumn("is_holiday", C("_hn").isNotNull())
            .withColumn("holiday_name", C("_hn"))
            .drop("_hn")
        )
    return cal.select("date_key", *CALENDAR_COLUMNS, "day_index")


def order_span(items: DataFrame) -> DataFrame:
    """First and last order day of the lines (one row, columns start and end), dates that
    are no order dates (before FIRST_YEAR, after LAST_YEAR) set aside."""
    day = F.to_date("CREATION_TIME_UTC")
    day = F.when(F.year(day).between(FIRST_YEAR, LAST_YEAR), day)
    return items.agg(F.min(day).alias("start"), F.max(day).alias("end")).filter("start IS NOT NULL")


def derive_line_columns(items: DataFrame) -> DataFrame:
    """Revenue, UTC date/hour, daypart, customer type, card status."""
    hour = F.hour("CREATION_TIME_UTC")

    def either(column: str, yes: str, no: str) -> Column:
        return F.when(is_identified(column), F.lit(yes)).otherwise(F.lit(no))

    return items.select(
        "*",
        revenue("ITEM_PRICE", "ITEM_QUANTITY").alias("ITEM_REVENUE"),
        F.to_date("CREATION_TIME_UTC").alias("ORDER_DATE"),
        hour.alias("ORDER_HOUR_UTC"),
        silver_daypart(hour).alias("TIME_OF_DAY_UTC"),
        either("USER_ID", "IDENTIFIED", "GUEST").alias("CUSTOMER_TYPE"),
        either("PRINTED_CARD_NUMBER", "CARD_PRESENT", "NO_CARD").alias("CARD_STATUS"),
    )


def silver_order_items(items: DataFrame, options: DataFrame, calendar: DataFrame) -> DataFrame:
    """V3: enriched order lines, one row per input line.

    Lines join the per-line option revenue (both sides unique on the line key,
    so the join cannot be skewed) and then the calendar. There is no hint: Spark
    broadcasts the calendar if its size allows it (``build_calendar`` is bounded, a
    caller's need not be). Dates outside it get null attributes."""
    lines = derive_line_columns(items)
    with_options = (
        lines.join(option_revenue_by_line(options), on=LINE_KEY, how="left")
        .fillna({"OPTION_REVENUE": 0})
        .withColumn("TOTAL_LINE_REVENUE", C("ITEM_REVENUE") + C("OPTION_REVENUE"))
    )
    cal = calendar.select("date_key", *CALENDAR_COLUMNS)
    return with_options.join(cal, with_options["ORDER_DATE"] == cal["date_key"], "left").drop(
        "date_key"
    )


def with_month(df: DataFrame) -> DataFrame:
    """Rows with ORDER_MONTH, the first day of ORDER_DATE's month: the partition column of
    tables by month."""
    return df.withColumn("ORDER_MONTH", F.trunc("ORDER_DATE", "month"))


def silver_options(options: DataFrame) -> DataFrame:
    """V4: options with OPTION_REVENUE; unmatched and repeated rows are kept."""
    return options.withColumn("OPTION_REVENUE", revenue("OPTION_PRICE", "OPTION_QUANTITY"))


def silver_calendar(calendar: DataFrame) -> DataFrame:
    """V5: the calendar as written to silver."""
    return calendar.select("date_key", *CALENDAR_COLUMNS)
