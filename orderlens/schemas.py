"""Declared schemas: raw text contracts, typed landing contracts, gold contracts.

Fixed values: these column lists, types and table comments must equal the
workload's published contracts, so they are stated here as plain text.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# ---------------------------------------------------------------------------
# Expected source columns, in file order.
# ---------------------------------------------------------------------------
EXPECTED_COLUMNS: dict[str, list[str]] = {
    "date_dim": [
        "date_key", "year", "month", "week", "day_of_week",
        "is_weekend", "is_holiday", "holiday_name",
    ],
    "order_items": [
        "APP_NAME", "RESTAURANT_ID", "CREATION_TIME_UTC", "ORDER_ID", "USER_ID",
        "PRINTED_CARD_NUMBER", "IS_LOYALTY", "CURRENCY", "LINEITEM_ID",
        "ITEM_CATEGORY", "ITEM_NAME", "ITEM_PRICE", "ITEM_QUANTITY",
    ],
    "order_item_options": [
        "ORDER_ID", "LINEITEM_ID", "OPTION_GROUP_NAME", "OPTION_NAME",
        "OPTION_PRICE", "OPTION_QUANTITY",
    ],
}

# File names used in quality reports (fixed values).
FILE_NAMES = {
    "date_dim": "date_dim.csv",
    "order_items": "order_items.csv",
    "order_item_options": "order_item_options.csv",
}

# Tokens read as null in raw text (fixed values).
NA_TOKENS = ["NULL", "null", "NA", "N/A", "NaN", "nan"]

# Text widths of the typed landing tables (fixed values); Spark strings carry
# no width, so the strict load checks them.
ORDER_ITEM_WIDTHS = {
    "APP_NAME": 255, "RESTAURANT_ID": 255, "ORDER_ID": 255, "USER_ID": 255,
    "PRINTED_CARD_NUMBER": 255, "CURRENCY": 10, "LINEITEM_ID": 255,
    "ITEM_CATEGORY": 255, "ITEM_NAME": 255,
}
OPTION_WIDTHS = {
    "ORDER_ID": 255, "LINEITEM_ID": 255, "OPTION_GROUP_NAME": 255, "OPTION_NAME": 255,
}
DATE_DIM_WIDTHS = {"day_of_week": 10, "holiday_name": 50}

PRICE = DecimalType(10, 2)
MONEY = DecimalType(38, 2)


def _struct(pairs: list[tuple[str, DataType]]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in pairs])


def raw_schema(table: str) -> StructType:
    """All-string contract of a raw file (staging form)."""
    return _struct([(c, StringType()) for c in EXPECTED_COLUMNS[table]])


# Typed landing contracts (fixed values).
TYPED_SCHEMAS: dict[str, StructType] = {
    "order_items": _struct([
        ("APP_NAME", StringType()), ("RESTAURANT_ID", StringType()),
        ("CREATION_TIME_UTC", TimestampNTZType()), ("ORDER_ID", StringType()),
        ("USER_ID", StringType()), ("PRINTED_CARD_NUMBER", StringType()),
        ("IS_LOYALTY", BooleanType()), ("CURRENCY", StringType()),
        ("LINEITEM_ID", StringType()), ("ITEM_CATEGORY", StringType()),
        ("ITEM_NAME", StringType()), ("ITEM_PRICE", PRICE),
        ("ITEM_QUANTITY", IntegerType()),
    ]),
    "order_item_options": _struct([
        ("ORDER_ID", StringType()), ("LINEITEM_ID", StringType()),
        ("OPTION_GROUP_NAME", StringType()), ("OPTION_NAME", StringType()),
        ("OPTION_PRICE", PRICE), ("OPTION_QUANTITY", IntegerType()),
    ]),
    "date_dim": _struct([
        ("date_key", DateType()), ("year", IntegerType()), ("month", IntegerType()),
        ("week", IntegerType()), ("day_of_week", StringType()),
        ("is_weekend", BooleanType()), ("is_holiday", BooleanType()),
        ("holiday_name", StringType()),
    ]),
}

# ---------------------------------------------------------------------------
# Gold table contracts (column order, names, types, comments).
# ---------------------------------------------------------------------------
_S, _D, _B, _L, _I = StringType(), DateType(), BooleanType(), LongType(), IntegerType()

GOLD_SCHEMAS: dict[str, StructType] = {
    "sales_hourly": _struct([
        ("app_name", _S), ("restaurant_id", _S), ("order_date", _D),
        ("order_hour_utc", _I), ("time_of_day_utc", _S), ("is_weekend", _B),
        ("order_count", _L), ("line_item_count", _L), ("item_quantity", _L),
        ("item_revenue", MONEY), ("option_revenue", MONEY), ("total_revenue", MONEY),
        ("average_order_value", MONEY),
    ]),
    "restaurant_daily": _struct([
        ("app_name", _S), ("restaurant_id", _S), ("order_date", _D),
        ("day_of_week", _S), ("is_weekend", _B), ("is_holiday", _B),
        ("holiday_name", _S), ("order_count", _L), ("customer_count", _L),
        ("line_item_count", _L), ("item_revenue", MONEY), ("option_revenue", MONEY),
        ("total_revenue", MONEY), ("average_order_value", MONEY),
    ]),
    "item_daily": _struct([
        ("app_name", _S), ("restaurant_id", _S), ("order_date", _D),
        ("item_category", _S), ("item_name", _S), ("quantity_sold", _L),
        ("order_count", _L), ("item_revenue", MONEY), ("average_item_price", MONEY),
    ]),
    "option_daily": _struct([
        ("app_name", _S), ("restaurant_id", _S), ("order_date", _D),
        ("option_group_name", _S), ("option_name", _S), ("option_quantity", _L),
        ("option_revenue", MONEY), ("order_count", _L),
        ("average_option_price", MONEY), ("free_option_quantity", _L),
        ("paid_option_quantity", _L), ("free_option_order_count", _L),
        ("paid_option_order_count", _L), ("paid_option_revenue", MONEY),
    ]),
    "customer_summary": _struct([
        ("user_id", _S), ("order_count", _L), ("item_count", _L),
        ("total_item_revenue", MONEY), ("total_option_revenue", MONEY),
        ("total_revenue", MONEY), ("average_order_value", MONEY),
        ("first_order_date", _D), ("last_order_date", _D),
        ("loyalty_order_count", _L), ("loyalty_revenue", MONEY),
    ]),
    "order_detail": _struct([
        ("app_name", _S), ("restaurant_id", _S), ("order_date", _D),
        ("order_id", _S), ("lineitem_id", _S), ("user_id", _S),
        ("item_category", _S), ("item_name", _S), ("is_loyalty", _B),
        ("card_status", _S), ("time_of_day_utc", _S), ("item_price", MONEY),
        ("item_quantity", _L), ("item_revenue", MONEY), ("option_revenue", MONEY),
        ("total_line_revenue", MONEY),
    ]),
    "customer_ltv_daily": _struct([
        ("user_id", _S), ("order_date", _D), ("daily_revenue", MONEY),
        ("cumulative_ltv", MONEY), ("daily_order_count", _L),
        ("cumulative_order_count", _L),
    ]),
}

GOLD_COMMENTS: dict[str, str] = {
    "sales_hourly": "Hourly sales metrics by app, restaurant, date, and UTC hour.",
    "restaurant_daily": "Daily restaurant sales and customer metrics by app, restaurant, and date.",
    "item_daily": "Daily item sales metrics by app, restaurant, date, category, and item.",
    "option_daily": "Daily option usage and revenue metrics by app, restaurant, date, option group, and option.",
    "customer_summary": "Historical customer-level sales, loyalty, and order summary metrics.",
    "order_detail": "Curated order line-item detail for drill-down analysis.",
    "customer_ltv_daily": "Daily customer revenue and cumulative lifetime value and order counts.",
}

# Grain (unique key) of every gold dataset; checked before any write.
GOLD_GRAIN: dict[str, list[str]] = {
    "sales_hourly": ["app_name", "restaurant_id", "order_date", "order_hour_utc",
                     "time_of_day_utc", "is_weekend"],
    "restaurant_daily": ["app_name", "restaurant_id", "order_date", "day_of_week",
                         "is_weekend", "is_holiday", "holiday_name"],
    "item_daily": ["app_name", "restaurant_id", "order_date", "item_category", "item_name"],
    "option_daily": ["app_name", "restaurant_id", "order_date", "option_group_name",
                     "option_name"],
    "customer_summary": ["user_id"],
    "order_detail": ["order_id", "lineitem_id"],
    "customer_ltv_daily": ["user_id", "order_date"],
}
