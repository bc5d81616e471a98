"""Profiling queries over the raw staging tables (F1-F8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.sources.ingest import text_length

C = F.col


def longest_categories(raw_items: DataFrame, k: int = 20) -> DataFrame:
    """the k longest ITEM_CATEGORY values with their length (top-k is the
    feature; ties broken by the text)."""
    return (
        raw_items.select(text_length("ITEM_CATEGORY").alias("category_length"), "ITEM_CATEGORY")
        .orderBy(C("category_length").desc_nulls_last(), C("ITEM_CATEGORY").asc_nulls_last())
        .limit(k)
    )


def url_categories(raw_items: DataFrame) -> DataFrame:
    """how many categories contain 'http' (case-sensitive LIKE)."""
    return raw_items.agg(F.count_if(C("ITEM_CATEGORY").like("%http%")).alias("rows_with_urls"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """row count per table."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def item_lengths(raw_items: DataFrame) -> DataFrame:
    """longest category and item name."""
    return raw_items.agg(
        F.max(text_length("ITEM_CATEGORY")).alias("max_item_category_length"),
        F.max(text_length("ITEM_NAME")).alias("max_item_name_length"),
    )


def option_lengths(raw_options: DataFrame) -> DataFrame:
    """longest text of the four option text columns."""
    return raw_options.agg(
        F.max(text_length("ORDER_ID")).alias("max_order_id_length"),
        F.max(text_length("LINEITEM_ID")).alias("max_lineitem_id_length"),
        F.max(text_length("OPTION_GROUP_NAME")).alias("max_option_group_name_length"),
        F.max(text_length("OPTION_NAME")).alias("max_option_name_length"),
    )


def option_ranges(typed_options: DataFrame) -> DataFrame:
    """price and quantity ranges of typed options."""
    return typed_options.agg(
        F.min("OPTION_PRICE").alias("min_option_price"),
        F.max("OPTION_PRICE").alias("max_option_price"),
        F.min("OPTION_QUANTITY").alias("min_option_quantity"),
        F.max("OPTION_QUANTITY").alias("max_option_quantity"),
    )


def first_timestamps(raw_items: DataFrame, n: int = 10) -> DataFrame:
    """the first n timestamp texts in file order (a preview)."""
    return raw_items.orderBy("source_row").limit(n).select("source_row", "CREATION_TIME_UTC")


def loyalty_counts(raw_items: DataFrame) -> DataFrame:
    """F8: rows per IS_LOYALTY text."""
    return raw_items.groupBy("IS_LOYALTY").agg(F.count(F.lit(1)).alias("row_count"))
