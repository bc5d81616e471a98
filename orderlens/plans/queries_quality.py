"""Registered typed-ingest, quality-report and profiling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators import profiling as pf
from orderlens.operators import quality as dq
from orderlens.plans.registry_base import Query
from orderlens.sources import fixtures
from orderlens.sources import ingest as ing


def raw_items(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.raw_order_items(spark, d)


def raw_opts(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.raw_options(spark, d)


def raw_dd(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.raw_date_dim(spark, d)


RAW = {"order_items": raw_items, "options": raw_opts, "date_dim": raw_dd}
TABLE = {"order_items": "order_items", "options": "order_item_options", "date_dim": "date_dim"}


def _broken(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    items = raw_items(s, d)
    return dq.broken_option_rows(raw_opts(s, d), items), items


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # typed ingest
        "ingest_date_dim": lambda s, d: ing.ingest_date_dim(raw_dd(s, d), strict=False),
        "ingest_order_items": lambda s, d: ing.ingest_order_items(raw_items(s, d), strict=False),
        "ingest_options": lambda s, d: ing.ingest_options(raw_opts(s, d), strict=False),
        "preview_conversion": lambda s, d: ing.preview_conversion(raw_items(s, d), 10),
        # quality report
        "dq_issues_date_dim": lambda s, d: dq.table_issues(s, raw_dd(s, d), "date_dim"),
        "dq_issues_order_items": lambda s, d: dq.table_issues(s, raw_items(s, d), "order_items"),
        "dq_issues_options": lambda s, d: dq.table_issues(s, raw_opts(s, d), "order_item_options"),
        "dq_issues_options_renamed": lambda s, d: dq.table_issues(
            s, fixtures.raw_options_renamed(s, d), "order_item_options"
        ),
        "dq_broken_references": lambda s, d: dq.broken_reference_issues(_broken(s, d)[0]),
        "dq_broken_options": lambda s, d: _broken(s, d)[0].orderBy("ORDER_ID", "LINEITEM_ID", "source_row"),
        "dq_broken_summary": lambda s, d: dq.broken_summary(_broken(s, d)[0]),
        "dq_broken_order_items": lambda s, d: dq.broken_order_lines(*_broken(s, d)),
        "dq_affected_orders": lambda s, d: dq.affected_order_lines(*_broken(s, d)),
        "dq_missing_item_fields": lambda s, d: dq.missing_item_fields(raw_items(s, d)),
        "dq_investigated_order": lambda s, d: dq.investigated_order(raw_items(s, d)),
        "dq_zero_quantity": lambda s, d: dq.zero_quantity_rows(raw_items(s, d)),
        "dq_zero_quantity_counts": lambda s, d: dq.zero_quantity_counts(raw_items(s, d)),
        "dq_option_duplicates": lambda s, d: dq.option_duplicates(raw_opts(s, d)).orderBy(
            *dq.OPTION_KEY, "source_row"
        ),
        "dq_option_duplicate_groups": lambda s, d: dq.option_duplicate_groups(raw_opts(s, d)),
        "dq_summary": lambda s, d: dq.quality_summary(s, raw_dd(s, d), raw_items(s, d), raw_opts(s, d)),
        # profiling
        "profile_longest_category": lambda s, d: pf.longest_categories(raw_items(s, d)),
        "profile_url_category": lambda s, d: pf.url_categories(raw_items(s, d)),
        "profile_row_counts": lambda s, d: pf.row_counts(
            {"order_items": raw_items(s, d), "order_item_options": raw_opts(s, d), "date_dim": raw_dd(s, d)}
        ),
        "profile_item_lengths": lambda s, d: pf.item_lengths(raw_items(s, d)),
        "profile_option_lengths": lambda s, d: pf.option_lengths(raw_opts(s, d)),
        "profile_option_ranges": lambda s, d: pf.option_ranges(ing.ingest_options(raw_opts(s, d), strict=False)),
        "profile_timestamps": lambda s, d: pf.first_timestamps(raw_items(s, d)),
        "profile_loyalty": lambda s, d: pf.loyalty_counts(raw_items(s, d)),
    }
    for short, read in RAW.items():
        table = TABLE[short]
        q[f"dq_missing_{short}"] = lambda s, d, read=read, table=table: dq.missing_values(read(s, d), table)
        q[f"dq_duplicate_rows_{short}"] = lambda s, d, read=read, table=table: dq.in_first_appearance(
            dq.duplicate_rows(read(s, d), table)
        )
        q[f"dq_duplicate_members_{short}"] = lambda s, d, read=read, table=table: dq.duplicate_members(
            read(s, d), table
        )
    return q
