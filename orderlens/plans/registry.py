"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given test tables through the fixture recipe
(``orderlens.sources.fixtures``) and runs the library's operators on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import checks, gold, silver
from orderlens.plans.registry_base import Query, items, options, silver_lines, silver_opts
from orderlens.sources import fixtures


def _by_order(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    """A dataset over the order rollup, as the silver-to-gold job computes it."""
    return lambda spark, d: gold.conform(build(gold.order_rollup(silver_lines(spark, d))), name)


def _by_line(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: gold.conform(build(silver_lines(spark, d)), name)


def _repeated(df: DataFrame, twice: str) -> DataFrame:
    """``df`` with the rows that meet a condition twice, for the grain checks to find."""
    copies = F.when(F.expr(twice), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")


# Rows that the inputs of the grain checks hold twice.
LINE_TWICE = "LINEITEM_ID LIKE '%7-1'"
DAY_TWICE = "day(order_date) = 1"


# Orders that come after all others in the query of the lifetime values by increments.
LATE_ORDER = "coalesce(crc32(ORDER_ID) % 20 = 3, false)"


def _ltv_by_increments(spark: SparkSession, d: str) -> DataFrame:
    """Lifetime values of all orders but the late ones, then refreshed for these: what the
    increment keeps and what it computes.

    Both are made of one rollup of all orders, so lines and options are read and joined once.
    That takes a filter which Spark does not move below the rollup (it would have two then,
    of different lines): one that asks for the rollup's sums too, so for all of them
    wherever it is read; no order is without lines. Days are distinct, so their inner join
    is a semi join that stays above the rollup."""
    lines = silver_lines(spark, d)
    late = F.expr(LATE_ORDER)
    no_lines = (F.col("LINES") == 0) & F.col("TOTAL_LINE_REVENUE").isNotNull()
    rollup = gold.order_rollup(lines).filter(~no_lines)
    early = rollup.filter(~late | no_lines)
    stored = silver.with_month(gold.conform(gold.customer_ltv_daily(early), "customer_ltv_daily"))
    days = gold.identified_lines(lines.filter(late)).select(F.col("USER_ID").alias("_u"), F.col("ORDER_DATE").alias("_d")).distinct()
    theirs = rollup.join(days, F.col("USER_ID").eqNullSafe(F.col("_u")) & F.col("ORDER_DATE").eqNullSafe(F.col("_d"))).drop("_u", "_d")
    # likewise one activity for all that is read of it: every row passes
    every = (F.col("daily_order_count") >= 0) | F.col("daily_revenue").isNull()
    changed = gold.conform_activity(gold.customer_daily_activity(theirs)).filter(every)
    rows, _ = gold.refreshed_lifetime_values(stored, gold.lifetime_totals(stored), changed)
    months = rows.select(F.col("ORDER_MONTH").alias("_m")).distinct()
    kept = stored.join(months, F.col("ORDER_MONTH").eqNullSafe(F.col("_m")), "left_anti")
    return kept.unionByName(gold.replaced_months(stored, rows)).drop("ORDER_MONTH")


def _silver_and_gold() -> dict[str, Query]:
    ltv = _by_order("customer_ltv_daily", gold.customer_ltv_daily)
    detail = _by_line("order_detail", gold.order_detail)
    return {
        "options_by_line": lambda s, d: silver.option_revenue_by_line(options(s, d)),
        "unmatched_options": lambda s, d: silver.unmatched_option_keys(items(s, d), options(s, d)),
        "silver_order_items": silver_lines,
        "silver_options": silver_opts,
        "calendar": lambda s, d: silver.silver_calendar(fixtures.order_calendar(s, d)),
        "order_summary": lambda s, d: gold.order_summary(gold.order_rollup(silver_lines(s, d))),
        "sales_hourly": _by_order("sales_hourly", gold.sales_hourly),
        "restaurant_daily": _by_order("restaurant_daily", gold.restaurant_daily),
        "item_daily": _by_line("item_daily", gold.item_daily),
        "options_with_context": lambda s, d: gold.options_with_context(
            silver_opts(s, d), silver_lines(s, d)
        ),
        "option_daily": lambda s, d: gold.conform(
            gold.option_daily(gold.options_with_context(silver_opts(s, d), silver_lines(s, d))),
            "option_daily",
        ),
        "customer_summary": _by_order("customer_summary", gold.customer_summary),
        "customer_daily_activity": lambda s, d: gold.customer_daily_activity(gold.order_rollup(silver_lines(s, d))),
        "customer_ltv_daily": ltv,
        "customer_ltv_refreshed": _ltv_by_increments,
        "order_detail": detail,
        "check_silver_grain": lambda s, d: checks.silver_grain_duplicates(_repeated(silver_lines(s, d), LINE_TWICE)),
        "check_ltv_grain": lambda s, d: checks.duplicate_keys(
            _repeated(ltv(s, d), DAY_TWICE), ["user_id", "order_date"]
        ),
        "gold_row_counts": lambda s, d: gold.row_counts(gold.gold_datasets(silver_lines(s, d), silver_opts(s, d))),
        "check_order_detail_grain": lambda s, d: checks.duplicate_keys(
            _repeated(detail(s, d), LINE_TWICE), ["order_id", "lineitem_id"]
        ),
    }


def all_queries() -> dict[str, Query]:
    q = _silver_and_gold()
    from orderlens.plans import queries_metrics, queries_quality  # noqa: PLC0415

    q.update(queries_metrics.queries())
    q.update(queries_quality.queries())
    return q
