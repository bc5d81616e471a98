"""Silver -> gold datasets (G0-G9) and ``conform``.

Every dataset is an aggregate over silver lines. Where a dataset needs several
distinct counts over the same column, it is written as two grouped levels
(order grain, then the dataset grain) instead of ``count(DISTINCT ...)`` twice:
Spark would otherwise ``Expand`` each row once per distinct column before the
shuffle. Both levels aggregate partially before their shuffle, so one hot key
(a big restaurant, a busy user) never ships its raw lines to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.columns import is_identified
from orderlens.functions.rounding import half_up_mean, half_up_mean_or_zero
from orderlens.schemas import GOLD_SCHEMAS

C = F.col


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the gold contract's columns in order, lower-case names, cast to
    the contract types (decimal casts round half up)."""
    by_lower = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            C(by_lower[f.name]).cast(f.dataType).alias(f.name)
            for f in GOLD_SCHEMAS[table].fields
        ]
    )


# Order-level attributes shared by the order-grained gold datasets. Within one
# order they are normally constant, so the rollup has about one row per order.
ROLLUP_KEYS = [
    "ORDER_ID", "USER_ID", "CUSTOMER_TYPE", "IS_LOYALTY", "APP_NAME", "RESTAURANT_ID",
    "ORDER_DATE", "ORDER_HOUR_UTC", "TIME_OF_DAY_UTC", "day_of_week", "is_weekend",
    "is_holiday", "holiday_name",
]


def order_rollup(lines: DataFrame) -> DataFrame:
    """Lines folded to (order + order-level attributes): line count and sums.

    sales_hourly, restaurant_daily, customer_summary, the lifetime-value
    datasets and order_summary all aggregate these rows instead of lines, so
    the silver->gold job scans the lines and shuffles their order-grain
    partial sums once for all five. Exact: every attribute those datasets
    group or filter on is a rollup key, and distinct order/user counts stay
    distinct counts."""
    return lines.groupBy(*ROLLUP_KEYS).agg(
        F.count(F.lit(1)).alias("LINES"),
        F.sum("ITEM_QUANTITY").alias("ITEM_QUANTITY"),
        F.sum("ITEM_REVENUE").alias("ITEM_REVENUE"),
        F.sum("OPTION_REVENUE").alias("OPTION_REVENUE"),
        F.sum("TOTAL_LINE_REVENUE").alias("TOTAL_LINE_REVENUE"),
    )


# Shared money and count aggregates over the rollup, by output name.
_SUMS = {
    "LINE_ITEM_COUNT": "LINES",
    "ITEM_QUANTITY": "ITEM_QUANTITY",
    "ITEM_REVENUE": "ITEM_REVENUE",
    "OPTION_REVENUE": "OPTION_REVENUE",
    "TOTAL_REVENUE": "TOTAL_LINE_REVENUE",
}


def _orders_by(rollup: DataFrame, keys: list[str], sums: list[str], **extra: Column) -> DataFrame:
    """Distinct orders, sums and average order value of a rollup by ``keys``."""
    out = rollup.groupBy(*keys).agg(
        F.count_distinct("ORDER_ID").alias("ORDER_COUNT"),
        *[c.alias(name) for name, c in extra.items()],
        *[F.sum(_SUMS[name]).alias(name) for name in sums],
    )
    return out.withColumn("AVERAGE_ORDER_VALUE", half_up_mean_or_zero("TOTAL_REVENUE", "ORDER_COUNT"))


def order_summary(rollup: DataFrame) -> DataFrame:
    """One row per order: app, restaurant, date, total, items. ``min`` picks
    the attribute (equal to the first non-null value when it is constant per
    order, and deterministic after a shuffle)."""
    return rollup.groupBy("ORDER_ID").agg(
        F.min("APP_NAME").alias("APP_NAME"),
        F.min("RESTAURANT_ID").alias("RESTAURANT_ID"),
        F.min("ORDER_DATE").alias("ORDER_DATE"),
        F.sum("TOTAL_LINE_REVENUE").alias("ORDER_TOTAL"),
        F.sum("ITEM_QUANTITY").alias("ORDER_TOTAL_ITEMS"),
    )


def sales_hourly(rollup: DataFrame) -> DataFrame:
    """G1: app, restaurant, date, hour (+ daypart, weekend)."""
    keys = ["APP_NAME", "RESTAURANT_ID", "ORDER_DATE", "ORDER_HOUR_UTC", "TIME_OF_DAY_UTC", "is_weekend"]
    return _orders_by(rollup, keys, list(_SUMS))


def restaurant_daily(rollup: DataFrame) -> DataFrame:
    """App, restaurant, date (+ calendar attributes). Customers counted are
    identified users only.

    Two distinct counts over different columns: Spark expands each input row
    into one row per distinct column before its partial aggregation. The input
    is the order rollup, about one row per order, so the expansion is of orders,
    not of lines."""
    keys = ["APP_NAME", "RESTAURANT_ID", "ORDER_DATE", "day_of_week", "is_weekend", "is_holiday", "holiday_name"]
    known = F.when(C("CUSTOMER_TYPE") == "IDENTIFIED", C("USER_ID"))
    sums = ["LINE_ITEM_COUNT", "ITEM_REVENUE", "OPTION_REVENUE", "TOTAL_REVENUE"]
    return _orders_by(rollup, keys, sums, CUSTOMER_COUNT=F.count_distinct(known))


def item_daily(lines: DataFrame) -> DataFrame:
    """App, restaurant, date, category, item. The average price is per line
    (unweighted by quantity)."""
    keys = ["APP_NAME", "RESTAURANT_ID", "ORDER_DATE", "ITEM_CATEGORY", "ITEM_NAME"]
    return lines.groupBy(*keys).agg(
        F.sum("ITEM_QUANTITY").alias("QUANTITY_SOLD"),
        F.sum("ITEM_REVENUE").alias("ITEM_REVENUE"),
        F.count_distinct("ORDER_ID").alias("ORDER_COUNT"),
        half_up_mean(F.sum("ITEM_PRICE"), F.count("ITEM_PRICE")).alias("AVERAGE_ITEM_PRICE"),
    )


def options_with_context(silver_options: DataFrame, lines: DataFrame, grain_checked: bool = True) -> DataFrame:
    """Options joined to their line's app, restaurant and date (inner: orphan
    options drop out). When the line grain has been proven unique (check C1),
    the de-duplication of the line side is skipped; it would cost a shuffle."""
    context = lines.select("ORDER_ID", "LINEITEM_ID", "APP_NAME", "RESTAURANT_ID", "ORDER_DATE")
    if not grain_checked:
        context = context.dropDuplicates(["ORDER_ID", "LINEITEM_ID"])
    return silver_options.join(context, on=["ORDER_ID", "LINEITEM_ID"], how="inner")


def option_daily(options_ctx: DataFrame) -> DataFrame:
    """App, restaurant, date, option group, option. Free = price 0, paid =
    price > 0 (null or negative prices are in neither).

    Level 1 folds each order's options per group key; level 2 counts orders
    (all, with a free option, with a paid option) with plain counts."""
    keys = ["APP_NAME", "RESTAURANT_ID", "ORDER_DATE", "OPTION_GROUP_NAME", "OPTION_NAME"]
    price, qty = C("OPTION_PRICE"), C("OPTION_QUANTITY")
    per_order = options_ctx.groupBy(*keys, "ORDER_ID").agg(
        F.sum(qty).alias("q"),
        F.sum("OPTION_REVENUE").alias("r"),
        F.sum(price).alias("p_sum"),
        F.count(price).alias("p_n"),
        F.sum(F.when(price == 0, qty).otherwise(0)).alias("free_q"),
        F.sum(F.when(price > 0, qty).otherwise(0)).alias("paid_q"),
        F.sum(F.when(price > 0, C("OPTION_REVENUE")).otherwise(0)).alias("paid_r"),
        F.max(price == 0).alias("has_free"),
        F.max(price > 0).alias("has_paid"),
    )
    return per_order.groupBy(*keys).agg(
        F.sum("q").alias("OPTION_QUANTITY"),
        F.sum("r").alias("OPTION_REVENUE"),
        F.count(F.lit(1)).alias("ORDER_COUNT"),
        half_up_mean(F.sum("p_sum"), F.sum("p_n")).alias("AVERAGE_OPTION_PRICE"),
        F.sum("free_q").alias("FREE_OPTION_QUANTITY"),
        F.sum("paid_q").alias("PAID_OPTION_QUANTITY"),
        F.count_if(C("has_free")).alias("FREE_OPTION_ORDER_COUNT"),
        F.count_if(C("has_paid")).alias("PAID_OPTION_ORDER_COUNT"),
        F.sum("paid_r").alias("PAID_OPTION_REVENUE"),
    )


def identified_lines(lines: DataFrame) -> DataFrame:
    """Rows of identified users (not null, not blank)."""
    return lines.filter(is_identified("USER_ID"))


def customer_summary(rollup: DataFrame) -> DataFrame:
    """One row per identified user (two levels: order, then user). Lines without
    an ORDER_ID add to the sums but are no order."""
    loyal = C("IS_LOYALTY") == True  # noqa: E712 - null stays null
    per_order = identified_lines(rollup).groupBy("USER_ID", "ORDER_ID").agg(
        F.sum("ITEM_QUANTITY").alias("q"),
        F.sum("ITEM_REVENUE").alias("ir"),
        F.sum("OPTION_REVENUE").alias("orv"),
        F.sum("TOTAL_LINE_REVENUE").alias("tr"),
        F.min("ORDER_DATE").alias("d0"),
        F.max("ORDER_DATE").alias("d1"),
        F.max(loyal).alias("loyal"),
        F.sum(F.when(loyal, C("TOTAL_LINE_REVENUE")).otherwise(0)).alias("lr"),
    )
    out = per_order.groupBy("USER_ID").agg(
        F.count("ORDER_ID").alias("ORDER_COUNT"),
        F.sum("q").alias("ITEM_COUNT"),
        F.sum("ir").alias("TOTAL_ITEM_REVENUE"),
        F.sum("orv").alias("TOTAL_OPTION_REVENUE"),
        F.sum("tr").alias("TOTAL_REVENUE"),
        F.min("d0").alias("FIRST_ORDER_DATE"),
        F.max("d1").alias("LAST_ORDER_DATE"),
        F.count_if(C("loyal") & C("ORDER_ID").isNotNull()).alias("LOYALTY_ORDER_COUNT"),
        F.sum("lr").alias("LOYALTY_REVENUE"),
    )
    return out.withColumn("AVERAGE_ORDER_VALUE", half_up_mean_or_zero("TOTAL_REVENUE", "ORDER_COUNT"))


def customer_daily_activity(rollup: DataFrame) -> DataFrame:
    """Identified user x date: revenue and distinct orders."""
    return identified_lines(rollup).groupBy("USER_ID", "ORDER_DATE").agg(
        F.sum("TOTAL_LINE_REVENUE").alias("DAILY_REVENUE"),
        F.count_distinct("ORDER_ID").alias("DAILY_ORDER_COUNT"),
    )


def customer_ltv_daily(rollup: DataFrame) -> DataFrame:
    """G8 (flagship): running lifetime value and order count per user by date.

    The window runs over the (user, date) activity, not over lines: a user's
    window partition holds at most one row per calendar day, whatever the
    user's share of all lines."""
    running = (
        Window.partitionBy("USER_ID")
        .orderBy("ORDER_DATE")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return customer_daily_activity(rollup).select(
        "USER_ID",
        "ORDER_DATE",
        "DAILY_REVENUE",
        F.sum("DAILY_REVENUE").over(running).alias("CUMULATIVE_LTV"),
        "DAILY_ORDER_COUNT",
        F.sum("DAILY_ORDER_COUNT").over(running).alias("CUMULATIVE_ORDER_COUNT"),
    )


def conform_activity(activity: DataFrame) -> DataFrame:
    """Daily activity (G7) under the names and types of the stored lifetime values, with
    its month."""
    types = {f.name: f.dataType for f in GOLD_SCHEMAS["customer_ltv_daily"].fields}
    names = ["user_id", "order_date", "daily_revenue", "daily_order_count"]
    return activity.select(*[C(n).cast(types[n]).alias(n) for n in names], F.trunc("order_date", "month").alias("ORDER_MONTH"))


def lifetime_totals(values: DataFrame) -> DataFrame:
    """Each user's totals over the stored lifetime values: the state from which an
    increment goes on."""
    return values.groupBy("user_id").agg(
        F.sum("daily_revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.sum("daily_order_count").alias("total_orders"),
        F.count("daily_revenue").alias("known_days"),
    )


def _day() -> Column:
    """The day of a row for comparisons: one without a date precedes all others, as in the
    window of a full run."""
    return F.coalesce(C("order_date"), F.lit("0001-01-01").cast("date"))


def refreshed_lifetime_values(stored: DataFrame, state: DataFrame, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """G8 for the users of ``changed`` only: (rows from each user's first changed day on, all
    users' new totals).

    ``changed``: whole new values of user-days (``conform_activity``); ``stored``: the lifetime
    values of at least the months from the first changed day on; ``state``: the users'
    totals (``lifetime_totals``). A user's value before the first changed day is the stored
    total less the stored days from there on, so no earlier history is read: for new days
    nothing but the total. The window runs over the days from the first changed one on."""
    since = changed.groupBy("user_id").agg(F.min(_day()).alias("_since"))
    later = stored.join(since, "user_id").filter(_day() >= C("_since"))
    given = changed.select(C("user_id").alias("_u"), _day().alias("_d"))
    unchanged = later.join(given, (C("user_id") == C("_u")) & (_day() == C("_d")), "left_anti")
    names = ["user_id", "order_date", "daily_revenue", "daily_order_count"]
    days = unchanged.select(*names).unionByName(changed.select(*names))

    removed = later.groupBy("user_id").agg(
        F.sum("daily_revenue").alias("_rev"), F.sum("daily_order_count").alias("_n"), F.count("daily_revenue").alias("_known")
    )
    nothing = F.lit(0)
    opening = since.join(state, "user_id", "left").join(removed, "user_id", "left").select(
        "user_id",
        (F.coalesce("total_revenue", nothing) - F.coalesce("_rev", nothing)).alias("_rev0"),
        (F.coalesce("total_orders", nothing) - F.coalesce("_n", nothing)).alias("_n0"),
        (F.coalesce("known_days", nothing) - F.coalesce("_known", nothing)).alias("_known0"),
    )
    so_far = Window.partitionBy("user_id").orderBy(_day()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # null, as a sum is, as long as no day has a revenue
    value = C("_rev0") + F.coalesce(F.sum("daily_revenue").over(so_far), nothing)
    rows = days.join(opening, "user_id").select(
        "user_id", "order_date", "daily_revenue",
        F.when(C("_known0") + F.count("daily_revenue").over(so_far) > 0, value).alias("cumulative_ltv"),
        "daily_order_count",
        (C("_n0") + F.sum("daily_order_count").over(so_far)).alias("cumulative_order_count"),
        F.trunc("order_date", "month").alias("ORDER_MONTH"),
    )
    types = {f.name: f.dataType for f in GOLD_SCHEMAS["customer_ltv_daily"].fields}
    rows = rows.select(*[C(n).cast(t).alias(n) for n, t in types.items()], "ORDER_MONTH")

    now = days.groupBy("user_id").agg(
        F.sum("daily_revenue").alias("_rev1"), F.sum("daily_order_count").alias("_n1"), F.count("daily_revenue").alias("_known1")
    )
    added = opening.join(now, "user_id").select(
        "user_id",
        F.when(C("_known0") + C("_known1") > 0, C("_rev0") + F.coalesce("_rev1", nothing)).cast("decimal(38,2)").alias("total_revenue"),
        (C("_n0") + C("_n1")).alias("total_orders"),
        (C("_known0") + C("_known1")).alias("known_days"),
    )
    return rows, state.join(since, "user_id", "left_anti").unionByName(added)


def replaced_months(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """The months in which ``rows`` (``refreshed_lifetime_values``) have days: these rows, and
    the stored rows that they do not replace."""
    months = rows.select(C("ORDER_MONTH").alias("_m")).distinct()
    since = rows.groupBy("user_id").agg(F.min(_day()).alias("_since")).select(C("user_id").alias("_u"), "_since")
    same_month = stored.join(months, C("ORDER_MONTH").eqNullSafe(C("_m")), "left_semi")
    others = same_month.join(since, (C("user_id") == C("_u")) & (_day() >= C("_since")), "left_anti")
    return others.unionByName(rows)


def order_detail(lines: DataFrame) -> DataFrame:
    """Curated line detail (16 columns)."""
    return lines.select(
        "APP_NAME", "RESTAURANT_ID", "ORDER_DATE", "ORDER_ID", "LINEITEM_ID", "USER_ID",
        "ITEM_CATEGORY", "ITEM_NAME", "IS_LOYALTY", "CARD_STATUS", "TIME_OF_DAY_UTC",
        "ITEM_PRICE", "ITEM_QUANTITY", "ITEM_REVENUE", "OPTION_REVENUE", "TOTAL_LINE_REVENUE",
    )


def gold_datasets(
    lines: DataFrame, silver_opts: DataFrame, grain_checked: bool = True, rollup: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All seven gold datasets, conformed to their contracts. Pass a stored
    ``order_rollup(lines)`` to share it between the order-grained datasets."""
    rollup = order_rollup(lines) if rollup is None else rollup
    raw = {
        "sales_hourly": sales_hourly(rollup),
        "restaurant_daily": restaurant_daily(rollup),
        "item_daily": item_daily(lines),
        "option_daily": option_daily(options_with_context(silver_opts, lines, grain_checked)),
        "customer_summary": customer_summary(rollup),
        "order_detail": order_detail(lines),
        "customer_ltv_daily": customer_ltv_daily(rollup),
    }
    return {name: conform(df, name) for name, df in raw.items()}


def row_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """C4: row count of every gold dataset (one small aggregate each, unioned;
    the seven plans share their silver input where Spark reuses exchanges)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in datasets.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
