"""Business metrics (M1-M18) over typed order lines.

Signature: ``fn(order_items[, options], *, as_of=None, include_guests=False)``.
The amount of a line is ``ITEM_PRICE * ITEM_QUANTITY`` (options are included
only in lifetime value, M1). ``as_of`` (text 'yyyy-MM-dd HH:mm:ss') anchors the
trailing month; by default it is the latest order time, computed as a scalar
subquery. Per-user metrics drop guests (null or blank USER_ID) unless
``include_guests``: all guests would otherwise form one giant "customer".

Skew: per-user windows never see a user's whole history. The most recent
lines/orders use ``row_number() <= k`` (Spark pushes a per-partition top-k
below the shuffle); average gaps between consecutive orders are telescoping
sums, so they are plain aggregates with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.columns import (
    amount,
    is_identified,
    money,
    revenue,
    trend_daypart,
    ts_literal,
    week_start,
)
from orderlens.functions.rounding import half_up_mean, half_up_ratio

C = F.col
TS = "CREATION_TIME_UTC"


def _people(items: DataFrame, include_guests: bool) -> DataFrame:
    return items if include_guests else items.filter(is_identified("USER_ID"))


def as_of_column(items: DataFrame, as_of: str | None) -> Column:
    if as_of is not None:
        return ts_literal(as_of, items.schema[TS].dataType)
    return items.select(F.max(TS)).scalar()


def trailing_month(items: DataFrame, as_of: str | None, include_guests: bool = False) -> DataFrame:
    """Lines (of identified users unless ``include_guests``) at or after
    ``as_of`` minus one month. The default anchor is the latest order of all
    lines, guests included. Lines of a table by month (ORDER_MONTH) are read from the
    month on in which the trailing month begins."""
    anchor = as_of_column(items, as_of)
    begin = anchor - F.expr("INTERVAL 1 MONTH")
    recent = _people(items, include_guests).filter(C(TS) >= begin)
    return recent.filter(C("ORDER_MONTH") >= F.trunc(F.to_date(begin), "month")) if "ORDER_MONTH" in items.columns else recent


# M1 -------------------------------------------------------------------------
def clv_lines(items: DataFrame, options: DataFrame, *, include_guests: bool = False) -> DataFrame:
    """M1: lifetime total per line = item amount + the line's option revenue
    (left join: lines without options keep their item amount)."""
    per_line = options.groupBy("ORDER_ID", "LINEITEM_ID").agg(
        F.sum(revenue("OPTION_PRICE", "OPTION_QUANTITY")).alias("_opt")
    )
    lines = _people(items, include_guests).select(
        "USER_ID", "ORDER_ID", "LINEITEM_ID", amount().alias("_item")
    )
    return lines.join(per_line, ["ORDER_ID", "LINEITEM_ID"], "left").select(
        "USER_ID", "ORDER_ID", "LINEITEM_ID",
        money(C("_item") + F.coalesce(C("_opt"), F.lit(0))).alias("lifetime_total"),
    )


def clv_customer(items: DataFrame, options: DataFrame, *, include_guests: bool = False) -> DataFrame:
    """M1 per user."""
    return (
        clv_lines(items, options, include_guests=include_guests)
        .groupBy("USER_ID")
        .agg(money(F.sum("lifetime_total")).alias("lifetime_total"))
    )


# M2, M3 ---------------------------------------------------------------------
def recent_purchases(items: DataFrame, k: int = 1, *, include_guests: bool = False) -> DataFrame:
    """M2 (k=1) / M3 (k=5): each user's k most recent lines; ties broken by
    ORDER_ID, LINEITEM_ID."""
    w = Window.partitionBy("USER_ID").orderBy(C(TS).desc(), C("ORDER_ID"), C("LINEITEM_ID"))
    ranked = _people(items, include_guests).withColumn("_rank", F.row_number().over(w))
    return ranked.filter(C("_rank") <= k).select(
        "USER_ID", "ORDER_ID", "LINEITEM_ID", TS, money(amount()).alias("total_purch_amount")
    )


# M4, M5, M6 -----------------------------------------------------------------
def purchase_frequency(items: DataFrame, *, as_of: str | None = None, include_guests: bool = False) -> DataFrame:
    """M4: distinct orders per user in the trailing month."""
    recent = trailing_month(items, as_of, include_guests)
    return recent.groupBy("USER_ID").agg(F.count_distinct("ORDER_ID").alias("number_of_purchases"))


def monthly_spend(items: DataFrame, *, as_of: str | None = None, include_guests: bool = False) -> DataFrame:
    """M5: amount spent per user in the trailing month."""
    recent = trailing_month(items, as_of, include_guests)
    return recent.groupBy("USER_ID").agg(money(F.sum(amount())).alias("total_amount_spent"))


def days_since_last_order(items: DataFrame, *, as_of: str | None = None, include_guests: bool = False) -> DataFrame:
    """M6: whole days (midnights crossed) from a user's last order to ``as_of``,
    for users active in the trailing month."""
    anchor = as_of_column(items, as_of)
    recent = trailing_month(items, as_of, include_guests)
    return recent.groupBy("USER_ID").agg(
        F.datediff(F.to_date(anchor), F.to_date(F.max(TS))).alias("days_since_last_order")
    )


# M7, M8 ---------------------------------------------------------------------
def order_totals(items: DataFrame, *, include_guests: bool = False) -> DataFrame:
    """Order grain: first line time and amount per (user, order)."""
    return _people(items, include_guests).groupBy("USER_ID", "ORDER_ID").agg(
        F.min(TS).alias("order_time"), F.sum(amount()).alias("order_total")
    )


def order_gaps(items: DataFrame, *, include_guests: bool = False) -> DataFrame:
    """M7: per user with more than one order: orders, average days and average
    spend change between consecutive orders (ordered by time, then ORDER_ID).

    The consecutive differences telescope: their sum is last minus first. So
    the averages are (last - first) / (count - 1): aggregates only. An order
    without a total has no difference to its neighbours; users with such orders get
    their differences step by step (``_step_sums``)."""
    orders = order_totals(items, include_guests=include_guests)
    key = F.struct("order_time", "ORDER_ID")
    per_user = orders.groupBy("USER_ID").agg(
        F.count("order_time").alias("total_orders"),
        F.count(F.lit(1)).alias("_n"),
        F.count("order_total").alias("_known"),
        F.min("order_time").alias("_t0"),
        F.max("order_time").alias("_t1"),
        F.min_by("order_total", key).alias("_v0"),
        F.max_by("order_total", key).alias("_v1"),
    )
    gaps = per_user.filter(C("_known") < C("_n")).select(C("USER_ID").alias("_user"))
    stepwise = _step_sums(orders.join(gaps, C("USER_ID").eqNullSafe(C("_user")), "left_semi"))
    joined = per_user.join(stepwise, C("USER_ID").eqNullSafe(C("_user")), "left")
    whole = C("_known") == C("_n")
    days = F.datediff(F.to_date("_t1"), F.to_date("_t0")).cast("double") / (C("total_orders") - 1)
    change = F.when(whole, C("_v1") - C("_v0")).otherwise(C("_steps")).cast("double")
    pairs = F.when(whole, C("_n") - 1).otherwise(F.nullif(C("_pairs"), F.lit(0)))
    return joined.filter(C("total_orders") > 1).select(
        "USER_ID",
        "total_orders",
        F.round(days, 6).alias("avg_days_between_orders"),
        F.round(change / pairs, 6).alias("avg_spend_diff_between_orders"),
    )


def _step_sums(orders: DataFrame) -> DataFrame:
    """(_user, _steps, _pairs): sum and number of the known differences between a user's
    consecutive orders.

    A user (all guests, say) may have any share of the orders, so histories are cut: orders
    are range-partitioned by user, time and order, a partition's orders of a user are one
    segment, and the lag runs within segments. What the borders of segments lack is the
    difference of a segment's first order to the last one of the segment before it: a lag
    over segments, of which a user has no more than there are partitions."""
    ranged = orders.repartitionByRange("USER_ID", "order_time", "ORDER_ID").withColumn("_segment", F.spark_partition_id())
    within = Window.partitionBy("USER_ID", "_segment").orderBy("order_time", "ORDER_ID")
    key = F.struct("order_time", "ORDER_ID")
    segments = (
        ranged.withColumn("_d", C("order_total") - F.lag("order_total").over(within))
        .groupBy(C("USER_ID").alias("_user"), "_segment")
        .agg(
            F.sum("_d").alias("_sum"), F.count("_d").alias("_n"),
            F.min_by("order_total", key).alias("_first"), F.max_by("order_total", key).alias("_last"),
        )
    )
    along = Window.partitionBy("_user").orderBy("_segment")
    bordered = segments.withColumn("_border", C("_first") - F.lag("_last").over(along))
    return bordered.groupBy("_user").agg(
        F.coalesce(F.sum("_sum") + F.sum("_border"), F.sum("_sum"), F.sum("_border")).alias("_steps"),
        (F.sum("_n") + F.count("_border")).alias("_pairs"),
    )


def spend_change_last_orders(items: DataFrame, k: int = 5, *, include_guests: bool = False) -> DataFrame:
    """M8: each user's k most recent orders with the previous order's total and
    the percent change (null when there is no previous order or it is 0).

    The previous order of the k-th most recent is the (k+1)-th, so only the
    k+1 most recent orders per user are kept (top-k below the shuffle) before
    the lag."""
    orders = order_totals(items, include_guests=include_guests)
    recency = Window.partitionBy("USER_ID").orderBy(C("order_time").desc(), C("ORDER_ID").desc())
    latest = orders.withColumn("_rank", F.row_number().over(recency)).filter(C("_rank") <= k + 1)
    chrono = Window.partitionBy("USER_ID").orderBy("order_time", "ORDER_ID")
    with_prev = latest.withColumn("prev_order_total", F.lag("order_total").over(chrono))
    prev = C("prev_order_total")
    pct = half_up_ratio(C("order_total") - prev, prev, scale_by=100)
    return with_prev.filter(C("_rank") <= k).select(
        "USER_ID",
        "ORDER_ID",
        "order_time",
        money("order_total").alias("order_total"),
        money(prev).alias("prev_order_total"),
        pct.alias("pct_change_from_prev_order"),
    )


# M9-M13 ---------------------------------------------------------------------
def weekly_revenue(items: DataFrame, by: str | None = None, wide: bool = True) -> DataFrame:
    """M9/M11/M13 (wide: one column per daypart + total) and M12/M13 (total
    only, ``wide=False``) per week (Monday), optionally per ``by`` column. A
    null time counts only in the total."""
    hour = F.hour(TS)
    amt = amount()
    zero = F.lit(0)
    keys = ([by] if by else []) + [week_start(TS).alias("order_week")]
    aggs = []
    if wide:
        aggs = [
            money(F.sum(F.when(hour < 12, amt).otherwise(zero))).alias("morning_revenue"),
            money(F.sum(F.when((hour >= 12) & (hour < 16), amt).otherwise(zero))).alias("afternoon_revenue"),
            money(F.sum(F.when(hour >= 16, amt).otherwise(zero))).alias("evening_revenue"),
        ]
    aggs.append(money(F.sum(amt)).alias("total_weekly_revenue"))
    return items.groupBy(*keys).agg(*aggs)


def weekly_daypart_long(items: DataFrame) -> DataFrame:
    """One row per week and daypart; sorted by week desc, then the
    daypart's earliest hour (an aggregate that is not returned)."""
    hour = F.hour(TS)
    grouped = items.groupBy(
        week_start(TS).alias("order_week"), trend_daypart(hour).alias("time_of_day")
    ).agg(money(F.sum(amount())).alias("total_revenue"), F.min(hour).alias("_first_hour"))
    return grouped.orderBy(C("order_week").desc(), C("_first_hour").asc_nulls_first()).drop(
        "_first_hour"
    )


# M14-M16 --------------------------------------------------------------------
def non_loyalty_orders(items: DataFrame, *, guests_only: bool = False) -> DataFrame:
    """One row over non-loyalty orders: count, average, max, min, total
    (rounded to cents). ``guests_only`` keeps orders of users without an id."""
    lines = items.filter(C("IS_LOYALTY") == False)  # noqa: E712
    if guests_only:
        lines = lines.filter(~is_identified("USER_ID"))
    per_order = lines.groupBy("ORDER_ID").agg(F.sum(amount()).alias("t"))
    return per_order.agg(
        F.count("ORDER_ID").alias("total_non_loyalty_orders"),
        half_up_mean(F.sum("t"), F.count("t")).alias("avg_amount_spent_per_order"),
        money(F.round(F.max("t"), 2)).alias("max_amount_spent_on_order"),
        money(F.round(F.min("t"), 2)).alias("min_amount_spent_on_order"),
        money(F.round(F.sum("t"), 2)).alias("total_non_loyalty_revenue"),
    )


def non_loyalty_customers(items: DataFrame) -> DataFrame:
    """Identified users' non-loyalty orders: count, average, total."""
    lines = items.filter((C("IS_LOYALTY") == False) & is_identified("USER_ID"))  # noqa: E712
    per_order = lines.groupBy("USER_ID", "ORDER_ID").agg(F.sum(amount()).alias("t"))
    return per_order.groupBy("USER_ID").agg(
        F.count("ORDER_ID").alias("total_orders"),
        half_up_mean(F.sum("t"), F.count("t")).alias("avg_purchase_amount"),
        money(F.round(F.sum("t"), 2)).alias("lifetime_spent"),
    )


def loyalty_customers(items: DataFrame, *, include_guests: bool = False) -> DataFrame:
    """Loyalty users: average order, number of orders, total (order grain
    first, so 'orders' counts orders)."""
    lines = _people(items, include_guests).filter(C("IS_LOYALTY") == True)  # noqa: E712
    per_order = lines.groupBy("USER_ID", "ORDER_ID").agg(F.sum(amount()).alias("t"))
    return per_order.groupBy("USER_ID").agg(
        half_up_mean(F.sum("t"), F.count("t")).alias("average_order_amount"),
        F.count("ORDER_ID").alias("number_of_orders"),
        money(F.sum("t")).alias("total_loyalty_revenue"),
    )


# M17, M18 -------------------------------------------------------------------
def top_locations(items: DataFrame) -> DataFrame:
    """Restaurant x week (of the order's earliest line): revenue, orders,
    average order value."""
    per_order = items.groupBy("RESTAURANT_ID", "ORDER_ID").agg(
        week_start(F.min(TS)).alias("order_week"), F.sum(amount()).alias("t")
    )
    return per_order.groupBy("RESTAURANT_ID", "order_week").agg(
        money(F.sum("t")).alias("total_revenue"),
        F.count("ORDER_ID").alias("weekly_order_count"),
        half_up_mean(F.sum("t"), F.count("t")).alias("average_order_value"),
    )


DISCOUNTED, FULL_PRICE = "Discounted Order", "Full Price Order"


def discount_effectiveness(items: DataFrame, options: DataFrame) -> DataFrame:
    """Discounted (any option priced 0) vs full-price orders: orders,
    revenue, average order value and shares of the total.

    The shares divide by the sum over the (at most two) status rows, a window
    over the grouped result, not over the data."""
    discounted = options.filter(C("OPTION_PRICE") == 0).select("ORDER_ID").distinct()
    totals = items.groupBy("ORDER_ID").agg(F.sum(amount()).alias("t"))
    classified = totals.join(
        discounted.withColumn("_d", F.lit(True)), "ORDER_ID", "left"
    ).withColumn(
        "discount_status", F.when(C("_d"), F.lit(DISCOUNTED)).otherwise(F.lit(FULL_PRICE))
    )
    grouped = classified.groupBy("discount_status").agg(
        F.count("ORDER_ID").alias("total_orders"),
        F.sum("t").alias("_rev"),
        half_up_mean(F.sum("t"), F.count("t")).alias("average_order_value"),
    )
    everything = Window.partitionBy()
    share = lambda part, whole: half_up_ratio(part, whole, scale_by=100)
    return grouped.select(
        "discount_status",
        "total_orders",
        money(F.round("_rev", 2)).alias("total_revenue"),
        "average_order_value",
        share(C("total_orders"), F.sum("total_orders").over(everything)).alias("pct_of_total_orders"),
        share(C("_rev"), F.sum("_rev").over(everything)).alias("pct_of_total_revenue"),
    )


# Report order (O1-O3) -------------------------------------------------------
# Sort keys of the metric reports that have an order; a leading "-" sorts descending.
REPORT_ORDER: dict[str, list[str]] = {
    "purchase_frequency": ["-number_of_purchases", "USER_ID"],
    "monthly_spend": ["-total_amount_spent", "USER_ID"],
    "days_since_last_order": ["-days_since_last_order", "USER_ID"],
    "order_gaps": ["avg_days_between_orders", "USER_ID"],
    "spend_change_5": ["USER_ID", "order_time"],
    "weekly_daypart_wide": ["-order_week"],
    "restaurant_weekly_daypart": ["RESTAURANT_ID", "-order_week"],
    "restaurant_weekly": ["RESTAURANT_ID", "-order_week"],
    "category_weekly_daypart": ["ITEM_CATEGORY", "-order_week"],
    "category_weekly": ["ITEM_CATEGORY", "-order_week"],
    "non_loyalty_customers": ["-lifetime_spent", "USER_ID"],
    "top_locations": ["RESTAURANT_ID", "-order_week"],
}


def in_report_order(df: DataFrame, name: str) -> DataFrame:
    """Sort a metric as its report is sorted (a distributed range sort)."""
    keys = REPORT_ORDER.get(name)
    if not keys:
        return df
    return df.orderBy(*[C(k[1:]).desc() if k.startswith("-") else C(k).asc() for k in keys])
