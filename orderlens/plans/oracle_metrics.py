"""DuckDB oracle SQL for the business metrics (M1-M18), from the metrics'
definitions: an order beside the one of the preceding place, EXISTS for free options,
totals as scalar subqueries."""

from __future__ import annotations

from orderlens.plans.oracle_fixtures import half_up_avg

M = "DECIMAL(38,2)"
AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"
IDENT = "USER_ID IS NOT NULL AND trim(USER_ID) <> ''"
AMT = "ITEM_PRICE * ITEM_QUANTITY"
WEEK = "CAST(date_trunc('week', CREATION_TIME_UTC) AS DATE)"
HOUR = "hour(CREATION_TIME_UTC)"


def exact_ratio(num: str, den: str) -> str:
    """round half away from zero of num / den * 100 to 2 places, exactly, for
    decimals of scale <= 2 (integer arithmetic in hundredths)."""
    a = f"(CAST(({num}) * 100 AS HUGEINT) * 10000)"
    b = f"CAST(({den}) * 100 AS HUGEINT)"
    q = f"((2 * abs({a}) + abs({b})) // (2 * abs({b})))"
    return (
        f"CASE WHEN {b} = 0 THEN NULL ELSE CAST(CAST(sign({a}) * sign({b}) * {q} AS DECIMAL(38,0))"
        f" * CAST(0.01 AS DECIMAL(2,2)) AS {M}) END"
    )


def _weekly(by: str | None, wide: bool) -> str:
    keys = (f"{by}, " if by else "") + f"{WEEK} AS order_week"
    cols = ""
    if wide:
        cols = (
            f"CAST(SUM(CASE WHEN {HOUR} < 12 THEN {AMT} ELSE 0 END) AS {M}) AS morning_revenue, "
            f"CAST(SUM(CASE WHEN {HOUR} >= 12 AND {HOUR} < 16 THEN {AMT} ELSE 0 END) AS {M}) AS afternoon_revenue, "
            f"CAST(SUM(CASE WHEN {HOUR} >= 16 THEN {AMT} ELSE 0 END) AS {M}) AS evening_revenue, "
        )
    return f"SELECT {keys}, {cols}CAST(SUM({AMT}) AS {M}) AS total_weekly_revenue FROM order_items GROUP BY ALL"


def _numbered_orders(who: str) -> str:
    """Orders with their place in their customer's history, from 1."""
    return f"""
SELECT *, row_number() OVER (PARTITION BY USER_ID ORDER BY first_line NULLS FIRST, ORDER_ID NULLS FIRST) AS place FROM (
  SELECT USER_ID, ORDER_ID, min(CREATION_TIME_UTC) AS first_line, sum({AMT}) AS spent FROM order_items WHERE {who} GROUP BY ALL)"""


def _order_gaps(who: str) -> str:
    """Every order beside the one of the preceding place."""
    orders = _numbered_orders(who)
    return f"""
SELECT a.USER_ID, count(a.first_line) AS total_orders,
  round(avg(date_diff('day', CAST(b.first_line AS DATE), CAST(a.first_line AS DATE))), 6) AS avg_days_between_orders,
  round(CAST(avg(CAST(a.spent - b.spent AS DOUBLE)) AS DOUBLE), 6) AS avg_spend_diff_between_orders
FROM ({orders}) a LEFT JOIN ({orders}) b ON a.USER_ID IS NOT DISTINCT FROM b.USER_ID AND b.place = a.place - 1
GROUP BY a.USER_ID HAVING count(a.first_line) > 1"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clv_lines"] = f"""
SELECT i.USER_ID, i.ORDER_ID, i.LINEITEM_ID, CAST(i.{AMT} + COALESCE(o.OPTION_REVENUE, 0) AS {M}) AS lifetime_total
FROM order_items i LEFT JOIN options_by_line o ON i.ORDER_ID = o.ORDER_ID AND i.LINEITEM_ID = o.LINEITEM_ID
WHERE i.{IDENT}"""
    q["clv_customer"] = f"""
SELECT i.USER_ID, CAST(SUM(i.{AMT} + COALESCE(o.OPTION_REVENUE, 0)) AS {M}) AS lifetime_total
FROM order_items i LEFT JOIN options_by_line o ON i.ORDER_ID = o.ORDER_ID AND i.LINEITEM_ID = o.LINEITEM_ID
WHERE i.{IDENT} GROUP BY i.USER_ID"""
    for name, k in (("recent_purchase", "= 1"), ("recent_purchases_5", "<= 5")):
        q[name] = f"""
SELECT USER_ID, ORDER_ID, LINEITEM_ID, CREATION_TIME_UTC, CAST({AMT} AS {M}) AS total_purch_amount
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY USER_ID ORDER BY CREATION_TIME_UTC DESC, ORDER_ID NULLS FIRST, LINEITEM_ID) AS rk
      FROM order_items WHERE {IDENT}) t WHERE rk {k}"""
    recent = f"FROM order_items WHERE {IDENT} AND CREATION_TIME_UTC >= {AS_OF} - INTERVAL 1 MONTH GROUP BY USER_ID"
    q["purchase_frequency"] = f"SELECT USER_ID, COUNT(DISTINCT ORDER_ID) AS number_of_purchases {recent}"
    q["monthly_spend"] = f"SELECT USER_ID, CAST(SUM({AMT}) AS {M}) AS total_amount_spent {recent}"
    q["days_since_last_order"] = f"""
SELECT USER_ID, CAST(date_diff('day', CAST(MAX(CREATION_TIME_UTC) AS DATE), CAST({AS_OF} AS DATE)) AS INTEGER)
  AS days_since_last_order {recent}"""
    q["order_gaps"] = _order_gaps(IDENT)
    q["order_gaps_all"] = _order_gaps("TRUE")
    latest = "(SELECT max(CREATION_TIME_UTC) FROM order_items) - INTERVAL 1 MONTH"
    q["purchase_frequency_latest"] = f"""
SELECT USER_ID, count(DISTINCT ORDER_ID) AS number_of_purchases FROM order_items WHERE CREATION_TIME_UTC >= {latest} GROUP BY ALL"""
    q["monthly_spend_latest"] = f"""
SELECT USER_ID, CAST(sum({AMT}) AS {M}) AS total_amount_spent FROM order_items WHERE CREATION_TIME_UTC >= {latest} GROUP BY ALL"""
    orders = _numbered_orders(IDENT)
    q["spend_change_5"] = f"""
SELECT a.USER_ID, a.ORDER_ID, a.first_line AS order_time, CAST(a.spent AS {M}) AS order_total,
  CAST(b.spent AS {M}) AS prev_order_total, {exact_ratio("a.spent - b.spent", "b.spent")} AS pct_change_from_prev_order
FROM ({orders}) a LEFT JOIN ({orders}) b ON a.USER_ID = b.USER_ID AND b.place = a.place - 1
WHERE a.place > (SELECT max(c.place) - 5 FROM ({orders}) c WHERE c.USER_ID = a.USER_ID)"""
    q["weekly_daypart_wide"] = _weekly(None, True)
    q["weekly_daypart_long"] = f"""
SELECT {WEEK} AS order_week,
  CASE WHEN {HOUR} < 12 THEN 'Morning' WHEN {HOUR} < 16 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day,
  CAST(SUM({AMT}) AS {M}) AS total_revenue
FROM order_items GROUP BY ALL"""
    q["restaurant_weekly_daypart"] = _weekly("RESTAURANT_ID", True)
    q["restaurant_weekly"] = _weekly("RESTAURANT_ID", False)
    q["category_weekly_daypart"] = _weekly("ITEM_CATEGORY", True)
    q["category_weekly"] = _weekly("ITEM_CATEGORY", False)
    for name, extra in (("non_loyalty_orders", ""), ("guest_orders", f" AND NOT ({IDENT})")):
        q[name] = f"""
WITH t AS (SELECT ORDER_ID, SUM({AMT}) AS order_total FROM order_items
           WHERE IS_LOYALTY = FALSE{extra} GROUP BY ORDER_ID)
SELECT COUNT(ORDER_ID) AS total_non_loyalty_orders,
  {half_up_avg("SUM(order_total)", "COUNT(order_total)")} AS avg_amount_spent_per_order,
  CAST(ROUND(MAX(order_total), 2) AS {M}) AS max_amount_spent_on_order,
  CAST(ROUND(MIN(order_total), 2) AS {M}) AS min_amount_spent_on_order,
  CAST(ROUND(SUM(order_total), 2) AS {M}) AS total_non_loyalty_revenue
FROM t"""
    q["non_loyalty_customers"] = f"""
WITH t AS (SELECT USER_ID, ORDER_ID, SUM({AMT}) AS order_total FROM order_items
           WHERE IS_LOYALTY = FALSE AND {IDENT} GROUP BY USER_ID, ORDER_ID)
SELECT USER_ID, COUNT(ORDER_ID) AS total_orders,
  {half_up_avg("SUM(order_total)", "COUNT(order_total)")} AS avg_purchase_amount,
  CAST(ROUND(SUM(order_total), 2) AS {M}) AS lifetime_spent
FROM t GROUP BY USER_ID"""
    q["loyalty_customers"] = f"""
WITH t AS (SELECT USER_ID, ORDER_ID, SUM({AMT}) AS order_total FROM order_items
           WHERE IS_LOYALTY = TRUE AND {IDENT} GROUP BY USER_ID, ORDER_ID)
SELECT USER_ID, {half_up_avg("SUM(order_total)", "COUNT(order_total)")} AS average_order_amount,
  COUNT(ORDER_ID) AS number_of_orders, CAST(SUM(order_total) AS {M}) AS total_loyalty_revenue
FROM t GROUP BY USER_ID"""
    q["top_locations"] = f"""
SELECT RESTAURANT_ID, CAST(date_trunc('week', first_line) AS DATE) AS order_week, CAST(sum(spent) AS {M}) AS total_revenue,
  count(ORDER_ID) AS weekly_order_count, {half_up_avg("sum(spent)", "count(spent)")} AS average_order_value
FROM (SELECT RESTAURANT_ID, ORDER_ID, min(CREATION_TIME_UTC) AS first_line, sum({AMT}) AS spent
      FROM order_items GROUP BY RESTAURANT_ID, ORDER_ID)
GROUP BY ALL"""
    per_order = f"SELECT ORDER_ID, sum({AMT}) AS spent FROM order_items GROUP BY ORDER_ID"
    free = "EXISTS (SELECT 1 FROM order_items_options f WHERE f.ORDER_ID = p.ORDER_ID AND f.OPTION_PRICE = 0)"
    n_all = f"(SELECT count(ORDER_ID) FROM ({per_order}))"
    spent_all = f"(SELECT sum(spent) FROM ({per_order}))"
    q["discount_effectiveness"] = f"""
SELECT CASE WHEN {free} THEN 'Discounted Order' ELSE 'Full Price Order' END AS discount_status,
  count(p.ORDER_ID) AS total_orders, CAST(round(sum(p.spent), 2) AS {M}) AS total_revenue,
  {half_up_avg("sum(p.spent)", "count(p.spent)")} AS average_order_value,
  {exact_ratio("count(p.ORDER_ID)", n_all)} AS pct_of_total_orders,
  {exact_ratio("sum(p.spent)", spent_all)} AS pct_of_total_revenue
FROM ({per_order}) p GROUP BY 1"""
    return q
