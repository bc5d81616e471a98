"""DuckDB oracle SQL for every registered query.

Each entry is an independent formulation of the query in DuckDB SQL over the
fixture CTEs (``oracle_fixtures``). Types are cast to what Spark produces:
DuckDB sums integers to HUGEINT (cast BIGINT), multiplies int x decimal to a
narrower decimal (cast), returns BIGINT for hour/week (cast INTEGER) and divides
decimals as DOUBLE (exact half-up instead, ``half_up_avg``).
"""

from __future__ import annotations

from orderlens.plans.oracle_fixtures import average_order, half_up_avg, with_fixtures

M = "DECIMAL(38,2)"


def _gold() -> dict[str, str]:
    q: dict[str, str] = {}
    q["silver_order_items"] = "SELECT * EXCLUDE (ORDER_ID), ORDER_ID FROM silver_items"
    q["options_by_line"] = "SELECT * FROM options_by_line"
    q["unmatched_options"] = """
SELECT DISTINCT o.ORDER_ID, o.LINEITEM_ID FROM order_items_options o
WHERE NOT EXISTS (SELECT 1 FROM order_items i WHERE i.ORDER_ID = o.ORDER_ID AND i.LINEITEM_ID = o.LINEITEM_ID)"""
    q["silver_options"] = "SELECT * FROM silver_options"
    q["calendar"] = "SELECT * EXCLUDE (day_index) FROM cal"
    q["order_summary"] = f"""
SELECT ORDER_ID, MIN(APP_NAME) AS APP_NAME, MIN(RESTAURANT_ID) AS RESTAURANT_ID, MIN(ORDER_DATE) AS ORDER_DATE,
  CAST(SUM(TOTAL_LINE_REVENUE) AS {M}) AS ORDER_TOTAL, CAST(SUM(ITEM_QUANTITY) AS BIGINT) AS ORDER_TOTAL_ITEMS
FROM silver_items GROUP BY ORDER_ID"""
    q["sales_hourly"] = f"""
SELECT APP_NAME AS app_name, RESTAURANT_ID AS restaurant_id, ORDER_DATE AS order_date,
  ORDER_HOUR_UTC AS order_hour_utc, TIME_OF_DAY_UTC AS time_of_day_utc, is_weekend,
  COUNT(DISTINCT ORDER_ID) AS order_count, COUNT(*) AS line_item_count,
  CAST(SUM(ITEM_QUANTITY) AS BIGINT) AS item_quantity,
  CAST(SUM(ITEM_REVENUE) AS {M}) AS item_revenue, CAST(SUM(OPTION_REVENUE) AS {M}) AS option_revenue,
  CAST(SUM(TOTAL_LINE_REVENUE) AS {M}) AS total_revenue,
  {average_order("SUM(TOTAL_LINE_REVENUE)", "COUNT(DISTINCT ORDER_ID)")} AS average_order_value
FROM silver_items GROUP BY ALL"""
    q["restaurant_daily"] = f"""
SELECT APP_NAME AS app_name, RESTAURANT_ID AS restaurant_id, ORDER_DATE AS order_date, day_of_week,
  is_weekend, is_holiday, holiday_name,
  COUNT(DISTINCT ORDER_ID) AS order_count,
  COUNT(DISTINCT CASE WHEN CUSTOMER_TYPE = 'IDENTIFIED' THEN USER_ID END) AS customer_count,
  COUNT(*) AS line_item_count,
  CAST(SUM(ITEM_REVENUE) AS {M}) AS item_revenue, CAST(SUM(OPTION_REVENUE) AS {M}) AS option_revenue,
  CAST(SUM(TOTAL_LINE_REVENUE) AS {M}) AS total_revenue,
  {average_order("SUM(TOTAL_LINE_REVENUE)", "COUNT(DISTINCT ORDER_ID)")} AS average_order_value
FROM silver_items GROUP BY ALL"""
    q["item_daily"] = f"""
SELECT APP_NAME AS app_name, RESTAURANT_ID AS restaurant_id, ORDER_DATE AS order_date,
  ITEM_CATEGORY AS item_category, ITEM_NAME AS item_name,
  CAST(SUM(ITEM_QUANTITY) AS BIGINT) AS quantity_sold, COUNT(DISTINCT ORDER_ID) AS order_count,
  CAST(SUM(ITEM_REVENUE) AS {M}) AS item_revenue,
  {half_up_avg("SUM(ITEM_PRICE)", "COUNT(ITEM_PRICE)")} AS average_item_price
FROM silver_items GROUP BY ALL"""
    q["options_with_context"] = """
SELECT o.*, i.APP_NAME, i.RESTAURANT_ID, i.ORDER_DATE
FROM silver_options o JOIN silver_items i ON o.ORDER_ID = i.ORDER_ID AND o.LINEITEM_ID = i.LINEITEM_ID"""
    q["option_daily"] = f"""
SELECT i.APP_NAME AS app_name, i.RESTAURANT_ID AS restaurant_id, i.ORDER_DATE AS order_date,
  o.OPTION_GROUP_NAME AS option_group_name, o.OPTION_NAME AS option_name,
  CAST(SUM(o.OPTION_QUANTITY) AS BIGINT) AS option_quantity,
  CAST(SUM(o.OPTION_REVENUE) AS {M}) AS option_revenue,
  COUNT(DISTINCT o.ORDER_ID) AS order_count,
  {half_up_avg("SUM(o.OPTION_PRICE)", "COUNT(o.OPTION_PRICE)")} AS average_option_price,
  CAST(SUM(CASE WHEN o.OPTION_PRICE = 0 THEN o.OPTION_QUANTITY ELSE 0 END) AS BIGINT) AS free_option_quantity,
  CAST(SUM(CASE WHEN o.OPTION_PRICE > 0 THEN o.OPTION_QUANTITY ELSE 0 END) AS BIGINT) AS paid_option_quantity,
  COUNT(DISTINCT CASE WHEN o.OPTION_PRICE = 0 THEN o.ORDER_ID END) AS free_option_order_count,
  COUNT(DISTINCT CASE WHEN o.OPTION_PRICE > 0 THEN o.ORDER_ID END) AS paid_option_order_count,
  CAST(SUM(CASE WHEN o.OPTION_PRICE > 0 THEN o.OPTION_REVENUE ELSE 0 END) AS {M}) AS paid_option_revenue
FROM silver_options o JOIN silver_items i ON o.ORDER_ID = i.ORDER_ID AND o.LINEITEM_ID = i.LINEITEM_ID
GROUP BY ALL"""
    q["customer_summary"] = f"""
SELECT USER_ID AS user_id, COUNT(DISTINCT ORDER_ID) AS order_count,
  CAST(SUM(ITEM_QUANTITY) AS BIGINT) AS item_count,
  CAST(SUM(ITEM_REVENUE) AS {M}) AS total_item_revenue,
  CAST(SUM(OPTION_REVENUE) AS {M}) AS total_option_revenue,
  CAST(SUM(TOTAL_LINE_REVENUE) AS {M}) AS total_revenue,
  {average_order("SUM(TOTAL_LINE_REVENUE)", "COUNT(DISTINCT ORDER_ID)")} AS average_order_value,
  MIN(ORDER_DATE) AS first_order_date, MAX(ORDER_DATE) AS last_order_date,
  COUNT(DISTINCT CASE WHEN IS_LOYALTY THEN ORDER_ID END) AS loyalty_order_count,
  CAST(SUM(CASE WHEN IS_LOYALTY THEN TOTAL_LINE_REVENUE ELSE 0 END) AS {M}) AS loyalty_revenue
FROM identified GROUP BY USER_ID"""
    q["customer_daily_activity"] = f"""
SELECT USER_ID, ORDER_DATE, CAST(SUM(TOTAL_LINE_REVENUE) AS {M}) AS DAILY_REVENUE,
  COUNT(DISTINCT ORDER_ID) AS DAILY_ORDER_COUNT
FROM identified GROUP BY USER_ID, ORDER_DATE"""
    q["customer_ltv_daily"] = f"""
SELECT USER_ID AS user_id, ORDER_DATE AS order_date, CAST(rev AS {M}) AS daily_revenue,
  CAST(SUM(rev) OVER (PARTITION BY USER_ID ORDER BY ORDER_DATE ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {M}) AS cumulative_ltv,
  n AS daily_order_count,
  CAST(SUM(n) OVER (PARTITION BY USER_ID ORDER BY ORDER_DATE ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_order_count
FROM (SELECT USER_ID, ORDER_DATE, SUM(TOTAL_LINE_REVENUE) AS rev, COUNT(DISTINCT ORDER_ID) AS n
      FROM identified GROUP BY USER_ID, ORDER_DATE) d"""
    # whatever the increments, the values are those of all orders
    q["customer_ltv_refreshed"] = q["customer_ltv_daily"]
    q["order_detail"] = f"""
SELECT APP_NAME AS app_name, RESTAURANT_ID AS restaurant_id, ORDER_DATE AS order_date, ORDER_ID AS order_id,
  LINEITEM_ID AS lineitem_id, USER_ID AS user_id, ITEM_CATEGORY AS item_category, ITEM_NAME AS item_name,
  IS_LOYALTY AS is_loyalty, CARD_STATUS AS card_status, TIME_OF_DAY_UTC AS time_of_day_utc,
  CAST(ITEM_PRICE AS {M}) AS item_price, CAST(ITEM_QUANTITY AS BIGINT) AS item_quantity,
  CAST(ITEM_REVENUE AS {M}) AS item_revenue, CAST(OPTION_REVENUE AS {M}) AS option_revenue,
  CAST(TOTAL_LINE_REVENUE AS {M}) AS total_line_revenue
FROM silver_items"""
    gold_names = ["sales_hourly", "restaurant_daily", "item_daily", "option_daily", "customer_summary",
                  "order_detail", "customer_ltv_daily"]
    q["gold_row_counts"] = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM ({q[n]})" for n in gold_names
    )
    # repeated rows: a key that stands twice by the seed or by itself
    q["check_silver_grain"] = """
SELECT ORDER_ID, LINEITEM_ID, CAST(SUM(CASE WHEN LINEITEM_ID LIKE '%7-1' THEN 2 ELSE 1 END) AS BIGINT) AS count
FROM silver_items GROUP BY ALL HAVING COUNT(*) > 1 OR ANY_VALUE(LINEITEM_ID) LIKE '%7-1'"""
    q["check_ltv_grain"] = f"""
SELECT user_id, order_date, CAST(2 * COUNT(*) AS BIGINT) AS count FROM ({q["customer_ltv_daily"]})
WHERE day(order_date) = 1 GROUP BY ALL"""
    q["check_order_detail_grain"] = """
SELECT ORDER_ID AS order_id, LINEITEM_ID AS lineitem_id,
  CAST(SUM(CASE WHEN LINEITEM_ID LIKE '%7-1' THEN 2 ELSE 1 END) AS BIGINT) AS count
FROM silver_items GROUP BY ALL HAVING COUNT(*) > 1 OR ANY_VALUE(LINEITEM_ID) LIKE '%7-1'"""
    return q


def oracle_queries() -> dict[str, str]:
    raw: dict[str, str] = {}
    raw.update(_gold())
    from orderlens.plans import oracle_metrics, oracle_quality  # noqa: PLC0415

    raw.update(oracle_metrics.queries())
    raw.update(oracle_quality.queries())
    return {name: with_fixtures(sql) for name, sql in raw.items()}
