"""DuckDB twin of ``orderlens.sources.fixtures`` as SQL common table expressions.

Every oracle query is ``WITH <these CTEs> SELECT ...`` over the pre-registered
test-table views. Each CTE is materialized once per query.
"""

from __future__ import annotations

import re

# (name, body) in dependency order.
FIXTURE_CTES: list[tuple[str, str]] = [
    ("li", """
SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
  l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS rn
FROM lineitem"""),
    ("order_items", """
SELECT r_name AS APP_NAME, n_name AS RESTAURANT_ID,
  o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR + (o_orderkey % 60) * INTERVAL '1' MINUTE AS CREATION_TIME_UTC,
  CASE WHEN o_orderkey % 29 = 0 AND rn = 1 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS ORDER_ID,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN ' ' ELSE CAST(o_custkey AS VARCHAR) END AS USER_ID,
  CASE WHEN o_orderkey % 7 = 0 THEN CAST(1000000 + o_custkey AS VARCHAR) WHEN o_orderkey % 7 = 1 THEN '' END AS PRINTED_CARD_NUMBER,
  (o_orderstatus = 'F' AND o_orderkey % 10 > 1) AS IS_LOYALTY,
  'USD' AS CURRENCY,
  CAST(o_orderkey AS VARCHAR) || '-' || CAST(rn AS VARCHAR) AS LINEITEM_ID,
  p_type AS ITEM_CATEGORY, p_name AS ITEM_NAME,
  CAST(CASE WHEN o_orderkey % 31 <> 0 THEN p_retailprice END AS DECIMAL(10,2)) AS ITEM_PRICE,
  CAST(l_quantity AS INTEGER) AS ITEM_QUANTITY
FROM li JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey"""),
    ("placed_options", """
SELECT CASE WHEN l_partkey % 97 = 0 THEN 'ORPHAN-' || CAST(l_orderkey AS VARCHAR) ELSE CAST(l_orderkey AS VARCHAR) END AS ORDER_ID,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(rn AS VARCHAR) AS LINEITEM_ID,
  CASE WHEN n = 3 THEN 'group-1' ELSE 'group-' || CAST(n AS VARCHAR) END AS OPTION_GROUP_NAME,
  'opt-' || CAST(CASE WHEN n = 3 THEN l_partkey % 5 ELSE (l_partkey + n - 1) % 5 END AS VARCHAR) AS OPTION_NAME,
  CAST(CASE WHEN n = 2 THEN 0 WHEN n = 3 AND l_orderkey % 22 = 0 THEN l_discount * 10 + 1 ELSE l_discount * 10 END AS DECIMAL(10,2)) AS OPTION_PRICE,
  CAST(1 + l_partkey % 3 AS INTEGER) AS OPTION_QUANTITY,
  CAST((l_orderkey * 1000 + rn) * 4 + n AS BIGINT) AS place
FROM (SELECT *, UNNEST(GENERATE_SERIES(1, CASE WHEN l_orderkey % 11 = 0 THEN 3 WHEN l_orderkey % 5 < 2 THEN 2
        WHEN l_orderkey % 5 = 2 THEN 1 ELSE 0 END)) AS n FROM li) x"""),
    ("order_items_options", "SELECT * EXCLUDE (place) FROM placed_options"),
    ("days", """
SELECT CAST(UNNEST(GENERATE_SERIES(s, e, INTERVAL 1 DAY)) AS DATE) AS date_key, s
FROM (SELECT CAST(date_trunc('year', MIN(o_orderdate)) AS DATE) AS s,
             CAST(date_trunc('year', MAX(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS e
      FROM orders) b"""),
    ("cal", """
SELECT date_key, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month,
  CAST(weekofyear(date_key) AS INTEGER) AS week, dayname(date_key) AS day_of_week,
  dayofweek(date_key) IN (0, 6) AS is_weekend, FALSE AS is_holiday, CAST(NULL AS VARCHAR) AS holiday_name,
  CAST(date_key - s AS BIGINT) AS day_index
FROM days"""),
    ("raw_order_items", """
WITH b AS (SELECT i.*, CAST(split_part(LINEITEM_ID, '-', 1) AS BIGINT) AS o, CAST(split_part(LINEITEM_ID, '-', 2) AS BIGINT) AS n
           FROM order_items i),
r AS (SELECT *, o * 7 + n AS h, UNNEST(CASE WHEN (o * 7 + n) % 149 = 0 THEN [0, 1] ELSE [0] END) AS dup FROM b)
SELECT CAST((o * 1000 + n) * 2 + 2 + dup AS BIGINT) AS source_row, APP_NAME, RESTAURANT_ID,
  CASE WHEN h % 137 = 0 THEN 'not-a-time' WHEN h % 151 = 0 THEN '4:39' WHEN h % 157 = 0 THEN '2021'
       WHEN h % 173 = 0 THEN CAST(CREATION_TIME_UTC AS VARCHAR) || '+02:00' ELSE CAST(CREATION_TIME_UTC AS VARCHAR) END AS CREATION_TIME_UTC,
  ORDER_ID, USER_ID, PRINTED_CARD_NUMBER,
  CASE WHEN h % 131 = 0 THEN 'maybe' WHEN IS_LOYALTY THEN 'TRUE' ELSE 'FALSE' END AS IS_LOYALTY,
  CASE WHEN h % 127 = 0 THEN 'usd' ELSE CURRENCY END AS CURRENCY,
  CASE WHEN h % 139 = 0 THEN NULL ELSE LINEITEM_ID END AS LINEITEM_ID,
  CASE WHEN h % 139 = 0 THEN chr(9) || ' ' || chr(10) WHEN h % 179 = 0 THEN 'see http://example.com/menu' ELSE ITEM_CATEGORY END AS ITEM_CATEGORY,
  CASE WHEN h % 139 = 0 THEN '' ELSE ITEM_NAME END AS ITEM_NAME,
  CASE WHEN h % 101 = 0 THEN '4:39' WHEN h % 103 = 0 THEN '-1.00' WHEN h % 163 = 0 THEN '12d'
       WHEN h % 167 = 0 THEN ' 12.50' || chr(9) ELSE CAST(ITEM_PRICE AS VARCHAR) END AS ITEM_PRICE,
  CASE WHEN h % 107 = 0 THEN '0' WHEN h % 109 = 0 THEN '1.5' WHEN h % 113 = 0 THEN 'x' WHEN h % 181 = 0 THEN '12F'
       ELSE CAST(ITEM_QUANTITY AS VARCHAR) END AS ITEM_QUANTITY
FROM r"""),
    ("raw_options", """
SELECT place + 2 AS source_row,
  CASE WHEN LINEITEM_ID LIKE '%77-1' THEN NULL ELSE ORDER_ID END AS ORDER_ID, LINEITEM_ID, OPTION_GROUP_NAME, OPTION_NAME,
  CASE WHEN LINEITEM_ID LIKE '%13-2' THEN '-0.50' WHEN LINEITEM_ID LIKE '%17-3' THEN 'free' ELSE CAST(OPTION_PRICE AS VARCHAR) END AS OPTION_PRICE,
  CASE WHEN LINEITEM_ID LIKE '%19-1' THEN '0' WHEN LINEITEM_ID LIKE '%23-1' THEN ' ' || chr(9) ELSE CAST(OPTION_QUANTITY AS VARCHAR) END AS OPTION_QUANTITY
FROM placed_options"""),
    ("raw_date_dim", """
SELECT CAST(day_index * 2 + dup + 2 AS BIGINT) AS source_row,
 CASE WHEN day(date_key) = 31 AND month = 1 THEN '31/01/' || CAST(year AS VARCHAR)
      ELSE LPAD(CAST(day(date_key) AS VARCHAR), 2, '0') || '-' || LPAD(CAST(month AS VARCHAR), 2, '0') || '-' || CAST(year AS VARCHAR) END AS date_key,
 CAST(year AS VARCHAR) AS year,
 CASE WHEN day(date_key) = 30 AND month = 6 THEN '13' ELSE CAST(month AS VARCHAR) END AS month,
 CASE WHEN day(date_key) = 29 AND month = 3 THEN '1.5' WHEN day(date_key) = 28 AND month = 3 THEN 'wk' ELSE CAST(week AS VARCHAR) END AS week,
 CASE WHEN day(date_key) = 4 AND month = 7 THEN 'monday' ELSE day_of_week END AS day_of_week,
 CASE WHEN is_weekend THEN 'TRUE' ELSE 'FALSE' END AS is_weekend,
 CASE WHEN day(date_key) = 25 AND month = 12 THEN 'yes' ELSE 'FALSE' END AS is_holiday,
 CASE WHEN day(date_key) = 25 AND month = 12 THEN 'Christmas' ELSE '' END AS holiday_name
FROM (SELECT *, UNNEST(CASE WHEN day(date_key) = 15 AND month = 1 THEN [0, 1] ELSE [0] END) AS dup FROM cal) c"""),
    ("options_by_line", """
SELECT ORDER_ID, LINEITEM_ID,
  CAST(SUM(CAST(OPTION_PRICE AS DECIMAL(18,2)) * OPTION_QUANTITY) AS DECIMAL(38,2)) AS OPTION_REVENUE
FROM order_items_options GROUP BY ORDER_ID, LINEITEM_ID"""),
    ("silver_items", """
SELECT i.ORDER_ID, i.LINEITEM_ID, i.APP_NAME, i.RESTAURANT_ID, i.CREATION_TIME_UTC, i.USER_ID,
  i.PRINTED_CARD_NUMBER, i.IS_LOYALTY, i.CURRENCY, i.ITEM_CATEGORY, i.ITEM_NAME, i.ITEM_PRICE, i.ITEM_QUANTITY,
  CAST(CAST(i.ITEM_PRICE AS DECIMAL(18,2)) * i.ITEM_QUANTITY AS DECIMAL(29,2)) AS ITEM_REVENUE,
  CAST(i.CREATION_TIME_UTC AS DATE) AS ORDER_DATE,
  CAST(hour(i.CREATION_TIME_UTC) AS INTEGER) AS ORDER_HOUR_UTC,
  CASE WHEN hour(i.CREATION_TIME_UTC) < 5 THEN 'Night' WHEN hour(i.CREATION_TIME_UTC) < 12 THEN 'Morning'
       WHEN hour(i.CREATION_TIME_UTC) < 17 THEN 'Afternoon' ELSE 'Evening' END AS TIME_OF_DAY_UTC,
  CASE WHEN i.USER_ID IS NULL OR trim(i.USER_ID) = '' THEN 'GUEST' ELSE 'IDENTIFIED' END AS CUSTOMER_TYPE,
  CASE WHEN i.PRINTED_CARD_NUMBER IS NOT NULL AND trim(i.PRINTED_CARD_NUMBER) <> '' THEN 'CARD_PRESENT' ELSE 'NO_CARD' END AS CARD_STATUS,
  COALESCE(o.OPTION_REVENUE, CAST(0 AS DECIMAL(38,2))) AS OPTION_REVENUE,
  CAST(CAST(CAST(i.ITEM_PRICE AS DECIMAL(18,2)) * i.ITEM_QUANTITY AS DECIMAL(29,2)) + COALESCE(o.OPTION_REVENUE, 0) AS DECIMAL(38,2)) AS TOTAL_LINE_REVENUE,
  c.year, c.month, c.week, c.day_of_week, c.is_weekend, c.is_holiday, c.holiday_name
FROM order_items i
LEFT JOIN options_by_line o ON i.ORDER_ID = o.ORDER_ID AND i.LINEITEM_ID = o.LINEITEM_ID
LEFT JOIN cal c ON c.date_key = CAST(i.CREATION_TIME_UTC AS DATE)"""),
    ("silver_options", """
SELECT *, CAST(CAST(OPTION_PRICE AS DECIMAL(18,2)) * OPTION_QUANTITY AS DECIMAL(29,2)) AS OPTION_REVENUE
FROM order_items_options"""),
    ("identified", """
SELECT * FROM silver_items WHERE USER_ID IS NOT NULL AND trim(USER_ID) <> ''"""),
]


def _needed(sql: str) -> set[str]:
    """The fixture tables that a statement refers to, and those that these build on."""
    bodies = dict(FIXTURE_CTES)
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"[A-Za-z_]+", todo.pop()))
        new = (words & bodies.keys()) - found
        found |= new
        todo += [bodies[name] for name in new]
    return found


def with_fixtures(select_sql: str) -> str:
    """Prefix a SELECT with the fixture CTEs that it needs."""
    # Explicitly MATERIALIZED: DuckDB's automatic choice for CTEs used more
    # than once can fail internally on repeated runs in one connection.
    needed = _needed(select_sql)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({body.strip()})" for name, body in FIXTURE_CTES if name in needed)
    body = select_sql.strip()
    if not ctes:
        return body
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def half_up_avg(s: str, n: str) -> str:
    """Exact half-up s / n to 2 decimals for s >= 0 (DuckDB divides decimals as
    DOUBLE and can miss half-cent ties); null for n = 0."""
    return (
        f"CAST(CAST((2 * CAST(({s}) * 100 AS HUGEINT) + ({n})) // NULLIF(2 * ({n}), 0) AS DECIMAL(36,0))"
        f" * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(38,2))"
    )


def average_order(s: str, n: str) -> str:
    """As ``half_up_avg``, 0 for n = 0."""
    return f"CASE WHEN {n} > 0 THEN {half_up_avg(s, n)} ELSE CAST(0 AS DECIMAL(38,2)) END"
