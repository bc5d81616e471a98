"""DuckDB oracle SQL for typed ingest, the quality report and profiling: one
SELECT per rule, combined with UNION ALL; distinct counts where the report
defines them with distinct counts."""

from __future__ import annotations

from orderlens.plans.oracle_metrics import exact_ratio
from orderlens.schemas import EXPECTED_COLUMNS, FILE_NAMES

INT_TEXT = r"\s*[+-]?[0-9]+\s*"
RAW = {"order_items": "raw_order_items", "options": "raw_options", "date_dim": "raw_date_dim"}
TABLE = {"order_items": "order_items", "options": "order_item_options", "date_dim": "date_dim"}
ISSUE = 'file, "row", "column", value, issue_type, details'


def missing(c: str) -> str:
    return f"({c} IS NULL OR NOT regexp_matches({c}, '\\S'))"


def bare(c: str) -> str:
    return f"trim({c}, ' ' || chr(9) || chr(10) || chr(13))"


def utc_time(c: str) -> str:
    """UTC wall-clock time of a text with a date and a time; a trailing +HH:MM is taken off."""
    whole = f"regexp_full_match({bare(c)}, '\\d{{4}}-\\d\\d?-\\d\\d?[T ]\\d\\d?:\\d\\d(:\\d\\d(\\.\\d+)?)?(Z|[+-]\\d\\d:?\\d\\d)?')"
    local = f"TRY_CAST(regexp_replace({bare(c)}, '(Z|[+-]\\d\\d:?\\d\\d)$', '') AS TIMESTAMP)"
    ahead = f"CASE WHEN regexp_matches({bare(c)}, '\\d[+]02:00$') THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END"
    return f"CASE WHEN {whole} THEN {local} - {ahead} END"


def to_int(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '{INT_TEXT}') THEN TRY_CAST({c} AS INTEGER) END"


def flag(c: str) -> str:
    return f"CASE WHEN upper({c}) = 'TRUE' THEN TRUE WHEN upper({c}) = 'FALSE' THEN FALSE END"


def _rule(table: str, file: str, col: str, cases: list[tuple[str, str, str]]) -> str:
    """First failing case per row of one column: (condition, type, details)."""
    t = " ".join(f"WHEN {cond} THEN '{typ}'" for cond, typ, _ in cases)
    d = " ".join(f"WHEN {cond} THEN '{det}'" for cond, _, det in cases)
    return (
        f"SELECT * FROM (SELECT '{file}' AS file, source_row AS \"row\", '{col}' AS \"column\", {col} AS value, "
        f"CASE WHEN {missing(col)} THEN NULL {t} END AS issue_type, "
        f"CASE WHEN {missing(col)} THEN NULL {d} END AS details FROM {table}) WHERE issue_type IS NOT NULL"
    )


def _num(c: str) -> str:
    return f"CASE WHEN regexp_full_match({bare(c)}, '[+-]?(\\d+([.]\\d*)?|[.]\\d+)([eE][+-]?\\d+)?') THEN TRY_CAST({bare(c)} AS DOUBLE) END"


def _range(table, file, c, lo, hi):
    n = _num(c)
    return _rule(table, file, c, [
        (f"({n}) IS NULL", "Invalid numeric value", f"{c} should be numeric."),
        (f"({n}) % 1 <> 0", "Invalid integer value", f"{c} should contain whole numbers."),
        (f"NOT (({n}) BETWEEN {lo} AND {hi})", "Out-of-range value", f"Expected {c} to be between {lo} and {hi}."),
    ])


def _bool(table, file, c):
    return _rule(table, file, c, [(f"upper({c}) NOT IN ('TRUE', 'FALSE')", "Invalid boolean value", "Expected TRUE or FALSE.")])


def _price(table, file, c, typ, msg):
    n = _num(c)
    return _rule(table, file, c, [
        (f"({n}) IS NULL", "Invalid numeric value", f"{c} should be numeric."),
        (f"({n}) < 0", typ, msg),
    ])


def _qty(table, file, c):
    n = _num(c)
    return _rule(table, file, c, [
        (f"({n}) IS NULL", "Invalid numeric value", f"{c} should be numeric."),
        (f"({n}) % 1 <> 0 OR ({n}) <= 0", "Invalid quantity", f"{c} should be a positive whole number."),
    ])


def issues_sql(short: str) -> str:
    t, file = RAW[short], FILE_NAMES[TABLE[short]]
    if short == "date_dim":
        parts = [
            _rule(t, file, "date_key", [(
                "try_strptime(trim(date_key), '%d-%m-%Y') IS NULL AND try_strptime(trim(date_key), '%m-%d-%Y') IS NULL",
                "Invalid date", "Could not be parsed as DD-MM-YYYY or MM-DD-YYYY.")]),
            _range(t, file, "year", 2000, 2100), _range(t, file, "month", 1, 12), _range(t, file, "week", 1, 53),
            _rule(t, file, "day_of_week", [(
                "day_of_week NOT IN ('Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday')",
                "Invalid categorical value", "Expected a weekday name such as Monday or Sunday.")]),
            _bool(t, file, "is_weekend"), _bool(t, file, "is_holiday"),
        ]
    elif short == "order_items":
        parts = [
            _bool(t, file, "IS_LOYALTY"),
            _rule(t, file, "CURRENCY", [("NOT regexp_full_match(CURRENCY, '\\s*[A-Z]{3}\\s*')", "Invalid currency code",
                                         "Expected a 3-letter uppercase currency code such as USD.")]),
            _price(t, file, "ITEM_PRICE", "Negative price", "ITEM_PRICE should normally be zero or greater."),
            _qty(t, file, "ITEM_QUANTITY"),
            _rule(t, file, "CREATION_TIME_UTC", [(f"({utc_time('CREATION_TIME_UTC')}) IS NULL",
                                                  "Invalid timestamp", "Could not be parsed as a valid UTC timestamp.")]),
        ]
    else:
        parts = [
            _price(t, file, "OPTION_PRICE", "Negative option price", "OPTION_PRICE should normally be zero or greater."),
            _qty(t, file, "OPTION_QUANTITY"),
        ]
    return "\nUNION ALL\n".join(f"SELECT {ISSUE} FROM ({p})" for p in parts)


# Missing keys equal missing keys: compared as a text that no key is, by plain equality.
_NONE = "'<none>'"
BROKEN = f"""SELECT o.* FROM raw_options o LEFT JOIN (
  SELECT DISTINCT COALESCE(ORDER_ID, {_NONE}) AS a, COALESCE(LINEITEM_ID, {_NONE}) AS b, 1 AS hit FROM raw_order_items) k
  ON COALESCE(o.ORDER_ID, {_NONE}) = k.a AND COALESCE(o.LINEITEM_ID, {_NONE}) = k.b WHERE k.hit IS NULL"""

BROKEN_ISSUES = f"""SELECT 'order_item_options.csv' AS file, source_row AS "row", 'ORDER_ID / LINEITEM_ID' AS "column",
  COALESCE(ORDER_ID, 'nan') || ' / ' || COALESCE(LINEITEM_ID, 'nan') AS value, 'Broken reference' AS issue_type,
  'ORDER_ID + LINEITEM_ID does not exist in order_items.csv.' AS details FROM ({BROKEN})"""


def missing_sql(short: str) -> str:
    t, file = RAW[short], FILE_NAMES[TABLE[short]]
    cols = EXPECTED_COLUMNS[TABLE[short]]
    parts = []
    for c in cols:
        n = f"COUNT(*) FILTER (WHERE {missing(c)})"
        parts.append(
            f"SELECT '{file}' AS file, '{c}' AS \"column\", COUNT(*) AS total_rows, {n} AS missing_count, "
            f"COALESCE({exact_ratio(n, 'COUNT(*)')}, CAST(0 AS DECIMAL(38,2))) AS missing_percent FROM {t}"
        )
    return "\nUNION ALL\n".join(parts)


def duplicates_sql(short: str) -> str:
    t, file = RAW[short], FILE_NAMES[TABLE[short]]
    cols = EXPECTED_COLUMNS[TABLE[short]]
    values = " || ' | ' || ".join(f"'{c}=' || COALESCE({c}, 'nan')" for c in cols)
    return (
        f"SELECT '{file}' AS file, COUNT(*) AS duplicate_group_size, MIN(source_row) AS first_source_row, "
        f"{values} AS duplicate_values FROM {t} GROUP BY {', '.join(cols)} HAVING COUNT(*) >= 2"
    )


def duplicate_members_sql(short: str) -> str:
    """Members by window over the group (the oracle formulation)."""
    t, file = RAW[short], FILE_NAMES[TABLE[short]]
    cols = ", ".join(EXPECTED_COLUMNS[TABLE[short]])
    return (
        f"SELECT '{file}' AS file, first_source_row, source_row FROM ("
        f"SELECT source_row, MIN(source_row) OVER (PARTITION BY {cols}) AS first_source_row, "
        f"COUNT(*) OVER (PARTITION BY {cols}) AS n FROM {t}) WHERE n >= 2"
    )


DUP_GROUPS = """SELECT ORDER_ID, LINEITEM_ID, OPTION_GROUP_NAME, OPTION_NAME, MIN(source_row) AS original_source_row,
  COUNT(*) AS duplicate_count,
  (COUNT(DISTINCT OPTION_PRICE) = 1 AND COUNT(DISTINCT OPTION_QUANTITY) = 1) AS exact_match
FROM raw_options
WHERE ORDER_ID IS NOT NULL AND LINEITEM_ID IS NOT NULL AND OPTION_GROUP_NAME IS NOT NULL AND OPTION_NAME IS NOT NULL
GROUP BY ORDER_ID, LINEITEM_ID, OPTION_GROUP_NAME, OPTION_NAME HAVING COUNT(*) > 1"""

MISSING_ITEM_FIELDS = (
    f"SELECT * FROM raw_order_items WHERE {missing('LINEITEM_ID')} OR {missing('ITEM_CATEGORY')} "
    f"OR {missing('ITEM_NAME')}"
)


def _summary(short: str) -> str:
    """One row per file from three one-row aggregates (rows and missing cells,
    duplicate groups, issues) combined side by side."""
    t, table = RAW[short], TABLE[short]
    cols = EXPECTED_COLUMNS[table]
    miss = " + ".join(f"COUNT(*) FILTER (WHERE {missing(c)})" for c in cols)
    issues = f"SELECT COUNT(*) AS n FROM ({issues_sql(short)})"
    if short == "options":
        issues = f"SELECT SUM(n) AS n FROM ({issues} UNION ALL SELECT COUNT(*) AS n FROM ({BROKEN_ISSUES}))"
    return (
        f"SELECT '{FILE_NAMES[table]}' AS file, b.rows, CAST({len(cols)} AS BIGINT) AS columns, b.missing_values, "
        f"d.n AS duplicate_groups, CAST(i.n AS BIGINT) AS corrupt_or_invalid_values "
        f"FROM (SELECT COUNT(*) AS rows, CAST({miss} AS BIGINT) AS missing_values FROM {t}) b "
        f"JOIN (SELECT COUNT(*) AS n FROM ({duplicates_sql(short)})) d ON TRUE "
        f"JOIN ({issues}) i ON TRUE"
    )


def _len(c: str) -> str:
    return f"CAST(length(rtrim({c})) AS INTEGER)"


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ingest_date_dim"] = f"""
SELECT CAST(try_strptime(date_key, '%d-%m-%Y') AS DATE) AS date_key, {to_int('year')} AS year,
  {to_int('month')} AS month, {to_int('week')} AS week, day_of_week,
  {flag('is_weekend')} AS is_weekend, {flag('is_holiday')} AS is_holiday, holiday_name
FROM raw_date_dim"""
    q["ingest_order_items"] = f"""
SELECT APP_NAME, RESTAURANT_ID,
  {utc_time('CREATION_TIME_UTC')} AS CREATION_TIME_UTC, ORDER_ID,
  USER_ID, PRINTED_CARD_NUMBER,
  {flag('IS_LOYALTY')} AS IS_LOYALTY, CURRENCY, LINEITEM_ID,
  ITEM_CATEGORY, ITEM_NAME,
  TRY_CAST(ITEM_PRICE AS DECIMAL(10,2)) AS ITEM_PRICE, {to_int('ITEM_QUANTITY')} AS ITEM_QUANTITY
FROM raw_order_items"""
    typed_options = f"""
SELECT ORDER_ID, LINEITEM_ID,
  OPTION_GROUP_NAME, OPTION_NAME,
  TRY_CAST(OPTION_PRICE AS DECIMAL(10,2)) AS OPTION_PRICE, {to_int('OPTION_QUANTITY')} AS OPTION_QUANTITY
FROM raw_options"""
    q["ingest_options"] = typed_options
    q["preview_conversion"] = f"""
SELECT source_row, CREATION_TIME_UTC, {utc_time('CREATION_TIME_UTC')} AS converted_creation_time, IS_LOYALTY,
  CASE WHEN IS_LOYALTY = 'TRUE' THEN 1 WHEN IS_LOYALTY = 'FALSE' THEN 0 END AS converted_is_loyalty
FROM raw_order_items ORDER BY source_row LIMIT 10"""
    for short in RAW:
        q[f"dq_missing_{short}"] = missing_sql(short)
        q[f"dq_duplicate_rows_{short}"] = duplicates_sql(short)
        q[f"dq_duplicate_members_{short}"] = duplicate_members_sql(short)
        q[f"dq_issues_{short}"] = issues_sql(short)
    q["dq_issues_options_renamed"] = f"""
SELECT * FROM ({issues_sql('options')})
UNION ALL VALUES
 ('order_item_options.csv', NULL, 'COLUMN STRUCTURE', '', 'Missing column(s)', 'OPTION_GROUP_NAME'),
 ('order_item_options.csv', NULL, 'COLUMN STRUCTURE', '', 'Unexpected column(s)', 'OPTION_GROUP')"""
    q["dq_broken_references"] = BROKEN_ISSUES
    q["dq_broken_options"] = f"SELECT * FROM ({BROKEN})"
    q["dq_broken_summary"] = f"""
SELECT ORDER_ID, LINEITEM_ID, COUNT(*) AS occurrence_count FROM ({BROKEN})
WHERE ORDER_ID IS NOT NULL AND LINEITEM_ID IS NOT NULL GROUP BY ORDER_ID, LINEITEM_ID"""
    q["dq_broken_order_items"] = f"""
SELECT ids.ORDER_ID, i.LINEITEM_ID, i.RESTAURANT_ID, i.CREATION_TIME_UTC, i.USER_ID, i.ITEM_CATEGORY, i.ITEM_NAME,
  i.ITEM_PRICE, i.ITEM_QUANTITY
FROM (SELECT DISTINCT ORDER_ID FROM ({BROKEN})) ids
LEFT JOIN raw_order_items i ON COALESCE(ids.ORDER_ID, {_NONE}) = COALESCE(i.ORDER_ID, {_NONE})"""
    q["dq_affected_orders"] = f"""
SELECT i.* FROM raw_order_items i JOIN (SELECT DISTINCT COALESCE(ORDER_ID, {_NONE}) AS a FROM ({BROKEN})) b
  ON COALESCE(i.ORDER_ID, {_NONE}) = b.a"""
    q["dq_missing_item_fields"] = MISSING_ITEM_FIELDS
    q["dq_investigated_order"] = f"""
SELECT * FROM raw_order_items WHERE ORDER_ID = (SELECT ORDER_ID FROM ({MISSING_ITEM_FIELDS}) ORDER BY source_row LIMIT 1)"""
    q["dq_zero_quantity"] = "SELECT * FROM raw_order_items WHERE trim(ITEM_QUANTITY) = '0'"
    q["dq_zero_quantity_counts"] = """
SELECT trim(ITEM_QUANTITY) AS ITEM_QUANTITY, COUNT(*) AS count FROM raw_order_items
WHERE trim(ITEM_QUANTITY) IN ('0', '0.0') GROUP BY 1"""
    q["dq_option_duplicate_groups"] = DUP_GROUPS
    q["dq_option_duplicates"] = f"""
SELECT o.source_row, g.original_source_row, o.ORDER_ID, o.LINEITEM_ID, o.OPTION_GROUP_NAME, o.OPTION_NAME,
  o.OPTION_PRICE, o.OPTION_QUANTITY, g.duplicate_count, g.exact_match
FROM raw_options o JOIN ({DUP_GROUPS}) g ON o.ORDER_ID = g.ORDER_ID AND o.LINEITEM_ID = g.LINEITEM_ID
  AND o.OPTION_GROUP_NAME = g.OPTION_GROUP_NAME AND o.OPTION_NAME = g.OPTION_NAME"""
    q["dq_summary"] = "\nUNION ALL\n".join(_summary(s) for s in ("date_dim", "order_items", "options"))
    q["profile_longest_category"] = f"""
SELECT {_len('ITEM_CATEGORY')} AS category_length, ITEM_CATEGORY FROM raw_order_items
ORDER BY category_length DESC NULLS LAST, ITEM_CATEGORY ASC NULLS LAST LIMIT 20"""
    q["profile_url_category"] = "SELECT COUNT(*) FILTER (WHERE ITEM_CATEGORY LIKE '%http%') AS rows_with_urls FROM raw_order_items"
    q["profile_row_counts"] = """
SELECT 'order_items' AS table_name, COUNT(*) AS row_count FROM raw_order_items
UNION ALL SELECT 'order_item_options', COUNT(*) FROM raw_options
UNION ALL SELECT 'date_dim', COUNT(*) FROM raw_date_dim"""
    q["profile_item_lengths"] = f"""
SELECT MAX({_len('ITEM_CATEGORY')}) AS max_item_category_length, MAX({_len('ITEM_NAME')}) AS max_item_name_length
FROM raw_order_items"""
    q["profile_option_lengths"] = f"""
SELECT MAX({_len('ORDER_ID')}) AS max_order_id_length, MAX({_len('LINEITEM_ID')}) AS max_lineitem_id_length,
  MAX({_len('OPTION_GROUP_NAME')}) AS max_option_group_name_length, MAX({_len('OPTION_NAME')}) AS max_option_name_length
FROM raw_options"""
    q["profile_option_ranges"] = f"""
SELECT MIN(OPTION_PRICE) AS min_option_price, MAX(OPTION_PRICE) AS max_option_price,
  MIN(OPTION_QUANTITY) AS min_option_quantity, MAX(OPTION_QUANTITY) AS max_option_quantity
FROM ({typed_options})"""
    q["profile_timestamps"] = "SELECT source_row, CREATION_TIME_UTC FROM raw_order_items ORDER BY source_row LIMIT 10"
    q["profile_loyalty"] = "SELECT IS_LOYALTY, COUNT(*) AS row_count FROM raw_order_items GROUP BY IS_LOYALTY"
    return q
