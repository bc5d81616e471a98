"""Data-quality report over raw text tables.

Inputs are raw tables: every data column a string, plus ``source_row`` (the
record's row in its file). Every rule set is one scan: per row an array of
nullable issue structs (the first failing rule per column), nulls filtered,
exploded. A missing value (null, empty, blank) is never reported as corrupt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.columns import WHITE, is_missing, is_missing_cell, stripped
from orderlens.functions.membership import key_hash, may_be_in
from orderlens.functions.rounding import half_up_ratio
from orderlens.schemas import EXPECTED_COLUMNS, FILE_NAMES
from orderlens.sources.ingest import column_differences, is_timestamp

C = F.col

# Rule texts and accepted values of the quality report.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
BOOLEAN_TEXTS = ["TRUE", "FALSE"]
CURRENCY_PATTERN = rf"^[{WHITE}]*[A-Z]{{3}}[{WHITE}]*$"
DATE_FORMATS = ["d-M-yyyy", "M-d-yyyy"]  # DD-MM-YYYY or MM-DD-YYYY
DATE_DIM_RANGES = [("year", 2000, 2100), ("month", 1, 12), ("week", 1, 53)]
MISSING_TEXT = "nan"  # how a missing value prints in value listings

MSG_INVALID_DATE = "Could not be parsed as DD-MM-YYYY or MM-DD-YYYY."
MSG_WEEKDAY = "Expected a weekday name such as Monday or Sunday."
MSG_BOOLEAN = "Expected TRUE or FALSE."
MSG_CURRENCY = "Expected a 3-letter uppercase currency code such as USD."
MSG_NEG_ITEM = "ITEM_PRICE should normally be zero or greater."
MSG_NEG_OPTION = "OPTION_PRICE should normally be zero or greater."
MSG_TIMESTAMP = "Could not be parsed as a valid UTC timestamp."
MSG_BROKEN = "ORDER_ID + LINEITEM_ID does not exist in order_items.csv."

# a decimal number (group 1) between white space
NUMBER_TEXT = rf"^[{WHITE}]*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)[{WHITE}]*$"

LINE_KEY = ["ORDER_ID", "LINEITEM_ID"]
OPTION_KEY = ["ORDER_ID", "LINEITEM_ID", "OPTION_GROUP_NAME", "OPTION_NAME"]


def data_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c != "source_row"]


# rule builders ----------------------------------------------------------------
def _issue(column: str, issue_type: str, details: str) -> Column:
    return F.struct(
        F.lit(column).alias("column"),
        C(column).cast("string").alias("value"),
        F.lit(issue_type).alias("issue_type"),
        F.lit(details).alias("details"),
    )


def _number(c: str) -> Column:
    """Decimal text as a number; null for anything else (suffixes such as ``12d``)."""
    return F.regexp_extract(C(c), NUMBER_TEXT, 1).try_cast("double")


def _not_whole(x: Column) -> Column:
    return (x % 1) != 0


def range_rule(c: str, lo: int, hi: int) -> Column:
    x = _number(c)
    return (
        F.when(is_missing(c), F.lit(None))
        .when(x.isNull(), _issue(c, "Invalid numeric value", f"{c} should be numeric."))
        .when(_not_whole(x), _issue(c, "Invalid integer value", f"{c} should contain whole numbers."))
        .when(~x.between(lo, hi), _issue(c, "Out-of-range value", f"Expected {c} to be between {lo} and {hi}."))
    )


def boolean_rule(c: str) -> Column:
    return F.when(
        ~is_missing(c) & ~F.upper(C(c)).isin(BOOLEAN_TEXTS),
        _issue(c, "Invalid boolean value", MSG_BOOLEAN),
    )


def date_rule(c: str) -> Column:
    text = stripped(c)
    unparsed = F.lit(True)
    for fmt in DATE_FORMATS:
        unparsed = unparsed & F.try_to_date(text, fmt).isNull()
    return F.when(~is_missing(c) & unparsed, _issue(c, "Invalid date", MSG_INVALID_DATE))


def weekday_rule(c: str) -> Column:
    return F.when(
        ~is_missing(c) & ~C(c).isin(WEEKDAYS), _issue(c, "Invalid categorical value", MSG_WEEKDAY)
    )


def currency_rule(c: str) -> Column:
    return F.when(
        ~is_missing_cell(c) & ~C(c).rlike(CURRENCY_PATTERN),
        _issue(c, "Invalid currency code", MSG_CURRENCY),
    )


def price_rule(c: str, negative_type: str, negative_msg: str) -> Column:
    x = _number(c)
    return (
        F.when(is_missing_cell(c), F.lit(None))
        .when(x.isNull(), _issue(c, "Invalid numeric value", f"{c} should be numeric."))
        .when(x < 0, _issue(c, negative_type, negative_msg))
    )


def quantity_rule(c: str) -> Column:
    x = _number(c)
    return (
        F.when(is_missing_cell(c), F.lit(None))
        .when(x.isNull(), _issue(c, "Invalid numeric value", f"{c} should be numeric."))
        .when(_not_whole(x) | (x <= 0), _issue(c, "Invalid quantity", f"{c} should be a positive whole number."))
    )


def timestamp_rule(c: str) -> Column:
    return F.when(
        ~is_missing_cell(c) & ~is_timestamp(c),
        _issue(c, "Invalid timestamp", MSG_TIMESTAMP),
    )


def _explode(raw: DataFrame, file: str, rules: list[Column]) -> DataFrame:
    """The issues found. Rules that hold are dropped behind the explode: in a lambda the
    rules would be interpreted, and a filter of the rows would go below all that makes them."""
    issues = raw.select(C("source_row").alias("row"), F.explode(F.array(*rules)).alias("i")).filter(C("i").isNotNull())
    return issues.select(F.lit(file).alias("file"), "row", "i.column", "i.value", "i.issue_type", "i.details")


def _count_found(rules: list[Column]) -> Column:
    return sum((F.when(rule.isNotNull(), 1).otherwise(0) for rule in rules), F.lit(0))


# D1 ---------------------------------------------------------------------------
def column_issues(spark: SparkSession, raw: DataFrame, table: str) -> DataFrame:
    """Missing / unexpected columns against the expected list (metadata:
    at most two rows; ``row`` is null where the report writes N/A)."""
    rows = []
    missing, unexpected = column_differences(data_columns(raw), table)
    file = FILE_NAMES[table]
    if missing:
        rows.append((file, None, "COLUMN STRUCTURE", "", "Missing column(s)", ", ".join(missing)))
    if unexpected:
        rows.append((file, None, "COLUMN STRUCTURE", "", "Unexpected column(s)", ", ".join(unexpected)))
    return spark.createDataFrame(
        rows, "file string, row bigint, column string, value string, issue_type string, details string"
    )


# D4-D6 ------------------------------------------------------------------------
def _rules_of(table: str) -> dict[str, Column]:
    """The value rule of every checked column."""
    if table == "date_dim":
        ranges = {c: range_rule(c, lo, hi) for c, lo, hi in DATE_DIM_RANGES}
        flags = {c: boolean_rule(c) for c in ("is_weekend", "is_holiday")}
        return {"date_key": date_rule("date_key"), **ranges, "day_of_week": weekday_rule("day_of_week"), **flags}
    if table == "order_items":
        return {
            "IS_LOYALTY": boolean_rule("IS_LOYALTY"),
            "CURRENCY": currency_rule("CURRENCY"),
            "ITEM_PRICE": price_rule("ITEM_PRICE", "Negative price", MSG_NEG_ITEM),
            "ITEM_QUANTITY": quantity_rule("ITEM_QUANTITY"),
            "CREATION_TIME_UTC": timestamp_rule("CREATION_TIME_UTC"),
        }
    return {
        "OPTION_PRICE": price_rule("OPTION_PRICE", "Negative option price", MSG_NEG_OPTION),
        "OPTION_QUANTITY": quantity_rule("OPTION_QUANTITY"),
    }


def value_issues(raw: DataFrame, table: str) -> DataFrame:
    """The value rules of the columns that the file has."""
    rules = [rule for c, rule in _rules_of(table).items() if c in raw.columns]
    return _explode(raw, FILE_NAMES[table], rules)


def date_dim_issues(raw: DataFrame) -> DataFrame:
    """Every row's date, year/month/week, weekday name and flags."""
    return value_issues(raw, "date_dim")


def order_item_issues(raw: DataFrame) -> DataFrame:
    """Loyalty flag, currency, price, quantity, timestamp."""
    return value_issues(raw, "order_items")


def option_issues(raw: DataFrame) -> DataFrame:
    """Option price and quantity."""
    return value_issues(raw, "order_item_options")


def table_issues(spark: SparkSession, raw: DataFrame, table: str) -> DataFrame:
    """D1 + value rules of one table."""
    return column_issues(spark, raw, table).unionByName(value_issues(raw, table))


# D2, D3 -----------------------------------------------------------------------
def missing_values(raw: DataFrame, table: str) -> DataFrame:
    """Per column: total rows, missing count, percent (2 dp, 0 when the
    table is empty). One aggregate pass, then unpivot of the single row."""
    cols = data_columns(raw)
    wide = raw.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count_if(is_missing(c)).alias(c) for c in cols]
    )
    long = wide.unpivot("_total", cols, "column", "missing_count")
    return long.select(
        F.lit(FILE_NAMES[table]).alias("file"),
        "column",
        C("_total").alias("total_rows"),
        "missing_count",
        F.coalesce(half_up_ratio(C("missing_count"), C("_total"), 100), F.lit(0).cast("decimal(38,2)")).alias(
            "missing_percent"
        ),
    )


def _hashes(cols: list[str]) -> list[Column]:
    """A 128-bit hash of columns, in two parts."""
    values = [C(c) for c in cols]
    return [key_hash(values).alias("_h1"), key_hash(values, salt=1).alias("_h2")]


def _may_repeat(raw: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of which there may be another one equal in ``cols``: hashes are counted first,
    and only rows with a repeated hash (and a few others) are passed on. What is shuffled of
    all the others is their hash, not their texts."""
    repeated = raw.select(*_hashes(cols)).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter(C("_n") >= 2)
    return may_be_in(raw, key_hash([C(c) for c in cols]), repeated, "_h1")


def _duplicate_group_keys(some: DataFrame, cols: list[str]) -> DataFrame:
    """Groups of equal rows, by value, among the rows that may repeat."""
    return (
        some.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("source_row").alias("first_source_row"))
        .filter(C("_n") >= 2)
    )


def duplicate_rows(raw: DataFrame, table: str) -> DataFrame:
    """D3: groups of rows equal in every data column (nulls equal), size >= 2:
    size, first source row and the values as ``col=value | ...``. The report
    sorts them by first source row (``in_first_appearance``).

    A group's member rows are listed by ``duplicate_members`` (one row per
    member), never gathered into one cell: a group may hold a third of all
    rows."""
    cols = data_columns(raw)
    values = F.concat_ws(
        " | ", *[F.concat(F.lit(f"{c}="), F.coalesce(C(c), F.lit(MISSING_TEXT))) for c in cols]
    )
    return _duplicate_group_keys(_may_repeat(raw, cols), cols).select(
        F.lit(FILE_NAMES[table]).alias("file"),
        C("_n").alias("duplicate_group_size"),
        "first_source_row",
        values.alias("duplicate_values"),
    )


def in_first_appearance(groups: DataFrame) -> DataFrame:
    """Duplicate groups in order of first appearance in their file."""
    return groups.orderBy("file", "first_source_row")


def duplicate_members(raw: DataFrame, table: str) -> DataFrame:
    """D3 members: every row of a duplicate group with its group's first
    source row. The groups join back on all data columns, null-safely; a hot
    group is split by adaptive skew-join handling. The rows that may repeat are dealt
    out once, in even parts, for both sides of the join."""
    cols = data_columns(raw)
    raw = _may_repeat(raw, cols).hint("rebalance")
    groups = _duplicate_group_keys(raw, cols).drop("_n")
    g = groups.select(*[C(c).alias(f"_g_{c}") for c in cols], "first_source_row")
    cond = None
    for c in cols:
        term = raw[c].eqNullSafe(g[f"_g_{c}"])
        cond = term if cond is None else cond & term
    return raw.join(g, cond, "inner").select(
        F.lit(FILE_NAMES[table]).alias("file"), "first_source_row", "source_row"
    )


# D7-D11 -----------------------------------------------------------------------
def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(right[k])
        cond = term if cond is None else cond & term
    return cond


def broken_option_rows(raw_options: DataFrame, raw_items: DataFrame) -> DataFrame:
    """Option rows whose (ORDER_ID, LINEITEM_ID) is not a line key.
    Keys match null-safely (a missing key equals a missing key).

    The option keys, each once, lose those of lines: only keys are shuffled, and a hot one
    (many options with the same missing key) is a row a task. A bitmap of the keys that are
    left keeps most option rows from a shuffle; the others are compared by value, and a
    hot key among them is split by adaptive skew-join handling."""
    lines = raw_items.select(*LINE_KEY)
    keys = raw_options.select(*LINE_KEY).distinct()
    broken = keys.join(lines, _null_safe(keys, lines, LINE_KEY), "left_anti")
    parts = [C(k) for k in LINE_KEY]
    rows = may_be_in(raw_options, key_hash(parts), broken.select(key_hash(parts).alias("_key")), "_key")
    renamed = broken.select(*[C(k).alias(f"_{k}") for k in LINE_KEY])
    same = C(LINE_KEY[0]).eqNullSafe(C(f"_{LINE_KEY[0]}")) & C(LINE_KEY[1]).eqNullSafe(C(f"_{LINE_KEY[1]}"))
    return rows.join(renamed, same, "left_semi").select("source_row", *EXPECTED_COLUMNS["order_item_options"])


def broken_reference_issues(broken: DataFrame) -> DataFrame:
    """One issue per broken option row (``broken_option_rows``)."""
    shown = lambda c: F.coalesce(C(c), F.lit(MISSING_TEXT))
    return broken.select(
        F.lit(FILE_NAMES["order_item_options"]).alias("file"),
        C("source_row").alias("row"),
        F.lit("ORDER_ID / LINEITEM_ID").alias("column"),
        F.concat(shown("ORDER_ID"), F.lit(" / "), shown("LINEITEM_ID")).alias("value"),
        F.lit("Broken reference").alias("issue_type"),
        F.lit(MSG_BROKEN).alias("details"),
    )


def broken_summary(broken: DataFrame) -> DataFrame:
    """Occurrences per broken key pair (rows with a missing key are not
    grouped), most frequent first."""
    return (
        broken.filter(C("ORDER_ID").isNotNull() & C("LINEITEM_ID").isNotNull())
        .groupBy(*LINE_KEY)
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
        .orderBy(C("occurrence_count").desc(), *LINE_KEY)
    )


BROKEN_ORDER_COLUMNS = [
    "ORDER_ID", "LINEITEM_ID", "RESTAURANT_ID", "CREATION_TIME_UTC", "USER_ID",
    "ITEM_CATEGORY", "ITEM_NAME", "ITEM_PRICE", "ITEM_QUANTITY",
]


def broken_order_lines(broken: DataFrame, raw_items: DataFrame) -> DataFrame:
    """The order lines of every broken ORDER_ID (on ORDER_ID only, null-safe; an
    id with no line is kept with nulls).

    A bitmap of the ids keeps the lines of all others from a shuffle. Lines without an
    ORDER_ID may be a third of all: an inner join lets adaptive skew handling split the
    lines of a hot id, which the outer side of a left join would not. Ids without a line
    are those that none of the lines let through has. The lines are made and dealt out once
    for both: Spark does so if both read the same columns, hence the hash of all."""
    ids = broken.select(C("ORDER_ID").alias("_oid")).distinct()
    broken_ids = ids.select(key_hash([C("_oid")]).alias("_key"))
    lines = may_be_in(raw_items.select(*BROKEN_ORDER_COLUMNS), key_hash([C("ORDER_ID")]), broken_ids, "_key").hint("rebalance")
    found = lines.join(ids, lines["ORDER_ID"].eqNullSafe(ids["_oid"]), "inner").select(*BROKEN_ORDER_COLUMNS)
    one = lines.groupBy(C("ORDER_ID").alias("_id")).agg(F.max(F.xxhash64(*BROKEN_ORDER_COLUMNS)).alias("_line"))
    lone = ids.join(one, ids["_oid"].eqNullSafe(one["_id"]), "left").filter(C("_line").isNull())
    nulls = [F.lit(None).cast("string").alias(c) for c in BROKEN_ORDER_COLUMNS[1:]]
    return found.unionByName(lone.select(C("_oid").alias("ORDER_ID"), *nulls)).orderBy("ORDER_ID", "LINEITEM_ID")


def affected_order_lines(broken: DataFrame, raw_items: DataFrame) -> DataFrame:
    """Order lines whose ORDER_ID has a broken option (semi join)."""
    ids = broken.select(C("ORDER_ID").alias("_oid")).distinct()
    return raw_items.join(ids, raw_items["ORDER_ID"].eqNullSafe(ids["_oid"]), "left_semi")


# D12-D14 ----------------------------------------------------------------------
def missing_item_fields(raw_items: DataFrame) -> DataFrame:
    """Lines missing LINEITEM_ID, ITEM_CATEGORY or ITEM_NAME."""
    return raw_items.filter(
        is_missing("LINEITEM_ID") | is_missing("ITEM_CATEGORY") | is_missing("ITEM_NAME")
    )


def investigated_order(raw_items: DataFrame) -> DataFrame:
    """Every line of the order of the first (lowest source row) line
    with missing item fields. The chosen order is one row, joined back."""
    first = missing_item_fields(raw_items).agg(
        F.min_by("ORDER_ID", "source_row").alias("_oid")
    )
    return raw_items.join(F.broadcast(first), raw_items["ORDER_ID"] == first["_oid"], "inner").drop(
        "_oid"
    )


ZERO_TEXTS = ["0", "0.0"]


def zero_quantity_rows(raw_items: DataFrame) -> DataFrame:
    """Lines whose quantity text is 0."""
    return raw_items.filter(F.trim(C("ITEM_QUANTITY")) == "0")


def zero_quantity_counts(raw_items: DataFrame) -> DataFrame:
    """How often the quantity texts 0 and 0.0 occur."""
    text = F.trim(C("ITEM_QUANTITY"))
    return (
        raw_items.filter(text.isin(ZERO_TEXTS))
        .groupBy(text.alias("ITEM_QUANTITY"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


# D15 --------------------------------------------------------------------------
def option_duplicate_groups(raw_options: DataFrame) -> DataFrame:
    """D15, one row per repeated option key (order, line, group, name; rows
    with a missing key part are not grouped): first row, size, and
    ``exact_match`` = one distinct price and one distinct quantity
    (``min == max`` over non-null values, no distinct aggregation). The
    member rows are ``option_duplicates``. Keys are counted by hash first."""
    return _option_groups(_may_repeat(_whole_keys(raw_options), OPTION_KEY))


def _whole_keys(raw_options: DataFrame) -> DataFrame:
    for k in OPTION_KEY:
        raw_options = raw_options.filter(C(k).isNotNull())
    return raw_options


def _option_groups(keyed: DataFrame) -> DataFrame:
    g = keyed.groupBy(*OPTION_KEY).agg(
        F.count(F.lit(1)).alias("duplicate_count"),
        F.min("source_row").alias("original_source_row"),
        F.min("OPTION_PRICE").alias("_p0"), F.max("OPTION_PRICE").alias("_p1"),
        F.min("OPTION_QUANTITY").alias("_q0"), F.max("OPTION_QUANTITY").alias("_q1"),
    )
    same = lambda lo, hi: F.coalesce(C(lo) == C(hi), F.lit(False))
    return g.filter(C("duplicate_count") > 1).select(
        *OPTION_KEY,
        "original_source_row",
        "duplicate_count",
        (same("_p0", "_p1") & same("_q0", "_q1")).alias("exact_match"),
    )


def option_duplicates(raw_options: DataFrame) -> DataFrame:
    """D15, one row per member of a repeated option key, with the group's
    first row, size and exact-match flag (output linear in the rows)."""
    some = _may_repeat(_whole_keys(raw_options), OPTION_KEY)
    groups = _option_groups(some)
    return some.join(groups, OPTION_KEY, "inner").select(
        "source_row", "original_source_row", *OPTION_KEY, "OPTION_PRICE", "OPTION_QUANTITY",
        "duplicate_count", "exact_match",
    )


# D16, D17 ---------------------------------------------------------------------
RAW_ORDER = ("date_dim", "order_items", "order_item_options")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def report_parts(
    spark: SparkSession, raw_date_dim: DataFrame, raw_items: DataFrame, raw_options: DataFrame, broken: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Missing values, duplicate groups (sorted), duplicate members and issues (column,
    value and reference issues) of all three files, each unioned."""
    raws = dict(zip(RAW_ORDER, (raw_date_dim, raw_items, raw_options)))
    missing = [missing_values(raw, t) for t, raw in raws.items()]
    groups = [duplicate_rows(raw, t) for t, raw in raws.items()]
    members = [duplicate_members(raw, t) for t, raw in raws.items()]
    issues = [table_issues(spark, raw, t) for t, raw in raws.items()] + [broken_reference_issues(broken)]
    return _union(missing), in_first_appearance(_union(groups)), _union(members), _union(issues)


SUMMARY_COUNTS = ["rows", "columns", "missing_values", "duplicate_groups", "corrupt_or_invalid_values"]


def _summary_rows(raw: DataFrame, table: str) -> DataFrame:
    """What the summary needs of a row: its file, a 128-bit hash, its line key and its
    missing and invalid cells."""
    cols = data_columns(raw)
    rules = [rule for c, rule in _rules_of(table).items() if c in cols]
    # the lambda keeps the projection out of whole-stage code, where its one method would be
    # over the 8000 bytes up to which the JVM compiles; by itself it is compiled in small ones
    cells = F.size(F.filter(F.array(*[C(c).cast("string") for c in cols]), is_missing_cell))
    key = [C(k) if table != "date_dim" and k in cols else F.lit(None) for k in LINE_KEY]
    return raw.select(
        F.lit(RAW_ORDER.index(table)).alias("_t"), *_hashes(cols), *[k.cast("string").alias(n) for k, n in zip(key, ("_k1", "_k2"))],
        cells.cast("bigint").alias("_missing"), _count_found(rules).cast("bigint").alias("_bad"),
    )


def quality_summary(
    spark: SparkSession, raw_date_dim: DataFrame, raw_items: DataFrame, raw_options: DataFrame, broken: DataFrame | None = None
) -> DataFrame:
    """One row per file: rows, columns, missing values, duplicate groups, corrupt
    or invalid values (column, value and, for options, reference issues).

    Every file is scanned once. Its rows are counted by 128-bit hash (with the line key,
    which the row determines), which gives rows, missing and invalid cells, and the groups
    of equal rows; then by line key, which gives the option rows without a line; then in all.
    Each step aggregates before its shuffle, so a hot row or key is one row a task. Two
    different rows with one 128-bit hash would count as equal; at 10**12 rows the odds are
    below 10**-14. ``broken``: broken option rows that are already stored are counted there."""
    raws = dict(zip(RAW_ORDER, (raw_date_dim, raw_items, raw_options)))
    rows = _union([_summary_rows(raw, t) for t, raw in raws.items()])
    same = rows.groupBy("_t", "_h1", "_h2", "_k1", "_k2").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_missing").alias("_missing"), F.sum("_bad").alias("_bad")
    )
    counts = {"rows": C("_n"), "missing": C("_missing"), "groups": F.when(C("_n") >= 2, 1).otherwise(0), "bad": C("_bad")}
    of = lambda i, value: F.sum(F.when(C("_t") == i, value))
    by_key = same.groupBy("_k1", "_k2").agg(
        F.max(C("_t") == RAW_ORDER.index("order_items")).alias("_line"),
        *[of(i, value).alias(f"{name}{i}") for i in range(len(RAW_ORDER)) for name, value in counts.items()],
    )
    options_at = RAW_ORDER.index("order_item_options")
    total = by_key.agg(
        *[F.coalesce(F.sum(f"{name}{i}"), F.lit(0)).alias(f"{name}{i}") for i in range(len(RAW_ORDER)) for name in counts],
        F.coalesce(F.sum(F.when(~C("_line"), C(f"rows{options_at}"))), F.lit(0)).alias("broken"),
    )
    files = []
    for i, (table, raw) in enumerate(raws.items()):
        cols = data_columns(raw)
        wrong = C(f"bad{i}") + sum(bool(x) for x in column_differences(cols, table))
        if i == options_at:
            wrong = wrong + (C("broken") if broken is None else broken.agg(F.count(F.lit(1))).scalar())
        values = [C(f"rows{i}"), F.lit(len(cols)), C(f"missing{i}"), C(f"groups{i}"), wrong]
        files.append(F.struct(F.lit(FILE_NAMES[table]).alias("file"), *[v.cast("bigint").alias(n) for v, n in zip(values, SUMMARY_COUNTS)]))
    return total.select(F.explode(F.array(*files)).alias("f")).select("f.*")


def expected_schema(spark: SparkSession) -> DataFrame:
    """The expected column list of every file (a constant listing)."""
    rows = [
        (FILE_NAMES[t], i + 1, c) for t, cols in EXPECTED_COLUMNS.items() for i, c in enumerate(cols)
    ]
    return spark.createDataFrame(rows, "file string, column_position int, expected_column string")
