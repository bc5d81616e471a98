"""Test-table recipe: TPC-H-style tables -> the workload's order data.

The given tables (``lineitem orders customer nation region part``) are mapped
onto ``order_items`` / ``order_items_options`` and onto dirty raw text versions
of them, all as Spark plans over the whole tables. Modulo arithmetic here only
*shapes* values (null users, hours, repeat rows); no row is filtered away to
make a check cheaper. Every recipe has an identical DuckDB twin in
``orderlens.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.operators.silver import build_calendar

C = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem plus ``rn``, the line's position inside its order.

    (l_orderkey, l_linenumber) is not unique in the test data, so lines are
    numbered with a window partitioned by order (rows per order are few)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate",
    )
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"
    )
    return li.withColumn("rn", F.row_number().over(w))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed order lines: one app (region) and restaurant (nation) per order."""
    lines = numbered_lines(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions.
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name", "p_retailprice")
    ok = C("o_orderkey")
    joined = (
        lines.join(orders, C("l_orderkey") == ok)
        .join(customer, C("o_custkey") == C("c_custkey"))
        .join(nation, C("c_nationkey") == C("n_nationkey"))
        .join(region, C("n_regionkey") == C("r_regionkey"))
        .join(part, C("l_partkey") == C("p_partkey"))
    )
    return joined.select(
        C("r_name").alias("APP_NAME"),
        C("n_name").alias("RESTAURANT_ID"),
        (C("o_orderdate") + F.make_dt_interval(F.lit(0), ok % 24, ok % 60, F.lit(0))).alias(
            "CREATION_TIME_UTC"
        ),
        # some first lines have lost their order id
        F.when((ok % 29 == 0) & (C("rn") == 1), F.lit(None).cast("string")).otherwise(_s(ok)).alias("ORDER_ID"),
        F.when(ok % 10 == 0, F.lit(None).cast("string"))
        .when(ok % 10 == 1, F.lit(" "))
        .otherwise(_s(C("o_custkey")))
        .alias("USER_ID"),
        F.when(ok % 7 == 0, _s(F.lit(1000000) + C("o_custkey")))
        .when(ok % 7 == 1, F.lit(""))
        .alias("PRINTED_CARD_NUMBER"),
        ((C("o_orderstatus") == "F") & (ok % 10 > 1)).alias("IS_LOYALTY"),
        F.lit("USD").alias("CURRENCY"),
        F.concat(_s(ok), F.lit("-"), _s(C("rn"))).alias("LINEITEM_ID"),
        C("p_type").alias("ITEM_CATEGORY"),
        C("p_name").alias("ITEM_NAME"),
        # some orders have no prices, so no total
        F.when(ok % 31 != 0, C("p_retailprice")).cast("decimal(10,2)").alias("ITEM_PRICE"),
        C("l_quantity").cast("int").alias("ITEM_QUANTITY"),
    )


def _options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options with ``_place``, a number of their own in file order."""
    lines = numbered_lines(spark, sf_dir)
    ok, pk = C("l_orderkey"), C("l_partkey")
    n_options = (
        F.when(ok % 11 == 0, 3).when(ok % 5 < 2, 2).when(ok % 5 == 2, 1).otherwise(0)
    )
    exploded = lines.withColumn(
        "n", F.explode(F.slice(F.array(F.lit(1), F.lit(2), F.lit(3)), 1, n_options))
    )
    n = C("n")
    price = (
        F.when(n == 2, F.lit(0.0))
        .when((n == 3) & (ok % 22 == 0), C("l_discount") * 10 + 1)
        .otherwise(C("l_discount") * 10)
    )
    return exploded.select(
        F.when(pk % 97 == 0, F.concat(F.lit("ORPHAN-"), _s(ok))).otherwise(_s(ok)).alias("ORDER_ID"),
        F.concat(_s(ok), F.lit("-"), _s(C("rn"))).alias("LINEITEM_ID"),
        F.when(n == 3, F.lit("group-1")).otherwise(F.concat(F.lit("group-"), _s(n))).alias(
            "OPTION_GROUP_NAME"
        ),
        F.concat(
            F.lit("opt-"), _s(F.when(n == 3, pk % 5).otherwise((pk + n - 1) % 5))
        ).alias("OPTION_NAME"),
        price.cast("decimal(10,2)").alias("OPTION_PRICE"),
        (F.lit(1) + pk % 3).cast("int").alias("OPTION_QUANTITY"),
        ((ok * 1000 + C("rn")) * 4 + n).cast("bigint").alias("_place"),
    )


def order_items_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero to three options per line, generated with ``explode`` (no cross join):
    free options (price 0), exact repeats, repeats with another price, and
    orphans whose ORDER_ID matches no line."""
    return _options(spark, sf_dir).drop("_place")


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar spanning whole years around the order dates.

    The span comes from ``orders.o_orderdate`` (a one-column scan; every line
    of an order falls on the order's date), so it grows with the data; the
    calendar holds one row per day of that span."""
    day = F.to_date("o_orderdate")
    bounds = table(spark, sf_dir, "orders").agg(
        F.trunc(F.min(day), "year").alias("start"),
        F.date_sub(F.add_months(F.trunc(F.max(day), "year"), 12), 1).alias("end"),
    )
    return build_calendar(bounds=bounds)


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty text version of ``order_items`` with its source row number.

    Bad timestamps (a bare time, a bare year, one with an offset that is good),
    booleans, currency codes, prices and quantities (with suffixes), a category with a
    link, a line with missing id/category/name (blanks, tabs, line breaks), and exact
    repeated rows are mixed in by value rules. The source row is a number of the
    line's own that grows in file order; it has gaps, so no rows need counting."""
    items = order_items(spark, sf_dir)
    order = F.substring_index(C("LINEITEM_ID"), "-", 1).cast("bigint")
    line_no = F.substring_index(C("LINEITEM_ID"), "-", -1).cast("bigint")
    h = order * 7 + line_no
    copies = F.when(h % 149 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    base = items.select(
        "*", h.alias("_h"), ((order * 1000 + line_no) * 2 + 2).alias("_place"), F.explode(copies).alias("_dup")
    )
    hh = C("_h")
    time = _s(C("CREATION_TIME_UTC"))

    def dirty(column: str, *cases: tuple[int, str | None]) -> Column:
        out = F
        for divisor, text in cases:
            out = out.when(hh % divisor == 0, F.lit(text).cast("string"))
        return out.otherwise(_s(C(column))).alias(column)

    return base.select(
        (C("_place") + C("_dup")).alias("source_row"),
        "APP_NAME",
        "RESTAURANT_ID",
        F.when(hh % 137 == 0, "not-a-time")
        .when(hh % 151 == 0, "4:39")
        .when(hh % 157 == 0, "2021")
        .when(hh % 173 == 0, F.concat(time, F.lit("+02:00")))
        .otherwise(time)
        .alias("CREATION_TIME_UTC"),
        "ORDER_ID",
        "USER_ID",
        "PRINTED_CARD_NUMBER",
        F.when(hh % 131 == 0, "maybe").when(C("IS_LOYALTY"), "TRUE").otherwise("FALSE").alias("IS_LOYALTY"),
        dirty("CURRENCY", (127, "usd")),
        dirty("LINEITEM_ID", (139, None)),
        dirty("ITEM_CATEGORY", (139, "\t \n"), (179, "see http://example.com/menu")),
        dirty("ITEM_NAME", (139, "")),
        dirty("ITEM_PRICE", (101, "4:39"), (103, "-1.00"), (163, "12d"), (167, " 12.50\t")),
        dirty("ITEM_QUANTITY", (107, "0"), (109, "1.5"), (113, "x"), (181, "12F")),
    )


def raw_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty text version of ``order_items_options`` with its source row number:
    a null ORDER_ID, a negative and a non-numeric price, a zero and a blank
    quantity, keyed on the line id's ending."""
    lid = C("LINEITEM_ID")
    return _options(spark, sf_dir).select(
        (C("_place") + 2).alias("source_row"),
        F.when(lid.like("%77-1"), F.lit(None).cast("string")).otherwise(C("ORDER_ID")).alias(
            "ORDER_ID"
        ),
        lid,
        "OPTION_GROUP_NAME",
        "OPTION_NAME",
        F.when(lid.like("%13-2"), F.lit("-0.50"))
        .when(lid.like("%17-3"), F.lit("free"))
        .otherwise(_s(C("OPTION_PRICE")))
        .alias("OPTION_PRICE"),
        F.when(lid.like("%19-1"), F.lit("0"))
        .when(lid.like("%23-1"), F.lit(" \t"))
        .otherwise(_s(C("OPTION_QUANTITY")))
        .alias("OPTION_QUANTITY"),
    )


def raw_options_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_options`` from a file with a missing and an unexpected column."""
    return raw_options(spark, sf_dir).withColumnRenamed("OPTION_GROUP_NAME", "OPTION_GROUP")


def raw_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty text date dimension over the order calendar: a date in the wrong
    format, an out-of-range month, a fractional and a non-numeric week, a
    lower-case weekday, a bad holiday flag, some days twice. Rows follow the date, so
    the source row comes from the day's position in the span (no window needed)."""
    d, m = F.dayofmonth("date_key"), C("month")
    copies = F.when((d == 15) & (m == 1), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    cal = order_calendar(spark, sf_dir).select("*", F.explode(copies).alias("_dup"))
    d, m = F.dayofmonth("date_key"), C("month")
    two = lambda c: F.lpad(_s(c), 2, "0")
    return cal.select(
        (C("day_index") * 2 + C("_dup") + 2).cast("bigint").alias("source_row"),
        F.when((d == 31) & (m == 1), F.concat(F.lit("31/01/"), _s(C("year"))))
        .otherwise(F.concat(two(d), F.lit("-"), two(m), F.lit("-"), _s(C("year"))))
        .alias("date_key"),
        _s(C("year")).alias("year"),
        F.when((d == 30) & (m == 6), F.lit("13")).otherwise(_s(m)).alias("month"),
        F.when((d == 29) & (m == 3), F.lit("1.5"))
        .when((d == 28) & (m == 3), F.lit("wk"))
        .otherwise(_s(C("week")))
        .alias("week"),
        F.when((d == 4) & (m == 7), F.lit("monday")).otherwise(C("day_of_week")).alias("day_of_week"),
        F.when(C("is_weekend"), F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("is_weekend"),
        F.when((d == 25) & (m == 12), F.lit("yes")).otherwise(F.lit("FALSE")).alias("is_holiday"),
        F.when((d == 25) & (m == 12), F.lit("Christmas")).otherwise(F.lit("")).alias("holiday_name"),
    )
