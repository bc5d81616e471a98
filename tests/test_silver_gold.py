import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderlens.operators import gold, silver
from orderlens.plans.registry_base import silver_lines, silver_opts
from orderlens.schemas import GOLD_SCHEMAS, TYPED_SCHEMAS

ITEM_COLS = TYPED_SCHEMAS["order_items"]


def _items(spark, rows):
    return spark.createDataFrame(rows, ITEM_COLS)


def _line(order, line, user, ts, price="10.00", qty=1, loyal=False, card=None):
    return ("app", "r1", ts, order, user, card, loyal, "USD", line, "cat", "name", Decimal(price), qty)


def test_daypart_customer_and_card(spark):
    hours = [0, 4, 5, 11, 12, 16, 17, 23]
    rows = [_line(f"o{h}", "l1", "u", dt.datetime(2021, 1, 4, h, 0)) for h in hours]
    rows.append(_line("onull", "l1", None, None))
    rows.append(_line("oblank", "l1", " ", dt.datetime(2021, 1, 4, 1), card=" "))
    rows.append(_line("ocard", "l1", "", dt.datetime(2021, 1, 4, 1), card="123"))
    out = {r["ORDER_ID"]: r for r in silver.derive_line_columns(_items(spark, rows)).collect()}
    bands = [out[f"o{h}"]["TIME_OF_DAY_UTC"] for h in hours]
    assert bands == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]
    assert out["onull"]["TIME_OF_DAY_UTC"] == "Evening"
    assert out["onull"]["CUSTOMER_TYPE"] == "GUEST" and out["oblank"]["CUSTOMER_TYPE"] == "GUEST"
    assert out["o0"]["CUSTOMER_TYPE"] == "IDENTIFIED"
    assert out["oblank"]["CARD_STATUS"] == "NO_CARD" and out["ocard"]["CARD_STATUS"] == "CARD_PRESENT"
    assert out["onull"]["CARD_STATUS"] == "NO_CARD"


def test_silver_keeps_every_line_and_nulls_outside_calendar(spark):
    rows = [
        _line("1", "1-1", "u1", dt.datetime(2021, 1, 4, 9), "2.50", 2),
        _line("1", "1-2", "u1", dt.datetime(2021, 1, 4, 9), "1.00", 1),
        _line("2", "2-1", "u2", dt.datetime(2030, 1, 1, 9), "1.00", 1),
    ]
    opts = spark.createDataFrame(
        [("1", "1-1", "g", "a", Decimal("0.50"), 2), ("1", "1-1", "g", "a", Decimal("0.50"), 2),
         ("9", "9-1", "g", "a", Decimal("1.00"), 1)],
        TYPED_SCHEMAS["order_item_options"],
    )
    cal = silver.build_calendar(spark, "2021-01-01", "2021-12-31")
    out = {r["LINEITEM_ID"]: r for r in silver.silver_order_items(_items(spark, rows), opts, cal).collect()}
    assert len(out) == 3
    assert out["1-1"]["OPTION_REVENUE"] == Decimal("2.00")  # repeats are summed
    assert out["1-1"]["TOTAL_LINE_REVENUE"] == Decimal("7.00")
    assert out["1-2"]["OPTION_REVENUE"] == Decimal("0.00")
    assert out["1-1"]["day_of_week"] == "Monday" and out["1-1"]["is_weekend"] is False
    assert out["2-1"]["year"] is None and out["2-1"]["day_of_week"] is None
    unmatched = silver.unmatched_option_keys(_items(spark, rows), opts).collect()
    assert [tuple(r) for r in unmatched] == [("9", "9-1")]


def test_calendar_iso_week_and_span(spark):
    cal = {r["date_key"]: r for r in silver.build_calendar(spark).collect()}
    assert len(cal) == 1402
    jan1 = cal[dt.date(2021, 1, 1)]
    assert (jan1["year"], jan1["week"], jan1["day_of_week"]) == (2021, 53, "Friday")
    assert cal[dt.date(2021, 1, 2)]["is_weekend"] is True and cal[dt.date(2021, 1, 2)]["is_holiday"] is False


def test_holidays_are_marked(spark):
    hol = spark.createDataFrame([(dt.date(2021, 12, 25), "Christmas")], "date_key date, holiday_name string")
    cal = {r["date_key"]: r for r in silver.build_calendar(spark, "2021-12-24", "2021-12-26", hol).collect()}
    assert cal[dt.date(2021, 12, 25)]["is_holiday"] is True
    assert cal[dt.date(2021, 12, 25)]["holiday_name"] == "Christmas"
    assert cal[dt.date(2021, 12, 24)]["is_holiday"] is False


def test_option_daily_free_paid_null_negative(spark):
    ctx = spark.createDataFrame(
        [("o1", "l1", "g", "a", Decimal("0.00"), 2, "app", "r", dt.date(2021, 1, 1)),
         ("o1", "l1", "g", "a", Decimal("1.00"), 1, "app", "r", dt.date(2021, 1, 1)),
         ("o2", "l1", "g", "a", None, 5, "app", "r", dt.date(2021, 1, 1)),
         ("o3", "l1", "g", "a", Decimal("-1.00"), 1, "app", "r", dt.date(2021, 1, 1))],
        "ORDER_ID string, LINEITEM_ID string, OPTION_GROUP_NAME string, OPTION_NAME string, "
        "OPTION_PRICE decimal(10,2), OPTION_QUANTITY int, APP_NAME string, RESTAURANT_ID string, ORDER_DATE date",
    ).withColumn("OPTION_REVENUE", F.col("OPTION_PRICE").cast("decimal(18,2)") * F.col("OPTION_QUANTITY"))
    r = gold.conform(gold.option_daily(ctx), "option_daily").first()
    assert r["order_count"] == 3 and r["option_quantity"] == 9
    assert r["free_option_quantity"] == 2 and r["paid_option_quantity"] == 1
    assert r["free_option_order_count"] == 1 and r["paid_option_order_count"] == 1
    assert r["paid_option_revenue"] == Decimal("1.00")
    assert r["average_option_price"] == Decimal("0.00")  # (0 + 1 - 1) / 3 priced rows


def test_gold_contracts_and_invariants(spark, sf):
    lines = silver_lines(spark, sf)
    ds = gold.gold_datasets(lines, silver_opts(spark, sf))
    for name, df in ds.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in GOLD_SCHEMAS[name]], name
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    t = total(ds["order_detail"], "total_line_revenue")
    assert total(ds["sales_hourly"], "total_revenue") == t
    assert total(ds["restaurant_daily"], "total_revenue") == t
    assert total(ds["item_daily"], "item_revenue") == total(lines, "ITEM_REVENUE")
    ctx = gold.options_with_context(silver_opts(spark, sf), lines)
    assert total(ds["option_daily"], "option_revenue") == total(ctx, "OPTION_REVENUE")
    last = ds["customer_ltv_daily"].groupBy("user_id").agg(
        F.max_by("cumulative_ltv", "order_date").alias("ltv"),
        F.max_by("cumulative_order_count", "order_date").alias("n"),
    )
    joined = last.join(ds["customer_summary"], "user_id")
    assert joined.count() == ds["customer_summary"].count()
    assert joined.filter((F.col("ltv") != F.col("total_revenue")) | (F.col("n") < F.col("order_count"))).count() == 0
    assert ds["customer_ltv_daily"].count() == 1179


def test_averages_are_rounded_once(spark):
    """100.00 over 20,001 orders is 0.00499975: rounding to six places first would give
    a cent."""
    one = _items(spark, [_line("first", "l", "u", dt.datetime(2021, 1, 4), price="100.00")])
    rest = spark.range(20_000).select(F.col("id").cast("string").alias("ORDER_ID")).crossJoin(one.drop("ORDER_ID")).withColumn(
        "ITEM_PRICE", F.lit("0.00").cast("decimal(10,2)"))
    opts = spark.createDataFrame([], TYPED_SCHEMAS["order_item_options"])
    cal = silver.build_calendar(spark, "2021-01-01", "2021-12-31")
    rollup = gold.order_rollup(silver.silver_order_items(one.unionByName(rest), opts, cal))
    for name, build in (("sales_hourly", gold.sales_hourly), ("restaurant_daily", gold.restaurant_daily), ("customer_summary", gold.customer_summary)):
        row = gold.conform(build(rollup), name).first()
        assert row["order_count"] == 20_001 and row["average_order_value"] == Decimal("0.00"), name


def test_lines_without_an_order_are_no_order(spark):
    rows = [_line("o1", "l1", "u", dt.datetime(2021, 1, 4), loyal=True), _line(None, "l2", "u", dt.datetime(2021, 1, 4), loyal=True),
            _line(None, "l3", "w", dt.datetime(2021, 1, 4))]
    opts = spark.createDataFrame([], TYPED_SCHEMAS["order_item_options"])
    rollup = gold.order_rollup(silver.silver_order_items(_items(spark, rows), opts, silver.build_calendar(spark, "2021-01-01", "2021-12-31")))
    got = {r["user_id"]: r for r in gold.conform(gold.customer_summary(rollup), "customer_summary").collect()}
    assert (got["u"]["order_count"], got["u"]["loyalty_order_count"], got["u"]["total_revenue"]) == (1, 1, Decimal("20.00"))
    assert (got["w"]["order_count"], got["w"]["average_order_value"]) == (0, Decimal("0.00"))
