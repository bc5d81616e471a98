import os
import tempfile

import pytest
from pyspark.sql import functions as F

from orderlens.operators import quality
from orderlens.operators.checks import CheckFailed
from orderlens.plans import jobs
from orderlens.plans.registry_base import items, options
from orderlens.schemas import GOLD_SCHEMAS
from orderlens.sources import fixtures, ingest, layers


@pytest.fixture(scope="module")
def bronze(spark, sf):
    base = tempfile.mkdtemp(prefix="orderlens-bronze-")
    layers.write_layer(items(spark, sf), base, layers.BRONZE_TABLES["order_items"])
    layers.write_layer(options(spark, sf), base, layers.BRONZE_TABLES["options"])
    return base


def test_bronze_silver_gold_round_trip(spark, sf, bronze):
    root = tempfile.mkdtemp(prefix="orderlens-run-")
    silver_dir, gold_dir = f"{root}/silver", f"{root}/gold"
    r1 = jobs.bronze_to_silver(spark, bronze, silver_dir, calendar=fixtures.order_calendar(spark, sf))
    assert r1.counts["bronze_order_items"] == r1.counts["silver_order_items"] == 6000
    assert r1.counts["unmatched_option_keys"] > 60
    r2 = jobs.silver_to_gold(spark, silver_dir, gold_dir, database="gold_test")
    assert r2.counts["customer_ltv_daily"] == 1179 and r2.counts["order_detail"] == 6000
    for name, schema in GOLD_SCHEMAS.items():
        table = spark.table(f"gold_test.{name}")
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schema], name
        assert table.count() == r2.counts[name]


def test_failed_check_leaves_previous_output(spark, sf, bronze):
    root = tempfile.mkdtemp(prefix="orderlens-run-")
    silver_dir, gold_dir = f"{root}/silver", f"{root}/gold"
    jobs.bronze_to_silver(spark, bronze, silver_dir, calendar=fixtures.order_calendar(spark, sf))
    jobs.silver_to_gold(spark, silver_dir, gold_dir, database=None)
    before = layers.versions(spark, gold_dir)
    count = layers.read_layer(spark, gold_dir, "sales_hourly").count()
    # a silver table whose line grain is broken
    lines = layers.read_layer(spark, silver_dir, "order_items")
    bad_dir = f"{root}/silver_bad"
    layers.write_layer(lines.unionByName(lines.limit(1)), bad_dir, "order_items")
    layers.write_layer(layers.read_layer(spark, silver_dir, "order_item_options"), bad_dir, "order_item_options")
    with pytest.raises(CheckFailed):
        jobs.silver_to_gold(spark, bad_dir, gold_dir, database=None)
    assert layers.versions(spark, gold_dir) == before
    assert layers.read_layer(spark, gold_dir, "sales_hourly").count() == count > 0


def test_quality_report_from_csv(spark, sf):
    root = tempfile.mkdtemp(prefix="orderlens-q-")
    csv = {}
    for table, frame in (("order_items", fixtures.raw_order_items(spark, sf)),
                         ("order_item_options", fixtures.raw_options(spark, sf)),
                         ("date_dim", fixtures.raw_date_dim(spark, sf))):
        path = f"{root}/csv/{table}"
        frame.drop("source_row").coalesce(2).write.option("header", True).csv(path)
        csv[table] = path
    for table, short in jobs.RAW_FILES.items():
        layers.write_layer(ingest.read_raw_csv(spark, csv[table], table), f"{root}/bronze", f"raw_{short}")
    paths = jobs.quality_report(spark, f"{root}/bronze", f"{root}/report")
    assert set(paths) >= {"summary", "missing_values", "duplicates", "corrupt_values", "broken_references"}
    summary = {r["file"]: r for r in spark.read.parquet(paths["summary"]).collect()}
    assert summary["order_items.csv"]["rows"] == 6045
    assert summary["order_item_options.csv"]["rows"] == 7140
    broken = spark.read.parquet(paths["broken_references"])
    want = quality.broken_option_rows(fixtures.raw_options(spark, sf), fixtures.raw_order_items(spark, sf))
    assert broken.count() == want.count() > 183
    assert broken.agg(F.min("source_row")).first()[0] >= 2


def test_land_raw_csv_typed_load_is_strict(spark, sf):
    root = tempfile.mkdtemp(prefix="orderlens-land-")
    clean = {
        "order_items": items(spark, sf).select([F.col(c).cast("string") for c in items(spark, sf).columns]),
        "order_item_options": options(spark, sf).select([F.col(c).cast("string") for c in options(spark, sf).columns]),
        "date_dim": fixtures.raw_date_dim(spark, sf).drop("source_row").filter(
            "date_key NOT LIKE '31/%' AND month <> '13' AND week NOT IN ('1.5', 'wk')"),
    }
    csv = {}
    for table, frame in clean.items():
        csv[table] = f"{root}/csv/{table}"
        frame.coalesce(1).write.option("header", True).csv(csv[table])
    report = jobs.land_raw_csv(spark, csv, f"{root}/bronze")
    assert report.counts["raw_order_items"] == 6000
    typed = layers.read_layer(spark, f"{root}/bronze", layers.BRONZE_TABLES["order_items"])
    assert typed.schema["ITEM_PRICE"].dataType.simpleString() == "decimal(10,2)"
    assert typed.agg(F.sum("ITEM_QUANTITY")).first()[0] == items(spark, sf).agg(F.sum("ITEM_QUANTITY")).first()[0]
    dirty = f"{root}/csv_dirty"
    fixtures.raw_order_items(spark, sf).drop("source_row").coalesce(1).write.option("header", True).csv(dirty)
    with pytest.raises(Exception):
        jobs.land_raw_csv(spark, {**csv, "order_items": dirty}, f"{root}/bronze2")


def test_report_csv_and_table_lifecycle(spark, sf):
    root = tempfile.mkdtemp(prefix="orderlens-s14-")
    frames = {"zero_quantity": fixtures.raw_order_items(spark, sf).filter("trim(ITEM_QUANTITY) = '0'")}
    paths = layers.write_report(frames, f"{root}/report", fmt="csv")
    back = spark.read.option("header", True).csv(paths["zero_quantity"])
    assert back.count() == frames["zero_quantity"].count() > 0
    # Register, select all, drop (the data stays at its location)
    layers.write_layer(items(spark, sf).limit(5), root, "staging")
    folder = layers.table_folder(spark, root, "staging")
    spark.sql(f"CREATE TABLE IF NOT EXISTS staging_test USING parquet LOCATION '{folder}'")
    assert layers.read_table(spark, "staging_test").count() == 5
    layers.drop_table(spark, "staging_test")
    assert not spark.catalog.tableExists("staging_test")
    assert spark.read.parquet(folder).count() == 5


def test_holidays_from_bronze_date_dim(spark):
    import datetime as dt

    root = tempfile.mkdtemp(prefix="orderlens-hol-")
    dd = spark.createDataFrame(
        [(dt.date(2021, 12, 25), 2021, 12, 51, "Saturday", True, True, "Christmas"),
         (dt.date(2021, 12, 24), 2021, 12, 51, "Friday", False, False, None)],
        "date_key date, year int, month int, week int, day_of_week string, is_weekend boolean, "
        "is_holiday boolean, holiday_name string",
    )
    layers.write_layer(dd, root, layers.BRONZE_TABLES["date_dim"])
    lines = spark.createDataFrame(
        [("a", "r", dt.datetime(2021, 12, d, 10), str(d), "u", None, False, "USD", "1-1", "c", "n", None, 1) for d in (24, 25)],
        "APP_NAME string, RESTAURANT_ID string, CREATION_TIME_UTC timestamp_ntz, ORDER_ID string, USER_ID string, "
        "PRINTED_CARD_NUMBER string, IS_LOYALTY boolean, CURRENCY string, LINEITEM_ID string, ITEM_CATEGORY string, "
        "ITEM_NAME string, ITEM_PRICE decimal(10,2), ITEM_QUANTITY int",
    )
    layers.write_layer(lines, root, layers.BRONZE_TABLES["order_items"])
    layers.write_layer(options(spark, "/root/testdata/sf0.001").limit(0), root, layers.BRONZE_TABLES["options"])
    jobs.bronze_to_silver(spark, root, f"{root}/silver", holidays_from_date_dim=True)
    cal = {r["date_key"]: r for r in layers.read_layer(spark, f"{root}/silver", "date_dim").collect()}
    assert cal[dt.date(2021, 12, 25)]["is_holiday"] is True
    assert cal[dt.date(2021, 12, 25)]["holiday_name"] == "Christmas"
    assert cal[dt.date(2021, 12, 24)]["is_holiday"] is False
    row = layers.read_layer(spark, f"{root}/silver", "order_items").filter("ORDER_ID = '25'").first()
    assert row["is_holiday"] is True and row["holiday_name"] == "Christmas"


def test_empty_lifetime_value_fails_before_writing(spark, sf, bronze):
    root = tempfile.mkdtemp(prefix="orderlens-run-")
    silver_dir = f"{root}/silver"
    jobs.bronze_to_silver(spark, bronze, silver_dir, calendar=fixtures.order_calendar(spark, sf))
    guests = f"{root}/silver_guests"
    lines = layers.read_layer(spark, silver_dir, "order_items").withColumn("USER_ID", F.lit(None).cast("string"))
    layers.write_layer(lines, guests, "order_items")
    layers.write_layer(layers.read_layer(spark, silver_dir, "order_item_options"), guests, "order_item_options")
    with pytest.raises(CheckFailed, match="empty"):
        jobs.silver_to_gold(spark, guests, f"{root}/gold", database=None)
    assert layers.versions(spark, f"{root}/gold") == {}


def test_check_helpers_raise(spark):
    from orderlens.operators import checks

    with pytest.raises(CheckFailed):
        checks.assert_same_count(5, 6, "Silver order_items")
    df = spark.createDataFrame([("1", "a"), ("1", "a")], "k string, v string")
    with pytest.raises(CheckFailed):
        checks.assert_no_duplicates(df, ["k"], "t")
    with pytest.raises(CheckFailed):
        checks.assert_not_empty(df.limit(0), "t")
    checks.assert_not_empty(df, "t")


def test_missing_input_file_is_an_error(spark):
    from orderlens.sources import ingest as ing

    with pytest.raises(Exception):
        ing.read_raw_csv(spark, "/nonexistent/order_items.csv", "order_items").count()


def test_duplicate_calendar_day_fails_before_silver_is_replaced(spark, sf, bronze):
    root = tempfile.mkdtemp(prefix="orderlens-run-")
    cal = fixtures.order_calendar(spark, sf)
    busy_day = items(spark, sf).select(F.to_date("CREATION_TIME_UTC")).first()[0]
    doubled = cal.unionByName(cal.filter(F.col("date_key") == busy_day))
    with pytest.raises(CheckFailed, match="date_dim"):
        jobs.bronze_to_silver(spark, bronze, f"{root}/silver", calendar=doubled)
    assert layers.versions(spark, f"{root}/silver") == {}


def test_row_count_check_precedes_the_swap(spark, sf, bronze, monkeypatch):
    """V6: lines that multiply leave the earlier silver tables as they were."""
    from orderlens.operators import silver

    root = tempfile.mkdtemp(prefix="orderlens-run-")
    jobs.bronze_to_silver(spark, bronze, f"{root}/silver")
    before = sorted(map(tuple, layers.read_layer(spark, f"{root}/silver", "order_items").select("LINEITEM_ID").collect()))
    plain = silver.silver_order_items
    monkeypatch.setattr(silver, "silver_order_items", lambda *a: (out := plain(*a)).unionByName(out.limit(3)))
    with pytest.raises(CheckFailed, match="rows, expected"):
        jobs.bronze_to_silver(spark, bronze, f"{root}/silver")
    assert sorted(map(tuple, layers.read_layer(spark, f"{root}/silver", "order_items").select("LINEITEM_ID").collect())) == before


def test_default_calendar_covers_the_orders(spark, sf, bronze):
    root = tempfile.mkdtemp(prefix="orderlens-run-")
    jobs.bronze_to_silver(spark, bronze, f"{root}/silver")
    lines = layers.read_layer(spark, f"{root}/silver", "order_items")
    assert lines.filter("ORDER_DATE IS NOT NULL AND (week IS NULL OR is_weekend IS NULL)").count() == 0


def test_failed_write_keeps_the_old_rows(spark):
    root = tempfile.mkdtemp(prefix="orderlens-swap-")
    layers.write_layer(spark.range(5), root, "t")
    bad = spark.range(5).select(F.raise_error(F.lit("bad price")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="bad price"):
        layers.write_layer(bad, root, "t")
    assert layers.read_layer(spark, root, "t").count() == 5
    # a table may be replaced by what was read from it
    layers.write_layer(layers.read_layer(spark, root, "t").filter("id < 3"), root, "t")
    assert layers.read_layer(spark, root, "t").count() == 3
    assert len(os.listdir(f"{root}/_data/t")) == 2  # the current version and the one before


def test_failed_typed_load_keeps_all_bronze_tables(spark, tmp_path):
    from orderlens.schemas import EXPECTED_COLUMNS

    rows = {"order_items": ["app,r,2021-12-07T16:23:30Z,1,u,,TRUE,USD,1-1,c,n,{price},1"], "order_item_options": ["1,1-1,g,n,1.00,1"],
            "date_dim": ["07-12-2021,2021,12,49,Tuesday,FALSE,FALSE,"]}
    csv = {}
    for table, lines in rows.items():
        csv[table] = f"{tmp_path}/{table}.csv"
        with open(csv[table], "w", encoding="utf-8") as out:
            out.write("\n".join([",".join(EXPECTED_COLUMNS[table]), *lines]).format(price="2.50") + "\n")
    jobs.land_raw_csv(spark, csv, f"{tmp_path}/bronze")
    with open(csv["order_items"], "a", encoding="utf-8") as out:
        out.write(rows["order_items"][0].format(price="4:39") + "\n")
    with pytest.raises(Exception):
        jobs.land_raw_csv(spark, csv, f"{tmp_path}/bronze")
    for name in ("raw_order_items", layers.BRONZE_TABLES["order_items"], layers.BRONZE_TABLES["options"]):
        assert layers.read_layer(spark, f"{tmp_path}/bronze", name).count() == 1


def test_summary_is_the_same_in_either_format(spark, sf):
    """Values with line breaks are counted from the frames, not from written CSV."""
    root = tempfile.mkdtemp(prefix="orderlens-fmt-")
    raws = {"order_items": fixtures.raw_order_items(spark, sf), "options": fixtures.raw_options(spark, sf).withColumn(
        "OPTION_PRICE", F.concat("OPTION_PRICE", F.lit("\nx"))), "date_dim": fixtures.raw_date_dim(spark, sf)}
    for short, raw in raws.items():
        layers.write_layer(raw, f"{root}/bronze", f"raw_{short}")
    a = jobs.quality_report(spark, f"{root}/bronze", f"{root}/a")
    b = jobs.quality_report(spark, f"{root}/bronze", f"{root}/b", fmt="csv")
    want = sorted(tuple(map(str, r)) for r in spark.read.parquet(a["summary"]).collect())
    assert sorted(tuple(map(str, r)) for r in spark.read.option("header", True).csv(b["summary"]).collect()) == want
    bad = {r[0]: r[-1] for r in want}["order_item_options.csv"]
    assert int(bad) >= raws["options"].filter("OPTION_PRICE IS NOT NULL").count()
    assert {"missing_item_fields", "zero_quantity", "affected_orders"} <= set(a)
