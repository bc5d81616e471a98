from pyspark.sql import functions as F

from orderlens.functions import membership as ms
from orderlens.operators import metrics as m
from orderlens.operators import quality as dq
from orderlens.plans.registry_base import items
from orderlens.schemas import EXPECTED_COLUMNS
from orderlens.sources import fixtures, layers


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_rows_of_the_set_pass_whatever_the_size_of_the_bitmap(spark):
    df = spark.range(20_000).withColumn("h", ms.key_hash([F.col("id").cast("string")]))
    keys = df.filter("id % 100 = 7").select(F.col("h").alias("k"))
    for bits, most in ((24, 210), (12, 4_000), (6, 20_000)):
        out = ms.may_be_in(df, F.col("h"), keys, "k", bits)
        assert out.columns == df.columns
        assert out.filter("id % 100 = 7").count() == 200 and 200 <= out.count() <= most
    assert ms.may_be_in(df, F.col("h"), keys.limit(0), "k").count() == 0


def test_nulls_are_values(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", ""), (None, None)], "x string, y string")
    assert df.select(ms.key_hash([F.col("x"), F.col("y")])).distinct().count() == 4


def raw_rows(spark, rows):
    names = EXPECTED_COLUMNS["order_item_options"]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "source_row long, " + ", ".join(f"{c} string" for c in names))


def test_duplicates_by_hash_are_those_by_value(spark):
    import random

    rng = random.Random(2)
    values = [None, "", "a", "b"]
    rows = [tuple(rng.choice(values) for _ in range(6)) for _ in range(3000)] + [("hot",) * 6] * 800
    raw = raw_rows(spark, rows).repartition(5)
    names = EXPECTED_COLUMNS["order_item_options"]
    plain = raw.groupBy(*names).agg(F.count("*").alias("n"), F.min("source_row").alias("f")).filter("n > 1")
    got = dq.duplicate_rows(raw, "order_item_options")
    assert sorted((r["duplicate_group_size"], r["first_source_row"]) for r in got.collect()) == sorted((r["n"], r["f"]) for r in plain.collect())
    assert dq.duplicate_members(raw, "order_item_options").count() == plain.agg(F.sum("n")).first()[0]


def test_orphans_by_key_are_those_by_value(spark):
    options = raw_rows(spark, [(o, i, "g", "n", "1", "1") for o in (None, "1", "2", "x") for i in (None, "1-1", "9")] * 3)
    lines = spark.createDataFrame([("1", "1-1"), (None, "9"), ("2", None), ("2", None)], "ORDER_ID string, LINEITEM_ID string")
    got = {(r["ORDER_ID"], r["LINEITEM_ID"]) for r in dq.broken_option_rows(options, lines).collect()}
    every = {(o, i) for o in (None, "1", "2", "x") for i in (None, "1-1", "9")}
    assert got == every - {("1", "1-1"), (None, "9"), ("2", None)}
    assert dq.broken_option_rows(options, lines).count() == 27


def test_rows_without_copies_are_shuffled_as_hashes(spark, sf, tmp_path):
    fixtures.raw_order_items(spark, sf).write.parquet(f"{tmp_path}/raw")
    raw = layers.read_layer(spark, str(tmp_path), "raw")
    df = dq.duplicate_rows(raw, "order_items")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # below the exchange by all columns stands the bitmap's join
    wide = plan.split("hashpartitioning(APP_NAME")[1]
    assert "BroadcastHashJoin" in wide.split("FileScan")[0]


def test_the_summary_scans_every_raw_file_once(spark, sf, tmp_path):
    raws = {"date_dim": fixtures.raw_date_dim(spark, sf), "items": fixtures.raw_order_items(spark, sf), "options": fixtures.raw_options(spark, sf)}
    for name, raw in raws.items():
        raw.write.parquet(f"{tmp_path}/{name}")
    stored = [layers.read_layer(spark, str(tmp_path), name) for name in raws]
    df = dq.quality_summary(spark, *stored)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3
    by_file = {r["file"]: r for r in df.collect()}
    for table, raw in zip(dq.RAW_ORDER, stored):
        row = by_file[dq.FILE_NAMES[table]]
        assert row["rows"] == raw.count() and row["columns"] == len(raw.columns) - 1
        assert row["duplicate_groups"] == dq.duplicate_rows(raw, table).count() > 0
        assert row["missing_values"] == dq.missing_values(raw, table).agg(F.sum("missing_count")).first()[0]
        issues = dq.value_issues(raw, table).count()
        assert row["corrupt_or_invalid_values"] == issues + (dq.broken_option_rows(stored[2], stored[1]).count() if table == "order_item_options" else 0)


def test_the_summary_of_empty_files(spark, sf):
    raws = [fixtures.raw_date_dim(spark, sf).limit(0), fixtures.raw_order_items(spark, sf).limit(0), fixtures.raw_options(spark, sf).limit(0)]
    rows = dq.quality_summary(spark, *raws).collect()
    assert len(rows) == 3 and all(r["rows"] == r["missing_values"] == r["duplicate_groups"] == r["corrupt_or_invalid_values"] == 0 for r in rows)


def test_a_hot_user_with_an_unknown_total_is_cut(spark):
    """A third of the orders on no user, one of them without a total: differences are those
    of a lag, and no task takes the user whole."""
    n = 6000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise((F.col("id") % 500).cast("string")).alias("USER_ID"),
        F.concat(F.lit("o"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("ORDER_ID"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(pmod(id * 7919, 200000) as int))").alias("CREATION_TIME_UTC"),
        F.when(~F.col("id").isin(3, 9, 600), (F.col("id") * 37 % 101).cast("decimal(10,2)")).alias("ITEM_PRICE"),
        F.lit(1).alias("ITEM_QUANTITY"),
    )
    got = {r["USER_ID"]: r for r in m.order_gaps(rows, include_guests=True).collect()}
    pdf = m.order_totals(rows, include_guests=True).toPandas().sort_values(["order_time", "ORDER_ID"])
    pdf["order_total"] = pdf["order_total"].astype(float)
    for user, part in [(None, pdf[pdf["USER_ID"].isna()]), *pdf.groupby("USER_ID")]:
        assert got[user]["total_orders"] == len(part)
        assert abs(got[user]["avg_spend_diff_between_orders"] - part["order_total"].diff().mean()) < 1e-5
    segments = m.order_totals(rows, include_guests=True).repartitionByRange(4, "USER_ID", "order_time", "ORDER_ID")
    sizes = segments.filter("USER_ID IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 2 and max(r["count"] for r in sizes) < 0.35 * n


def test_a_calendar_is_bounded(spark):
    """Lines dated in the years 1 and 9999 do not stretch the calendar."""
    import datetime as dt

    from orderlens.operators import silver

    days = [dt.datetime(1, 1, 1), dt.datetime(2021, 3, 1), dt.datetime(2021, 3, 9), dt.datetime(9999, 12, 31)]
    lines = spark.createDataFrame([(d,) for d in days], "CREATION_TIME_UTC timestamp_ntz")
    assert silver.build_calendar(bounds=silver.order_span(lines)).count() == 9
    assert silver.order_span(lines.limit(0)).count() == 0
    try:
        silver.build_calendar(spark, "1500-01-01", "2100-01-01").count()
    except Exception as e:  # noqa: BLE001
        assert "400 years" in str(e)
    else:
        raise AssertionError("no error")


def test_a_bitmap_does_not_make_spark_compute_the_rows_twice(spark, sf):
    """A join key that may be null is tested below all that makes the rows."""
    import re

    from orderlens.plans.registry import all_queries

    for name in ("dq_duplicate_rows_order_items", "dq_duplicate_members_order_items", "dq_broken_options"):
        plan = all_queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert "xxhash64" in plan and not re.search(r"isnotnull\([^#]*xxhash64", plan), name


def test_rows_that_may_repeat_are_made_once_for_both_sides_of_their_join(spark, sf):
    members = dq.duplicate_members(fixtures.raw_order_items(spark, sf), "order_items")
    dealt = [line for line in final_plan(members).splitlines() if "REBALANCE_PARTITIONS" in line]
    assert sorted("ReusedExchange" in line for line in dealt) == [False, True]


def test_lines_are_made_once_for_what_reads_them_twice(spark, sf):
    """Numbered lines in the final plan: of the options (keys, rows), the line keys and the
    lines; of the options, all lines and the late days."""
    from orderlens.plans.registry import all_queries

    for name, most in (("dq_broken_order_items", 4), ("customer_ltv_refreshed", 3)):
        assert final_plan(all_queries()[name](spark, sf)).count("Window [row_number") == most, name


def test_lines_of_broken_orders_with_a_hot_and_a_lone_id(spark):
    """A third of the lines on no order; ids of the broken options with lines, without any, null."""
    names = dq.BROKEN_ORDER_COLUMNS
    order = [None if i % 3 == 0 else str(i % 50) for i in range(3000)]
    lines = spark.createDataFrame([(o, str(i), *["x"] * 7) for i, o in enumerate(order)], ", ".join(f"{c} string" for c in names))
    for ids in ([None, "7", "7", "lone"], ["lone", "8"], [None], []):
        broken = spark.createDataFrame([(i,) for i in ids], "ORDER_ID string")
        got = sorted((r["ORDER_ID"] or "", r["LINEITEM_ID"] or "") for r in dq.broken_order_lines(broken, lines).collect())
        want = [(o or "", str(i)) for i, o in enumerate(order) if o in ids] + [("lone", "")] * ("lone" in ids)
        assert got == sorted(want), ids
    none = lines.filter("ORDER_ID IS NOT NULL")
    assert [tuple(r) for r in dq.broken_order_lines(spark.createDataFrame([(None,)], "ORDER_ID string"), none).collect()] == [(None,) * 9]
