from pyspark.sql import functions as F

from orderlens.sources import fixtures


def test_fixture_row_counts(spark, sf):
    assert fixtures.order_items(spark, sf).count() == 6000
    assert fixtures.order_items_options(spark, sf).count() == 7140
    assert fixtures.raw_order_items(spark, sf).count() == 6045
    assert fixtures.raw_options(spark, sf).count() == 7140
    assert fixtures.order_calendar(spark, sf).count() == 2557
    assert fixtures.raw_date_dim(spark, sf).count() == 2557 + 7


def test_line_ids_unique(spark, sf):
    items = fixtures.order_items(spark, sf)
    assert items.select("LINEITEM_ID").distinct().count() == items.count()


def test_hard_cases_are_there(spark, sf):
    items = fixtures.order_items(spark, sf)
    assert items.filter("ORDER_ID IS NULL").count() > 0
    assert items.filter("ITEM_PRICE IS NULL").count() > 0
    raw = fixtures.raw_order_items(spark, sf)
    for case in ("CREATION_TIME_UTC = '4:39'", "CREATION_TIME_UTC = '2021'", "CREATION_TIME_UTC LIKE '%+02:00'",
                 "ITEM_PRICE = '12d'", "ITEM_QUANTITY = '12F'", "ITEM_CATEGORY LIKE '%http%'", "ITEM_CATEGORY RLIKE '^\\\\s+$'"):
        assert raw.filter(case).count() > 0, case


def test_source_rows_are_unique_and_follow_the_file(spark, sf):
    for raw in (fixtures.raw_order_items(spark, sf), fixtures.raw_options(spark, sf), fixtures.raw_date_dim(spark, sf)):
        stats = raw.agg(F.min("source_row"), F.count_distinct("source_row"), F.count("*")).first()
        assert stats[0] >= 2 and stats[1] == stats[2]
