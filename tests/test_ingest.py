import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from orderlens.schemas import EXPECTED_COLUMNS
from orderlens.sources import fixtures
from orderlens.sources import ingest as ing


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_read_raw_csv_numbers_rows_per_file(spark):
    folder = tempfile.mkdtemp(prefix="orderlens-csv-")
    header = ",".join(EXPECTED_COLUMNS["order_item_options"])
    _write(folder, "a.csv", header + "\n1,1-1,g,a,1.00,1\nNULL,1-2,\"multi\nline\",b,,2\n2,2-1,g,N/A,0.50, \n")
    _write(folder, "b.csv", header + "\n3,3-1,g,a,nan,1\n")
    raw = ing.read_raw_csv(spark, folder, "order_item_options")
    rows = [(r["ORDER_ID"], r["LINEITEM_ID"], r["source_row"], r["OPTION_GROUP_NAME"], r["OPTION_NAME"],
             r["OPTION_PRICE"], r["OPTION_QUANTITY"]) for r in raw.collect()]
    by_line = {r[1]: r for r in rows}
    assert by_line["1-1"][2] == 2 and by_line["1-2"][2] == 3 and by_line["2-1"][2] == 4
    assert by_line["3-1"][2] == 2  # second file restarts at row 2
    assert by_line["1-2"][0] is None and by_line["1-2"][3] == "multi\nline"
    assert by_line["2-1"][4] is None and by_line["3-1"][5] is None
    assert by_line["1-2"][5] is None  # an empty unquoted field is null; both count as missing
    assert by_line["2-1"][6] == " "


def test_typed_ingest_strict_and_lenient(spark, sf):
    raw = fixtures.raw_order_items(spark, sf)
    lenient = ing.ingest_order_items(raw, strict=False)
    assert lenient.schema["ITEM_PRICE"].dataType.simpleString() == "decimal(10,2)"
    bad = lenient.filter("ITEM_PRICE IS NULL OR ITEM_QUANTITY IS NULL OR CREATION_TIME_UTC IS NULL").count()
    assert bad > 0
    with pytest.raises(Exception):
        ing.ingest_order_items(raw, strict=True).write.format("noop").mode("overwrite").save()


def test_date_dim_ingest_values(spark):
    raw = spark.createDataFrame(
        [("05-03-2020", "2020", "3", "10", "Thursday", "TRUE", "false", "")],
        ", ".join(f"{c} string" for c in EXPECTED_COLUMNS["date_dim"]),
    )
    r = ing.ingest_date_dim(raw).first()
    assert r["date_key"] == dt.date(2020, 3, 5) and r["year"] == 2020 and r["week"] == 10
    assert r["is_weekend"] is True and r["is_holiday"] is False


def test_preview_and_describe(spark, sf):
    raw = fixtures.raw_order_items(spark, sf)
    prev = ing.preview_conversion(raw).collect()
    first = sorted(r["source_row"] for r in raw.select("source_row").collect())[:10]
    assert [r["source_row"] for r in prev] == first
    assert all(r["converted_is_loyalty"] in (0, 1, None) for r in prev)
    desc = {r["column_name"]: r for r in ing.describe_schema(spark, ing.ingest_order_items(raw, strict=False)).collect()}
    assert desc["ITEM_PRICE"]["data_type"] == "decimal(10,2)"


def test_option_decimal_and_int_casts(spark):
    raw = spark.createDataFrame([("1", "1-1", "g", "a", "2.5", "3"), ("1", "1-1", "g", "a", "x", "1.5")],
                                ", ".join(f"{c} string" for c in EXPECTED_COLUMNS["order_item_options"]))
    rows = ing.ingest_options(raw, strict=False).collect()
    assert rows[0]["OPTION_PRICE"] == Decimal("2.50") and rows[0]["OPTION_QUANTITY"] == 3
    assert rows[1]["OPTION_PRICE"] is None and rows[1]["OPTION_QUANTITY"] is None


def test_read_raw_csv_splittable_numbers_across_splits(spark):
    folder = tempfile.mkdtemp(prefix="orderlens-csv-")
    header = ",".join(EXPECTED_COLUMNS["order_item_options"])
    body = "".join(f"{i},{i}-1,group-{i % 7},opt,1.00,1\n" for i in range(2, 1502))
    _write(folder, "big.csv", header + "\n" + body)
    _write(folder, "small.csv", header + "\n2,2-1,g,a,1.00,1\n3,3-1,g,a,1.00,1\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = ing.read_raw_csv(spark, folder, "order_item_options")
        assert raw.rdd.getNumPartitions() > 3
        rows = raw.select("ORDER_ID", "source_row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 1502
    # every record's number equals its line in its file (ORDER_ID was written as that line)
    assert all(int(r["ORDER_ID"]) == r["source_row"] for r in rows)


def _raises(match, frame):
    with pytest.raises(Exception, match=match):
        frame.write.format("noop").mode("overwrite").save()


OPTION_HEADER = ",".join(EXPECTED_COLUMNS["order_item_options"])


def test_columns_go_by_name_in_any_order(spark, tmp_path):
    names = EXPECTED_COLUMNS["order_item_options"][::-1]
    _write(tmp_path, "a.csv", "\ufeff" + ",".join(names) + "\r\n2,1.00,opt,\"g, \"\"x\"\"\",1-1,1\r\n\r\n")
    row = ing.read_raw_csv(spark, str(tmp_path), "order_item_options").first()
    assert row.asDict() == {"source_row": 2, "ORDER_ID": "1", "LINEITEM_ID": "1-1", "OPTION_GROUP_NAME": 'g, "x"', "OPTION_NAME": "opt",
                            "OPTION_PRICE": "1.00", "OPTION_QUANTITY": "2"}


def test_missing_and_unexpected_columns(spark, tmp_path):
    _write(tmp_path, "a.csv", "LINEITEM_ID,ORDER_ID,OPTION_GROUP_NAME,OPTION_NAME,OPTION_PRICE,EXTRA\nL1,O1,g,n,1.00,e\n")
    with pytest.raises(ing.ColumnMismatch, match="OPTION_QUANTITY.*EXTRA"):
        ing.read_raw_csv(spark, str(tmp_path), "order_item_options")
    from orderlens.operators import quality as dq

    raw = ing.read_raw_csv(spark, str(tmp_path), "order_item_options", columns="report")
    assert raw.first().asDict() == {"source_row": 2, "LINEITEM_ID": "L1", "ORDER_ID": "O1", "OPTION_GROUP_NAME": "g", "OPTION_NAME": "n",
                                    "OPTION_PRICE": "1.00", "EXTRA": "e"}
    issues = sorted((r["issue_type"], r["details"]) for r in dq.table_issues(spark, raw, "order_item_options").collect())
    assert issues == [("Missing column(s)", "OPTION_QUANTITY"), ("Unexpected column(s)", "EXTRA")]


@pytest.mark.parametrize("record", ["1,1-1,g,a,1.00,1,7,8", "1,1-1", '1,1-1,"two\nlines",a,1.00', "1,1-1,g,a,1.00,1\r3,3-1,g,a,1.00,1"])
def test_broken_records_fail_the_read(spark, tmp_path, record):
    _write(tmp_path, "a.csv", OPTION_HEADER + "\n0,0-1,g,a,1.00,1\n" + record + "\n2,2-1,g,a,1.00,1\n")
    _raises("not one whole record", ing.read_raw_csv(spark, str(tmp_path), "order_item_options"))


def test_a_quote_that_is_never_closed_fails_the_read(spark, tmp_path):
    _write(tmp_path, "a.csv", OPTION_HEADER + '\n0,0-1,g,a,1.00,1\n1,1-1,"g,a,1.00,1\n2,2-1,g,a,1.00,1\n')
    _raises("never closed", ing.read_raw_csv(spark, str(tmp_path), "order_item_options"))


@pytest.fixture
def small_splits(spark):
    """Files of a few hundred bytes are read in many splits."""
    settings = {"spark.sql.files.maxPartitionBytes": "211", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _quoted_file(rng, records, end):
    """A file's text, with values of quotes, separators, line breaks and blank lines."""
    bits = ["x", ",", '""', "\n", "\r\n", "\n\n", " ", "y" * 90, "\n" + "z" * 230 + "\n", "é"]
    out = [OPTION_HEADER]
    for i in range(records):
        value = "".join(rng.choices(bits, k=rng.randrange(4))) if rng.random() < 0.5 else None
        group = "plain" if value is None else '"' + value + '"'
        out.append(f'{i},{i}-1,{group},"n{i}",1.00,{i}' if rng.random() < 0.7 else f'{i},{i}-1,{group},{"w" * rng.randrange(40)},1.00,{i}')
        if rng.random() < 0.1:
            out.append("" if rng.random() < 0.5 else " \t")
    return end.join(out) + (end if rng.random() < 0.5 else "")


def test_line_breaks_in_values_across_splits(spark, tmp_path, small_splits):
    """Rows are those of the parse of whole files by one task, wherever splits begin; but
    that parse makes CR LF in values LF, and here values stay as they are written."""
    import random

    rng = random.Random(8)
    for i in range(6):
        with open(tmp_path / f"f{i}.csv", "w", encoding="utf-8", newline="") as out:
            out.write(_quoted_file(rng, 10 + 25 * i, "\n" if i % 2 else "\r\n"))
    names = EXPECTED_COLUMNS["order_item_options"]
    got = ing.read_raw_csv(spark, str(tmp_path), "order_item_options")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 40
    rows = sorted(map(tuple, got.collect()), key=str)
    want = []
    for i in range(6):
        whole = spark.read.schema(", ".join(f"{c} string" for c in names)).option("header", True).option("multiLine", True).option("escape", '"')
        kept = [r for r in whole.csv(str(tmp_path / f"f{i}.csv")).collect() if any((v or "").strip() for v in r)]
        want += [(n + 2, *[None if v in ("", None) else v for v in r]) for n, r in enumerate(kept)]
    plain = lambda r: tuple((v.replace("\r\n", "\n") if isinstance(v, str) else v) or None for v in r)
    assert sorted(map(plain, rows), key=str) == sorted(map(plain, want), key=str)
    assert any("\n" in (r[3] or "") for r in rows) and any("\r\n" in (r[3] or "") for r in rows)


def test_a_value_longer_than_several_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(300))
    _write(tmp_path, "a.csv", f'{OPTION_HEADER}\n1,1-1,"{long}",a,1.00,1\n2,2-1,"b\n",a,1.00,1\n')
    rows = ing.read_raw_csv(spark, str(tmp_path), "order_item_options").orderBy("source_row").collect()
    assert [(r["source_row"], r["ORDER_ID"], r["OPTION_GROUP_NAME"]) for r in rows] == [(2, "1", long), (3, "2", "b\n")]


def test_files_without_such_values_are_not_shuffled(spark, tmp_path):
    _write(tmp_path, "a.csv", OPTION_HEADER + '\n0,0-1,"g, 1",a,1.00,1\n')
    raw = ing.read_raw_csv(spark, str(tmp_path), "order_item_options")
    assert raw.count() == 1
    raw.collect()
    final = raw._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "collect_list" not in final


def test_a_file_with_another_header_fails_the_read(spark, tmp_path):
    _write(tmp_path, "a.csv", OPTION_HEADER + "\n0,0-1,g,a,1.00,1\n")
    _write(tmp_path, "b.csv", ",".join(EXPECTED_COLUMNS["order_item_options"][::-1]) + "\n1,1.00,a,g,0-1,0\n")
    _raises("another header", ing.read_raw_csv(spark, str(tmp_path), "order_item_options"))


def test_long_texts_are_never_cut(spark):
    cols = EXPECTED_COLUMNS["order_item_options"]
    a, b = "x" * 300 + "1", "x" * 300 + "2"
    raw = spark.createDataFrame([(a, "1", "g", "n", "1", "1"), (b, "1", "g", "n", "1", "1")], ", ".join(f"{c} string" for c in cols))
    assert ing.ingest_options(raw, strict=False).select("ORDER_ID").distinct().count() == 2
    _raises("longer than 255", ing.ingest_options(raw))


@pytest.mark.parametrize("text, want", [
    ("2021-12-07T16:23:30.917Z", dt.datetime(2021, 12, 7, 16, 23, 30, 917000)), ("2021-12-07 16:23:30+02:00", dt.datetime(2021, 12, 7, 14, 23, 30)),
    (" 2021-12-07T16:23:30-0530\t", dt.datetime(2021, 12, 7, 21, 53, 30)), ("2021-12-07 16:23", dt.datetime(2021, 12, 7, 16, 23)),
    ("4:39", None), ("4:39:00", None), ("2021", None), ("2021-02-30 10:00:00", None), ("not-a-time", None), (None, None),
])
def test_times_are_utc_and_whole(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").select(ing.utc_timestamp("t").alias("u"))
    assert df.first()["u"] == want


def test_quarantine_parts_bad_rows(spark, sf):
    raw = fixtures.raw_order_items(spark, sf)
    good, bad = ing.quarantine(raw, "order_items")
    assert good.count() + bad.count() == raw.count() and bad.count() > 0
    assert bad.filter("CREATION_TIME_UTC = 'not-a-time'").count() == raw.filter("CREATION_TIME_UTC = 'not-a-time'").count()
    kept = raw.join(bad.select("source_row"), "source_row", "left_anti")
    assert ing.ingest_order_items(kept.drop("source_row")).count() == good.count()


def test_the_landing_contract_is_enforced(spark, sf):
    typed = ing.ingest_options(fixtures.raw_options(spark, sf).limit(5), strict=False)
    assert ing.conform_typed(typed, "order_item_options") is typed
    with pytest.raises(ValueError, match="contract"):
        ing.conform_typed(typed.withColumnRenamed("ORDER_ID", "X"), "order_item_options")
