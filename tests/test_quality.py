from orderlens.operators import quality as dq
from orderlens.schemas import EXPECTED_COLUMNS


def _raw(spark, table, rows):
    cols = ["source_row"] + EXPECTED_COLUMNS[table]
    schema = ", ".join(["source_row bigint"] + [f"{c} string" for c in EXPECTED_COLUMNS[table]])
    return spark.createDataFrame([tuple(r) for r in rows], schema).select(*cols)


def _issues(df):
    return sorted((r["row"], r["column"], r["issue_type"]) for r in df.collect())


def test_option_rules_first_failure_only(spark):
    rows = [(2, "1", "1-1", "g", "a", "4:39", "0"), (3, "1", "1-1", "g", "a", "-0.50", "1.5"),
            (4, "1", "1-1", "g", "a", " ", "x"), (5, "1", "1-1", "g", "a", None, "2"),
            (6, "1", "1-1", "g", "a", "1.00", "-2"), (7, "1", "1-1", "g", "a", "0", "3")]
    got = _issues(dq.option_issues(_raw(spark, "order_item_options", rows)))
    assert got == [
        (2, "OPTION_PRICE", "Invalid numeric value"), (2, "OPTION_QUANTITY", "Invalid quantity"),
        (3, "OPTION_PRICE", "Negative option price"), (3, "OPTION_QUANTITY", "Invalid quantity"),
        (4, "OPTION_QUANTITY", "Invalid numeric value"), (6, "OPTION_QUANTITY", "Invalid quantity"),
    ]


def test_order_item_rules(spark):
    base = ["app", "r", "2021-12-07T16:23:30.917Z", "1", "u", "", "TRUE", "USD", "1-1", "c", "n", "1.00", "1"]
    def row(n, **kw):
        vals = dict(zip(EXPECTED_COLUMNS["order_items"], base))
        vals.update(kw)
        return [n] + [vals[c] for c in EXPECTED_COLUMNS["order_items"]]
    rows = [row(2), row(3, IS_LOYALTY="true"), row(4, IS_LOYALTY="maybe"), row(5, CURRENCY="usd"),
            row(6, CURRENCY=" EUR "), row(7, CREATION_TIME_UTC="2021-12-07 16:23:30"),
            row(8, CREATION_TIME_UTC="not-a-time"), row(9, ITEM_QUANTITY="0"), row(10, ITEM_PRICE="-1.00")]
    got = _issues(dq.order_item_issues(_raw(spark, "order_items", rows)))
    assert got == [(4, "IS_LOYALTY", "Invalid boolean value"), (5, "CURRENCY", "Invalid currency code"),
                   (8, "CREATION_TIME_UTC", "Invalid timestamp"), (9, "ITEM_QUANTITY", "Invalid quantity"),
                   (10, "ITEM_PRICE", "Negative price")]


def test_date_dim_rules_every_row(spark):
    rows = [(2, "05-03-2020", "2020", "3", "10", "Thursday", "FALSE", "FALSE", ""),
            (3, "12-31-2020", "2020", "12", "53", "Thursday", "false", "FALSE", ""),
            (4, "31/01/2020", "1999", "13", "1.5", "monday", "TRUE", "yes", "x"),
            (5, "1-2-2020", "x", "0", "wk", "Sunday", " ", "TRUE", None)]
    got = _issues(dq.date_dim_issues(_raw(spark, "date_dim", rows)))
    assert got == [
        (4, "date_key", "Invalid date"), (4, "day_of_week", "Invalid categorical value"),
        (4, "is_holiday", "Invalid boolean value"), (4, "month", "Out-of-range value"),
        (4, "week", "Invalid integer value"), (4, "year", "Out-of-range value"),
        (5, "month", "Out-of-range value"), (5, "week", "Invalid numeric value"), (5, "year", "Invalid numeric value"),
    ]


def test_missing_duplicates_and_columns(spark):
    rows = [(2, "1", "1-1", "g", "a", "1.00", "1"), (3, "1", "1-1", "g", "a", "1.00", "1"),
            (4, None, "1-1", "g", " ", "1.00", "1"), (5, None, "1-1", "g", " ", "1.00", "1")]
    raw = _raw(spark, "order_item_options", rows)
    miss = {r["column"]: r for r in dq.missing_values(raw, "order_item_options").collect()}
    assert miss["ORDER_ID"]["missing_count"] == 2 and str(miss["ORDER_ID"]["missing_percent"]) == "50.00"
    assert miss["OPTION_NAME"]["missing_count"] == 2 and miss["OPTION_PRICE"]["missing_count"] == 0
    dups = sorted((r["first_source_row"], r["duplicate_group_size"], r["duplicate_values"])
                  for r in dq.duplicate_rows(raw, "order_item_options").collect())
    assert [d[:2] for d in dups] == [(2, 2), (4, 2)]
    assert dups[1][2].startswith("ORDER_ID=nan | LINEITEM_ID=1-1 | OPTION_GROUP_NAME=g | OPTION_NAME=  |")
    members = sorted(tuple(r)[1:] for r in dq.duplicate_members(raw, "order_item_options").collect())
    assert members == [(2, 2), (2, 3), (4, 4), (4, 5)]
    empty = raw.limit(0)
    assert {str(r["missing_percent"]) for r in dq.missing_values(empty, "order_item_options").collect()} == {"0.00"}
    odd = raw.withColumnRenamed("OPTION_NAME", "OPTION").drop("OPTION_PRICE")
    col_issues = sorted((r["issue_type"], r["details"]) for r in dq.column_issues(spark, odd, "order_item_options").collect())
    assert col_issues == [("Missing column(s)", "OPTION_NAME, OPTION_PRICE"), ("Unexpected column(s)", "OPTION")]


def test_broken_references_null_safe(spark):
    items = _raw(spark, "order_items", [
        [2, "a", "r", "t", "1", "u", "", "TRUE", "USD", "1-1", "c", "n", "1", "1"],
        [3, "a", "r", "t", None, "u", "", "TRUE", "USD", "9-9", "c", "n", "1", "1"],
    ])
    opts = _raw(spark, "order_item_options", [
        (2, "1", "1-1", "g", "a", "1", "1"), (3, None, "9-9", "g", "a", "1", "1"),
        (4, None, "1-1", "g", "a", "1", "1"), (5, "7", "7-1", "g", "a", "1", "1"), (6, "7", "7-1", "g", "b", "1", "1"),
    ])
    broken = dq.broken_option_rows(opts, items)
    assert sorted(r["source_row"] for r in broken.collect()) == [4, 5, 6]
    issues = {r["row"]: r["value"] for r in dq.broken_reference_issues(broken).collect()}
    assert issues[4] == "nan / 1-1"
    summary = [(r["ORDER_ID"], r["LINEITEM_ID"], r["occurrence_count"]) for r in dq.broken_summary(broken).collect()]
    assert summary == [("7", "7-1", 2)]
    lines = dq.broken_order_lines(broken, items).collect()
    assert sorted((r["ORDER_ID"], r["LINEITEM_ID"]) for r in lines if r["ORDER_ID"]) == [("7", None)]
    assert [r["LINEITEM_ID"] for r in lines if r["ORDER_ID"] is None] == ["9-9"]


def test_option_duplicate_exact_match(spark):
    rows = [(2, "1", "1-1", "g", "a", "1.00", "1"), (3, "1", "1-1", "g", "a", "1.00", "1"),
            (4, "1", "1-1", "g", "b", "1.00", "1"), (5, "1", "1-1", "g", "b", "2.00", "1"),
            (6, "1", "1-1", "g", "c", None, None), (7, "1", "1-1", "g", "c", None, None),
            (8, None, "1-1", "g", "d", "1", "1"), (9, None, "1-1", "g", "d", "1", "1")]
    raw = _raw(spark, "order_item_options", rows)
    groups = {r["OPTION_NAME"]: r for r in dq.option_duplicate_groups(raw).collect()}
    assert set(groups) == {"a", "b", "c"}
    assert groups["a"]["exact_match"] is True and groups["b"]["exact_match"] is False
    assert groups["c"]["exact_match"] is False  # all prices missing: no single distinct value
    assert groups["b"]["original_source_row"] == 4 and groups["b"]["duplicate_count"] == 2
    members = dq.option_duplicates(raw).collect()
    assert len(members) == 6 and {r["duplicate_count"] for r in members} == {2}


def test_investigated_order_and_zero_quantity(spark):
    base = ["a", "r", "t", "1", "u", "", "TRUE", "USD", "1-1", "c", "n", "1", "1"]
    rows = [[2] + base, [3] + base[:3] + ["2"] + base[4:8] + [None, " ", "", "1", "0"],
            [4] + base[:3] + ["2"] + base[4:8] + ["2-2", "c", "n", "1", " 0 "], [5] + base[:12] + ["0.0"]]
    raw = _raw(spark, "order_items", rows)
    assert sorted(r["source_row"] for r in dq.investigated_order(raw).collect()) == [3, 4]
    assert sorted(r["source_row"] for r in dq.zero_quantity_rows(raw).collect()) == [3, 4]
    assert sorted((r[0], r[1]) for r in dq.zero_quantity_counts(raw).collect()) == [("0", 2), ("0.0", 1)]


def test_white_space_suffixes_and_bare_times(spark):
    base = ["app", "r", "2021-12-07T16:23:30Z", "1", "u", "", "TRUE", "USD", "1-1", "c", "n", "1.00", "1"]
    def row(n, **kw):
        vals = dict(zip(EXPECTED_COLUMNS["order_items"], base)) | kw
        return [n] + [vals[c] for c in EXPECTED_COLUMNS["order_items"]]
    rows = [row(2, ITEM_PRICE="12d"), row(3, ITEM_QUANTITY="12F"), row(4, ITEM_PRICE="\t\n"), row(5, CREATION_TIME_UTC="4:39:00"),
            row(6, CREATION_TIME_UTC="2021"), row(7, CREATION_TIME_UTC="2021-12-07 16:23:30+02:00"), row(8, ITEM_PRICE=" 1e1\t"),
            row(9, CURRENCY="\tUSD\n"), row(10, ITEM_PRICE="0x1F"), row(11, ITEM_QUANTITY="1.")]
    raw = _raw(spark, "order_items", rows)
    assert _issues(dq.order_item_issues(raw)) == [
        (2, "ITEM_PRICE", "Invalid numeric value"), (3, "ITEM_QUANTITY", "Invalid numeric value"), (5, "CREATION_TIME_UTC", "Invalid timestamp"),
        (6, "CREATION_TIME_UTC", "Invalid timestamp"), (10, "ITEM_PRICE", "Invalid numeric value"),
    ]
    missing = {r["column"]: r["missing_count"] for r in dq.missing_values(raw, "order_items").collect()}
    assert missing["ITEM_PRICE"] == 1


def test_summary_counts_column_issues(spark):
    raw = _raw(spark, "order_item_options", [(2, "1", "1-1", "g", "a", "x", "1")])
    dates, lines = _raw(spark, "date_dim", []), _raw(spark, "order_items", [])
    renamed = raw.withColumnRenamed("OPTION_GROUP_NAME", "OPTION_GROUP")
    got = {r["file"]: r for r in dq.quality_summary(spark, dates, lines, renamed, raw.limit(0)).collect()}
    assert got["order_item_options.csv"]["corrupt_or_invalid_values"] == 3  # two column issues, one price
    assert got["order_items.csv"]["rows"] == 0 and got["order_items.csv"]["missing_values"] == 0


def test_rules_run_compiled_and_agree_with_the_typed_load(spark, sf):
    from orderlens.functions.columns import is_missing, is_missing_cell, stripped
    from orderlens.plans.registry import all_queries
    from orderlens.sources.ingest import is_timestamp, utc_timestamp

    plan = all_queries()["dq_issues_order_items"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan  # rules in a lambda are interpreted row by row
    ends = ["", " ", "\t\n", "\u00a0", "\u3000", "\x1c", "\x85\u2028"]
    times = ["2021-12-07 16:23", "2021-12-07T16:23:30Z", "2021-12-07 16:23:30.5 +02:00", "2021-12-07 16:23:30-0230", "2021-13-07 16:23:30",
             "2021-12-07", "4:39", "2021", "x2021-12-07 16:23:30", "2021-12-07 16:23:30+02:00x", "2021-12-07 25:00:00Z"]
    rest = ["", "!", "~", "\x7f", "\u00e9", "a b", "\x00", "1", "USD"]
    rows = [(a + x + b,) for x in times + rest for a in ends for b in ends] + [(None,)]
    df = spark.createDataFrame(rows, "c string")
    got = df.select("c", is_timestamp("c").alias("i"), utc_timestamp("c").isNotNull().alias("u"), is_missing("c").alias("m"), is_missing_cell("c").alias("f"))
    assert [r for r in got.collect() if r["i"] != r["u"] or r["m"] != r["f"]] == []
    old = stripped("c").rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    numbers = spark.createDataFrame([(a + x + b,) for x in ("1", "-.5", "+1.e3", "12d", "1 2", "0x1F", ".", "", "1e400") for a in ends for b in ends] + [(None,)], "c string")
    wrong = numbers.filter(~dq._number("c").eqNullSafe(dq.F.when(old, stripped("c").try_cast("double"))))
    assert wrong.collect() == []
    assert df.filter(dq.C("c").rlike(dq.CURRENCY_PATTERN) != stripped("c").rlike("^[A-Z]{3}$")).collect() == []


def test_summary_does_not_interpret_the_rules(spark, sf):
    from orderlens.plans.registry import all_queries

    plan = all_queries()["dq_summary"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(array(CASE" not in plan
