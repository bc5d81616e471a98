import os
import tempfile

import pytest
from pyspark.sql import functions as F

from orderlens.operators import gold, metrics, silver
from orderlens.plans import jobs
from orderlens.plans.registry_base import items, options
from orderlens.schemas import GOLD_SCHEMAS
from orderlens.sources import fixtures, layers


def rows_of(df):
    names = sorted(c for c in df.columns if c != layers.MONTH)
    return sorted(tuple(map(str, r)) for r in df.select(*names).collect())


def by_month(spark, days):
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "d string, i long")
    return silver.with_month(df.select(F.to_date("d").alias("ORDER_DATE"), "i"))


def values(spark, base, table="t"):
    return sorted(r["i"] for r in layers.read_layer(spark, base, table).collect())


def test_months_are_added_and_replaced(spark, tmp_path):
    base = str(tmp_path)
    days = ["2024-01-05", "2024-01-20", "2024-02-03", "2024-03-01", None]
    layers.write_layer(by_month(spark, days), base, "t", by_month=True)
    kept = layers.versions(spark, base)["t"]
    # one month replaced, one added; the others stay where they are
    new = by_month(spark, ["2024-02-10", "2024-04-01"]).withColumn("i", F.col("i") + 10)
    layers.write_layer(new, base, "t", mode="touched", by_month=True)
    assert values(spark, base) == [0, 1, 3, 4, 10, 11]
    now = layers.versions(spark, base)["t"]
    old = next(iter(kept))
    assert now[old] == ["2024-01-01", "2024-03-01", None] and sorted(next(m for v, m in now.items() if v != old)) == ["2024-02-01", "2024-04-01"]
    layers.write_layer(by_month(spark, ["2024-01-31", None]).withColumn("i", F.col("i") + 20), base, "t", mode="append", by_month=True)
    assert values(spark, base) == [0, 1, 3, 4, 10, 11, 20, 21]
    # the months without a date can be replaced too, and a table by none of its months
    layers.write_layer(by_month(spark, [None]).withColumn("i", F.lit(30).cast("long")), base, "t", mode="touched", by_month=True)
    assert values(spark, base) == [0, 1, 3, 10, 11, 20, 30]
    layers.write_layer(by_month(spark, []), base, "t", by_month=True)
    assert values(spark, base) == []


def test_only_wanted_months_are_scanned(spark, tmp_path):
    base = str(tmp_path)
    layers.write_layer(by_month(spark, ["2024-01-05", "2024-02-03"]), base, "t", by_month=True)
    layers.write_layer(by_month(spark, ["2024-02-04", "2024-03-05"]), base, "t", mode="append", by_month=True)
    df = layers.read_layer(spark, base, "t").filter("ORDER_MONTH >= DATE'2024-02-01'")
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "DataFilters: []" in plan
    assert len({os.path.dirname(f) for f in df.inputFiles()}) >= 3


def test_trailing_month_metrics_read_their_months_only(spark, sf, tmp_path):
    lines = silver.with_month(silver.silver_order_items(items(spark, sf), options(spark, sf), fixtures.order_calendar(spark, sf)))
    layers.write_layer(lines, str(tmp_path), "order_items", by_month=True)
    stored = layers.read_layer(spark, str(tmp_path), "order_items")
    anchor = items(spark, sf).agg(F.max("CREATION_TIME_UTC")).first()[0]
    for name, as_of in (("purchase_frequency", None), ("monthly_spend", None), ("days_since_last_order", None), ("monthly_spend", str(anchor))):
        metric = getattr(metrics, name)
        got = metric(stored, as_of=as_of)
        assert rows_of(got) == rows_of(metric(items(spark, sf), as_of=as_of)) != []
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert any("PartitionFilters: [" in x and "ORDER_MONTH" in x.split("PartitionFilters: [")[1].split("PushedFilters")[0] for x in plan.splitlines())


@pytest.mark.parametrize("at", range(4))
def test_a_failure_at_any_table_leaves_all_old_tables(spark, tmp_path, monkeypatch, at):
    base, names = str(tmp_path), ["a", "b", "c"]
    with layers.Staged(spark, base) as run:
        for n in names:
            run.write(spark.range(3), n)
        run.publish()
    before, plain = layers.versions(spark, base), layers._Files.replace
    if at == 3:  # in the publication itself
        monkeypatch.setattr(layers._Files, "replace", lambda *a: (_ for _ in ()).throw(OSError("no pointer")))
    with pytest.raises(Exception, match="bad price|no pointer"):
        with layers.Staged(spark, base) as run:
            for i, n in enumerate(names):
                bad = F.raise_error(F.lit("bad price")).cast("bigint").alias("id")
                run.write(spark.range(9).select(bad) if i == at else spark.range(9), n)
            run.publish()
    monkeypatch.setattr(layers._Files, "replace", plain)
    assert layers.versions(spark, base) == before
    assert [layers.read_layer(spark, base, n).count() for n in names] == [3, 3, 3]
    # nothing of the failed run is left
    assert all(len(os.listdir(f"{base}/_data/{n}")) == 1 for n in names) and not os.path.exists(f"{base}/_staged")


def test_readers_of_the_version_before_go_on(spark, tmp_path):
    base = str(tmp_path)
    layers.write_layer(spark.range(3), base, "t")
    old = layers.read_layer(spark, base, "t")
    layers.write_layer(spark.range(8), base, "t")
    assert old.count() == 3 and layers.read_layer(spark, base, "t").count() == 8
    layers.write_layer(spark.range(2), base, "t")
    assert len(os.listdir(f"{base}/_data/t")) == 2  # the current one and the one before
    with layers.Staged(spark, base) as one:
        one.write(spark.range(1), "t")
        layers.write_layer(spark.range(5), base, "t")
        with pytest.raises(RuntimeError, match="another run"):
            one.publish()
    assert layers.read_layer(spark, base, "t").count() == 5
    assert layers.stored_row_counts(spark, base).collect()[0] == ("t", 5)


def test_a_failed_report_leaves_the_earlier_one(spark, tmp_path):
    base = str(tmp_path)
    first = layers.write_report({"a": spark.range(3), "b": spark.range(4)}, base)
    bad = spark.range(5).select(F.raise_error(F.lit("bad")).alias("x"))
    with pytest.raises(Exception, match="bad"):
        layers.write_report({"a": spark.range(9), "b": bad}, base)
    assert spark.read.parquet(first["a"]).count() == 3 and layers.read_layer(spark, base, "b").count() == 4


def test_plain_folders_are_layers_too(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/order_items")
    assert layers.read_layer(spark, str(tmp_path), "order_items").count() == 4


# increments -----------------------------------------------------------------------
def _full(spark, root, name, lines, opts):
    bronze = f"{root}/{name}-bronze"
    layers.write_layer(lines, bronze, layers.BRONZE_TABLES["order_items"])
    layers.write_layer(opts, bronze, layers.BRONZE_TABLES["options"])
    jobs.bronze_to_silver(spark, bronze, f"{root}/{name}-silver")
    jobs.silver_to_gold(spark, f"{root}/{name}-silver", f"{root}/{name}-gold", database=None)


def test_increments_equal_a_full_run(spark, sf):
    """Two increments, the second with late days, lines without a date, an order whose lines
    come apart, new users and users whose only revenue is unknown so far."""
    root = tempfile.mkdtemp(prefix="orderlens-inc-")
    every = items(spark, sf)
    day, o = F.to_date("CREATION_TIME_UTC"), F.crc32(F.col("ORDER_ID")) % 40
    undated = F.crc32(F.col("LINEITEM_ID")) % 97 == 5
    every = every.withColumn("CREATION_TIME_UTC", F.when(~undated | F.col("ORDER_ID").isNull(), F.col("CREATION_TIME_UTC")))
    every = every.withColumn("ITEM_PRICE", F.when(F.crc32(F.col("USER_ID")) % 5 > 0, F.col("ITEM_PRICE")))
    border = items(spark, sf).agg(F.percentile_approx(day.cast("timestamp").cast("long"), 0.98)).first()[0]
    late = F.coalesce(o == 3, F.lit(False)) | F.coalesce(F.crc32(F.col("LINEITEM_ID")) % 50 == 7, F.lit(False))
    new = F.coalesce(day.cast("timestamp").cast("long") > border, F.lit(False))
    batch = F.when(late, 2).when(new, 1).otherwise(0)
    marked = every.withColumn("batch", batch)
    marked.write.parquet(f"{root}/marked")
    marked = spark.read.parquet(f"{root}/marked")
    opts = options(spark, sf)
    opts.write.parquet(f"{root}/options")
    opts = spark.read.parquet(f"{root}/options")

    def part(b):
        lines = marked.filter(F.col("batch") == b).drop("batch")
        return lines, opts.join(lines.select("ORDER_ID", "LINEITEM_ID"), ["ORDER_ID", "LINEITEM_ID"], "left_semi").select(*opts.columns)

    assert all(part(b)[0].count() > 30 for b in (0, 1, 2))
    _full(spark, root, "inc", *part(0))
    before = layers.versions(spark, f"{root}/inc-gold")["customer_ltv_daily"]
    counts = jobs.append_orders(spark, f"{root}/inc-silver", f"{root}/inc-gold", *part(1), database="gold_inc").counts
    after = layers.versions(spark, f"{root}/inc-gold")["customer_ltv_daily"]
    # the new days' months are replaced, the others stay
    first = next(iter(before))
    assert len(after) == 2 and len(after[first]) > 60 and 0 < counts["lifetime_value_rows"] < 200
    jobs.append_orders(spark, f"{root}/inc-silver", f"{root}/inc-gold", *part(2), database="gold_inc")
    joined = [part(b) for b in (0, 1, 2)]
    _full(spark, root, "full", *[joined[0][i].unionByName(joined[1][i]).unionByName(joined[2][i]) for i in (0, 1)])
    for kind, table in (("gold", "customer_ltv_daily"), ("gold", jobs.LTV_STATE), ("silver", "order_items"), ("silver", "order_item_options")):
        got, want = (layers.read_layer(spark, f"{root}/{n}-{kind}", table) for n in ("inc", "full"))
        assert rows_of(got) == rows_of(want), table
    view = spark.table("gold_inc.customer_ltv_daily")
    assert [(f.name, f.dataType) for f in view.schema] == [(f.name, f.dataType) for f in GOLD_SCHEMAS["customer_ltv_daily"]]
    assert rows_of(view) == rows_of(layers.read_layer(spark, f"{root}/full-gold", "customer_ltv_daily"))
    # the same lines once more fail, and change nothing
    was = layers.versions(spark, f"{root}/inc-silver"), layers.versions(spark, f"{root}/inc-gold")
    with pytest.raises(ValueError, match="duplicate"):
        jobs.append_orders(spark, f"{root}/inc-silver", f"{root}/inc-gold", *part(1))
    assert (layers.versions(spark, f"{root}/inc-silver"), layers.versions(spark, f"{root}/inc-gold")) == was


def test_new_days_need_no_history(spark):
    """For days after all stored ones, the stored values that are given can be empty."""
    stored = "user_id string, order_date date, daily_revenue decimal(38,2), cumulative_ltv decimal(38,2), daily_order_count long, cumulative_order_count long, ORDER_MONTH date"
    state = spark.createDataFrame([("u", 1, 3, 1), ("w", 9, 9, 9)], "user_id string, total_revenue int, total_orders long, known_days long")
    state = state.withColumn("total_revenue", F.col("total_revenue").cast("decimal(38,2)"))
    changed = spark.sql("SELECT 'u' user_id, DATE'2024-05-01' order_date, CAST(2 AS DECIMAL(38,2)) daily_revenue, 1L daily_order_count, DATE'2024-05-01' ORDER_MONTH")
    rows, totals = gold.refreshed_lifetime_values(spark.createDataFrame([], stored), state, changed)
    assert [tuple(map(str, r)) for r in rows.collect()] == [("u", "2024-05-01", "2.00", "3.00", "1", "4", "2024-05-01")]
    assert sorted(tuple(map(str, r)) for r in totals.collect()) == [("u", "3.00", "4", "2"), ("w", "9.00", "9", "9")]
