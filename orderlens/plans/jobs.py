"""End-to-end jobs: raw CSV landing, bronze -> silver (E1), silver -> gold
and the quality report (E3).

Datasets are written beside the current ones, checked, and only then published, all tables
of a layer at once (``layers.Staged``): a failed load or check leaves the earlier rows
readable.
Fewer passes than a naive script: source and silver row counts are observed
during the write, the non-empty and grain checks of a dataset share one
aggregate, and written row counts are observed during the writes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import checks, gold, quality, silver
from orderlens.schemas import GOLD_GRAIN
from orderlens.sources import ingest, layers

C = F.col


@dataclass
class JobReport:
    """Counts and notes a job reports (what the original jobs printed)."""

    counts: dict[str, int] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    notes: list[str] = field(default_factory=list)


def _count_of(obs: Observation) -> int:
    return int(obs.get["rows"])


# Landing ----------------------------------------------------------------------
RAW_FILES = {"order_items": "order_items", "order_item_options": "options", "date_dim": "date_dim"}


def land_raw_csv(spark: SparkSession, csv_paths: dict[str, str], bronze_base: str) -> JobReport:
    """Raw CSV -> bronze: the raw text (with source rows, for the quality report) and
    the typed tables. A file with missing or unexpected columns, a broken record or a
    value that the strict typed load rejects fails the job, and all bronze tables
    stay as they were."""
    report = JobReport()
    typed = {
        "order_items": ingest.ingest_order_items,
        "order_item_options": ingest.ingest_options,
        "date_dim": ingest.ingest_date_dim,
    }
    with layers.Staged(spark, bronze_base) as staged:
        for table, short in RAW_FILES.items():
            raw = ingest.read_raw_csv(spark, csv_paths[table], table)
            raw_out, obs = checks.observed(raw, f"raw_{short}")
            staged.write(raw_out, f"raw_{short}")
            report.counts[f"raw_{short}"] = _count_of(obs)
            kept = spark.read.parquet(staged.path(f"raw_{short}"))
            staged.write(typed[table](kept.drop("source_row")), layers.BRONZE_TABLES[short])
        staged.publish()
    return report


# E1 ---------------------------------------------------------------------------
def bronze_to_silver(
    spark: SparkSession,
    bronze_base: str,
    silver_base: str,
    calendar: DataFrame | None = None,
    holidays: DataFrame | None = None,
    holidays_from_date_dim: bool = False,
) -> JobReport:
    """Silver lines, options and calendar.

    ``calendar`` defaults to the days from the first to the last order, every day a
    non-holiday. ``holidays_from_date_dim`` marks the holidays the bronze date
    dimension flags (its ``is_holiday`` rows, a few per year).

    The lines are written in one pass, with bronze and silver row counts observed on
    the way. V6 (silver keeps exactly the bronze lines) and the uniqueness of
    calendar days are settled before the written tables replace the earlier ones."""
    report = JobReport()
    items = layers.read_layer(spark, bronze_base, layers.BRONZE_TABLES["order_items"])
    options = layers.read_layer(spark, bronze_base, layers.BRONZE_TABLES["options"])
    for name, df in (("order_items", items), ("options", options)):
        report.schemas[name] = df.schema.simpleString()
    if holidays is None and holidays_from_date_dim:
        holidays = (
            layers.read_layer(spark, bronze_base, layers.BRONZE_TABLES["date_dim"])
            .filter(C("is_holiday") & C("date_key").isNotNull())
            .groupBy("date_key")
            .agg(F.min("holiday_name").alias("holiday_name"))
        )
    cal = calendar
    if cal is None:
        cal = silver.build_calendar(holidays=holidays, bounds=silver.order_span(items))
    checks.assert_no_duplicates(cal, ["date_key"], "Silver date_dim")

    bronze_obs = Observation("bronze_order_items")
    observed_items = items.observe(bronze_obs, F.count(F.lit(1)).alias("rows"))
    lines = silver.silver_order_items(observed_items, options, cal)
    unmatched = silver.unmatched_option_keys(items, options).count()
    report.counts["unmatched_option_keys"] = unmatched
    if unmatched:
        report.notes.append(f"{unmatched} option key pairs have no order line")

    with layers.Staged(spark, silver_base) as staged:
        out, silver_obs = checks.observed(lines, "silver_order_items")
        staged.write(silver.with_month(out), layers.SILVER_TABLES["order_items"], by_month=True)
        silver_count, bronze_count = _count_of(silver_obs), _count_of(bronze_obs)
        checks.assert_same_count(silver_count, bronze_count, "Silver order_items")
        report.counts.update(bronze_order_items=bronze_count, silver_order_items=silver_count)
        opts_out, opts_obs = checks.observed(silver.silver_options(options), "silver_options")
        staged.write(opts_out, layers.SILVER_TABLES["options"])
        report.counts["silver_order_item_options"] = _count_of(opts_obs)
        staged.write(silver.silver_calendar(cal), layers.SILVER_TABLES["date_dim"])
        staged.publish()
    return report


# E2 ---------------------------------------------------------------------------
def silver_to_gold(
    spark: SparkSession, silver_base: str, gold_base: str, database: str | None = "gold"
) -> JobReport:
    """Seven gold datasets, checked, written, optionally registered.

    C1 (silver grain) runs first and fails fast. order_detail keeps every
    silver line with the same key, so its grain check (C5) is C1. The order
    rollup is written once, beside the layer: five of the seven datasets read
    that table instead of the lines. One aggregate over the written lifetime
    values answers both C2 (not empty) and C3 (unique per user and date). Row
    counts (C4) are observed during the writes. All datasets are swapped in
    together, after the checks."""
    report = JobReport()
    lines = layers.read_layer(spark, silver_base, layers.SILVER_TABLES["order_items"])
    opts = layers.read_layer(spark, silver_base, layers.SILVER_TABLES["options"])
    report.schemas["silver_order_items"] = lines.schema.simpleString()

    checks.assert_no_duplicates(lines, ["ORDER_ID", "LINEITEM_ID"], "Silver order_items")
    with layers.Staged(spark, gold_base) as staged:
        rollup_path = f"{staged.folder}/rollup"
        gold.order_rollup(lines).write.parquet(rollup_path)
        rollup = spark.read.parquet(rollup_path)
        datasets = gold.gold_datasets(lines, opts, grain_checked=True, rollup=rollup)
        ltv = "customer_ltv_daily"
        observations = {}
        for name in [ltv, *[n for n in datasets if n != ltv]]:
            out, observations[name] = checks.observed(datasets[name], name)
            staged.write(silver.with_month(out) if name == ltv else out, name, by_month=name == ltv)
            if name == ltv:
                values = staged.read(ltv)
                _check_lifetime_values(values)
                staged.write(gold.lifetime_totals(values), LTV_STATE)
        report.counts.update({name: _count_of(obs) for name, obs in observations.items()})
        staged.publish()
    if database:
        layers.register_gold(spark, gold_base, database)
    return report


#: Each user's lifetime value at the end of what is stored; ``append_orders`` goes on from it.
LTV_STATE = "customer_ltv_state"


def append_orders(
    spark: SparkSession,
    silver_base: str,
    gold_base: str,
    new_items: DataFrame,
    new_options: DataFrame,
    database: str | None = None,
) -> JobReport:
    """Daily increment of E1 and of the lifetime values (G7, G8): new typed order lines with
    their options, of any dates.

    Silver: the new lines get their attributes and are added to the months that they fall
    in; nothing stored is rewritten. A line that is there already fails the job (stored
    lines of the same months are compared).

    Lifetime values: the user-days that the lines touch are computed from the stored lines of
    their months; a user's running values go on from the stored total, for late days from the
    total less the days that follow. Only the users touched, from their first new day on, are
    computed, and only the months that these days fall in are replaced. The result is that
    of a full run over all lines. The other gold datasets are rebuilt by
    ``silver_to_gold``."""
    report = JobReport()
    names = layers.SILVER_TABLES
    days = layers.read_layer(spark, silver_base, names["date_dim"])
    holidays = days.filter("is_holiday").select("date_key", "holiday_name")
    fresh = silver.build_calendar(holidays=holidays, bounds=silver.order_span(new_items))
    lines = silver.with_month(silver.silver_order_items(new_items, new_options, fresh))
    with layers.Staged(spark, silver_base) as silver_run, layers.Staged(spark, gold_base) as gold_run:
        out, seen = checks.observed(lines, "new_order_items")
        silver_run.write(out, names["order_items"], by_month=True, mode="append")
        report.counts["new_order_items"] = _count_of(seen)
        added = spark.read.parquet(silver_run.path(names["order_items"]))
        months = _span(added.agg(F.min(layers.MONTH), F.max(layers.MONTH), F.count_if(C(layers.MONTH).isNull())).first())
        key = ["ORDER_ID", "LINEITEM_ID"]
        touched = silver_run.read(names["order_items"]).filter(months)
        repeated = touched.join(added.select(*key).distinct(), key, "left_semi")
        checks.assert_no_duplicates(repeated.filter(" AND ".join(f"{k} IS NOT NULL" for k in key)), key, "Silver order_items")
        silver_run.write(silver.silver_options(new_options), names["options"], mode="append")
        new_days = silver.silver_calendar(fresh).join(days.select("date_key"), "date_key", "left_anti")
        silver_run.write(new_days, names["date_dim"], mode="append")

        report.counts["lifetime_value_rows"] = _refresh_lifetime_values(spark, gold_base, gold_run, touched, added)
        silver_run.publish()
        gold_run.publish()
    if database:
        layers.register_gold(spark, gold_base, database)
    return report


def _refresh_lifetime_values(
    spark: SparkSession, gold_base: str, run: layers.Staged, touched: DataFrame, added: DataFrame
) -> int:
    """Lifetime values for ``added`` lines, which are among the lines of the ``touched``
    months: the number of rows computed."""

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{run.folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{run.folder}/{name}")

    ltv = "customer_ltv_daily"
    user_days = gold.identified_lines(added).select("USER_ID", "ORDER_DATE").distinct()
    pair = C("l.USER_ID").eqNullSafe(C("d.USER_ID")) & C("l.ORDER_DATE").eqNullSafe(C("d.ORDER_DATE"))
    theirs = touched.alias("l").join(user_days.alias("d"), pair, "left_semi")
    changed = kept(gold.conform_activity(gold.customer_daily_activity(gold.order_rollup(theirs))), "changed")
    first, undated, n = changed.agg(F.min(layers.MONTH), F.count_if(C(layers.MONTH).isNull()), F.count(F.lit(1))).first()
    if not n:
        return 0
    stored = layers.read_layer(spark, gold_base, ltv)
    if not undated:  # a day without a date comes before all others
        stored = stored.filter(C(layers.MONTH) >= F.lit(first))
    rows, totals = gold.refreshed_lifetime_values(stored, layers.read_layer(spark, gold_base, LTV_STATE), changed)
    rows = kept(rows, "rows")
    run.write(gold.replaced_months(stored, rows), ltv, by_month=True, mode="touched")
    run.write(totals, LTV_STATE)
    _check_lifetime_values(spark.read.parquet(run.path(ltv)))
    return rows.count()


def _span(found: tuple) -> Column:
    """Months from the first to the last, and rows without one if there are any."""
    low, high, without = found
    inside = C(layers.MONTH).between(F.lit(low), F.lit(high))
    return inside | C(layers.MONTH).isNull() if without else inside


def _check_lifetime_values(ltv: DataFrame) -> None:
    """C2 and C3 in one aggregate."""
    keys = GOLD_GRAIN["customer_ltv_daily"]
    stats = ltv.groupBy(*keys).count().agg(F.count(F.lit(1)).alias("keys"), F.max("count").alias("widest")).first()
    if not stats or not stats["keys"]:
        raise checks.CheckFailed("customer_ltv_daily is empty.")
    if stats["widest"] > 1:
        raise checks.CheckFailed("customer_ltv_daily contains duplicate USER_ID + ORDER_DATE combinations.")


# E3 ---------------------------------------------------------------------------
def quality_frames(
    spark: SparkSession,
    raw_date_dim: DataFrame,
    raw_items: DataFrame,
    raw_options: DataFrame,
    broken: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every dataset of the quality report as DataFrames. ``broken``: the option
    rows without an order line, if they are already stored (five datasets use them)."""
    if broken is None:
        broken = quality.broken_option_rows(raw_options, raw_items)
    missing, dups, members, issues = quality.report_parts(spark, raw_date_dim, raw_items, raw_options, broken)
    return {
        "missing_values": missing,
        "duplicates": dups,
        "duplicate_members": members,
        "corrupt_values": issues,
        "expected_schema": quality.expected_schema(spark),
        "missing_item_fields": quality.missing_item_fields(raw_items),
        "investigated_order": quality.investigated_order(raw_items),
        "zero_quantity": quality.zero_quantity_rows(raw_items),
        "zero_quantity_counts": quality.zero_quantity_counts(raw_items),
        "broken_references": broken.orderBy("ORDER_ID", "LINEITEM_ID", "source_row"),
        "broken_reference_summary": quality.broken_summary(broken),
        "broken_reference_investigation": quality.broken_order_lines(broken, raw_items),
        "affected_orders": quality.affected_order_lines(broken, raw_items),
        "duplicate_investigation": quality.option_duplicates(raw_options).orderBy(
            *quality.OPTION_KEY, "source_row"
        ),
        "duplicate_groups": quality.option_duplicate_groups(raw_options),
        "summary": quality.quality_summary(spark, raw_date_dim, raw_items, raw_options),
    }


def quality_report(
    spark: SparkSession, bronze_base: str, out_base: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Read the landed raw text tables and write every report dataset, in either
    format from the same frames. The broken references are written once, as
    ``broken_reference_options`` (always Parquet), and read back by what needs them."""
    raw = {short: layers.read_layer(spark, bronze_base, f"raw_{short}") for short in RAW_FILES.values()}
    name = "broken_reference_options"
    layers.write_layer(quality.broken_option_rows(raw["options"], raw["order_items"]), out_base, name)
    broken = layers.read_layer(spark, out_base, name)
    frames = quality_frames(spark, raw["date_dim"], raw["order_items"], raw["options"], broken)
    return {name: layers.table_folder(spark, out_base, name), **layers.write_report(frames, out_base, fmt)}
