import datetime as dt
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from orderlens.operators import metrics as m
from orderlens.plans.registry_base import items, options
from orderlens.schemas import TYPED_SCHEMAS


def _items(spark, rows):
    full = [("app", "r1", ts, o, u, None, loyal, "USD", ln, "cat", "n", Decimal(p), q)
            for (o, ln, u, ts, p, q, loyal) in rows]
    return spark.createDataFrame(full, TYPED_SCHEMAS["order_items"])


def T(d, h=0):
    return dt.datetime(2021, 3, d, h)


def test_order_gaps_equals_brute_force_lag(spark, sf):
    it = items(spark, sf)
    ours = {r["USER_ID"]: r for r in m.order_gaps(it).collect()}
    pdf = m.order_totals(it).toPandas().sort_values(["USER_ID", "order_time", "ORDER_ID"], na_position="first")
    pdf["order_total"] = pdf["order_total"].astype(float)  # orders without a total are NaN
    pdf["d"] = pdf.groupby("USER_ID")["order_time"].diff().dt.days
    pdf["day"] = pdf["order_time"].dt.normalize()
    pdf["d"] = pdf.groupby("USER_ID")["day"].diff().dt.days
    pdf["s"] = pdf.groupby("USER_ID")["order_total"].diff()
    g = pdf.groupby("USER_ID").agg(n=("order_time", "count"), d=("d", "mean"), s=("s", "mean"))
    g = g[g["n"] > 1]
    assert set(g.index) == set(ours)
    for user, row in g.iterrows():
        assert ours[user]["total_orders"] == row["n"]
        assert abs(ours[user]["avg_days_between_orders"] - row["d"]) < 1e-6
        spend = ours[user]["avg_spend_diff_between_orders"]
        assert spend is None if pd.isna(row["s"]) else abs(spend - row["s"]) < 1e-5


def test_spend_change_uses_previous_order_before_the_cut(spark):
    rows = [(f"o{i}", "l", "u", T(i), str(10 * i), 1, False) for i in range(1, 8)]
    rows.append(("z0", "l", "v", T(1), "0", 1, False))
    rows.append(("z1", "l", "v", T(2), "5", 1, False))
    out = m.spend_change_last_orders(_items(spark, rows), 5).orderBy("USER_ID", "order_time").collect()
    u = [r for r in out if r["USER_ID"] == "u"]
    assert [r["ORDER_ID"] for r in u] == ["o3", "o4", "o5", "o6", "o7"]
    assert u[0]["prev_order_total"] == Decimal("20.00")
    assert u[0]["pct_change_from_prev_order"] == Decimal("50.00")
    v = [r for r in out if r["USER_ID"] == "v"]
    assert v[0]["prev_order_total"] is None and v[1]["pct_change_from_prev_order"] is None  # previous total 0


def test_recent_purchase_tie_break_and_guests(spark):
    rows = [("o2", "l2", "u", T(5), "1", 1, False), ("o1", "l9", "u", T(5), "1", 1, False),
            ("o1", "l1", "u", T(5), "1", 1, False), ("g", "l1", None, T(6), "1", 1, False),
            ("b", "l1", " ", T(6), "1", 1, False)]
    df = _items(spark, rows)
    top = m.recent_purchases(df, 1).collect()
    assert [(r["ORDER_ID"], r["LINEITEM_ID"]) for r in top] == [("o1", "l1")]
    with_guests = m.recent_purchases(df, 1, include_guests=True).collect()
    assert len(with_guests) == 3


def test_trailing_month_defaults_to_latest_order(spark):
    rows = [("o1", "l", "u", T(1), "1", 1, False), ("o2", "l", "u", dt.datetime(2021, 2, 1), "2", 1, False),
            ("o3", "l", "w", dt.datetime(2021, 1, 15), "4", 1, False)]
    df = _items(spark, rows)
    freq = {r["USER_ID"]: r["number_of_purchases"] for r in m.purchase_frequency(df).collect()}
    assert freq == {"u": 2}  # window starts 2021-02-01 00:00 (inclusive), a month before the latest order
    days = {r["USER_ID"]: r["days_since_last_order"] for r in m.days_since_last_order(df, as_of="2021-03-11 23:00:00").collect()}
    assert days == {"u": 10}


def test_weekly_long_pivots_to_wide(spark, sf):
    it = items(spark, sf)
    wide = m.weekly_revenue(it).toPandas().set_index("order_week").sort_index()
    long = m.weekly_daypart_long(it).toPandas()
    piv = long.pivot(index="order_week", columns="time_of_day", values="total_revenue").fillna(Decimal("0.00"))
    piv = piv.sort_index()
    assert (piv["Morning"] == wide["morning_revenue"]).all()
    assert (piv["Afternoon"] == wide["afternoon_revenue"]).all()
    assert (piv["Evening"] == wide["evening_revenue"]).all()
    assert (wide["morning_revenue"] + wide["afternoon_revenue"] + wide["evening_revenue"] == wide["total_weekly_revenue"]).all()


def test_discount_shares_sum_to_100(spark, sf):
    out = m.discount_effectiveness(items(spark, sf), options(spark, sf)).collect()
    assert {r["discount_status"] for r in out} == {"Discounted Order", "Full Price Order"}
    assert abs(sum(r["pct_of_total_orders"] for r in out) - 100) <= Decimal("0.01")
    assert abs(sum(r["pct_of_total_revenue"] for r in out) - 100) <= Decimal("0.01")
    assert sum(r["total_orders"] for r in out) == items(spark, sf).filter("ORDER_ID IS NOT NULL").select("ORDER_ID").distinct().count()


def test_loyalty_counts_orders_not_users(spark):
    rows = [("o1", "l1", "u", T(1), "10", 1, True), ("o1", "l2", "u", T(1), "5", 1, True),
            ("o2", "l1", "u", T(2), "5", 1, True), ("o3", "l1", "u", T(3), "7", 1, False)]
    r = m.loyalty_customers(_items(spark, rows)).first()
    assert r["number_of_orders"] == 2 and r["total_loyalty_revenue"] == Decimal("20.00")
    assert r["average_order_amount"] == Decimal("10.00")


def test_half_up_mean_is_exact(spark):
    from orderlens.functions.rounding import half_up_mean
    df = spark.createDataFrame([(Decimal("0.05"), 2), (Decimal("0.15"), 2), (Decimal("-0.05"), 2), (Decimal("1.00"), 0)],
                               "s decimal(38,2), n bigint")
    got = [r[0] for r in df.select(half_up_mean(F.col("s"), F.col("n"))).collect()]
    assert got == [Decimal("0.03"), Decimal("0.08"), Decimal("-0.03"), None]


def test_order_gaps_with_unknown_totals(spark):
    """Differences are between neighbours that both have a total."""
    rows = [("o1", "l", "u", T(1), "10", 1, False), ("o2", "l", "u", T(2), "30", 1, False), ("o3", "l", "u", T(3), None, 1, False),
            ("o4", "l", "u", T(5), "50", 1, False), ("p1", "l", "v", T(1), None, 1, False), ("p2", "l", "v", T(4), "5", 1, False)]
    full = [("app", "r1", ts, o, u, None, loyal, "USD", ln, "cat", "n", None if p is None else Decimal(p), q) for (o, ln, u, ts, p, q, loyal) in rows]
    got = {r["USER_ID"]: r for r in m.order_gaps(spark.createDataFrame(full, TYPED_SCHEMAS["order_items"])).collect()}
    assert got["u"]["avg_spend_diff_between_orders"] == 20.0 and got["u"]["total_orders"] == 4
    assert got["v"]["avg_spend_diff_between_orders"] is None and got["v"]["avg_days_between_orders"] == 3.0


def test_half_up_ratio_matches_decimal_arithmetic(spark):
    from decimal import ROUND_HALF_UP

    from hypothesis import given, settings
    from hypothesis import strategies as st

    from orderlens.functions.rounding import half_up_ratio

    cents = st.integers(min_value=-10**9, max_value=10**9)

    @settings(max_examples=25, deadline=None)
    @given(st.lists(st.tuples(cents, cents), min_size=1, max_size=20))
    def check(pairs):
        rows = [(Decimal(a) / 100, Decimal(b) / 100) for a, b in pairs]
        df = spark.createDataFrame(rows, "a decimal(20,2), b decimal(20,2)")
        got = [r[0] for r in df.select(half_up_ratio(F.col("a"), F.col("b"), 100)).collect()]
        want = [None if b == 0 else (a * 100 / b).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
                for a, b in rows]
        assert got == want

    check()


def test_default_anchor_counts_guest_orders(spark):
    # the latest order is a guest's: the identified user's order two months earlier falls outside
    rows = [("o1", "l", "u", T(1), "1", 1, False), ("g1", "l", None, dt.datetime(2021, 5, 1), "1", 1, False)]
    df = _items(spark, rows)
    assert m.purchase_frequency(df).count() == 0
    assert m.days_since_last_order(df).count() == 0
    assert {r["USER_ID"] for r in m.purchase_frequency(df, include_guests=True).collect()} == {None}
