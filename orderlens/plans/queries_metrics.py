"""Registered metric queries (M1-M18), in report order."""

from __future__ import annotations

from orderlens.operators import metrics as m
from orderlens.plans.registry_base import Query, items, options

# Fixed test anchor for the trailing month (the last order date of the test data).
AS_OF = "2001-08-01 00:00:00"


def _r(name: str, build) -> Query:
    return lambda spark, d: m.in_report_order(build(spark, d), name)


def queries() -> dict[str, Query]:
    q = {
        "clv_lines": lambda s, d: m.clv_lines(items(s, d), options(s, d)),
        "clv_customer": lambda s, d: m.clv_customer(items(s, d), options(s, d)),
        "recent_purchase": lambda s, d: m.recent_purchases(items(s, d), 1),
        "recent_purchases_5": lambda s, d: m.recent_purchases(items(s, d), 5),
        "purchase_frequency": lambda s, d: m.purchase_frequency(items(s, d), as_of=AS_OF),
        "monthly_spend": lambda s, d: m.monthly_spend(items(s, d), as_of=AS_OF),
        "days_since_last_order": lambda s, d: m.days_since_last_order(items(s, d), as_of=AS_OF),
        "order_gaps": lambda s, d: m.order_gaps(items(s, d)),
        "spend_change_5": lambda s, d: m.spend_change_last_orders(items(s, d), 5),
        "weekly_daypart_wide": lambda s, d: m.weekly_revenue(items(s, d)),
        "weekly_daypart_long": lambda s, d: m.weekly_daypart_long(items(s, d)),
        "restaurant_weekly_daypart": lambda s, d: m.weekly_revenue(items(s, d), by="RESTAURANT_ID"),
        "restaurant_weekly": lambda s, d: m.weekly_revenue(items(s, d), by="RESTAURANT_ID", wide=False),
        "category_weekly_daypart": lambda s, d: m.weekly_revenue(items(s, d), by="ITEM_CATEGORY"),
        "category_weekly": lambda s, d: m.weekly_revenue(items(s, d), by="ITEM_CATEGORY", wide=False),
        "non_loyalty_orders": lambda s, d: m.non_loyalty_orders(items(s, d)),
        "guest_orders": lambda s, d: m.non_loyalty_orders(items(s, d), guests_only=True),
        "non_loyalty_customers": lambda s, d: m.non_loyalty_customers(items(s, d)),
        "loyalty_customers": lambda s, d: m.loyalty_customers(items(s, d)),
        "top_locations": lambda s, d: m.top_locations(items(s, d)),
        "discount_effectiveness": lambda s, d: m.discount_effectiveness(items(s, d), options(s, d)),
    }
    # the literal forms of the metrics: guests count as customers, and the trailing month
    # ends with the latest order
    q |= {
        "purchase_frequency_latest": lambda s, d: m.purchase_frequency(items(s, d), include_guests=True),
        "monthly_spend_latest": lambda s, d: m.monthly_spend(items(s, d), include_guests=True),
        "order_gaps_all": lambda s, d: m.order_gaps(items(s, d), include_guests=True),
    }
    return {name: _r(name, build) for name, build in q.items()}
