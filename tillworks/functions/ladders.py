"""Classification ladders: the first rung that holds gives the label.

Thresholds are arguments. The labels and the default thresholds are fixed values: the vocabulary
that reports, column tests and dashboards share.
"""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillworks.functions.scalars import flag


def ladder(rungs: Iterable[tuple[Column, str]], otherwise: str) -> Column:
    """Labels by first match. A condition that is unknown does not match."""
    label = F
    for condition, name in rungs:
        label = label.when(condition, name)
    return label.otherwise(otherwise)


def at_least(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """A ladder of descending lower bounds on one value."""
    return ladder([(value >= bound, name) for bound, name in steps], otherwise)


# Activity tables


def spending_segment(spent: Column, high: float = 1000, medium: float = 500) -> Column:
    return at_least(spent, [(high, "High Value"), (medium, "Medium Value")], "Low Value")


def purchase_frequency(purchases: Column, frequent: int = 5, regular: int = 3) -> Column:
    return at_least(purchases, [(frequent, "Frequent"), (regular, "Regular")], "Occasional")


def product_preference(share: Column, strong: float = 0.7, mixed: float = 0.3) -> Column:
    return at_least(
        share, [(strong, "Electronics Enthusiast"), (mixed, "Mixed Buyer")], "Furniture Focused"
    )


def transaction_tier(amount: Column, high: float = 1000, medium: float = 100) -> Column:
    return at_least(amount, [(high, "high"), (medium, "medium")], "low")


def transaction_value_label(amount: Column, high: float = 1000, medium: float = 100) -> Column:
    return at_least(amount, [(high, "High Value"), (medium, "Medium Value")], "Low Value")


def user_segment(
    value: Column, vip: float = 1000, high: float = 500, medium: float = 100
) -> Column:
    return ladder(
        [
            (value >= vip, "VIP"),
            (value >= high, "High Value"),
            (value >= medium, "Medium Value"),
            (value > 0, "Low Value"),
        ],
        "No Purchase",
    )


def user_activity(days: Column, active: int = 7, risk: int = 30, dormant: int = 90) -> Column:
    return ladder(
        [(days <= active, "Active"), (days <= risk, "At Risk"), (days <= dormant, "Dormant")],
        "Churned",
    )


# Orders and lines


def shipping_performance(shipped: Column, required: Column, grace_days: int = 3) -> Column:
    return ladder(
        [
            (shipped.isNull(), "Not Shipped"),
            (shipped <= required, "On Time"),
            (shipped <= F.date_add(required, grace_days), "Slightly Late"),
        ],
        "Late",
    )


def freight_tier(freight: Column, high: float = 100, medium: float = 20) -> Column:
    return at_least(freight, [(high, "High Freight"), (medium, "Medium Freight")], "Low Freight")


def quantity_tier(quantity: Column, bulk: int = 50, large: int = 20, standard: int = 5) -> Column:
    return at_least(
        quantity,
        [(bulk, "Bulk Order"), (large, "Large Order"), (standard, "Standard Order")],
        "Small Order",
    )


def discount_tier(discount: Column, high: str = "0.2", medium: str = "0.1") -> Column:
    """Bounds are decimal text, so that they compare exactly with decimal discounts."""
    return ladder(
        [
            (discount >= F.lit(high).cast("decimal(5,3)"), "High Discount"),
            (discount >= F.lit(medium).cast("decimal(5,3)"), "Medium Discount"),
            (discount > 0, "Low Discount"),
        ],
        "No Discount",
    )


def is_high_value_line(net: Column, bound: float = 1000) -> Column:
    return flag(net >= bound)


# Customers

# The countries of each region group.
NORTH_AMERICA = ("USA", "Canada", "Mexico")
EUROPE = (
    "UK", "Germany", "France", "Spain", "Italy", "Belgium", "Switzerland", "Austria", "Poland",
    "Sweden", "Norway", "Denmark", "Finland", "Ireland", "Portugal",
)
SOUTH_AMERICA = ("Brazil", "Argentina", "Venezuela")


def region_group(country: Column) -> Column:
    return ladder(
        [
            (country.isin(*NORTH_AMERICA), "North America"),
            (country.isin(*EUROPE), "Europe"),
            (country.isin(*SOUTH_AMERICA), "South America"),
        ],
        "Other",
    )


def contact_type(title: Column) -> Column:
    words = {
        "owner": "Owner",
        "manager": "Manager",
        "representative": "Sales Rep",
        "agent": "Agent",
    }
    return ladder([(title.ilike(f"%{word}%"), name) for word, name in words.items()], "Other")


def customer_value(
    value: Column, vip: float = 10000, high: float = 5000, medium: float = 1000
) -> Column:
    return ladder(
        [
            (value >= vip, "VIP"),
            (value >= high, "High Value"),
            (value >= medium, "Medium Value"),
            (value > 0, "Low Value"),
        ],
        "No Orders",
    )


def customer_frequency(
    orders: Column, frequent: int = 20, regular: int = 10, occasional: int = 5
) -> Column:
    return ladder(
        [
            (orders >= frequent, "Frequent"),
            (orders >= regular, "Regular"),
            (orders >= occasional, "Occasional"),
            (orders > 0, "One-Time"),
        ],
        "Never Ordered",
    )


def customer_activity(
    days: Column, active: int = 30, risk: int = 90, dormant: int = 180
) -> Column:
    return ladder(
        [
            (days.isNull(), "Never Ordered"),
            (days <= active, "Active"),
            (days <= risk, "At Risk"),
            (days <= dormant, "Dormant"),
        ],
        "Churned",
    )


def customer_tier(
    value_segment: Column,
    frequency_segment: Column,
    orders: Column,
    days: Column,
    active: int = 30,
    risk: int = 90,
    lost: int = 180,
    new_orders: int = 2,
) -> Column:
    """Value, frequency and recency in one label. No last order counts as recent."""

    def within(bound: int) -> Column:
        return days.isNull() | (days <= bound)

    valuable = value_segment.isin("VIP", "High Value")
    return ladder(
        [
            (
                (value_segment == "VIP") & (frequency_segment == "Frequent") & within(active),
                "Champion",
            ),
            (valuable & frequency_segment.isin("Frequent", "Regular"), "Loyal"),
            (~within(risk) & valuable, "At Risk VIP"),
            ((orders <= new_orders) & within(risk), "New Customer"),
            (~within(lost), "Lost"),
        ],
        "Standard",
    )


# Products


def needs_reorder(stock: Column, reorder: Column, discontinued: Column) -> Column:
    return flag((stock <= reorder) & ~discontinued)


def stock_status(
    stock: Column, reorder: Column, discontinued: Column, overstock_factor: int = 3
) -> Column:
    return ladder(
        [
            ((stock == 0) & ~discontinued, "Out of Stock"),
            ((stock <= reorder) & ~discontinued, "Low Stock"),
            (stock > reorder * overstock_factor, "Overstocked"),
        ],
        "Normal",
    )


def price_tier(price: Column, premium: float = 50, mid_range: float = 20) -> Column:
    return at_least(price, [(premium, "Premium"), (mid_range, "Mid-Range")], "Economy")


def product_status(stock: Column, reorder: Column, discontinued: Column) -> Column:
    return ladder(
        [
            (discontinued, "Discontinued"),
            (stock == 0, "Out of Stock"),
            (stock <= reorder, "Low Stock"),
        ],
        "Available",
    )


def inventory_status(stock: Column, reorder: Column, overstock_factor: int = 3) -> Column:
    return ladder(
        [(stock <= reorder, "LOW STOCK"), (stock > reorder * overstock_factor, "OVERSTOCKED")],
        "NORMAL",
    )


def performance_tier(
    revenue: Column, star: float = 10000, high: float = 5000, solid: float = 1000
) -> Column:
    return ladder(
        [
            (revenue >= star, "Star Product"),
            (revenue >= high, "High Performer"),
            (revenue >= solid, "Solid Performer"),
            (revenue > 0, "Low Performer"),
        ],
        "Never Sold",
    )


def inventory_action(
    discontinued: Column,
    status: Column,
    revenue: Column,
    days_unsold: Column,
    urgent: float = 1000,
    priority: float = 5000,
    stale_days: int = 90,
) -> Column:
    return ladder(
        [
            (discontinued, "Discontinued"),
            ((status == "Out of Stock") & (revenue > urgent), "URGENT: Restock High Seller"),
            ((status == "Low Stock") & (revenue > priority), "High Priority Restock"),
            (status == "Low Stock", "Monitor Stock"),
            ((status == "Overstocked") & (days_unsold > stale_days), "Liquidate Excess"),
            (status == "Overstocked", "Reduce Inventory"),
        ],
        "Normal",
    )
