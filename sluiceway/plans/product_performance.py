"""Performance of products: viewers, event counts, completed sales, conversion rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.columns import half_up, percent
from sluiceway.operators.joins import join_totals

# Counted event types and their columns.
COUNTED = {"clicks": "click", "add_to_carts": "add_to_cart", "purchases_from_events": "purchase"}
ATTRIBUTES = ["product_id", "product_name", "category", "price"]

# Rules of the result.
RULES = [
    {"name": "check_product_id_not_null", "type": "null_check", "column": "product_id", "threshold": 0.0},
    {"name": "check_positive_price", "type": "range_check", "column": "price", "min_value": 0},
    {"name": "check_minimum_records", "type": "row_count", "min_count": 1},
]


def _with_event_totals(products: DataFrame, events: DataFrame) -> DataFrame:
    """Events are counted per product before the join, so a popular product is one row in it."""
    totals = {"unique_viewers": F.count_distinct("user_id")}
    totals |= {name: F.count_if(F.col("event_type") == word) for name, word in COUNTED.items()}
    seen = events.where(F.col("product_id").isNotNull()).select("product_id", "user_id", "event_type")
    return join_totals(products.select(*ATTRIBUTES), seen, "product_id", totals, dict.fromkeys(totals, 0))


def _one_row_each(joined: DataFrame, *more: str) -> DataFrame:
    """Products listed twice count their events twice, as a join with the events would."""
    once = [F.max(name).alias(name) for name in ("unique_viewers", *more)]
    return joined.groupBy(*ATTRIBUTES).agg(*once, *[F.sum(name).alias(name) for name in COUNTED])


def event_totals(products: DataFrame, events: DataFrame) -> DataFrame:
    """Viewers and event counts of every product, 0 for products without events."""
    return _one_row_each(_with_event_totals(products, events))


def product_performance(products: DataFrame, events: DataFrame, transactions: DataFrame) -> DataFrame:
    """Event totals, completed sales and the rates from click to cart to purchase.

    Both joins and the last grouping share the partitioning by product, so products and both sets of
    totals are shuffled once each.
    """
    sales = {
        "total_quantity_sold": F.sum("quantity"),
        "total_revenue": F.sum("total_amount"),
        "transaction_count": F.count(F.lit(1)),
    }
    completed = transactions.where(F.col("status") == "completed")
    seen = _with_event_totals(products, events)
    joined = join_totals(seen, completed, "product_id", sales, dict.fromkeys(sales, 0))
    per_unit = half_up(F.col("total_revenue") / F.col("total_quantity_sold"))
    return _one_row_each(joined, *sales).withColumns(
        {
            "click_to_cart_rate": percent(F.col("add_to_carts"), F.col("clicks")),
            "cart_to_purchase_rate": percent(F.col("transaction_count"), F.col("add_to_carts")),
            "avg_revenue_per_unit": F.when(F.col("total_quantity_sold") > 0, per_unit).otherwise(F.lit(0.0)),
        }
    )


def spec(products: dict, events: dict, transactions: dict, target: str, name: str = "product_performance") -> dict:
    """Spec that runs the plan from three source dicts into a folder, which is optimized after the write."""
    sources = {"products": products, "events": events, "transactions": transactions}
    return {
        "pipeline": {"name": name},
        "sources": [{**source, "name": key} for key, source in sources.items()],
        "transformations": [
            {
                "name": "product_performance",
                "type": "python",
                "inputs": list(sources),
                "output": "product_performance",
                "function": "sluiceway.plans.product_performance.product_performance",
            }
        ],
        "validation": {"enabled": True, "fail_on_error": True, "rules": RULES},
        "target": {"type": "parquet", "path": target, "mode": "overwrite", "optimize": {"enabled": True}},
    }
