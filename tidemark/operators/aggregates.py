"""Sales totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rowkind import is_integral
from tidemark.functions.temporal import hour_of


def hourly_sales(
    orders: DataFrame,
    products: DataFrame,
    *,
    product: str = "product_id",
    price: str = "sale_price",
    at: str = "purchase_timestamp",
    hour: Column | None = None,
) -> DataFrame:
    """``sum(price)`` by product and hour of day over orders left-joined with products.

    A price depends on the product alone, so orders are counted by product and hour
    first: the join sees one row per group instead of one per order, and a product
    with most of the orders is already combined before the first shuffle. No key is
    heavy any more, so the join is left to the optimizer.
    """
    counts = orders.groupBy(product, (hour if hour is not None else hour_of(at, "bigint")).alias("hh")).agg(
        F.count(F.lit(1)).alias("_orders")
    )
    priced = counts.join(products.select(product, price), product, "left")
    return priced.select(product, "hh", (_summand(priced, price) * F.col("_orders")).alias("sales"))


def customer_total(
    enriched: DataFrame, customer: object | None = None, *, key: str = "customer_id", price: str = "sale_price"
) -> DataFrame:
    """``sum(price)`` by customer; of one customer when ``customer`` is given."""
    rows = enriched if customer is None else enriched.filter(F.col(key) == F.lit(customer))
    return rows.groupBy(key).agg(F.sum(_summand(rows, price)).alias("sales"))


def _summand(df: DataFrame, column: str) -> Column:
    """Whole numbers as long ones, so that sums do not overflow; decimals and doubles as they are."""
    return F.col(column).cast("bigint") if is_integral(df, column) else F.col(column)
